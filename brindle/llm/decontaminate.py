"""Benchmark decontamination by greedy string tiling.

Seeds are runs of ``tile`` tokens (all of them for shorter items). Documents and benchmark
items that share a seed are compared: the longest common runs of tokens that do not overlap
earlier ones are marked again and again, found from the hashes of their seeds, until no run
of ``tile`` tokens is left. Marked tokens over the item's tokens are its coverage, so a
passage is caught whatever the order of its parts.

The benchmark's seeds are broadcast in blocks of at most ``BLOCK_BYTES`` of text, each of
which meets all documents; a benchmark of ordinary size is one block.
"""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brindle.llm.batches import Rows, each_batch, hold, map_batches, strings

#: Bytes of benchmark text in one broadcast, tokens kept per worker, pairs of places looked at together.
BLOCK_BYTES, CACHE, PAIRS = 16 << 20, 100_000, 1 << 20
_BASE = np.uint64(0x9E3779B97F4A7C15)


def normalize(chunk: str) -> str:
    """A white-space separated chunk as a token: lower case, letters and digits only."""
    return "".join(c for c in chunk.lower() if c.isalnum())


def tokens(text: str) -> list[str]:
    return [t for t in map(normalize, text.split()) if t]


def _runs(doc: np.ndarray, item: np.ndarray, least: int, starts: np.ndarray) -> list[tuple[int, int, int]]:
    """Maximal runs of equal tokens (position in doc, position in item, length) of at least ``least``.

    A rolling hash finds the pairs of places that share a seed. Of the pairs of a diagonal only the first
    of each run is kept, and it is lengthened token by token, all runs at once.
    """
    hashes = _rolling(item, least)
    order = np.argsort(hashes, kind="stable")
    hashes = hashes[order]
    own = _rolling(doc, least, starts)
    low, high = np.searchsorted(hashes, own), np.searchsorted(hashes, own, "right")
    met = high > low
    starts, low, many = starts[met], low[met], (high - low)[met]
    parts, at = [], 0
    ends = np.cumsum(many)
    while at < len(starts):
        # A bounded number of pairs at a time.
        stop = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + PAIRS, "right")))
        each = many[at:stop]
        d = np.repeat(starts[at:stop], each)
        p = order[np.repeat(low[at:stop] - np.cumsum(each) + each, each) + np.arange(each.sum())]
        fresh = (d == 0) | (p == 0)
        fresh[~fresh] = doc[d[~fresh] - 1] != item[p[~fresh] - 1]
        parts.append((d[fresh], p[fresh]))
        at = stop
    if not parts:
        return []
    d, p = (np.concatenate(part) for part in zip(*parts))
    length = np.zeros(len(d), np.int64)
    room = np.minimum(len(doc) - d, len(item) - p)
    active = np.arange(len(d))
    n = 0
    while len(active):
        active = active[room[active] > n]
        active = active[doc[d[active] + n] == item[p[active] + n]]
        n += 1
        length[active] = n
    real = length >= least  # equal hashes of different seeds end here
    return list(zip(d[real].tolist(), p[real].tolist(), length[real].tolist()))


def tile_matches(doc: np.ndarray, item: np.ndarray, least: int, starts: np.ndarray | None = None) -> list[tuple[int, int, int]]:
    """Greedy tiles (position in doc, position in item, length) of at least ``least`` equal numbers.

    ``starts`` are the positions in ``doc`` at which a run can begin a seed, if they are known. Maximal runs lie
    in buckets by length. From the longest down, a run whose tokens are all free becomes a tile; one that
    tiles have cut is split into its free parts, which go to the buckets of their lengths. So nothing is searched twice.
    """
    least = max(1, min(least, len(item)))
    if len(doc) < least or not len(item):
        return []
    item, doc = np.ascontiguousarray(item, np.int64), np.ascontiguousarray(doc, np.int64)
    buckets: dict[int, list[tuple[int, int]]] = {}
    for d, p, n in _runs(doc, item, least, np.arange(len(doc) - least + 1) if starts is None else starts):
        buckets.setdefault(n, []).append((d, p))
    doc_free, item_free, left = np.ones(len(doc), bool), np.ones(len(item), bool), len(item)
    tiles = []
    for n in range(max(buckets, default=0), least - 1, -1):
        for d, p in sorted(buckets.pop(n, ())):
            free = doc_free[d:d + n] & item_free[p:p + n]
            if free.all():
                doc_free[d:d + n] = item_free[p:p + n] = False
                tiles.append((d, p, n))
                left -= n
            elif free.any():
                edges = np.flatnonzero(np.diff(free, prepend=False, append=False)).tolist()
                for a, b in zip(edges[::2], edges[1::2]):
                    if b - a >= least:
                        buckets.setdefault(b - a, []).append((d + a, p + a))
        if left < least:
            break
    return tiles


class Benchmark:
    """Items of one block as numbered tokens, with their seeds."""

    def __init__(self, items: list[tuple[int, str]], tile: int):
        self.tile = tile
        self.numbers: dict[str, int] = {}
        self.items: list[tuple[int, np.ndarray]] = []
        self.chunks = _Chunks(self.numbers)
        seeds: dict[int, dict[int, list[int]]] = {}
        for item, text in items:
            coded = np.array([self.numbers.setdefault(t, len(self.numbers) + 1) for t in tokens(text)], np.int64)
            if not len(coded):
                continue
            size = min(tile, len(coded))
            for value in set(_rolling(coded, size).tolist()):
                seeds.setdefault(size, {}).setdefault(value, []).append(len(self.items))
            self.items.append((item, coded))
        self.seeds = {size: (np.array(sorted(found), np.uint64), found) for size, found in seeds.items()}

    def matches(self, texts: list[str], least: float) -> list[list[tuple[int, float, list]]]:
        """For every text, the items covered by at least ``least``: (item, coverage, tiles)."""
        if len(self.chunks) > CACHE:
            self.chunks.clear()
        coded = []
        for text in texts:
            row = np.array(list(map(self.chunks.__getitem__, text.split())), np.int64)
            coded.append(row[row >= 0])
        bounds = np.cumsum([0, *map(len, coded)])
        joined = np.concatenate(coded) if coded else np.zeros(0, np.int64)
        found: dict[tuple[int, int], list[int]] = {}
        for size, (sorted_seeds, by_seed) in self.seeds.items():
            if len(joined) < size:
                continue
            known = np.concatenate([[0], np.cumsum(joined > 0)])
            starts = np.flatnonzero(known[size:] - known[:-size] == size)
            if not len(starts):
                continue
            values = _rolling(joined, size, starts)
            at = np.minimum(np.searchsorted(sorted_seeds, values), len(sorted_seeds) - 1)
            hit = sorted_seeds[at] == values
            for start, value in zip(starts[hit].tolist(), values[hit].tolist()):
                text = int(np.searchsorted(bounds, start, "right")) - 1
                if start + size <= bounds[text + 1]:
                    for item in by_seed[value]:
                        found.setdefault((text, item), []).append(start - int(bounds[text]))
        out: list[list[tuple[int, float, list]]] = [[] for _ in texts]
        for (text, item), starts in found.items():
            name, wanted = self.items[item]
            tiles = tile_matches(coded[text], wanted, self.tile, np.array(sorted(starts)))
            coverage = sum(n for *_, n in tiles) / len(wanted)
            if coverage >= least:
                out[text].append((name, coverage, tiles))
        return out


class _Chunks(dict):
    """Chunk of text -> token number: 0 for tokens no item has, -1 for chunks without a token."""

    def __init__(self, numbers: dict[str, int]):
        super().__init__()
        self.numbers = numbers

    def __missing__(self, chunk: str) -> int:
        token = normalize(chunk)
        number = self.numbers.get(token, 0) if token else -1
        if len(chunk) <= 64:
            self[chunk] = number
        return number


def _rolling(coded: np.ndarray, size: int, starts: np.ndarray | None = None) -> np.ndarray:
    """Polynomial hashes of the runs of ``size`` tokens, modulo 2**64."""
    if starts is None:
        starts = np.arange(len(coded) - size + 1)
    numbers = coded.astype(np.uint64)
    out = np.zeros(len(starts), np.uint64)
    for k in range(size):
        out = out * _BASE + numbers[starts + k]
    return out


_BLOCKS: dict[str, Benchmark] = {}


def _index(key: str, shared, tile: int) -> Benchmark:
    """The worker's index of a block. A module's function, so that all tasks share it."""
    hold("decontaminate", _BLOCKS.clear)
    if key not in _BLOCKS:
        _BLOCKS.clear()
        _BLOCKS[key] = Benchmark(shared.value, tile)
    return _BLOCKS[key]


def _blocks(benchmark: DataFrame, item_col: str, text_col: str, block_bytes: int):
    """A name and a broadcast for every block of the benchmark."""
    spark = benchmark.sparkSession
    items = benchmark.select(F.col(item_col).alias("item"), F.coalesce(text_col, F.lit("")).alias("text"))
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    count = -(-size // block_bytes) or 1
    while True:
        parted = items.withColumn("block", F.pmod(F.xxhash64("item", "text"), F.lit(count)))
        # Room for uneven blocks; an item larger than that is a block of its own.
        most = parted.groupBy("block").agg(F.sum(F.octet_length("text")).alias("n"), F.count("*").alias("c")).where(
            f"n > {2 * block_bytes} and c > 1").isEmpty()
        if most or count > 1 << 20:
            break
        count *= 2
    for block in range(count):
        rows = [(r.item, r.text) for r in parted.where(F.col("block") == block).orderBy("item", "text").collect()]
        yield uuid.uuid4().hex, spark.sparkContext.broadcast(rows)


def find_leaks(docs: DataFrame, benchmark: DataFrame, tile: int = 4, least: float = 0.5, id_col: str = "doc_id",
               text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text",
               block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(doc_id, item_id, coverage, tiles) for every document that covers ``least`` of an item.

    Tiles are (start in the document, start in the item, length) in tokens: white-space separated
    chunks, lower-cased, letters and digits only. Null and empty texts and items without tokens
    match nothing; very long and repetitive texts are compared whole; repeated documents and items give repeated rows; null ids stay null; ties
    between tiles go to the earlier place in the document; empty tables give no rows; other
    columns are ignored.
    """
    chosen = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    tiles = pa.list_(pa.struct([("doc_start", pa.int32()), ("item_start", pa.int32()), ("length", pa.int32())]))
    schema = pa.schema([("doc_id", pa.int64()), ("item_id", pa.int64()), ("coverage", pa.float64()), ("tiles", tiles)])
    out = None
    for key, shared in _blocks(benchmark, item_col, item_text_col, block_bytes):
        def work(batches, key=key, shared=shared):
            rows = Rows(schema)
            for batch in batches:
                ids, texts = batch.column("doc_id").to_pylist(), strings(batch, "text")
                for at in range(0, len(texts), 256):
                    for doc, hits in zip(ids[at:at + 256], _index(key, shared, tile).matches(texts[at:at + 256], least)):
                        for item, coverage, found in hits:
                            rows.add((doc, item, coverage, [
                                {"doc_start": d, "item_start": p, "length": n} for d, p, n in sorted(found)]))
                if rows.full():
                    yield rows.take()
            yield rows.take()
        part = map_batches(chosen, "doc_id long, item_id long, coverage double, "
                                   "tiles array<struct<doc_start:int,item_start:int,length:int>>", work)
        out = part if out is None else out.union(part)
    return out


def drop_leaks(docs: DataFrame, benchmark: DataFrame, tile: int = 4, least: float = 0.5, text_col: str = "text",
               item_col: str = "item_id", item_text_col: str = "text", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The rows that cover less than ``least`` of every item, whole and with all their columns."""
    for key, shared in _blocks(benchmark, item_col, item_text_col, block_bytes):
        def work(batch, key=key, shared=shared):
            texts, clean = strings(batch, text_col), []
            for at in range(0, len(texts), 256):
                clean += [not hits for hits in _index(key, shared, tile).matches(texts[at:at + 256], least)]
            return batch.filter(pa.array(clean, pa.bool_()))
        docs = each_batch(docs, docs.schema, work)
    return docs
