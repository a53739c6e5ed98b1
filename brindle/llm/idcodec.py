"""Token ids as compressed, checksummed blocks: adaptive context mixing and a range coder.

A block holds up to ``BLOCK`` ids and is coded on its own. Three predictors name an id each: the
one that last followed the two ids before (order 2), the one that last followed the id before
(order 1) and the most frequent one so far (order 0). The coded symbol says which of them is
right, or that none is. Its distribution mixes two adaptive ones, of the block and of the
confidence of both context predictors. Every such confidence has a weight of its own for the mix,
which follows the gradient of the code length. Predictors learn after each id, distributions and
weights after every ``_EVERY`` ids, earlier at first, from all ids since. The bit lengths of
literals, ids that no predictor names, are Huffman coded (DEFLATE) beside the coder's words; their
lower bits, which no model predicts, are stored as they are.

Blocks do not depend on each other, so a task codes up to ``LANES`` of them in step: every step
codes one id of every block by array operations, and rows of four 16-bit numbers are looked up as
one number. All literals of a block are read before its first step.

A coded block: magic, bits of the largest possible id, numbers of ids, documents and words, CRC-32
of the ids; for every document in it its id, its ids here and whether it begins here; the 16-bit
words: bytes of the literals' lengths, these, the coder's words and, from the back, the literals'
lower bits.
"""

from __future__ import annotations

import struct
import zlib
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from brindle.llm.batches import TEXT_BYTES, Rows, map_batches, partition_id, regroup
from brindle.llm.wordbpe import encoder

BLOCK, LANES = 4096, 2048
#: Texts encoded together, and their bytes.
TEXTS, SIZE = 2048, 2 * TEXT_BYTES
MAGIC, _HEAD = b"CMX4", struct.Struct("<4sIIIII")
_TABLE, _LITERAL = 1 << 11, 3
_BITS, _RATE, _LEAST = 14, 5, 64
_TOTAL = 1 << _BITS
# Ids between two updates of distributions and weights, which come earlier at first.
_EVERY = 64
# A row of four 16-bit numbers is one 64-bit number where it is looked up.
_ALL = 0x0001000100010001
# Weights of the mix: their bits, the bits that mix, the size and largest size of a step, the least share of either side.
_WEIGHT, _MIX, _STEP, _JUMP, _SHARE = 16, 6, 10, 1 << 12, 1 << 11
# Of ids' hashes the upper bits count; the second factor, squared, is 0, so that two ids are all that is left.
_HASH, _TWO, _SHIFT = np.int64(-0x61C8864680B583EB), np.int64(-0x7A143595 << 32), np.uint64(64 - 11)
_EVEN = np.array([k * _TOTAL // 4 for k in range(4)], np.int16).view(np.int64)[0]
# Of 1 << _PULL: the pull of one of k new ids where a distribution has seen u (at most _SEEN), which learns fast as long as it has
# seen little.
_PULL, _SEEN = 16, 64
_RATES = np.array([[max(((1 << _RATE * k) - ((1 << _RATE) - 1) ** k << _PULL) // ((1 << _RATE * k) * max(k, 1)),
                        min(k, 1) * (1 << _PULL) // (u + k + 2)) for k in range(_EVERY + 1)] for u in range(_SEEN + 1)])


def _sizes(rows: np.ndarray) -> np.ndarray:
    out = np.empty_like(rows)
    np.subtract(rows[:, 1:], rows[:, :-1], out=out[:, :-1])
    np.subtract(_TOTAL, rows[:, -1], out=out[:, -1])
    return out


def _pulled(rows: np.ndarray, seen: np.ndarray, many: np.ndarray, updates: np.ndarray) -> np.ndarray:
    """Cumulative distributions after so many new symbols of each kind."""
    place = np.arange(4) * _LEAST
    step = (place - rows) * many[:, None] + (np.cumsum(seen, axis=1) - seen) * (_TOTAL - 4 * _LEAST)
    return rows + (step * _RATES[updates, many][:, None] >> _PULL)


class _Model:
    """Predictors and distributions of many blocks, of at most ``steps`` ids each."""

    def __init__(self, lanes: int, id_bits: int, steps: int):
        self.entry_bits = id_bits + 2
        kind = np.int32 if (steps + 1).bit_length() + self.entry_bits < 32 else np.int64
        self.first = 16 * np.arange(lanes)
        # Of the orders 2 and 1: predicted id * 4 + confidence; of order 1 also, in the upper bits, the number of times that the
        # id of this place was seen.
        self.base = _TABLE * np.arange(2 * lanes).reshape(2, lanes)
        self.table = np.zeros(2 * lanes * _TABLE, kind)
        self.once, self.mask = kind(1 << self.entry_bits), kind((1 << self.entry_bits) - 1)
        self.last, self.top, self.top_seen = np.zeros((3, lanes), kind)
        self.general = np.full(lanes, _EVEN).view(np.int16)
        self.special = np.full(lanes * 16, _EVEN)
        self.updates, self.general_updates = np.zeros(lanes * 16, np.int64), np.zeros(lanes, np.int64)
        self.weight = np.full(lanes * 16, 1 << (_WEIGHT - 1), np.int64)  # of the special distribution
        # The mix of both; a row begins with 0, also the one behind the last.
        self.mixed = np.zeros(64 * lanes + 4, np.int16)
        self.hash = np.zeros((2, lanes), np.int64)  # of the last two ids and of the last
        self._mix()

    def _mix(self) -> None:
        general = np.repeat(self.general.view(np.int64), 16).view(np.int16)
        share = ((self.weight >> (_WEIGHT - _MIX)) * _ALL).view(np.int16)
        mixed = np.multiply(self.special.view(np.int16) - general, share, dtype=np.int32)
        mixed >>= _MIX
        np.add(mixed, general, out=self.mixed[:-4], casting="unsafe")

    def predict(self, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The ids that the orders 2 and 1 predict for the first n lanes, that of order 0, and the rows of ``mixed``
        for their symbols."""
        self.at = (self.hash[:, :n].view(np.uint64) >> _SHIFT).view(np.int64)
        self.at += self.base[:, :n]
        self.found = self.table.take(self.at)
        self.found[1] += self.once
        seen, top, top_seen = self.found[1] >> self.entry_bits, self.top[:n], self.top_seen[:n]
        better = seen > top_seen
        np.copyto(top, self.last[:n], where=better)
        np.copyto(top_seen, seen, where=better)
        self.entry = self.found & self.mask
        sure = self.entry & 3
        row = sure[0] << 2
        row |= sure[1]
        return self.entry >> 2, top, self.first[:n] + row

    def learn(self, ids: np.ndarray, wrong: np.ndarray) -> None:
        """The next ids, and where the orders 2 and 1 did not predict them."""
        n = len(ids)
        fresh = ids << 2
        entry = self.entry
        self.found -= entry
        entry += 1
        np.minimum(entry, fresh | 3, out=entry)
        np.copyto(entry, fresh, where=wrong)
        entry += self.found
        self.table[self.at] = entry
        self.last[:n] = ids
        two, one = self.hash[0, :n], self.hash[1, :n]
        np.multiply(ids, _HASH, out=one)
        two *= _TWO
        two += one

    def adapt(self, places: np.ndarray) -> None:
        """Distributions and weights after the symbols at these places of ``mixed``."""
        seen = np.bincount(places, minlength=len(self.mixed) - 4).reshape(-1, 4)
        many = seen[:, 0] + seen[:, 1] + seen[:, 2] + seen[:, 3]
        rows = many.nonzero()[0]
        own, many_own = seen[rows], many[rows]
        special = self.special[rows].view(np.int16).reshape(-1, 4).astype(np.int64)
        general = self.general.reshape(-1, 4).astype(np.int64)
        mixed = self.mixed[:-4].view(np.int64)[rows].view(np.int16).reshape(-1, 4).astype(np.int64)
        step = (_sizes(special) - _sizes(general[rows >> 4]) << _STEP) // _sizes(mixed)
        step = np.minimum(np.maximum(step, -_JUMP), _JUMP) * own
        step = step[:, 0] + step[:, 1] + step[:, 2] + step[:, 3] + self.weight[rows]
        self.weight[rows] = np.minimum(np.maximum(step, _SHARE), (1 << _WEIGHT) - _SHARE)
        self.special[rows] = _pulled(special, own, many_own, self.updates[rows]).astype(np.int16).view(np.int64).ravel()
        self.updates[rows] = np.minimum(self.updates[rows] + many_own, _SEEN)
        seen = sum(seen[k::16] for k in range(16))
        many = seen[:, 0] + seen[:, 1] + seen[:, 2] + seen[:, 3]
        self.general[:] = _pulled(general, seen, many, self.general_updates).ravel()
        self.general_updates = np.minimum(self.general_updates + many, _SEEN)
        self._mix()


def _spans(steps: int) -> list[tuple[int, int]]:
    """The steps between two updates."""
    edges = [0, *(t for k in range(_EVERY.bit_length()) if (t := 1 << k) < min(_EVERY, steps)), *range(_EVERY, steps, _EVERY)]
    return list(zip(edges, [*edges[1:], steps])) if steps else []


def _lengths(id_bits: int):
    """Bit lengths of arrays of ids."""
    if id_bits <= 20:
        return np.frexp(np.arange(1 << id_bits, dtype=np.float64))[1].astype(np.uint8).take
    return lambda ids: np.frexp(ids.astype(np.float64))[1].astype(np.uint8)


def _in_step(blocks: list) -> tuple[list[int], np.ndarray]:
    """Lanes by falling length, and how many are still running at each step."""
    order = sorted(range(len(blocks)), key=lambda i: -blocks[i])
    sizes = np.array([blocks[i] for i in order])
    steps = int(sizes[0]) if len(sizes) else 0
    return order, np.searchsorted(-sizes, -np.arange(steps), "left")


def _pack(values: np.ndarray, widths: np.ndarray, id_bits: int) -> np.ndarray:
    """Numbers of so many bits each, one behind the other, as 16-bit words."""
    ends = np.cumsum(widths)
    total, starts, parts = int(ends[-1]) if len(ends) else 0, ends - widths, 3 if id_bits > 17 else 2
    at = starts >> 4
    shifted = values << (16 * parts - (starts & 15) - widths)
    # Numbers do not overlap, so a word is the sum of their parts.
    words = sum(np.bincount(at + k, shifted >> 16 * (parts - 1 - k) & 0xFFFF, (total >> 4) + parts) for k in range(parts))
    return words[:-(-total // 16)].astype("<u2")


def _squeeze(ids: np.ndarray, lengths, id_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Words of the literals' bit lengths, behind their number of bytes, and of the lower bits."""
    bits = lengths(ids)
    squeezed = b""
    if len(ids):
        huffman = zlib.compressobj(1, zlib.DEFLATED, -9, 6, zlib.Z_HUFFMAN_ONLY)
        squeezed = huffman.compress(bits.tobytes()) + huffman.flush()
    widths = np.maximum(bits, 1).astype(np.int64) - 1
    data = struct.pack("<I", len(squeezed)) + squeezed + b"\0" * (len(squeezed) % 2)
    return np.frombuffer(data, "<u2"), _pack(ids.astype(np.int64) & ((1 << widths) - 1), widths, id_bits)


def _literals(coded: np.ndarray) -> tuple[np.ndarray, int]:
    """All literals of a block, and where the words of the coder begin."""
    data = coded.astype("<u2").tobytes()
    (size,) = struct.unpack_from("<I", data)
    try:
        bits = np.frombuffer(zlib.decompress(data[4:4 + size], -9) if size else b"", np.uint8)
    except zlib.error as broken:
        raise ValueError("a block of token ids is damaged") from broken
    widths = np.maximum(bits, np.uint8(1)).astype(np.int64) - 1
    ends = np.cumsum(widths)
    starts, words = ends - widths, (int(ends[-1]) >> 4) + 1 if len(ends) else 0
    rest = np.zeros(words + 2, np.int64)
    stored = coded[:-words - 1:-1]
    rest[:len(stored)] = stored
    window = ((rest[:-2] << 32) | (rest[1:-1] << 16) | rest[2:]).take(starts >> 4)
    window >>= 48 - (starts & 15) - widths
    window &= (1 << widths) - 1
    window += (bits > 0).astype(np.int64) << widths
    return window, 2 + (size + 1) // 2


def encode_blocks(blocks: list[np.ndarray], id_bits: int = 32) -> list[np.ndarray]:
    """The 16-bit words of every block of ids (below 2**id_bits): the bit lengths of literals, the words of the coder
    and, last one first, the lower bits of literals."""
    order, running = _in_step([len(b) for b in blocks])
    lanes = len(blocks)
    model, lengths = _Model(lanes, id_bits, len(running)), _lengths(id_bits)
    ids = np.zeros((len(running), lanes), model.top.dtype)
    for k, i in enumerate(order):
        ids[:len(blocks[i]), k] = blocks[i]
    low, span = np.zeros(lanes, np.int64), np.full(lanes, 1 << 48, np.int64)
    words = np.zeros((len(running) + 3, lanes), np.uint32)
    count = np.zeros(lanes, np.int64)
    literals = np.zeros(ids.shape, bool)
    places = np.zeros((_EVERY, lanes), np.int64)
    for begin, stop in _spans(len(running)):
        own = running[begin:stop].tolist()
        for t, n in enumerate(own, begin):
            new = ids[t, :n]
            guess, top, row = model.predict(n)
            wrong = guess != new
            symbols = (top != new).view(np.uint8)
            symbols += np.uint8(1)
            symbols *= wrong[1]
            symbols += np.uint8(1)
            symbols *= wrong[0]
            np.equal(symbols, _LITERAL, out=literals[t, :n])
            row <<= 2
            np.add(row, symbols, out=places[t - begin, :n])
            model.learn(new, wrong)
        coded = places[:stop - begin, :own[0]]
        start = model.mixed.take(coded).astype(np.int64)
        size = model.mixed.take(coded + 1) - start
        size += literals[begin:stop, :own[0]] * np.int64(_TOTAL)
        for t, n in enumerate(own):
            r = span[:n] >> _BITS
            low[:n] += start[t, :n] * r
            np.multiply(size[t, :n], r, out=span[:n])
            small = (span[:n] < 1 << 32).nonzero()[0]
            if len(small):
                x, place = low[small], count[small]
                words[place, small] = x >> 32
                count[small] = place + 1
                low[small] = (x & 0xFFFFFFFF) << 16
                span[small] <<= 16
        model.adapt(coded.ravel() if own[0] == own[-1] else np.concatenate([c[:n] for c, n in zip(coded, own)]))
    for k in (32, 16, 0):
        words[count, np.arange(lanes)] = ((low >> k) & 0xFFFF) + ((low >> 48) << 16 if k == 32 else 0)
        count += 1
    for t in range(int(count.max(initial=1)) - 1, 0, -1):  # carries
        words[t - 1] += words[t] >> 16
    out: list = [None] * lanes
    for k, i in enumerate(order):
        before, behind = _squeeze(blocks[i][literals[:len(blocks[i]), k]], lengths, id_bits)
        out[i] = np.concatenate([before, (words[:count[k], k] & 0xFFFF).astype("<u2"), behind[::-1]])
    return out


def decode_blocks(coded: list[np.ndarray], sizes: list[int], id_bits: int = 32) -> list[np.ndarray]:
    """The ids of every block, from its words and its number of ids."""
    order, running = _in_step(sizes)
    lanes = len(coded)
    model = _Model(lanes, id_bits, len(running))
    known = [_literals(coded[i]) for i in order]
    literals = np.concatenate([*(own.astype(model.top.dtype) for own, _ in known), np.zeros(1, model.top.dtype)])
    cursor = np.cumsum([0, *(len(own) for own, _ in known)])[:-1]
    flat = np.concatenate([*(part for i in order for part in (coded[i], np.zeros(3, "<u2"))), np.zeros(3, "<u2")])
    place = np.cumsum([0, *(len(coded[i]) + 3 for i in order)])[:-1] + np.array([at for _, at in known], np.int64)
    span = np.full(lanes, 1 << 48, np.int64)
    code = np.zeros(lanes, np.int64)
    for _ in range(3):
        code = (code << 16) | flat[place]
        place += 1
    ids = np.zeros((len(running), lanes), model.top.dtype)
    places = np.zeros((_EVERY, lanes), np.int64)
    for begin, stop in _spans(len(running)):
        own, rows = running[begin:stop].tolist(), model.mixed[:-4].view(np.int64)
        for t, n in enumerate(own, begin):
            guess, top, row = model.predict(n)
            r = span[:n] >> _BITS
            value = (code[:n].view(np.uint64) // r.view(np.uint64)).view(np.int64)
            np.minimum(value, _TOTAL - 1, out=value)
            value *= _ALL
            # How many of the row's numbers, the first of which is 0, are at most the value.
            symbols = np.bitwise_count((rows.take(row).view(np.int16) <= value.view(np.int16)).view(np.uint32))
            symbols -= np.uint8(1)
            literal = symbols == _LITERAL
            row <<= 2
            row += symbols
            places[t - begin, :n] = row
            start = model.mixed.take(row).astype(np.int64)
            row += 1
            size = model.mixed.take(row) + (literal * np.int64(_TOTAL))
            size -= start
            start *= r
            code[:n] -= start
            np.multiply(size, r, out=span[:n])
            small = (span[:n] < 1 << 32).nonzero()[0]
            if len(small):
                at = place[small]
                code[small] = (code[small] << 16) | flat.take(at, mode="clip")
                place[small] = at + 1
                span[small] <<= 16
            new, at = ids[t, :n], cursor[:n]
            literals.take(at, out=new, mode="clip")
            at += literal
            for symbol, known in enumerate((guess[0], guess[1], top)):
                np.copyto(new, known, where=symbols == symbol)
            model.learn(new, guess != new)
        done = places[:stop - begin, :own[0]]
        model.adapt(done.ravel() if own[0] == own[-1] else np.concatenate([c[:n] for c, n in zip(done, own)]))
    out: list = [None] * lanes
    for k, i in enumerate(order):
        out[i] = ids[:sizes[i], k].astype("<u4")
    return out


def _seal(ids: np.ndarray, words: np.ndarray, id_bits: int, docs: list[tuple[int | None, int, bool]]) -> bytes:
    names = np.array([d if d is not None else 0 for d, _, _ in docs], "<i8")
    marks = np.array([begins | (d is None) << 1 for d, _, begins in docs], "u1")
    return (_HEAD.pack(MAGIC, id_bits, len(ids), len(docs), len(words), crc32(ids.tobytes())) + names.tobytes()
            + np.array([n for _, n, _ in docs], "<u4").tobytes() + marks.tobytes() + words.tobytes())


def _unseal(data: bytes):
    magic, id_bits, n, docs, words, check = _HEAD.unpack_from(data)
    if magic != MAGIC:
        raise ValueError("not a block of token ids")
    at = _HEAD.size
    names = np.frombuffer(data, "<i8", docs, at)
    sizes = np.frombuffer(data, "<u4", docs, at + 8 * docs)
    marks = np.frombuffer(data, "u1", docs, at + 12 * docs)
    return n, check, names, sizes, marks, np.frombuffer(data, "<u2", words, at + 13 * docs), id_bits


def write_ids(docs: DataFrame, path: str, tokenizer: str, end_id: int = 1, id_col: str = "doc_id",
              text_col: str = "text") -> None:
    """Write the ids of all texts, in ascending order of doc_id, as coded blocks below ``path``.

    Ids are those of ``tokenizer`` (a tokenizers file) without special tokens, then ``end_id``. Rows of
    the files: shard (a range of doc_ids), block, first (ids before it in its shard), n_ids and
    data. A null or empty text is the single ``end_id``; null doc_ids come last; equal ids go by
    the hash of their texts; an empty table gives no blocks; other columns are ignored.
    """
    schema = pa.schema([("shard", pa.int64()), ("block", pa.int64()), ("first", pa.int64()), ("n_ids", pa.int64()),
                        ("data", pa.binary())])
    end = np.array([end_id], "<u4").tobytes()

    def work(batches):
        shard, number, first = partition_id(), 0, 0
        blocks: list[tuple[bytes, list]] = []
        held: list[bytes] = []
        inside: list[tuple] = []
        room = BLOCK
        out = Rows(schema)

        def flush():
            nonlocal number, first
            ids = [np.frombuffer(b, "<u4") for b, _ in blocks]
            bits = encoder(tokenizer).id_bits(end_id)
            for own, coded, (_, members) in zip(ids, encode_blocks(ids, bits), blocks):
                out.add((shard, number, first, len(own), _seal(own, coded, bits, members)))
                number, first = number + 1, first + len(own)
            blocks.clear()

        for batch in regroup(batches, TEXTS, SIZE):
            coded, borders = encoder(tokenizer).encode_batch(batch.column("text"), end)
            coded, ends = coded.tobytes(), (4 * borders).tolist()
            for doc, start, stop in zip(batch.column("doc_id").to_pylist(), ends, ends[1:]):
                place = start
                while place < stop:
                    part = coded[place:min(stop, place + 4 * room)]
                    held.append(part)
                    inside.append((doc, len(part) // 4, place == start))
                    place += len(part)
                    room -= len(part) // 4
                    if not room:
                        blocks.append((b"".join(held), inside))
                        held, inside, room = [], [], BLOCK
                        if len(blocks) == LANES:
                            flush()
                            yield out.take()
        if held:
            blocks.append((b"".join(held), inside))
        if blocks:
            flush()
        yield out.take()

    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = F.col("doc_id").asc_nulls_last()
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    ordered = texts.repartitionByRange(parts, order).sortWithinPartitions(order, F.xxhash64("text"))
    map_batches(ordered, "shard long, block long, first long, n_ids long, data binary", work,
                caches="wordbpe").write.parquet(path)


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start (ids of all documents before it) and ids (little-endian unsigned 32-bit integers)
    of every document below ``path``. A block whose checksum fails stops the job."""
    files = spark.read.parquet(path)
    shards = files.groupBy("shard").agg(F.sum("n_ids").alias("n")).orderBy("shard").collect()
    bases, total = [], 0
    for row in shards:  # one row for every task that wrote
        bases.append((row["shard"], total))
        total += row["n"]
    base = spark.createDataFrame(bases, "shard long, base long")
    schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("ids", pa.binary())])

    def decoded(rows):
        opened = [_unseal(data) for *_, data in rows]
        found = decode_blocks([o[5] for o in opened], [o[0] for o in opened], opened[0][6])
        for (shard, start, _), (_, check, names, sizes, marks, _, _), ids in zip(rows, opened, found):
            if crc32(ids.tobytes()) != check:
                raise ValueError(f"a block of shard {shard} is damaged")
            yield shard, start, ids, zip(names.tolist(), sizes.tolist(), marks.tolist())

    def work(batches):
        out, rows, doc = Rows(schema), [], None

        def take():
            nonlocal doc
            for _, start, ids, members in decoded(rows):
                at = 0
                for name, size, mark in members:
                    if mark & 1:
                        if doc:
                            out.add((doc[0], doc[1], b"".join(doc[2])), sum(map(len, doc[2])))
                        doc = (None if mark & 2 else name, start + at, [])
                    doc[2].append(ids[at:at + size].tobytes())
                    at += size
                if out.full():
                    yield out.take()
            rows.clear()

        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in ("shard", "start", "data"))):
                rows.append(row)
                if len(rows) == LANES:
                    yield from take()
        if rows:
            yield from take()
        if doc:
            out.add((doc[0], doc[1], b"".join(doc[2])))
        yield out.take()

    ordered = files.join(F.broadcast(base), "shard").select(
        "shard", "block", (F.col("base") + F.col("first")).alias("start"), "data").repartition(
        max(1, len(bases)), "shard").sortWithinPartitions("shard", "block").select("shard", "start", "data")
    return map_batches(ordered, "doc_id long, start long, ids binary", work)
