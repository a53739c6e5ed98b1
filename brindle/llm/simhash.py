"""SimHash near-duplicates through pivot distance tables.

A fingerprint is one or more 64-bit words; two fingerprints link if they differ in at most
``max_bits`` bits. Every distinct fingerprint gets a table of its Hamming distances to
``PIVOTS`` reference fingerprints. By the triangle inequality two fingerprints differ in at
least as many bits as any coordinate of their tables does, so inside a bucket rows are sorted
by the first coordinate, a row meets only those within ``max_bits`` of it there, pairs with a
larger difference in any other coordinate are discarded, and only survivors are
compared bit by bit. Distances to far references concentrate, so the tables alone would leave
nearly every pair of a large corpus; buckets come from bit masks instead: all choices of three
of ``max_bits + 3`` blocks (complete: that many differing bits leave three blocks untouched)
or, where ``max_bits`` is too large for that, samples of bits.

A bucket gives the links of a spanning forest of its survivors, never all pairs. Buckets of
over ``BUCKET`` rows are handed on as chunks in order of the first coordinate and every two
chunks that can hold links are compared in a task of their own.
"""

from __future__ import annotations

from functools import reduce
from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brindle.llm.batches import column, each_batch, map_batches, record_batch, strings
from brindle.llm.components import connected_components
from brindle.session import as_table

#: Reference fingerprints, and rows that are compared within one bucket task.
PIVOTS, BUCKET = 16, 4096
_ALL = (1 << 64) - 1


def _mix(x: int) -> int:
    """A well spread 64-bit word for a small number."""
    return xxhash.xxh64_intdigest(x.to_bytes(8, "little"), 7)


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def shingle_hashes(text: str, words: int) -> np.ndarray:
    """XXH64 (seed 42) of all word shingles, repeats included; see ``fingerprints``."""
    tokens = text.encode("utf-8", "surrogatepass").lower().split()
    if not tokens:
        return np.zeros(0, np.uint64)
    joined = b" ".join(tokens)
    if len(tokens) <= words:
        return np.array([xxhash.xxh64_intdigest(joined, 42)], np.uint64)
    sizes = np.fromiter(map(len, tokens), np.int64, len(tokens))
    ends = np.cumsum(sizes + 1) - 1
    starts = ends - sizes
    n = len(tokens) - words + 1
    cut = map(memoryview(joined).__getitem__, map(slice, starts[:n].tolist(), ends[words - 1:].tolist()))
    return np.fromiter(map(xxhash.xxh64_intdigest, cut, repeat(42)), np.uint64, n)


def majority(hashes: np.ndarray, parts: int) -> list[int]:
    """Words whose bits are set in over half of the hashes; later words use remixed hashes."""
    out = []
    for part in range(parts):
        h = hashes
        if part:
            h = (hashes + np.uint64(_mix(part))) * np.uint64(0x9E3779B97F4A7C15)
            h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
            h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
            h = h ^ (h >> np.uint64(31))
        counts = np.zeros(64, np.int64)
        for at in range(0, len(h), 1 << 16):
            bits = np.unpackbits(np.ascontiguousarray(h[at:at + (1 << 16)]).view(np.uint8).reshape(-1, 8),
                                 axis=1, bitorder="little")
            counts += bits.sum(axis=0, dtype=np.int64)
        out.append(int(np.packbits(2 * counts > len(h), bitorder="little").view(np.uint64)[0]))
    return out


def fingerprints(docs: DataFrame, shingle: int = 4, parts: int = 1, id_col: str = "doc_id",
                 text_col: str = "text", distinct: bool = False) -> DataFrame:
    """doc_id, digest (xxhash64 of the text), fingerprint (16 hex digits a word) and its words w0, w1, ...

    Texts are lower-cased in A-Z and cut at ASCII white space; shingles of ``shingle`` words are
    joined by a space, repeats included unless ``distinct``; fewer words are one shingle; none give zero.
    """
    schema = pa.schema([("doc_id", pa.int64()), ("digest", pa.int64())] + [(f"w{k}", pa.int64()) for k in range(parts)])

    def work(batch):
        hashes = (shingle_hashes(t, shingle) for t in strings(batch, "text"))
        found = [majority(np.unique(h) if distinct else h, parts) for h in hashes]
        words = np.array(found, np.uint64).reshape(-1, parts).view(np.int64)
        return record_batch(schema, batch.column("doc_id"), batch.column("digest"), *(np.ascontiguousarray(w) for w in words.T))

    names = [f"w{k}" for k in range(parts)]
    out = each_batch(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"),
                                 F.xxhash64(text_col).alias("digest")),
                     ", ".join(f"{n} long" for n in ["doc_id", "digest", *names]), work)
    return out.withColumn("fingerprint", F.lower(F.concat(*(F.lpad(F.hex(n), 16, "0") for n in names))))


def exact_masks(max_bits: int) -> list[list[int]]:
    """Masks over 64 bits of which one leaves out every set of ``max_bits`` bits."""
    blocks = max_bits + 3
    edges = [64 * k // blocks for k in range(blocks + 1)]
    part = [((1 << b) - 1) ^ ((1 << a) - 1) for a, b in zip(edges, edges[1:])]
    return [[sum(part[k] for k in chosen)] for chosen in combinations(range(blocks), 3)]


def sampled_masks(parts: int, tables: int, bits: int) -> list[list[int]]:
    """``tables`` masks of ``bits`` bits each, spread over all words by a fixed rule."""
    masks = []
    for table in range(tables):
        order = sorted(range(64 * parts), key=lambda bit: _mix((table << 16) + bit + 1))[:bits]
        masks.append([sum(1 << (b - 64 * p) for b in order if b // 64 == p) for p in range(parts)])
    return masks


def _pivot_tables(parts: int) -> list:
    """Two columns with eight distances of eight bits each."""
    out = []
    for half in range(2):
        distances = [reduce(lambda a, b: a + b, [
            F.bit_count(F.col(f"w{p}").bitwiseXOR(F.lit(_signed(_mix(1000 + 16 * p + 8 * half + k)))))
            for p in range(parts)]).cast("long") for k in range(PIVOTS // 2)]
        out.append(reduce(lambda a, b: a.bitwiseOR(b),
                          [F.shiftleft(d, 8 * k) for k, d in enumerate(distances)]).alias(f"t{half}"))
    return out


def _survivors(key, first, tables, words, max_bits):
    """Index pairs of rows with equal key that differ in at most ``max_bits`` bits, and the bits.
    Rows are sorted by (key, first coordinate)."""
    alive, shift, found = np.arange(len(key)), 0, []
    while True:
        shift += 1
        alive = alive[alive + shift < len(key)]
        there = alive + shift
        alive = alive[(key[there] == key[alive]) & (first[there] - first[alive] <= max_bits)]
        if not len(alive):
            break
        for at in range(0, len(alive), 1 << 15):
            i = alive[at:at + (1 << 15)]
            j = i + shift
            near = (np.abs(tables[i] - tables[j]) <= max_bits).all(axis=1)
            i, j = i[near], j[near]
            differ = np.bitwise_count(words[i] ^ words[j]).sum(axis=1, dtype=np.int64)
            linked = differ <= max_bits
            if linked.any():
                found.append((i[linked], j[linked], differ[linked]))
    if not found:
        return np.zeros((3, 0), np.int64)
    return np.concatenate([np.stack(f) for f in found], axis=1)


def _forest(n: int, pairs: np.ndarray) -> np.ndarray:
    """A spanning forest of the pairs that prefers few differing bits."""
    i, j, differ = pairs[:, np.lexsort((pairs[1], pairs[0], pairs[2]))]
    parent, kept = np.arange(n), []
    while len(i):
        for a, b in zip(i[:512].tolist(), j[:512].tolist()):
            x, y = a, b
            while parent[x] != x:
                x = parent[x]
            while parent[y] != y:
                y = parent[y]
            if x != y:
                parent[max(x, y)] = min(x, y)
                kept.append((a, b))
        while True:
            up = parent[parent]
            if (up == parent).all():
                break
            parent = up
        apart = parent[i] != parent[j]
        i, j = i[apart], j[apart]
    return np.array(kept, np.int64).reshape(-1, 2)


def _compare(rows: DataFrame, parts: int, max_bits: int, limit: int) -> DataFrame:
    """Links of rows(key, t0, t1, w...) that share a key and lie together in sorted tasks.

    Rows of a key with over ``limit`` rows come back as chunks (chunk, and the row's own columns).
    """
    names = [f"w{k}" for k in range(parts)]
    columns = [*names, *(f"v{k}" for k in range(parts)), "key", "chunk", "t0", "t1"]
    schema = pa.schema([(c, pa.int64()) for c in columns])

    def links(data):
        key, t, words = data[0], data[1:3], data[3:]
        tables = np.ascontiguousarray(t.T).view(np.uint8).astype(np.int16)
        codes = np.ascontiguousarray(words.T).view(np.uint64)
        pairs = _survivors(key, tables[:, 0], tables, codes, max_bits)
        if not pairs.shape[1]:
            return None
        i, j = _forest(len(key), pairs).T
        none = pa.nulls(len(i), pa.int64())
        return record_batch(schema, *words[:, i], *words[:, j], none, none, none, none)

    def chunk(data, number):
        n = data.shape[1]
        none = pa.nulls(n, pa.int64())
        return record_batch(schema, *data[3:], *([none] * parts), data[0],
                            np.full(n, number), data[1], data[2])

    def work(batches):
        held, over, number = np.zeros((3 + parts, 0), np.int64), None, 0
        for batch in batches:
            new = np.stack([column(batch, c) for c in ["key", "t0", "t1", *names]])
            held = np.concatenate([held, new], axis=1)
            if over is not None:  # the rest of a large bucket
                end = int(np.searchsorted(held[0] != over, True)) if (held[0] != over).any() else held.shape[1]
                mine, held = held[:, :end], held[:, end:]
                for at in range(0, mine.shape[1], limit // 2):
                    yield chunk(mine[:, at:at + limit // 2], number)
                    number += 1
                if not held.shape[1]:
                    continue
                over = None
            if not held.shape[1]:
                continue
            start = int(np.argmax(held[0] == held[0, -1]))
            # Whole buckets, of which a large one may stand anywhere.
            ready, held = held[:, :start], held[:, start:]
            edges = np.concatenate([[0], np.flatnonzero(np.diff(ready[0])) + 1, [ready.shape[1]]])
            large = [k for k in np.flatnonzero(np.diff(edges) > limit)] if ready.shape[1] else []
            for k in large:
                mine = ready[:, edges[k]:edges[k + 1]]
                for number, at in enumerate(range(0, mine.shape[1], limit // 2)):
                    yield chunk(mine[:, at:at + limit // 2], number)
            if large:
                drop = np.zeros(ready.shape[1], bool)
                for k in large:
                    drop[edges[k]:edges[k + 1]] = True
                ready = ready[:, ~drop]
            found = links(ready) if ready.shape[1] > 1 else None
            if found is not None:
                yield found
            if held.shape[1] > limit:
                over, number = held[0, 0], 0
                for at in range(0, held.shape[1], limit // 2):
                    yield chunk(held[:, at:at + limit // 2], number)
                    number += 1
                held = held[:, :0]
        found = links(held) if held.shape[1] > 1 else None
        if found is not None:
            yield found

    ordered = (rows.select("key", "t0", "t1", *names).repartition("key")
               .sortWithinPartitions("key", F.col("t0").bitwiseAND(F.lit(255))))
    return map_batches(ordered, ", ".join(f"{c} long" for c in columns), work, rows=None)


def links(codes: DataFrame, masks: list[list[int]], max_bits: int, parts: int, bucket: int = BUCKET) -> DataFrame:
    """Links (w0.., v0..) between distinct fingerprints: a spanning forest of each bucket."""
    names = [f"w{k}" for k in range(parts)]
    keys = [F.xxhash64(F.lit(t), *(F.col(n).bitwiseAND(F.lit(_signed(m))) for n, m in zip(names, mask)))
            for t, mask in enumerate(masks)]
    tabled = codes.select(*names, *_pivot_tables(parts))
    found = as_table(_compare(tabled.select(F.explode(F.array(*keys)).alias("key"), "t0", "t1", *names),
                              parts, max_bits, bucket), "buckets")
    pairs = found.where("chunk is null")
    rest = found.where("chunk is not null")
    if not rest.isEmpty():
        first = F.col("t0").bitwiseAND(F.lit(255))
        ranges = rest.groupBy("key", "chunk").agg(F.min(first).alias("low"), F.max(first).alias("high"))
        left = ranges.select("key", F.col("chunk").alias("c"), F.col("high"))
        right = ranges.select("key", F.col("chunk").alias("d"), F.col("low"))
        tasks = left.join(right, "key").where(f"c <= d and low - high <= {max_bits}").select(
            "key", F.explode(F.array_distinct(F.array("c", "d"))).alias("chunk"),
            F.xxhash64("key", "c", "d").alias("task"))
        spread = rest.join(tasks, ["key", "chunk"]).select(F.col("task").alias("key"), "t0", "t1", *names)
        # A task holds two chunks of half a bucket each, and more only if keys collide.
        pairs = pairs.union(_compare(spread, parts, max_bits, 1 << 40))
    return pairs.select(*names, *(f"v{k}" for k in range(parts)))


def _hex(prefix: str, parts: int):
    return F.lower(F.concat(*(F.lpad(F.hex(f"{prefix}{k}"), 16, "0") for k in range(parts))))


def near_components(docs: DataFrame, shingle: int = 5, parts: int = 2, max_bits: int = 30,
                    masks: list[list[int]] | None = None, min_jaccard: float | None = 0.8,
                    bucket: int = BUCKET, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, fingerprint, component_id, group, digest for every row.

    A component is named by its smallest doc_id; ``group`` is its smallest fingerprint (with ``min_jaccard``
    its smallest digest), ``digest`` the xxhash64 of the text.

    ``min_jaccard`` takes fingerprints of distinct shingles and adds an exact check: texts are linked, also those
    of one fingerprint, only if their sets of shingles are at least that similar. A null text counts as empty (fingerprint zero,
    linked like any other). Repeated rows give repeated results. Null doc_ids stay null and count
    for a component's name only if it has no other. An empty table gives no rows; other
    columns are ignored.
    """
    masks = masks or (exact_masks(max_bits) if parts == 1 else sampled_masks(parts, 64, 16))
    names = [f"w{k}" for k in range(parts)]
    exact = min_jaccard is not None
    marked = as_table(fingerprints(docs, shingle, parts, id_col, text_col, distinct=exact), "fingerprints")
    node = F.col("digest" if exact else "fingerprint").alias("node")
    nodes = as_table(marked.groupBy(node, "fingerprint", *names).agg(F.min("doc_id").alias("first")), "nodes")
    codes = nodes.select("fingerprint", *names).distinct() if exact else nodes
    found = links(codes, masks, max_bits, parts, bucket).select(
        _hex("w", parts).alias("a"), _hex("v", parts).alias("b")).select(
        F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    if exact:
        found = _similar(docs, nodes.select("fingerprint", "node"), as_table(found, "pairs"), shingle, min_jaccard, text_col)
    roots = connected_components(found).withColumnRenamed("node", "n")
    named = nodes.join(roots, F.col("node") == F.col("n"))
    smallest = named.groupBy("root").agg(F.min("first").alias("least")).withColumnRenamed("root", "r")
    linked = named.join(smallest, F.col("root") == F.col("r")).select(F.col("node").alias("f"), "root", "least")
    labels = nodes.join(linked, F.col("node") == F.col("f"), "left").select(
        F.col("node").alias("g"), F.when(F.col("root").isNull(), F.col("first")).otherwise(F.col("least"))
        .alias("component_id"), F.coalesce("root", "node").alias("group"))
    return marked.join(labels, F.col("digest" if exact else "fingerprint") == F.col("g")).select(
        "doc_id", "fingerprint", "component_id", "group", "digest")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **settings) -> DataFrame:
    """One row of every near-duplicate component, whole and with all its columns.

    The row with the smallest doc_id stays (null ids are greatest, equal ids go by the hash of their
    texts, of repeated rows one stays). ``settings`` are those of ``near_components``.
    """
    found = near_components(docs, id_col=id_col, text_col=text_col, **settings)
    kept = found.groupBy("group").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "digest")).alias("k"))
    names = ["_no_id", "_id", "_digest"]
    while set(names) & set(docs.columns):
        names = [f"{n}_" for n in names]

    def key(identity, digest):
        return [c.alias(n) for c, n in zip((identity.isNull(), F.coalesce(identity, F.lit(0)), digest), names)]

    kept = kept.select(*key(F.col("k.doc_id"), F.col("k.digest")))
    marked = docs.select("*", *key(F.col(id_col).cast("long"), F.xxhash64(text_col)))
    return marked.join(kept, names, "left_semi").dropDuplicates(names).select(*docs.columns)


def _similar(docs: DataFrame, nodes: DataFrame, pairs: DataFrame, shingle: int, least: float, text_col: str) -> DataFrame:
    """Links (a, b) between texts (by digest) whose shingle sets have a Jaccard index of at least ``least``.

    ``nodes`` are (fingerprint, node), node being a digest; ``pairs`` (a, b) of fingerprints. Every
    text is compared with the smallest digest of its fingerprint, and these with each other along the
    pairs. Texts unlike it are compared with all others of their fingerprint and of its
    neighbours; so are all texts of two fingerprints whose smallest digests are unlike.
    """
    heads = as_table(nodes.groupBy("fingerprint").agg(F.min("node").alias("head"), F.count("*").alias("many")), "heads")
    inner = nodes.join(heads.where("many > 1"), "fingerprint").where("node <> head").select(
        F.col("head").alias("a"), F.col("node").alias("b"), "fingerprint")
    x = heads.select(F.col("fingerprint").alias("a"), F.col("head").alias("x"), F.col("many").alias("m"))
    y = heads.select(F.col("fingerprint").alias("b"), F.col("head").alias("y"), F.col("many").alias("n"))
    across = as_table(pairs.join(x, "a").join(y, "b"), "across")
    first = inner.select("a", "b").union(across.select("x", "y"))
    texts = docs.select(F.xxhash64(text_col).alias("digest"), F.col(text_col).alias("text"))
    checked = as_table(_compare_texts(texts, first, shingle, least), "checked")
    good = checked.where("near").select("a", "b")
    if heads.where("many > 1").isEmpty():
        return good
    bad = checked.where("not near").select("a", "b")
    lone = as_table(inner.join(bad, ["a", "b"]).select("fingerprint", F.col("b").alias("node")), "lone")
    members = nodes.join(lone.select("node", F.lit(True).alias("lone")), "node", "left").select(
        "fingerprint", "node", F.coalesce("lone", F.lit(False)).alias("lone"))
    same = lone.join(members.select("fingerprint", F.col("node").alias("other")), "fingerprint").select(
        F.least("node", "other").alias("a"), F.greatest("node", "other").alias("b")).where("a <> b")
    unlike = across.where("m > 1 or n > 1").join(
        bad.select(F.col("a").alias("x"), F.col("b").alias("y"), F.lit(True).alias("unlike")), ["x", "y"], "left")
    one = members.select(F.col("fingerprint").alias("a"), F.col("node").alias("c"), F.col("lone").alias("c_lone"))
    two = members.select(F.col("fingerprint").alias("b"), F.col("node").alias("d"), F.col("lone").alias("d_lone"))
    other = unlike.join(one, "a").join(two, "b").where("unlike or c_lone or d_lone").select("c", "d")
    more = as_table(same.union(other).distinct().join(first, ["a", "b"], "left_anti"), "more")
    if more.isEmpty():
        return good
    return good.union(_compare_texts(texts, more, shingle, least).where("near").select("a", "b"))


def _compare_texts(texts: DataFrame, pairs: DataFrame, shingle: int, least: float) -> DataFrame:
    """(a, b, near) for pairs (a, b) of digests of ``texts``."""
    pairs = as_table(pairs, "digests")
    needed = pairs.select(F.explode(F.array("a", "b")).alias("digest")).distinct()
    texts = as_table(texts.join(needed, "digest", "left_semi").dropDuplicates(["digest"]), "texts")
    left = texts.select(F.col("digest").alias("a"), F.col("text").alias("x"))
    right = texts.select(F.col("digest").alias("b"), F.col("text").alias("y"))
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("near", pa.bool_())])

    def work(batch):
        near, last, mine = [], None, None
        for x, y in zip(strings(batch, "x"), strings(batch, "y")):
            if last is None or x != last:
                last, mine = x, np.unique(shingle_hashes(x, shingle))
            other = np.unique(shingle_hashes(y, shingle))
            both = len(np.intersect1d(mine, other, assume_unique=True))
            union = len(mine) + len(other) - both
            near.append(not union or both >= least * union)
        return record_batch(schema, batch.column("a"), batch.column("b"), near)

    return each_batch(pairs.join(left, "a").join(right, "b"), "a long, b long, near boolean", work)
