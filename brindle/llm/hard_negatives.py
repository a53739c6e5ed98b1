"""Hard negatives by the threshold algorithm: for anchor rows, near rows of other labels in a window of scores.

Candidates lie in blocks of rows. A block keeps, for every dimension, its rows sorted by that component. For
an anchor, the sorted lists are read from the end that its component's sign favours; every row met is
looked up whole and scored exactly. The components at the present depth bound the score of any row not met yet:
once this threshold falls strictly below the k-th score of every window, the rest of the block is out. k-th scores
are carried from block to block of a task, so later blocks often stop at once. The bound never removes a
row that belongs to the result, equal scores included; with vectors of no structure the lists are
read to their ends, which is then a plain scan.

Anchors are dealt into blocks too. Each wave of anchor blocks, of a bounded size, is broadcast and meets all
candidate blocks; each task hands on at most k rows a window, and those are merged by the same order.
"""

from __future__ import annotations

import contextlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brindle.llm.batches import Rows, column, map_batches
from brindle.operators.windows import top_per_group
from brindle.session import as_table

#: Rows of a candidate block, anchors of an anchor block, anchor blocks of a wave (16 MB at 64 dimensions), pairs of
#: blocks that Spark hands over at once, anchors that are scored together.
BLOCK, ANCHORS, WAVE, AT_ONCE, TOGETHER = 4096, 512, 64, 8, 128
#: Largest sum that double precision holds exactly.
EXACT = 1 << 53
_LONG = (1 << 63) - 1


class Block:
    """Candidates with their sorted lists. ``vectors`` has a row for each candidate."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray):
        self.ids, self.labels, self.vectors = ids, labels, vectors
        self.order = np.argsort(vectors, axis=0, kind="stable")  # of each dimension, ascending
        self.sorted = np.take_along_axis(vectors, self.order, axis=0)

    def threshold(self, anchors: np.ndarray, depth: int) -> np.ndarray:
        """What a row can score at most if it is at ``depth`` or deeper in every list, read as the signs say."""
        return np.maximum(anchors, 0) @ self.sorted[-1 - depth] + np.minimum(anchors, 0) @ self.sorted[depth]

    def accessed(self, anchor: np.ndarray, start: int, end: int) -> np.ndarray:
        """Rows at depths ``start`` to ``end`` of the anchor's lists, in any number."""
        size = len(self.ids)
        high, low = np.flatnonzero(anchor > 0), np.flatnonzero(anchor < 0)
        return np.concatenate([self.order[size - end:size - start, high].ravel(), self.order[start:end, low].ravel()])


class Best:
    """The k best (score, id) of every window of the anchors of a block, by descending score, then ascending id."""

    def __init__(self, anchors: int, windows: int, k: int, dtype):
        self.k = k
        self.scores = np.full((anchors, windows, k), -np.inf, dtype)
        self.ids = np.zeros((anchors, windows, k), np.int64)
        self.found = np.zeros((anchors, windows), np.int64)

    def worst(self) -> np.ndarray:
        """The k-th score of every window, minus infinity where there are fewer."""
        return self.scores[:, :, -1]

    def add(self, anchor: int, window: int, scores: np.ndarray, ids: np.ndarray) -> None:
        many = self.found[anchor, window]
        scores = np.concatenate([self.scores[anchor, window, :many], scores])
        ids = np.concatenate([self.ids[anchor, window, :many], ids])
        chosen = np.lexsort((ids, -scores))[:self.k]
        self.found[anchor, window] = len(chosen)
        self.scores[anchor, window, :len(chosen)] = scores[chosen]
        self.ids[anchor, window, :len(chosen)] = ids[chosen]


def search(block: Block, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray, low: np.ndarray, high: np.ndarray,
           same_label: bool, best: Best) -> int:
    """Add the block's rows to the windows [low, high] (anchors x windows) of the anchors; returns rows scored.

    Rows with the anchor's id are left out, and so are those of the other kind of label.
    """
    size, dims = block.vectors.shape
    scored = 0

    def take(active: np.ndarray, scores: np.ndarray, rows: np.ndarray | None, fresh: np.ndarray | None) -> None:
        own_ids = block.ids if rows is None else block.ids[rows]
        own_labels = block.labels if rows is None else block.labels[rows]
        fit = (own_labels[None] == labels[active, None]) == same_label
        fit &= own_ids[None] != ids[active, None]
        if fresh is not None:
            fit &= fresh
        for window in range(low.shape[1]):
            floor = np.maximum(low[active, window], best.worst()[active, window])
            hits = fit & (scores >= floor[:, None]) & (scores <= high[active, window][:, None])
            for at in np.flatnonzero(hits.any(axis=1)):
                chosen = np.flatnonzero(hits[at])
                best.add(active[at], window, scores[at, chosen], own_ids[chosen])

    def open_anchors(active: np.ndarray, depth: int) -> np.ndarray:
        """Those for which a row at ``depth`` could still enter some window."""
        top = block.threshold(vectors[active], depth)[:, None]
        worst = best.worst()[active]
        return active[((top >= low[active]) & (top >= worst) & (low[active] <= high[active])).any(axis=1)]

    for first in range(0, len(ids), TOGETHER):
        active = open_anchors(np.arange(first, min(first + TOGETHER, len(ids))), 0)
        seen = np.zeros((len(ids[first:first + TOGETHER]), size), bool)
        depth, step = 0, max(1, size // (8 * max(1, dims)))
        while len(active) and depth < size:
            end = min(size, depth + step)
            if end * dims >= 2 * size:
                break  # nearly all rows are met at this depth
            for anchor in active:
                rows = block.accessed(vectors[anchor], depth, end)
                mark = seen[anchor - first]
                rows = np.unique(rows[~mark[rows]])
                mark[rows] = True
                scored += len(rows)
                take(np.array([anchor]), vectors[anchor][None] @ block.vectors[rows].T, rows, None)
            depth, step = end, 4 * step
            if depth < size:
                active = open_anchors(active, depth)
        if len(active) and depth < size:
            left = ~seen[active - first]
            scored += int(left.sum())
            take(active, vectors[active] @ block.vectors.T, None, left)
    return scored


@contextlib.contextmanager
def _few_rows(spark, rows: int):
    """Hand over few rows at once: each of them is a pair of blocks."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, rows)
    try:
        yield
    finally:
        spark.conf.set(key, before)


def _as_blocks(rows: DataFrame, dims: int) -> DataFrame:
    """Rows (id, label, q) in blocks of at most ``BLOCK``, from where they lie, without a shuffle."""
    schema = pa.schema([("ids", pa.binary()), ("labels", pa.binary()), ("q", pa.binary())])

    def pack(batches):
        kept, many = [], 0

        def emit():
            return pa.RecordBatch.from_arrays(
                [pa.array([b"".join(part)], pa.binary()) for part in zip(*kept)], schema=schema)
        for batch in batches:
            q = batch.column("q").flatten().to_numpy().reshape(batch.num_rows, dims)
            ids, labels, at = column(batch, "id"), column(batch, "label"), 0
            while at < batch.num_rows:
                end = min(batch.num_rows, at + BLOCK - many)
                kept.append((ids[at:end].tobytes(), labels[at:end].tobytes(), q[at:end].tobytes()))
                many, at = many + end - at, end
                if many == BLOCK:
                    yield emit()
                    kept, many = [], 0
        if kept:
            yield emit()

    return map_batches(rows.select("id", "label", "q"), "ids binary, labels binary, q binary", pack)


def _meet(candidates: DataFrame, anchors: DataFrame, dims: int, exact: bool, k: int, windows: int, same_label: bool) -> DataFrame:
    """The k best candidates of every window of every anchor: (anchor, window, id, score).

    ``anchors`` has anchor, id, label, q and, per window, low and high.
    """
    spark = candidates.sparkSession
    many = anchors.count()
    blocks = max(1, -(-many // ANCHORS))
    # Anchors are dealt by a hash of their unique number, so blocks have about ANCHORS of them.
    dealt = as_table(
        anchors.groupBy(F.pmod(F.xxhash64("anchor"), F.lit(blocks)).cast("int").alias("block"))
        .agg(F.collect_list(F.struct("anchor", "id", "label", "q", "low", "high")).alias("own")), "anchor-blocks")
    kind = np.float64 if exact else object
    schema = pa.schema([("anchor", pa.int64()), ("window", pa.int32()), ("id", pa.int64()), ("score", pa.int64())])

    def numbers(values, shape) -> np.ndarray:
        return values.flatten().to_numpy().reshape(shape).astype(kind)

    def work(batches):
        kept: dict[int, tuple] = {}
        last, block = None, None
        for batch in batches:
            for i in range(batch.num_rows):
                raw = batch.column("ids")[i].as_py()
                q = batch.column("q")[i].as_py()
                if last != (raw, q):
                    last = raw, q
                    block = Block(np.frombuffer(raw, np.int64), np.frombuffer(batch.column("labels")[i].as_py(), np.int64),
                                  np.frombuffer(q, np.int64).reshape(-1, dims).astype(kind))
                number = batch.column("block")[i].as_py()
                if number not in kept:
                    own = batch.column("own").slice(i, 1).flatten()
                    rows = len(own)
                    kept[number] = (own.field("anchor").to_numpy(), own.field("id").to_numpy(), own.field("label").to_numpy(),
                                    numbers(own.field("q"), (rows, dims)), numbers(own.field("low"), (rows, windows)),
                                    numbers(own.field("high"), (rows, windows)), Best(rows, windows, k, kind))
                _, ids, labels, vectors, low, high, best = kept[number]
                search(block, ids, labels, vectors, low, high, same_label, best)
        out = Rows(schema)
        for names, *_, best in kept.values():
            for anchor, window in zip(*np.nonzero(best.found)):
                for n in range(best.found[anchor, window]):
                    out.add((int(names[anchor]), int(window), int(best.ids[anchor, window, n]),
                             int(best.scores[anchor, window, n])))
                if out.full():
                    yield out.take()
        yield out.take()

    parts = []
    with _few_rows(spark, AT_ONCE):
        for start in range(0, blocks, WAVE):
            wave = dealt.where(F.col("block").between(start, start + WAVE - 1))
            pairs = candidates.withColumn("block", F.explode(F.sequence(F.lit(start), F.lit(min(blocks, start + WAVE) - 1))))
            # A wave has at most WAVE blocks of about ANCHORS vectors.
            met = map_batches(pairs.join(F.broadcast(wave), "block"), "anchor long, window int, id long, score long", work)
            parts.append(as_table(met, "window-rows"))
    found = parts[0]
    for part in parts[1:]:
        found = found.unionByName(part)
    return top_per_group(found, ["anchor", "window"], k, F.col("score").desc(), F.col("id"), out="place")


def mine(rows: DataFrame, is_anchor: Column, positives: int = 5, negatives: int = 5, least: int = 80, most: int = 100,
         scale: int = 256, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """anchor_id, positive_id, rank (from 1), negative_id, positive_score and negative_score.

    A component x counts as floor(``scale`` * x), a score is the inner product with the anchor; higher scores come
    first, equal ones by smaller id. An anchor's positives are its first ``positives`` other rows of its label; a
    positive's negatives the first ``negatives`` rows of other labels whose score is ``least`` to ``most`` percent
    of the positive's score. Both are all there are, if there are fewer.

    Rows with a null id, label or vector, or with a component that is null or not finite, take no part; shorter
    vectors count as filled up with zeros. Rows with the anchor's id are never its partners. Other rows with a
    repeated id count once each; anchors that are repeated rows count once. Scores are exact; a table with
    components so large that a score may leave 64 bits is refused (ValueError). An empty table, one without anchors, or one whose vectors
    have no components gives no rows.
    ``label_col`` holds whole numbers. Other columns, whatever their names, are ignored.
    """
    vector = F.col(vector_col)
    usable = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf")))
    clean = as_table(rows.select(
        F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("long").alias("label"),
        F.when(usable, F.transform(vector, lambda x: F.floor(x.cast("double") * scale).cast("long"))).alias("q"),
        F.coalesce(is_anchor, F.lit(False)).alias("asks")).where("id is not null and label is not null and q is not null"),
        "vectors")
    dims, short, top, bottom = clean.agg(
        F.max(F.size("q")), F.min(F.size("q")), F.max(F.array_max("q")), F.min(F.array_min("q"))).first()
    out = ("anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long")
    if not dims:
        return rows.sparkSession.createDataFrame([], out)
    if short < dims:
        clean = clean.withColumn("q", F.concat("q", F.array_repeat(F.lit(0).cast("long"), F.lit(dims) - F.size("q"))))
    largest = dims * max(abs(top), abs(bottom)) ** 2
    if largest > _LONG:
        raise ValueError(f"components up to {max(abs(top), abs(bottom))} in size: scores may leave 64 bits")
    exact = largest < EXACT
    candidates = as_table(_as_blocks(clean, dims), "candidate-blocks")
    # The number tells anchors apart that share an id; the table is stored, so it does not change.
    anchors = as_table(clean.where("asks").select("id", "label", "q").distinct()
                       .withColumn("anchor", F.monotonically_increasing_id()), "anchors")

    lowest = F.array(F.lit(-_LONG)).alias("low")
    nearest = as_table(_meet(candidates, anchors.select("*", lowest, F.array(F.lit(_LONG)).alias("high")), dims, exact,
                             positives, 1, True).select("anchor", "id", "score", "place"), "positives")
    # The windows of an anchor in the order of its positives; a window from 1 to 0 holds nothing.
    owned = nearest.groupBy("anchor").agg(F.sort_array(F.collect_list(F.struct("place", "id", "score"))).alias("own"))
    score = F.transform(F.col("own.score"), lambda s: s.cast("decimal(38,0)"))
    pad = F.array_repeat
    low = F.transform(score, lambda s: F.ceil(s * least / 100).cast("long"))
    high = F.transform(score, lambda s: F.floor(s * most / 100).cast("long"))
    asked = as_table(anchors.join(owned, "anchor").select(
        "anchor", "id", "label", "q", "own",
        F.concat(low, pad(F.lit(1).cast("long"), F.lit(positives) - F.size("own"))).alias("low"),
        F.concat(high, pad(F.lit(0).cast("long"), F.lit(positives) - F.size("own"))).alias("high")), "windows")
    chosen = _meet(candidates, asked, dims, exact, negatives, positives, False)
    named = asked.select("anchor", F.col("id").alias("anchor_id"), F.posexplode("own").alias("window", "positive"))
    return named.join(chosen.withColumnRenamed("id", "negative_id"), ["anchor", "window"]).select(
        "anchor_id", F.col("positive.id").alias("positive_id"), F.col("place").cast("int").alias("rank"), "negative_id",
        F.col("positive.score").alias("positive_score"), F.col("score").alias("negative_score"))
