"""Text quality by ordinal regression with cumulative links.

Grades 0, 1, ... share one weight for every hashed text feature; ordered thresholds cut the
score into grades: P(grade <= k) = sigmoid(threshold_k - score). The score's expected grade
orders documents, the tail probability of a grade selects them.

Features are a document's distinct words, the shares of its word shapes (letters, case and the
punctuation around them) and its share of distinct words, hashed into ``BUCKETS``.
"""

from __future__ import annotations

import uuid
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brindle.llm.batches import each_batch, hold, record_batch, strings

#: Hash buckets, labelled documents to learn from, documents that must have a feature, rounds, penalty,
#: words kept per worker.
BUCKETS, LEARN_DOCS, LEAST_DOCS, ROUNDS, PENALTY, CACHE = 1 << 24, 20_000, 8, 200, 0.3, 150_000
_SHAPE_WEIGHT = 5.0


def _bucket(name: str) -> int:
    return crc32(name.encode("utf-8", "surrogatepass")) % BUCKETS


def _shape(chunk: str) -> str:
    out = ""
    for c in chunk:
        kind = "A" if c.isupper() else "a" if c.isalpha() else "0" if c.isdigit() else c
        if not out.endswith(kind):
            out += kind
    return out[:12]


class _Chunks(dict):
    """Chunk of text -> (bucket of its word or -1, bucket of its shape)."""

    def __missing__(self, chunk: str) -> tuple[int, int]:
        word = "".join(c for c in chunk.lower() if c.isalnum())
        found = (_bucket("w:" + word) if word else -1, _bucket("s:" + _shape(chunk)))
        if len(chunk) <= 64:
            if len(self) > CACHE:
                self.clear()
            self[chunk] = found
        return found


_CHUNKS = _Chunks()


def features(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Buckets and values of a text's features; a text without words has one feature of its own."""
    hold("ordinal", _CHUNKS.clear)
    chunks = text.split()
    if not chunks:
        return np.array([_bucket("empty")], np.int64), np.ones(1)
    found = np.array(list(map(_CHUNKS.__getitem__, chunks)), np.int64).reshape(-1, 2)
    words = np.unique(found[:, 0])
    words = words[words >= 0]
    shapes, many = np.unique(found[:, 1], return_counts=True)
    varied = _bucket(f"v:{int(10 * len(words) / len(chunks))}")
    return (np.concatenate([words, shapes, [varied]]),
            np.concatenate([np.ones(len(words)), _SHAPE_WEIGHT * many / len(chunks), [1.0]]))


def fit(docs: DataFrame, labels: DataFrame, grade: Column, id_col: str = "doc_id", text_col: str = "text",
        most: int = LEARN_DOCS) -> dict:
    """Weights and thresholds from at most about ``most`` labelled documents, chosen by a hash of their id.

    ``grade`` is an expression over ``labels`` with values 0, 1, ...; null grades and labels of
    unknown documents are not used. Without labels the model has no grades. Texts are used whole, a null one as
    empty; repeated labels and documents count once each; other columns, whatever their names, are ignored.
    """
    graded = labels.select(F.col(id_col).alias("_id"), grade.cast("int").alias("_grade")).where(
        "_id is not null and _grade >= 0")
    size = graded.count()
    if size > most:
        graded = graded.where(F.pmod(F.xxhash64("_id"), F.lit(1_000_003)) < most / size * 1_000_003)
    # About LEARN_DOCS rows of two numbers.
    texts = docs.select(F.col(id_col).alias("_doc"), F.col(text_col).alias("text"))
    chosen = texts.join(F.broadcast(graded), F.col("_doc") == F.col("_id")).select("_grade", "text")
    schema = pa.schema([("grade", pa.int32()), ("buckets", pa.binary()), ("values", pa.binary())])

    def work(batch):
        found = [features(t) for t in strings(batch, "text")]
        return record_batch(schema, batch.column("_grade"), [b.astype("<i4").tobytes() for b, _ in found],
                            [v.astype("<f4").tobytes() for _, v in found])

    rows = each_batch(chosen, "grade int, buckets binary, values binary", work).collect()
    if not rows:
        return {"buckets": np.zeros(0, np.int64), "weights": np.zeros(0), "thresholds": np.zeros(0)}
    y = np.array([r["grade"] for r in rows])
    buckets = [np.frombuffer(r["buckets"], "<i4") for r in rows]
    row = np.repeat(np.arange(len(rows)), [len(b) for b in buckets])
    column = np.concatenate(buckets)
    value = np.concatenate([np.frombuffer(r["values"], "<f4") for r in rows]).astype(float)
    names, place, seen = np.unique(column, return_inverse=True, return_counts=True)
    kept = seen >= min(LEAST_DOCS, max(1, len(rows) // 50))
    use = kept[place]
    place = (np.cumsum(kept) - 1)[place[use]]
    weights, thresholds = _descend(row[use], place, value[use], y, int(kept.sum()))
    return {"buckets": names[kept].astype(np.int64), "weights": weights, "thresholds": thresholds}


def _descend(row, column, value, y, width):
    """Adam on the penalized likelihood; thresholds are a first one and positive steps."""
    n, top = len(y), int(y.max())
    if not top:
        return np.zeros(width), np.zeros(0)
    share = np.clip([np.mean(y <= k) for k in range(top)], 1e-3, 1 - 1e-3)
    start = np.maximum.accumulate(np.log(share / (1 - share)) + 1e-3 * np.arange(top))
    x = np.concatenate([np.zeros(width), start[:1], np.log(np.maximum(np.diff(start), 1e-2))])
    mean, square = np.zeros_like(x), np.zeros_like(x)

    def sigmoid(v):
        return 1 / (1 + np.exp(-np.clip(v, -40, 40)))

    for step in range(1, ROUNDS + 1):
        weights, steps = x[:width], np.exp(x[width + 1:])
        thresholds = np.concatenate([x[width:width + 1], x[width] + np.cumsum(steps)])
        score = np.bincount(row, value * weights[column], n)
        bounds = np.concatenate([[-np.inf], thresholds, [np.inf]])
        low, high = sigmoid(bounds[y] - score), sigmoid(bounds[y + 1] - score)
        low, high = np.where(y == 0, 0, low), np.where(y == top, 1, high)
        chance = np.maximum(high - low, 1e-12)
        by_low, by_high = low * (1 - low) / chance, high * (1 - high) / chance
        # d(-log chance)/d score and by the thresholds below and above a row's grade.
        g_score = (by_high - by_low) / n
        g_bound = np.bincount(y, by_low, top + 1)[1:] / n - np.bincount(y, by_high, top + 1)[:-1] / n
        tails = np.cumsum(g_bound[::-1])[::-1]
        gradient = np.concatenate([np.bincount(column, value * g_score[row], width) + PENALTY / n * weights,
                                   tails[:1], tails[1:] * steps])
        mean = 0.9 * mean + 0.1 * gradient
        square = 0.99 * square + 0.01 * gradient ** 2
        x = x - 0.1 * (mean / (1 - 0.9 ** step)) / (np.sqrt(square / (1 - 0.99 ** step)) + 1e-8)
    return x[:width], np.concatenate([x[width:width + 1], x[width] + np.cumsum(np.exp(x[width + 1:]))])


_MODELS: dict[str, dict] = {}


def _model(key: str, shared) -> dict:
    """The worker's copy of a broadcast model. A module's function, so that all tasks share it."""
    if key not in _MODELS:
        _MODELS.clear()
        _MODELS[key] = shared.value
    return _MODELS[key]


def _tails(model: dict, texts: list[str]) -> np.ndarray:
    """P(grade >= k) for k = 1, 2, ... of every text."""
    out = np.zeros((len(texts), len(model["thresholds"])))
    buckets, weights = model["buckets"], model["weights"]
    for i, text in enumerate(texts):
        names, values = features(text)
        score = 0.0
        if len(buckets):
            at = np.minimum(np.searchsorted(buckets, names), len(buckets) - 1)
            score = float((weights[at] * values)[buckets[at] == names].sum())
        out[i] = 1 / (1 + np.exp(-np.clip(score - model["thresholds"], -40, 40)))
    return out


def select(docs: DataFrame, model: dict, least_grade: int = 2, least_chance: float = 0.5, id_col: str = "doc_id",
           text_col: str = "text") -> DataFrame:
    """(doc_id, expected_grade, tail_probability) of the rows with P(grade >= least_grade) >= ``least_chance``.

    A null text counts as empty, which is a feature of its own. A model without grades, or with
    none as high as ``least_grade``, selects nothing. Repeated rows give repeated results; null
    ids stay null; an empty table gives no rows; other columns are ignored.
    """
    key, shared = uuid.uuid4().hex, docs.sparkSession.sparkContext.broadcast(model)
    schema = pa.schema([("doc_id", pa.int64()), ("expected_grade", pa.float64()), ("tail_probability", pa.float64())])

    def work(batch):
        tails = _tails(_model(key, shared), strings(batch, "text"))
        chance = tails[:, least_grade - 1] if tails.shape[1] >= least_grade else np.zeros(len(tails))
        out = record_batch(schema, batch.column("doc_id"), tails.sum(axis=1), chance)
        return out.filter(pa.array(chance >= least_chance, pa.bool_()))

    return each_batch(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")),
                      "doc_id long, expected_grade double, tail_probability double", work)
