"""Context-triggered piecewise hashing of texts and the likeness of two fingerprints.

A rolling hash of the last ``WINDOW`` bytes ends a chunk wherever its low ``k`` bits are all
set, so chunks average 2**k bytes and boundaries move with the text. Every chunk gives one
of 64 signature letters. A fingerprint is ``k:signature:signature at k + 1``, with k chosen
from the length so that a text has about ``LETTERS`` chunks. Fingerprints are comparable at
equal block sizes, that is if their k differ by at most one.
"""

from __future__ import annotations

from hashlib import sha256

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brindle.llm.batches import Rows, map_batches, partition_id
from brindle.session import as_table

WINDOW, LETTERS, MOST, SMALLEST, SHARED = 7, 64, 512, 1, 5
_ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"
_FACTORS = [pow(0x01000193, k, 1 << 32) for k in range(WINDOW)]


def _signature(data: bytes, ends: np.ndarray) -> str:
    view, at, out = memoryview(data), 0, []
    for end in [*(ends + 1).tolist(), len(data)]:
        if end > at:
            out.append(_ALPHABET[xxhash.xxh32_intdigest(view[at:end]) & 63])
            at = end
    return "".join(out)


def fingerprint(text: str) -> str:
    """The fingerprint of a text; equal texts have equal ones, the empty text has no letters."""
    data = text.encode("utf-8", "surrogatepass")
    k = SMALLEST
    while len(data) >> k > LETTERS:
        k += 1
    if not data:
        return f"{k}::"
    raw = np.frombuffer(data, np.uint8).astype(np.uint32)
    rolling = raw * np.uint32(_FACTORS[0])
    for back in range(1, min(WINDOW, len(raw))):
        rolling[back:] += raw[:-back] * np.uint32(_FACTORS[back])
    rolling *= np.uint32(0x9E3779B1)
    rolling >>= np.uint32(7)

    def ends(bits):
        mask = np.uint32((1 << bits) - 1)
        return np.flatnonzero((rolling & mask) == mask)

    # Prose has about as many triggers as expected. Repetitive texts can have very many or hardly any:
    # larger or smaller blocks then, but never a signature of over MOST letters.
    fine = ends(k)
    while len(fine) >= MOST:
        k += 1
        fine = ends(k)
    while k > SMALLEST and len(fine) < LETTERS // 2:
        finer = ends(k - 1)
        if len(finer) >= MOST:
            break
        k, fine = k - 1, finer
    mask = np.uint32((2 << k) - 1)
    coarse = fine[(rolling[fine] & mask) == mask]
    return f"{k}:{_signature(data, fine)}:{_signature(data, coarse)}"


def _edit_likeness(a: str, b: str) -> float:
    """1 - distance / (both lengths), with insertions and deletions of one letter; 0 without a
    common run of ``SHARED`` letters (or of the shorter one's length)."""
    if a == b:
        return 1.0
    run = min(SHARED, len(a), len(b))
    if not run:
        return 0.0
    runs = {a[i:i + run] for i in range(len(a) - run + 1)}
    if not any(b[i:i + run] in runs for i in range(len(b) - run + 1)):
        return 0.0
    places: dict[str, int] = {}
    for i, letter in enumerate(a):
        places[letter] = places.get(letter, 0) | (1 << i)
    full = (1 << len(a)) - 1
    row = full
    for letter in b:  # zeros in row: the longest common subsequence so far
        hit = row & places.get(letter, 0)
        row = ((row + hit) | (row - hit)) & full
    common = len(a) - row.bit_count()
    return 2 * common / (len(a) + len(b))


def likeness(a: str, b: str) -> float:
    """How alike two fingerprints are, 0 to 1; 0 if their block sizes are not compatible."""
    if a == b:
        return 1.0
    ka, fine_a, coarse_a = a.split(":")
    kb, fine_b, coarse_b = b.split(":")
    if ka == kb:
        return max(_edit_likeness(fine_a, fine_b), _edit_likeness(coarse_a, coarse_b) if coarse_a and coarse_b else 0.0)
    if int(ka) == int(kb) + 1:
        return _edit_likeness(fine_a, coarse_b)
    if int(kb) == int(ka) + 1:
        return _edit_likeness(coarse_a, fine_b)
    return 0.0


def edited(text: str, following: str) -> str:
    """The text with its last quarter replaced by the first as many characters of another."""
    quarter = len(text) // 4
    return text[:len(text) - quarter] + following[:quarter]


def compare_neighbours(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every document's fingerprint next to that of its edited text and of the next document.

    Columns: doc_id, n_chars (code points), edited_sha256 (of the edited text's UTF-8), fingerprint,
    edited_fingerprint, near_edited and near_next (likeness to these two). The next
    document is the one with the next higher doc_id (nulls come last, equal ids in order of
    their texts' hashes); after the last comes the first. A null text counts as empty;
    repeated rows are documents of their own; a single document follows itself; an empty
    table gives no rows; other columns are ignored.

    Documents are sorted once over range partitions. Only the first and the last document of
    a partition meet another partition's; those rows alone are joined afterwards.
    """
    spark = docs.sparkSession
    schema = pa.schema([
        ("part", pa.int64()), ("edge", pa.string()), ("text", pa.string()), ("doc_id", pa.int64()),
        ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()),
        ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64())])
    ddl = ("part long, edge string, text string, doc_id long, n_chars long, edited_sha256 string, "
           "fingerprint string, edited_fingerprint string, near_edited double, near_next double")

    def compared(doc, text, own, following, after):
        new = edited(text, following)
        mark = fingerprint(new)
        return (doc, len(text), sha256(new.encode("utf-8", "surrogatepass")).hexdigest(), own, mark,
                likeness(own, mark), likeness(own, after))

    def walk(batches):
        out, part, last, first = Rows(schema), partition_id(), None, True
        for batch in batches:
            for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                text = text or ""
                own = last[2] if last and last[1] == text else fingerprint(text)
                if first:
                    out.add((part, "first", text, doc, None, None, own, None, None, None), len(text))
                    first = False
                if last:
                    out.add((part, None, None, *compared(*last, text, own)))
                last = (doc, text, own)
                if out.full():
                    yield out.take()
        if last:
            doc, text, own = last
            out.add((part, "last", text, doc, None, None, own, None, None, None), len(text))
        yield out.take()

    def close(batch_iter):
        for batch in batch_iter:
            out = Rows(schema)
            for doc, text, own, following, after in zip(*(c.to_pylist() for c in batch.columns)):
                out.add((None, None, None, *compared(doc, text or "", own, following or "", after)))
            yield out.take()

    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    order = F.col("doc_id").asc_nulls_last()
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    done = as_table(map_batches(texts.repartitionByRange(parts, order)
                                .sortWithinPartitions(order, F.xxhash64("text")), ddl, walk), "neighbours")
    # Partition numbers that hold documents; each is followed by the next, the last by the first.
    full = sorted(r.part for r in done.where("edge = 'first'").select("part").collect())
    follows = spark.createDataFrame(list(zip(full, full[1:] + full[:1])), "part long, after long")
    ends = done.where("edge = 'last'").select("part", "doc_id", "text", "fingerprint").join(follows, "part")
    starts = done.where("edge = 'first'").select(
        F.col("part").alias("after"), F.col("text").alias("following"), F.col("fingerprint").alias("after_mark"))
    closed = map_batches(ends.join(starts, "after").select("doc_id", "text", "fingerprint", "following", "after_mark"),
                         ddl, close)
    return done.where("edge is null").unionByName(closed).drop("part", "edge", "text")
