"""Bounded-space online packing of token sequences into fixed windows.

Every task packs the documents of its own partition in the order it reads them, so nothing
is shuffled: a fixed number of windows is open at a time, a document goes to the window
that it fills best, and when it fits nowhere the fullest window is topped up with the
document's first tokens and emitted full. What is still open when a partition ends is
merged over partitions in groups of ``MERGE_WINDOWS`` windows by the same rule; each group
leaves at most one sequence that is not full.

The pieces of the first step are written to the shared folder once: texts are encoded once,
and a lost executor cannot change which pieces are left over.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brindle.llm.batches import Rows, map_batches, partition_id, regroup
from brindle.llm.wordbpe import encoder
from brindle.session import as_table

#: Windows left over by the partitions that one merging task takes.
MERGE_WINDOWS = 4096
#: Texts that are encoded together, so that their common words are looked up once.
TEXTS = 2048

PIECES = ("doc_id long, start long, length long, doc_tokens long, sequence_id long, offset long, "
          "ids binary, closed boolean")
_ARROW = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()),
                    ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64()),
                    ("ids", pa.binary()), ("closed", pa.bool_())])


class Packer:
    """Open windows of one task. A piece is (doc_id, start, ids, doc_tokens)."""

    def __init__(self, size: int, windows: int, first_id: int, out: Rows):
        self.size, self.windows, self.next_id, self.out = size, windows, first_id, out
        self.open: list[list] = []  # [fill, pieces]

    def _emit(self, pieces: list[tuple], closed: bool) -> None:
        offset = 0
        for doc, start, ids, total in pieces:
            length = len(ids) // 4
            self.out.add((doc, start, length, total, self.next_id, offset, ids, closed), len(ids))
            offset += length
        self.next_id += 1

    def add(self, pieces: list[tuple]) -> None:
        """Place pieces that belong together; they are parted only where nothing fits."""
        need = sum(len(p[2]) for p in pieces) // 4
        while need >= self.size:
            full, pieces = _cut(pieces, self.size)
            self._emit(full, True)
            need -= self.size
        if not need:
            return
        fits = [w for w in self.open if w[0] + need <= self.size]
        if fits:
            window = max(fits, key=lambda w: w[0])
            window[0] += need
            window[1].extend(pieces)
        elif len(self.open) < self.windows:
            self.open.append([need, pieces])
            return
        else:
            window = max(self.open, key=lambda w: w[0])
            head, rest = _cut(pieces, self.size - window[0])
            window[1].extend(head)
            window[0] = self.size
            self.open.append([need - sum(len(p[2]) for p in head) // 4, rest])
        if window[0] == self.size:
            self._emit(window[1], True)
            self.open.remove(window)

    def leave(self) -> None:
        """Hand over the open windows as they are."""
        for _, pieces in self.open:
            self._emit(pieces, False)
        self.open = []

    def finish(self) -> None:
        """Join the open windows end to end; at most one sequence is not full."""
        pieces = [p for _, own in sorted(self.open, key=lambda w: -w[0]) for p in own]
        self.open = []
        while pieces:
            head, pieces = _cut(pieces, self.size)
            self._emit(head, True)


def _cut(pieces: list[tuple], size: int) -> tuple[list[tuple], list[tuple]]:
    head, left = [], size
    for k, (doc, start, ids, total) in enumerate(pieces):
        length = len(ids) // 4
        if length >= left:
            head.append((doc, start, ids[:4 * left], total))
            rest = [(doc, start + left, ids[4 * left:], total)] if length > left else []
            return head, rest + pieces[k + 1:]
        head.append((doc, start, ids, total))
        left -= length
    return head, []


def pack(docs: DataFrame, tokenizer: str, size: int = 2048, windows: int = 16, end_id: int = 1,
         id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Sequences of at most ``size`` ids, as one row per piece of a document.

    Columns: doc_id, start, length, doc_tokens, sequence_id, offset and ids (little-endian
    unsigned 32-bit integers). Ids are those of ``tokenizer`` (a tokenizers file) without
    special tokens, then ``end_id``. A null or empty text is the single id ``end_id``;
    repeated rows are packed once each; a null doc_id stays null; texts longer than a window
    fill whole windows first; an empty table gives no rows; other columns are ignored.
    """
    end = np.array([end_id], "<u4").tobytes()

    def fill(batches):
        out = Rows(_ARROW)
        packer = Packer(size, windows, partition_id() << 33, out)
        for batch in regroup(batches, TEXTS):
            ids, borders = encoder(tokenizer).encode_batch(batch.column("text"), end)
            data, ends = ids.tobytes(), (4 * borders).tolist()
            for doc, a, b in zip(batch.column("doc_id").to_pylist(), ends, ends[1:]):
                packer.add([(doc, 0, data[a:b], (b - a) // 4)])
                if out.full():
                    yield out.take()
        packer.leave()
        yield out.take()

    def merge(batches):
        out = Rows(_ARROW)
        packer, group, window, held = None, None, None, []
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                key, sequence, doc, start, ids, total = row
                if sequence != window:
                    if held:
                        packer.add(held)
                    held, window = [], sequence
                if key != group:
                    if packer:
                        packer.finish()
                    # Ids above those of the first step.
                    group, packer = key, Packer(size, windows, (1 << 62) + (key << 33), out)
                held.append((doc, start, ids, total))
                if out.full():
                    yield out.take()
        if held:
            packer.add(held)
        if packer:
            packer.finish()
        yield out.take()

    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    first = as_table(map_batches(texts, PIECES, fill, caches="wordbpe"), "packed")
    left = first.where("not closed")
    groups = max(1, -(-left.where("offset = 0").count() // MERGE_WINDOWS))
    merged = map_batches(
        left.select(F.expr(f"pmod(xxhash64(sequence_id), {groups})").alias("key"), "sequence_id", "doc_id",
                    "start", "ids", "doc_tokens", "offset")
        .repartition(groups, "key").sortWithinPartitions("key", "sequence_id", "offset")
        .select("key", "sequence_id", "doc_id", "start", "ids", "doc_tokens"), PIECES, merge)
    return first.where("closed").unionByName(merged).drop("closed")
