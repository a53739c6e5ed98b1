"""Helpers around Arrow batches inside Spark tasks."""

from __future__ import annotations

import contextlib
import ctypes
import gc
import os
import tempfile
import zipfile
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession

#: Rows gathered before an output batch is handed on.
OUT_ROWS = 4096
#: Rows of an input batch that are turned into Python objects at a time, and rows that Spark hands over at once.
IN_ROWS, ARROW_ROWS = 512, 1024
#: Bytes of texts that are encoded together.
TEXT_BYTES = 4 << 20
#: Words whose ids are gathered at a time.
SLICE = 1 << 16
_ARROW = "spark.sql.execution.arrow.maxRecordsPerBatch"

_HELD: dict[str, Callable[[], None]] = {}


def hold(name: str, clear: Callable[[], None]) -> None:
    """Name the worker's caches in use; those of operators that ran before are cleared.

    Python workers live on from stage to stage, so caches would add up.
    """
    free_others(name)
    _HELD[name] = clear


def free_others(name: str) -> None:
    """Clear the worker's caches of all operators but ``name`` and hand their memory back."""
    others = [other for other in _HELD if other != name]
    for other in others:
        _HELD.pop(other)()
    if others:
        gc.collect()
        pa.default_memory_pool().release_unused()
        with contextlib.suppress(OSError, AttributeError):  # not every C library has it
            ctypes.CDLL(None).malloc_trim(0)


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package's modules to the Python workers, once per application."""
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    path = os.path.join(tempfile.mkdtemp(prefix="ship-"), "modules.zip")
    with zipfile.ZipFile(path, "w") as archive:
        for folder, _, names in os.walk(package):
            for name in names:
                if name.endswith(".py"):
                    file = os.path.join(folder, name)
                    archive.write(file, os.path.relpath(file, os.path.dirname(package)))
    context.addPyFile(path)
    _SHIPPED.add(context.applicationId)


def _slices(batches: Iterator[pa.RecordBatch], rows: int | None) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, rows or batch.num_rows):
            yield batch.slice(at, rows or batch.num_rows)


def _halves(batch: pa.RecordBatch, size: int) -> Iterator[pa.RecordBatch]:
    if batch.nbytes <= size or batch.num_rows < 2:
        yield batch
        return
    half = batch.num_rows // 2
    yield from _halves(batch.slice(0, half), size)
    yield from _halves(batch.slice(half), size)


def regroup(batches: Iterable[pa.RecordBatch], rows: int, size: int = TEXT_BYTES) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of ``rows`` and more, but for the last and those that would have more than ``size``
    bytes; only a single row may."""
    held, many, large = [], 0, 0
    for batch in batches:
        for part in _halves(batch, size):
            if held and (many >= rows or large + part.nbytes > size):
                yield pa.concat_batches(held)
                held, many, large = [], 0, 0
            held.append(part)
            many += part.num_rows
            large += part.nbytes
    if held:
        yield pa.concat_batches(held)


def map_batches(df: DataFrame, schema: str, work: Callable[[Iterator[pa.RecordBatch]], Iterable],
                rows: int | None = IN_ROWS, caches: str | None = None) -> DataFrame:
    """``mapInArrow`` for a generator that takes and yields record batches (of at most ``rows`` rows).

    The caches that operators have left in the worker go first, but for those held under the name ``caches`` (by
    default that of the module of ``work``). The session hands over at most
    ``ARROW_ROWS`` rows at once, because a batch of texts has no bound in bytes.
    """
    spark, own = df.sparkSession, caches or work.__module__.rpartition(".")[2]
    if int(spark.conf.get(_ARROW)) > ARROW_ROWS:
        spark.conf.set(_ARROW, ARROW_ROWS)

    def run(batches):
        free_others(own)
        try:
            yield from work(_slices(batches, rows))
        finally:
            pa.default_memory_pool().release_unused()
    ship(spark)
    return df.mapInArrow(run, schema)


def each_batch(df: DataFrame, schema: str, work: Callable[[pa.RecordBatch], pa.RecordBatch],
               rows: int | None = IN_ROWS) -> DataFrame:
    """``mapInArrow`` with one output batch for each slice of the input."""
    def each(batches):
        return map(work, batches)
    each.__module__ = work.__module__
    return map_batches(df, schema, each, rows)


def strings(batch: pa.RecordBatch, name: str) -> list[str]:
    """A text column as Python strings, null as the empty text."""
    return [v or "" for v in batch.column(name).to_pylist()]


def column(batch: pa.RecordBatch, name: str) -> np.ndarray:
    return batch.column(name).to_numpy(zero_copy_only=False)


def record_batch(schema: pa.Schema, *columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c, f.type)
                                       for c, f in zip(columns, schema)], schema=schema)


def ragged(data: np.ndarray, first: np.ndarray, sizes: np.ndarray, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The parts of ``data`` (by their first places and sizes) that ``codes`` name, one after another, and their borders."""
    each = sizes[codes]
    done = np.zeros(len(codes) + 1, np.int64)
    np.cumsum(each, out=done[1:])
    out = np.empty(done[-1], data.dtype)
    for at in range(0, len(codes), SLICE):
        part, to = codes[at:at + SLICE], min(len(codes), at + SLICE)
        a, b = done[at], done[to]
        place = np.repeat(first[part] - (done[at:to] - a).astype(np.int32), each[at:to])
        place += np.arange(b - a, dtype=np.int32)
        np.take(data, place, out=out[a:b])
    return out, done


class Words:
    """The words of a batch of texts: how many each text has, and every word as a number into ``dictionary``."""

    def __init__(self, lists: pa.ListArray):
        coded = lists.flatten().dictionary_encode()
        self.counts = np.diff(lists.offsets.to_numpy())
        self.codes = coded.indices.to_numpy()
        self.dictionary: pa.Array = coded.dictionary

    @property
    def distinct(self) -> list[str]:
        return self.dictionary.to_pylist()

    def gather(self, ids: list[bytes], end: bytes = b"") -> tuple[np.ndarray, np.ndarray]:
        """All ids (unsigned 32-bit, text after text, ``end`` behind each) and the texts' borders, from those of the
        distinct words."""
        sizes = np.fromiter(map(len, ids), np.int32, len(ids)) // 4
        return self.join(np.frombuffer(b"".join(ids), "<u4"), (np.cumsum(sizes) - sizes).astype(np.int32), sizes, end)

    def join(self, data: np.ndarray, first: np.ndarray, sizes: np.ndarray, end: bytes = b"") -> tuple[np.ndarray, np.ndarray]:
        """:meth:`gather` from the places and sizes (both int32) of the distinct words' ids in ``data``."""
        codes, counts = self.codes, self.counts + bool(end)
        if end:
            codes = np.insert(codes, np.cumsum(self.counts), len(sizes))
            first, sizes = np.append(first, np.int32(len(data))), np.append(sizes, np.int32(len(end) // 4))
            data = np.concatenate([data, np.frombuffer(end, "<u4")])
        out, done = ragged(data, first, sizes, codes)
        return out, done[np.concatenate([[0], np.cumsum(counts)])]


class Rows:
    """Gathers rows and yields them as record batches of bounded size."""

    def __init__(self, schema: pa.Schema, limit: int = OUT_ROWS, limit_bytes: int = 4 << 20):
        self.schema, self.limit, self.limit_bytes = schema, limit, limit_bytes
        self.rows: list[tuple] = []
        self.bytes = 0

    def add(self, row: tuple, size: int = 0) -> None:
        self.rows.append(row)
        self.bytes += size

    def full(self) -> bool:
        return len(self.rows) >= self.limit or self.bytes >= self.limit_bytes

    def take(self) -> pa.RecordBatch:
        out = record_batch(self.schema, *(zip(*self.rows) if self.rows else [[] for _ in self.schema]))
        self.rows, self.bytes = [], 0
        return out


def partition_id() -> int:
    context = TaskContext.get()
    return context.partitionId() if context else 0
