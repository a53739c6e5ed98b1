"""Session settings and the shared storage that intermediate tables live in."""

from __future__ import annotations

import contextlib
import re
import tempfile
import threading
import uuid

from pyspark.sql import DataFrame, SparkSession

# The switches the operators rely on. Executors and memory belong to the deployment;
# size_for fits partition counts to the input.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.streaming.minBatchesToRetain": "5",
    # Window state can outgrow the heap; RocksDB keeps it on local disk, backed by the checkpoint.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}

# Sizing targets of size_for.
SHUFFLE_BYTES, SPLIT_BYTES, MAX_SCAN_TASKS = 256 << 20, 128 << 20, 200_000

_SCRATCH: dict[str, list[str]] = {}
_LOCK, _OWNED = threading.Lock(), threading.local()


def build_session(app: str = "brindle", master: str | None = None, **conf) -> SparkSession:
    """Create (or reuse) a session; ``conf`` keys use ``__`` in place of dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in DEFAULTS.items():
        builder = builder.config(key, value)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), str(value))
    return builder.getOrCreate()


def apply_defaults(spark: SparkSession) -> SparkSession:
    """Set the runtime switches on a session somebody else built."""
    for key, value in DEFAULTS.items():
        spark.conf.set(key, value)
    return spark


def size_for(spark: SparkSession, *paths: str) -> int:
    """Fit split and shuffle sizes to the stored bytes of the inputs; returns the bytes.

    Shuffles start with one partition per ``SHUFFLE_BYTES`` of input (AQE merges what
    turns out small) and scans of very large inputs use larger splits, so that neither
    200 huge partitions nor a million tiny tasks come out.
    """
    total = 0
    for path in paths:
        target = spark._jvm.org.apache.hadoop.fs.Path(path)
        system = target.getFileSystem(spark._jsc.hadoopConfiguration())
        total += sum(system.getContentSummary(found.getPath()).getLength()
                     for found in system.globStatus(target) or [])
    partitions = max(spark.sparkContext.defaultParallelism, total // SHUFFLE_BYTES)
    split = max(SPLIT_BYTES, total // MAX_SCAN_TASKS)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.initialPartitionNum", partitions)
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    return total


def shared_dir(spark: SparkSession) -> str:
    """Root folder every executor can reach: ``spark.checkpoint.dir`` of the session.

    A local session without the setting (tests) gets a folder of its own; on a cluster its
    absence, or a machine-local folder, is a configuration error, because that folder would
    lose data with the machine.
    """
    context = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not root:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
        root = tempfile.mkdtemp(prefix="brindle-")
    elif root.startswith("file:") and not context.master.startswith("local"):
        raise ValueError(f"spark.checkpoint.dir must be shared by all executors, not {root}")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder; never reused between calls.

    It belongs to the innermost :func:`scratch_owner` of the calling thread, else to the application.
    """
    path = f"{shared_dir(spark)}/brindle/{label}-{uuid.uuid4().hex}"
    owners = getattr(_OWNED, "stack", None)
    if owners:
        owners[-1].append(path)
    else:
        with _LOCK:
            _SCRATCH.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


@contextlib.contextmanager
def scratch_owner(spark: SparkSession):
    """Own the scratch tables that this thread writes inside the block; they are deleted at its end."""
    owners = _OWNED.__dict__.setdefault("stack", [])
    owners.append([])
    try:
        yield
    finally:
        for path in owners.pop():
            delete_path(spark, path)


def release_scratch(spark: SparkSession) -> None:
    """Delete the application's scratch tables, but for those a block still owns. Frames built on
    them stop working, so call it once their results are stored."""
    with _LOCK:
        paths = _SCRATCH.pop(spark.sparkContext.applicationId, [])
    for path in paths:
        delete_path(spark, path)


def as_table(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once to shared storage and return the scan of it.

    Cuts lineage in a way that survives executor loss, stops a reused side from
    being computed twice, and gives Catalyst the true size of the side, so that it
    broadcasts it only below ``spark.sql.autoBroadcastJoinThreshold``.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextlib.contextmanager
def arrow_rows(spark: SparkSession, rows: int):
    """Inside the block, Python workers get at most ``rows`` rows at once: for rows that hold whole blocks of data."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, rows)
    try:
        yield
    finally:
        spark.conf.set(key, before)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether ``path`` exists on its (possibly remote) file system."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def delete_path(spark: SparkSession, path: str) -> None:
    """Delete ``path`` and all below it, if it exists."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def finished_batches(spark: SparkSession, path: str) -> dict[int, float]:
    """Batch number -> time (seconds) at which its folder ``batch_id=n`` below ``path`` was finished."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = target.getFileSystem(spark._jsc.hadoopConfiguration())
    found = {}
    for status in system.globStatus(spark._jvm.org.apache.hadoop.fs.Path(f"{path}/batch_id=*/_SUCCESS")) or []:
        number = re.fullmatch(r"batch_id=(\d+)", status.getPath().getParent().getName())
        if number:
            found[int(number[1])] = status.getModificationTime() / 1000
    return found


def folders(spark: SparkSession, path: str, pattern: str) -> list[str]:
    """Paths directly below ``path`` whose names match the glob ``pattern``."""
    target = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{pattern}")
    system = target.getFileSystem(spark._jsc.hadoopConfiguration())
    return [status.getPath().toString() for status in system.globStatus(target) or []]
