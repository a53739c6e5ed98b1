"""Scans. Schemas are given, so no file is read just to infer one."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from brindle.functions.dates import with_date_parts
from brindle.session import finished_batches, folders, path_exists
from brindle.sources import schemas


#: Stored bytes up to which a scan may be dealt out anew.
SMALL_SCAN = 64 << 20

#: Bytes of a scan, as Catalyst estimates them, for each task that it is dealt out to.
DEALT_BYTES = 4 << 20


def register(df: DataFrame, view: str | None) -> DataFrame:
    """Expose ``df`` to SQL under ``view`` and hand it on."""
    if view:
        df.createOrReplaceTempView(view)
    return df


def balanced(scan: DataFrame, most_bytes: int = SMALL_SCAN) -> DataFrame:
    """Deal a scan of at most ``most_bytes`` stored bytes out over all cores; leave any larger one alone.

    For row-heavy work (tokenizing) on a small file that is one split. Larger inputs are never
    shuffled for it: they have splits enough, or should be written with more row groups.
    """
    size = int(str(scan._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return scan.repartition(scan.sparkSession.sparkContext.defaultParallelism) if size <= most_bytes else scan


def dealt(scan: DataFrame, key: str, task_bytes: int = DEALT_BYTES) -> DataFrame:
    """Deal a scan out by ``key``, for work that makes many rows of one (tokenizing) and then groups them by ``key``
    and more: the scan is shuffled before it grows, and never again for these groups.

    The work is spread over all cores however few row groups the files have. The number of tasks follows the bytes.
    """
    size = int(str(scan._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return scan.repartition(max(scan.sparkSession.sparkContext.defaultParallelism, -(-size // task_bytes)), key)


def read_csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """CSV with a header line and a fixed schema."""
    return spark.read.schema(schema).option("header", True).csv(path)


def read_flights(spark: SparkSession, path: str, view: str | None = "flights") -> DataFrame:
    """Flight records with year, month and day of week appended."""
    flights = read_csv(spark, path, schemas.FLIGHTS)
    return register(with_date_parts(flights, "FL_DATE"), view)


def read_quoted_csv(spark: SparkSession, path: str, casts: dict[str, str]) -> DataFrame:
    """Header-driven CSV whose quoted fields may hold quotes and line breaks.

    Only the columns of ``casts`` (name -> type) are kept; text that does not fit its
    type becomes null. A file with quoted line breaks is read by one task, so feed
    large inputs as many files.
    """
    raw = (spark.read.option("header", True).option("multiLine", True)
           .option("quote", '"').option("escape", '"').option("mode", "PERMISSIVE").csv(path))
    return raw.select(*(F.col(name).try_cast(kind).alias(name) for name, kind in casts.items()))


def read_reviews(spark: SparkSession, path: str) -> DataFrame:
    """Review keys, rating and time; not yet cleaned."""
    return read_quoted_csv(spark, path, {"reviewerID": "string", "asin": "string",
                                         "overall": "double", "unixReviewTime": "bigint"})


def read_parquet(spark: SparkSession, path: str, view: str | None = None) -> DataFrame:
    """Parquet scan; directory names ``col=value`` become partition columns."""
    return register(spark.read.parquet(path), view)


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """Text collection: one row (doc, line) per line, ``doc`` is the file's base name."""
    lines = spark.read.text(path)
    return lines.select(F.col("_metadata.file_name").alias("doc"), F.col("value").alias("line"))


def read_word_list(spark: SparkSession, path: str, *, missing_ok: bool = False) -> DataFrame:
    """Distinct non-blank words, stripped and lowercased (column ``word``)."""
    if missing_ok and not path_exists(spark, path):
        return spark.createDataFrame([], "word string")
    word = F.lower(F.regexp_replace("value", r"(?U)^\s+|\s+$", ""))
    return spark.read.text(path).select(word.alias("word")).where(F.col("word") != "").distinct()


def read_batches(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """What the foreachBatch writers finished: only batch folders with their _SUCCESS marker.

    Adds ``batch_id``; empty if nothing was finished yet. Folders may lie below ``kind=value`` ones.
    """
    base = f"{path.rstrip('/')}"
    found = [f"{base}/batch_id={n}" for n in finished_batches(spark, base)]
    found += [f"{kind}/batch_id={n}" for kind in folders(spark, base, "*=*") if "batch_id=" not in kind.rsplit("/", 1)[1]
              for n in finished_batches(spark, kind)]
    if not found:
        return spark.createDataFrame([], schema).drop("batch_id").withColumn("batch_id", F.lit(None).cast("long"))
    stored = StructType([f for f in StructType.fromDDL(schema) if f.name != "batch_id"])
    rows = spark.read.schema(stored).parquet(*found)
    number = F.regexp_extract(F.col("_metadata.file_path"), r"batch_id=(\d+)", 1)
    return rows.select("*", number.cast("long").alias("batch_id"))


def read_sink(spark: SparkSession, path: str, schema: str, *, newest_files: int | None = None,
              modified_after: str | None = None) -> DataFrame:
    """What a streaming file sink committed so far; empty if nothing was written yet.

    ``modified_after`` prunes at listing time. ``newest_files`` keeps the rows of that
    many most recently written files.
    """
    if not path_exists(spark, path):
        return spark.createDataFrame([], schema)
    reader = spark.read.schema(schema)
    if modified_after:
        reader = reader.option("modifiedAfter", modified_after)
    rows = reader.parquet(path)
    if newest_files is None:
        return rows
    stamped = rows.select("*", F.col("_metadata.file_path").alias("__file"),
                          F.col("_metadata.file_modification_time").alias("__at"))
    newest = (stamped.groupBy("__file").agg(F.max("__at").alias("__at"))
              .orderBy(F.col("__at").desc(), F.col("__file").desc()).limit(newest_files))
    return stamped.join(F.broadcast(newest.select("__file")), "__file", "left_semi").select(*rows.columns)


def read_factors(spark: SparkSession, path: str):
    """Stored (user factors, item factors); fails if they were never saved."""
    users, items = spark.read.parquet(f"{path}/user_factors"), spark.read.parquet(f"{path}/item_factors")
    return users.select("id", "features"), items.select("id", "features")


def read_dictionaries(spark: SparkSession, path: str):
    """Stored (user dictionary, item dictionary); fails if they were never saved."""
    return spark.read.parquet(f"{path}/user_index"), spark.read.parquet(f"{path}/item_index")
