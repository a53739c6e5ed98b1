"""From raw documents to packed training sequences: five stages, each over all its predecessor kept."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from brindle.llm import decontaminate, langid, line_dedup, packing, simhash
from brindle.session import as_table

TOKENIZER = "word_bpe_49k.json"


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a language that has at least half of their letters; texts without letters and texts
    mostly in scripts that no language has go."""
    return langid.keep_languages(docs, langid.learn(docs), least_share=0.5, learned_scripts=True)


def line_deduplication(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Blocks of 30 words and more that an earlier document has are deleted; texts left without words go."""
    cut = line_dedup.dedup_lines(docs, min_words=30).where(F.col("text").rlike(r"\S"))
    return cut.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def near_deduplication(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every group whose five-word shingles are at least 0.8 alike."""
    return simhash.keep_one(docs, shingle=5, min_jaccard=0.8)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold less than half of every benchmark item."""
    return decontaminate.drop_leaks(docs, spark.read.parquet(f"{sf_dir.rstrip('/')}/benchmark.parquet"))


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of at most 2048 token ids."""
    return packing.pack(docs, public_tokenizers.path(TOKENIZER))


STAGES = [
    ("language ID", language_id),
    ("line dedup", line_deduplication),
    ("SimHash near-dedup", near_deduplication),
    ("benchmark decontamination", decontamination),
    ("packing", sequences),
]

# Training, alignment and tokenizers have no SQL form; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table; each stage's rows are written and read again by the next."""
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = as_table(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
