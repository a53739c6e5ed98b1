"""The operators' queries over the test tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from brindle.llm import (
    ctph, decontaminate, hard_negatives, html_text, idcodec, langid, line_dedup, merkle, oracles, ordinal, packing,
    piece_bpe, simhash, token_counts)
from brindle.session import scratch_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {"op12_merkle_manifest": oracles.merkle(), "op13_hard_negatives": oracles.HARD_NEGATIVES}


def query(f):
    QUERIES[f.__name__] = f
    return f


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


@query
def op1_simhash(spark, folder):
    return simhash.near_components(table(spark, folder, "documents"), shingle=4, parts=1, max_bits=4,
                                   min_jaccard=None).select("doc_id", "fingerprint", "component_id")


@query
def op2_packing(spark, folder):
    pieces = packing.pack(table(spark, folder, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens",
                         "sequence_id", "offset")


@query
def op3_line_dedup(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return line_dedup.dedup_lines(docs, report=True)


@query
def op4_piecewise_hash(spark, folder):
    return ctph.compare_neighbours(table(spark, folder, "documents"))


@query
def op5_ordinal_quality(spark, folder):
    docs = table(spark, folder, "documents")
    # Toxic texts are the lowest grade, poor ones the next, good ones the highest.
    grade = F.when(F.col("toxic") == 1, 0).otherwise(1 + F.col("quality"))
    return ordinal.select(docs, ordinal.fit(docs, table(spark, folder, "labels"), grade))


@query
def op6_language_id(spark, folder):
    docs = table(spark, folder, "documents")
    held_out = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(4)) == 2
    model = langid.learn(docs.where(~held_out))
    return langid.identify(docs, model, (F.coalesce(held_out, F.lit(False)).alias("held_out"),)).select(
        "doc_id", "held_out", "lang_pred", "score")


@query
def op7_id_files(spark, folder):
    path = scratch_path(spark, "ids")
    idcodec.write_ids(table(spark, folder, "documents"), path, public_tokenizers.path("word_bpe_49k.json"))
    return idcodec.read_ids(spark, path).select(
        "doc_id", "start", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.crc32("ids").alias("ids_crc32"))


@query
def op8_token_counts(spark, folder):
    return token_counts.count_tokens(table(spark, folder, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


@query
def op9_decontamination(spark, folder):
    return decontaminate.find_leaks(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


@query
def op10_html_text(spark, folder):
    return html_text.extract_text(table(spark, folder, "pages"))


@query
def op11_sentencepiece(spark, folder):
    model = public_tokenizers.path("piece_bpe_32k.model")
    coded = piece_bpe.decode(piece_bpe.encode(table(spark, folder, "documents"), model), model)
    return coded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
                        F.sha2("decoded", 256).alias("decoded_sha256"))


@query
def op12_merkle_manifest(spark, folder):
    # A third of the rows, chosen by their ids, come back with a changed text.
    chosen = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    found = F.when(chosen, merkle.ascii_lower("text")).otherwise(F.col("text"))
    return merkle.manifest(table(spark, folder, "documents"), now={"text": found}).select(
        "doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


@query
def op13_hard_negatives(spark, folder):
    rows = table(spark, folder, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(rows.withColumn("label", label), F.col("vec_id") % 100 == 0)
