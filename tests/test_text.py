"""Tokenizer, inverted index, stop words and the text files around them."""

import os
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from brindle.functions.stopwords import ENGLISH
from brindle.functions.text import tokens
from brindle.operators import inverted_index as index
from brindle.plans import catalog, text_queries  # noqa: F401
from brindle.plans.studies import physical_plan
from brindle.session import scratch_path
from brindle.sources import readers, writers

DOCS = [("1.txt", "The cat -- the CAT! don't"), ("1.txt", ""), ("2.txt", "STOP—well-known café a b 42nd cat"),
        ("3.txt", "   \t "), ("4.txt", "the and of"), ("", "orphan"), (None, "orphan")]


@pytest.fixture
def docs(spark):
    return spark.createDataFrame(DOCS, "doc string, line string")


@pytest.fixture
def stop(spark):
    return index.stop_terms(index.english_stop_words(spark))


def test_tokens(spark, docs):
    got = [r[0] for r in docs.select(tokens(F.col("line"))).collect()]
    assert got[0] == ["the", "cat", "the", "cat", "dont"]
    assert got[2] == ["stopwellknown", "caf", "a", "b", "42nd", "cat"]
    assert got[3] == []
    wide = [r[0] for r in docs.select(tokens(F.col("line"), unicode=True)).collect()]
    assert "café" in wide[2]


def test_index_drops_stop_words_and_nameless_documents(docs, stop, rows):
    assert rows(index.build_index(docs, stop=stop), "term", "doc", "tf") == [
        ("42nd", "2.txt", 1), ("b", "2.txt", 1), ("caf", "2.txt", 1), ("cat", "1.txt", 2), ("cat", "2.txt", 1),
        ("stopwellknown", "2.txt", 1)]


def test_raw_stop_words_miss_apostrophes(spark, docs):
    raw = index.stop_terms(index.english_stop_words(spark), raw=True)
    assert raw.count() == len(set(ENGLISH)) == 198
    assert index.build_index(docs, stop=raw).where("term = 'dont'").count() == 1


def test_posting_lists_and_lines(docs, stop):
    lists = index.posting_lists(index.build_index(docs, stop=stop))
    lines = {r["term"]: r["line"] for r in index.index_lines(lists).collect()}
    assert lines["cat"] == "cat --> 1.txt:2, 2.txt:1"
    assert [r["term"] for r in index.preview(index.build_index(docs, stop=stop), 2).collect()] == ["b", "caf"]


def test_preview_takes_terms_not_parts(spark):
    docs = spark.createDataFrame([(f"d{i}", "a b c") for i in range(9)], "doc string, line string")
    found = index.preview(index.build_index(docs), 2, max_postings=4).collect()
    assert [(r["term"], r["part"], len(r["postings"])) for r in found] == [
        ("a", 0, 4), ("a", 1, 4), ("a", 2, 1), ("b", 0, 4), ("b", 1, 4), ("b", 2, 1)]


def test_frequent_terms_are_split_and_complete(spark):
    docs = spark.range(500).select(F.format_string("d%03d", "id").alias("doc"), F.lit("common rare").alias("line"))
    docs = docs.withColumn("line", F.when(F.col("doc") == "d007", F.col("line")).otherwise(F.lit("common")))
    lists = index.posting_lists(index.build_index(docs), max_postings=40).collect()
    common = [r for r in lists if r["term"] == "common"]
    common.sort(key=lambda r: r["part"])
    assert [r["part"] for r in common] == list(range(13))
    assert [len(r["postings"]) for r in common] == [40] * 12 + [20]
    assert [p["doc"] for r in common for p in r["postings"]] == [f"d{i:03d}" for i in range(500)]
    assert [r["part"] for r in lists if r["term"] == "rare"] == [0]


def test_stop_share(docs, stop):
    got = {r["doc"]: (r["tokens"], r["stop_tokens"], r["stop_ratio"]) for r in index.stop_share(docs, stop).collect()}
    assert got["1.txt"] == (5, 3, 0.6)
    assert got["3.txt"] == (0, 0, None)
    assert got["4.txt"] == (3, 3, 1.0)


def test_collection_of_files(spark, tmp_path, rows):
    books = {"10.txt": "one two\n\ntwo three\n", "2.txt": "two\n"}
    for name, text in books.items():
        (tmp_path / name).write_text(text)
    built = index.build_index(readers.read_documents(spark, str(tmp_path)))
    expected = {(t, n): c for n, text in books.items() for t, c in Counter(text.split()).items()}
    assert {(t, d): c for t, d, c in rows(built, "term", "doc", "tf")} == expected


def test_index_sinks(spark, docs, stop):
    built = index.build_index(docs, stop=stop)
    table, text = scratch_path(spark, "t"), scratch_path(spark, "x")
    writers.write_index(built, table)
    assert index.find_term(readers.read_parquet(spark, table), "cat").count() == 2
    assert not writers.succeeded(spark, text)
    for _ in range(2):  # the second run replaces the first
        writers.write_index_text(index.posting_lists(built), text)
    assert writers.succeeded(spark, text)
    lines = [r[0] for r in spark.read.text(text).collect()]
    assert len(lines) == 5 and "b --> 2.txt:1" in lines


def test_word_list(spark, tmp_path):
    path = os.path.join(tmp_path, "w.txt")
    with open(path, "w") as file:
        file.write("  The\nand\t\n\nTHE\n of \n")
    assert sorted(r[0] for r in readers.read_word_list(spark, path).collect()) == ["and", "of", "the"]
    missing = str(tmp_path / "missing")
    assert readers.read_word_list(spark, missing, missing_ok=True).count() == 0
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        readers.read_word_list(spark, missing).count()


def test_whole_documents_are_shuffled_once(spark, stop):
    """Dealt out by document, a text is shuffled before it grows into an index, and the index is not."""
    path = scratch_path(spark, "whole")
    spark.createDataFrame([(1, "cat cat dog"), (2, "cat  the"), (3, None)], "doc long, line string").coalesce(1).write.parquet(path)
    built = index.build_index(readers.dealt(spark.read.parquet(path), "doc"), stop=stop)
    plan = physical_plan(built)
    assert sorted(map(tuple, built.collect())) == [("cat", 1, 2), ("cat", 2, 1), ("dog", 1, 1)]
    assert len(re.findall(r"^\(\d+\) Exchange", plan, re.M)) == 1 and re.search(r"hashpartitioning\(doc", plan)
    assert "hashpartitioning(doc_id" in physical_plan(catalog.QUERIES["inverted_index"](spark, "/root/testdata/sf0.001"))
    dealt = readers.dealt(spark.read.parquet(path), "doc", task_bytes=1)
    assert dealt.rdd.getNumPartitions() > spark.sparkContext.defaultParallelism


@pytest.mark.parametrize("most", [2, 20, 1000])
def test_parts_are_the_same_however_they_are_found(spark, monkeypatch, most):
    """Terms beyond the bound are sorted over all tasks, others gathered and cut."""
    monkeypatch.setattr(index, "MAX_GATHERED", most)
    sorts = []
    inner = index.dense_ids
    monkeypatch.setattr(index, "dense_ids", lambda *args, **kw: (sorts.append(1), inner(*args, **kw))[1])
    docs = spark.range(45).selectExpr("id AS doc", "concat('all', if(id % 3 = 0, ' third', ''), if(id = 7, ' once', '')) AS line")
    found = {(r["term"], r["part"]): [p["doc"] for p in r["postings"]]
             for r in index.posting_lists(index.build_index(docs), max_postings=10).collect()}
    expected = {}
    for term, hits in (("all", list(range(45))), ("third", list(range(0, 45, 3))), ("once", [7])):
        expected |= {(term, i // 10): hits[i:i + 10] for i in range(0, len(hits), 10)}
    assert found == expected
    assert bool(sorts) == (most < 45)
