"""Catalog: the inverted index over the text tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brindle.functions.stopwords import ENGLISH
from brindle.operators import filters, inverted_index as index
from brindle.plans.catalog import Tables, bigint, query
from brindle.session import as_table, scratch_path
from brindle.sources import readers, writers

_TOKENS = r"""(SELECT doc_id AS doc, unnest(string_split_regex(
    regexp_replace(lower(text), '[^a-z0-9\s]', '', 'g'), '\s+')) AS term FROM documents)"""
_STOP = "(SELECT DISTINCT regexp_replace(w, '[^a-z0-9]', '', 'g') AS term FROM (VALUES {}) AS v(w))".format(
    ", ".join("('{}')".format(w.replace("'", "''")) for w in ENGLISH))
_INDEX = f"""(SELECT term, doc, count(*) AS tf FROM {_TOKENS}
    WHERE term <> '' AND term NOT IN (SELECT term FROM {_STOP}) GROUP BY term, doc)"""
_LISTS = f"""(SELECT term, string_agg(doc || ':' || tf, ', ' ORDER BY doc) AS entries
    FROM {_INDEX} GROUP BY term)"""


def stop(t: Tables) -> DataFrame:
    return index.stop_terms(index.english_stop_words(t.spark))


def texts(t: Tables) -> DataFrame:
    return readers.dealt(t.documents.select("doc_id", "text"), "doc_id")


def full_index(t: Tables) -> DataFrame:
    return index.build_index(texts(t), "doc_id", "text", stop=stop(t))


@query(f"SELECT term, doc, tf FROM {_INDEX}")
def inverted_index(t):
    return full_index(t)


@query(f"SELECT term, doc, count(*) AS tf FROM {_TOKENS} WHERE term <> '' GROUP BY term, doc")
def inverted_index_all_terms(t):
    return index.build_index(texts(t), "doc_id", "text")


@query(r"""SELECT term, doc, count(*) AS tf FROM (SELECT doc_id AS doc, unnest(string_split_regex(
             regexp_replace(lower(text), '[^\p{L}\p{N}\s]', '', 'g'), '\s+')) AS term FROM documents)
           WHERE term <> '' GROUP BY term, doc""")
def inverted_index_unicode(t):
    return index.build_index(texts(t), "doc_id", "text", unicode=True)


@query(f"SELECT term, CAST(0 AS BIGINT) AS part, term || ' --> ' || entries AS line FROM {_LISTS}")
def index_lines(t):
    return index.index_lines(index.posting_lists(full_index(t)))


@query(f"SELECT term, doc, tf FROM {_INDEX}")
def split_posting_lists(t):
    """Terms in more than 50 documents are split into parts; all postings survive."""
    lists = index.posting_lists(full_index(t), max_postings=50)
    return lists.select("term", F.inline("postings"))


@query(f"""SELECT term, entries FROM {_LISTS} WHERE NOT regexp_matches(term, '^[0-9]')
           ORDER BY term LIMIT 20""")
def index_preview(t):
    lists = index.preview(as_table(full_index(t), "index"), stored=True)
    entry = F.transform("postings", lambda p: F.concat_ws(":", p["doc"], p["tf"]))
    return lists.select("term", F.array_join(entry, ", ").alias("entries"))


@query(f"""SELECT term, CAST((r - 1) // 50 AS BIGINT) AS part,
             string_agg(doc || ':' || tf, ', ' ORDER BY doc) AS entries FROM (SELECT *, row_number() OVER (
               PARTITION BY term ORDER BY doc) AS r FROM {_INDEX}) GROUP BY ALL""")
def ranged_posting_lists(t):
    """Parts of at most 50 entries are ranges of documents in order."""
    lists = index.posting_lists(full_index(t), max_postings=50)
    entry = F.transform("postings", lambda p: F.concat_ws(":", p["doc"], p["tf"]))
    return lists.select("term", "part", F.array_join(entry, ", ").alias("entries"))


@query(f"SELECT term, doc, tf FROM {_INDEX} WHERE term = 'license'")
def term_lookup(t):
    path = scratch_path(t.spark, "index")
    writers.write_index(full_index(t), path)
    return index.find_term(t.spark.read.parquet(path), "license")


@query(f"""SELECT doc, count(*) AS tokens, count(*) FILTER (term IN (SELECT term FROM {_STOP})) AS stop_tokens,
             count(*) FILTER (term IN (SELECT term FROM {_STOP})) / count(*) AS stop_ratio
           FROM {_TOKENS} WHERE term <> '' GROUP BY doc
           UNION ALL SELECT doc_id, 0, 0, NULL FROM documents
           WHERE doc_id NOT IN (SELECT doc FROM {_TOKENS} WHERE term <> '')""")
def stop_word_ratio(t):
    return index.stop_share(texts(t), stop(t), "doc_id", "text")


@query(r"""SELECT conv_id, turn, line FROM (SELECT conv_id, turn,
             unnest(string_split(text, chr(10))) AS line FROM conversations)
           WHERE regexp_matches(line, '\S')""")
def non_blank_lines(t):
    lines = t.conversations.select("conv_id", "turn", F.explode(F.split("text", "\n")).alias("line"))
    return filters.non_blank(lines, "line")


@query(f"SELECT term, CAST(sum(tf) AS BIGINT) AS tf FROM {_INDEX} GROUP BY term")
def text_collection_terms(t):
    """Texts written as plain files, read back line by line with their file name."""
    path = scratch_path(t.spark, "texts")
    t.documents.select("text").write.text(path)
    counted = index.build_index(readers.read_documents(t.spark, path), stop=stop(t))
    return counted.groupBy("term").agg(F.sum("tf").alias("tf"))


@query(f"SELECT term || ' --> ' || entries AS line FROM {_LISTS}")
def index_text_sink(t):
    path = scratch_path(t.spark, "index-text")
    writers.write_index_text(index.posting_lists(full_index(t)), path)
    return t.spark.read.text(path).withColumnRenamed("value", "line")
