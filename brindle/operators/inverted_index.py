"""Inverted index over a text collection: counts, posting lists, lookups.

The index proper is the long table (term, doc, tf). Posting lists are derived from
it and split into parts once a term occurs in more documents than one row should
hold, so no list ever has to fit into one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brindle.functions.stopwords import ENGLISH
from brindle.functions.text import SPACES, cleaned, posting_line, tokens
from brindle.operators.joins import broadcast_join, excluding
from brindle.operators.ordering import dense_ids
from brindle.session import as_table

MAX_POSTINGS = 100_000

#: Entries of a term up to which they are gathered first and then cut into parts; at 32 bytes an entry.
MAX_GATHERED = 1_000_000


def tokenize(docs: DataFrame, doc: str = "doc", text: str = "line", *,
             unicode: bool = False) -> DataFrame:
    """One row (doc, term) per token. Blank lines and nameless documents yield nothing."""
    named = docs.where(F.col(doc).isNotNull() & (F.trim(F.col(doc).cast("string")) != ""))
    words = F.split(cleaned(F.col(text), unicode=unicode), SPACES)
    return named.select(F.col(doc).alias("doc"), F.explode(words).alias("term")).where(F.col("term") != "")


def stop_terms(words: DataFrame, *, raw: bool = False, unicode: bool = False) -> DataFrame:
    """Distinct stop terms from a word list (column ``word``).

    Words pass the tokenizer's cleaning, so "don't" also stops the token "dont";
    ``raw=True`` compares the words as written.
    """
    term = F.lower(F.trim("word"))
    if not raw:
        term = cleaned(term, unicode=unicode)
    return words.select(term.alias("term")).where(F.col("term") != "").distinct()


def english_stop_words(spark) -> DataFrame:
    """The built-in list as a word table."""
    return spark.createDataFrame([(w,) for w in ENGLISH], "word string")


def term_counts(terms: DataFrame) -> DataFrame:
    """Index table (term, doc, tf); tokens collapse to counts before the exchange."""
    return terms.groupBy("term", "doc").agg(F.count(F.lit(1)).alias("tf"))


def build_index(docs: DataFrame, doc: str = "doc", text: str = "line", *,
                stop: DataFrame | None = None, unicode: bool = False) -> DataFrame:
    """Tokenize, drop stop terms and count: (term, doc, tf).

    Where rows are whole documents, deal them out by ``doc`` first (:func:`readers.dealt`): then every task has all
    of its documents' tokens, and the text is shuffled in place of the longer index.
    """
    terms = tokenize(docs, doc, text, unicode=unicode)
    if stop is not None:
        terms = excluding(terms, stop, "term")
    return term_counts(terms)


def posting_lists(index: DataFrame, *, max_postings: int = MAX_POSTINGS,
                  stored: bool = False) -> DataFrame:
    """Rows (term, part, postings) with ``postings`` sorted by document.

    A term's parts are ranges of documents in order, each with at most ``max_postings`` entries
    and all full but the last; a term in at most that many documents has the single part 0. The entries
    of terms in more than ``MAX_GATHERED`` documents are sorted over all tasks to find their places; those
    of others are gathered and cut. The index is written first unless it is ``stored`` already.
    """
    index = index if stored else as_table(index, "index")
    frequent = as_table(index.groupBy("term").agg(F.count(F.lit(1)).alias("df"))
                        .where(F.col("df") > max_postings), "frequent-terms")
    if frequent.isEmpty():
        return _gathered(index.withColumn("part", F.lit(0).cast("long")), "term", "part")
    hot = as_table(frequent.where(F.col("df") > max(max_postings, MAX_GATHERED)).select("term"), "hot-terms")
    if hot.isEmpty():
        return _cut(_gathered(index, "term"), max_postings)
    flagged = broadcast_join(index, hot.withColumn("__hot", F.lit(True)), "term", "left")
    numbered = dense_ids(flagged.where("__hot").drop("__hot"), "term", "doc", out="__at")
    starts = as_table(numbered.groupBy("term").agg(F.min("__at").alias("__start")), "term-starts")
    part = F.floor((F.col("__at") - F.col("__start")) / F.lit(max_postings))
    ranged = broadcast_join(numbered, starts, "term").withColumn("part", part).drop("__at", "__start")
    few = flagged.where("__hot is null").drop("__hot")
    return _cut(_gathered(few, "term"), max_postings).unionByName(_gathered(ranged, "term", "part"))


def _gathered(entries: DataFrame, *keys: str) -> DataFrame:
    return entries.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct("doc", "tf"))).alias("postings"))


def _cut(lists: DataFrame, max_postings: int) -> DataFrame:
    """One row per part of each list."""
    last = F.floor((F.size("postings") - 1) / F.lit(max_postings))
    pieces = F.transform(F.sequence(F.lit(0).cast("long"), last), lambda part: F.struct(
        part.alias("part"), F.slice("postings", (part * max_postings + 1).cast("int"), max_postings).alias("postings")))
    return lists.select("term", F.inline(pieces))


def index_lines(lists: DataFrame) -> DataFrame:
    """Text form: ``term --> doc:tf, doc:tf``; a term has one line per part, so at least one."""
    return lists.select("term", "part", posting_line(F.col("term"), F.col("postings")).alias("line"))


def find_term(index: DataFrame, term: str) -> DataFrame:
    """Entries of one term; on a term-sorted table the filter prunes row groups."""
    return index.where(F.col("term") == F.lit(term))


def first_terms(index: DataFrame, k: int = 20) -> DataFrame:
    """The first ``k`` terms that do not start with a digit."""
    return index.where(~F.col("term").rlike("^[0-9]")).select("term").distinct().orderBy("term").limit(k)


def preview(index: DataFrame, k: int = 20, **lists) -> DataFrame:
    """Posting lists, in all their parts, of the first ``k`` terms that do not start with a digit.

    Terms are chosen before any list is built.
    """
    chosen = as_table(first_terms(index, k), "first-terms")
    few = index.join(F.broadcast(chosen), "term", "left_semi")
    return posting_lists(few, **lists).orderBy("term", "part")


def stop_share(docs: DataFrame, stop: DataFrame, doc: str = "doc", text: str = "line", *,
               unicode: bool = False) -> DataFrame:
    """Per document: tokens, stop tokens and their share (null without tokens)."""
    terms = docs.select(F.col(doc).alias("doc"),
                        F.explode_outer(tokens(F.col(text), unicode=unicode)).alias("term"))
    flags = stop.select("term", F.lit(True).alias("is_stop"))
    counts = broadcast_join(terms, flags, "term", "left").groupBy("doc").agg(
        F.count("term").alias("tokens"), F.count("is_stop").alias("stop_tokens"))
    return counts.withColumn("stop_ratio",
                             F.try_divide(F.col("stop_tokens").cast("double"), "tokens"))
