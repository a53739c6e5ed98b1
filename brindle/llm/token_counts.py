"""Token counts by two tiers of pre-token lengths, without shuffling pre-tokens.

Tier one is a table of the most frequent pre-tokens and the number of tokens each gives,
of a fixed size, broadcast to the workers. Tier two is a bounded cache in every Python
worker: pre-tokens that the table lacks are encoded once by the library and kept. The
table comes from all documents: each task keeps a bounded summary of its own pre-tokens
and hands on at most ``PER_TASK`` of them, which are summed. It changes the speed only;
counts are exact whatever it holds.
"""

from __future__ import annotations

import json
import os
import re
import uuid
from collections import Counter
from itertools import filterfalse

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brindle.llm.batches import column, each_batch, hold, map_batches, record_batch, strings

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

import regex  # noqa: E402
from tokenizers import Tokenizer, pre_tokenizers  # noqa: E402

#: Pre-tokens in the broadcast table (at most ``LONGEST`` characters each: under 4 MB), pre-tokens that a
#: task hands on, entries of a worker's cache.
TABLE, PER_TASK, CACHE, LONGEST = 32_768, 8_192, 400_000, 32

# The pattern by which byte-level vocabularies of this kind cut texts.
_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
# Characters on whose class all Unicode versions agree; a text with any other goes to the library whole.
_UNUSUAL = re.compile("[^\t\n\r -~\xa1-˿Α-ΡΣ-ωЀ-ӿ‐-‧‰-⁞"
                      "€、-〃ぁ-ゖァ-ヺ一-龥]")


class Counts:
    """Lengths of pre-tokens for one tokenizer file."""

    def __init__(self, path: str):
        self.full = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        cut = spec.get("pre_tokenizer") or {}
        added = spec["added_tokens"]
        self.by_piece = (spec.get("normalizer") is None and cut.get("type") == "ByteLevel"
                         and cut.get("use_regex") and not cut.get("add_prefix_space")
                         and not spec.get("post_processor") and not spec.get("truncation")
                         and not any(t["single_word"] or t["lstrip"] or t["rstrip"] for t in added))
        self.special = re.compile("|".join(re.escape(t["content"]) for t in added)) if added else None
        self.find = regex.compile(_PATTERN).findall
        self.bare = Tokenizer.from_file(path)
        self.bare.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.table: dict[str, int] = {}
        self.known: dict[str, int] = {}

    def pieces(self, text: str) -> tuple[list[str], int] | None:
        """Pre-tokens and the number of special tokens; None if only the library may cut the text."""
        if not self.by_piece or _UNUSUAL.search(text):
            return None
        if self.special and self.special.search(text):
            parts = self.special.split(text)
            return [p for part in parts for p in self.find(part)], len(parts) - 1
        return self.find(text), 0

    def use(self, table: dict[str, int]) -> None:
        if self.table is not table:
            self.table, self.known = table, dict(table)

    def count(self, texts: list[str]) -> list[int]:
        out = [0] * len(texts)
        cut = []
        for i, text in enumerate(texts):
            found = self.pieces(text)
            if found is None:
                out[i] = len(self.full.encode(text, add_special_tokens=False).ids)
            else:
                cut.append((i, *found))
        if len(self.known) > len(self.table) + CACHE:
            self.known = dict(self.table)
        unseen: set[str] = set()
        for _, found, _ in cut:
            unseen.update(filterfalse(self.known.__contains__, found))
        missing = list(unseen)
        coded = self.bare.encode_batch_fast(missing, add_special_tokens=False) if missing else []
        self.known.update(zip(missing, (len(e.ids) for e in coded)))
        get = self.known.__getitem__
        for i, found, extra in cut:
            out[i] = sum(map(get, found)) + extra
        for piece in missing:
            if len(piece) > 2 * LONGEST:
                del self.known[piece]
        return out


_COUNTS: dict[str, Counts] = {}
_TABLES: dict[str, dict[str, int]] = {}


def _counts(path: str) -> Counts:
    hold("token_counts", _COUNTS.clear)
    if path not in _COUNTS:
        _COUNTS[path] = Counts(path)
    return _COUNTS[path]


def _table(key: str, shared) -> dict[str, int]:
    """The worker's table, made once from the broadcast. A module's function, so that all tasks share it."""
    if key not in _TABLES:
        joined, sizes = shared.value
        _TABLES.clear()
        _TABLES[key] = dict(zip(joined.split("\0"), sizes)) if sizes else {}
    return _TABLES[key]


def frequent_pieces(docs: DataFrame, tokenizer: str, text_col: str = "text") -> DataFrame:
    """(piece, n): the ``TABLE`` most frequent pre-tokens of all documents, from bounded summaries per task."""
    schema = pa.schema([("piece", pa.string()), ("n", pa.int64())])

    def summarize(batches):
        seen: Counter[str] = Counter()
        for batch in batches:
            counts = _counts(tokenizer)
            for text in strings(batch, "text"):
                found = counts.pieces(text)
                if found:
                    seen.update(found[0])
                if len(seen) > CACHE:
                    seen = Counter(dict(seen.most_common(CACHE // 4)))
        top = [(p, n) for p, n in seen.most_common(2 * PER_TASK) if n > 1 and len(p) <= LONGEST][:PER_TASK]
        yield record_batch(schema, [p for p, _ in top], [n for _, n in top])

    found = map_batches(docs.select(F.col(text_col).alias("text")), "piece string, n long", summarize)
    return found.groupBy("piece").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "piece").limit(TABLE)


def count_tokens(docs: DataFrame, tokenizer: str, limit: int = 512, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """doc_id, n_bytes (UTF-8), n_tokens and over_limit (n_tokens > ``limit``) of every row.

    Counts are those of the library without added special tokens. A null text counts as
    empty (0 bytes, 0 tokens); repeated rows give repeated rows; a null doc_id stays null;
    an empty table gives no rows; other columns are ignored.
    """
    spark = docs.sparkSession
    pieces = [r.piece for r in frequent_pieces(docs, tokenizer, text_col).collect()]
    lengths = bytes(min(255, n) for n in _counts(tokenizer).count(pieces)) if pieces else b""
    shared = spark.sparkContext.broadcast(("\0".join(pieces), lengths))
    key = uuid.uuid4().hex
    schema = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_tokens", pa.int64()),
                        ("over_limit", pa.bool_())])

    def work(batch):
        counts = _counts(tokenizer)
        counts.use(_table(key, shared))
        texts = strings(batch, "text")
        n = [c for at in range(0, len(texts), 256) for c in counts.count(texts[at:at + 256])]
        return record_batch(schema, batch.column("doc_id"), column(batch, "n_bytes"), n, [c > limit for c in n])

    return each_batch(
        docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"),
                    F.coalesce(F.octet_length(text_col), F.lit(0)).cast("long").alias("n_bytes")),
        "doc_id long, n_bytes long, n_tokens long, over_limit boolean", work)
