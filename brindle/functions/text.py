"""Tokenizer and posting-line formatting."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values. (?U) makes \s cover Unicode white space such as the no-break space.
ASCII_DROP = r"(?U)[^a-z0-9\s]"
UNICODE_DROP = r"(?U)[^\p{L}\p{N}\s]"
SPACES = r"(?U)\s+"
HEAD_SEPARATOR = " --> "
ENTRY_SEPARATOR = ", "


def cleaned(text: Column, *, unicode: bool = False) -> Column:
    """Lowercase and delete (not space out) every other character.

    The default keeps a-z and 0-9 only, so "well-known" becomes "wellknown" and
    accented letters vanish; ``unicode=True`` keeps letters and digits of any script.
    """
    return F.regexp_replace(F.lower(text), UNICODE_DROP if unicode else ASCII_DROP, "")


def tokens(text: Column, *, unicode: bool = False) -> Column:
    """Array of the non-empty tokens of ``text``, in order."""
    return F.filter(F.split(cleaned(text, unicode=unicode), SPACES), lambda t: t != "")


def posting_line(term: Column, postings: Column) -> Column:
    """``term --> doc:tf, doc:tf`` from an array of ``struct(doc, tf)``."""
    entries = F.transform(postings, lambda p: F.concat_ws(":", p["doc"].cast("string"),
                                                          p["tf"].cast("string")))
    return F.concat(term, F.lit(HEAD_SEPARATOR), F.array_join(entries, ENTRY_SEPARATOR))
