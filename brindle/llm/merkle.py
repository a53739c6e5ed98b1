"""Merkle manifest of a table: a hash tree for every language, a tree over the languages, proofs for all rows.

All of it is DataFrame functions. Rows get their place in a tree from a sort that is spread over all tasks. A
*slot pivot* builds a level: conditional aggregates spread the children of a parent into ``FANOUT`` columns, one for
each slot; the concatenated columns are the parent's input, and the columns without the own slot are a child's
siblings. Proofs go down the same tables, so that a level's siblings are joined to a parent once and not to each row
below it. Levels shrink by ``FANOUT``; each is written to the shared folder, so lineage stays short.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brindle.operators.joins import broadcast_join
from brindle.operators.ordering import dense_ids
from brindle.session import as_table

FANOUT = 8
#: Columns of a document that its leaf covers, in this order.
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")

_SLOTS = [f"c{slot}" for slot in range(FANOUT)]
_PATH = "array<struct<left:string,right:string>>"


def ascii_lower(column: str | Column) -> Column:
    """The text with A to Z, and no other letter, in lower case."""
    return F.translate(column if isinstance(column, Column) else F.col(column),
                       string.ascii_uppercase, string.ascii_lowercase)


def leaf_hash(fields: list[Column]) -> Column:
    """Hex sha256 of the fields, each as ``-`` if null, else as byte count, ``:`` and value."""
    texts = [field.cast("string") for field in fields]
    parts = [F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]
    return F.sha2(F.concat(*parts), 256)


def _digest() -> Column:
    return F.sha2(F.concat_ws("", *_SLOTS), 256)


def _pivot(nodes: DataFrame, extra: tuple[str, ...] = ()) -> DataFrame:
    """Nodes (tree, size, at, digest) as one row a parent: the digest of the child in each slot, and its ``extra``."""
    slot = F.col("at") % FANOUT
    spread = [F.max(F.when(slot == i, F.col(source))).alias(f"{short}{i}")
              for short, source in [("c", "digest"), *((name, name) for name in extra)] for i in range(FANOUT)]
    return nodes.groupBy("tree", "size", F.floor(F.col("at") / FANOUT).alias("parent")).agg(*spread)


def _climb(leaves: DataFrame, largest: int, extra: tuple[str, ...] = ()) -> list[DataFrame]:
    """Stored levels from the leaves up, until every tree has one node left. ``largest``: leaves of the largest tree."""
    levels = [as_table(_pivot(leaves, extra), "slots")]
    largest = -(-largest // FANOUT)
    while largest > 1:
        up = levels[-1].where("size > 1").select(
            "tree", F.ceil(F.col("size") / FANOUT).alias("size"), F.col("parent").alias("at"), _digest().alias("digest"))
        levels.append(as_table(_pivot(up.where("size > 1")), "slots"))
        largest = -(-largest // FANOUT)
    return levels


def _roots(levels: list[DataFrame]) -> DataFrame:
    """(tree, digest) of the trees' roots; the leaf of a tree of one leaf is its root."""
    tops = [level.where(f"size <= {FANOUT}").select("tree", F.when(F.col("size") == 1, F.col("c0")).otherwise(_digest())
                                                    .alias("digest")) for level in levels]
    found = tops[0]
    for top in tops[1:]:
        found = found.unionByName(top)
    return found


def _children(rows: DataFrame, keep: list[str], extra: tuple[str, ...] = ()) -> DataFrame:
    """One row for each child: tree, its place, digest, ``extra`` and its path, the own siblings first."""
    def child(slot: int) -> Column:
        siblings = F.struct(F.concat_ws("", *_SLOTS[:slot]).alias("left") if slot else F.lit("").alias("left"),
                            F.concat_ws("", *_SLOTS[slot + 1:]).alias("right") if slot + 1 < FANOUT
                            else F.lit("").alias("right"))
        here = F.when(F.col("size") == 1, F.col("path")).otherwise(F.concat(F.array(siblings), "path"))
        return F.struct((F.col("parent") * FANOUT + slot).alias("at"), F.col(f"c{slot}").alias("digest"),
                        here.alias("path"), *(F.col(f"{name}{slot}").alias(name) for name in extra))
    spread = rows.select("tree", *keep, F.explode(F.array(*map(child, range(FANOUT)))).alias("child"))
    return spread.where("child.digest is not null").select("tree", *keep, "child.*")


def _descend(levels: list[DataFrame], roots: DataFrame, keep: list[str], extra: tuple[str, ...] = ()) -> DataFrame:
    """The leaves with the siblings on their way to the root, as ``path``, in front of the path that ``roots``
    (tree, path and ``keep``) has for their tree."""
    below = None
    for number in reversed(range(len(levels))):
        level = levels[number]
        ways = level.where(f"size <= {FANOUT}").select("tree", "parent").join(roots, "tree")
        if below is not None:
            ways = ways.unionByName(below.select("tree", F.col("at").alias("parent"), "path", *keep))
        rows = level.join(ways, ["tree", "parent"])
        below = _children(rows, keep, extra if number == 0 else ())
    return below


def manifest(docs: DataFrame, now: dict[str, Column] | None = None, tree: str = "lang",
             fields: tuple[str, ...] = FIELDS, id_col: str = "doc_id") -> DataFrame:
    """doc_id, leaf, subroot, root, siblings, proof_sha256, folded_root and verified for every row.

    The leaves of a tree (rows of one ``tree`` value) ascend by id; runs of ``FANOUT`` nodes become their hash until
    one is left, the subroot; subroots, ordered by that value, likewise give the root. ``now`` replaces columns
    by what is found at the time of a check: ``folded_root`` is recomputed from that leaf and the original
    siblings, and ``verified`` says whether it is the root. ``siblings`` are the texts left and right of the node at
    each level.

    Nulls: a null field has a mark of its own in the leaf, rows without id come first, rows without ``tree`` value
    are a tree of their own, the first. Repeated ids ascend by their leaves, and repeated rows are a leaf each. Empty
    and very long texts are hashed whole. An empty table gives no rows. Other columns, whatever their names, are ignored.
    """
    found = [(now or {}).get(field, F.col(field)) for field in fields]
    own = leaf_hash([F.col(field) for field in fields])
    leaves = as_table(docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.col(tree).cast("string").alias("name"),
        own.alias("digest"), *([leaf_hash(found).alias("seen")] if now else [])), "leaves")
    if not now:
        leaves = leaves.withColumn("seen", F.col("digest"))
    # Equal rows are parted by their place in the scan, so that copies spread over the tasks of the sort.
    leaves = leaves.withColumn("copy", F.monotonically_increasing_id())
    sorted_leaves = dense_ids(leaves, "name", "doc_id", "digest", "copy", out="row")

    # A tree's name with a mark, because null names are joined too.
    named = sorted_leaves.withColumn("tree", F.coalesce(F.concat(F.lit("="), "name"), F.lit("")))
    trees = as_table(named.groupBy("tree").agg(F.min("row").alias("first"), F.count(F.lit(1)).alias("size")), "trees")
    many, largest = trees.agg(F.count(F.lit(1)), F.max("size")).first()
    placed = broadcast_join(named, trees, "tree").withColumn("at", F.col("row") - F.col("first"))
    extra = ("doc_id", "seen")
    levels = _climb(placed, largest or 0, extra)

    # The tree over the trees; the mark of null sorts first.
    tops = dense_ids(as_table(_roots(levels), "subroots"), "tree", out="at").withColumnRenamed("tree", "name")
    upper = _climb(tops.select(F.lit("").alias("tree"), F.lit(many).cast("long").alias("size"), "at", "digest", "name"),
                   many, ("name",))
    start = _roots(upper).select("tree", F.array().cast(_PATH).alias("path"), F.col("digest").alias("root"))
    subroots = _descend(upper, start, ["root"], ("name",)).select(
        F.col("name").alias("tree"), "path", "root", F.col("digest").alias("subroot"))
    subroots = as_table(subroots, "subroot-paths")

    rows = _descend(levels, subroots, ["subroot", "root"], extra)
    folded = F.aggregate("path", F.col("seen"),
                         lambda digest, level: F.sha2(F.concat(level.left, digest, level.right), 256))
    proof = F.sha2(F.array_join(F.transform("path", lambda level: F.concat(level.left, level.right)), ""), 256)
    return rows.select("doc_id", F.col("digest").alias("leaf"), "subroot", "root", F.col("path").alias("siblings"),
                       proof.alias("proof_sha256"), folded.alias("folded_root")).withColumn(
        "verified", F.col("folded_root") == F.col("root"))
