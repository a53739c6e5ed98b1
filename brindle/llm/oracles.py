"""DuckDB SQL of the operators' queries that SQL can express."""

from __future__ import annotations

#: Levels of a tree of 8 children each that the SQL has: for up to 8 ** 8 rows a language and 8 ** 4 languages.
LEAF_LEVELS, TREE_LEVELS = 8, 4

_CRC = """crc_table AS (
  SELECT list_transform(range(256), lambda i: list_reduce(list_concat([i], range(8)),
    lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t)"""
_CRC_OF_ID = """xor(list_reduce(
    list_concat([4294967295], list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT))),
    lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295)"""


def _field(name: str) -> str:
    return f"coalesce(strlen(CAST({name} AS VARCHAR)) || ':' || CAST({name} AS VARCHAR), '-')"


def _levels(first: str, name: str, groups: str, count: int) -> list[str]:
    """Levels ``name``0, ``name``1, ...: every node with the digests left and right of it in its run of eight."""
    out, source = [], first
    for k in range(count):
        run = f"PARTITION BY {groups}, pos >> 3 ORDER BY pos"
        out.append(f"""{name}{k} AS (
  SELECT *, coalesce(string_agg(digest, '') OVER ({run} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l,
         coalesce(string_agg(digest, '') OVER ({run} ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r
  FROM {source})""")
        out.append(f"""{name}{k}_up AS (
  SELECT {groups}, pos >> 3 AS pos, (size + 7) >> 3 AS size,
         CASE WHEN size = 1 THEN max(digest) ELSE sha256(string_agg(digest, '' ORDER BY pos)) END AS digest
  FROM {name}{k} GROUP BY {groups}, pos >> 3, size)""")
        source = f"{name}{k}_up"
    return out


def _folds(start: str, name: str, level: str, match: str, count: int, at: str) -> list[str]:
    """From the leaves up: the proof's text and the digest folded with each level's siblings."""
    out, source = [], start
    for k in range(count):
        out.append(f"""{name}{k} AS (
  SELECT s.* EXCLUDE (proof, folded), proof || l || r AS proof,
         CASE WHEN n.size = 1 THEN folded ELSE sha256(l || folded || r) END AS folded
  FROM {source} s JOIN {level}{k} n ON {match} AND n.pos = (s.{at} >> {3 * k}))""")
        source = f"{name}{k}"
    return out


def merkle() -> str:
    last, top = LEAF_LEVELS - 1, TREE_LEVELS - 1
    parts = [_CRC, f"""hashed AS (
  SELECT doc_id, coalesce('=' || lang, '') AS tree,
         sha256({_field('doc_id')} || {_field('source')} || {_field('lang')} || {_field('n_chars')} || {_field('text')}) AS digest,
         CASE WHEN {_CRC_OF_ID} % 3 = 0
              THEN sha256({_field('doc_id')} || {_field('source')} || {_field('lang')} || {_field('n_chars')} ||
                          {_field("translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")}) END AS changed
  FROM documents, crc_table)""", """leaves AS (
  SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, digest) - 1 AS pos,
         count(*) OVER (PARTITION BY tree) AS size
  FROM hashed)""",
             *_levels("leaves", "n", "tree", LEAF_LEVELS),
             f"""subroots AS (
  SELECT 0 AS one, tree, digest, row_number() OVER (ORDER BY encode(tree)) - 1 AS pos, count(*) OVER () AS size
  FROM n{last}_up)""",
             *_levels("subroots", "t", "one", TREE_LEVELS),
             """f AS (SELECT doc_id, tree, digest AS leaf, pos, '' AS proof, coalesce(changed, digest) AS folded FROM leaves)""",
             *_folds("f", "p", "n", "n.tree = s.tree", LEAF_LEVELS, "pos"),
             f"""upper_start AS (
  SELECT p.*, s.pos AS tree_at, s.digest AS subroot FROM p{last} p JOIN subroots s ON s.tree = p.tree)""",
             *_folds("upper_start", "u", "t", "true", TREE_LEVELS, "tree_at")]
    return "WITH " + ",\n".join(parts) + f"""
SELECT doc_id, leaf, subroot, root, sha256(proof) AS proof_sha256, folded AS folded_root, folded = root AS verified
FROM u{top}, (SELECT digest AS root FROM t{top}_up)"""


HARD_NEGATIVES = """WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS q
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same,
         CAST(list_inner_product(a.q, b.q) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
p AS (
  SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5)
SELECT p.anchor_id, positive_id,
       CAST(row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, other_id) AS INTEGER) AS rank,
       other_id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT same
  AND 80 * positive_score <= 100 * score AND 100 * score <= 100 * positive_score
QUALIFY row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, other_id) <= 5"""
