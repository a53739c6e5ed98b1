"""Piece encoding against the library, the Merkle manifest and hard negatives against brute force."""

import hashlib
import math
import random
import string
import zlib

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from brindle.llm import hard_negatives, merkle, piece_bpe

SMALL = "/root/testdata/sf0.001"
MODEL = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def model():
    return piece_bpe.Model(MODEL)


@pytest.fixture(scope="module")
def library():
    return piece_bpe.library(MODEL)


# ---- pieces ------------------------------------------------------------------------------

@settings(max_examples=400, deadline=None)
@given(text=st.one_of(st.text(max_size=40),
                      st.text(alphabet="aabcdeeethions  ▁.,\n\t\0é中😀ß01", max_size=60)))
def test_ids_and_text_of_the_library(model, library, text):
    ids = model.encode(text)
    assert ids == library.encode(text)
    assert model.decode_batch(pa.array([ids], pa.list_(pa.int32()))) == [library.decode(ids)]


def test_runs_of_spaces_and_of_one_letter(model, library):
    for n in range(70):
        for text in (" " * n, "a" + " " * n + "b", "a" * n, " " * n + "the", "▁" * n, "\n" * n, "=" * n):
            assert model.encode(text) == library.encode(text)


def test_long_texts_without_spaces(model, library):
    rng = random.Random(3)
    for alphabet in ("ab", "abcdefghijklmnop", "中文字é"):
        text = "".join(rng.choice(alphabet) for _ in range(20_000))
        assert model.encode(text) == library.encode(text)


def test_neighbours_are_compatible_if_merging_them_keeps_them(model):
    rng = random.Random(4)
    words = [w for w in model.ids if "  " not in w]
    for _ in range(4000):
        left, right = rng.choice(words), rng.choice(words)
        assert model.compatible(left, right) == (model.merge(left + right) == [left, right]), (left, right)


def test_walk_steps_back(model):
    """The pieces come from the walk: it meets dead ends, and gives what merging the whole text gives."""
    rng = random.Random(5)
    words = [w for w in model.ids if " " not in w and len(w) > 2]
    greedy = 0
    for _ in range(500):
        text = "".join(rng.choice(words) for _ in range(5))
        found = model.walk(text)
        assert found == model.merge(text)
        at, plain = 0, []
        while at < len(text):
            plain.append(max((text[at:n] for n in range(at + 1, min(len(text), at + 16) + 1) if text[at:n] in model.ids), key=len))
            at += len(plain[-1])
        greedy += plain != found
    assert greedy > 50


@settings(max_examples=200, deadline=None)
@given(ids=st.lists(st.one_of(st.integers(0, 31999), st.integers(0, 258)), max_size=12))
def test_any_ids_decode_as_in_the_library(model, library, ids):
    assert model.decode_batch(pa.array([ids], pa.list_(pa.int32()))) == [library.decode(ids)]


def test_encoding_a_table(spark, table, library):
    texts = [(1, "the cat"), (1, "the cat"), (2, None), (None, ""), (3, "x" * 50_000 + " \n"), (4, "  two  spaces ")]
    rows = table(texts)
    coded = piece_bpe.encode(rows, MODEL)
    assert coded.columns == ["doc_id", "ids"]
    got = sorted(((r.doc_id, tuple(r.ids)) for r in coded.collect()), key=repr)
    assert got == sorted(((i, (*library.encode(t or ""), 2)) for i, t in texts), key=repr)
    back = piece_bpe.decode(coded.withColumn("decoded", F.lit(1)).withColumn("key", F.lit(2)), MODEL)
    assert sorted(r.decoded for r in back.collect()) == sorted(library.decode(library.encode(t or "")) for _, t in texts)
    assert piece_bpe.encode(rows.limit(0), MODEL).count() == 0
    empty = spark.createDataFrame([(None,), ([],)], "ids array<int>")
    assert sorted((r.decoded for r in piece_bpe.decode(empty, MODEL).collect()), key=repr) == ["", None]


def test_the_whole_table_comes_back(spark, library):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    rows = piece_bpe.decode(piece_bpe.encode(docs, MODEL), MODEL).collect()
    assert len(rows) == len(texts)
    for row in rows:
        assert row.ids == [*library.encode(texts[row.doc_id]), 2]
        assert row.decoded == texts[row.doc_id]


# ---- Merkle ------------------------------------------------------------------------------

def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row):
    return sha(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def root_and_proofs(digests):
    """The root and, for each leaf, (left, right) of its siblings by level."""
    paths, level, at = [[] for _ in digests], list(digests), list(range(len(digests)))
    while len(level) > 1:
        runs = [level[i:i + 8] for i in range(0, len(level), 8)]
        for n, p in enumerate(at):
            run = runs[p // 8]
            paths[n].append(("".join(run[:p % 8]), "".join(run[p % 8 + 1:])))
        at = [p // 8 for p in at]
        level = [sha(*run) for run in runs]
    return level[0], paths


def brute_manifest(rows, changed):
    """rows: (doc_id, source, lang, n_chars, text)."""
    groups = {}
    for row, new in zip(rows, changed):
        groups.setdefault(row[2], []).append((row, leaf(row), leaf(new)))
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    subroots, inner = [], {}
    for name in order:
        groups[name].sort(key=lambda x: (x[0][0] is not None, x[0][0] or 0, x[1]))
        top, paths = root_and_proofs([x[1] for x in groups[name]])
        subroots.append(top)
        inner[name] = paths
    root, outer = root_and_proofs(subroots) if subroots else (None, [])
    out = []
    for n, name in enumerate(order):
        for (row, own, now), path in zip(groups[name], inner[name]):
            steps, folded = path + outer[n], now
            for left, right in steps:
                folded = sha(left, folded, right)
            out.append((row[0], own, subroots[n], root, sha(*(a + b for a, b in steps)), folded, folded == root))
    return sorted(out, key=repr)


def lowered(row):
    if row[0] is None or zlib.crc32(str(row[0]).encode()) % 3 or row[4] is None:
        return row
    return (*row[:4], row[4].translate(str.maketrans(string.ascii_uppercase, string.ascii_lowercase)))


@pytest.mark.parametrize("many,langs", [(0, 1), (1, 1), (8, 1), (9, 2), (75, 3), (400, 30)])
def test_manifest(spark, many, langs):
    rng = random.Random(many)
    names = [None, "en", "é", "z", *(f"l{n}" for n in range(40))][:langs]
    rows = []
    for n in range(many):
        rows.append((rng.choice([n, n, n, None, 5, -n]), rng.choice(["s", None]), rng.choice(names), rng.choice([n, None]),
                     rng.choice([None, "", "AÉb", "plain", "X" * 5000])))
    rows += rows[:3]
    frame = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string")
    for clash in ("tree", "at", "size", "path", "c0", "row", "name"):
        frame = frame.withColumn(clash, F.lit("x"))
    chosen = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    found = F.when(chosen, merkle.ascii_lower("text")).otherwise(F.col("text"))
    got = merkle.manifest(frame, now={"text": found})
    cols = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    assert sorted((tuple(r[c] for c in cols) for r in got.collect()), key=repr) == brute_manifest(rows, list(map(lowered, rows)))


def test_untouched_rows_verify(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    got = merkle.manifest(docs)
    assert got.where("verified").count() == docs.count() == got.where("size(siblings) >= 2").count()


# ---- hard negatives ----------------------------------------------------------------------

def brute_negatives(rows, anchors, k=5):
    clean = [(i, v, [math.floor(256 * x) for x in e]) for i, e, v in rows
             if i is not None and v is not None and e is not None and all(x is not None and math.isfinite(x) for x in e)]
    out = set()
    for a, label, q in clean:
        if a not in anchors:
            continue
        others = sorted(((-sum(x * y for x, y in zip(q, p)), i, v) for i, v, p in clean if i != a))
        for s, positive, _ in [o for o in others if o[2] == label][:k]:
            near = [o for o in others if o[2] != label and -80 * s <= -100 * o[0] <= -100 * s][:k]
            out |= {(a, positive, n + 1, o[1], -s, -o[0]) for n, o in enumerate(near)}
    return sorted(out)


COLUMNS = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]


@pytest.mark.parametrize("dims,block,anchors", [(2, 16, 4), (8, 64, 512), (64, 4096, 512)])
def test_negatives(spark, monkeypatch, dims, block, anchors):
    """Clustered vectors, many equal scores, rows that take no part, blocks smaller than the table."""
    rng = random.Random(dims)
    centres = [[rng.uniform(-1, 1) for _ in range(dims)] for _ in range(4)]
    rows = []
    for n in range(300):
        vector = [c + rng.choice([0, 0.01, 0.2]) * rng.uniform(-1, 1) for c in rng.choice(centres)]
        if n % 41 == 0:
            vector[rng.randrange(dims)] = rng.choice([None, math.nan, math.inf, -math.inf])
        rows.append((n, None if n % 43 == 0 else vector, None if n % 47 == 1 else rng.randrange(3)))
    rows.append((None, [0.5] * dims, 1))
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    for clash in ("anchor", "id", "q", "score", "window", "place", "block"):
        frame = frame.withColumn(clash, F.lit("x"))
    monkeypatch.setattr(hard_negatives, "BLOCK", block)
    monkeypatch.setattr(hard_negatives, "ANCHORS", anchors)
    monkeypatch.setattr(hard_negatives, "WAVE", 2)
    got = hard_negatives.mine(frame, F.col("vec_id") % 10 == 3)
    want = brute_negatives(rows, set(range(3, 300, 10)))
    assert sorted(tuple(r[c] for c in COLUMNS) for r in got.collect()) == want
    assert want


def test_negatives_of_odd_tables(spark):
    ddl = "vec_id long, embedding array<double>, label int"
    anchor = F.col("vec_id") == 0
    assert hard_negatives.mine(spark.createDataFrame([], ddl), anchor).count() == 0
    assert hard_negatives.mine(spark.createDataFrame([(1, [1.0], 1)], ddl), anchor).count() == 0
    assert hard_negatives.mine(spark.createDataFrame([(0, [], 1)], ddl), anchor).count() == 0
    # Scores that doubles do not hold exactly, a short vector, a repeated anchor and a repeated candidate.
    huge = float(1 << 20)
    rows = [(0, [huge, 1.0], 1), (0, [huge, 1.0], 1), (1, [huge, 2.0], 1), (2, [huge], 2), (3, [huge, 1.0], 2), (3, [huge, 1.0], 2)]
    got = hard_negatives.mine(spark.createDataFrame(rows, ddl), anchor)
    big = int(huge) ** 2 * 65536
    want = [(0, 1, 1, 3, big + 2 * 65536, big + 65536), (0, 1, 2, 3, big + 2 * 65536, big + 65536), (0, 1, 3, 2, big + 2 * 65536, big)]
    assert sorted(tuple(r[c] for c in COLUMNS) for r in got.collect()) == sorted(want)
    with pytest.raises(ValueError):
        hard_negatives.mine(spark.createDataFrame([(0, [1e12], 1)], ddl), anchor)


def test_search_stops_before_the_lists_end():
    """Rows far from the anchor are not scored, and a block that cannot hold a better row is not entered."""
    rng = np.random.default_rng(6)
    near = rng.normal(0, 1, (20, 4)) + 100
    far = rng.normal(0, 1, (4000, 4))
    vectors = np.floor(np.concatenate([near, far]))
    ids, labels = np.arange(len(vectors)), np.zeros(len(vectors), np.int64)
    asked = np.array([[90.0, 95.0, 100.0, 105.0]])
    low, high = np.full((1, 1), -np.inf), np.full((1, 1), np.inf)
    best = hard_negatives.Best(1, 1, 5, np.float64)
    scored = hard_negatives.search(hard_negatives.Block(ids, labels, vectors), np.array([-1]), np.array([0]), asked, low, high, True, best)
    scores = vectors @ asked[0]
    assert best.ids[0, 0].tolist() == sorted(range(len(ids)), key=lambda i: (-scores[i], i))[:5]
    assert scored < len(vectors) / 4
    empty = hard_negatives.search(hard_negatives.Block(ids[20:], labels[20:], vectors[20:]), np.array([-1]), np.array([0]), asked,
                                  low, high, True, best)
    assert empty == 0


def test_equal_scores_at_the_threshold_are_met():
    """Rows that score just what the threshold says may still win by a smaller id."""
    vectors = np.ones((4096, 2))
    ids = np.arange(4096)[::-1].copy()
    best = hard_negatives.Best(1, 1, 5, np.float64)
    hard_negatives.search(hard_negatives.Block(ids, np.zeros(4096, np.int64), vectors), np.array([-1]), np.array([0]),
                          np.ones((1, 2)), np.full((1, 1), -np.inf), np.full((1, 1), np.inf), True, best)
    assert best.ids[0, 0].tolist() == [0, 1, 2, 3, 4]


# ---- clashing names and deep pages -------------------------------------------------------

def test_columns_named_like_the_operators_own(spark):
    from brindle.llm import langid, line_dedup, ordinal
    text = "ein Satz mit Worten der lang genug ist " * 3
    docs = spark.createDataFrame([(n, f"{text} {n}", "de") for n in range(6)], "doc_id long, text string, lang string")
    for clash in ("_id", "_grade", "_doc", "grade", "_text", "n_blocks", "removed_chars"):
        docs = docs.withColumn(clash, F.lit(7))
    labels = docs.select("doc_id", (F.col("doc_id") % 2).alias("_grade"), F.lit(1).alias("_id"))
    assert len(ordinal.fit(docs, labels, F.col("_grade"))["thresholds"]) == 1
    found = langid.identify(docs, langid.learn(docs), keep=("_text", "_id"))
    assert sorted((r["doc_id"], r["_text"], r["lang_pred"]) for r in found.collect()) == [(n, 7, "de") for n in range(6)]
    cut = line_dedup.dedup_lines(docs, min_words=5, report=True)
    assert sorted(cut.columns) == sorted(docs.columns)
    assert [r["n_blocks"] for r in cut.orderBy("doc_id").collect()] == [0, 1, 1, 1, 1, 1]


def test_deeply_nested_pages_take_linear_time():
    import time

    from brindle.llm import html_text
    begun = time.perf_counter()
    assert set(html_text.extract("<div>word " * 100_000).split()) == {"word"}
    assert html_text.extract("<b>" * 30_000 + "<p>t</p></i></div>" * 30_000).split() == ["t"] * 30_000
    assert time.perf_counter() - begun < 30
