"""Language ID, ordinal regression, page text and the pipeline."""

import collections
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from brindle.llm import html_text, langid, ordinal
from brindle.llm.queries import QUERIES

SMALL = "/root/testdata/sf0.001"


def test_held_out_languages(spark):
    folder = "/root/testdata/sf0.01"
    langs = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    rows = QUERIES["op6_language_id"](spark, folder).collect()
    assert {r["doc_id"] for r in rows} == set(langs)
    import zlib
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in rows)
    held = [r for r in rows if r["held_out"]]
    assert np.mean([r["lang_pred"] == langs[r["doc_id"]] for r in held]) > 0.98
    assert all(0 <= r["score"] <= 1 for r in rows)


@pytest.fixture(scope="module")
def model(spark):
    rng = random.Random(1)
    words = {"aa": ["anna", "banana", "salad", "map"], "bb": ["zzyx", "ixxo", "yuzz", "oxo"], "cc": ["мир", "слово", "дом"]}
    rows = [(i, " ".join(rng.choices(words[lang], k=30)), lang) for i, lang in enumerate(sorted(words) * 8)]
    rows += [(900, None, "aa"), (901, "unlabelled", None)]
    return langid.learn(spark.createDataFrame(rows, "doc_id long, text string, lang string"))


def best_path(scores):
    """Viterbi over all languages, without the shortcut."""
    value, back = scores[0].copy(), []
    for row in scores[1:]:
        step = value[:, None] - langid.SWITCH * (1 - np.eye(len(row)))
        back.append(step.argmax(axis=0))
        value = step.max(axis=0) + row
    return value.max()


def cost(scores, path):
    return scores[np.arange(len(path)), path].sum() - langid.SWITCH * np.count_nonzero(np.diff(path))


def test_paths_are_best():
    rng = np.random.default_rng(2)
    for _ in range(300):
        scores = -rng.exponential(rng.choice([1, 6, 15]), (rng.integers(1, 40), rng.integers(1, 5)))
        path = langid.Labeller._path(scores)
        assert cost(scores, path) == pytest.approx(best_path(scores))


def test_mixed_and_empty_texts(table, model):
    mixed = "anna banana salad map anna banana " + "zzyx ixxo yuzz oxo zzyx ixxo yuzz oxo zzyx oxo"
    rows = [(1, mixed), (2, None), (3, ""), (4, "12 !? 34"), (5, "мир дом"), (None, "anna map"), (1, mixed), (6, "世界")]
    out = langid.identify(table(rows), model).collect()
    got = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in out}
    assert [got[i][0] for i in (1, 2, 3, 4, 5, None)] == ["bb", "und", "und", "und", "cc", "aa"]
    assert got[2][1] == 0 and 0.5 < got[1][1] < 1 and got[5][1] == 1 and len(out) == len(rows)
    assert got[6][0] in model["languages"]
    spans = next(r["spans"] for r in out if r["doc_id"] == 1)
    assert [(s["start"], s["end"], s["lang"]) for s in spans] == [(0, 6, "aa"), (6, 16, "bb")]
    kept = langid.keep_languages(table(rows), model)
    assert sorted((r["doc_id"] for r in kept.collect()), key=repr) == [1, 1, 5, 6, None] and kept.columns == table(rows).columns
    assert langid.identify(table([]), model).count() == 0


def test_scripts_that_were_not_learned(table, model):
    rows = [(1, "世界"), (2, "anna 世界"), (3, "a 世界"), (4, "anna banana"), (5, "мир"), (6, None), (7, "შენ anna"), (8, "12")]
    kept = langid.keep_languages(table(rows), model, learned_scripts=True)
    assert sorted(r["doc_id"] for r in kept.collect()) == [2, 4, 5, 7]
    forced = {r["doc_id"]: r["score"] for r in langid.identify(table(rows), model).collect()}
    assert forced[1] == 1 and forced[3] > 0


def test_pipeline_drops_scripts_without_a_language(spark):
    rows = [(i, "anna banana salad map", "aa") for i in range(20)] + [(30, "世界 世界", None), (31, "дом слово", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    assert {r["doc_id"] for r in corpus_pipeline.language_id(spark, docs, "").collect()} == set(range(20))


def test_no_labels(table, spark):
    empty = langid.learn(spark.createDataFrame([], "doc_id long, text string, lang string"))
    assert langid.identify(table([(1, "text")]), empty).first()["lang_pred"] == "und"


# --- ordinal regression ---------------------------------------------------------------

def graded(spark, n=300):
    rng = random.Random(3)
    rows, labels = [], []
    for i in range(n):
        grade = i % 3
        words = [f"n{rng.randrange(500)}" for _ in range(30)]
        words[5:5 + 4] = [["bad", "awful", "nasty", "bad"], ["meh", "meh", "soso", "plain"], ["fine", "good", "nice", "fine"]][grade]
        rows.append((i, " ".join(words)))
        labels.append((i, grade if i % 2 else None))
    return rows, spark.createDataFrame(labels, "doc_id long, grade int")


def test_grades_are_learned_and_ordered(spark, table):
    rows, labels = graded(spark)
    fitted = ordinal.fit(table(rows), labels, F.col("grade"))
    assert (np.diff(fitted["thresholds"]) > 0).all() and len(fitted["thresholds"]) == 2
    every = {r["doc_id"]: r for r in ordinal.select(table(rows), fitted, 1, 0.0).collect()}
    means = [np.mean([every[i]["expected_grade"] for i in every if i % 3 == g]) for g in range(3)]
    assert means[0] < 0.5 < means[1] < 1.5 < means[2]
    best = {r["doc_id"] for r in ordinal.select(table(rows), fitted).collect()}
    assert len(best ^ {i for i, _ in rows if i % 3 == 2}) <= 3


def test_gradient():
    """The fit is a minimum: no small step along any coordinate improves the penalized likelihood."""
    rng = np.random.default_rng(4)
    y = rng.integers(0, 3, 60)
    x = rng.normal(size=(60, 3)) + y[:, None]
    row, column = np.repeat(np.arange(60), 3), np.tile(np.arange(3), 60)
    weights, thresholds = ordinal._descend(row, column, x.ravel(), y, 3)

    def loss(w, t):
        bounds = np.concatenate([[-np.inf], t, [np.inf]])
        cdf = lambda v: 1 / (1 + np.exp(-v))
        chance = cdf(bounds[y + 1] - x @ w) - cdf(bounds[y] - x @ w)
        return -np.log(chance).sum() + ordinal.PENALTY / 2 * (w ** 2).sum()
    least = loss(weights, thresholds)
    for k in range(3):
        for sign in (-0.2, 0.2):
            assert loss(weights + sign * np.eye(3)[k], thresholds) > least - 0.05


def test_selection_edges(spark, table):
    rows, labels = graded(spark, 60)
    fitted = ordinal.fit(table(rows), labels, F.col("grade"))
    odd = [(1, None), (2, ""), (None, "good fine nice fine"), (3, "good fine nice fine"), (3, "good fine nice fine")]
    assert [r["doc_id"] for r in ordinal.select(table(odd), fitted, 2, 0.0).collect()] == [1, 2, None, 3, 3]
    assert ordinal.select(table(odd), fitted, 3).count() == 0
    assert ordinal.select(table([]), fitted).count() == 0
    none = ordinal.fit(table(rows), labels.limit(0), F.col("grade"))
    assert ordinal.select(table(rows), none).count() == 0


def test_toxic_documents_are_not_selected(spark):
    folder = "/root/testdata/sf0.01"
    chosen = {r["doc_id"] for r in QUERIES["op5_ordinal_quality"](spark, folder).collect()}
    labels = spark.read.parquet(f"{folder}/labels.parquet").collect()
    toxic = {r["doc_id"] for r in labels if r["toxic"]}
    good = {r["doc_id"] for r in labels if r["quality"] and not r["toxic"]}
    assert len(chosen & toxic) <= 0.05 * len(toxic) and len(chosen & good) >= 0.97 * len(good)


# --- pages ----------------------------------------------------------------------------

LONG = "This sentence is one of the many in the article and it goes on for a good while."


@pytest.mark.parametrize("html,text", [
    (None, ""), ("", ""), ("no tags at all", "no tags at all"), ("<p>", ""), ("<!-- x -->", ""),
    (f"<nav><a>Home</a></nav><article><h1>Head</h1><p>{LONG}<p>Be.<p>{LONG}</article><footer>f</footer>",
     f"Head {LONG} Be. {LONG}"),
    (f"<div class='menu'><a href=x>a</a></div><div id=content><p>{LONG}</p><p>A &amp; B&eacute;&#8212;c<br>d</p></div>"
     f"<div class='sidebar'>{LONG}</div>", f"{LONG} A & Bé—c d"),
    (f"<main><p>{LONG}</p><form><label>Name</label><input></form><div class='comments'><p>{LONG}</p></div>"
     f"<script>var a='<p>';</script><style>p{{}}</style><div class='cookie-notice'>{LONG}</div></main>", LONG),
    (f"<body><article><p><b>{LONG}<br><p>{LONG}</article>", f"{LONG} {LONG}"),
    (f"<article><ul><li>one<li>two</ul><table><tr><td>x<td>y</table><p>{LONG}</p></article>", f"one two x y {LONG}"),
    (f"<article><p>{LONG} <a href=q>link</a> a<i>b</i>c</p></article></div></p>", f"{LONG} link abc"),
])
def test_page(html, text):
    assert html_text.extract(html or "") == text


def test_pages_of_a_table(spark):
    import html as entities
    import re
    pages = spark.read.parquet(f"{SMALL}/pages.parquet")
    found = {r["page_id"]: r for r in QUERIES["op10_html_text"](spark, SMALL).collect()}
    for page in pages.collect():
        inner = re.search(r"<article>(.*)</article>", page["html"], re.S).group(1).replace("<br>", " ")
        blocks = (" ".join(entities.unescape(re.sub("</?b>", "", b)).split()) for b in re.split("</?(?:p|h1)>", inner))
        text = " ".join(b for b in blocks if b)
        assert (found[page["page_id"]]["text"], found[page["page_id"]]["n_chars"]) == (text, len(text))
    odd = spark.createDataFrame([(None, "u", None), (1, None, ""), (1, None, "<p>a</p>" * 5000)], "page_id long, url string, html string")
    assert sorted(r["n_chars"] for r in html_text.extract_text(odd).collect()) == [0, 0, 9999]
    assert html_text.extract_text(odd.limit(0)).count() == 0


# --- pipeline -------------------------------------------------------------------------

def test_pipeline(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    columns, before = docs.columns, {r["doc_id"] for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.as_table(stage(spark, docs, SMALL), "stage")
        assert docs.columns == columns
        now = {r["doc_id"]: r for r in docs.collect()}
        assert set(now) <= before and len(now) > 0.8 * len(before), name
        assert all(r["n_chars"] == len(r["text"]) and r["text"].strip() for r in now.values())
        before = set(now)
    shared = collections.Counter()
    for row in now.values():
        words = row["text"].lower().split()
        shared.update({" ".join(words[i:i + 5]) for i in range(len(words) - 4)})
    items = [r["text"].lower().split() for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    assert not any(" ".join(item) in row["text"].lower() for item in items for row in now.values())
    pieces = corpus_pipeline.run(spark, SMALL)
    assert {r["doc_id"] for r in pieces.collect()} == before
    assert pieces.groupBy("sequence_id").agg(F.sum("length").alias("n")).where("n < 2048").count() <= 1


def test_pipeline_of_odd_rows(spark, tmp_path):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    text = "Some words of a text that is long enough to be kept by all stages."
    rows = [(1, text, "en", "a", len(text)), (None, None, None, None, None), (2, "", "en", None, 0), (1, text, "en", "a", len(text)),
            (3, "9 8 7", None, "b", 5)]
    bench = spark.createDataFrame([], "item_id long, text string")
    for name, own in (("odd", rows), ("empty", [])):
        folder = str(tmp_path / name)
        spark.createDataFrame(own, schema).write.parquet(f"{folder}/documents.parquet")
        bench.write.parquet(f"{folder}/benchmark.parquet")
        assert [r["doc_id"] for r in corpus_pipeline.run(spark, folder).collect()] == ([1] if own else [])
