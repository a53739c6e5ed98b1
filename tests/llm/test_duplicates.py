"""SimHash, line dedup, piecewise hashes and string tiling against brute force."""

import hashlib
import random
import time
from itertools import combinations

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from brindle.llm import ctph, decontaminate, line_dedup, simhash
from brindle.llm.components import connected_components

SMALL = "/root/testdata/sf0.001"


def fingerprint(text, k=4):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i:i + k]) for i in range(max(1, len(words) - k + 1))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def components(nodes, linked):
    parent = {n: n for n in nodes}

    def top(n):
        while parent[n] != n:
            n = parent[n]
        return n
    for a, b in combinations(nodes, 2):
        if linked(a, b):
            x, y = sorted((top(a), top(b)))
            parent[y] = x
    return {n: top(n) for n in nodes}


@pytest.mark.parametrize("bucket", [4096, 2])
def test_components_of_a_table(spark, bucket):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    marks = {i: fingerprint(t) for i, t in texts.items()}
    want = components(sorted(texts), lambda a, b: (marks[a] ^ marks[b]).bit_count() <= 4)
    found = simhash.near_components(docs, 4, 1, 4, min_jaccard=None, bucket=bucket).collect()
    assert {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in found} == {
        i: (f"{marks[i]:016x}", want[i]) for i in texts}


def test_links_are_complete(spark):
    """Chains and clusters of fingerprints at distances about the bound, in buckets of any size."""
    rng = random.Random(1)
    codes = []
    for _ in range(12):
        code = rng.getrandbits(64)
        for _ in range(12):
            codes.append(code)
            for bit in rng.sample(range(64), rng.randint(1, 6)):
                code ^= 1 << bit
    codes = sorted(set(codes))
    frame = spark.createDataFrame([(simhash._signed(c),) for c in codes], "w0 long")
    want = components(codes, lambda a, b: (a ^ b).bit_count() <= 4)
    for bucket in (4096, 2):
        pairs = simhash.links(frame, simhash.exact_masks(4), 4, 1, bucket).collect()
        pairs = {(r["w0"] % (1 << 64), r["v0"] % (1 << 64)) for r in pairs}
        assert all((a ^ b).bit_count() <= 4 for a, b in pairs)
        assert components(codes, lambda a, b: (a, b) in pairs or (b, a) in pairs) == want


def test_masks_leave_out_any_four_bits():
    masks = [m for (m,) in simhash.exact_masks(4)]
    rng = random.Random(2)
    for _ in range(3000):
        gone = sum(1 << b for b in rng.sample(range(64), 4))
        assert any(not m & gone for m in masks)


def test_edge_rows(table):
    words = " ".join(f"w{i}" for i in range(60))
    rows = [(1, ""), (2, None), (3, " \n"), (4, words), (4, words), (None, words), (None, "alone"), (9, "Alone"),
            (7, words.upper())]
    found = simhash.near_components(table(rows), 4, 1, 4, min_jaccard=None).collect()
    got = sorted(((r["doc_id"], r["component_id"]) for r in found), key=repr)
    assert got == sorted([(1, 1), (2, 1), (3, 1), (4, 4), (4, 4), (None, 4), (None, 9), (9, 9), (7, 4)], key=repr)
    assert simhash.near_components(table([])).count() == 0
    kept = simhash.keep_one(table(rows))
    assert kept.columns == table(rows).columns
    assert sorted(r["doc_id"] for r in kept.collect()) == [1, 4, 9]


def test_near_copies_of_five_word_shingles(spark):
    rng = random.Random(3)
    texts = []
    for group in range(30):
        base = [f"g{group}w{rng.randrange(9999)}" for _ in range(200)]
        texts.append(base)
        for edits in (0, 1, 2, 3, 12):
            copy = list(base)
            for _ in range(edits):
                copy[rng.randrange(200)] = f"x{rng.randrange(9999)}"
            texts.append(copy)
    sets = [{tuple(t[i:i + 5]) for i in range(len(t) - 4)} for t in texts]

    def near(a, b):
        return len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])
    want = components(range(len(texts)), near)
    docs = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "doc_id long, text string")
    got = {r["doc_id"]: r["component_id"] for r in simhash.near_components(docs).collect()}
    wrong = [i for i in got if got[i] != want[i]]
    assert not any(got[i] // 6 != i // 6 for i in got) and len(wrong) <= 2


def test_one_repeated_shingle_does_not_make_duplicates(table):
    rng = random.Random(14)
    rows = [(i, "- " * 104 + " ".join(f"w{rng.randrange(10**6)}" for _ in range(90))) for i in range(8)]
    assert simhash.keep_one(table(rows)).count() == 8


def test_equal_fingerprints_are_verified(spark):
    """Three texts share a made-up fingerprint: two alike, one alike only with a text of the next one."""
    words = [[f"{c}{i}" for i in range(60)] for c in "ab"]
    texts = [" ".join(w) for w in (words[0], words[0][:-1], words[1], words[1][:-2])]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    digest = {r["doc_id"]: r["d"] for r in docs.selectExpr("doc_id", "xxhash64(text) AS d").collect()}
    for marks in ("ppqq", "pppq", "pppp"):
        nodes = spark.createDataFrame([(m, digest[i]) for i, m in enumerate(marks)], "fingerprint string, node long")
        pairs = spark.createDataFrame([("p", "q")] if "q" in marks else [], "a string, b string")
        found = simhash._similar(docs, nodes, pairs, 5, 0.8, "text").collect()
        assert {frozenset((r["a"], r["b"])) for r in found} == {
            frozenset((digest[i], digest[i + 1])) for i in (0, 2)}


def test_null_and_equal_ids_are_checked_by_their_own_texts(table):
    rng = random.Random(15)
    texts = []
    for group in range(10):  # index 0.77: near in bits, but below 0.8
        base = [f"g{group}w{rng.randrange(9999)}" for _ in range(200)]
        texts += [" ".join(base), " ".join(f"x{i}" if i % 40 == 20 else w for i, w in enumerate(base))]
    for doc in (None, 1):
        assert simhash.keep_one(table([(doc, t) for t in texts])).count() == 20


def test_connected_components(spark):
    rng = random.Random(4)
    nodes = [f"n{i:03d}" for i in range(150)]
    edges = [(nodes[i], nodes[i + 1]) for i in range(60)] + [(nodes[80], n) for n in nodes[81:130]]
    edges += [tuple(rng.sample(nodes[130:], 2)) for _ in range(6)] + [(None, "n001"), ("n005", "n005")]
    rng.shuffle(edges)
    found = {r["node"]: r["root"] for r in connected_components(spark.createDataFrame(edges, "a string, b string")).collect()}
    linked = {frozenset(e) for e in edges}
    want = components(nodes, lambda a, b: frozenset((a, b)) in linked)
    assert found == {n: want[n] for e in edges for n in e if None not in e}
    assert connected_components(spark.createDataFrame([], "a string, b string")).count() == 0


# --- line dedup -----------------------------------------------------------------------

def prose(rng, n):
    return " ".join(f"{'W' if i % 9 == 0 else 'w'}{rng.randrange(10**6)}{'.' if i % 9 == 8 else ''}" for i in range(n))


def test_passage_inside_lines_is_deleted_once():
    rng = random.Random(5)
    passage = prose(rng, 68)
    first, later = prose(rng, 200) + " " + passage + " " + prose(rng, 90), prose(rng, 40) + " " + passage + " " + prose(rng, 30)
    ((start, end),) = line_dedup.common_blocks(first, later, 30)
    assert later[start:end] == passage
    assert line_dedup.cut_spans(later, [(start, end)]) == later.replace(passage + " ", "")


def test_blocks_in_another_order_and_short_ones():
    rng = random.Random(6)
    one, two, short = prose(rng, 60), prose(rng, 70), prose(rng, 12)
    first = "\n".join([one, prose(rng, 50), two, prose(rng, 20), short])
    later = "\n".join([prose(rng, 10), two, short, one])
    gone = sorted(later[s:e] for s, e in line_dedup.common_blocks(first, later, 30))
    assert gone == sorted([one, two])
    assert line_dedup.common_blocks(first, first, 30) == [(0, len(first))]
    assert line_dedup.common_blocks(first, "", 30) == line_dedup.common_blocks("", first, 30) == []


@settings(max_examples=150, deadline=None)
@given(st.lists(st.sampled_from("abcdefgh"), max_size=25), st.lists(st.sampled_from("abcdefgh"), max_size=25))
def test_patience_is_an_alignment(a, b):
    pairs = line_dedup.patience(a, b)
    assert all(a[i] == b[j] for i, j in pairs)
    assert all(i < k and j < m for (i, j), (k, m) in zip(pairs, pairs[1:]))
    if a == b:
        assert len(pairs) == len(a)


def test_passages_repeated_inside_a_document_are_deleted():
    rng = random.Random(11)
    passage, (u1, u2, u3, v1, v2) = prose(rng, 63), (prose(rng, 45) for _ in range(5))
    twice, once = f"{u1} {passage} {u2} {passage} {u3}", f"{v1} {passage} {v2}"
    assert line_dedup.patience(*([" ".join(line) for line in line_dedup.lines(t)] for t in (twice, once)))
    ((start, end),) = line_dedup.common_blocks(twice, once, 30)
    assert once[start:end] == passage
    again = f"{v1} {passage} {v2} {passage}"
    for first in (once.replace(v1, u1).replace(v2, u2), twice):
        assert [again[s:e] for s, e in line_dedup.common_blocks(first, again, 30)] == [passage, passage]


def test_pairs_are_documents_with_the_first_holder_of_a_window(table):
    """A passage whose lines all stand in earlier documents, alone or scattered over a long one."""
    rng = random.Random(12)
    passage = [prose(rng, 9) for _ in range(7)]
    scattered = " ".join(f"{prose(rng, 27)} {line}" for line in passage)
    texts = [f"{prose(rng, 36)} {line} {prose(rng, 36)}" for line in passage] + [scattered]
    texts += [f"{prose(rng, 45)} {' '.join(passage)} {prose(rng, 18)}" for _ in range(3)]
    rows = list(enumerate(texts))
    pairs = {(r["first"], r["doc_id"]) for r in line_dedup.pair_documents(table(rows)).collect()}
    assert pairs == {(8, 9), (8, 10)}
    cut = {r["doc_id"]: r["text"] for r in line_dedup.dedup_lines(table(rows)).collect()}
    assert [i for i, text in rows if cut[i] != text] == [9, 10]
    assert not any(" ".join(passage) in cut[i] for i in (9, 10))


def shared_windows(texts, n):
    """(document, start) of all windows of n words that an earlier document has."""
    seen, out = set(), set()
    for doc, text in sorted(texts.items()):
        words = text.lower().split()
        runs = [tuple(words[i:i + n]) for i in range(len(words) - n + 1)]
        out |= {(doc, i) for i, run in enumerate(runs) if run in seen}
        seen |= set(runs)
    return out


def test_every_window_of_an_earlier_document_is_deleted(table):
    """Passages of 30 to 50 words inside long sentences, of lines of two words, and cut in one document only."""
    rng = random.Random(13)

    def running(n):
        return " ".join(f"w{rng.randrange(10**6)}" for _ in range(n))
    texts = []
    for size in (30, 31, 35, 40, 50) * 4:
        passage = running(size)
        texts += [f"{running(40)} {passage} {running(40)}", f"{running(33)} {passage} {running(60)}"]
    short = "\n".join(running(2) for _ in range(25))
    sentence = running(20)
    texts += [f"{running(9)}\n{short}\n{running(8)}", f"{running(12)} \n{short}\n{running(7)}",
              f"{running(9)}. {sentence}. {running(40)}", f"{running(9)}. {sentence}. {running(40)}"]
    texts += [f"{running(10)}. {sentence} {short} {running(9)}.", f"{short}. {running(3)} {short.upper()}"]
    rows = list(enumerate(texts))
    out = {r["doc_id"]: r["text"] for r in line_dedup.dedup_lines(table(rows)).collect()}
    want = dict(rows)
    gone = {(doc, i + k) for doc, i in shared_windows(want, 30) for k in range(30)}
    for doc, text in rows:
        assert out[doc].split() == [w for i, w in enumerate(text.split()) if (doc, i) not in gone]
    assert len({doc for doc, _ in gone}) == 23


@settings(max_examples=100, deadline=None)
@given(st.lists(st.text(st.sampled_from("aAbB \t\n\x1c\x85\xa0\u3000éÉİΣσςß\u212a\ua7cb\0"), max_size=40), max_size=4))
def test_words_of_a_batch_are_hashed_at_once(texts):
    """Array operations over bytes in place of a string for each word; equal words are those of Python's lower and split."""
    hashes = line_dedup._Hashes()
    owner, found = hashes(pa.array(["", *texts], pa.string()))
    want = [(k, w) for k, t in enumerate(["", *texts]) for w in t.lower().split()]
    assert owner.tolist() == [k for k, _ in want]
    assert len({(w, h) for (_, w), h in zip(want, found.tolist())}) == len({w for _, w in want}) == len(set(found.tolist()))


def test_words_longer_than_a_piece_of_bytes(monkeypatch):
    monkeypatch.setattr(line_dedup, "BYTES", 4)
    texts = ["a bb ccc dddd eeeee", "x" * 50 + " eeeee a", "", " dddd"]
    owner, found = line_dedup._Hashes()(pa.array(texts).slice(1))
    monkeypatch.undo()
    _, all_at_once = line_dedup._Hashes()(pa.array(texts))
    assert owner.tolist() == [0, 0, 0, 2] and found.tolist()[1:] == [all_at_once[k] for k in (4, 0, 3)]


def test_equal_texts_are_not_split(monkeypatch):
    text = " One line.  Another line, of more words.\n"
    first = line_dedup._Split(text)
    monkeypatch.setattr(line_dedup, "lines", None)
    assert line_dedup.common_blocks(first, " " + text[1:], 7) == [(1, len(text) - 1)]
    assert line_dedup.common_blocks(first, text, 8) == []


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text("ab ", max_size=90), max_size=4), st.integers(1, 12))
def test_windows_by_definition(texts, least):
    owner, seeds, windows = line_dedup._windows(texts, least, line_dedup._Hashes())
    want = [(k, tuple(w[i:i + least])) for k, w in enumerate(map(str.split, texts)) for i in range(len(w) - least + 1)]
    assert owner.tolist() == [k for k, _ in want]
    for found in (seeds, windows):  # equal windows have equal seeds and hashes, wherever they stand
        assert len({(w, int(h)) for (_, w), h in zip(want, found)}) == len({w for _, w in want})
    assert len(set(windows.tolist())) == len({w for _, w in want})


def test_line_dedup_of_a_table(table):
    rng = random.Random(7)
    shared, own = prose(rng, 80), [prose(rng, 90) for _ in range(6)]
    rows = [(5, f"{own[0]} {shared}"), (1, f"{shared} {own[1]}"), (3, own[2]), (8, f"{own[3]}\n{shared} {own[4]}"),
            (9, own[2]), (None, shared), (2, None), (4, ""), (8, f"{own[3]}\n{shared} {own[4]}")]
    out = line_dedup.dedup_lines(table(rows), report=True)
    got = sorted(((r["doc_id"], r["text"], r["removed_chars"] > 0) for r in out.collect()), key=repr)
    assert got == sorted([(5, f"{own[0]} ", True), (1, f"{shared} {own[1]}", False), (3, own[2], False), (9, "", True),
                          (8, f"{own[3]}\n{own[4]}", True), (8, f"{own[3]}\n{own[4]}", True), (None, shared, False),
                          (2, None, False), (4, "", False)], key=repr)
    assert out.columns[:len(table(rows).columns)] == table(rows).columns
    assert line_dedup.dedup_lines(table([])).count() == 0


def test_no_long_passage_is_left_twice(spark):
    """Brute force over the table: prose passages of over 50 words stay in one document only."""
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text")
    texts = {r["doc_id"]: r["text"] for r in line_dedup.dedup_lines(docs).collect()}
    seen, twice = {}, set()
    for doc in sorted(texts):
        words = texts[doc].lower().split()
        for run in {tuple(words[i:i + 51]) for i in range(len(words) - 50)}:
            if len(set(run)) > 25 and seen.setdefault(run, doc) != doc:
                twice.add(doc)
    assert not twice


# --- piecewise hashes -----------------------------------------------------------------

def test_neighbours_of_a_table(spark, table):
    rng = random.Random(8)
    rows = [(i, prose(rng, rng.randrange(5, 120))) for i in range(40)] + [(50, ""), (60, None), (70, "é" * 9), (None, "end")]
    out = ctph.compare_neighbours(table(random.Random(9).sample(rows, len(rows)))).collect()
    assert len(out) == len(rows)
    texts = [t or "" for _, t in rows]
    for n, (doc, _) in enumerate(rows):
        (r,) = [r for r in out if r["doc_id"] == doc]
        text, after = texts[n], texts[(n + 1) % len(rows)]
        quarter = len(text) // 4
        new = text[:len(text) - quarter] + after[:quarter]
        assert (r["n_chars"], r["edited_sha256"]) == (len(text), hashlib.sha256(new.encode()).hexdigest())
        assert (r["fingerprint"], r["edited_fingerprint"]) == (ctph.fingerprint(text), ctph.fingerprint(new))
        assert r["near_next"] == ctph.likeness(r["fingerprint"], ctph.fingerprint(after))
        assert 0 <= r["near_edited"] <= 1
    assert np.median([r["near_edited"] for r in out if r["n_chars"] > 400]) > 0.6
    (alone,) = ctph.compare_neighbours(table([(1, "only one")])).collect()
    assert alone["near_next"] == 1.0
    assert ctph.compare_neighbours(table([])).count() == 0


def test_repetitive_texts_have_short_signatures():
    for text in ("ab" * 300_000, "Orre " * 50_000, "x" * 100_000, "a. " * 9, "the cat sat " * 20_000):
        mark = ctph.fingerprint(text)
        assert len(mark) <= 2 * ctph.MOST + 10 and ctph.likeness(mark, ctph.fingerprint(text + "y")) >= 0


@settings(max_examples=100, deadline=None)
@given(st.text("abcd", max_size=20), st.text("abcd", max_size=20))
def test_edit_likeness(a, b):
    rows = [list(range(len(b) + 1))]
    for i, x in enumerate(a):
        rows.append([i + 1])
        for j, y in enumerate(b):
            rows[-1].append(rows[-2][j] if x == y else 1 + min(rows[-2][j + 1], rows[-1][j]))
    run = min(ctph.SHARED, len(a), len(b))
    shared = run and any(a[i:i + run] in b for i in range(len(a) - run + 1))
    want = 1.0 if a == b else 1 - rows[-1][-1] / (len(a) + len(b)) if shared else 0.0
    assert ctph._edit_likeness(a, b) == pytest.approx(want)


# --- tiling ---------------------------------------------------------------------------

def tiles_by_definition(doc, item, least):
    """Greedy string tiling, all pairs of positions each round."""
    least = max(1, min(least, len(item)))
    free_d, free_i, tiles = [True] * len(doc), [True] * len(item), []
    while True:
        best, found = least, []
        for d in range(len(doc)):
            for p in range(len(item)):
                n = 0
                while (d + n < len(doc) and p + n < len(item) and doc[d + n] == item[p + n]
                       and free_d[d + n] and free_i[p + n]):
                    n += 1
                if n > best:
                    best, found = n, [(d, p)]
                elif n == best:
                    found.append((d, p))
        if not found:
            return tiles
        for d, p in found:
            if all(free_d[d:d + best]) and all(free_i[p:p + best]):
                free_d[d:d + best] = free_i[p:p + best] = [False] * best
                tiles.append((d, p, best))


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(1, 5), max_size=30), st.lists(st.integers(1, 5), min_size=1, max_size=15), st.integers(1, 4))
def test_tiles(doc, item, least):
    got = decontaminate.tile_matches(np.array(doc), np.array(item), least)
    assert got == tiles_by_definition(doc, item, least)


@settings(max_examples=30, deadline=None)
@given(st.lists(st.integers(1, 3), min_size=20, max_size=80), st.lists(st.integers(1, 3), min_size=5, max_size=40))
def test_tiles_with_few_pairs_at_once(doc, item):
    before, decontaminate.PAIRS = decontaminate.PAIRS, 7
    try:
        assert decontaminate.tile_matches(np.array(doc), np.array(item), 2) == tiles_by_definition(doc, item, 2)
    finally:
        decontaminate.PAIRS = before


def test_tiling_repetitive_texts_ends():
    """Time follows the pairs of places, not their square."""
    begun = time.perf_counter()
    assert decontaminate.tile_matches(np.ones(20_000), np.ones(200), 4) == [(0, 0, 200)]
    assert time.perf_counter() - begun < 2
    letters = np.arange(20_000) % 26
    bench = decontaminate.Benchmark([(n, " ".join(chr(97 + (k + n) % 26) for k in range(200))) for n in range(40)], 4)
    found = bench.matches([" ".join(chr(97 + k) for k in letters)], 0.5)[0]
    assert [(name, coverage) for name, coverage, _ in found] == [(n, 1.0) for n in range(40)]
    assert time.perf_counter() - begun < 10


@pytest.mark.parametrize("block", [16 << 20, 100])
def test_leaks(spark, table, block):
    rng = random.Random(10)
    items = [prose(rng, 30) for _ in range(6)] + ["two words", "", None]
    half = items[1].split()
    rows = [(1, f"{prose(rng, 20)} {items[0].upper()} {prose(rng, 9)}"), (2, " ".join(half[15:] + ["x"] + half[:15])),
            (3, prose(rng, 50)), (4, " ".join(half[:12])), (5, None), (6, ""), (7, "here: two, words!"), (None, items[2]),
            (1, items[3])]
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string").selectExpr("*", "1 AS doc_id")
    got = {(r["doc_id"], r["item_id"]): r["coverage"]
           for r in decontaminate.find_leaks(table(rows), bench, block_bytes=block).collect()}
    assert got == {(1, 0): 1.0, (2, 1): 1.0, (7, 6): 1.0, (None, 2): 1.0, (1, 3): 1.0}
    kept = decontaminate.drop_leaks(table(rows), bench, block_bytes=block)
    assert sorted(r["doc_id"] for r in kept.collect()) == [3, 4, 5, 6] and kept.columns == table(rows).columns
    assert decontaminate.find_leaks(table([]), bench).count() == 0
    assert decontaminate.find_leaks(table(rows), bench.limit(0)).count() == 0
