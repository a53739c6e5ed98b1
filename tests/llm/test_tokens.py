"""Token counts, packing and id files against the tokenizers library."""

import functools
import re
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from brindle.llm import batches, idcodec, packing, token_counts, wordbpe
from brindle.session import scratch_path

WORDS, BYTES = public_tokenizers.path("word_bpe_49k.json"), public_tokenizers.path("byte_bpe_50k.json")
TEXTS = ["Plain words, twice: plain words!", "", None, "ÉTÉ été naïve œuvre", "İ ΣΑΣ ﬁ é ½ 日本語 \x00",
         "a<|endoftext|>b <|startoftext|>", "don't we'LL it's 'quoted'", "tab\tline\n\n  spaces   end ",
         "word " * 3000, "x" * 5000, "😀 emoji — dash…", "Plain words, twice: plain words!"]
# Loaded once each; in a worker, using one operator's caches clears another's.
library_of, encoder_of, counts_of = map(functools.cache, (Tokenizer.from_file, wordbpe.Encoder, token_counts.Counts))
ROWS = [*enumerate(TEXTS), (None, "no id"), (0, "same id")]


@pytest.fixture(scope="module")
def words():
    tokenizer = Tokenizer.from_file(WORDS)
    return lambda text: np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 1], "<u4")


@settings(max_examples=80, deadline=None)
@given(st.lists(st.text(st.characters(blacklist_categories=["Cs"]), max_size=40), max_size=5))
def test_cached_encoding_is_the_librarys(texts):
    full = library_of(WORDS)
    own = encoder_of(WORDS)
    assert [np.frombuffer(b, "<u4").tolist() for b in own.encode(texts)] == [
        full.encode(t, add_special_tokens=False).ids for t in texts]
    counts = counts_of(BYTES)
    library = library_of(BYTES)
    assert counts.count(texts) == [len(library.encode(t, add_special_tokens=False).ids) for t in texts]


def test_caches_may_overflow(monkeypatch):
    monkeypatch.setattr(wordbpe, "CACHE", 3)
    own, full = wordbpe.Encoder(WORDS), Tokenizer.from_file(WORDS)
    for text in ["a b c d e f g", "a b h i j", "d e f g a b", "h, i. j!"] * 2:
        assert np.frombuffer(own.encode([text])[0], "<u4").tolist() == full.encode(text, add_special_tokens=False).ids


def test_few_bytes_are_encoded_together():
    """A worker's memory follows the bytes of texts it encodes at once, not only their number."""
    sizes = [10] * 700 + [300_000] * 40 + [9 << 20, 10, 2 << 20] + [10] * 5000
    rows = pa.RecordBatch.from_pydict({"at": range(len(sizes)), "text": ["x" * n for n in sizes]})
    slices = [rows.slice(at, 512) for at in range(0, len(sizes), 512)]
    got = list(batches.regroup(slices, 2048))
    assert pa.concat_batches(got).equals(rows)
    assert all(b.nbytes <= batches.TEXT_BYTES or b.num_rows == 1 for b in got)
    assert len(got) < 12


def test_words_are_cached_as_arrays():
    own, full = wordbpe.Encoder(WORDS), library_of(WORDS)
    words = [f"{a}{b}{c}" for a in "bcdfgklm" for b in ("ar", "ent", "olo") for c in map(chr, range(97, 123))]
    ids = own.encode([" ".join(words), "Bara? (bara) BARA... " + "long" * 40])
    assert [np.frombuffer(b, "<u4").tolist() for b in ids] == [full.encode(t, add_special_tokens=False).ids for t in (
        " ".join(words), "Bara? (bara) BARA... " + "long" * 40)]
    known = own.chunk_ids
    assert known.words.nbytes + known.data.nbytes < 40 * len(known)
    own.encode(["next"])
    assert "long" * 40 not in known.words.to_pylist()


def test_every_usual_character_is_cut_as_by_the_library():
    own, full = encoder_of(WORDS), library_of(WORDS)
    usual = [c for c in map(chr, range(0x2100)) if not re.search(wordbpe._UNUSUAL, c)]
    texts = [t for c in usual for t in (f"ab{c} {c}{c}ab ab{c}{c}", f"a{c}b {c}1{c}. it's{c}", f"it{c}'s. {c}'LL {c}'")]
    assert len(texts) > 2000
    assert [np.frombuffer(b, "<u4").tolist() for b in own.encode(texts)] == [
        e.ids for e in full.encode_batch(texts, add_special_tokens=False)]


def test_token_counts(table):
    library = Tokenizer.from_file(BYTES)
    got = sorted(map(tuple, token_counts.count_tokens(table(ROWS), BYTES, 8).collect()), key=repr)
    count = [(i, len((t or "").encode()), len(library.encode(t or "", add_special_tokens=False).ids)) for i, t in ROWS]
    assert got == sorted(((*c, c[2] > 8) for c in count), key=repr)
    assert token_counts.count_tokens(table([]), BYTES).count() == 0


@pytest.mark.parametrize("size,windows,group", [(2048, 16, 4096), (16, 2, 1), (7, 1, 3)])
def test_packing_is_a_partition_of_all_ids(table, words, monkeypatch, size, windows, group):
    monkeypatch.setattr(packing, "MERGE_WINDOWS", group)
    docs = table(ROWS).repartition(3)
    pieces = packing.pack(docs, WORDS, size, windows).collect()
    want = sorted((repr((i, words(t).tolist())) for i, t in ROWS))
    placed, found = defaultdict(list), defaultdict(list)
    for p in pieces:
        ids = np.frombuffer(p["ids"], "<u4")
        assert len(ids) == p["length"] > 0
        placed[p["sequence_id"]].append((p["offset"], p["length"]))
        found[p["doc_id"], p["doc_tokens"]].append((p["start"], ids.tolist()))
    for own in placed.values():
        own.sort()
        assert [o for o, _ in own] == np.cumsum([0, *(n for _, n in own)])[:-1].tolist()
        assert sum(n for _, n in own) <= size
    if size == 2048:
        total = sum(len(words(t)) for _, t in ROWS)
        assert len(placed) == -(-total // size)
        for (doc, n), parts in found.items():  # equal ids and sizes would mix here; there are none
            ids = [x for _, part in sorted(parts) for x in part]
            assert repr((doc, ids)) in want and len(ids) == n
    assert sum(p["length"] for p in pieces) == sum(len(words(t)) for _, t in ROWS)
    assert packing.pack(table([]), WORDS).count() == 0


def test_packing_little_padding(spark, table):
    docs = spark.range(400).selectExpr("id AS doc_id", "repeat('some words of a text ', cast(1 + id % 97 AS int)) AS text")
    sums = packing.pack(docs.repartition(5), WORDS, 256, 4).groupBy("sequence_id").agg(F.sum("length").alias("n"))
    assert sums.where("n < 256").count() <= 1


@settings(max_examples=40, deadline=None)
@given(st.lists(st.lists(st.integers(0, 2**32 - 1) | st.integers(0, 9), max_size=120), min_size=1, max_size=6))
def test_codec_round_trip(blocks):
    blocks = [np.array(b, np.uint32) for b in blocks]
    bits = max([1, *(int(b.max()).bit_length() for b in blocks if len(b))])
    for id_bits in {bits, 32}:
        coded = idcodec.encode_blocks(blocks, id_bits)
        back = idcodec.decode_blocks(coded, [len(b) for b in blocks], id_bits)
        assert all(np.array_equal(a, b) for a, b in zip(blocks, back))


def test_codec_learns(words):
    ids = np.tile(words("the same few words again and again, and the same once more"), 200)
    (coded,) = idcodec.encode_blocks([ids.astype(np.uint32)], 16)
    assert 16 * len(coded) < 3 * len(ids)


def test_mixing_weights_adapt(monkeypatch):
    """Ids that repeat after some contexts and are random after others: with weights that stay where they begin, the
    same blocks take more room."""
    rng = np.random.default_rng(5)
    blocks = []
    for _ in range(20):
        phrase, ids = rng.integers(0, 1 << 16, 8), []
        while len(ids) < 4000:
            ids.extend(phrase if rng.random() < 0.5 else rng.integers(0, 1 << 16, 8))
        blocks.append(np.array(ids, np.uint32))
    adaptive = idcodec.encode_blocks(blocks, 16)
    assert all(np.array_equal(a, b) for a, b in zip(blocks, idcodec.decode_blocks(adaptive, [len(b) for b in blocks], 16)))
    monkeypatch.setattr(idcodec, "_JUMP", 0)
    assert sum(map(len, adaptive)) < sum(map(len, idcodec.encode_blocks(blocks, 16)))


def test_little_work_for_an_id():
    """What a step looks up of a distribution is one number, and lower bits of literals take no step: they are the
    last words, as they are."""
    model = idcodec._Model(3, 16, 4096)
    assert model.special.nbytes == 3 * 16 * 8 and model.general.nbytes == 3 * 8
    ids = np.random.default_rng(7).permutation(1 << 16)[:3000].astype(np.uint32) | 1 << 15
    (coded,) = idcodec.encode_blocks([ids], 16)
    rest = "".join(f"{i & 0x7FFF:015b}" for i in ids.tolist())
    assert [f"{w:016b}" for w in coded[:-200:-1].tolist()] == [rest[16 * k:16 * k + 16] for k in range(199)]
    assert np.array_equal(idcodec.decode_blocks([coded], [3000], 16)[0], ids)


def test_distributions_learn_of_many_ids_at_once(words, monkeypatch):
    """A step only looks up and learns predictions; distributions follow every 64 ids, all literals are read at once."""
    rng, spans = np.random.default_rng(3), []
    adapt = idcodec._Model.adapt
    monkeypatch.setattr(idcodec._Model, "adapt", lambda model, places: (spans.append(len(places)), adapt(model, places)))
    text = np.concatenate([words("Some words of a text, and some words of another one. " * 40), rng.integers(0, 1 << 16, 3000)])
    blocks = [rng.permutation(text)[:n].astype(np.uint32) for n in (4000, 0, 1, 63, 64, 65, 128, 1000, 3400)]
    coded = idcodec.encode_blocks(blocks, 16)
    assert 3 * len(spans) < 4000 // 16 and sum(spans) == sum(map(len, blocks))
    assert all(np.array_equal(a, b) for a, b in zip(blocks, idcodec.decode_blocks(coded, [len(b) for b in blocks], 16)))
    assert 2 * sum(spans[:len(spans) // 2]) == sum(spans)
    model = idcodec._Model(2, 16, 4096)
    for _ in range(500):  # one symbol alone leaves the others room
        model.adapt(np.repeat([0, 64 + 63], 64))
        assert (idcodec._sizes(model.mixed[:-4].reshape(-1, 4)) > 0).all()


def test_caches_of_a_size(monkeypatch):
    monkeypatch.setattr(wordbpe, "_ENCODERS", {})
    small, large = wordbpe.encoder(WORDS, 2), wordbpe.Encoder(WORDS, 1000)
    for text in ["a b c d", "e f g h", "i j"]:
        assert small.encode([text]) == large.encode([text])
    assert len(small.chunk_ids) < len(large.chunk_ids) == 10
    assert wordbpe.encoder(WORDS, 2) is small is not wordbpe.encoder(WORDS)


@pytest.mark.parametrize("block,lanes", [(4096, 2048), (16, 3), (1, 2)])
def test_id_files(spark, table, words, monkeypatch, block, lanes):
    monkeypatch.setattr(idcodec, "BLOCK", block)
    monkeypatch.setattr(idcodec, "LANES", lanes)
    rows = ROWS if block > 1 else [r for r in ROWS if len(r[1] or "") < 100]
    path = scratch_path(spark, "ids")
    idcodec.write_ids(table(rows), path, WORDS)
    got = [(r["start"], r["doc_id"], np.frombuffer(r["ids"], "<u4").tolist()) for r in idcodec.read_ids(spark, path).collect()]
    got.sort()
    assert [d for _, d, _ in got] == sorted((i for i, _ in rows if i is not None)) + [None]
    assert [s for s, *_ in got] == np.cumsum([0, *(len(x) for *_, x in got)])[:-1].tolist()
    assert sorted(repr((d, x)) for _, d, x in got) == sorted(repr((i, words(t).tolist())) for i, t in rows)


def test_id_files_empty_and_damaged(spark, table):
    path = scratch_path(spark, "ids")
    idcodec.write_ids(table([]), path, WORDS)
    assert idcodec.read_ids(spark, path).count() == 0
    good, bad = scratch_path(spark, "ids"), scratch_path(spark, "ids")
    idcodec.write_ids(table([(1, "some text to spoil")]), good, WORDS)
    broken = F.concat(F.expr("substring(data, 1, octet_length(data) - 3)"), F.lit(b"zzz"))
    spark.read.parquet(good).withColumn("data", broken).write.parquet(bad)
    with pytest.raises(Exception, match="damaged"):
        idcodec.read_ids(spark, bad).collect()


def test_whole_table_queries(spark, words):
    from brindle.llm.queries import QUERIES
    folder = "/root/testdata/sf0.001"
    docs = {r["doc_id"]: words(r["text"]) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    rows = QUERIES["op7_id_files"](spark, folder).orderBy("doc_id").collect()
    start = 0
    for r in rows:
        ids = docs.pop(r["doc_id"])
        assert (r["start"], r["n_tokens"], r["ids_crc32"]) == (start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)
    assert not docs
