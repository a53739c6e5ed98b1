"""Language of texts and of their spans: script ranges, per-word scores, Viterbi.

A model holds log probabilities of hashed character n-grams of words for every language, and
the scripts each language is written in. The script of a word narrows its candidates; its
score per language is the sum over its n-grams. A Viterbi pass over the words of a text, with
a penalty for every switch, labels spans of mixed text. The language of a text is the one with
most letters.

Most texts need no pass: if no run of words gains more in other languages than its switches
cost, the best single language is the best path, and that is tested with running sums.
"""

from __future__ import annotations

import uuid
from bisect import bisect_right
from collections import Counter
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brindle.llm.batches import each_batch, hold, map_batches, record_batch, strings

#: Hashed n-grams per language, longest n-gram, documents per language to learn from, cost of a switch
#: in nats, what one word can say against a language, words kept per worker.
BUCKETS, LONGEST, LEARN_DOCS, SWITCH, CLIP, CACHE = 1 << 16, 4, 5_000, 12.0, 10.0, 150_000
#: Share of a language's letters from which a script counts as one of its own.
SCRIPT_SHARE = 0.005

# Ranges of code points (first, last, script).
SCRIPTS = [(0x41, 0x24F, "Latin"), (0x1E00, 0x1EFF, "Latin"), (0x370, 0x3FF, "Greek"), (0x1F00, 0x1FFF, "Greek"),
           (0x400, 0x52F, "Cyrillic"), (0x530, 0x58F, "Armenian"), (0x590, 0x5FF, "Hebrew"),
           (0x600, 0x77F, "Arabic"), (0x900, 0x97F, "Devanagari"), (0x980, 0x9FF, "Bengali"),
           (0xA00, 0xA7F, "Gurmukhi"), (0xA80, 0xAFF, "Gujarati"), (0xB80, 0xBFF, "Tamil"),
           (0xC00, 0xC7F, "Telugu"), (0xE00, 0xE7F, "Thai"), (0x10A0, 0x10FF, "Georgian"),
           (0x1100, 0x11FF, "Hangul"), (0xAC00, 0xD7AF, "Hangul"), (0x3040, 0x30FF, "Kana"),
           (0x3400, 0x9FFF, "Han"), (0x20000, 0x2FFFF, "Han")]
_STARTS = sorted(s[0] for s in SCRIPTS)
_BY_START = sorted(SCRIPTS)
_LAST_LATIN = chr(0x24F)


def script(letter: str) -> str:
    code = ord(letter)
    at = bisect_right(_STARTS, code) - 1
    if at >= 0 and code <= _BY_START[at][1]:
        return _BY_START[at][2]
    return "other"


def letters(chunk: str) -> str:
    low = chunk.lower()
    return low if low.isalpha() else "".join(filter(str.isalpha, low))


def main_script(word: str) -> str:
    """The script of most letters; the first by name if several have as many."""
    if max(word) <= _LAST_LATIN:
        return "Latin"
    kinds = Counter(map(script, word))
    return max(sorted(kinds), key=kinds.get)


def grams(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Word numbers and buckets of all n-grams of words of letters, with the words' borders."""
    edged = "".join([f"^{w}$" for w in words])
    codes = np.frombuffer(edged.encode("utf-32-le", "surrogatepass"), np.uint32)
    owner = np.repeat(np.arange(len(words)), [len(w) + 2 for w in words])
    rolling, owners, buckets = np.zeros(len(codes), np.uint32), [], []
    for n in range(1, LONGEST + 1):
        end = len(codes) - n + 1
        if end <= 0:
            break
        rolling = rolling[:end] * np.uint32(0x01000193) + codes[n - 1:]
        inside = owner[:end] == owner[n - 1:]
        mixed = (rolling[inside] ^ np.uint32(n)) * np.uint32(0x9E3779B1)
        owners.append(owner[:end][inside])
        buckets.append((mixed >> np.uint32(16)).astype(np.int64) % BUCKETS)
    return np.concatenate(owners), np.concatenate(buckets)


def learn(docs: DataFrame, lang_col: str = "lang", id_col: str = "doc_id", text_col: str = "text",
          per_language: int = LEARN_DOCS) -> dict:
    """A model from labelled texts: ``per_language`` documents of every language, chosen by a hash
    of their id, or all of them if a language has fewer. Rows without text or label are not used."""
    labelled = docs.where(F.col(text_col).isNotNull() & F.col(lang_col).isNotNull())
    sizes = {r[0]: r[1] for r in labelled.groupBy(lang_col).count().orderBy(lang_col).collect()}
    if not sizes:
        return {"languages": [], "scores": np.zeros((0, BUCKETS), np.float32), "scripts": {}}
    languages = sorted(sizes)
    share = F.create_map(*(x for lang in languages for x in
                           (F.lit(lang), F.lit(min(1.0, per_language / sizes[lang])))))
    chosen = labelled.where(F.pmod(F.xxhash64(id_col), F.lit(1_000_003)) < share[F.col(lang_col)] * 1_000_003)
    schema = pa.schema([("lang", pa.string()), ("kind", pa.string()), ("bucket", pa.int64()), ("n", pa.int64())])

    def count(batches):
        words: dict[str, Counter] = {}
        for batch in batches:
            for lang, text in zip(strings(batch, "lang"), strings(batch, "text")):
                words.setdefault(lang, Counter()).update(text.split())
        rows = []
        for lang, seen in words.items():
            clean: Counter = Counter()
            for chunk, n in seen.items():
                clean[letters(chunk)] += n
            del clean[""]
            kinds: Counter = Counter()
            for word, n in clean.items():
                kinds[main_script(word)] += n * len(word)
            owner, found = grams(list(clean)) if clean else (np.zeros(0, int), np.zeros(0, int))
            many = np.bincount(found, np.array(list(clean.values()), float)[owner], BUCKETS) if clean else np.zeros(0)
            rows += [(lang, "", int(b), int(many[b])) for b in np.flatnonzero(many)]
            rows += [(lang, name, -1, n) for name, n in kinds.items()]
        yield record_batch(schema, *(zip(*rows) if rows else ([] for _ in schema)))

    counted = map_batches(chosen.select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text")),
                          "lang string, kind string, bucket long, n long", count)
    # At most BUCKETS rows a language reach the driver.
    rows = counted.groupBy("lang", "kind", "bucket").agg(F.sum("n").alias("n")).toArrow()
    counts = np.zeros((len(languages), BUCKETS))
    scripts: dict[str, list[float]] = {}
    at = np.array([languages.index(v) for v in rows["lang"].to_pylist()], np.int64)
    bucket, n = rows["bucket"].to_numpy(), rows["n"].to_numpy()
    counts[at[bucket >= 0], bucket[bucket >= 0]] = n[bucket >= 0]
    for lang, kind, many in zip(at[bucket < 0], rows.filter(pa.array(bucket < 0))["kind"].to_pylist(), n[bucket < 0]):
        scripts.setdefault(kind, [0.0] * len(languages))[lang] = float(many)
    total = np.maximum(1, np.sum(list(scripts.values()), axis=0)) if scripts else 1
    own = {kind: np.array(v) / total >= SCRIPT_SHARE for kind, v in scripts.items()}
    scores = np.log((counts + 0.5) / (counts.sum(axis=1, keepdims=True) + 0.5 * BUCKETS))
    return {"languages": languages, "scores": (scores - scores.mean(axis=0)).astype(np.float32),
            "scripts": {k: v for k, v in own.items() if v.any()}}


class Labeller:
    """Scores and labels words with a model; one per worker."""

    def __init__(self, model: dict):
        self.model, self.languages = model, model["languages"]
        self.table = np.ascontiguousarray(model["scores"].T, np.float64)
        self._clear()

    def _clear(self) -> None:
        self.rows: dict[str, int] = {}
        self.words: dict[str, int] = {"": 0}
        self.scores, self.letters = np.zeros((1, len(self.languages))), np.zeros(1, np.int64)
        self.known = np.zeros(1, np.int64)  # letters of words in scripts that some language has

    def _learn(self, chunks: list[str]) -> None:
        """Rows for unseen chunks; chunks with the same letters share one."""
        found = list(map(letters, chunks))
        new = [w for w in dict.fromkeys(found) if w not in self.words]
        if new:
            owner, buckets = grams(new)
            score = np.stack([np.bincount(owner, self.table[buckets, k], len(new))
                              for k in range(len(self.languages))], axis=1)
            nothing = np.ones(len(self.languages), bool)
            kinds = list(map(main_script, new))
            able = np.array([self.model["scripts"].get(kind, nothing) for kind in kinds])
            score = np.where(able, score, -np.inf)
            score = np.maximum(score - score.max(axis=1, keepdims=True), -CLIP)
            first = len(self.letters)
            self.words.update(zip(new, range(first, first + len(new))))
            self.scores = np.concatenate([self.scores, score])
            self.letters = np.concatenate([self.letters, [len(w) for w in new]])
            self.known = np.concatenate([self.known, [len(w) * (kind in self.model["scripts"])
                                                      for w, kind in zip(new, kinds)]])
        self.rows.update(zip(chunks, map(self.words.__getitem__, found)))

    def label(self, texts: list[str]) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """For every text, language number, letters and letters in learned scripts of every white-space separated word."""
        if len(self.rows) > CACHE:
            self._clear()
        split = [t.split() for t in texts]
        unseen = [c for c in dict.fromkeys(chain.from_iterable(split)) if c not in self.rows]
        if unseen:
            self._learn(unseen)
        out = []
        for chunks in split:
            at = np.fromiter(map(self.rows.__getitem__, chunks), np.int64, len(chunks))
            out.append((self._path(self.scores[at]) if len(at) else at, self.letters[at], self.known[at]))
        for chunk in unseen:
            if len(chunk) > 64:
                del self.rows[chunk]
        return out

    @staticmethod
    def _path(scores: np.ndarray) -> np.ndarray:
        n, many = scores.shape
        best = int(scores.sum(axis=0).argmax())
        if many == 1:
            return np.zeros(n, np.int64)
        others = np.delete(scores, best, axis=1).max(axis=1) - scores[:, best]
        gain = np.concatenate([[0.0], np.cumsum(others)])
        inner = (gain - np.minimum.accumulate(gain)).max()
        if max(inner - 2 * SWITCH, gain.max() - SWITCH, gain[-1] - gain.min() - SWITCH) <= 0:
            return np.full(n, best)
        first, *rest = scores.tolist()
        value, back = first, []
        for row in rest:
            top = max(value)
            cut = top - SWITCH  # what a switch to a language leaves
            back.append((value.index(top), [v < cut for v in value]))
            value = [(cut if v < cut else v) + s for v, s in zip(value, row)]
        at = value.index(max(value))
        path = [at]
        for top, switched in reversed(back):
            if switched[at]:
                at = top
            path.append(at)
        return np.array(path[::-1], np.int64)

    def judge(self, texts: list[str], learned_scripts: bool = False) -> list[tuple[str, float, list[dict]]]:
        """Of every text the language (``und`` without letters), its share of the letters, and spans of words.

        With ``learned_scripts`` words in a script that no language of the model has add nothing to any share.
        """
        if not self.languages:
            return [("und", 0.0, [])] * len(texts)
        out = []
        for at in range(0, len(texts), 256):
            for path, count, known in self.label(texts[at:at + 256]):
                total = int(count.sum())
                if learned_scripts:
                    count = known
                if not count.any():
                    out.append(("und", 0.0, []))
                    continue
                shares = np.bincount(path, count, len(self.languages))
                best = int(shares.argmax())
                edges = [0, *(np.flatnonzero(path[1:] != path[:-1]) + 1).tolist(), len(path)]
                spans = [{"start": a, "end": b, "lang": self.languages[path[a]]} for a, b in zip(edges, edges[1:])]
                out.append((self.languages[best], float(shares[best] / total), spans))
        return out


_LABELLERS: dict[str, Labeller] = {}


def _labeller(key: str, shared) -> Labeller:
    """The worker's labeller for a broadcast model. A module's function, so that all tasks share it."""
    hold("langid", _LABELLERS.clear)
    if key not in _LABELLERS:
        _LABELLERS.clear()
        _LABELLERS[key] = Labeller(shared.value)
    return _LABELLERS[key]


def _send(docs: DataFrame, model: dict):
    """A name for the model and its broadcast, which has a fixed size for every language."""
    return uuid.uuid4().hex, docs.sparkSession.sparkContext.broadcast(model)


def identify(docs: DataFrame, model: dict, keep: tuple[str | Column, ...] = (), id_col: str = "doc_id",
             text_col: str = "text") -> DataFrame:
    """doc_id, columns of ``keep``, lang_pred, score (share of the letters, 0 to 1) and spans of words.

    A null text, a text without letters and any text under a model without languages give ``und``,
    score 0 and no spans. Ties go to the first language by name. Repeated rows give repeated
    results, null ids stay null, an empty table gives no rows, other columns are ignored.
    """
    key, shared = _send(docs, model)
    kept = docs.select(F.col(id_col).cast("long").alias("doc_id"), *keep).columns
    inner = "_text"
    while inner in kept:
        inner += "_"
    chosen = docs.select(F.col(id_col).cast("long").alias("doc_id"), *keep, F.col(text_col).alias(inner))
    ddl = (", ".join(f"`{n}` {t}" for n, t in chosen.dtypes[:-1])
           + ", lang_pred string, score double, spans array<struct<start:int,end:int,lang:string>>")
    span = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("lang", pa.string())]))

    def work(batch):
        own = [batch.column(i) for i in range(batch.num_columns - 1)]
        schema = pa.schema([*(batch.schema.field(i) for i in range(batch.num_columns - 1)),
                            ("lang_pred", pa.string()), ("score", pa.float64()), ("spans", span)])
        found = _labeller(key, shared).judge(strings(batch, inner))
        return record_batch(schema, *own, *map(list, zip(*found)))

    return each_batch(chosen, ddl, work)


def keep_languages(docs: DataFrame, model: dict, least_share: float = 0.5, text_col: str = "text",
                   learned_scripts: bool = False) -> DataFrame:
    """The rows whose text has a language with at least ``least_share`` of its letters.

    With ``learned_scripts`` words in a script that no language of the model has count as no language's. Rows pass through whole, with all their columns; texts that are null or have no letters go.
    """
    key, shared = _send(docs, model)

    def work(batch):
        found = _labeller(key, shared).judge(strings(batch, text_col), learned_scripts)
        return batch.filter(pa.array([lang != "und" and share >= least_share for lang, share, _ in found], pa.bool_()))

    return each_batch(docs, docs.schema, work)
