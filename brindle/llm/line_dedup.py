"""Line deduplication by pairwise alignment.

Documents meet by windows of ``min_words`` words: every document is paired with the first one (lowest
doc_id) that has the same window, never with all others, so a window in k documents gives k - 1 pairs however
common it is, and the partner of a window holds all of it. Windows are counted only where their seed (the
smallest hash of ``GRAM`` words inside) is in several documents, which every window in several documents
passes.

Lines are the lines of a text, cut at sentence ends and, where a sentence is long, after words
chosen by their hash, so that a passage inside a line is found as well. The lines of a pair
are aligned by patience diff: lines unique in both documents (or else the rarest common ones) anchor
the alignment, the gaps between anchors are aligned the same way. Runs of aligned lines are extended word by word over their
borders, and runs of at least ``min_words`` words are deleted from the later document. So are windows of that
many words that are in both but whose lines are cut in different places and cannot align. As a
block is only deleted where an earlier document has it, one copy always stays.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections import Counter
from itertools import accumulate, chain, compress, count, pairwise
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brindle.llm.batches import Rows, column, each_batch, map_batches, record_batch
from brindle.operators.joins import fits_broadcast
from brindle.session import as_table

#: Words of a sentence before it is cut, words per cut piece, words of shared lines worth aligning.
LONG, PIECE, PAIR_WORDS = 24, 8, 16
#: Words of a seed, bits (as a power of two) of the largest table of repeated seeds, words kept per task,
#: bytes of words hashed together.
GRAM, MAP_BITS, WORDS_KEPT, BYTES = 8, 28, 200_000, 1 << 17
#: Of the hashes of words in a row.
FACTOR = 0x9E3779B97F4A7C15
_END = re.compile(r"[.!?…]\s|\n")
# Letters whose lower case depends on their neighbours, or that libraries of other Unicode versions take differently,
# and white space outside ASCII's six.
_OTHER = "[\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000İΣ\u1c80-\u1cff\ua640-\uabff\U00010000-\U0001efff]"
_SPACE = np.array([chr(c).isspace() for c in range(0x3002)])  # no character above is white space


class _Cuts(dict):
    """Whether a long sentence is cut behind a word, kept for a task."""

    def __missing__(self, word: str) -> bool:
        if len(self) >= WORDS_KEPT:
            self.clear()
        cut = self[word] = crc32(word.encode("utf-8", "surrogatepass")) % PIECE == 0
        return cut


_CUTS = _Cuts()


def lines(text: str) -> list[list[str]]:
    """The lines of a text as lists of lower-case words."""
    out = []
    text = text.lower()
    ends = [0, *(m.end() for m in _END.finditer(text)), len(text)]
    for words in (text[a:b].split() for a, b in pairwise(ends)):
        if len(words) <= LONG:
            if words:
                out.append(words)
            continue
        start = 0
        for end in compress(count(1), map(_CUTS.__getitem__, words)):
            out.append(words[start:end])
            start = end
        if start < len(words):
            out.append(words[start:])
    return out


def _anchors(a: list, b: list, a0: int, a1: int, b0: int, b1: int) -> list[tuple[int, int]]:
    """Lines unique in both ranges, as the longest chain that rises in both.

    Without such lines the rarest common ones serve, their occurrences paired by number.
    """
    in_a, in_b = Counter(a[a0:a1]), Counter(b[b0:b1])
    common = {line: max(in_a[line], in_b[line]) for line in in_a.keys() & in_b.keys()}
    if not common:
        return []
    rarest = min(common.values())
    where: dict = {}
    for i in range(a0, a1):
        if common.get(a[i]) == rarest:
            where.setdefault(a[i], []).append(i)
    seen: Counter = Counter()
    found = []
    for j in range(b0, b1):
        if b[j] in where and seen[b[j]] < len(where[b[j]]):
            found.append((where[b[j]][seen[b[j]]], j))
            seen[b[j]] += 1
    tops: list[int] = []
    ends: list[int] = []
    before = [-1] * len(found)
    for k, (i, _) in enumerate(found):
        at = bisect_left(tops, i)
        before[k] = ends[at - 1] if at else -1
        if at == len(tops):
            tops.append(i)
            ends.append(k)
        else:
            tops[at], ends[at] = i, k
    chain, k = [], ends[-1] if ends else -1
    while k >= 0:
        chain.append(found[k])
        k = before[k]
    return chain[::-1]


def patience(a: list, b: list) -> list[tuple[int, int]]:
    """Aligned positions of two lists, rising in both."""
    pairs, todo = [], [(0, len(a), 0, len(b))]
    while todo:
        a0, a1, b0, b1 = todo.pop()
        while a0 < a1 and b0 < b1 and a[a0] == b[b0]:
            pairs.append((a0, b0))
            a0, b0 = a0 + 1, b0 + 1
        while a0 < a1 and b0 < b1 and a[a1 - 1] == b[b1 - 1]:
            a1, b1 = a1 - 1, b1 - 1
            pairs.append((a1, b1))
        if a0 == a1 or b0 == b1:
            continue
        chain = _anchors(a, b, a0, a1, b0, b1)
        if chain:
            for (i, j), (k, m) in pairwise([(a0 - 1, b0 - 1), *chain, (a1, b1)]):
                todo.append((i + 1, k, j + 1, m))
            pairs.extend(chain)
    return sorted(pairs)


class _Split:
    """A text's lines as keys, its words, and where each line's words begin."""

    def __init__(self, text: str):
        self.text = text
        found = lines(text)
        self.keys = [" ".join(line) for line in found]
        self.known = frozenset(self.keys)
        self.words = list(chain.from_iterable(found))
        self.at = [0, *accumulate(map(len, found))]
        self.values = np.fromiter(map(hash, self.words), np.int64, len(self.words)).view(np.uint64)
        self.sorted: tuple[np.ndarray, np.ndarray] | None = None

    def windows(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of all windows of ``n`` words in order, and where they begin."""
        if self.sorted is None:
            found = rolled(self.values, n)
            order = np.argsort(found, kind="stable")
            self.sorted = found[order], order
        return self.sorted


def common_blocks(first: str | _Split, later: str, min_words: int) -> list[tuple[int, int]]:
    """Spans (start, end) of characters of ``later`` that align with ``first``, of at least ``min_words`` words each.

    Blocks in another order are found by aligning again what is left.
    """
    a = first if isinstance(first, _Split) else _Split(first)
    starts, ends = _places(later)
    if a.text == later:
        return [(int(starts[0]), int(ends[-1]))] if len(starts) >= max(1, min_words) else []
    b = _Split(later)
    taken = bytearray(len(b.words))
    _align(a, b, min_words, taken)
    _sweep(a, b, min_words, taken)
    edges = np.diff(np.frombuffer(bytes(1) + taken + bytes(1), np.int8)).nonzero()[0]
    return list(zip(starts[edges[::2]].tolist(), ends[edges[1::2] - 1].tolist()))


def _places(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Where the words of a text begin and end."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    space = np.ones(len(codes) + 2, bool)
    _SPACE.take(codes, mode="clip", out=space[1:-1])
    edges = (space[1:] != space[:-1]).nonzero()[0]
    return edges[::2], edges[1::2]


def _align(a: _Split, b: _Split, min_words: int, taken: bytearray) -> None:
    """Mark the words of ``b`` in blocks aligned with ``a``."""
    keys = list(b.keys)
    while sum(b.at[j + 1] - b.at[j] for j, key in enumerate(keys) if key in a.known) >= min(PAIR_WORDS, min_words):
        new = False
        runs: list[list[int]] = []
        for i, j in patience(a.keys, keys):
            if runs and runs[-1][1] == i and runs[-1][3] == j:
                runs[-1][1], runs[-1][3] = i + 1, j + 1
            else:
                runs.append([i, i + 1, j, j + 1])
        for i0, i1, j0, j1 in runs:
            x0, x1, y0, y1 = a.at[i0], a.at[i1], b.at[j0], b.at[j1]
            while x0 > 0 and y0 > 0 and not taken[y0 - 1] and a.words[x0 - 1] == b.words[y0 - 1]:
                x0, y0 = x0 - 1, y0 - 1
            while x1 < len(a.words) and y1 < len(taken) and not taken[y1] and a.words[x1] == b.words[y1]:
                x1, y1 = x1 + 1, y1 + 1
            if y1 - y0 >= min_words and not any(taken[y0:y1]):
                taken[y0:y1] = b"\1" * (y1 - y0)
                for j in range(bisect_right(b.at, y0) - 1, bisect_left(b.at, y1)):
                    keys[j] = f"\n{j}"  # a line with a deleted word aligns no more
                new = True
        if not new:
            return


def _sweep(a: _Split, b: _Split, min_words: int, taken: bytearray) -> None:
    """Mark what lines have not aligned: all windows of ``min_words`` words of ``b`` that stand anywhere in ``a``."""
    n = min_words
    if min(len(a.words), len(b.words)) < n:
        return
    found, (known, order) = rolled(b.values, n), a.windows(n)
    at = np.minimum(np.searchsorted(known, found), len(known) - 1)
    j = np.flatnonzero(known[at] == found)
    i = order[at[j]]
    # Windows in a row share all words but one: the words are compared by their first and, where a row ends, by all.
    last = np.ones(len(j), bool)
    last[:-1] = (np.diff(i) != 1) | (np.diff(j) != 1)
    inside = np.arange(n)
    if (a.values[i] != b.values[j]).any() or (a.values[i[last, None] + inside] != b.values[j[last, None] + inside]).any():
        same = np.ones(len(j), bool)  # equal hashes of other words
        for k in range(n):
            same &= a.values[i + k] == b.values[j + k]
        i, j = i[same], j[same]
    change = np.zeros(len(b.words) + 1, np.int64)
    change[j] = 1
    change[n:] -= change[:-n].copy()
    np.frombuffer(taken, np.uint8)[np.cumsum(change[:-1]) > 0] = 1


def cut_spans(text: str, spans: list[tuple[int, int]]) -> str:
    """The text without the spans and the white space behind each."""
    out, at = [], 0
    for start, end in sorted(spans):
        if start > at:
            out.append(text[at:start])
        at = max(at, end)
        while at < len(text) and text[at].isspace():
            at += 1
    out.append(text[at:])
    return "".join(out)


class _Hashes:
    """Hashes of the words of texts in lower case: of every byte a number of its own, times a power by its place."""

    def __init__(self):
        self.numbers = np.array([xxhash.xxh64_intdigest(bytes([b])) for b in range(256)], np.uint64)
        self._reach(BYTES)

    def _reach(self, size: int) -> None:
        self.powers, self.inverse = (np.multiply.accumulate(np.concatenate([[np.uint64(1)], np.full(size, f, np.uint64)]))
                                     for f in (FACTOR, pow(FACTOR, -1, 1 << 64)))

    def __call__(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Of all words: the number of their text, their hash."""
        other = pc.match_substring_regex(texts, _OTHER)
        low = pc.utf8_lower(texts)
        if pc.any(other).as_py():
            low = pc.coalesce(pa.array([" ".join(t.lower().split()) if o else None for t, o in zip(texts.to_pylist(), other.to_pylist())],
                                       pa.string()), low)
        lists = pc.ascii_split_whitespace(low)
        owner = np.repeat(np.arange(len(texts)), np.diff(lists.offsets.to_numpy()))
        words = lists.flatten()
        if not len(words):
            return owner, np.zeros(0, np.uint64)
        _, places, data = words.buffers()
        places = np.frombuffer(places, np.int32)[words.offset:words.offset + len(words) + 1]
        data = np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8)
        found = np.empty(len(words), np.uint64)
        start = 0
        while start < len(words):  # pieces of many bytes, but of whole words
            end = max(start + 1, int(np.searchsorted(places, places[start] + BYTES, "right")) - 1)
            own = places[start:end + 1] - places[start]
            if own[-1] >= len(self.powers):
                self._reach(int(own[-1]))
            sums = np.zeros(own[-1] + 1, np.uint64)
            np.cumsum(self.numbers.take(data[places[start]:places[end]]) * self.powers[:own[-1]], out=sums[1:])
            sums = sums.take(own)
            found[start:end] = (sums[1:] - sums[:-1]) * self.inverse.take(own[:-1])
            start = end
        real = places[1:] > places[:-1]  # none is before or behind the white space at the ends of a text
        owner, found = owner[real], found[real]
        found ^= found >> np.uint64(32)
        found *= np.uint64(FACTOR)
        found ^= found >> np.uint64(29)
        return owner, found


def rolled(values: np.ndarray, n: int) -> np.ndarray:
    """A hash of every ``n`` values in a row."""
    done, size, block, width = None, 0, values, 1
    while True:
        if n & width:
            if done is None:
                done = block
            else:
                many = max(0, len(done) - width)
                done = done[:many] * np.uint64(pow(FACTOR, width, 1 << 64)) + block[size:size + many]
            size += width
        if size == n:
            return done
        many = max(0, len(block) - width)
        block = block[:many] * np.uint64(pow(FACTOR, width, 1 << 64)) + block[width:width + many]
        width *= 2


def _least(values: np.ndarray, n: int) -> np.ndarray:
    """The smallest of every ``n`` values in a row."""
    width = 1
    while 2 * width <= n:
        values, width = np.minimum(values[:-width], values[width:]), 2 * width
    rest = n - width
    return np.minimum(values[:-rest], values[rest:]) if rest else values


def _windows(texts: pa.Array | list[str], min_words: int, hashes: _Hashes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of all windows of ``min_words`` words: the number of their text, their seed, their hash.

    The seed is the smallest hash of ``GRAM`` words inside the window, so it depends on
    nothing but the window's words, and windows in a row mostly share it.
    """
    owner, values = hashes(texts if isinstance(texts, pa.Array) else pa.array(texts, pa.string()))
    if len(values) < min_words:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    gram = min(GRAM, min_words)
    seeds = _least(rolled(values, gram), min_words - gram + 1)
    inside = owner[:len(seeds)] == owner[min_words - 1:]
    return owner[:len(seeds)][inside], seeds[inside], rolled(values, min_words)[inside]


def _repeated_seeds(texts: DataFrame, min_words: int) -> np.ndarray:
    """Seeds that several documents have, as a table of bits by their lowest bits.

    Bits that are set for other seeds cost time, never results.
    """
    schema = pa.schema([("seed", pa.int64()), ("doc_id", pa.int64())])

    def work(batches):
        hashes = _Hashes()
        for batch in batches:
            owner, seeds, _ = _windows(batch.column("text"), min_words, hashes)
            new = np.ones(len(seeds), bool)
            new[1:] = (seeds[1:] != seeds[:-1]) | (owner[1:] != owner[:-1])
            yield record_batch(schema, seeds[new].view(np.int64), column(batch, "doc_id")[owner[new]])

    seeds = map_batches(texts, "seed long, doc_id long", work).groupBy("seed").agg(
        F.min("doc_id").alias("first"), F.max("doc_id").alias("last")).where("first < last").select("seed")
    seeds = as_table(seeds, "seeds")
    bits = 1 << min(MAP_BITS, max(16, (16 * seeds.count()).bit_length()))
    # At most 2 ** MAP_BITS / 64 rows reach the driver.
    rows = seeds.select(F.col("seed").bitwiseAND(F.lit(bits - 1)).alias("b")).groupBy(
        F.shiftright("b", 6).alias("at")).agg(F.bit_or(F.expr("shiftleft(1L, cast(b & 63 AS int))")).alias("set")).toArrow()
    table = np.zeros(bits // 64, np.int64)
    table[rows["at"].to_numpy()] = rows["set"].to_numpy()
    return table.view(np.uint64)


def pair_documents(docs: DataFrame, min_words: int = 30, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(first, doc_id): pairs to align; every document with the first holder of each of its windows of
    ``min_words`` words."""
    schema = pa.schema([("window", pa.int64()), ("doc_id", pa.int64())])
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).where(
        "doc_id is not null and text is not null")
    table = texts.sparkSession.sparkContext.broadcast(_repeated_seeds(texts, min_words))

    def work(batches):
        hashes, known = _Hashes(), table.value
        for batch in batches:
            owner, seeds, windows = _windows(batch.column("text"), min_words, hashes)
            low = seeds & np.uint64(64 * len(known) - 1)
            hit = (known[(low >> np.uint64(6)).astype(np.int64)] >> (low & np.uint64(63)) & np.uint64(1)) == 1
            owner, windows = owner[hit], windows[hit]
            # A window that a text repeats counts once, so no window has more rows than texts.
            once = np.unique(windows ^ owner.astype(np.uint64) * np.uint64(FACTOR),
                             return_index=True)[1]
            yield record_batch(schema, windows[once].view(np.int64), column(batch, "doc_id")[owner[once]])

    windows = as_table(map_batches(texts, "window long, doc_id long", work), "windows")
    shared = windows.groupBy("window").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last")).where(
        "first < last").drop("last")
    return windows.join(shared, "window").where("first < doc_id").select("first", "doc_id").distinct()


def find_blocks(docs: DataFrame, min_words: int = 30, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, digest, first, start, end): blocks of characters that an earlier document has.

    ``digest`` is the xxhash64 of the text, for rows that share an id.
    """
    pairs = as_table(pair_documents(docs, min_words, id_col, text_col), "pairs")
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).where(
        "text is not null")
    needed = pairs.select(F.explode(F.array("first", "doc_id")).alias("id")).distinct()
    needed = as_table(needed, "needed")
    texts = texts.join(F.broadcast(needed) if fits_broadcast(needed) else needed, "id", "left_semi")
    texts = as_table(texts.withColumn("digest", F.xxhash64("text")), "texts")
    if texts.count() > texts.select("id").distinct().count():  # repeated ids: each text once
        texts = as_table(texts.dropDuplicates(["id", "digest"]), "texts")
    later = texts.select(F.col("id").alias("doc_id"), "digest", F.col("text").alias("later"))
    earlier = texts.select(F.col("id").alias("first"), F.col("text").alias("earlier"))
    schema = pa.schema([("doc_id", pa.int64()), ("digest", pa.int64()), ("first", pa.int64()),
                        ("start", pa.int32()), ("end", pa.int32())])

    def work(batch):
        rows, split = Rows(schema), None
        for doc, digest, first, text, other in zip(*(batch.column(c).to_pylist() for c in
                                                     ("doc_id", "digest", "first", "later", "earlier"))):
            if split is None or split.text != other:  # rows come in order of the earlier document
                split = _Split(other)
            for start, end in common_blocks(split, text, min_words):
                rows.add((doc, digest, first, start, end))
        return rows.take()

    # The pairs are two numbers each: broadcast where they fit, so that the later texts stay where they are.
    near = F.broadcast(pairs) if fits_broadcast(pairs) else pairs
    return each_batch(later.join(near, "doc_id").join(earlier, "first"),
                      "doc_id long, digest long, first long, start int, end int", work)


def dedup_lines(docs: DataFrame, min_words: int = 30, id_col: str = "doc_id", text_col: str = "text",
                report: bool = False) -> DataFrame:
    """The rows with the blocks deleted that an earlier document has; all columns stay.

    ``report`` adds n_blocks and removed_chars, in place of columns of these names. Texts that lose everything become empty. Null
    texts and rows with a null doc_id stay as they are and are compared with nothing; rows that
    share an id (repeated rows too) are not compared with each other, each is aligned with every earlier
    document's texts; an empty table gives no rows; all other columns pass through.
    """
    if report:
        docs = docs.drop("n_blocks", "removed_chars")
    blocks = as_table(find_blocks(docs, min_words, id_col, text_col), "blocks")
    spans = as_table(blocks.groupBy("doc_id", "digest").agg(
        F.array_sort(F.collect_set(F.struct("start", "end"))).alias("spans")), "spans")
    if fits_broadcast(spans):
        spans = F.broadcast(spans)
    mark = "_spans"
    while mark in docs.columns:
        mark += "_"
    spans = spans.select(F.col("doc_id").alias(mark + "id"), F.col("digest").alias(mark + "digest"),
                         F.col("spans").alias(mark))
    joined = docs.join(spans, (docs[id_col].cast("long") == spans[mark + "id"])
                       & (F.xxhash64(docs[text_col]) == spans[mark + "digest"]), "left").select(
        *(docs[c] for c in docs.columns), mark)
    ddl = ", ".join(f"`{n}` {t}" for n, t in docs.dtypes) + (
        ", n_blocks long, removed_chars long" if report else "")

    def work(batch):
        n = batch.num_columns - 1
        own = {batch.schema.field(i).name: batch.column(i) for i in range(n)}
        found = batch.column(n).to_pylist()
        texts = own[text_col].to_pylist()
        new = [cut_spans(t, [(s["start"], s["end"]) for s in f]) if f else t for t, f in zip(texts, found)]
        own[text_col] = pa.array(new, pa.string())
        fields = [pa.field(name, values.type) for name, values in own.items()]
        if report:
            own["n_blocks"] = pa.array([len(f or ()) for f in found], pa.int64())
            own["removed_chars"] = pa.array([len(t or "") - len(x or "") for t, x in zip(texts, new)], pa.int64())
            fields += [pa.field("n_blocks", pa.int64()), pa.field("removed_chars", pa.int64())]
        return record_batch(pa.schema(fields), *own.values())

    return each_batch(joined, ddl, work)
