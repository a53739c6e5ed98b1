"""Token ids of whole texts by a tokenizers file, with a worker-side cache of words.

For the lower-casing word vocabulary, a text without unusual characters is cut at white
space, and its distinct chunks are lowered and cut into words, all by array operations: the
ids of a word do not depend on its neighbours, so words are looked up in a bounded cache and
only unseen ones reach the library. The cache is an Arrow array of words and one array of
ids, not a dictionary of objects. Any other text, and any other tokenizer file, goes to the
library whole. Ids are equal either way.
"""

from __future__ import annotations

import json
import os
import string
from array import array

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

from tokenizers import Tokenizer, normalizers, pre_tokenizers  # noqa: E402

from brindle.llm.batches import Words, hold, ragged  # noqa: E402

# The settings in the tokenizer file for which chunks may be looked up.
_WORDS = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_NORMALIZERS = ["NFC", "Replace", "Lowercase"]
# Characters that lower-casing, composition or white-space rules may treat differently, and
# what could start a special token.
_UNUSUAL = "[^\t\n\r -~\xa1-įı-˿‐-‧‰-⁞]|<\\|"
# What may be cut off behind letters: an apostrophe may belong to the letters behind it.
_MARKS = "".join(c for c in string.punctuation if c != "'")
#: Words in a worker's cache (about 10 MB) and the longest that is kept, in bytes.
CACHE, LONGEST = 400_000, 64
#: Words that the library gets at once: what it returns takes some hundred bytes an id.
TOGETHER = 8192


class Known:
    """Words with their ids, and the batch that last used them."""

    def __init__(self):
        # What is cut into nothing has no ids.
        self.words = pa.array([""], pa.string())
        self.data, self.sizes = np.zeros(0, "<u4"), np.zeros(1, np.int32)
        self.used, self.batch = np.zeros(1, np.int32), 0

    def __len__(self) -> int:
        return len(self.words) - 1

    def first(self) -> np.ndarray:
        return (np.cumsum(self.sizes) - self.sizes).astype(np.int32)

    def add(self, words: pa.Array, data: np.ndarray, sizes: np.ndarray) -> None:
        self.words = pa.concat_arrays([self.words, words])
        self.data, self.sizes = np.concatenate([self.data, data]), np.concatenate([self.sizes, sizes])
        self.used = np.concatenate([self.used, np.zeros(len(words), np.int32)])

    def trim(self, most: int) -> None:
        """Once there are more than ``most`` words, keep the half of them used last; long words always go."""
        stays = pc.binary_length(self.words).to_numpy() <= LONGEST
        if len(self) > most:
            stays[np.argsort(self.used[1:], kind="stable")[:len(self) - most // 2] + 1] = False
        if stays.all():
            return
        kept = np.flatnonzero(stays)
        self.data = ragged(self.data, self.first(), self.sizes, kept)[0]
        self.words, self.sizes, self.used = self.words.take(pa.array(kept)), self.sizes[kept], self.used[kept]


class Encoder:
    """``encode(texts) -> list of bytes``: ids as little-endian unsigned 32-bit integers."""

    def __init__(self, path: str, cache: int | None = None):
        self.cache = cache
        self.full = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        steps = [s["type"] for s in ((spec.get("normalizer") or {}).get("normalizers") or [])]
        cuts = (spec.get("pre_tokenizer") or {}).get("pretokenizers") or [{}]
        self.by_chunk = (steps == _NORMALIZERS
                         and cuts[0].get("pattern", {}).get("Regex") == _WORDS
                         and all(t["content"].startswith("<|") for t in spec["added_tokens"])
                         and not spec.get("post_processor") and not spec.get("truncation"))
        if self.by_chunk:
            self.bare = Tokenizer.from_file(path)
            self.bare.normalizer = normalizers.Sequence([])
            self.bare.pre_tokenizer = pre_tokenizers.Sequence([
                pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
            # Every word's last token, and no other, ends with the suffix.
            suffix = spec["model"]["end_of_word_suffix"]
            self.by_chunk = bool(suffix)
            self.ends = np.zeros(self.full.get_vocab_size(), bool)
            for token, number in self.full.get_vocab().items():
                self.ends[number] = bool(suffix) and token.endswith(suffix)
        self.chunk_ids = Known()

    def id_bits(self, *others: int) -> int:
        """Bits of the largest id of the vocabulary and ``others``."""
        return max(1, self.full.get_vocab_size() - 1, *others).bit_length()

    def _learn(self, words: pa.Array) -> None:
        """Learn words, many in one call of the library: as one text, cut at the words' ends."""
        found = []
        for at in range(0, len(words), TOGETHER):
            text = " ".join(words.slice(at, TOGETHER).to_pylist())
            found.append(np.array(self.bare.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u4"))
        ids = np.concatenate(found)
        self.chunk_ids.add(words, ids, np.diff(np.flatnonzero(self.ends[ids]), prepend=-1).astype(np.int32))

    def _places(self, words: pa.Array) -> np.ndarray:
        """Where the cache has the words, after it has learned the unseen ones."""
        known, coded = self.chunk_ids, words.dictionary_encode()
        known.trim(self.cache or CACHE)
        known.batch += 1
        # The cache is looked up among the batch's words, which are fewer.
        found = pc.fill_null(pc.index_in(known.words, coded.dictionary), -1).to_numpy()
        here = np.flatnonzero(found >= 0)
        places = np.full(len(coded.dictionary), -1, np.int64)
        places[found[here]] = here
        new = places < 0
        if new.any():
            unseen = coded.dictionary.filter(pa.array(new))
            places[new] = np.arange(len(known.words), len(known.words) + len(unseen))
            self._learn(unseen)
        known.used[places] = known.batch
        return places[coded.indices.to_numpy()]

    def _chunks(self, chunks: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of distinct chunks: an array, and the chunks' first places and sizes in it."""
        low = pc.utf8_lower(chunks)
        heads = pc.ascii_rtrim(low, characters=_MARKS)
        plain = pc.utf8_is_alpha(heads)
        # Letters and the marks behind them, often none, are two words; they lie in this order already.
        own, half = low.filter(plain), pc.binary_length(heads.filter(plain)).to_numpy()
        offsets = np.frombuffer(own.buffers()[1], np.int32, len(own) + 1, 4 * own.offset)
        both = np.append(np.stack([offsets[:-1], offsets[:-1] + half], axis=1).ravel(), offsets[-1])
        pairs = pa.StringArray.from_buffers(2 * len(own), pa.py_buffer(both), own.buffers()[2])
        cut = pc.ascii_split_whitespace(pc.ascii_ltrim_whitespace(
            pc.replace_substring_regex(low.filter(pc.invert(plain)), f"({_WORDS})", r" \1")))
        places = self._places(pa.concat_arrays([pairs, cut.flatten()]))
        data, done = ragged(self.chunk_ids.data, self.chunk_ids.first(), self.chunk_ids.sizes, places)
        plain = plain.to_numpy(zero_copy_only=False)
        borders = np.concatenate([done[:2 * len(own):2], done[2 * len(own) + cut.offsets.to_numpy()]])
        first, sizes = np.empty(len(chunks), np.int32), np.empty(len(chunks), np.int32)
        for mask, part in ((plain, slice(0, len(own))), (~plain, slice(len(own), len(chunks)))):
            first[mask], sizes[mask] = borders[:-1][part], np.diff(borders)[part]
        return data, first, sizes

    def _whole(self, text: str) -> bytes:
        return array("I", self.full.encode(text, add_special_tokens=False).ids).tobytes()

    def encode_batch(self, texts: pa.Array, end: bytes = b"") -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts (null: empty) with ``end`` behind each, one after another, and the texts' borders."""
        texts = pc.fill_null(texts, "")
        whole = (pc.match_substring_regex(texts, _UNUSUAL).to_numpy(zero_copy_only=False) if self.by_chunk
                 else np.ones(len(texts), bool))
        # A text that only the library may cut is one word here: its number behind a character that others lack.
        names = {f"\0{i}": i for i in np.flatnonzero(whole).tolist()}
        if names:
            marks = np.full(len(texts), None, object)
            marks[whole] = list(names)
            cut = pc.ascii_split_whitespace(pc.coalesce(pa.array(marks, pa.string()), texts))
        else:
            cut = pc.ascii_split_whitespace(texts)
        words = Words(cut)
        if not names:
            return words.join(*self._chunks(words.dictionary), end)
        marked = pc.starts_with(words.dictionary, "\0")
        data, place, size = self._chunks(words.dictionary.filter(pc.invert(marked)))
        own = [np.frombuffer(self._whole(texts[names[w]].as_py()), "<u4")
               for w in words.dictionary.filter(marked).to_pylist()]
        marked = marked.to_numpy(zero_copy_only=False)
        first, sizes = np.empty(len(marked), np.int32), np.empty(len(marked), np.int32)
        first[~marked], sizes[~marked] = place, size
        sizes[marked] = [len(ids) for ids in own]
        first[marked] = len(data) + np.cumsum(sizes[marked]) - sizes[marked]
        return words.join(np.concatenate([data, *own]), first, sizes, end)

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        ids, borders = self.encode_batch(pa.array(texts, pa.string()))
        data, ends = ids.tobytes(), (4 * borders).tolist()
        return [data[a:b] for a, b in zip(ends, ends[1:])]


_ENCODERS: dict[tuple, Encoder] = {}


def encoder(path: str, cache: int | None = None) -> Encoder:
    """The worker's encoder for a tokenizer file, with at most about ``cache`` entries a cache; loaded once per Python worker."""
    hold("wordbpe", _ENCODERS.clear)
    if (path, cache) not in _ENCODERS:
        _ENCODERS.clear()  # one at a time, for the caches would add up
        _ENCODERS[path, cache] = Encoder(path, cache)
    return _ENCODERS[path, cache]
