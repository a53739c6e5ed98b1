"""SentencePiece models of the merge type: exact encoding by backtracking, and decoding.

A text's encoding is the only sequence of pieces in which every two neighbours are *compatible*:
merging the text of the two from its characters gives just these two. So instead of merging
a whole text, the encoder walks over it with the longest piece that starts at each place (found by
one Aho-Corasick pass), steps back to shorter ones where a neighbour is not compatible, and marks places
that lead nowhere in a bitfield, so that no place is tried twice. Compatibility is decided by re-merging
two pieces, at most a few dozen characters, and remembered.

Texts are cut where no piece crosses: before a run of spaces, if the vocabulary has none with a space behind
another character. Chunks then repeat, and each worker remembers a bounded number of them.
"""

from __future__ import annotations

import codecs
import heapq
import os
import re
from array import array

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType
from sentencepiece import SentencePieceProcessor
from sentencepiece import sentencepiece_model_pb2 as model_file

from brindle.llm.batches import Words, hold, map_batches

#: The sign that stands for a space inside pieces.
SPACE = "▁"
#: Chunks (twice as many) and pairs of pieces that a worker remembers, the longest chunk that it does, ids of an output batch.
CHUNKS, PAIRS, LONGEST, OUT_IDS = 120_000, 200_000, 64, 1 << 20


_PARTS = re.compile(r" *\w+|\W+").findall


def _each_byte(error: UnicodeError):
    return "�" * (error.end - error.start), error.end


codecs.register_error("brindle-each-byte", _each_byte)


class Model:
    """The pieces of a model file, with encoding and decoding of single texts."""

    def __init__(self, path: str):
        proto = model_file.ModelProto()
        with open(path, "rb") as file:
            proto.ParseFromString(file.read())
        kind, normal, trained = proto.SentencePiece.Type, proto.normalizer_spec, proto.trainer_spec
        kinds = [p.type for p in proto.pieces]
        if (trained.model_type != trained.BPE or normal.precompiled_charsmap or normal.remove_extra_whitespaces
                or not normal.escape_whitespaces or trained.treat_whitespace_as_suffix
                or proto.denormalizer_spec.precompiled_charsmap or kind.USER_DEFINED in kinds or kind.UNUSED in kinds):
            raise ValueError(f"{os.path.basename(path)}: only merge-type models that take texts as they are")
        self.prefix = " " if normal.add_dummy_prefix else ""
        self.text = [p.piece.replace(SPACE, " ") for p in proto.pieces]
        self.ids = {self.text[i]: i for i, k in enumerate(kinds) if k == kind.NORMAL}
        self.score = {t: proto.pieces[i].score for t, i in self.ids.items()}
        self.unknown = kinds.index(kind.UNKNOWN)
        self.end_id = next((i for i, p in enumerate(proto.pieces) if p.piece == (trained.eos_piece or "</s>")), -1)
        self.byte_ids = None
        if trained.byte_fallback:
            self.byte_ids = [next(i for i, p in enumerate(proto.pieces) if p.piece == f"<0x{b:02X}>") for b in range(256)]
        self.control = np.array([k == kind.CONTROL for k in kinds])
        self.surface = [t.encode() for t in self.text]
        for i, k in enumerate(kinds):
            if k == kind.CONTROL:
                self.surface[i] = b""
            elif k == kind.UNKNOWN:
                self.surface[i] = trained.unk_surface.encode()
        for value, i in enumerate(self.byte_ids or []):
            self.surface[i] = bytes([value])
        self.starts_with_space = np.array([t.startswith(" ") and k == kind.NORMAL for t, k in zip(self.text, kinds)])
        # Scores that several pieces share: there the order of merges is not that of the pieces alone.
        seen: dict[float, list[str]] = {}
        for t, s in self.score.items():
            seen.setdefault(s, []).append(t)
        tied = {t for own in seen.values() if len(own) > 1 for t in own}
        self.cuts_at_spaces = not any(" " in t.lstrip(" ") for t in self.ids)
        # Tied pieces of spaces only: runs of spaces are merged as they are, all other chunks are walked over.
        self.spaces_tied = any(not t.strip(" ") for t in tied)
        self.walks = all(not t.strip(" ") for t in tied) and self.cuts_at_spaces
        self.finder = ahocorasick.Automaton()
        for t in self.ids:
            self.finder.add_word(t, (len(t) - 1, t))
        self.finder.make_automaton()
        # Neighbouring characters inside pieces; between any others a text can be cut.
        self.inside = {t[i:i + 2] for t in self.ids for i in range(len(t) - 1)}
        # A run of characters that are no pieces.
        single = "".join(t for t in self.ids if len(t) == 1)
        self.strange = re.compile(f"([^{re.escape(single)}]+)", re.DOTALL)
        # The order of merges, which goes by score; -1 for what is no merge.
        order = sorted(self.score, key=self.score.get, reverse=True)
        self.rank = {t: i if len(t) > 1 else -1 for i, t in enumerate(order)}
        self.halves: dict[str, tuple[str, str] | None] = {}
        self.prefixes: dict[str, str | None] = {}
        self.pairs: dict[str, bool] = {}
        # Chunks of late, and those of the generation before, from which the frequent ones return.
        self.chunks: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    # ---- encoding -------------------------------------------------------------------------

    def merge(self, text: str, until: int | None = None) -> list[str]:
        """Pieces of ``text`` by merging neighbours, best score first, then leftmost: the definition.

        With ``until`` only merges that come before that one.
        """
        parts: list[str | None] = list(text)
        after, before = list(range(1, len(parts) + 1)), list(range(-1, len(parts) - 1))
        heap: list[tuple[float, int, str]] = []

        def offer(left: int, right: int) -> None:
            if left >= 0 and right < len(parts):
                joined = parts[left] + parts[right]
                if joined in self.score and (until is None or self.rank[joined] < until):
                    heapq.heappush(heap, (-self.score[joined], left, joined))
        for i in range(len(parts) - 1):
            offer(i, i + 1)
        while heap:
            _, left, joined = heapq.heappop(heap)
            if parts[left] is None or after[left] >= len(parts) or parts[left] + parts[after[left]] != joined:
                continue
            right = after[left]
            parts[left], parts[right] = joined, None
            after[left] = after[right]
            if after[left] < len(parts):
                before[after[left]] = left
            offer(before[left], left)
            offer(left, after[left])
        return [p for p in parts if p is not None]

    def last_merge(self, piece: str) -> tuple[str, str] | None:
        """The two pieces whose merge gives ``piece``; None if merging its text gives something else."""
        if piece not in self.halves:
            whole = self.merge(piece) == [piece]
            ways = ((piece[:n], piece[n:]) for n in range(1, len(piece)))
            self.halves[piece] = next((w for w in ways if self.merge(piece, self.rank[piece]) == list(w)), None) if whole else None
        return self.halves[piece]

    def compatible(self, left: str, right: str) -> bool:
        """Whether the two pieces (or the right one alone) stay as they are when their text is merged anew.

        Merging is replayed backwards: the later of the two pieces' merges is undone, and the parts at the border
        must not have been a better merge at that time.
        """
        rank = self.rank
        if len(right) > 1 and not self.last_merge(right):
            return False
        if not left:
            return True
        until = len(rank)
        while True:
            if rank.get(left + right, until) < until:
                return False
            a, b = rank[left], rank[right]
            if a > b:
                until, left = a, self.halves.get(left, ()) or self.last_merge(left)
                left = left[1]
            elif b >= 0:
                # Of two equal merges the left one comes first.
                until, right = b + 1, self.halves.get(right, ()) or self.last_merge(right)
                right = right[0]
            else:
                return True

    def shorter(self, piece: str) -> str | None:
        """The longest piece that is a proper prefix of ``piece``."""
        if piece not in self.prefixes:
            self.prefixes[piece] = next((piece[:n] for n in range(len(piece) - 1, 0, -1) if piece[:n] in self.ids), None)
        return self.prefixes[piece]

    def walk(self, text: str) -> list[str]:
        """Pieces of a text of known characters, by backtracking over longest matches."""
        size = len(text)
        longest: list[str | None] = [None] * (size + 1)
        for end, (back, piece) in self.finder.iter(text):  # by their ends, so the longest from a place comes last
            longest[end - back] = piece
        failed = bytearray(size // 8 + 1)
        found: list[str] = []
        at, piece, last, pairs = 0, longest[0], "", self.pairs
        while at < size:
            end = at + len(piece)
            if not (failed[end >> 3] >> (end & 7)) & 1:
                pair = f"{last}\n{piece}"
                fits = pairs.get(pair)
                if fits is None:
                    if len(pairs) >= PAIRS:
                        pairs.clear()
                    fits = pairs[pair] = self.compatible(last, piece)
                if fits:
                    found.append(piece)
                    at, piece, last = end, longest[end], piece
                    continue
            piece = self.shorter(piece)
            if piece is None:
                # Nothing goes on from here.
                failed[at >> 3] |= 1 << (at & 7)
                piece = found.pop()
                at -= len(piece)
                last = found[-1] if found else ""
        return found

    def pieces(self, chunk: str) -> list[int]:
        """Ids of a chunk whose borders no piece crosses."""
        out: list[int] = []
        for i, run in enumerate(self.strange.split(chunk)):
            if i % 2:
                out += [self.byte_ids[b] for b in run.encode()] if self.byte_ids else [self.unknown]
            elif run:
                merged = not self.walks or self.spaces_tied and "  " in run
                out += [self.ids[p] for p in (self.merge(run) if merged else self.walk(run))]
        return out

    def learned(self, chunks: list[str]) -> list[bytes]:
        """Ids of chunks as little-endian unsigned 32-bit integers."""
        recent, older, out = self.chunks, self.older, []
        for chunk in chunks:
            ids = recent.get(chunk)
            if ids is None:
                ids = older.get(chunk)
                if ids is None:
                    parts = self.parts(chunk)
                    if len(parts) > 1:
                        ids = b"".join(self.learned(parts))
                    else:
                        ids = array("I", self.pieces(chunk)).tobytes()
                if len(chunk) <= LONGEST:
                    recent[chunk] = ids
            out.append(ids)
        return out

    def _age(self) -> None:
        if len(self.chunks) > CHUNKS:
            self.chunks, self.older = {}, self.chunks

    def parts(self, chunk: str) -> list[str]:
        """Words and what stands between them, joined again where a piece may cross."""
        found = _PARTS(chunk)
        if len(found) > 1:
            for i in range(len(found) - 1, 0, -1):
                if found[i - 1][-1] + found[i][0] in self.inside:
                    found[i - 1] += found.pop(i)
        return found

    def cut(self, text: str) -> list[str]:
        """Chunks of a text (spaces in place of their signs) that can be encoded alone."""
        return re.findall(r" *[^ ]+| +", text) if self.cuts_at_spaces else [text]

    def encode(self, text: str) -> list[int]:
        """Ids of one text."""
        self._age()
        text = text.replace(SPACE, " ")
        return np.frombuffer(b"".join(self.learned(self.cut(self.prefix + text if text else ""))), "<u4").tolist()

    def encode_batch(self, texts: pa.Array, end: bytes = b"") -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, one after another, and the texts' borders."""
        self._age()
        texts = pc.fill_null(texts, "")
        if pc.any(pc.match_substring(texts, SPACE)).as_py():
            texts = pc.replace_substring(texts, SPACE, " ")
        if self.cuts_at_spaces and self.prefix:
            # Words between single spaces: each is the chunk of a space and the word.
            plain = pc.invert(pc.match_substring_regex(texts, "^ |  | $|^$"))
            if pc.all(plain).as_py():
                words = Words(pc.split_pattern(texts, " "))
                return words.gather(self.learned([" " + w for w in words.distinct]), end)
        words = Words(pa.array([self.cut(self.prefix + t if t else "") for t in texts.to_pylist()], pa.list_(pa.string())))
        return words.gather(self.learned(words.distinct), end)

    # ---- decoding -------------------------------------------------------------------------

    def decode_batch(self, lists: pa.ListArray) -> list[str]:
        """The text of each list of ids; bytes that are no UTF-8 become replacement characters, one each."""
        ids = lists.flatten().to_numpy().astype(np.int64)
        borders = lists.offsets.to_numpy().astype(np.int64)
        borders = borders - borders[0]
        if len(ids) and (ids.min() < 0 or ids.max() >= len(self.surface)):
            raise ValueError("ids outside the model")
        lengths = np.fromiter(map(len, self.surface), np.int64, len(self.surface))
        ends = np.concatenate([[0], np.cumsum(lengths[ids])])
        joined = pc.binary_join(
            pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), pa.array(self.surface, pa.binary()).take(pa.array(ids))),
            b"")[0].as_py()
        out = []
        quiet = self.control[ids]
        spoken = np.flatnonzero(~quiet)
        heads = np.searchsorted(spoken, borders[:-1])
        for row, (a, b) in enumerate(zip(borders[:-1].tolist(), borders[1:].tolist())):
            start, head = int(ends[a]), int(spoken[heads[row]]) if heads[row] < len(spoken) else b
            if self.prefix and head < b:
                start += int(self.starts_with_space[ids[head]])  # the space put before a text goes again
            # Bytes on two sides of a control id are no character together.
            parts = [start, *(int(ends[a + i]) for i in np.flatnonzero(quiet[a:b]) if ends[a + i] > start), int(ends[b])]
            out.append("".join(joined[x:y].decode("utf-8", "brindle-each-byte") for x, y in zip(parts, parts[1:])))
        return out


_MODELS: dict[str, Model] = {}


def load(path: str) -> Model:
    """The worker's model, read once."""
    hold("piece_bpe", _MODELS.clear)
    if path not in _MODELS:
        _MODELS[path] = Model(path)
    return _MODELS[path]


def encode(docs: DataFrame, model: str, end: bool = True, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, ids): what the sentencepiece library gives for every whole text, then the end id if ``end``.

    ``model`` is the path of a merge-type model without normalization. A null text counts as empty (just the end
    id); very long texts are encoded whole, in memory in proportion to their length; repeated rows give repeated
    rows; a null doc_id stays null; an empty table gives no rows; other columns, whatever their names, are ignored.
    """
    schema = pa.schema([("doc_id", pa.int64()), ("ids", pa.list_(pa.int32()))])

    def work(batches):
        for batch in batches:
            own = load(model)
            tail = np.array([own.end_id], "<u4").tobytes() if end else b""
            ids, borders = own.encode_batch(batch.column("text"), tail)
            first = 0
            while first < batch.num_rows:
                # A batch of results holds a bounded number of ids, or one document.
                last = max(first + 1, int(np.searchsorted(borders, borders[first] + OUT_IDS, "right")) - 1)
                lists = pa.ListArray.from_arrays(
                    pa.array(borders[first:last + 1] - borders[first], pa.int32()),
                    pa.array(ids[borders[first]:borders[last]].view(np.int32)))
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(first, last - first), lists], schema=schema)
                first = last

    return map_batches(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")),
                       "doc_id long, ids array<int>", work)


def decode(rows: DataFrame, model: str, ids_col: str = "ids", out: str = "decoded") -> DataFrame:
    """All columns of ``rows`` and the text ``out`` of its ids, as the library decodes them.

    A null list gives a null text, an empty one the empty text, control ids (begin, end) nothing. Ids outside the
    model and null ids are an error. Repeated rows stay, an empty table gives no rows; a column that is named
    ``out`` already is replaced.
    """
    rows = rows.drop(out)
    schema = StructType([*rows.schema.fields, StructField(out, StringType())])
    place = rows.columns.index(ids_col)

    def work(batches):
        for batch in batches:
            lists = batch.column(place)
            found = load(model).decode_batch(pc.fill_null(lists, pa.scalar([], lists.type)))
            text = pc.if_else(lists.is_null(), pa.scalar(None, pa.string()), pa.array(found, pa.string()))
            yield pa.RecordBatch.from_arrays([*batch.columns, text], names=[*batch.schema.names, out])

    return map_batches(rows, schema, work)


def library(model: str) -> SentencePieceProcessor:
    """The library's own processor, to compare with."""
    return SentencePieceProcessor(model_file=model)
