"""Unigram (SentencePiece) encoding and decoding over a double-array trie."""

from __future__ import annotations

import math
import re
import zlib
from array import array
from collections.abc import Iterator
from functools import lru_cache
from itertools import groupby

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import documents, free_name, with_columns
from .pieces import Keys, slices

MARK = "▁"
UNKNOWN_PENALTY = 10.0
CACHE_SEGMENTS = 150_000
LONGEST_CACHED = 48
_SEGMENT = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+")


class DoubleArray:
    """Trie in two integer arrays: the child of ``s`` by code ``c`` is ``t = base[s] + c`` if ``check[t] == s``."""

    def __init__(self, words: dict[str, int]):
        counts: dict[str, int] = {}
        for word in words:
            for char in word:
                counts[char] = counts.get(char, 0) + 1
        self.codes = {c: k + 1 for k, c in enumerate(sorted(counts, key=lambda c: (-counts[c], c)))}
        tree: list[tuple[dict[int, int], int]] = [({}, -1)]  # children by code; value
        for word, value in words.items():
            at = 0
            for char in word:
                children = tree[at][0]
                code = self.codes[char]
                if code not in children:
                    children[code] = len(tree)
                    tree.append(({}, -1))
                at = children[code]
            tree[at] = (tree[at][0], value)
        base, check, value = [0], [-1], [-1]  # slot 0 is the root, which is nobody's child
        later = [1]  # of a taken slot, one at or before the next free slot
        tried: dict[int, int] = {}  # by number of children, where the last search ended

        def free(slot: int) -> int:
            """The first free slot from ``slot`` on."""
            path = []
            while slot < len(later) and later[slot] != slot:
                path.append(slot)
                slot = later[slot]
            for passed in path:
                later[passed] = slot
            return slot

        queue = [(0, 0)]
        for node, slot in queue:  # grows while it is read: breadth first
            children, value[slot] = tree[node]
            if not children:
                continue
            codes = sorted(children)
            at = free(max(codes[0] + 1, tried.get(len(codes), 1) if len(codes) > 1 else 1))
            while any(free(at - codes[0] + c) != at - codes[0] + c for c in codes[1:]):
                at = free(at + 1)
            tried[len(codes)] = at
            start = at - codes[0]
            if (more := start + codes[-1] + 1 - len(check)) > 0:
                later += range(len(later), len(later) + more)
                base += [0] * more
                check += [-1] * more
                value += [-1] * more
            base[slot] = start
            for code in codes:
                check[start + code], later[start + code] = slot, start + code + 1
                queue.append((children[code], start + code))
        self.base, self.check, self.value = array("i", base), array("i", check), array("i", value)

    def prefixes(self, text: str, at: int) -> Iterator[tuple[int, int]]:
        """``(end, value)`` of every word that begins at ``at``."""
        slot, base, check, codes, size = 0, self.base, self.check, self.codes, len(self.check)
        for end in range(at, len(text)):
            slot, before = base[slot] + codes.get(text[end], size), slot
            if slot >= size or check[slot] != before or slot == 0:
                return
            if self.value[slot] >= 0:
                yield end + 1, self.value[slot]


class Unigram:
    """Pieces with log scores.

    ``pieces`` maps a piece to its id and log score, ``byte_ids`` the 256 byte pieces
    to their ids. A character without a piece of its own costs the least score
    less 10 and is written as its UTF-8 bytes. Of equally good paths the one whose
    pieces begin earliest wins.
    """

    def __init__(self, pieces: dict[str, tuple[int, float]], byte_ids: list[int]):
        self.pieces = {p: k for p, (k, _) in pieces.items()}
        self.trie = DoubleArray(self.pieces)
        self.scores = {k: s for k, s in pieces.values()}
        self.unknown = min(self.scores.values(), default=0.0) - UNKNOWN_PENALTY
        self.byte_ids = byte_ids
        self.surface = {k: p.encode() for p, (k, _) in pieces.items()} | {k: bytes([b]) for b, k in enumerate(byte_ids)}
        #: No piece goes on after a marker that follows another character, so words can be solved one by one.
        self.by_word = not any(re.search(f"[^{MARK}]{MARK}", p) for p in pieces)

    def viterbi(self, text: str) -> tuple[list[int], float, int]:
        """Ids, log score and number of byte pieces of the best path."""
        size = len(text)
        best, back = [-math.inf] * (size + 1), [(0, -1)] * (size + 1)
        best[0] = 0.0
        scores, unknown = self.scores, self.unknown
        base, check, value, codes, slots = self.trie.base, self.trie.check, self.trie.value, self.trie.codes, len(self.trie.check)
        coded = [codes.get(c, slots) for c in text]
        for start in range(size):
            here, slot, alone = best[start], 0, False
            for end in range(start, size):  # DoubleArray.prefixes, written out: this loop is the hot one
                to = base[slot] + coded[end]
                if to >= slots or check[to] != slot:
                    break
                slot = to
                piece = value[slot]
                if piece >= 0:
                    alone |= end == start
                    score = here + scores[piece]
                    if score > best[end + 1]:
                        best[end + 1], back[end + 1] = score, (start, piece)
            if not alone and here + unknown > best[start + 1]:
                best[start + 1], back[start + 1] = here + unknown, (start, -1)
        ids: list[int] = []
        n_bytes, at = 0, size
        while at:
            start, piece = back[at]
            if piece >= 0:
                ids.append(piece)
            else:
                raw = text[start:at].encode("utf-8", "surrogatepass")
                ids += [self.byte_ids[b] for b in reversed(raw)]
                n_bytes += len(raw)
            at = start
        return ids[::-1], best[size], n_bytes

    def segments(self, text: str) -> list[str]:
        """The text with a marker before it and for every space, cut before runs of markers.

        One marker before a segment is understood; of a segment that begins with a marker, the rest is meant.
        """
        if not text:
            return []
        marked = MARK + text.replace(" ", MARK)
        return [s[1:] if s[0] == MARK and len(s) > 1 and s[1] != MARK else MARK + s for s in _SEGMENT.findall(marked)] if self.by_word else [marked[1:]]

    def decode(self, ids: list[int]) -> str:
        surface = self.surface
        text = b"".join([surface[k] for k in ids]).decode("utf-8", errors="replace").replace(MARK, " ")
        return text[1:] if text[:1] == " " else text


class Encoder:
    """A model with a bounded cache of solved segments; one per Python worker.

    Segments that are new in a batch are solved together, those of one length at a
    time, with every step of the recurrence taken for all of them at once.
    """

    def __init__(self, model: Unigram):
        self.model = model
        self.base, self.check, self.value = (np.array(x) for x in (model.trie.base, model.trie.check, model.trie.value))
        self.code = np.full(0x110000, len(self.check), np.int32)
        self.code[[ord(c) for c in model.trie.codes]] = list(model.trie.codes.values())
        self.score = np.zeros(max(model.scores, default=0) + 1)
        self.score[list(model.scores)] = list(model.scores.values())
        self.cache: dict[str, tuple[bytes, float, int]] = {}  # ids as 32-bit integers: smaller than arrays, and joined at once

    def _solve(self, texts: list[str]) -> Iterator[tuple[bytes, float, int]]:
        """As ``Unigram.viterbi``, for texts of one length, with the bytes of the ids."""
        n, size, slots = len(texts), len(texts[0]), len(self.check)
        points = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32).reshape(n, size)
        codes = self.code[points]
        best = np.full((size + 1, n), -np.inf)
        best[0] = 0
        back, piece_at = np.zeros((size + 1, n), np.int32), np.full((size + 1, n), -1, np.int32)
        for start in range(size):
            rows, slot, alone = np.arange(n), np.zeros(n, np.int32), np.zeros(n, bool)
            for end in range(start, size):
                to = self.base[slot] + codes[rows, end]
                inside = to < slots
                inside[inside] = self.check[to[inside]] == slot[inside]
                if not inside.any():
                    break
                rows, slot = rows[inside], to[inside]
                piece = self.value[slot]
                whole = piece >= 0
                if end == start:
                    alone[rows[whole]] = True
                at, piece = rows[whole], piece[whole]
                score = best[start, at] + self.score[piece]
                better = score > best[end + 1, at]
                at = at[better]
                best[end + 1, at], back[end + 1, at], piece_at[end + 1, at] = score[better], start, piece[better]
            score = best[start] + self.model.unknown
            at = np.flatnonzero(~alone & (score > best[start + 1]))
            best[start + 1, at], back[start + 1, at], piece_at[start + 1, at] = score[at], start, -1
        back, piece_at = back.T.tolist(), piece_at.T.tolist()
        for text, total, starts, pieces in zip(texts, best[size].tolist(), back, piece_at, strict=True):
            ids, n_bytes, at = [], 0, size
            while at:
                if pieces[at] >= 0:
                    ids.append(pieces[at])
                else:
                    raw = text[starts[at] : at].encode("utf-8", "surrogatepass")
                    ids += [self.model.byte_ids[b] for b in reversed(raw)]
                    n_bytes += len(raw)
                at = starts[at]
            yield array("i", ids[::-1]).tobytes(), total, n_bytes

    def _learn(self, segments: list[str]) -> None:
        for length, group in groupby(sorted(segments, key=lambda s: (len(s), s[:1] == MARK)), lambda s: (len(s), s[:1] == MARK)):
            same = list(group)
            marked = [s[1:] if length[1] else MARK + s for s in same]
            step = 4096 if length[0] <= LONGEST_CACHED else 1
            for at in range(0, len(same), step):
                if step > 1:
                    solved = self._solve(marked[at : at + step])
                else:
                    ids, score, n_bytes = self.model.viterbi(marked[at])
                    solved = [(array("i", ids).tobytes(), score, n_bytes)]
                for segment, found in zip(same[at : at + step], solved, strict=True):
                    self.cache[segment] = found

    def encode(self, texts: pa.Array) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
        """Per text its ids, its log score and its number of byte pieces."""
        ids, scores, n_bytes = [np.empty(0, np.int32)] * len(texts), np.zeros(len(texts)), np.zeros(len(texts), np.int64)
        even = ~pc.match_substring_regex(texts, f"^ |  | $|{MARK}|^$").to_numpy(zero_copy_only=False) & self.model.by_word
        for rows, keys in Keys.of(texts, even, self.model.segments):
            if len(self.cache) > CACHE_SEGMENTS:
                self.cache.clear()
            missing = [s for s in keys.names if s not in self.cache]
            self._learn(missing)
            found = [self.cache[s] for s in keys.names]
            if found:
                joined, starts = keys.joined(np.array([len(x[0]) // 4 for x in found]), np.frombuffer(b"".join([x[0] for x in found]), np.int32))
                for k, row in enumerate(rows):
                    ids[row] = joined[starts[k] : starts[k + 1]]
                scores[rows] = keys.sums(np.array([x[1] for x in found]))
                n_bytes[rows] = keys.sums(np.array([x[2] for x in found]))
            for segment in missing:
                if len(segment) > LONGEST_CACHED:
                    del self.cache[segment]
        return ids, scores, n_bytes


@lru_cache(maxsize=4)
def public_model(path: str) -> Unigram:
    """The pieces of a sentencepiece file with log scores by their rank.

    A BPE file orders its pieces by merge rank and has no probabilities. Its rank
    order is that of frequency, so the score is the log of Zipf's law,
    ``1 / (rank + 1)`` over the sum of all: a fixed rule, nothing is trained.
    A unigram file would bring scores of its own; give those to ``Unigram``.
    """
    import sentencepiece

    file = sentencepiece.SentencePieceProcessor(model_file=path)
    kinds = range(file.get_piece_size())
    plain = [k for k in kinds if not (file.is_byte(k) or file.is_control(k) or file.is_unknown(k) or file.is_unused(k))]
    total = math.log(sum(1 / (r + 1) for r in range(len(plain))))
    pieces = {file.id_to_piece(k): (k, -math.log(r + 1) - total) for r, k in enumerate(plain)}
    byte_ids = {int(file.id_to_piece(k)[3:-1], 16): k for k in kinds if file.is_byte(k)}
    return Unigram(pieces, [byte_ids[b] for b in range(256)])


@lru_cache(maxsize=4)
def _encoder(path: str) -> Encoder:
    return Encoder(public_model(path))


def encode(docs: DataFrame, model: str, new: str = "ids", decoded: str | None = None) -> DataFrame:
    """``docs`` with the ids of each text in the further column ``new`` (with underscores if the name is taken).

    Null and empty texts give an empty array. Equal texts get equal ids. No shuffle. With ``decoded``, a
    column of that name holds the text these ids decode to, as ``decode`` gives it, from the same worker.
    """

    def start():
        encoder = _encoder(model)

        def ids_of(texts: pa.Array) -> list[pa.Array]:
            parts = [x for some in slices(texts, 1 << 22) for x in encoder.encode(some)[0]]
            offsets = np.append(0, np.cumsum([len(x) for x in parts])).astype(np.int32)
            out = [pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate([np.empty(0, np.int32), *parts])))]
            return out + ([pa.array([encoder.model.decode(x.tolist()) for x in parts], pa.string())] if decoded else [])

        return ids_of

    return with_columns(docs, f"{new} array<int>" + (f", {decoded} string" if decoded else ""), start)


def decode(encoded: DataFrame, model: str, ids: str = "ids", new: str = "decoded") -> DataFrame:
    """``encoded`` with the text of each row's ids; markers become spaces, byte pieces their bytes, null ids an empty text."""

    @F.pandas_udf("string")
    def text_from(rows: Iterator[pd.Series]) -> Iterator[pd.Series]:
        unigram = public_model(model)
        for part in rows:
            yield pd.Series([unigram.decode(x.tolist()) if x is not None else "" for x in part], index=part.index)

    return encoded.withColumn(free_name(encoded, new), text_from(F.col(ids)))


def unigram_digest(docs: DataFrame, model: str) -> DataFrame:
    """Encode and decode every whole text; ``doc_id`` and a digest of both directions.

    ``ids_crc32`` is the crc32 of the ids as little-endian 32-bit integers, ``decoded_crc32``
    that of the decoded UTF-8 text, ``round_trip`` whether it equals the input
    (it cannot where a text itself holds the marker U+2581, which decodes to a space).
    Null and empty texts have no ids and score 0; repeated rows stay repeated; an
    empty table gives an empty one; extra columns are left out.
    """

    def start():
        encoder = _encoder(model)

        def digest(texts: pa.Array) -> list[pa.Array]:
            out = []
            for some in slices(texts, 1 << 22):
                for text, ids, score, n_bytes in zip(some.to_pylist(), *encoder.encode(some), strict=True):
                    back = encoder.model.decode(ids.tolist())
                    out.append((len(ids), n_bytes, round(score, 6), zlib.crc32(ids.astype("<i4")), zlib.crc32(back.encode()), back == text))
            kinds = (pa.int64(), pa.int64(), pa.float64(), pa.int64(), pa.int64(), pa.bool_())
            return [pa.array([row[k] for row in out], kind) for k, kind in enumerate(kinds)]

        return digest

    new = "n_ids long, n_byte_pieces long, log_score double, ids_crc32 long, decoded_crc32 long, round_trip boolean"
    return with_columns(documents(docs), new, start).drop("text")
