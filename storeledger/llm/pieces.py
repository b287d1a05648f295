"""Encoding texts piece by piece, with a bounded cache of pieces.

A tokenizer never merges across its pre-tokens, so a text may be cut wherever a
pre-token is sure to begin, and equal pieces have equal ids. Natural text repeats
its words: a batch is cut and its distinct pieces are found by Arrow, and only
those pieces are looked up, or encoded if they are new.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CUT = re.compile(r"(?<=\S)(?= \S)")
#: Two characters side by side that some library takes for white space, or NUL, which marks first pieces.
UNEVEN = r"[\s\p{Z}\x0b\x1c-\x1f\x{85}]{2}|\x00"
CACHE_PIECES = 900_000
LONGEST_CACHED = 48
BATCH_BYTES = 1 << 18


def balanced(texts: Iterable[str], most: int = BATCH_BYTES) -> Iterator[list[str]]:
    """Batches of at most ``most`` characters; a longer text is a batch of its own."""
    batch, held = [], 0
    for text in texts:
        if batch and held + len(text) > most:
            yield batch
            batch, held = [], 0
        batch.append(text)
        held += len(text) + 16
    if batch:
        yield batch


def slices(texts: pa.Array, most: int = 1 << 24) -> Iterator[pa.Array]:
    """Slices of about ``most`` bytes; a longer text is a slice of its own."""
    ends = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False))
    at = 0
    while at < len(texts):
        to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + most, "right")))
        yield texts.slice(at, to - at)
        at = to


def sliced(batches: Iterable[pa.RecordBatch], column: int, most: int = 1 << 22) -> Iterator[pa.RecordBatch]:
    """The batches, cut so that ``column`` holds about ``most`` bytes in each."""
    for rows in batches:
        at = 0
        for part in slices(rows.column(column), most):
            yield rows.slice(at, len(part))
            at += len(part)


class Keys:
    """The pieces of some texts: ``names[codes[offsets[k]:offsets[k + 1]]]`` are those of text ``k``."""

    def __init__(self, lists: pa.Array):
        flat = lists.flatten().dictionary_encode()
        self.names: list[str] = flat.dictionary.to_pylist()
        self.codes = flat.indices.to_numpy(zero_copy_only=False)
        self.offsets = np.append(0, np.cumsum(pc.list_value_length(lists).to_numpy(zero_copy_only=False))).astype(np.int64)

    @classmethod
    def of(cls, texts: pa.Array, even: np.ndarray, split: Callable[[str], list[str]]) -> Iterator[tuple[np.ndarray, Keys]]:
        """For the even texts, cut at every space, and for the others, cut by ``split``: their positions and pieces."""
        for rows in (np.flatnonzero(even), np.flatnonzero(~even)):
            if len(rows):
                some = texts.take(pa.array(rows))
                lists = pc.split_pattern(some, " ") if even[rows[0]] else pa.array([split(t) for t in some.to_pylist()], pa.list_(pa.string()))
                yield rows, cls(lists)

    def sums(self, of_names: np.ndarray) -> np.ndarray:
        """Per text, the sum of a value its pieces have."""
        total = np.append(0, np.cumsum(of_names[self.codes]))
        return total[self.offsets[1:]] - total[self.offsets[:-1]]

    def joined(self, lengths: np.ndarray, flat: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts in a row, and where those of each text begin (and the last end)."""
        starts = np.cumsum(lengths) - lengths
        each = lengths[self.codes]
        ends = np.append(0, np.cumsum(each))
        ids = flat[np.repeat(starts[self.codes] - ends[:-1], each) + np.arange(ends[-1])]
        return ids, ends[self.offsets]


def _cuts(spec: dict) -> str:
    """Where this tokenizer may be cut: ``before`` a space, ``at`` a space (dropped), or ``none``."""
    normalizer, pre = spec.get("normalizer"), spec.get("pre_tokenizer") or {}
    plain = not any(t.get("lstrip") or t.get("rstrip") or t.get("single_word") or re.search(r"\s", t["content"]) for t in spec.get("added_tokens", ()))
    if not plain or spec.get("model", {}).get("type") != "BPE":
        return "none"
    if normalizer is None and pre.get("type") == "ByteLevel" and pre.get("use_regex") and not pre.get("add_prefix_space"):
        return "before"
    parts = (normalizer or {}).get("normalizers", [normalizer] if normalizer else [])
    steps = pre.get("pretokenizers", [pre])
    first = steps[0] if steps else {}
    drops_space = first.get("type") == "Split" and first.get("behavior") == "Removed" and first.get("invert") and r"[^\s" in first["pattern"].get("Regex", "")
    local = all(p["type"] in ("NFC", "Lowercase") or p["type"] == "Replace" and p["pattern"].get("Regex") == r"\s+" and p["content"] == " " for p in parts)
    rest = all(s.get("type") == "ByteLevel" and not s.get("add_prefix_space") and not s.get("use_regex") for s in steps[1:])
    return "at" if drops_space and local and rest else "none"


class Pieces:
    """The ids of the pieces of texts.

    Where the tokenizer may be cut before a space, a piece is named without that
    space, and the first piece of a text, which has none, with a NUL before it.
    Pieces that are new go to the library many at a time, joined by a special token,
    which the library sets apart before anything else, and are told apart by its id.
    """

    def __init__(self, path: str):
        self.cache: dict[str, bytes] = {}  # ids as 32-bit integers: smaller than arrays, and joined at once
        self.cuts, self.joint = "none", None
        if path.endswith(".model"):
            import sentencepiece

            processor = sentencepiece.SentencePieceProcessor(model_file=path)
            self._encode = lambda texts: processor.encode(texts, num_threads=1)
            return
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        self.cuts = _cuts(spec)
        special = [t for t in spec.get("added_tokens", ()) if t["special"] and not t["normalized"]]
        if self.cuts != "none" and special:
            self.joint = (special[-1]["content"], special[-1]["id"], re.compile("|".join(re.escape(t["content"][:1]) for t in spec["added_tokens"])))
        tokenizer = Tokenizer.from_file(path)
        tokenizer.no_truncation()
        tokenizer.no_padding()
        self._encode = lambda texts: [e.ids for e in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _names(self, text: str) -> list[str]:
        if self.cuts == "none" or "\x00" in text:
            return ["\x00" + text]
        return [p[1:] if p[:1] == " " else "\x00" + p for p in CUT.split(text)]

    def _text(self, name: str) -> str:
        if name[:1] == "\x00":
            return name[1:]
        return " " + name if self.cuts == "before" else name

    def _learn(self, names: list[str]) -> None:
        alone = []
        if self.joint:
            token, mark, first = self.joint
            joined = []
            for name in names:  # one that might hold or complete a special token goes alone
                text = self._text(name)
                (alone if first.search(text) else joined).append((name, text))
            at = 0
            for batch in balanced([t for _, t in joined]):
                ids = np.array(self._encode([token.join(batch)])[0], np.uint32)
                ends = 4 * np.flatnonzero(ids == mark)
                raw = ids.tobytes()
                for (name, _), a, b in zip(joined[at : at + len(batch)], [0, *(ends + 4).tolist()], [*ends.tolist(), len(raw)], strict=True):
                    self.cache[name] = raw[a:b]
                at += len(batch)
        else:
            alone = [(n, self._text(n)) for n in names]
        at = 0
        for batch in balanced([t for _, t in alone]):
            for part, ids in enumerate(self._encode(batch)):
                self.cache[alone[at + part][0]] = np.array(ids, np.uint32).tobytes()
            at += len(batch)

    def encode(self, texts: pa.Array) -> Iterator[tuple[np.ndarray, Keys, np.ndarray, np.ndarray]]:
        """Groups of texts: their positions, their pieces, the number of ids of each distinct piece, and those ids in a row."""
        even = np.zeros(len(texts), bool)
        if self.cuts == "before":
            even = ~pc.match_substring_regex(texts, UNEVEN).to_numpy(zero_copy_only=False)
            texts = pc.if_else(pa.array(even), pc.binary_join_element_wise("\x00", texts, ""), texts)
        elif self.cuts == "at":
            even = ~pc.match_substring(texts, "\x00").to_numpy(zero_copy_only=False)
            texts = pc.replace_substring(texts, "\n", " ")
        for rows, keys in Keys.of(texts, even, self._names):
            if len(self.cache) > CACHE_PIECES:
                self.cache.clear()
            missing = [n for n in keys.names if n not in self.cache]
            self._learn(missing)
            found = [self.cache[n] for n in keys.names]
            yield rows, keys, np.fromiter(map(len, found), np.int64, len(found)) // 4, np.frombuffer(b"".join(found), np.uint32)
            for name in missing:
                if len(name) > LONGEST_CACHED:
                    del self.cache[name]
