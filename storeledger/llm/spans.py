"""Windows of symbols that may repeat, found by anchors.

The anchor of a window is the least-hashed run of ``gram`` symbols in it (the leftmost
of equals): equal windows have equal anchors at equal offsets. Consecutive windows
with one anchor are a span. Windows can only be equal if their anchors are, so what
is counted and shuffled is a row a span, not a row a window.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import text_of
from .pieces import slices
from .sampling import mix
from .sketches import frequent_keys, is_marked

_BASES = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)
BATCH = 1 << 18
#: The sketch's bitmap has eight bits for each anchor that may repeat, half of those expected, between these bounds (32 MB at most).
LEAST_BITS, MOST_BITS = 20, 28


class Powers:
    """Powers of the two bases and of their inverses, modulo 2 ** 64, as far as they have been asked for."""

    def __init__(self):
        self.n = 0

    def upto(self, n: int) -> list[tuple[np.ndarray, np.ndarray]]:
        if n > self.n:
            self.n = max(n, BATCH + (BATCH >> 2))
            self.tables = []
            for base in _BASES:
                ups = np.full(self.n, base, np.uint64)
                downs = np.full(self.n, pow(base, -1, 1 << 64), np.uint64)
                ups[0] = downs[0] = 1
                self.tables.append((np.cumprod(ups), np.cumprod(downs)))
        return self.tables


_POWERS = Powers()


class Hashed:
    """Symbols with running sums, from which the hash of any run of them is taken at once."""

    def __init__(self, symbols: np.ndarray):
        tables = _POWERS.upto(len(symbols) + 1)
        self.sums, self.downs = [], []
        for k, (ups, downs) in enumerate(tables):
            values = symbols if k == 0 else mix(symbols)
            self.sums.append(np.append(np.uint64(0), np.cumsum(values * ups[: len(symbols)])))
            self.downs.append(downs)

    def runs(self, start: np.ndarray, end: np.ndarray, k: int) -> np.ndarray:
        return mix((self.sums[k][end] - self.sums[k][start]) * self.downs[k][start] + (end - start).astype(np.uint64))

    def grams(self, width: int) -> np.ndarray:
        """The first hash of every run of ``width`` symbols."""
        n = len(self.sums[0]) - width
        return mix((self.sums[0][width:] - self.sums[0][:n]) * self.downs[0][:n] + np.uint64(width)) if n > 0 else np.empty(0, np.uint64)


def sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    """The least of every ``width`` values in a row, by doubling."""
    size = 1
    while 2 * size <= width:
        values = np.minimum(values[:-size], values[size:])
        size *= 2
    return np.minimum(values[: len(values) - (width - size)], values[width - size :]) if width > size else values


@dataclass
class Scheme:
    """Windows of ``window`` symbols with anchors of ``gram``; ``symbols`` gives those of some texts and where each text's begin."""

    window: int
    gram: int
    symbols: Callable[[list[str]], tuple[np.ndarray, np.ndarray]]
    per_text: bool  # whether repeats within a text count

    def spans(self, texts: list[str]) -> tuple[np.ndarray, ...]:
        """Arrays ``text, start, windows, key, low, high``: of every span its text, first symbol, number of windows, anchor hash and 128-bit content hash."""
        symbols, of_text = self.symbols(texts)
        n = np.maximum(np.diff(of_text) - self.window + 1, 0)
        if not n.sum():
            return tuple(np.empty(0, kind) for kind in (np.int64, np.int64, np.int64, np.uint64, np.uint64, np.uint64))
        hashed = Hashed(symbols)
        grams = hashed.grams(self.gram)
        placed = (grams & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(grams), dtype=np.uint64)
        least = sliding_least(placed, self.window - self.gram + 1)
        at = np.repeat(of_text[:-1] - np.cumsum(n) + n, n) + np.arange(n.sum())
        anchor = (least[at] & np.uint64(0xFFFFFFFF)).astype(np.int64)
        first = np.flatnonzero(np.append(True, (anchor[1:] != anchor[:-1]) | (at[1:] != at[:-1] + 1)))
        windows = np.diff(np.append(first, len(at)))
        start = at[first]
        text = np.searchsorted(of_text, start, "right") - 1
        end = start + windows + self.window - 1
        # mixed anew: the least of many hashes are all small
        return text, start - of_text[text], windows, mix(grams[anchor[first]] + np.uint64(1)), hashed.runs(start, end, 0), hashed.runs(start, end, 1)

    def keys(self, column: int) -> Callable[[Iterable[pa.RecordBatch]], Iterator[np.ndarray]]:
        def found(batches: Iterable[pa.RecordBatch]) -> Iterator[np.ndarray]:
            for rows in batches:
                for texts in slices(rows.column(column), BATCH):
                    text, _, _, key, _, _ = self.spans(texts.to_pylist())
                    if not self.per_text:  # an anchor counts once a text
                        order = np.lexsort((key, text))
                        key, text = key[order], text[order]
                        key = key[np.append(True, (key[1:] != key[:-1]) | (text[1:] != text[:-1]))] if len(key) else key
                    yield key

        return found


def keyed(docs: DataFrame) -> DataFrame:
    """``doc_id, text, text_key``; the key tells the texts of one id apart."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    return rows.withColumn("text_key", F.xxhash64("text", F.length("text")))


def sketch_bits(docs: DataFrame, per_byte: float) -> int:
    n_bytes = docs.agg(F.sum(F.octet_length("text")).cast("long")).first()[0] or 0
    return min(MOST_BITS, max(LEAST_BITS, int(4 * per_byte * n_bytes).bit_length()))


def suspect_spans(rows: DataFrame, scheme: Scheme, per_byte: float) -> DataFrame:
    """Spans of ``rows(doc_id, text, text_key)`` whose anchor a count-min sketch of all rows takes for repeated.

    ``doc_id, text_key, start, windows, key, low, high``. The sketch never counts too little, so
    no window that occurs twice is missing. Anchors that occur once do not fill its bitmap; only with
    so many repeated ones that its largest size has few bits for each does it let more through.
    """
    bits = sketch_bits(rows, per_byte)
    bitmap = frequent_keys(rows.select("text"), scheme.keys(0), bits, 2)
    shared = rows.sparkSession.sparkContext.broadcast(bitmap)

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = 0
            for texts in slices(batch.column(1), BATCH):
                text, start, windows, key, low, high = scheme.spans(texts.to_pylist())
                kept = is_marked(shared.value, key, bits)
                row = pa.array(text[kept] + at)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(row), batch.column(2).take(row), pa.array(start[kept].astype(np.int32)), pa.array(windows[kept].astype(np.int32)), *(pa.array(x[kept].view(np.int64)) for x in (key, low, high))],
                    ["doc_id", "text_key", "start", "windows", "key", "low", "high"],
                )
                at += len(texts)

    return rows.mapInArrow(emit, "doc_id long, text_key long, start int, windows int, key long, low long, high long")


def covered(runs: np.ndarray, size: int) -> np.ndarray:
    """Of ``size`` symbols, those in any of the runs ``[start, end)``."""
    change = np.zeros(size + 1, np.int32)
    np.add.at(change, runs[:, 0], 1)
    np.add.at(change, runs[:, 1], -1)
    return np.cumsum(change[:-1]) > 0
