"""Words that a document repeats over and over: periodic runs, found and collapsed."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import documents
from .pieces import slices
from .sampling import mix, word_hashes
from .suffix_tree import runs

EXPONENT, LEAST = 4, 6
BATCH = 1 << 19
_WORD = r"[^\x20\x09-\x0D]+"


def may_run(words: np.ndarray, of_text: np.ndarray, exponent: int = EXPONENT, least: int = LEAST) -> np.ndarray:
    """Which words may be in a run: start and end of stretches outside of which there is none.

    A run holds each of its words ``exponent`` times or more, so a word rarer than that within its stretch cuts
    the stretch in two; stretches shorter than ``least`` go; and so on until nothing changes. Words are
    counted by hash cells, which never count too few.
    """
    at = np.arange(len(words))
    stretch = np.repeat(np.arange(len(of_text) - 1), np.diff(of_text))
    while len(at):
        bits = max(10, (4 * len(at)).bit_length())
        cells = (mix(words[at] + stretch.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - bits)).astype(np.int64)
        alive = np.bincount(cells, minlength=1 << bits)[cells] >= exponent
        before = len(at)
        at, stretch = at[alive], stretch[alive]
        cut = np.flatnonzero(np.append(True, (np.diff(at) > 1) | (np.diff(stretch) > 0))) if len(at) else np.empty(0, np.int64)
        size = np.diff(np.append(cut, len(at)))
        long = np.repeat(size >= least, size)
        stretch = np.repeat(np.arange(len(size)), size)[long]
        at = at[long]
        if len(at) == before:
            break
    if not len(at):
        return np.empty((0, 2), np.int64)
    cut = np.flatnonzero(np.append(True, (np.diff(at) > 1) | (np.diff(stretch) > 0)))
    return np.stack([at[cut], at[np.append(cut[1:], len(at)) - 1] + 1], axis=1)


def runs_of(words: list[bytes], stretches: np.ndarray, exponent: int = EXPONENT, least: int = LEAST) -> np.ndarray:
    """The runs of one text, looked for in ``stretches`` of its words only."""
    codes: dict[bytes, int] = {}
    symbols: list[int] = []
    place: list[np.ndarray] = []
    for start, end in stretches.tolist():
        symbols.extend(codes.setdefault(w, len(codes) + 1) for w in words[start:end])
        codes[b" %d" % start] = wall = len(codes) + 1  # no word: stretches never run into each other
        symbols.append(wall)
        place.append(np.arange(start, end + 1))
    if not symbols:
        return np.empty((0, 3), np.int64)
    found = runs(symbols, exponent, least)
    found[:, 0] = np.concatenate(place)[found[:, 0]]
    return found


def highest(found: np.ndarray) -> tuple[int, int, int] | None:
    """The run of the greatest exact length over period, by least start and period among equals."""
    best = None
    for start, length, period in found.tolist():  # in order of start and period
        if best is None or length * best[2] > best[1] * period:
            best = (start, length, period)
    return best


def periodic_runs(docs: DataFrame, exponent: int = EXPONENT, least: int = LEAST) -> DataFrame:
    """Per row of ``docs``: ``doc_id, n_runs, start, length, period, exponent_milli, runs_sha256, collapsed_sha256, runs, collapsed``.

    Words are ``[^\\x20\\x09-\\x0D]+``. A run is a maximal stretch of words of smallest period ``q`` and of at least
    ``exponent * q`` and ``least`` words. ``start`` to ``exponent_milli`` tell the run with the most repetitions.
    ``collapsed`` keeps the first period of every run and joins what is left by single spaces.

    Null and empty texts have no words and no runs; without runs the four numbers are null. Every row is
    judged alone, so repeated rows give equal results, null ids stay, and an empty table gives an empty
    one. Extra columns are left out. A text is read as a whole; its trees take memory in proportion to
    the words that may be in runs.
    """
    names = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256", "runs", "collapsed"]
    kinds = [pa.int64()] * 6 + [pa.string()] * 2 + [pa.list_(pa.struct([(c, pa.int64()) for c in ("start", "length", "period")])), pa.string()]

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = 0
            for some in slices(batch.column(1), BATCH):
                texts = some.to_pylist()
                hashes, of_text = word_hashes(texts)
                stretches = may_run(hashes, of_text, exponent, least)
                text_of = np.searchsorted(of_text, stretches[:, 0], "right") - 1
                first = np.searchsorted(text_of, np.arange(len(texts) + 1))
                out = []
                for t, doc_id in enumerate(batch.column(0).slice(at, len(texts)).to_pylist()):
                    words = texts[t].encode("utf-8", "surrogatepass").split()  # at those six blanks
                    found = runs_of(words, stretches[first[t] : first[t + 1]] - of_text[t], exponent, least)
                    if len(found):
                        gone = np.zeros(len(words) + 1, np.int64)
                        np.add.at(gone, found[:, 0] + found[:, 2], 1)
                        np.add.at(gone, found[:, 0] + found[:, 1], -1)
                        words = [w for w, g in zip(words, np.cumsum(gone[:-1]).tolist(), strict=True) if not g]
                    kept = b" ".join(words)
                    listed = found.tolist()
                    best = highest(found)
                    told = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
                    digest = hashlib.sha256("".join(f"{s},{n},{p}\n" for s, n, p in listed).encode()).hexdigest()
                    out.append((doc_id, len(listed), *told, digest, hashlib.sha256(kept).hexdigest(), [dict(zip(("start", "length", "period"), r, strict=True)) for r in listed], kept.decode("utf-8", "surrogatepass")))
                at += len(texts)
                yield pa.RecordBatch.from_arrays([pa.array([r[c] for r in out], kind) for c, kind in enumerate(kinds)], names)

    ddl = "doc_id long, n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string, collapsed_sha256 string, runs array<struct<start: long, length: long, period: long>>, collapsed string"
    return documents(docs).mapInArrow(emit, ddl)


def with_repeats(docs: DataFrame) -> DataFrame:
    """``doc_id, text`` with repetition written into every tenth text, as the query's contract says.

    With ``h`` the crc32 of the decimal id and ``g = floor(h / 10)``: where ``h % 10 = 0`` and there are ``n > 0`` words, each
    word from ``a = g % n`` on repeats the ``p = 1 + floor((n - a) / (3 + g % 8))`` words at ``a``. A null id is left alone.
    """
    rows = documents(docs)
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = F.regexp_extract_all("text", F.lit(f"({_WORD})"), 1)

    def repeated(w: Column) -> Column:
        n, g = F.size(w), F.expr("crc32(cast(cast(doc_id as string) as binary)) div 10")
        a = g % n
        p = F.lit(1) + F.floor((n - a) / (F.lit(3) + g % 8))
        order = F.transform(F.sequence(F.lit(0).cast("long"), n.cast("long") - 1), lambda i: F.when(i >= a, a + (i - a) % p).otherwise(i))
        return F.array_join(F.transform(order, lambda i: w[i.cast("int")]), " ")

    # one evaluation of the words, bound as the only element of an array
    written = F.transform(F.array(words), lambda w: F.when(F.size(w) > 0, repeated(w)).otherwise(F.lit("")))[0]
    return rows.withColumn("text", F.when(F.coalesce(h % 10 == 0, F.lit(False)), written).otherwise(F.col("text")))
