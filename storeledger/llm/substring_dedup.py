"""Removing passages of words that an earlier document holds."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import shuffles_deleted, staged
from .pieces import sliced, slices
from .sampling import word_hashes
from .sketches import may_repeat, might_hold, table_bits
from .spans import BATCH, Hashed, Scheme, covered, keyed, suspect_spans

WINDOW, GRAM = 13, 5
_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_FIRST = -(1 << 63)


def _scheme(window: int) -> Scheme:
    return Scheme(window, min(GRAM, window), word_hashes, per_text=False)


def _order() -> Column:
    return F.coalesce("doc_id", F.lit(_FIRST))


def _window_hashes(spans: DataFrame, texts: DataFrame, window: int) -> DataFrame:
    """``span, earliest, offset, w_low, w_high`` of every window of ``spans(span, doc_id, text_key, start, windows)``, read from ``texts``.

    ``earliest`` orders the span's document. Spans at one place of repeated rows count once.
    """
    once = spans.groupBy("doc_id", "text_key", "start", "windows").agg(F.min("span").alias("span"))
    per_text = once.groupBy(_order().alias("earliest"), "text_key").agg(F.collect_list(F.struct("start", "windows", "span")).alias("spans"))
    near, _ = might_hold(texts, "text_key", spans, table_bits(spans))
    joined = near.select(_order().alias("earliest"), "text_key", "text").join(per_text, ["earliest", "text_key"]).select("earliest", "text", "spans")

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            earliest, at = rows.column(0).to_numpy(), 0
            for some in slices(rows.column(1), BATCH):
                words, of_text = word_hashes(some.to_pylist())
                hashed, lists = Hashed(words), rows.column(2).slice(at, len(some))
                start, windows, span = (x.to_numpy(zero_copy_only=False) for x in lists.flatten().flatten())
                text = np.repeat(np.repeat(np.arange(len(some)), np.diff(lists.offsets.to_numpy())), windows)
                offset = np.arange(windows.sum()) - np.repeat(np.cumsum(windows) - windows, windows)
                first = of_text[text] + np.repeat(start, windows) + offset
                hashes = (hashed.runs(first, first + window, x).view(np.int64) for x in (0, 1))
                columns = (np.repeat(span, windows), earliest[text + at], offset.astype(np.int32), *hashes)
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["span", "earliest", "offset", "w_low", "w_high"])
                at += len(some)

    return joined.mapInArrow(emit, "span long, earliest long, offset int, w_low long, w_high long")


def repeated_runs(rows: DataFrame, window: int = WINDOW) -> DataFrame:
    """Per document text of ``rows``, ``runs``: windows, as first and last plus one, that start in an earlier document too.

    Spans that occur as a whole in an earlier document are settled by grouping spans. Only where
    spans of one anchor differ are their windows, those in the earliest document of each, hashed to 128
    bits; a sketch of these leaves out windows that occur once, and the others are grouped exactly.
    """
    spans = staged(suspect_spans(rows, _scheme(window), 0.03), "spans")
    distinct = staged(spans.groupBy("key", "low", "high").agg(F.min(_order()).alias("least"), F.max(_order()).alias("most")), "distinct-spans")
    asked = distinct.select("low", "high", "least", "most", may_repeat(distinct, "key").alias("open")).where("open or least < most")
    later = _order() > F.col("least")
    copies = spans.join(asked, ["low", "high"]).where(later | F.col("open"))
    copies = staged(copies.select(F.when(~later, F.monotonically_increasing_id()).alias("span"), "doc_id", "text_key", "start", "windows"), "copies")
    # in later documents a span is covered whole; in its earliest one, by windows that are earlier still
    whole = copies.where("span is null").select("doc_id", "text_key", F.col("start").alias("from"), (F.col("start") + F.col("windows")).alias("to"))
    own = copies.where("span is not null")
    windows = staged(_window_hashes(own, rows, window), "windows")
    windows = staged(windows.where(may_repeat(windows, "w_low")), "suspect-windows")
    earliest = windows.groupBy("w_low", "w_high").agg(F.min("earliest").alias("least"), F.max("earliest").alias("most")).where("least < most").drop("most")
    before = windows.join(earliest, ["w_low", "w_high"]).where("least < earliest").select("span", F.col("offset").alias("from"))
    before = own.join(before, "span").select("doc_id", "text_key", (F.col("start") + F.col("from")).alias("from"), (F.col("start") + F.col("from") + 1).alias("to"))
    return whole.unionByName(before).groupBy("doc_id", "text_key").agg(F.collect_set(F.struct("from", "to")).alias("runs"))


def remove_repeats(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """Per row of ``docs``: ``doc_id, n_words, n_removed, kept_sha256, kept``.

    Words are ``[^\\x20\\x09-\\x0D]+``. A word goes if it stands in ``window`` words in a row that also start
    in a document of a smaller id; what is kept is joined by single spaces.

    Null texts have no words. A null id is smaller than any other; rows of equal ids never remove each
    other's words, so repeated rows give equal results. An empty table gives an empty one; extra
    columns are left out.
    """
    rows = keyed(docs)
    with shuffles_deleted(docs.sparkSession):
        runs = staged(repeated_runs(rows, window), "runs")
        near, far = might_hold(rows, "text_key", runs, max(22, table_bits(runs)))
    d, k = F.col("doc_id"), F.col("text_key")
    hit = near.join(runs.select(d.alias("d"), k.alias("k"), "runs"), d.eqNullSafe(F.col("d")) & (k == F.col("k")), "left").select("doc_id", "text", "runs")
    every = hit.unionByName(far.select("doc_id", "text"), allowMissingColumns=True)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, 1):
            out = []
            for doc_id, text, found in zip(*(batch.column(c).to_pylist() for c in range(3)), strict=True):
                words = _WORD.findall(text)
                n = len(words)
                if found:
                    gone = covered(np.array([(r["from"], r["to"] + window - 1) for r in found]), n)
                    words = [w for w, x in zip(words, gone.tolist(), strict=True) if not x]
                kept = " ".join(words)
                out.append((doc_id, n, n - len(words), hashlib.sha256(kept.encode("utf-8", "surrogatepass")).hexdigest(), kept))
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string())
            yield pa.RecordBatch.from_arrays([pa.array([r[c] for r in out], kind) for c, kind in enumerate(kinds)], ["doc_id", "n_words", "n_removed", "kept_sha256", "kept"])

    return every.mapInArrow(cut, "doc_id long, n_words long, n_removed long, kept_sha256 string, kept string")
