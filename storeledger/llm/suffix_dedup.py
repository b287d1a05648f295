"""Removing long byte strings that occur more than once, with suffix arrays.

Anchors and a sketch leave the spans of text that may repeat; spans that are
equal as a whole are settled by grouping them. Where spans of one anchor differ, one
copy of each goes to a shard, by its anchor, so that every two equal strings meet. A shard builds
the suffix array of its spans (Larsson-Sadakane refinement), takes common prefixes
after Kasai, and so finds every string of the given length that occurs twice. An anchor
with very many different spans is split over shards; the strings that these shards
hold are then merged in slices of their hashes, by binary search in sorted runs.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import staged
from .pieces import sliced
from .sampling import _SALT
from .sketches import might_hold
from .spans import Hashed, Scheme, covered, keyed, suspect_spans

LENGTH, GRAM = 200, 50
#: Bytes of spans in a shard, and different spans of one anchor beyond which it is split.
SHARD_BYTES = 1 << 20
SPLIT_SPANS = 2_000
SLICES = 256


def _bytes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    raw = [t.encode("utf-8", "surrogatepass") for t in texts]
    return _SALT[np.frombuffer(b"".join(raw), np.uint8)], np.append(0, np.cumsum([len(r) for r in raw])).astype(np.int64)


def _scheme(length: int) -> Scheme:
    return Scheme(length, min(GRAM, length), _bytes, per_text=True)


def suffix_array(symbols: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The suffix array and its inverse, by Larsson-Sadakane refinement.

    ``symbols`` are bytes above 0; a 0 ends a span and is below all bytes, the earlier ``owner`` first.
    Suffixes are sorted by eight symbols at once; then the groups of equals are refined by the rank
    of what stands ``h`` symbols further on, ``h`` doubling, and suffixes whose place is settled are not
    touched again. The rank of a group is the place of its last member.
    """
    n = len(symbols)
    eight, live = np.zeros(n, np.uint64), np.ones(n, bool)
    padded = np.append(symbols, np.zeros(8, np.uint8))
    for k in range(8):
        here = padded[k : k + n] * live
        eight = (eight << np.uint64(8)) | here
        live &= here > 0
    order = np.argsort(eight)
    short = np.flatnonzero(eight[order] & np.uint64(0xFF) == 0)  # with the end of their span in sight: by it, all differ
    ended = order[short]
    order[short] = ended[np.lexsort((owner[ended], eight[ended]))]
    placed = eight[order]
    new = np.append(True, placed[1:] != placed[:-1])
    new[short] = True
    last = np.append(np.flatnonzero(new)[1:], n) - 1
    rank = np.empty(n, np.int64)
    rank[order] = np.repeat(last, np.diff(np.append(np.flatnonzero(new), n)))
    h = 8
    open_ = np.flatnonzero(~(new & np.append(new[1:], True)))  # places in groups of two or more
    while len(open_):
        at = order[open_]
        both = (rank[at] << 32) | rank[at + h]  # no open suffix ends within h symbols
        by = np.argsort(both)
        at, both = at[by], both[by]
        order[open_] = at
        first = np.append(True, both[1:] != both[:-1])
        ends = np.append(np.flatnonzero(first)[1:], len(at)) - 1
        rank[at] = np.repeat(open_[ends], np.diff(np.append(-1, ends)))
        open_ = open_[~(first & np.append(first[1:], True))]
        h *= 2
    return order, rank


def common_prefixes(symbols: np.ndarray, order: np.ndarray, rank: np.ndarray, starts: np.ndarray, ends: np.ndarray, most: int) -> np.ndarray:
    """By place, the common prefix (up to ``most``) of a suffix and the one before it, after Kasai.

    The prefix of a suffix is at least that of the suffix one symbol earlier, less one. All spans
    ``[starts, ends)`` walk along their suffixes side by side.
    """
    n = len(symbols)
    before = np.full(n, -1, np.int64)
    before[order[1:]] = order[:-1]
    by_suffix = np.zeros(n, np.int64)
    held = np.zeros(len(starts), np.int64)
    for step in range(int((ends - starts).max(initial=0))):
        live = np.flatnonzero(starts + step < ends)
        at = starts[live] + step
        other = before[at]
        h = np.where(other >= 0, np.maximum(held[live] - 1, 0), 0)
        grow = np.flatnonzero(other >= 0)
        while len(grow):
            a, b = at[grow] + h[grow], other[grow] + h[grow]
            inside = h[grow] < most  # no suffix goes on beyond the last end
            inside[inside] = (symbols[a[inside]] == symbols[b[inside]]) & (symbols[a[inside]] > 0)  # ends differ from each other
            grow = grow[inside]
            h[grow] += 1
        by_suffix[at] = held[live] = h
    out = np.zeros(n + 1, np.int64)
    out[rank] = by_suffix
    return out


def repeated_starts(spans: list[bytes], length: int) -> list[np.ndarray]:
    """Of each span, which of its strings of ``length`` bytes occur twice or more in all the spans."""
    sizes = np.array([len(s) for s in spans], np.int64)
    ends = np.cumsum(sizes + 1) - 1
    starts = ends - sizes
    symbols = np.zeros(int(ends[-1]) + 1, np.uint8)
    inside = np.ones(len(symbols), bool)
    inside[ends] = False
    symbols[inside] = np.frombuffer(b"".join(spans), np.uint8) + np.uint8(1)  # UTF-8 has no byte 255
    order, rank = suffix_array(symbols, np.repeat(np.arange(len(spans)), sizes + 1))
    prefix = common_prefixes(symbols, order, rank, starts, ends, length)
    twice = np.maximum(prefix[rank], prefix[rank + 1]) >= length
    return [twice[a : max(a, b - length + 1)] for a, b in zip(starts, ends, strict=True)]


_OPEN = "shard int, split boolean, low long, high long, copies long, piece binary"


def _contested(open_: DataFrame, rows: DataFrame, length: int) -> DataFrame:
    """The bytes of one copy of each span of ``open_``."""
    per_text = open_.groupBy("doc_id", "text_key").agg(F.collect_list(F.struct("start", "windows", "low", "high", "copies", "shard", "split")).alias("spans"))
    near, _ = might_hold(rows, "text_key", open_)
    d, k = F.col("doc_id"), F.col("text_key")
    joined = near.join(per_text.select(d.alias("d"), k.alias("k"), "spans"), d.eqNullSafe(F.col("d")) & (k == F.col("k")))

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("shard", pa.int32()), ("split", pa.bool_()), ("low", pa.int64()), ("high", pa.int64()), ("copies", pa.int64()), ("piece", pa.binary())])
        for batch in sliced(batches, 0):
            for text, spans in zip(batch.column(0), batch.column(1), strict=True):
                raw = text.as_py().encode("utf-8", "surrogatepass")
                out = []
                for s in spans.as_py():
                    piece = raw[s["start"] : s["start"] + s["windows"] + length - 1]
                    out.append({"shard": s["shard"], "split": s["split"], "low": s["low"], "high": s["high"], "copies": s["copies"], "piece": piece})
                yield pa.RecordBatch.from_pylist(out, schema=schema)

    return joined.select("text", "spans").mapInArrow(emit, _OPEN).dropDuplicates(["low", "high"])


def _shard_results(pieces: DataFrame, n_shards: int, length: int) -> DataFrame:
    """``low, high, from, to``: runs of repeated strings found in the shards; and, with ``slice``, hashes of
    the other strings of split anchors, packed and sorted, for the merge."""

    def shard(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now: int | None = None
        held: list[tuple] = []

        def finish() -> Iterator[pa.RecordBatch]:
            low, high, begin, end, slices, packed = [], [], [], [], [], []
            found = repeated_starts([r[4] for r in held], length)
            for (_, _, a, b, _), twice in zip(held, found, strict=True):
                edges = np.flatnonzero(np.diff(np.concatenate([[0], twice.view(np.int8), [0]])))
                low += [a] * (len(edges) // 2)
                high += [b] * (len(edges) // 2)
                begin += edges[::2].tolist()
                end += edges[1::2].tolist()
            yield pa.RecordBatch.from_arrays(
                [pa.array(low, pa.int64()), pa.array(high, pa.int64()), pa.array(begin, pa.int32()), pa.array(end, pa.int32()), pa.nulls(len(low), pa.int32()), pa.nulls(len(low), pa.binary())],
                ["low", "high", "from", "to", "slice", "strings"],
            )
            records = [np.empty(0, _STRING)]
            for (_, split, a, b, piece), twice in zip(held, found, strict=True):
                if split:  # strings repeated here must still be known to the other shards, as must those that are not
                    hashed = Hashed(_SALT[np.frombuffer(piece, np.uint8)])
                    at = np.arange(len(piece) - length + 1)
                    part = np.empty(len(at), _STRING)
                    part["w"], part["v"] = (hashed.runs(at, at + length, x) for x in (0, 1))
                    part["low"], part["high"], part["at"], part["done"] = a, b, at, twice
                    records.append(part)
            every = np.concatenate(records)
            every = every[np.argsort(every["w"], kind="stable")]
            cuts = np.searchsorted(every["w"], np.arange(1, SLICES, dtype=np.uint64) << np.uint64(56))  # 256 equal slices of hashes
            parts = [(k, p) for k, p in enumerate(np.split(every, cuts)) if len(p)]
            slices, packed = [k for k, _ in parts], [p.tobytes() for _, p in parts]
            m = len(slices)
            yield pa.RecordBatch.from_arrays(
                [pa.nulls(m, pa.int64()), pa.nulls(m, pa.int64()), pa.nulls(m, pa.int32()), pa.nulls(m, pa.int32()), pa.array(slices, pa.int32()), pa.array(packed, pa.binary())],
                ["low", "high", "from", "to", "slice", "strings"],
            )

        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in ("shard", "split", "low", "high", "piece")), strict=True):
                if row[0] != now:
                    if held:
                        yield from finish()
                    now, held = row[0], []
                held.append(row)
        if held:
            yield from finish()

    dealt = pieces.repartition(max(1, n_shards), "shard").sortWithinPartitions("shard")
    return dealt.mapInArrow(shard, "low long, high long, from int, to int, slice int, strings binary")


_STRING = np.dtype([("w", "<u8"), ("v", "<u8"), ("low", "<i8"), ("high", "<i8"), ("at", "<i4"), ("done", "?")])


def _merged(results: DataFrame) -> DataFrame:
    """Runs of the strings of split anchors that are in several shards: each shard's sorted hashes are looked up in all of their slice."""

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = None, []

        def finish() -> pa.RecordBatch:
            every = np.sort(np.concatenate(held)[["w", "v"]], order=("w", "v"))
            found = []
            for part in held:
                wanted = part[~part["done"]]
                first, last = (np.searchsorted(every["w"], wanted["w"], side) for side in ("left", "right"))
                several = np.flatnonzero(last - first > 1)
                same = [np.count_nonzero(every["v"][first[k] : last[k]] == wanted["v"][k]) > 1 for k in several]
                found.append(wanted[several[np.array(same, bool)]])
            hits = np.concatenate(found)
            return pa.RecordBatch.from_arrays([pa.array(hits["low"]), pa.array(hits["high"]), pa.array(hits["at"]), pa.array(hits["at"] + 1, pa.int32())], ["low", "high", "from", "to"])

        for batch in batches:
            for k, strings in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if k != now:
                    if held:
                        yield finish()
                    now, held = k, []
                held.append(np.frombuffer(strings, _STRING))
        if held:
            yield finish()

    dealt = results.where("slice is not null").select("slice", "strings").repartition(SLICES, "slice").sortWithinPartitions("slice")
    return dealt.mapInArrow(merge, "low long, high long, from int, to int")


def repeated_runs(rows: DataFrame, length: int = LENGTH) -> DataFrame:
    """Per document text of ``rows``, ``runs``: strings of ``length`` bytes, as first and last start plus one, that start elsewhere too."""
    spans = staged(suspect_spans(rows, _scheme(length), 0.015), "spans")
    distinct = spans.groupBy("key", "low", "high").agg(F.count(F.lit(1)).alias("copies"), F.min(F.struct("doc_id", "text_key", "start")).alias("first"), F.first("windows").alias("windows"))
    distinct = staged(distinct.select("key", "low", "high", "windows", "copies", "first.doc_id", "first.text_key", "first.start"), "distinct-spans")
    several = distinct.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    open_ = distinct.join(several, "key")
    n_bytes = distinct.join(several, "key").agg(F.sum(F.col("windows") + length).cast("long")).first()[0] or 0
    n_shards = max(1, -(-n_bytes // SHARD_BYTES))
    salt = F.when(F.col("n") > SPLIT_SPANS, F.pmod(F.xxhash64("low"), F.ceil(F.col("n") / SPLIT_SPANS))).otherwise(F.lit(0))
    shard = F.pmod(F.xxhash64("key", salt), F.lit(n_shards)).cast("int")
    open_ = staged(open_.withColumn("shard", shard).withColumn("split", F.col("n") > SPLIT_SPANS), "contested-spans")
    results = staged(_shard_results(_contested(open_, rows, length), n_shards, length), "shards")
    inner = staged(results.where("slice is null").select("low", "high", "from", "to").unionByName(_merged(results)), "repeated-strings")
    settled = distinct.select("low", "high", "key", (F.col("copies") > 1).alias("whole"))
    at = spans.join(settled, ["key", "low", "high"])
    whole = at.where("whole").select("doc_id", "text_key", F.col("start").alias("from"), (F.col("start") + F.col("windows")).alias("to"))
    part = at.where("not whole").join(inner, ["low", "high"]).select("doc_id", "text_key", (F.col("start") + F.col("from")).alias("from"), (F.col("start") + F.col("to")).alias("to"))
    return whole.unionByName(part).groupBy("doc_id", "text_key").agg(F.collect_set(F.struct("from", "to")).alias("runs"))


def remove_repeats(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """Per row of ``docs``: ``doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept``.

    A byte of the UTF-8 text goes if it stands in a string of ``length`` bytes that also starts anywhere
    else, in the same text or another; ``n_spans`` counts maximal removed runs, ``kept`` is what remains.

    Null texts are empty. Repeated rows are texts of their own, so they remove each other; null ids
    are as good as others. An empty table gives an empty one; extra columns are left out.
    """
    rows = keyed(docs)
    runs = staged(repeated_runs(rows, length), "runs")
    near, far = might_hold(rows, "text_key", runs)
    d, k = F.col("doc_id"), F.col("text_key")
    hit = near.join(runs.select(d.alias("d"), k.alias("k"), "runs"), d.eqNullSafe(F.col("d")) & (k == F.col("k")), "left").select("doc_id", "text", "runs")
    every = hit.unionByName(far.select("doc_id", "text"), allowMissingColumns=True)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"]
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary())
        for batch in sliced(batches, 1):
            out = []
            for doc_id, text, found in zip(*(batch.column(c).to_pylist() for c in range(3)), strict=True):
                raw = text.encode("utf-8", "surrogatepass")
                kept, n_spans = raw, 0
                if found:
                    gone = covered(np.array([(r["from"], r["to"] + length - 1) for r in found]), len(raw))
                    kept = np.frombuffer(raw, np.uint8)[~gone].tobytes()
                    n_spans = int(np.count_nonzero(np.diff(gone.view(np.int8), prepend=0) == 1))
                out.append((doc_id, len(raw), len(raw) - len(kept), n_spans, hashlib.sha256(kept).hexdigest(), kept))
            yield pa.RecordBatch.from_arrays([pa.array([r[c] for r in out], kind) for c, kind in enumerate(kinds)], names)

    return every.mapInArrow(cut, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary")
