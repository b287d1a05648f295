"""Near-duplicate classes by consistent weighted sampling over TF-IDF shingles.

A text is the set of its five-word shingles, a shingle weighing its count times
``1 + SPREAD * ln(1 + N / df) / ln(1 + N)``, ``df`` being the number of rows that hold it.
The ``df`` of shingles in one row of a hundred or more are counted first and broadcast (there
are at most a hundred times as many as a row has on average). As weights differ by ``1 + SPREAD`` at
most, plain counts settle most pairs, whatever the frequencies; for the rest, all
``df`` of their texts' shingles are counted, over all rows, and joined to the texts.
As no weight is over ``1 + SPREAD`` times another, the shared shingles of a large group of
copies count nearly as much as an edit's, and texts of such a group meet in the bands.
Signatures are cut into bands; texts that share a band are compared by their true weights,
and linked if the Jaccard similarity of these, or of the plain counts, is at or above the threshold.
Before texts are fetched, two numbers bound their similarity: how many shingles each has, and
in how many cells of their hashes one text has an even and the other an odd number of shingles.
Pairs that fall short of the threshold even so are no links, and are not compared further.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import components, free_name, staged, text_of
from .pieces import sliced, slices
from .sampling import WORDS, blocks, mix, seeds, shingle_hashes, word_hashes
from .sketches import cell, frequent_cells, is_set, might_hold, table_bits

SIMILARITY = 0.8
BANDS, ROWS = 16, 3
#: Shingles in fewer documents than this share are counted by a shuffle instead of being broadcast.
RARE = 0.01
#: How much more a shingle of one row weighs at most than one of all rows.
SPREAD = 0.25
CELL_BITS = 20
#: Cells of the bitmap of shingles whose rows are to be counted; where it is full, more are shuffled.
REPEAT_BITS = 26
#: Of buckets over so many texts, ``PIVOTS`` texts, and then as many of each large class, are compared with all others before the rest is.
SMALL_BUCKET = 24
PIVOTS = 8
#: Longs of cells, 64 each, that tell whether a text has an odd number of shingles there.
PARITY_LONGS = 16


def _sets(texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Of every text its distinct shingles and their counts."""
    words, of_text = word_hashes(texts)
    every = shingle_hashes(words)  # those across two texts are left out below
    for a, b in zip(of_text[:-1].tolist(), of_text[1:].tolist(), strict=True):
        yield np.unique(every[a : b - WORDS + 1] if b - a >= WORDS else shingle_hashes(words[a:b]), return_counts=True)


def _shingle_sets(batches: Iterable[pa.RecordBatch], column: int) -> Iterator[tuple[pa.RecordBatch, int, np.ndarray, np.ndarray]]:
    """Of every row its batch, its place there, its distinct shingles and their counts."""
    for rows in batches:
        at = 0
        for some in slices(rows.column(column), 1 << 19):
            for found in _sets(some.to_pylist()):
                yield rows, at, *found
                at += 1


class Weights:
    """The weight of a shingle: looked up if it is frequent, else by the counts that stand with its text; in one row if in neither."""

    def __init__(self, frequent: np.ndarray, counts: np.ndarray, n_docs: int):
        order = np.argsort(frequent)
        self.frequent = np.append(frequent[order], np.uint64(0xFFFFFFFFFFFFFFFF))
        self.idf = np.append(np.log1p(n_docs / counts[order]), 0.0)
        self.n_docs = n_docs
        self.rare = float(np.log1p(n_docs)) or 1.0

    def is_frequent(self, terms: np.ndarray) -> np.ndarray:
        at = np.searchsorted(self.frequent, terms)
        return (self.frequent[at] == terms) & (at < len(self.idf) - 1)

    def of(self, terms: np.ndarray, counts: np.ndarray, known: tuple[np.ndarray, np.ndarray] | None = None) -> np.ndarray:
        """``known``: shingles, in any order, and in how many rows they are."""
        idf = np.where(self.is_frequent(terms), self.idf[np.searchsorted(self.frequent, terms)], self.rare)
        if known is not None and len(known[0]):
            shingles, first = np.unique(known[0], return_index=True)
            at = np.minimum(np.searchsorted(shingles, terms), len(shingles) - 1)
            idf = np.where(shingles[at] == terms, np.log1p(self.n_docs / known[1][first][at]), idf)
        return counts * (1 + SPREAD * idf / self.rare)


def weights(docs: DataFrame) -> Weights:
    """Document frequencies over all rows of ``docs(text)``: a sketch finds the cells that can hold a
    frequent shingle, a second scan counts the shingles in those cells exactly."""
    n_docs = docs.count()
    texts = docs.select("text")

    def keys(batches: Iterable[pa.RecordBatch]) -> Iterator[np.ndarray]:
        return (found for _, _, found, _ in _shingle_sets(batches, 0))

    likely = frequent_cells(texts, keys, CELL_BITS, max(1, math.ceil(n_docs * RARE)))
    shared = docs.sparkSession.sparkContext.broadcast(likely)  # one bit for each of 2 ** 20 cells

    def counted(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0

        def row() -> pa.RecordBatch:
            found, m = np.unique(np.concatenate(held), return_counts=True)
            return pa.RecordBatch.from_arrays([pa.array(found.view(np.int64)), pa.array(m)], ["shingle", "df"])

        for _, _, found, _ in _shingle_sets(batches, 0):
            held.append(found[is_set(shared.value, cell(found, CELL_BITS))])
            n += len(held[-1])
            if n > 1 << 22:
                yield row()
                held, n = [], 0
        if held:
            yield row()

    totals = texts.mapInArrow(counted, "shingle long, df long").groupBy("shingle").agg(F.sum("df").alias("df"))
    # at most 1 / RARE times the mean number of shingles of a document
    frequent = totals.where(F.col("df") >= max(1.0, n_docs * RARE)).toArrow()
    return Weights(frequent.column("shingle").to_numpy().view(np.uint64), frequent.column("df").to_numpy(), n_docs)


def row_counts(rows: DataFrame, weigh: Weights, of: DataFrame | None = None) -> DataFrame:
    """``node_key, shingles, dfs``: the shingles of a row that are in other rows too but are not frequent, and in how many.

    ``of``: the ``node, text`` asked about, all of ``rows`` if left out. A bitmap of their shingles leaves
    out most others; what passes is counted exactly over all rows, added up in each task first.
    """
    asked = rows if of is None else of

    def keys(batches: Iterable[pa.RecordBatch]) -> Iterator[np.ndarray]:
        return (found for _, _, found, _ in _shingle_sets(batches, 0))

    likely = frequent_cells(asked.select("text"), keys, REPEAT_BITS, 1)
    shared = rows.sparkSession.sparkContext.broadcast((likely, weigh))

    def counted(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bitmap, frequent = shared.value
        held, n = [], 0

        def some() -> pa.RecordBatch:
            found, m = np.unique(np.concatenate(held), return_counts=True)
            return pa.RecordBatch.from_arrays([pa.array(found.view(np.int64)), pa.array(m)], ["shingle", "df"])

        for _, _, found, _ in _shingle_sets(batches, 0):
            found = found[is_set(bitmap, cell(found, REPEAT_BITS))]
            held.append(found[~frequent.is_frequent(found)])
            n += len(held[-1])
            if n > 1 << 21:
                yield some()
                held, n = [], 0
        if held:
            yield some()

    def dealt(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequent = shared.value[1]
        for batch, place, found, _ in _shingle_sets(batches, 1):
            found = found[~frequent.is_frequent(found)]
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(found), batch.column(0)[place].as_py())), pa.array(found.view(np.int64))], ["node_key", "shingle"])

    counts = rows.select("text").mapInArrow(counted, "shingle long, df long").groupBy("shingle").agg(F.sum("df").alias("df")).where("df > 1")
    each = asked.select(F.xxhash64("node").alias("node_key"), "text").mapInArrow(dealt, "node_key long, shingle long")
    lists = each.join(counts, "shingle").groupBy("node_key").agg(F.collect_list(F.struct("shingle", "df")).alias("known"))
    return lists.select("node_key", F.col("known.shingle").alias("shingles"), F.col("known.df").alias("dfs"))


def _counted(rows: DataFrame, counts: DataFrame) -> DataFrame:
    """``rows`` with their ``shingles`` and ``dfs``; nodes of equal keys get each other's too, which are as true."""
    return rows.withColumn("node_key", F.xxhash64("node")).join(counts, "node_key", "left").drop("node_key")


def _known(shingles: pa.ListArray, dfs: pa.ListArray) -> list[tuple[np.ndarray, np.ndarray]]:
    """Of every row its counted shingles and their counts; none if null."""
    ends = np.append(0, np.cumsum(pc.fill_null(pc.list_value_length(shingles), 0).to_numpy(zero_copy_only=False)))
    found, counts = shingles.flatten().to_numpy(zero_copy_only=False).view(np.uint64), dfs.flatten().to_numpy(zero_copy_only=False)
    return [(found[a:b], counts[a:b]) for a, b in zip(ends[:-1], ends[1:], strict=True)]


def weighted_jaccard(a: tuple[np.ndarray, ...], b: tuple[np.ndarray, ...], weigh: Weights) -> float:
    """Of two sets of shingles with counts (and the known counts of rows), by weights or by plain counts, whichever is more; 1 if both are empty."""
    _, ia, ib = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    return max(_alike(weigh.of(*a), weigh.of(*b), ia, ib), _alike(a[1], b[1], ia, ib))


def _alike(wa: np.ndarray, wb: np.ndarray, ia: np.ndarray, ib: np.ndarray) -> float:
    both = np.minimum(wa[ia], wb[ib]).sum()
    union = wa.sum() + wb.sum() - both
    return float(both / union) if union else 1.0


def plain_and_most(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> tuple[float, float]:
    """The similarity by plain counts, and the most it can be by weights, whatever the document frequencies.

    Weights lie between 1 and ``1 + SPREAD``, so it is most if what is shared weighs most and all else least.
    """
    _, ia, ib = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    plain = _alike(a[1], b[1], ia, ib)
    return plain, (1 + SPREAD) * plain / (1 + SPREAD * plain)


def _named(docs: DataFrame) -> DataFrame:
    """``node, doc_id, text``: a text's name orders by ``doc_id``, nulls first, and then by the text's hash."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    # the id as 16 digits that sort like the number
    order = F.lpad(F.hex(F.expr("doc_id ^ shiftleft(1L, 63)")), 16, "0")
    return rows.select(F.concat(F.coalesce(order, F.lit("")), F.lit("-"), F.md5("text")).alias("node"), "doc_id", "text")


def parity(terms: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """``PARITY_LONGS`` longs with a bit for each cell that holds an odd number of shingles."""
    cells = 64 * PARITY_LONGS
    odd = np.bincount((terms[counts % 2 == 1] & np.uint64(cells - 1)).astype(np.int64), minlength=cells) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view(np.int64)


def _signed(rows: DataFrame, weigh: Weights, bands: int, per_band: int) -> DataFrame:
    """``text_key, node, doc_id, bands, size, parity``, the bands as 64-bit hashes, ``size`` the number of shingles.

    Samples are drawn by weights that take a shingle which is not frequent for one of a single row:
    they decide who meets whom, not who is linked. Only ratios of weights matter to them, so that
    of most shingles is made 1, which costs least.
    """
    shared = rows.sparkSession.sparkContext.broadcast(weigh)

    def sign(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seed, now, out, sizes, odd = seeds(bands * per_band), None, [], [], []

        def lists(parts: list[np.ndarray], width: int) -> pa.Array:
            offsets = pa.array(np.arange(len(parts) + 1, dtype=np.int32) * width)
            return pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(parts).view(np.int64) if parts else np.empty(0, np.int64)))

        def done() -> pa.RecordBatch:
            columns = [now.column(0), now.column(1), lists(out, bands), pa.array(sizes, pa.int64()), lists(odd, PARITY_LONGS)]
            return pa.RecordBatch.from_arrays(columns, ["node", "doc_id", "bands", "size", "parity"])

        for batch, _, terms, counts in _shingle_sets(batches, 2):
            if batch is not now:
                if now is not None:
                    yield done()
                now, out, sizes, odd = batch, [], [], []
            drawn = blocks(terms, shared.value.of(terms, counts) / (1 + SPREAD), seed, 1 << 16).astype(np.uint64).reshape(bands, per_band)
            key = np.arange(bands, dtype=np.uint64) + np.uint64(1)
            for k in range(per_band):
                key = mix(key * np.uint64(0x9E3779B97F4A7C15) + drawn[:, k])
            out.append(key)
            sizes.append(int(counts.sum()))
            odd.append(parity(terms, counts))
        if now is not None:
            yield done()

    signed = rows.mapInArrow(sign, "node string, doc_id long, bands array<long>, size long, parity array<long>")
    return signed.withColumn("text_key", F.substring_index("node", "-", -1))


def most_apart(sizes: Column | float, similarity: float) -> Column | float:
    """By how many shingles texts of ``sizes`` together can differ and yet reach the similarity, whatever their weights.

    Weights reach it only if plain counts reach ``p`` (see ``plain_and_most``), and with ``d`` of ``n``
    shingles not shared these have the similarity ``(n - d) / (n + d)``.
    """
    p = similarity / (1 + SPREAD - SPREAD * similarity)
    return sizes * ((1 - p) / (1 + p)) + 1e-6


def _can_be_alike(similarity: float) -> Column:
    """Whether texts of ``size_a, parity_a`` and ``size_b, parity_b`` can be similar enough.

    A cell that is odd in one and even in the other holds at least one shingle that is not shared.
    """
    most = most_apart((F.col("size_a") + F.col("size_b")).cast("double"), similarity)
    odd = [F.bit_count(F.col("parity_a")[k].bitwiseXOR(F.col("parity_b")[k])) for k in range(PARITY_LONGS)]
    return (F.abs(F.col("size_a") - F.col("size_b")) <= most) & (reduce(Column.__add__, odd) <= most)


def _sided(texts: DataFrame, side: str, *shared: str) -> DataFrame:
    """``texts`` with ``node`` named ``side`` and every other column but ``shared`` with ``_side`` added."""
    return texts.select(*(F.col(c).alias(side if c == "node" else c if c in shared else f"{c}_{side}") for c in texts.columns))


def _with_texts(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """``pairs(a, b)`` with all columns of both texts, named with ``_a`` and ``_b``."""
    return pairs.join(_sided(texts, "a"), "a").join(_sided(texts, "b"), "b")


def _texts(rows: DataFrame, asked: DataFrame) -> DataFrame:
    """``node, text`` of ``asked(node, text_key)``; only rows whose hash is among those asked for are shuffled."""
    by_hash = rows.select(F.substring_index("node", "-", -1).alias("text_key"), "text").withColumn("hash", F.xxhash64("text_key"))
    near, _ = might_hold(by_hash, "hash", asked.withColumn("hash", F.xxhash64("text_key")), table_bits(asked))
    return near.join(asked, "text_key").groupBy("node").agg(F.first("text").alias("text"))


def _sets_of(a: list[str], b: list[str]) -> Iterator[tuple[tuple[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]]:
    """Of every pair of texts, both sets of shingles with counts."""
    for start in range(0, len(a), 64):
        left, right = a[start : start + 64], b[start : start + 64]
        distinct = list(dict.fromkeys(left + right))
        sets = dict(zip(distinct, _sets(distinct), strict=True))
        for x, y in zip(left, right, strict=True):
            yield sets[x], sets[y]


def _compared(pairs: DataFrame, texts: DataFrame, similarity: float) -> DataFrame:
    """Of ``pairs(a, b)``, those that can be similar enough, ``sure`` if they are by plain counts."""

    def compare(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in sliced(batches, 2):
            found = [plain_and_most(x, y) for x, y in _sets_of(rows.column(2).to_pylist(), rows.column(3).to_pylist())]
            sure, kept = pa.array([p >= similarity for p, _ in found], pa.bool_()), pa.array([m >= similarity - 1e-9 for _, m in found], pa.bool_())
            yield pa.RecordBatch.from_arrays([x.filter(kept) for x in (rows.column(0), rows.column(1), sure)], ["a", "b", "sure"])

    return _with_texts(pairs, texts).select("a", "b", "text_a", "text_b").mapInArrow(compare, "a long, b long, sure boolean")


def _verified(pairs: DataFrame, texts: DataFrame, weigh: Weights, similarity: float) -> DataFrame:
    """Of ``pairs(a, b)``, those whose texts are similar enough by weights; ``texts`` come with their ``shingles`` and ``dfs``."""
    shared = pairs.sparkSession.sparkContext.broadcast(weigh)

    def compare(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in sliced(batches, 2):
            sets = _sets_of(rows.column(2).to_pylist(), rows.column(3).to_pylist())
            known = zip(_known(rows.column(4), rows.column(5)), _known(rows.column(6), rows.column(7)), strict=True)
            kept = pa.array([weighted_jaccard((*x, kx), (*y, ky), shared.value) >= similarity for (x, y), (kx, ky) in zip(sets, known, strict=True)], pa.bool_())
            yield pa.RecordBatch.from_arrays([rows.column(0).filter(kept), rows.column(1).filter(kept)], ["a", "b"])

    columns = ("a", "b", "text_a", "text_b", "shingles_a", "dfs_a", "shingles_b", "dfs_b")
    return _with_texts(pairs, texts).select(*columns).mapInArrow(compare, "a long, b long")


def classes(docs: DataFrame, similarity: float = SIMILARITY, bands: int = BANDS, per_band: int = ROWS) -> DataFrame:
    """Per row of ``docs``: ``node`` (its own name), ``doc_id``, ``first_node`` of those with the same text, ``root`` of its class.

    Equal texts are one text from then on, with a number of its own. Each text is compared with the first
    text of every bucket it is in. As classes are what is asked for, further pairs matter only where a
    bucket still holds texts of different classes: of large buckets some texts are then compared with all
    others, which joins most of a group of copies; then some of each large class there with all outside of it,
    so that few who belong to it are left to be compared with each of its texts; and at last all texts that are
    still apart with each other.
    What is compared, in the join itself, are sizes and parities; only pairs that these do not rule
    out are met, in the first bucket they share, and compared by their texts.
    No pair of texts that shares a band is left out. Pairs that only document frequencies can
    decide wait until all others have; where their texts are still in different classes, the
    shingles of these texts are counted over all rows.

    Null texts are empty; texts without words are alike; null ids come first and stay null; repeated
    rows stay repeated; an empty table gives an empty one; extra columns are left out.
    """
    rows = _named(docs)
    weigh = weights(rows)
    signed = staged(_signed(rows, weigh, bands, per_band), "signatures")
    firsts = signed.groupBy("text_key").agg(F.min("node").alias("first_node"), *(F.first(c).alias(c) for c in ("bands", "size", "parity")))
    firsts = staged(firsts.withColumn("node", F.monotonically_increasing_id()), "distinct-texts")
    sketches, keys = firsts.select("node", "size", "parity"), firsts.select("node", "text_key")

    members = firsts.select("node", F.posexplode("bands").alias("place", "band"))
    sizes = members.groupBy("band", "place").agg(F.count(F.lit(1)).alias("n"), F.min("node").alias("first")).where("n > 1")
    members = staged(members.join(sizes, ["band", "place"]), "bucket-members")
    pairs = members.where("node <> first").select(F.col("first").alias("a"), F.col("node").alias("b")).distinct()
    pairs = staged(_with_texts(pairs, sketches).where(_can_be_alike(similarity)).select("a", "b"), "pairs")

    def ends(found: DataFrame) -> DataFrame:
        return found.select(F.col("a").alias("node")).unionByName(found.select(F.col("b").alias("node"))).distinct()

    def links(found: DataFrame) -> DataFrame:
        texts = staged(_texts(rows, staged(keys.join(ends(found), "node"), "asked")), "texts")
        return staged(_compared(found, texts, similarity), "compared")

    compared, tested, roots = links(pairs), pairs, None
    first_shared = reduce(lambda rest, k: F.when(F.col("bands_a")[k] == F.col("bands_b")[k], k).otherwise(rest), reversed(range(bands)), F.lit(bands))
    for step in ("large buckets", "large classes", "all"):
        if step == "large classes" and roots is not None:
            continue  # the pivots found nothing to compare
        if roots is None:  # else nothing was compared since
            roots = staged(components(compared.where("sure").select("a", "b")), "roots")
        at = members if step == "all" else members.where(F.col("n") > SMALL_BUCKET)
        at = at.join(roots, "node", "left").select("band", "place", "node", F.coalesce("root", "node").alias("root"))
        mixed = at.groupBy("band", "place").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low <> high").select("band", "place")
        open_ = staged(at.join(mixed, ["band", "place"]).join(firsts.select("node", "bands", "size", "parity"), "node"), "mixed-buckets")
        left, right = (_sided(open_, side, "band", "place") for side in ("a", "b"))
        apart = (F.col("root_a") != F.col("root_b")) & _can_be_alike(similarity)
        if step != "all":
            lot = F.pmod(F.xxhash64("node"), F.lit(PIVOTS)).alias("lot")
            if step == "large buckets":
                pivots = open_.groupBy("band", "place", lot).agg(F.min("node").alias("a"))
            else:  # others in each bucket, so that a text meets many
                pivots = open_.groupBy("band", "place", "root", lot).agg(F.max_by("node", F.xxhash64("node", "place")).alias("a"), F.count(F.lit(1)).alias("n"))
                pivots = pivots.where(F.col("n") * PIVOTS > SMALL_BUCKET)
            left = left.join(pivots.select("band", "place", "a"), ["band", "place", "a"], "left_semi")
            both = left.join(right.withColumnsRenamed({"band": "band_b", "place": "place_b"}), (F.col("band") == F.col("band_b")) & (F.col("place") == F.col("place_b")) & apart)
            both = both.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
        else:
            both = left.join(right.withColumnsRenamed({"band": "band_b", "place": "place_b"}), (F.col("band") == F.col("band_b")) & (F.col("place") == F.col("place_b")) & (F.col("a") < F.col("b")) & apart & (first_shared == F.col("place"))).select("a", "b")
        more = staged(both.join(tested, ["a", "b"], "left_anti"), "pairs")
        if not more.isEmpty():
            compared, tested, roots = compared.unionByName(links(more)), tested.unionByName(more), None
    if roots is None:
        roots = staged(components(compared.where("sure").select("a", "b")), "roots")
    unsure = compared.where("not sure").select("a", "b")
    for end in ("a", "b"):
        unsure = unsure.join(roots.select(F.col("node").alias(end), F.col("root").alias(f"root_{end}")), end, "left")
    apart = F.coalesce("root_a", "a") != F.coalesce("root_b", "b")
    unsure = staged(unsure.where(apart).select("a", "b"), "unsure")
    if not unsure.isEmpty():
        asked = staged(_texts(rows, staged(keys.join(ends(unsure), "node"), "asked")), "unsure-texts")
        counts = staged(row_counts(rows, weigh, asked), "row-counts")
        heavy = staged(_verified(unsure, _counted(asked, counts), weigh, similarity), "links")
        if not heavy.isEmpty():
            roots = staged(components(compared.where("sure").select("a", "b").unionByName(heavy)), "roots")
    linked = firsts.select("text_key", "node", "first_node").join(roots, "node")
    least = linked.groupBy("root").agg(F.min("first_node").alias("least"))
    rooted = firsts.select("text_key", "first_node").join(linked.join(least, "root").select("text_key", "least"), "text_key", "left")
    rooted = rooted.select("text_key", "first_node", F.coalesce("least", "first_node").alias("root"))
    return signed.select("node", "doc_id", "text_key").join(rooted, "text_key").select("node", "doc_id", "first_node", "root")


def _id(node: str) -> Column:
    """The ``doc_id`` in a text's name."""
    return F.conv(F.substring_index(node, "-", 1), 16, -10).cast("long").bitwiseXOR(F.expr("shiftleft(1L, 63)"))


def near_duplicates(docs: DataFrame, **options) -> DataFrame:
    """Per row of ``docs``: ``doc_id``, ``copy_of`` (least id with the same text) and ``class_id`` (least id of its near-duplicate class)."""
    return classes(docs, **options).select("doc_id", _id("first_node").alias("copy_of"), _id("root").alias("class_id"))


def keep_one(docs: DataFrame, **options) -> DataFrame:
    """The first row, by id and text, of every near-duplicate class, with its columns as they were.

    Rows that are equal in id and text are one document; one of them is kept.
    """
    kept = staged(classes(docs, **options).where("node = root").select("node").distinct(), "kept")
    name = free_name(docs, "text_node")
    order = F.lpad(F.hex(F.expr("cast(doc_id as long) ^ shiftleft(1L, 63)")), 16, "0")
    named = docs.withColumn(name, F.concat(F.coalesce(order, F.lit("")), F.lit("-"), F.md5(text_of())))
    return named.join(kept.withColumnRenamed("node", name), name, "left_semi").dropDuplicates([name]).select(*docs.columns)
