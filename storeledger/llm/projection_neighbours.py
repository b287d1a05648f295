"""Linking similar vectors: sorted projection passes find who belongs together, blocks count exactly who is linked."""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache, reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import components, staged
from .vectors import finite, matrix

LEAST = 0.9
#: Vectors side by side in a pass that are compared with one another.
WINDOW = 256
#: Vectors of one component that are counted together.
BLOCK = 512
#: The chance that two vectors of cosine 0.9 agree in a hash, by bit of it: measured as 0.88 in 8 dimensions, 0.90 in 256.
ALIKE = 0.88
#: The chance to miss such a pair in all passes.
MISSED = 0.02
_NEAR = 1e-12
_ANGLE = 1e-6


def unit(x: np.ndarray) -> np.ndarray:
    """Rows scaled to length one, whatever their magnitude."""
    x = x / np.abs(x).max(axis=1, keepdims=True, initial=0)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def linked(a: np.ndarray, b: np.ndarray, least: float = LEAST) -> np.ndarray:
    """Which unit rows of ``a`` and ``b`` have a cosine of ``least`` or more; close calls are settled by exactly rounded sums."""
    cosine = a @ b.T
    found = cosine >= least
    for i, j in zip(*np.nonzero(np.abs(cosine - least) < _NEAR), strict=True):
        exact = math.fsum(a[i] * b[j]) / math.sqrt(math.fsum(a[i] * a[i]) * math.fsum(b[j] * b[j]))
        found[i, j] = exact >= least or math.isclose(exact, least, rel_tol=4e-16)
    return found


@lru_cache(maxsize=4)
def _directions(size: int, seed: int, hashes: int) -> np.ndarray:
    return np.random.default_rng([size, seed]).standard_normal((size, size * hashes))


def hash_bits(size: int) -> int:
    return max(1, (2 * size - 1).bit_length())


def hash_count(size: int) -> int:
    return max(1, min(4, 62 // hash_bits(size)))


def sort_keys(x: np.ndarray, seed: int) -> np.ndarray:
    """Concatenated hashes of unit rows: each is the random direction, of as many as dimensions, a row lies closest to, or its opposite."""
    size = x.shape[1]
    n, bits = hash_count(size), hash_bits(size)
    turned = (x @ _directions(size, seed, n)).reshape(len(x), n, size)
    nearest = np.abs(turned).argmax(axis=2)
    negative = np.take_along_axis(turned, nearest[:, :, None], axis=2)[:, :, 0] < 0
    codes = 2 * nearest.astype(np.int64) + negative
    key = np.zeros(len(x), np.int64)
    for k in range(n):
        key = (key << bits) | codes[:, k]
    return key


def pass_count(vectors: int, window: int = WINDOW) -> int:
    """As many passes as it takes to miss a pair at the threshold less often than ``MISSED``.

    Sorted neighbours within a window share about as many bits as cut all vectors into groups of that size.
    """
    bits = max(0.0, math.log2(max(1, vectors) / window))
    return max(4, math.ceil(math.log(MISSED) / math.log1p(-min(0.9, ALIKE**bits))))


def _spanning(links: np.ndarray) -> np.ndarray:
    """For each row the first row it is connected with, by links among all."""
    label = np.arange(len(links))
    i, j = np.nonzero(links)
    while True:
        new = label.copy()
        np.minimum.at(new, i, label[j])
        new = new[new]
        if (new == label).all():
            return label
        label = new


def _ordered(nodes: DataFrame, seed: int, by: list[str]) -> DataFrame:
    """``nodes`` with their sort keys, dealt and sorted by ``by``, length, key and node."""
    at = nodes.columns.index("embedding")
    schema = T.StructType([*nodes.schema.fields, T.StructField("size", T.IntegerType()), T.StructField("key", T.LongType())])

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            lists = rows.column(at)
            size = lists.value_lengths().to_numpy(zero_copy_only=False)
            key = np.zeros(len(size), np.int64)
            for s in np.unique(size):
                which = np.flatnonzero(size == s)
                key[which] = sort_keys(unit(matrix(lists.take(pa.array(which)))), seed)
            yield pa.RecordBatch.from_arrays([*rows.columns, pa.array(size, pa.int32()), pa.array(key)], schema.names)

    order = [*by, "size", "key", "node"]
    return nodes.mapInArrow(keyed, schema).repartitionByRange(*order).sortWithinPartitions(*order)


def _stretches(batches: Iterator[pa.RecordBatch], names: tuple[str, ...], most: int) -> Iterator[pa.RecordBatch]:
    """Rows in a row that agree in ``names``, at most ``most`` of them at a time."""
    held: list[pa.RecordBatch] = []
    value, n = None, 0

    def whole() -> pa.RecordBatch:
        return pa.Table.from_batches(held).combine_chunks().to_batches()[0]

    for rows in batches:
        if not rows.num_rows:
            continue
        columns = [rows.column(rows.schema.get_field_index(c)).to_numpy(zero_copy_only=False) for c in names]
        cuts = np.flatnonzero(np.append(True, np.any([c[1:] != c[:-1] for c in columns], axis=0))).tolist()
        for at, to in zip(cuts, [*cuts[1:], rows.num_rows], strict=True):
            here = tuple(c[at] for c in columns)
            while at < to:
                if held and (here != value or n == most):
                    yield whole()
                    held, n = [], 0
                value, part = here, rows.slice(at, min(to - at, most - n))
                held.append(part)
                n, at = n + part.num_rows, at + part.num_rows
    if held:
        yield whole()


def _pass(nodes: DataFrame, seed: int, least: float, window: int) -> DataFrame:
    """Edges ``a, b`` that connect what verified links within windows of one pass connect."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before, x_before, size = np.empty(0, np.int64), None, None
        for rows in _stretches(batches, ("size",), 2 * window):
            node, x = rows.column(0).to_numpy(), unit(matrix(rows.column(1)))
            if x.shape[1] == size:
                node, x = np.append(before, node), np.concatenate([x_before, x])
            label = _spanning(linked(x, x, least))
            apart = np.flatnonzero(label != np.arange(len(label)))
            if len(apart):
                yield pa.RecordBatch.from_arrays([pa.array(node[apart]), pa.array(node[label[apart]])], ["a", "b"])
            before, x_before, size = node[-window:], x[-window:], x.shape[1]

    return _ordered(nodes.select("node", "embedding"), seed, []).mapInArrow(compare, "a long, b long")


def _blocks(members: DataFrame, block: int) -> DataFrame:
    """``members(root, node, copies, least, embedding)`` in blocks of one component each, close ones together.

    Every block has its nodes, the sum of its unit vectors, that sum's direction, and the widest angle to it.
    """
    ddl = (
        "root long, block long, weight long, least long, nodes array<long>, copies array<long>, vectors array<double>, "
        "total array<double>, centre array<double>, angle double"
    )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _stretches(batches, ("root", "size"), block):
            node, copies = rows.column("node").to_numpy(), rows.column("copies").to_numpy()
            x = unit(matrix(rows.column("embedding")))
            total = x.sum(axis=0)
            centre = total / (np.sqrt((total * total).sum()) or 1)
            out = {
                "root": [rows.column("root")[0].as_py()], "block": [int(node[0])], "weight": [int(copies.sum())], "least": [int(rows.column("least").to_numpy().min())],
                "nodes": [node], "copies": [copies], "vectors": [x.ravel()], "total": [total], "centre": [centre],
                "angle": [float(np.arccos(np.clip((x @ centre).min(), -1, 1)))],
            }
            yield pa.RecordBatch.from_pydict(out)

    return _ordered(members, 0, ["root"]).mapInArrow(cut, ddl)


def _angle(a: str, b: str):
    dot = F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)
    return F.acos(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), dot)))


def _tight(blocks: DataFrame, widest: float) -> DataFrame:
    """Roots of components in several blocks that lie so close around their mean that all pairs are linked."""
    several = blocks.groupBy("root").count().where("count > 1").select("root")
    some = blocks.select("root", "total", "centre", "angle").join(several, "root")
    sums = some.select("root", F.posexplode("total").alias("at", "v")).groupBy("root", "at").agg(F.sum("v").alias("v"))
    length = sums.groupBy("root").agg(F.sqrt(F.sum(F.col("v") * F.col("v"))).alias("length")).where("length > 0")
    mean = sums.join(length, "root").groupBy("root").agg(F.array_sort(F.collect_list(F.struct("at", (F.col("v") / F.col("length")).alias("v")))).alias("m"))
    mean = mean.select("root", F.col("m.v").alias("mean"))  # as long as a vector
    reach = some.join(mean, "root").groupBy("root").agg(F.max(_angle("centre", "mean") + F.col("angle")).alias("reach"))
    return reach.where(2 * F.col("reach") <= widest).select("root", F.lit(True).alias("tight"))


def _counted(blocks: DataFrame, pairs: DataFrame, least: float) -> DataFrame:
    """``node, links``: of every two blocks in ``pairs(block, other)`` the copies of linked vectors on the other side."""
    load = blocks.select("block", "nodes", "copies", "vectors")
    other = load.select(F.col("block").alias("other"), F.col("nodes").alias("nodes2"), F.col("copies").alias("copies2"), F.col("vectors").alias("vectors2"))
    both = pairs.join(load, "block").join(other, "other")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            for k in range(rows.num_rows):
                nodes, copies, flat, nodes2, copies2, flat2 = (rows.column(c)[k].values.to_numpy(zero_copy_only=False) for c in ("nodes", "copies", "vectors", "nodes2", "copies2", "vectors2"))
                same = rows.column("block")[k] == rows.column("other")[k]
                found = linked(flat.reshape(len(nodes), -1), flat2.reshape(len(nodes2), -1), least)
                if same:
                    np.fill_diagonal(found, True)  # copies are linked with each other, though not with themselves
                yield pa.RecordBatch.from_pydict({"node": nodes, "links": found @ copies2 - int(same)})
                if not same:
                    yield pa.RecordBatch.from_pydict({"node": nodes2, "links": copies @ found})

    return both.mapInArrow(count, "node long, links long")


def _links(blocks: DataFrame, least: float) -> DataFrame:
    """``node, links, component`` of every vector in a component.

    Tight components need no comparison. In the others, blocks that lie so close that all their vectors are
    linked, or so far apart that none is, are settled by their centres and widest angles; only what is
    left is compared, vector by vector.
    """
    widest = math.acos(least)
    stats = blocks.groupBy("root").agg(F.sum("weight").alias("members"), F.min("least").alias("component"))
    at = staged(
        blocks.select("root", "block", "weight", "centre", "angle")
        .join(stats, "root")
        .join(_tight(blocks, widest - _ANGLE), "root", "left")
        .select("*", F.col("tight").isNotNull().alias("all")).drop("tight"),
        "block-centres",
    )
    open_ = at.where("not all")
    two = open_.select("root", "block", "weight", "centre", "angle").join(
        open_.select("root", F.col("block").alias("other"), F.col("weight").alias("weight2"), F.col("centre").alias("centre2"), F.col("angle").alias("angle2")), "root"
    )
    apart, room = _angle("centre", "centre2"), F.col("angle") + F.col("angle2")
    two = two.where("block < other").withColumn("apart", apart).withColumn("room", room).where(F.col("apart") - F.col("room") <= widest + _ANGLE)
    two = staged(two.select("block", "other", "weight", "weight2", (F.col("apart") + F.col("room") <= widest - _ANGLE).alias("all")), "block-pairs")
    whole = two.where("all")
    whole = whole.select("block", F.col("weight2").alias("more")).unionByName(whole.select(F.col("other").alias("block"), F.col("weight").alias("more")))
    whole = whole.groupBy("block").agg(F.sum("more").alias("more"))
    pairs = two.where("not all").select("block", "other").unionByName(open_.select("block", F.col("block").alias("other")))
    compared = _counted(blocks, pairs, least).groupBy("node").agg(F.sum("links").alias("links"))
    base = at.join(whole, "block", "left").select(
        "block", "component", F.when(F.col("all"), F.col("members") - 1).otherwise(F.coalesce("more", F.lit(0))).alias("base")
    )
    each = blocks.select("block", "nodes").join(base, "block").select(F.explode("nodes").alias("node"), "component", "base")
    return each.join(compared, "node", "left").select("node", "component", (F.col("base") + F.coalesce("links", F.lit(0))).alias("links"))


def similar_vectors(vectors: DataFrame, least: float = LEAST, window: int = WINDOW, block: int = BLOCK) -> DataFrame:
    """Per row of ``vectors(vec_id, embedding)``: ``vec_id, n_links, component_id, kept``.

    Two rows are linked if the cosine of their vectors is ``least`` or more, in double precision. ``n_links`` is the
    number of other rows a row is linked with, ``component_id`` the smallest id links lead to.

    Equal vectors are one vector with a count. Each pass orders the vectors by hashes of their own random
    directions and compares neighbours within a bounded window; what verified pairs of all passes connect is
    a component. Windows limit what a pass finds in a crowd, so links are then counted anew, exactly,
    within components. A pair at the threshold that nothing else connects is missed with a chance of about
    ``MISSED``, closer pairs far less often.

    Vectors that are null, zero, empty or hold null, NaN or infinite entries, and rows without an id, are linked with
    nothing: they are components of their own, and kept. Vectors of different lengths are never linked.
    Repeated rows are linked with each other, like all rows of one vector; of an id that occurs several
    times all rows are kept if one is. An empty table gives an empty one. Extra columns are left out.
    """
    single = isinstance(vectors.schema["embedding"].dataType, T.ArrayType) and isinstance(vectors.schema["embedding"].dataType.elementType, T.FloatType)
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast(f"array<{'float' if single else 'double'}>").alias("embedding"))
    usable = F.col("vec_id").isNotNull() & finite() & F.coalesce(F.exists("embedding", lambda x: x != 0), F.lit(False))
    digests = [F.xxhash64(F.lit(k), "embedding").alias(f"h{k}") for k in (1, 2)]
    nodes = rows.where(usable).groupBy("embedding").agg(F.min("vec_id").alias("least"), F.count(F.lit(1)).alias("copies"))
    nodes = staged(nodes.select(F.monotonically_increasing_id().alias("node"), "least", "copies", *digests, "embedding"), "vectors")
    n = nodes.count()
    found = [staged(_pass(nodes, seed, least, window), "pass") for seed in range(pass_count(n, window))] if n else []
    edges = reduce(DataFrame.unionByName, found) if found else nodes.select(F.col("node").alias("a"), F.col("node").alias("b"))
    of_node = components(edges)
    members = nodes.select("node", "least", "copies", "embedding").join(of_node, "node")
    links = _links(staged(_blocks(members, block), "blocks"), least)
    done = staged(
        nodes.drop("embedding").join(links, "node", "left").select(
            "least", "copies", "h1", "h2", F.coalesce("links", F.col("copies") - 1).alias("n_links"), F.coalesce("component", "least").alias("component_id")
        ),
        "links",
    )
    spread = 16  # a vector may be a third of all rows
    many = done.where("copies > 1").select("h1", "h2", "n_links", "component_id", F.explode(F.sequence(F.lit(0), F.lit(spread - 1))).alias("part"))
    own = rows.where(usable).select("vec_id", *digests, F.pmod(F.xxhash64("vec_id"), F.lit(spread)).cast("int").alias("part"))
    every = (
        done.where("copies = 1").select(F.col("least").alias("vec_id"), "n_links", "component_id")
        .unionByName(own.join(many, ["h1", "h2", "part"]).select("vec_id", "n_links", "component_id"))
        .unionByName(rows.where(~usable).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id")))
    )
    return every.select("*", F.col("vec_id").eqNullSafe(F.col("component_id")).alias("kept"))


SQL = """
WITH RECURSIVE vectors AS (
    SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
    WHERE embedding IS NOT NULL AND vec_id IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), links AS (
    SELECT a.vec_id AS a, b.vec_id AS b FROM vectors AS a JOIN vectors AS b
    ON a.vec_id <> b.vec_id AND len(a.v) = len(b.v) AND list_cosine_similarity(a.v, b.v) >= 0.9
), reached AS (
    SELECT vec_id AS a, vec_id AS b FROM vectors UNION SELECT reached.a, links.b FROM reached JOIN links ON reached.b = links.a
), least AS (SELECT a, min(b) AS component_id FROM reached GROUP BY a), counted AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT e.vec_id, CAST(coalesce(n, 0) AS BIGINT) AS n_links, coalesce(component_id, e.vec_id) AS component_id, coalesce(component_id, e.vec_id) = e.vec_id AS kept
FROM embeddings AS e LEFT JOIN least ON least.a = e.vec_id LEFT JOIN counted ON counted.a = e.vec_id
"""
