"""Whitening of vectors from an exact covariance, by bit-sliced scatter."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .vectors import finite_vectors, matrix

SCALE, SHIFT = 64, 1_000_000
COMPONENTS = 32
#: Rows whose planes are held at a time.
ROWS = 1 << 14
_LOWEST, _HIGHEST = -(1 << 63), (1 << 63) - 1


def quantised(values: np.ndarray) -> np.ndarray:
    """``floor(64 c) + 1000000`` as 64-bit integers; what these cannot hold becomes the nearest they can."""
    scaled = np.floor(values * SCALE)
    inside = np.clip(scaled, -(2.0**63), 2.0**62).astype(np.int64) + SHIFT
    return np.where(scaled > 2.0**62, np.int64(_HIGHEST), inside)


def planes(shifted: np.ndarray, bits: list[int]) -> np.ndarray:
    """The bit planes of all dimensions, in order, each packed across rows into 64-bit words."""
    packed = [np.packbits((shifted[:, j] >> np.uint64(a)) & np.uint64(1) == 1, bitorder="little") for j, n in enumerate(bits) for a in range(n)]
    if not packed:
        return np.empty((0, 0), np.uint64)
    table = np.stack(packed)
    return np.pad(table, ((0, 0), (0, -table.shape[1] % 8))).view(np.uint64)


@dataclass
class Whitening:
    """Fitted on ``n`` vectors: sums over dimensions, eigenvectors by falling eigenvalue, and the share each explains."""

    n: int
    size: int
    least: list[int]  # per dimension, subtracted before packing
    sums: list[int]  # of what is left, over all vectors
    basis: np.ndarray  # columns: eigenvector over the root of its eigenvalue
    explained: np.ndarray

    def shifted(self, x: np.ndarray) -> np.ndarray:
        return x.view(np.uint64) - np.array([v % (1 << 64) for v in self.least], np.uint64)

    def project(self, x: np.ndarray) -> np.ndarray:
        return (self.shifted(x).astype(np.float64) - np.array([s / self.n for s in self.sums])) @ self.basis

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """Sums over dimensions of ``(n x - S)^2``, exact; none where a 64-bit integer cannot hold it."""
        u = self.shifted(x)
        most = max((max(abs(self.n * int(u[:, j].max()) - s), abs(self.n * int(u[:, j].min()) - s)) for j, s in enumerate(self.sums)), default=0)
        if most * most * max(1, len(self.sums)) <= _HIGHEST:
            off = self.n * u.astype(np.int64) - np.array(self.sums, np.int64)
            return (off * off).sum(axis=1).tolist()
        exact = [sum((self.n * v - s) ** 2 for v, s in zip(row, self.sums, strict=True)) for row in u.tolist()]
        return [v if v <= _HIGHEST else None for v in exact]


def _ranges(rows: DataFrame) -> list:
    """Per dimension the number of vectors, the least and the greatest integer; one row a dimension reaches the driver."""

    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, low, high = 0, None, None
        for batch in batches:
            x = quantised(matrix(batch.column(1)))
            if len(x):
                n += len(x)
                low, high = (x.min(axis=0), x.max(axis=0)) if low is None else (np.minimum(low, x.min(axis=0)), np.maximum(high, x.max(axis=0)))
        if n:
            yield pa.RecordBatch.from_pydict({"dim": pa.array(range(len(low)), pa.int32()), "n": [n] * len(low), "low": low, "high": high})

    parts = rows.mapInArrow(local, "dim int, n long, low long, high long")
    return parts.groupBy("dim").agg(F.sum("n").alias("n"), F.min("low").alias("low"), F.max("high").alias("high")).orderBy("dim").collect()


def _products(rows: DataFrame, least: list[int], bits: list[int]) -> dict[tuple[int, int], int]:
    """Exact sums of products of shifted entries by pair of dimensions; ``(j, -1)`` holds the plain sums.

    Every pair of planes is one AND and one popcount over packed words, worth two to the power of
    both planes' places. Counts are added up by place in Spark and weighted as unbounded integers.
    """
    dim_of = np.array([j for j, n in enumerate(bits) for _ in range(n)], np.int64)
    place_of = np.array([a for n in bits for a in range(n)], np.int64)
    base = np.array([v % (1 << 64) for v in least], np.uint64)
    places = 2 * max(bits, default=0) + 1

    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((len(bits), len(bits) + 1, places), np.int64)  # the last column: plain sums
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                packed = planes(quantised(matrix(batch.column(1).slice(at, ROWS))).view(np.uint64) - base, bits)
                for i in range(len(packed)):
                    j, place = dim_of[i], place_of[i]
                    both = np.bitwise_count(packed[i:] & packed[i]).sum(axis=1, dtype=np.int64)
                    counts[j, -1, place] += both[0]
                    # planes of one dimension meet in both orders, which is worth one place more
                    up = place + place_of[i:] + ((dim_of[i:] == j) & (np.arange(len(both)) > 0))
                    np.add.at(counts[j], (dim_of[i:], up), both)
        j, k, place = np.nonzero(counts)
        yield pa.RecordBatch.from_pydict({"j": pa.array(j, pa.int32()), "k": pa.array(np.where(k == len(bits), -1, k), pa.int32()), "place": pa.array(place, pa.int32()), "n": counts[j, k, place]})

    found = rows.mapInArrow(local, "j int, k int, place int, n long").groupBy("j", "k", "place").agg(F.sum("n").alias("n"))
    total: dict[tuple[int, int], int] = {}
    for row in found.toLocalIterator():  # grows with the dimensions, not with the rows
        total[row.j, row.k] = total.get((row.j, row.k), 0) + (row.n << row.place)
    return total


def fit(vectors: DataFrame, components: int = COMPONENTS) -> Whitening | None:
    """The whitening of ``vectors(vec_id, embedding)``, all of one length; none of no vectors or of length 0."""
    ranges = _ranges(vectors)
    if not ranges:
        return None
    n, least = ranges[0].n, [r.low for r in ranges]
    bits = [(r.high - r.low).bit_length() for r in ranges]
    total = _products(vectors, least, bits)
    sums = [total.get((j, -1), 0) for j in range(len(bits))]
    cov = np.zeros((len(bits), len(bits)))
    for j in range(len(bits)):
        for k in range(j, len(bits)):
            cov[j, k] = cov[k, j] = (n * total.get((j, k), 0) - sums[j] * sums[k]) / n**2  # integers: rounded once
    values, basis = np.linalg.eigh(cov)
    values, basis = values[::-1], basis[:, ::-1]
    kept = min(components, int((values > len(bits) * np.finfo(float).eps * max(values[0], 0)).sum()))
    return Whitening(n, len(bits), least, sums, basis[:, :kept] / np.sqrt(values[:kept]), values[:kept] / (np.trace(cov) or 1))


def identity_error(vectors: DataFrame, by: Whitening) -> float:
    """The largest absolute entry of the whitened vectors' covariance minus the identity, taken over all of them."""
    width = by.basis.shape[1]

    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((width + 1, width))
        for batch in batches:
            y = by.project(quantised(matrix(batch.column(1))))
            total[:width] += y.T @ y
            total[width] += y.sum(axis=0)
        a, b = np.indices(total.shape)
        yield pa.RecordBatch.from_pydict({"a": pa.array(a.ravel(), pa.int32()), "b": pa.array(b.ravel(), pa.int32()), "v": total.ravel()})

    if not width:
        return 0.0
    total = np.zeros((width + 1, width))
    for row in vectors.mapInArrow(local, "a int, b int, v double").groupBy("a", "b").agg(F.sum("v").alias("v")).collect():
        total[row.a, row.b] = row.v
    mean = total[width] / by.n
    return float(np.abs(total[:width] / by.n - np.outer(mean, mean) - np.eye(width)).max())


def whitened(vectors: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """Per vector and component: ``vec_id, component, n, deviation, whitened, explained, identity_error``.

    Entries become integers, ``floor(64 c) + 1000000``; sums and cross-products of these are exact, taken
    from bit planes packed across rows, and centred as integers before the eigenvectors are found.

    Vectors that are null or hold null, NaN or infinite entries are dropped, and so are those whose length is
    not the most frequent one (of equally frequent lengths the longest stays). Components without
    variance are left out: a single vector, equal vectors, or an empty table give no rows. Null ids and
    repeated rows stay as they are. An entry beyond 64-bit integers becomes the nearest of these; a
    deviation they cannot hold is null. Extra columns are left out.
    """
    rows = finite_vectors(vectors)
    by = fit(rows, components)
    ddl = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    if by is None or not by.basis.shape[1]:
        return vectors.sparkSession.createDataFrame([], ddl)
    error = identity_error(rows, by)
    width = by.basis.shape[1]

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = quantised(matrix(batch.column(1)))
            if not len(x):
                continue
            each = np.repeat(np.arange(len(x)), width)
            yield pa.RecordBatch.from_pydict({
                "vec_id": batch.column(0).take(pa.array(each)),
                "component": pa.array(np.tile(np.arange(1, width + 1), len(x)), pa.int32()),
                "n": pa.array(np.full(len(each), by.n)),
                "deviation": pa.array(by.deviations(x), pa.int64()).take(pa.array(each)),
                "whitened": by.project(x).ravel(),
                "explained": np.tile(by.explained, len(x)),
                "identity_error": np.full(len(each), error),
            })

    return rows.mapInArrow(emit, ddl)
