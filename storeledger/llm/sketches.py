"""Count-min sketches of a corpus, merged from sketches of its partitions."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SLICES = 1024
#: Keys that a task holds before it folds them into its sketch.
HELD = 1 << 20
#: Bits of the cells in which ``frequent_keys`` counts: so many that hardly two keys share one; in a slice they take four bytes.
FINE = 42
_SLICE_BITS = SLICES.bit_length() - 1
_IN_SLICE = (1 << (FINE - _SLICE_BITS)) - 1

Keys = Callable[[Iterable[pa.RecordBatch]], Iterator[np.ndarray]]
_LOCAL = pa.schema([("slice", pa.int32()), ("offsets", pa.binary()), ("counts", pa.binary())])


def cell(keys: np.ndarray, bits: int) -> np.ndarray:
    """The cell of each key: its upper ``bits``."""
    return (keys >> np.uint64(64 - bits)).astype(np.int64)


def is_set(bitmap: np.ndarray, cells: np.ndarray) -> np.ndarray:
    return (bitmap[cells >> 3] >> (cells & 7).astype(np.uint8)) & 1 == 1


def _partial_counts(rows: DataFrame, keys: Keys, bits: int, kind: str, most: int) -> DataFrame:
    """``slice, offsets, counts``: the cells of each partition's keys, sparse, sorted by slice with a slice in one task.

    Of ``2 ** bits`` cells each slice has an equal range; counts are of ``kind``, ``most`` at most.
    """
    size = (1 << bits) // SLICES

    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells, counts = np.empty(0, np.int64), np.empty(0, np.int64)
        held: list[np.ndarray] = []

        def fold() -> tuple[np.ndarray, np.ndarray]:
            new, m = np.unique(cell(np.concatenate(held), bits), return_counts=True)
            if not len(cells):
                return new, np.minimum(m, most)
            every, where = np.unique(np.concatenate([cells, new]), return_inverse=True)
            return every, np.minimum(np.bincount(where, np.concatenate([counts, m])).astype(np.int64), most)

        n = 0
        for found in keys(batches):
            held.append(found)
            n += len(found)
            if n >= HELD:
                cells, counts = fold()
                held, n = [], 0
        if n:
            cells, counts = fold()
        packed = counts.astype(kind)
        ends = np.searchsorted(cells, np.arange(SLICES + 1) * size).tolist()
        out = [
            {"slice": k, "offsets": (cells[a:b] - k * size).astype("<u4").tobytes(), "counts": packed[a:b].tobytes()}
            for k, (a, b) in enumerate(zip(ends[:-1], ends[1:], strict=True))
            if b > a
        ]
        yield pa.RecordBatch.from_pylist(out, schema=_LOCAL)

    return rows.mapInArrow(local, "slice int, offsets binary, counts binary").repartition("slice").sortWithinPartitions("slice")


def _gathered(parts: DataFrame, begin: Callable[[], tuple[Callable[[bytes, bytes], None], Callable[[], bytes]]], bits: int) -> np.ndarray:
    """The bitmap of all slices. Of the functions that ``begin`` gives a task, one takes in one partition's part of a slice, one gives the slice's bits and starts anew."""

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now = None
        add, packed = begin()

        def row() -> pa.RecordBatch:
            return pa.RecordBatch.from_pydict({"slice": pa.array([now], pa.int32()), "cells": pa.array([packed()], pa.binary())})

        for rows in batches:
            for k, offsets, counts in zip(*(rows.column(c).to_pylist() for c in range(3)), strict=True):
                if k != now:
                    if now is not None:
                        yield row()
                    now = k
                add(offsets, counts)
        if now is not None:
            yield row()

    merged = parts.mapInArrow(merge, "slice int, cells binary").toArrow()  # in one job: an iterator would run one for each partition
    size = (1 << bits) // SLICES
    bitmap = np.zeros((1 << bits) // 8, np.uint8)
    for k, cells in zip(merged.column(0).to_pylist(), merged.column(1), strict=True):
        bitmap[k * size // 8 : (k + 1) * size // 8] = np.frombuffer(cells.as_buffer(), np.uint8)
    return bitmap


def frequent_cells(rows: DataFrame, keys: Keys, bits: int, least: int) -> np.ndarray:
    """A packed bitmap of the ``2 ** bits`` cells (20 to 28 bits) whose keys occur ``least`` times or more in all.

    ``keys`` gives the 64-bit keys of a partition's batches. Each partition sketches its own keys
    and sends its counts, sparse and cut in slices; the task of a slice adds them up, one
    partition's part after another. A cell counts all keys that fall into it, so a key that
    occurs ``least`` times is never missed. The driver gets the cells that reach it, a bit each.
    """
    kind, most = ("u1", least) if least < 256 else ("<u4", (1 << 32) - 1)

    def begin() -> tuple[Callable[[bytes, bytes], None], Callable[[], bytes]]:
        total = np.zeros((1 << bits) // SLICES, np.int64)

        def add(offsets: bytes, counts: bytes) -> None:
            total[np.frombuffer(offsets, "<u4")] += np.frombuffer(counts, kind)

        def packed() -> bytes:
            cells = np.packbits(total >= least, bitorder="little").tobytes()
            total[:] = 0
            return cells

        return add, packed

    return _gathered(_partial_counts(rows, keys, bits, kind, most), begin, bits)


def _marks(cells: np.ndarray, bits: int) -> Iterator[np.ndarray]:
    """The two bits of each of the ``2 ** FINE`` cells in a bitmap of ``2 ** bits``, both in the part of the cell's slice."""
    width = bits - _SLICE_BITS
    offset = cells.astype(np.uint64) & np.uint64(_IN_SLICE)
    for mixed in (offset, (offset * np.uint64(0x9E3779B1)) & np.uint64(_IN_SLICE)):
        yield ((cells >> (FINE - _SLICE_BITS)) << width) | (mixed >> np.uint64(FINE - _SLICE_BITS - width)).astype(np.int64)


def frequent_keys(rows: DataFrame, keys: Keys, bits: int, least: int) -> np.ndarray:
    """A bitmap of ``2 ** bits`` (20 to 28 bits), for ``is_marked``, of the keys that occur ``least`` times or more in all.

    As ``frequent_cells``, but keys are counted in ``2 ** FINE`` cells, of which only those in use
    take room, and only the cells that reach ``least`` are marked, by two bits each. So what fills the
    bitmap are the keys that are looked for, however many others there are.
    """
    kind, most = ("u1", least) if least < 256 else ("<u4", (1 << 32) - 1)

    def begin() -> tuple[Callable[[bytes, bytes], None], Callable[[], bytes]]:
        held: list[tuple[np.ndarray, np.ndarray]] = []

        def add(offsets: bytes, counts: bytes) -> None:
            held.append((np.frombuffer(offsets, "<u4"), np.frombuffer(counts, kind)))

        def packed() -> bytes:
            cells, where = np.unique(np.concatenate([c for c, _ in held]), return_inverse=True)
            often = cells[np.bincount(where, np.concatenate([n for _, n in held])) >= least]
            held.clear()
            marked = np.zeros((1 << bits) // SLICES, bool)
            for mark in _marks(often.astype(np.int64), bits):
                marked[mark] = True
            return np.packbits(marked, bitorder="little").tobytes()

        return add, packed

    return _gathered(_partial_counts(rows, keys, FINE, kind, most), begin, bits)


def is_marked(bitmap: np.ndarray, keys: np.ndarray, bits: int) -> np.ndarray:
    """Whether each key may be among those of ``frequent_keys``; one that is among them never is missed."""
    first, second = (is_set(bitmap, mark) for mark in _marks(cell(keys, FINE), bits))
    return first & second


def column_keys(name: str) -> Keys:
    """Keys that stand in an integer column."""

    def keys(batches: Iterable[pa.RecordBatch]) -> Iterator[np.ndarray]:
        for rows in batches:
            yield rows.column(rows.schema.get_field_index(name)).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)

    return keys


def table_bits(rows: DataFrame) -> int:
    """Bits of a sketch with about eight cells for each row, 32 MB at most; ``rows`` should be a written table."""
    return min(28, max(20, (8 * rows.count()).bit_length()))


def _looked_up(rows: DataFrame, column: str, bitmap: np.ndarray, among: Callable[[np.ndarray, np.ndarray], np.ndarray]) -> Column:
    shared = rows.sparkSession.sparkContext.broadcast(bitmap)

    @F.pandas_udf("boolean")
    def held(values: pd.Series) -> pd.Series:
        return pd.Series(among(shared.value, values.to_numpy(np.int64).view(np.uint64)))

    return held.asNondeterministic()(column)  # one evaluation a row


def may_repeat(rows: DataFrame, column: str) -> Column:
    """False where the hash in ``column`` surely is no other row's; ``rows`` should be a written table."""
    bits = table_bits(rows)
    bitmap = frequent_keys(rows.select(column), column_keys(column), bits, 2)
    return _looked_up(rows, column, bitmap, lambda marked, keys: is_marked(marked, keys, bits))


def might_hold(rows: DataFrame, column: str, of: DataFrame, bits: int = 22) -> tuple[DataFrame, DataFrame]:
    """``rows`` whose hash in ``column`` may be among those of ``of``, and the rest, which surely is not.

    The bitmap has ``2 ** bits`` bits, however many rows there are; with it, rows that will find no
    partner need not be shuffled to a join.
    """
    bitmap = frequent_cells(of.select(column), column_keys(column), bits, 1)
    held = _looked_up(rows, column, bitmap, lambda cells, keys: is_set(cells, cell(keys, bits)))
    return rows.where(held), rows.where(~held)
