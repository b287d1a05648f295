"""The best legacy products by price inside families, without forming pairs.

A family is all legacy products with one name and one brand. Inside it the
score falls as the price moves away from the asked one, on either side, so the
best two are among the two nearest prices at or below and the two above, plus the
two smallest ids for prices that give no similarity at all.

Points and asked prices of a family are one ordered list of distinct prices. It
is cut at its own quantiles into slices of about equal size, each sorted by
itself; what lies beyond a slice's ends comes from the two outermost points
of the slices before and after it. The same plan serves families of any size.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..staging import staged

# Distinct prices of a family that one slice should hold.
SLICE_ROWS = 50_000
# Quantiles kept per family, and so the most slices.
QUANTILES = 256
_POINTS = "array<struct<price:double,ids:array<string>>>"


class Points(NamedTuple):
    """Price points (family, price, ids) and the smallest ids of each family."""

    points: DataFrame
    floor: DataFrame


def legacy_points(legacy: DataFrame) -> DataFrame:
    """Two smallest ids per (family, price). ``legacy``: family, id, price.

    Spark limits each group to two rows before the shuffle.
    """
    rank = F.row_number().over(Window.partitionBy("family", "price").orderBy("id"))
    return (
        legacy.withColumn("_rank", rank).where("_rank <= 2")
        .groupBy("family", "price").agg(F.sort_array(F.collect_list("id")).alias("ids"))
    )


def smallest_ids(points: DataFrame) -> DataFrame:
    """The two smallest ids of each family, with their prices."""
    flat = points.select("family", "price", F.explode("ids").alias("id"))
    rank = F.row_number().over(Window.partitionBy("family").orderBy("id"))
    return (
        flat.withColumn("_rank", rank).where("_rank <= 2")
        .groupBy("family").agg(F.collect_list(
            F.struct("price", F.array("id").alias("ids"))).alias("floor"))
    )


def prepare(points: DataFrame) -> Points:
    """``points`` is read several times, so hand in a written table."""
    return Points(points, staged(smallest_ids(points), "smallest-ids"))


def price_list(points: DataFrame, asked: DataFrame) -> DataFrame:
    """One row per family and price, of points and asked prices together: ``family, price, ids, is_asked``."""
    both = points.select("family", "price", "ids", F.lit(False).alias("is_asked")).unionByName(
        asked.select("family", "price", F.lit(None).cast("array<string>").alias("ids"), F.lit(True).alias("is_asked")))
    return both.where("price is not null").groupBy("family", "price").agg(
        F.max("ids").alias("ids"), F.max("is_asked").alias("is_asked"))


def in_slices(prices: DataFrame, slice_rows: int) -> DataFrame:
    """``prices`` with the ``slice`` of each row.

    Only families of more than one slice are looked up: at most a row for every
    ``slice_rows`` rows.
    """
    large = prices.groupBy("family").agg(F.count(F.lit(1)).alias("rows")).where(F.col("rows") > slice_rows)
    places = [k / QUANTILES for k in range(1, QUANTILES)]
    slices = F.least(F.lit(QUANTILES), F.ceil(F.col("rows") / slice_rows)).cast("int")
    cuts = prices.join(large, "family").groupBy("family").agg(
        F.first(slices).alias("slices"), F.percentile_approx("price", places, 20 * QUANTILES).alias("quantiles"))
    bounds = F.transform(
        F.sequence(F.lit(1), F.col("slices") - 1),
        lambda k: F.col("quantiles")[F.floor(k * QUANTILES / F.col("slices")).cast("int") - 1])
    before = F.size(F.filter("bounds", lambda b: b < F.col("price")))
    return prices.join(cuts.select("family", bounds.alias("bounds")), "family", "left").select(
        *prices.columns, F.when(F.col("bounds").isNull(), 0).otherwise(before).alias("slice"), F.col("bounds").isNotNull().alias("is_cut"))


def _outer_points(placed: DataFrame) -> DataFrame:
    """Per family that is cut, ``edges``: of each slice the two lowest and the two highest points, at most ``QUANTILES`` slices."""
    filled = placed.where(F.col("is_cut") & F.col("ids").isNotNull()).select("family", "slice", F.struct("price", "ids").alias("p"))

    def ends(order, name):
        rank = F.row_number().over(Window.partitionBy("family", "slice").orderBy(order))
        two = filled.withColumn("_rank", rank).where("_rank <= 2")
        return two.groupBy("family", "slice").agg(F.sort_array(F.collect_list("p")).alias(name))

    both = ends(F.asc("p.price"), "low").join(ends(F.desc("p.price"), "high"), ["family", "slice"])
    return both.groupBy("family").agg(F.sort_array(F.collect_list(F.struct("slice", "low", "high"))).alias("edges"))


def neighbours(placed: DataFrame) -> DataFrame:
    """``family, price, near`` of asked prices: the two points at or below and the two above.

    ``placed``: rows of ``price_list`` with their slice.
    """
    point = F.when(F.col("ids").isNotNull(), F.struct("price", "ids"))
    local = Window.partitionBy("family", "slice")
    up, down = local.orderBy("price"), local.orderBy(F.desc("price"))
    earlier, here = (Window.unboundedPreceding, -1), (Window.unboundedPreceding, Window.currentRow)

    def last(value, window):
        return F.last(value, ignorenulls=True).over(window)

    def with_next(window):  # a point and the point met before it
        return F.when(F.col("point").isNotNull(), F.array("point", last("point", window.rowsBetween(*earlier))))

    marked = (
        placed.repartition("family", "slice").withColumn("point", point)
        .withColumns({"low_pair": with_next(up), "high_pair": with_next(down)})
        .withColumn("below", last("low_pair", up.rowsBetween(*here)))
        .withColumn("above", last("high_pair", down.rowsBetween(*earlier)))
    )
    found = marked.where("is_asked").join(_outer_points(placed), "family", "left")
    before = F.reverse(F.flatten(F.transform(F.filter("edges", lambda e: e["slice"] < F.col("slice")), lambda e: e["high"])))
    after = F.flatten(F.transform(F.filter("edges", lambda e: e["slice"] > F.col("slice")), lambda e: e["low"]))
    empty = F.array().cast(_POINTS)
    near = F.concat(*[
        F.coalesce(c.cast(_POINTS), empty)
        for c in (F.col("below"), F.col("above"), F.slice(before, 1, 2), F.slice(after, 1, 2))])
    return found.select("family", "price", F.filter(near, lambda p: p.isNotNull()).alias("near"))


def nearest(probes: DataFrame, prepared: Points, slice_rows: int | None = None) -> DataFrame:
    """Candidates per probe: ``probes`` (family, price, any other columns) x
    ``points`` -> probes' columns, ``id``, ``legacy_price``.

    A family and price asked by many probes is looked up once.
    """
    points, floor = prepared
    probes = staged(probes, "price-probes")
    asked = probes.select("family", "price").distinct()
    near = neighbours(in_slices(price_list(points, asked), slice_rows or SLICE_ROWS)).withColumnsRenamed({"family": "_family", "price": "_price"})
    same = (F.col("family") == F.col("_family")) & F.col("price").eqNullSafe(F.col("_price"))
    empty = F.array().cast(_POINTS)
    everything = F.array_distinct(F.flatten(F.transform(
        F.concat(*[F.coalesce(F.col(c).cast(_POINTS), empty) for c in ("near", "floor")]),
        lambda p: F.transform(p["ids"], lambda i: F.struct(
            p["price"].alias("legacy_price"), i.alias("id"))))))
    return (
        probes.join(near, same, "left").join(floor, "family", "left")
        .select(*[c for c in probes.columns], F.explode(everything).alias("hit")).select(*probes.columns, "hit.*")
    )
