"""Spatial joins by grid cells: every candidate pair comes from an equi-join on a cell, never from a cross join."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tractlake.operators import shapes, tree
from tractlake.operators.keeping import cut


def edges(polygons: DataFrame, key: str, ring: str) -> DataFrame:
    """key, seq, x1, y1, x2, y2 of every edge of a closed ring."""
    return shapes.shape_edges(polygons, key, ring).select(key, "seq", *shapes.ENDS)


def bounds(polygons: DataFrame, key: str, ring: str) -> DataFrame:
    """key, x0, y0, x1, y1 of each shape."""
    points = F.flatten(F.flatten(shapes.as_parts(polygons, ring)))
    x, y = F.transform(points, lambda p: p["x"]), F.transform(points, lambda p: p["y"])
    return polygons.select(key, F.array_min(x).alias("x0"), F.array_min(y).alias("y0"), F.array_max(x).alias("x1"), F.array_max(y).alias("y1"))


def containing(points: DataFrame, polygons: DataFrame, point_key: str, key: str, ring: str, cell: float) -> DataFrame:
    """(point_key, key) for each area of any shape that a point lies inside of; points on a border or in a hole are inside of nothing."""
    return shapes.located(points, polygons, point_key, key, ring, cell).where("inside").select(point_key, key)


def assign_area(points: DataFrame, polygons: DataFrame, point_key: str, key: str, ring: str, cell: float) -> DataFrame:
    """points with key: the smallest polygon that holds the point, or null."""
    found = containing(points, polygons, point_key, key, ring, cell).groupBy(point_key).agg(F.min(key).alias(key))
    return points.join(found, point_key, "left")


def nearest(points: DataFrame, targets: DataFrame, point_key: str, target_key: str, most: float = tree.LEAF) -> DataFrame:
    """point_key, target_key and distance of the nearest target, ties to the smaller key; exact, whatever the points' and targets' density; most: targets of a leaf."""
    return tree.nearest(points, targets, point_key, target_key, most)


def within(points: DataFrame, targets: DataFrame, point_key: str, target_key: str, radius: float) -> DataFrame:
    """(point_key, target_key, distance) of all pairs at most radius apart; cells are as wide as the radius."""
    at = lambda c: F.floor(F.col(c) / radius).cast("bigint")
    around = F.explode(F.sequence(F.lit(-1).cast("bigint"), F.lit(1).cast("bigint")))
    spread = points.select(point_key, F.col("x").alias("px"), F.col("y").alias("py"), at("x").alias("ax"), at("y").alias("ay")).withColumn("dx", around).withColumn("dy", around)
    spread = spread.select(point_key, "px", "py", (F.col("ax") + F.col("dx")).alias("cx"), (F.col("ay") + F.col("dy")).alias("cy"))
    met = spread.join(targets.select(target_key, "x", "y", at("x").alias("cx"), at("y").alias("cy")), ["cx", "cy"])
    return met.withColumn("distance", F.hypot(F.col("px") - F.col("x"), F.col("py") - F.col("y"))).where(F.col("distance") <= radius).select(point_key, target_key, "distance")


def self_crossings(polygons: DataFrame, key: str, ring: str) -> DataFrame:
    """key and number of proper crossings of a shape's own edges."""
    edge = shapes.own_cells(shapes.shape_edges(polygons, key, ring), key)
    found = shapes.meetings(edge, [key], shapes.ID, F.col("cell")).where("kind = 'cross'").groupBy(key).agg(F.count("*").alias("n"))
    return polygons.select(key).distinct().join(found, key, "left").select(key, F.coalesce("n", F.lit(0)).alias("crossings"))


def outer_edges(polygons: DataFrame, key: str, ring: str, cell: float) -> DataFrame:
    """The pieces of the outline of a union of areas."""
    return shapes.outline(polygons, key, ring, cell)


def _value_counts(df: DataFrame, value: str, weight: str | None = None) -> DataFrame:
    """The distinct values of a column with their counts, and how many rows lie before each: ranges of values, and running counts inside."""
    sizes = df.where(F.col(value).isNotNull()).groupBy(F.col(value).alias("v")).agg((F.sum(weight) if weight else F.count("*")).alias("n"))
    ranged = cut(sizes.repartitionByRange(F.col("v")).withColumn("part", F.spark_partition_id()))
    totals = ranged.groupBy("part").agg(F.sum("n").alias("t"))
    before = totals.select("part", F.coalesce(F.sum("t").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("base"))  # a row for each task
    inside = F.coalesce(F.sum("n").over(Window.partitionBy("part").orderBy("v").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return ranged.withColumn("in", inside).join(before, "part").select("v", "n", (F.col("base") + F.col("in")).alias("before"))


def quantiles(df: DataFrame, value: str, shares: list[float], rest: tuple[int, float] | None = None, weight: str | None = None) -> DataFrame:
    """One row: q, the values at these shares of the sorted non-null values, between two of them by straight line; nulls without a value.

    rest: how many values there are in all, and the value, no smaller than those of df, that the ones not listed have. weight: how often each row counts.
    """
    counts = cut(_value_counts(df, value, weight))
    total = rest[0] if rest else counts.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    there = lambda k: F.max(F.when((F.col("before") <= k) & (F.col("before") + F.col("n") > k), F.col("v").cast("double")))
    at = lambda k: F.coalesce(there(k), F.lit(rest[1] if rest and total else None).cast("double"))
    out = []
    for share in shares:
        place = share * (total - 1) if total else 0.0
        low = int(place)
        out.append(at(low) + (at(min(low + 1, max(total - 1, 0))) - at(low)) * (place - low))
    return counts.agg(F.array(*out).alias("q"))


def quantiles_by(df: DataFrame, by: str, value: str, shares: list[float], weight: str | None = None) -> DataFrame:
    """by, q, low and high: quantiles of each group, as quantiles gives them, its least and its largest value; a group's values may lie in many tasks."""
    sizes = df.where(F.col(value).isNotNull()).groupBy(F.col(by).alias("g"), F.col(value).alias("v")).agg((F.sum(weight) if weight else F.count("*")).alias("n"))
    ranged = cut(sizes.repartitionByRange(F.col("g"), F.col("v")).withColumn("part", F.spark_partition_id()))
    totals = ranged.groupBy("g", "part").agg(F.sum("n").alias("t"))  # a row for each group and task
    before = totals.withColumn("base", F.coalesce(F.sum("t").over(Window.partitionBy("g").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    before = before.withColumn("total", F.sum("t").over(Window.partitionBy("g"))).drop("t")
    inside = F.coalesce(F.sum("n").over(Window.partitionBy("g", "part").orderBy("v").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    rows = ranged.withColumn("in", inside).join(before, ["g", "part"]).withColumn("at", F.col("base") + F.col("in"))
    value_at = lambda k: F.max(F.when((F.col("at") <= k) & (F.col("at") + F.col("n") > k), F.col("v").cast("double")))
    out = []
    for share in shares:
        place = (F.col("total") - 1) * share
        low = F.floor(place)
        out.append(value_at(low) + (value_at(F.least(low + 1, F.col("total") - 1)) - value_at(low)) * F.max(place - low))
    return rows.groupBy(F.col("g").alias(by)).agg(F.array(*out).alias("q"), F.min("v").alias("low"), F.max("v").alias("high"))


def average_rank(df: DataFrame, value: str, name: str) -> DataFrame:
    """Adds the average rank of a column: counts by value, running sums over the distinct values in ranges, and a join back."""
    ranks = _value_counts(df, value).select(F.col("v").alias(value), (F.col("before") + (F.col("n") + 1) / 2).alias(name))
    return df.join(ranks, value, "left")


def outside_lengths(lines: DataFrame, polygons: DataFrame, line_key: str, key: str, ring: str, cell: float) -> DataFrame:
    """line_key, length, length outside of all polygons and touches, of straight lines(line_key, x1, y1, x2, y2)."""
    point = lambda k: F.struct(F.col(f"x{k}").cast("double").alias("x"), F.col(f"y{k}").cast("double").alias("y"))
    return shapes.overlay(lines.select(line_key, F.array(point(1), point(2)).alias("line")), polygons, line_key, "line", key, ring, cell)


def outer_rings(polygons: DataFrame, key: str, ring: str, cell: float) -> DataFrame:
    """ring_id, hole, edges, length, area and ring of each closed outline of a union of areas."""
    return shapes.dissolve(polygons, key, ring, cell)
