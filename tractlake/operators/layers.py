"""Invariants of geometry, spine, point and road layers: each gives (check, detail, count) of what is wrong."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tractlake.functions import expr as X
from tractlake.operators import shapes, spatial
from tractlake.operators.joins import repeated


def faults(df: DataFrame, checks: dict[tuple[str, str], Column]) -> DataFrame:
    """(check, detail, count) of the rows that each condition holds for, in one aggregate."""
    names = list(checks)
    one = df.agg(*[F.count_if(bad).alias(f"n{k}") for k, bad in enumerate(checks.values())])
    rows = F.array(*[F.struct(F.lit(c).alias("check"), F.lit(d).alias("detail"), F.col(f"n{k}").alias("count")) for k, (c, d) in enumerate(names)])
    return one.select(F.inline(rows)).where("count > 0")


def count_fault(df: DataFrame, least: int, most: int) -> DataFrame:
    n = df.agg(F.count("*").alias("count"))
    return n.where(~F.col("count").between(least, most)).select(F.lit("rows").alias("check"), F.lit("row count").alias("detail"), "count")


def fixed_faults(df: DataFrame, wrong: list[tuple[str, str]]) -> list[DataFrame]:
    return [df.sparkSession.createDataFrame([(c, d, 1) for c, d in wrong], "check string, detail string, count bigint")] if wrong else []


def union(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def key_fault(df: DataFrame, key: str) -> DataFrame:
    return repeated(df, [key]).agg(F.count("*").alias("count")).where("count > 0").select(F.lit("key").alias("check"), F.lit(key).alias("detail"), "count")


def ring_faults(polygons: DataFrame, key: str, ring: str) -> DataFrame:
    """key and reason of each invalid shape, once for each reason; a missing one counts as empty."""
    return shapes.shape_faults(polygons, key, ring).select(key, F.when(F.col("reason") == "null", "empty").otherwise(F.col("reason")).alias("reason")).distinct()


def kind_of(shape: Column, depth: int) -> Column:
    """Point, LineString, Polygon or MultiPolygon by how deep the points lie; MultiPolygon only with several parts."""
    if depth < 3:
        return F.when(shape.isNotNull(), ("LineString", "Polygon")[depth - 1])
    return F.when(F.size(shape) > 1, "MultiPolygon").when(F.size(shape) == 1, "Polygon")


def geometry_faults(areas: DataFrame, key: str, shape: str, box: tuple[float, float, float, float], crs: str, wanted_crs: str, kinds: tuple[str, ...] = ()) -> DataFrame:
    """Wrong reference system, kinds of shape that aren't wanted, null and empty and invalid shapes by reason, and shapes that leave the box."""
    by_reason = shapes.shape_faults(areas, key, shape).groupBy("reason").agg(F.count("*").alias("count")).select(F.lit("validity").alias("check"), F.col("reason").alias("detail"), "count")
    b = spatial.bounds(areas.where(F.size(shape) > 0), key, shape)
    outside = faults(b, {("extent", "outside the box"): (F.col("x0") < box[0]) | (F.col("y0") < box[1]) | (F.col("x1") > box[2]) | (F.col("y1") > box[3])})
    parts = [by_reason, outside, *fixed_faults(areas, [("crs", crs)] if crs != wanted_crs else [])]
    if kinds:
        kind = kind_of(F.col(shape), shapes.nesting(areas, shape))
        parts.append(areas.select(kind.alias("detail")).where(~F.col("detail").isin(*kinds)).groupBy("detail").agg(F.count("*").alias("count")).select(F.lit("type").alias("check"), "detail", "count"))
    return union(parts)


def label_faults(manifests: DataFrame, wanted: DataFrame, key: str, labels: list[str]) -> DataFrame:
    """key, label, found and wanted of each label of manifests that isn't what wanted asks for; missing manifests have nulls."""
    a = wanted.select(key, *[F.col(c).alias(f"{c}__wanted") for c in labels]).join(manifests.select(key, *labels), key, "left")
    each = F.array(*[F.struct(F.lit(c).alias("label"), F.col(c).cast("string").alias("found"), F.col(f"{c}__wanted").cast("string").alias("wanted")) for c in labels])
    return a.select(key, F.explode(each).alias("s")).select(key, "s.*").where(~F.col("found").eqNullSafe(F.col("wanted")))


def spine_faults(areas: DataFrame, centers: DataFrame, key: str, shape: str, pattern: str, count: tuple[int, int], box: tuple[float, float, float, float], cell: float, crs: str = "", wanted_crs: str = "") -> DataFrame:
    """Of areas(key, shape): key form, repeats, count, reference system, validity and bounds; of centers(key, x, y): those that are missing, too many, or
    neither inside nor on the border of their own area."""
    own = faults(areas, {("key form", key): ~F.coalesce(F.col(key).cast("string").rlike(f"^(?:{pattern})$"), F.lit(False))})
    shapes_wrong = geometry_faults(areas, key, shape, box, crs, wanted_crs)
    shapes_wrong = shapes_wrong.withColumn("check", F.when(F.col("check") == "extent", "bounds").otherwise(F.col("check")))
    met = areas.select(key).join(centers.groupBy(key).agg(F.count("*").alias("n"), F.min(F.struct("x", "y")).alias("p")), key, "left")
    one = met.where("n = 1").select(F.col(key).alias("of"), "p.x", "p.y")
    home = shapes.located(one, areas, "of", key, shape, cell).where(F.col("of") == F.col(key)).select(key, F.lit(True).alias("home"))
    about = faults(met.join(home, key, "left"), {("centre", "missing"): F.col("n").isNull(), ("centre", "several"): F.col("n") > 1, ("centre", "outside of its area"): (F.col("n") == 1) & F.col("home").isNull()})
    return union([own, shapes_wrong, count_fault(areas, *count), key_fault(areas, key), about])


def point_faults(points: DataFrame, areas: DataFrame, key: str, source: str, area: str, mapping: dict[str, tuple[str, bool]], kind: str, group: str, flag: str, box: tuple[float, float, float, float]) -> DataFrame:
    """Of points: id form source:id, group and flag as the mapping of their kind says, an area that exists, coordinates inside the box, single keys."""
    wanted = F.lit(None).cast("struct<g:string,f:boolean>")
    for name, (g, f) in mapping.items():
        wanted = F.when(F.col(kind) == name, F.struct(F.lit(g).alias("g"), F.lit(f).alias("f"))).otherwise(wanted)
    own = faults(
        points,
        {
            ("id form", key): ~F.coalesce(F.col(key).rlike(rf"^{source}:\S+$"), F.lit(False)),
            ("mapping", "unknown kind"): wanted.isNull(),
            ("mapping", group): wanted.isNotNull() & ~F.col(group).eqNullSafe(wanted["g"]),
            ("mapping", flag): wanted.isNotNull() & ~F.col(flag).eqNullSafe(wanted["f"]),
            ("bounds", "outside the box"): ~X.in_box("x", "y", box),
        },
    )
    strays = points.where(F.col(area).isNotNull()).join(areas.select(area), area, "left_anti").agg(F.count("*").alias("count")).where("count > 0").select(F.lit("area").alias("check"), F.lit("unknown area").alias("detail"), "count")
    return union([own, key_fault(points, key), strays])


def road_faults(roads: DataFrame, key: str, line: str, classes: tuple[str, ...], types: tuple[str, ...], box: tuple[float, float, float, float], spine: DataFrame, area: str, shape: str, cell: float) -> DataFrame:
    """Of roads(key, class, type, line): unknown class or type, lines of no length, points outside the box, single keys, and lines that neither enter nor touch an area of the spine."""
    away = F.exists(F.flatten(F.col(line)) if shapes.nesting(roads, line) == 2 else F.col(line), lambda p: ~F.coalesce(p["x"].between(box[0], box[2]) & p["y"].between(box[1], box[3]), F.lit(False)))
    measured = roads.select(key, "class", "type", F.coalesce(away, F.lit(True)).alias("away")).join(shapes.overlay(roads, spine, key, line, area, shape, cell).select(key, "length", "touches"), key)
    own = faults(measured, {("class", "unknown"): ~F.coalesce(F.col("class").isin(*classes), F.lit(False)), ("type", "unknown"): ~F.coalesce(F.col("type").isin(*types), F.lit(False)), ("line", "no length"): F.col("length") == 0, ("bounds", "outside the box"): F.col("away"), ("spine", "touches no area"): ~F.col("touches")})
    return union([own, key_fault(roads, key)])


def plan_faults(points: DataFrame, key: str, counts: dict[str, int]) -> DataFrame:
    """Of the points(role, key, x, y) of a routing plan: keys that a role has twice or null, missing coordinates, roles that aren't planned, and counts that aren't exact."""
    own = faults(points, {("coordinates", "missing"): F.col("x").isNull() | F.col("y").isNull(), ("key", "null"): F.col(key).isNull(), ("role", "unplanned"): ~F.coalesce(F.col("role").isin(*counts), F.lit(False))})
    twice = repeated(points.where(F.col(key).isNotNull()), ["role", key]).agg(F.count("*").alias("count")).where("count > 0").select(F.lit("key").alias("check"), F.lit("repeated").alias("detail"), "count")
    seen = points.agg(*[F.count_if(F.col("role") == r).alias(f"n{k}") for k, r in enumerate(counts)])
    rows = F.inline(F.array(*[F.struct(F.lit("count").alias("check"), F.lit(r).alias("detail"), F.col(f"n{k}").alias("count"), F.lit(n).alias("wanted")) for k, (r, n) in enumerate(counts.items())]))
    return union([own, twice, seen.select(rows).where("count <> wanted").select("check", "detail", "count")])
