"""Queries of geometry expressions and spatial joins."""

from __future__ import annotations

from pyspark.sql import functions as F

from tractlake.functions import expr as X
from tractlake.functions import geometry as G
from tractlake.operators import spatial, tree
from tractlake.operators.joins import crossed_in_blocks
from tractlake.plans.base import Book
from tractlake.plans.standins import cells, from_origins, origins, sites, with_sql

BOOK = Book()
query = BOOK.add
CELL = 1400.0


def _polygons(spark, d):
    return cells(spark, d).select("cell_id", G.box_ring(F.col("x0"), F.col("y0"), F.col("x1"), F.col("y1"), clockwise=True).alias("ring"))


def _degrees(spark, d):
    return origins(spark, d).select("origin_id", (F.lit(-75.28) + F.col("x") * 0.32 / 27000).alias("lon"), (F.lit(39.87) + F.col("y") * 0.26 / 28000).alias("lat"))


@query("g1_to_metres")
def _(spark, d):
    x, y = G.to_metres(F.col("lon"), F.col("lat"))
    return _degrees(spark, d).select("origin_id", F.round(x, 3).alias("east"), F.round(y, 3).alias("north"))


@query("g2_to_degrees", with_sql("origins") + " SELECT origin_id, round(-75.28 + x * 0.32 / 27000, 6) AS lon, round(39.87 + y * 0.26 / 28000, 6) AS lat FROM origins")
def _(spark, d):
    x, y = G.to_metres(F.col("lon"), F.col("lat"))
    planar = _degrees(spark, d).select("origin_id", x.alias("e"), y.alias("n"))
    lon, lat = G.to_degrees(F.col("e"), F.col("n"))
    return planar.select("origin_id", F.round(lon, 6).alias("lon"), F.round(lat, 6).alias("lat"))


@query("g3_buffered_bounds")
def _(spark, d):
    deg = lambda x, y: (F.lit(-75.28) + x * 0.32 / 27000, F.lit(39.87) + y * 0.26 / 28000)
    box = cells(spark, d)
    corners = F.explode(F.array(*[F.struct(F.col(a).alias("x"), F.col(b).alias("y")) for a in ("x0", "x1") for b in ("y0", "y1")])).alias("p")
    lon, lat = deg(F.col("p.x"), F.col("p.y"))
    e, n = G.to_metres(lon, lat)
    grown = box.select("cell_id", corners).select("cell_id", e.alias("e"), n.alias("n")).groupBy("cell_id").agg((F.min("e") - 1000).alias("a"), (F.min("n") - 1000).alias("b"), (F.max("e") + 1000).alias("c"), (F.max("n") + 1000).alias("d"))
    back = F.explode(F.array(*[F.struct(F.col(a).alias("x"), F.col(b).alias("y")) for a in ("a", "c") for b in ("b", "d")])).alias("p")
    lon, lat = G.to_degrees(F.col("p.x"), F.col("p.y"))
    out = grown.select("cell_id", back).select("cell_id", lon.alias("lon"), lat.alias("lat")).groupBy("cell_id")
    return out.agg(*[F.round(f(c), 6).alias(n) for n, f, c in (("west", F.min, "lon"), ("south", F.min, "lat"), ("east", F.max, "lon"), ("north", F.max, "lat"))])


@query("g4_projected_bounds")
def _(spark, d):
    steps = F.sequence(F.lit(0), F.lit(20))
    side = lambda x, y: F.transform(steps, lambda k: F.struct(x(k / 20.0).alias("x"), y(k / 20.0).alias("y")))
    fx, fy = lambda t: F.col("x0") + (F.col("x1") - F.col("x0")) * t, lambda t: F.col("y0") + (F.col("y1") - F.col("y0")) * t
    points = F.explode(F.concat(side(fx, lambda t: F.col("y0") + t * 0), side(fx, lambda t: F.col("y1") + t * 0), side(lambda t: F.col("x0") + t * 0, fy), side(lambda t: F.col("x1") + t * 0, fy))).alias("p")
    e, n = G.to_metres(F.lit(-75.28) + F.col("p.x") * 0.32 / 27000, F.lit(39.87) + F.col("p.y") * 0.26 / 28000)
    rows = cells(spark, d).select("cell_id", points).select("cell_id", e.alias("e"), n.alias("n")).groupBy("cell_id")
    return rows.agg(*[F.round(f(c), 3).alias(k) for k, f, c in (("west", F.min, "e"), ("south", F.min, "n"), ("east", F.max, "e"), ("north", F.max, "n"))])


_INSIDE = "SELECT origin_id, cell_id FROM origins JOIN cells ON x > x0 AND x < x1 AND y > y0 AND y < y1"


@query("g5_within", with_sql("origins", "cells") + " " + _INSIDE)
def _(spark, d):
    return spatial.containing(origins(spark, d), _polygons(spark, d), "origin_id", "cell_id", "ring", CELL)


@query("g6_distance", with_sql("origins", "sites") + " SELECT origin_id, site_id, round(sqrt((o.x - s.x) * (o.x - s.x) + (o.y - s.y) * (o.y - s.y)), 3) AS metres FROM origins o CROSS JOIN sites s")
def _(spark, d):
    dx, dy = F.col("ox") - F.col("x"), F.col("oy") - F.col("y")
    pairs = crossed_in_blocks(from_origins(spark, d), sites(spark, d).select("site_id", "x", "y"), "origin_id")
    return pairs.select("origin_id", "site_id", X.rounded(F.sqrt(dx * dx + dy * dy), 3).alias("metres"))


@query("g7_validity", "SELECT n_nationkey AS cell_id, n_nationkey % 4 <> 0 AS closed, CAST(n_nationkey % 3 = 0 AS BIGINT) AS crossings FROM nation")
def _(spark, d):
    p = cells(spark, d)
    at = lambda x, y: F.struct(F.col(x).cast("double").alias("x"), F.col(y).cast("double").alias("y"))
    bow = F.array(at("x0", "y0"), at("x1", "y1"), at("x1", "y0"), at("x0", "y1"), at("x0", "y0"))
    ring = F.when(F.col("cell_id") % 3 == 0, bow).otherwise(G.box_ring(F.col("x0"), F.col("y0"), F.col("x1"), F.col("y1")))
    rings = p.select("cell_id", ring.alias("ring"))
    given = rings.select("cell_id", F.when(F.col("cell_id") % 4 == 0, F.slice("ring", 1, 4)).otherwise(F.col("ring")).alias("ring"))
    closed = given.select("cell_id", (F.get("ring", F.lit(0)) == F.get("ring", F.size("ring") - 1)).alias("closed"))
    return closed.join(spatial.self_crossings(rings, "cell_id", "ring"), "cell_id")


@query("g8_bounds", with_sql("cells") + " SELECT cell_id, CAST(x0 AS DOUBLE) AS x0, CAST(y0 AS DOUBLE) AS y0, CAST(x1 AS DOUBLE) AS x1, CAST(y1 AS DOUBLE) AS y1 FROM cells")
def _(spark, d):
    return spatial.bounds(_polygons(spark, d), "cell_id", "ring")


@query("g9_orientation", with_sql("cells") + " SELECT cell_id, CAST(5400 * 5600 AS DOUBLE) AS area FROM cells")
def _(spark, d):
    return _polygons(spark, d).select("cell_id", G.signed_area(G.counter_clockwise(F.col("ring"))).alias("area"))


@query("g10_line_length", with_sql("origins") + " SELECT origin_id, round(sqrt(9.0 * x * x + 16.0 * x * x) + y, 3) AS metres FROM origins")
def _(spark, d):
    at = lambda x, y: F.struct(x.cast("double").alias("x"), y.cast("double").alias("y"))
    x, y = F.col("x"), F.col("y")
    line = F.array(at(F.lit(0), F.lit(0)), at(3 * x, 4 * x), at(3 * x, 4 * x + y))
    return origins(spark, d).select("origin_id", F.round(G.line_length(line), 3).alias("metres"))


@query("g11_dissolve", "SELECT CAST(20 AS BIGINT) AS outer_edges, CAST(2 * (5 * 5400 + 5 * 5600) AS DOUBLE) AS metres")
def _(spark, d):
    e = spatial.outer_edges(_polygons(spark, d), "cell_id", "ring", CELL)
    return e.agg(F.count("*").alias("outer_edges"), F.sum(F.hypot(F.col("x2") - F.col("x1"), F.col("y2") - F.col("y1"))).alias("metres"))


@query("g12_round_coordinates", with_sql("cells") + " SELECT cell_id, round(x0 / 7.0, 2) AS first_x, round(y1 / 7.0, 2) AS last_y FROM cells")
def _(spark, d):
    seventh = F.transform("ring", lambda p: F.struct((p["x"] / 7).alias("x"), (p["y"] / 7).alias("y")))
    ring = G.rounded_ring(seventh, 2)
    return _polygons(spark, d).select("cell_id", F.array_min(F.transform(ring, lambda p: p["x"])).alias("first_x"), F.array_max(F.transform(ring, lambda p: p["y"])).alias("last_y"))


@query("c5_area_join", with_sql("origins", "cells") + f", i AS ({_INSIDE}) SELECT o.origin_id, min(i.cell_id) AS cell_id FROM origins o LEFT JOIN i ON o.origin_id = i.origin_id GROUP BY 1")
def _(spark, d):
    return spatial.assign_area(origins(spark, d), _polygons(spark, d), "origin_id", "cell_id", "ring", CELL).select("origin_id", "cell_id")


@query("c6_strict_area_join", with_sql("origins", "cells") + f", i AS ({_INSIDE}) SELECT CASE WHEN i.n IS NULL THEN 'unmatched' WHEN i.n > 1 THEN 'multiple' ELSE 'single' END AS status, count(*) AS points FROM origins o LEFT JOIN (SELECT origin_id, count(*) AS n FROM i GROUP BY 1) i ON o.origin_id = i.origin_id GROUP BY 1")
def _(spark, d):
    n = spatial.containing(origins(spark, d), _polygons(spark, d), "origin_id", "cell_id", "ring", CELL).groupBy("origin_id").agg(F.count("*").alias("n"))
    status = F.when(F.col("n").isNull(), "unmatched").when(F.col("n") > 1, "multiple").otherwise("single")
    return origins(spark, d).select("origin_id").join(n, "origin_id", "left").groupBy(status.alias("status")).agg(F.count("*").alias("points"))


_NEAR = "SELECT o.origin_id, s.site_id, sqrt((o.x - s.x) * (o.x - s.x) + (o.y - s.y) * (o.y - s.y)) AS m, row_number() OVER (PARTITION BY o.origin_id ORDER BY (o.x - s.x) * (o.x - s.x) + (o.y - s.y) * (o.y - s.y), s.site_id) AS r FROM origins o CROSS JOIN sites s"


@query("c7_nearest", with_sql("origins", "sites") + f" SELECT origin_id, round(m, 1) AS metres FROM ({_NEAR} WHERE s.flagged) WHERE r = 1")
def _(spark, d):
    flagged = sites(spark, d).where("flagged")
    return spatial.nearest(origins(spark, d), flagged, "origin_id", "site_id").select("origin_id", F.round("distance", 1).alias("metres"))


@query("c21_snap_to_node", with_sql("origins", "sites") + f" SELECT origin_id, site_id AS node_id, round(m, 3) AS metres FROM ({_NEAR}) WHERE r = 1")
def _(spark, d):
    return spatial.nearest(origins(spark, d), sites(spark, d), "origin_id", "site_id").select("origin_id", F.col("site_id").alias("node_id"), F.round("distance", 3).alias("metres"))


@query("c14_within_reach", with_sql("origins", "sites") + " SELECT count(*) AS reached, round(count(*) / ((SELECT count(*) FROM origins) * (SELECT count(*) FROM sites)), 6) AS share FROM origins o JOIN sites s ON (o.x - s.x) * (o.x - s.x) + (o.y - s.y) * (o.y - s.y) <= 9600 * 9600")
def _(spark, d):
    o, s = origins(spark, d), sites(spark, d)
    all_pairs = o.agg(F.count("*").alias("n")).join(s.agg(F.count("*").alias("m")))  # one row each
    return tree.counts_within(o, s, "origin_id", 9600.0).agg(F.sum("n").alias("reached")).join(all_pairs).select("reached", F.round(F.col("reached") / (F.col("n") * F.col("m")), 6).alias("share"))


@query("c22_pair_selection", with_sql("origins", "sites") + f" SELECT origin_id, site_id FROM ({_NEAR}) WHERE r = 1 AND origin_id % 10 = 0")
def _(spark, d):
    picked = origins(spark, d).where(F.col("origin_id") % 10 == 0)
    return spatial.nearest(picked, sites(spark, d), "origin_id", "site_id").select("origin_id", "site_id")


@query("m1_nearest_access", with_sql("origins", "sites") + f", n AS (SELECT origin_id, round(m, 1) AS estimate FROM ({_NEAR} WHERE s.flagged) WHERE r = 1), q AS (SELECT quantile_cont(estimate, [0.0, 0.2, 0.4, 0.6, 0.8, 1.0]) AS e FROM n) SELECT origin_id AS geoid, 'qa_nearest_m' AS metric_id, estimate, CAST(greatest(1, least(5, len(list_filter(list_transform(e, lambda x: round(x, 6)), lambda x: x < estimate)))) AS INTEGER) AS class FROM n, q")
def nearest_access(spark, d):
    flagged = sites(spark, d).where("flagged")
    near = spatial.nearest(origins(spark, d), flagged, "origin_id", "site_id").select(F.col("origin_id").alias("geoid"), F.round("distance", 1).alias("estimate"))
    edges = spatial.quantiles(near, "estimate", [0.0, 0.2, 0.4, 0.6, 0.8, 1.0]).select(F.array_distinct(F.transform("q", lambda x: F.round(x, 6))).alias("edges"))
    return near.join(F.broadcast(edges)).select("geoid", F.lit("qa_nearest_m").alias("metric_id"), "estimate", X.class_of("estimate", F.col("edges")).alias("class"))  # edges is one row


@query("m10_layer_crosscheck", with_sql("origins", "sites") + ", a AS (SELECT site_id, x, y FROM sites WHERE site_id % 2 = 0), b AS (SELECT site_id, x, y FROM sites WHERE site_id % 2 = 1), m AS (SELECT DISTINCT a.site_id FROM a JOIN b ON (a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y) <= 1500 * 1500) SELECT (SELECT count(*) FROM a) AS layer, (SELECT count(*) FROM m) AS agreed")
def _(spark, d):
    s = sites(spark, d)
    a, b = s.where(F.col("site_id") % 2 == 0), s.where(F.col("site_id") % 2 == 1).withColumnRenamed("site_id", "other_id")
    met = spatial.within(a, b, "site_id", "other_id", 1500.0).select("site_id").distinct()
    return a.join(met.withColumn("met", F.lit(True)), "site_id", "left").agg(F.count("*").alias("layer"), F.count("met").alias("agreed"))
