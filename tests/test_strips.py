"""Areas that lie over each other: what they are in bands, points in them, and lines over them."""

from __future__ import annotations

from pyspark.sql import functions as F

from tractlake.operators import shapes

AREA = "array<array<array<struct<x:double,y:double>>>>"


def _box(x0, y0, x1, y1):
    return [(x0, y0), (x1, y0), (x1, y1), (x0, y1), (x0, y0)]


def _turned(x, y, r):
    return [(x - r, y), (x, y - r), (x + r, y), (x, y + r), (x - r, y)]


def _areas(spark, copies):
    holed = [[_turned(40.0, 40.0, 30.0), _turned(40.0, 40.0, 15.0)], [_turned(40.0, 40.0, 8.0)]]
    return spark.createDataFrame([(k, holed) for k in range(copies)], f"area_id long, area {AREA}")


def test_points_by_strips(spark):
    """Points inside of a stretch that no edge runs through are told without an edge, and all places are those of the diamonds' distances."""
    areas = _areas(spark, 3)
    inner = shapes.strips(areas, "area_id", "area", 16.0).where("n = 0")
    assert inner.count() > 0 and inner.where("x9 <= x0").isEmpty()
    spots = [(i * 100 + j, float(i), float(j)) for i in range(5, 76) for j in range(5, 76)]
    got = shapes.located(spark.createDataFrame(spots, "p long, x double, y double"), areas, "p", "area_id", "area", 16.0)
    got = {(r["p"], r["area_id"]): (r["inside"], r["edge"]) for r in got.collect()}
    want = {}
    for p, x, y in spots:
        far = abs(x - 40) + abs(y - 40)
        edge, inside = far in (30, 15, 8), 15 < far < 30 or far < 8
        if edge or inside:
            want |= {(p, k): (inside, edge) for k in range(3)}
    assert got == want


def test_copies_are_one_cover(spark):
    """Areas that lie over each other leave as few stretches as one of them, and lines over them the lengths of one."""
    assert sorted(shapes.united(_areas(spark, 40), "area_id", "area", 16.0).collect()) == sorted(shapes.united(_areas(spark, 1), "area_id", "area", 16.0).collect())
    lines = spark.createDataFrame([(0, [(0.0, 40.0), (80.0, 40.0)]), (1, [(0.0, 0.0), (80.0, 80.0)]), (2, [(0.0, 1.0), (5.0, 1.0)]), (3, [(40.0, 40.0), (40.0, 40.0)]), (4, [(40.0, 10.0), (60.0, 10.0)])], "line_id long, line array<struct<x:double,y:double>>")
    for copies in (1, 40):
        got = shapes.overlay(lines, _areas(spark, copies), "line_id", "line", "area_id", "area", 16.0)
        got = {r["line_id"]: (r["outside"], r["touches"]) for r in got.select("line_id", F.round("outside", 6).alias("outside"), "touches").collect()}
        assert got == {0: (34.0, True), 1: (round((80 - 23) * 2**0.5, 6), True), 2: (5.0, False), 3: (0.0, True), 4: (20.0, True)}


def test_open_rings_have_no_stretches(spark):
    rows = [(1, [[[(0.0, 0.0), (30.0, 0.0), (30.0, 30.0), (0.0, 30.0)]]]), (2, [[_box(40.0, 0.0, 70.0, 30.0)]])]
    inner = shapes.strips(spark.createDataFrame(rows, f"area_id long, area {AREA}"), "area_id", "area", 16.0).where("n = 0")
    assert {r["area_id"] for r in inner.collect()} == {2}
