"""Validity, places of points, overlay and outlines on shapes with known answers, and against plain loops."""

import itertools
import math
import random

import pytest
from pyspark.sql import functions as F

from tractlake.operators import layers, shapes, spatial

RING = "k long, s array<struct<x:double,y:double>>"
POLYGON = "k long, s array<array<struct<x:double,y:double>>>"
MULTI = "k long, s array<array<array<struct<x:double,y:double>>>>"


def box(x0, y0, x1, y1):
    return [(x0, y0), (x1, y0), (x1, y1), (x0, y1), (x0, y0)]


def plain(points):
    return [(float(x), float(y)) for x, y in points]


def reasons(spark, schema, shapes_of):
    """For each shape its reasons with their places."""
    df = spark.createDataFrame(list(enumerate(shapes_of)), schema)
    got = [{} for _ in shapes_of]
    for r in shapes.shape_faults(df, "k", "s").collect():
        got[r["k"]][r["reason"]] = (r["x"], r["y"])
    return got


CASES = [
    (box(0, 0, 4, 4), {}),
    ([(0, 0), (4, 0), (4, 0), (4, 4), (0, 4), (0, 0)], {}),
    ([(0, 0), (4, 0), (4, 4), (2, 0), (0, 4), (0, 0)], {"touches itself": (2, 0)}),
    ([(0, 0), (4, 0), (4, 4), (4, 6), (4, 4), (0, 4), (0, 0)], {"spike": (4, 4), "touches itself": (4, 4)}),
    ([(0, 0), (4, 4), (8, 0), (8, 8), (4, 4), (0, 8), (0, 0)], {"touches itself": (4, 4)}),
    ([(0, 0), (2, 2), (4, 4), (4, 0), (2, 2), (0, 4), (0, 0)], {"touches itself": (2, 2)}),
    (box(0, 0, 4, 4)[:-1] + box(0, 0, 4, 4), {"overlaps itself": (0, 0), "touches itself": (0, 0)}),
    ([(0, 0), (4, 4), (4, 0), (0, 4), (0, 0)], {"crosses itself": (2, 2)}),
    ([(0, 0), (6, 0), (6, 4), (4, 0), (2, 0), (0, 4), (0, 0)], {"overlaps itself": (2, 0), "touches itself": (2, 0)}),
    ([(0, 0), (4, 0), (4, 4), (0, 4)], {"open": (0, 0)}),
    ([(0, 0), (4, 0), (0, 0)], {"too short": (0, 0)}),
    ([], {"empty": (None, None)}),
    (None, {"null": (None, None)}),
]


def test_reasons_of_one_ring(spark):
    assert reasons(spark, RING, [s and plain(s) for s, _ in CASES]) == [want for _, want in CASES]


def test_reasons_between_rings(spark):
    shell, hole = box(0, 0, 10, 10), box(2, 2, 4, 4)
    polygons = [
        ([shell, hole, box(6, 6, 8, 8)], set()),
        ([shell, [(0, 5), (3, 2), (6, 5), (3, 8), (0, 5)]], set()),  # touches at one corner
        ([shell, [(0, 5), (5, 2), (10, 5), (5, 8), (0, 5)]], {"interior in pieces"}),
        ([shell, box(2, 2, 4, 4), box(4, 4, 6, 6), box(2, 6, 4, 8), [(2, 4), (1, 5), (2, 6), (2, 4)]], {"interior in pieces"}),
        ([shell, box(20, 2, 24, 4)], {"hole outside"}),
        ([shell, box(1, 1, 8, 8), hole], {"nested holes"}),
        ([shell, box(8, 2, 12, 4)], {"rings cross"}),
        ([shell, [(10, 5), (12, 7), (10, 9), (8, 7), (10, 5)]], {"rings cross"}),  # at corners only
        ([shell, box(0, 2, 4, 4)], {"rings overlap"}),
    ]
    for (_, want), got in zip(polygons, reasons(spark, POLYGON, [[plain(r) for r in s] for s, _ in polygons]), strict=True):
        assert got.keys() >= want and bool(got) == bool(want)
        assert got.keys() <= want | {"interior in pieces"}
    several = [
        ([[shell], [box(10, 10, 12, 12)]], set()),
        ([[shell, box(2, 2, 8, 8)], [box(3, 3, 5, 5)]], set()),  # an island in a hole
        ([[shell], [box(3, 3, 5, 5)]], {"parts overlap"}),
        ([[shell], [box(10, 2, 12, 4)]], {"rings overlap"}),
    ]
    assert [got.keys() for got in reasons(spark, MULTI, [[[plain(r) for r in p] for p in s] for s, _ in several])] == [want for _, want in several]


def test_points_in_holes_and_parts(spark):
    areas = spark.createDataFrame([(1, [[plain(box(0, 0, 10, 10)), plain(box(2, 2, 8, 8))], [plain(box(4, 4, 6, 6))]])], MULTI)
    spots = [(1, 1, 1), (2, 3, 3), (3, 5, 5), (4, 2, 5), (5, 10, 10), (6, 11, 5), (7, 4, 4)]
    points = spark.createDataFrame([(i, float(x), float(y)) for i, x, y in spots], "id long, x double, y double")
    for cell in (0.7, 3.0, 100.0):
        got = {r["id"]: (r["inside"], r["edge"]) for r in shapes.located(points, areas, "id", "k", "s", cell).collect()}
        assert got == {1: (True, False), 3: (True, False), 4: (False, True), 5: (False, True), 7: (False, True)}
    assert {r["id"] for r in spatial.containing(points, areas, "id", "k", "s", 3.0).collect()} == {1, 3}


def overlaid(spark, lines, areas, cell=3.0):
    df = spark.createDataFrame([(i, plain(p)) for i, p in enumerate(lines)], "id long, line array<struct<x:double,y:double>>")
    got = shapes.overlay(df, spark.createDataFrame([(i, [[plain(r) for r in p] for p in a]) for i, a in enumerate(areas)], MULTI), "id", "line", "k", "s", cell)
    return [(r["length"], r["outside"], r["touches"]) for r in got.orderBy("id").collect()]


def test_lines_on_borders_through_holes_and_beside(spark):
    two = [[[box(0, 0, 10, 10)]], [[box(10, 0, 20, 10)]]]
    lines = [[(10, 1), (10, 9)], [(0, 0), (20, 0)], [(-5, 5), (25, 5)], [(3, 12), (9, 12)], [(20, 10), (30, 20)], [(2, 2), (3, 3), (3, 3), (4, 2)], [(5, 5), (5, 5)], [(50, 5), (50, 5)], [], [(5, 11), (5, 9), (7, 9), (7, 12)]]
    got = overlaid(spark, lines, two)
    want = [(8, 0, True), (20, 0, True), (30, 10, True), (6, 6, False), (10 * math.sqrt(2), 10 * math.sqrt(2), True), (2 * math.sqrt(2), 0, True), (0, 0, True), (0, 0, False), (0, 0, False), (7, 3, True)]
    for a, b in zip(got, want, strict=True):
        assert a == pytest.approx(b)
    holed = [[[box(0, 0, 10, 10), box(2, 2, 8, 8)]]]
    assert overlaid(spark, [[(-2, 5), (12, 5)], [(2, 0), (2, 10)], [(3, 3), (7, 7)]], holed) == [pytest.approx(x) for x in [(14, 10, True), (10, 0, True), (4 * math.sqrt(2), 4 * math.sqrt(2), False)]]
    diamonds = [[[[(0, 4), (4, 0), (8, 4), (4, 8), (0, 4)]]]]
    assert overlaid(spark, [[(0, 0), (8, 8)], [(-2, 6), (6, -2)], [(0, 8), (3, 11)]], diamonds) == [pytest.approx(x) for x in [(8 * math.sqrt(2), 4 * math.sqrt(2), True), (8 * math.sqrt(2), 4 * math.sqrt(2), True), (3 * math.sqrt(2), 3 * math.sqrt(2), False)]]


def union_of_cells(spark, cells):
    """Rings of a union of unit squares, and the lengths that counting its unit edges gives."""
    df = spark.createDataFrame([(i, plain(box(x, y, x + w, y + h))) for i, (x, y, w, h) in enumerate(cells)], RING)
    got = shapes.dissolve(df, "k", "s", 2.0).collect()
    full = {(x + i, y + j) for x, y, w, h in cells for i in range(w) for j in range(h)}
    length = sum((x + dx, y + dy) not in full for x, y in full for dx, dy in ((1, 0), (-1, 0), (0, 1), (0, -1)))
    return got, full, length


def test_outlines_of_t_junctions_corners_holes_and_overlaps(spark):
    (r,), _, _ = union_of_cells(spark, [(0, 0, 10, 20), (10, 0, 5, 10), (10, 10, 5, 10)])
    assert (r["length"], r["area"], r["hole"]) == (70, 300, False)
    assert r["ring"][0] == r["ring"][-1] and len(r["ring"]) == r["edges"] + 1
    got, _, _ = union_of_cells(spark, [(0, 0, 2, 2), (2, 2, 2, 2)])
    assert sorted((r["length"], r["edges"]) for r in got) == [(8, 4), (8, 4)]
    got, _, _ = union_of_cells(spark, [(0, 0, 3, 1), (0, 1, 1, 1), (2, 1, 1, 1), (0, 2, 3, 1)])
    assert sorted((r["hole"], r["length"], r["area"]) for r in got) == [(False, 12, 9), (True, 4, 1)]
    got, _, _ = union_of_cells(spark, [(0, 0, 4, 4), (2, 2, 4, 4), (3, 3, 1, 1)])
    assert [(r["length"], r["area"]) for r in got] == [(24, 28)]


def test_a_hole_that_touches_the_border_is_a_ring_of_its_own(spark):
    polygon = spark.createDataFrame([(1, [plain(box(0, 0, 10, 10)), plain([(0, 5), (3, 2), (6, 5), (3, 8), (0, 5)])])], POLYGON)
    got = shapes.dissolve(polygon, "k", "s", 3.0).collect()
    assert sorted((r["hole"], r["area"]) for r in got) == [(False, 100), (True, 18)]


@pytest.mark.parametrize("seed", [1, 2])
def test_outlines_of_random_boxes_match_counting(spark, seed):
    dice = random.Random(seed)
    got, full, length = union_of_cells(spark, [(dice.randint(0, 9), dice.randint(0, 9), dice.randint(1, 4), dice.randint(1, 4)) for _ in range(14)])
    assert sum(r["length"] for r in got) == length
    assert sum(-r["area"] if r["hole"] else r["area"] for r in got) == len(full)
    near = lambda a, b: abs(a[0] - b[0]) + abs(a[1] - b[1]) == 1
    left, pieces = set(full), 0
    while left:
        pieces, todo = pieces + 1, [left.pop()]
        while todo:
            at = todo.pop()
            hit = {c for c in left if near(at, c)}
            left -= hit
            todo += hit
    assert sum(not r["hole"] for r in got) == pieces


@pytest.mark.parametrize("seed", [3, 4])
def test_overlay_of_random_shapes_matches_sampling(spark, seed):
    dice = random.Random(seed)
    star = lambda cx, cy: [(cx + (4 + 2 * (i % 2)) * math.cos(i * math.pi / 5), cy + (4 + 2 * (i % 2)) * math.sin(i * math.pi / 5)) for i in range(10)]
    rings = [star(dice.uniform(0, 20), dice.uniform(0, 20)) for _ in range(4)]
    rings = [r + r[:1] for r in rings]
    lines = [[(dice.uniform(-3, 23), dice.uniform(-3, 23)) for _ in range(3)] for _ in range(6)]
    inside = lambda x, y, r: sum(((b[1] > y) != (d[1] > y)) and x < (d[0] - b[0]) * (y - b[1]) / (d[1] - b[1]) + b[0] for b, d in itertools.pairwise(r)) % 2
    for (length, outside, _), line in zip(overlaid(spark, lines, [[[r]] for r in rings]), lines, strict=True):
        out = 0
        for (ax, ay), (bx, by) in itertools.pairwise(line):
            spots = [(ax + (bx - ax) * (i + 0.5) / 2000, ay + (by - ay) * (i + 0.5) / 2000) for i in range(2000)]
            out += math.hypot(bx - ax, by - ay) * sum(not any(inside(x, y, r) for r in rings) for x, y in spots) / 2000
        assert outside == pytest.approx(out, abs=0.05) and length >= outside


def test_geometry_faults_tell_null_type_and_reference_system(spark):
    areas = spark.createDataFrame([(1, [[plain(box(0, 0, 4, 4))]]), (2, [[plain(box(0, 0, 1, 1))], [plain(box(2, 2, 3, 3))]]), (3, None), (4, []), (5, [[plain(box(0, 0, 9, 9))]])], MULTI)
    got = {tuple(r) for r in layers.geometry_faults(areas, "k", "s", (0, 0, 5, 5), "EPSG:1", "EPSG:2", kinds=("Polygon",)).collect()}
    assert got == {("validity", "null", 1), ("validity", "empty", 1), ("type", "MultiPolygon", 1), ("extent", "outside the box", 1), ("crs", "EPSG:1", 1)}


def test_nothing_at_all(spark):
    none = spark.createDataFrame([], MULTI)
    assert shapes.shape_faults(none, "k", "s").count() == 0
    assert shapes.dissolve(none, "k", "s", 1.0).count() == 0
    assert overlaid(spark, [[(0, 0), (3, 4)]], []) == [(5, 5, False)]
    points = spark.createDataFrame([(1, 1.0, 1.0)], "id long, x double, y double")
    assert shapes.located(points, none, "id", "k", "s", 1.0).where(F.col("inside")).count() == 0
