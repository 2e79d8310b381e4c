"""Operators on small literal inputs with known answers."""

import math
import re

import pytest
from pyspark.sql import functions as F

from tractlake.functions import expr as X
from tractlake.functions import geometry as G
from tractlake.operators import contracts, network, spatial
from tractlake.operators.contracts import Contract, Field


def test_reliability_tiers(spark):
    rows = [(3200.0, 210.0, 1), (4100.0, 900.0, 2), (2750.0, 2100.0, 3), (0.0, 5.0, None), (None, 5.0, None)]
    df = spark.createDataFrame(rows, "e double, m double, want bigint").withColumn("got", X.reliability_tier("e", "m"))
    assert all(r["got"] == r["want"] for r in df.collect())


def test_classes_of_ten_values(spark):
    edges = F.array(*[F.lit(x) for x in (1.0, 2.8, 4.6, 6.4, 8.2, 10.0)])
    df = spark.createDataFrame([(1.0,), (2.8,), (2.9,), (6.4,), (6.5,), (10.0,), (None,)], "v double")
    assert [r[0] for r in df.select(X.class_of("v", edges)).collect()] == [1, 1, 2, 3, 4, 5, None]


def test_safe_cells(spark):
    cells = [("=1", False), ("-3.5e2", True), ("-x", False), ("@a", False), ("plain", True), (None, True), ("", True)]
    df = spark.createDataFrame(cells, "c string, want boolean").withColumn("got", X.safe_cell("c"))
    assert all(r["got"] == r["want"] for r in df.collect())


def test_projection_round_trip_and_scale(spark):
    df = spark.createDataFrame([(-75.3, 39.9), (-74.9, 40.1), (-75.0, 40.0)], "lon double, lat double")
    x, y = G.to_metres(F.col("lon"), F.col("lat"))
    planar = df.select("lon", "lat", x.alias("x"), y.alias("y"))
    lon, lat = G.to_degrees(F.col("x"), F.col("y"))
    for r in planar.select("lon", "lat", "x", "y", lon.alias("a"), lat.alias("b")).collect():
        assert abs(r["a"] - r["lon"]) < 1e-9 and abs(r["b"] - r["lat"]) < 1e-9
    centre = planar.where("lon = -75.0").first()
    assert abs(centre["x"] - 500000) < 1e-6 and 4427700 < centre["y"] < 4427800


def test_nearest_points(spark):
    points = spark.createDataFrame([(1, 0.0, 0.0), (2, 10.0, 0.0), (3, 3.0, 4.0), (4, -9000.0, 5.0)], "id long, x double, y double")
    targets = spark.createDataFrame([(1, 3.0, 4.0), (2, 100.0, 100.0)], "t long, x double, y double")
    got = {r["id"]: (r["t"], round(r["distance"], 1)) for r in spatial.nearest(points, targets, "id", "t", 5.0).collect()}
    assert got == {1: (1, 5.0), 2: (1, 8.1), 3: (1, 0.0), 4: (1, round(math.hypot(9003, 1), 1))}
    none = spatial.nearest(points, targets.where("t > 9"), "id", "t", 5.0).collect()
    assert len(none) == 4 and all(r["t"] is None for r in none)


def test_points_on_an_edge_are_in_no_polygon(spark):
    square = spark.createDataFrame([(1, 0.0, 0.0, 10.0, 10.0), (2, 10.0, 0.0, 20.0, 10.0)], "p long, x0 double, y0 double, x1 double, y1 double")
    square = square.select("p", G.box_ring(F.col("x0"), F.col("y0"), F.col("x1"), F.col("y1")).alias("ring"))
    points = spark.createDataFrame([(1, 5.0, 5.0), (2, 10.0, 5.0), (3, 15.0, 1.0), (4, 50.0, 5.0)], "id long, x double, y double")
    got = {r["id"]: r["p"] for r in spatial.assign_area(points, square, "id", "p", "ring", 4.0).collect()}
    assert got == {1: 1, 2: None, 3: 2, 4: None}


def test_average_rank_of_ties_and_nulls(spark):
    df = spark.createDataFrame([(1, 5.0), (2, 5.0), (3, 1.0), (4, 9.0), (5, None)], "id long, v double")
    got = {r["id"]: r["r"] for r in spatial.average_rank(df, "v", "r").collect()}
    assert got == {1: 2.5, 2: 2.5, 3: 1.0, 4: 4.0, 5: None}


def test_contract_reports_every_violation(spark):
    df = spark.createDataFrame([(1, "a", -5.0), (1, "Z", 7.0), (None, "b", None)], "k long, s string, v double")
    c = Contract("t", (Field("k", "int", nullable=False), Field("s", "str", pattern="[a-z]"), Field("v", "float", low=0), Field("gone", "str"), Field("s", "int")), key=("k",), least_rows=5)
    got = {(r["check"], r["detail"], r["count"]) for r in contracts.violations(df, c).collect()}
    assert got == {("nulls", "k", 1), ("pattern", "s", 1), ("minimum", "v", 1), ("missing column", "gone", 1), ("kind", "s", 1), ("rows", "row count", 3), ("duplicate key", "k", 1), ("null key", "k", 1)}
    with pytest.raises(ValueError, match="minimum v"):
        contracts.enforce(df, c)


def test_components_and_shortest_paths(spark):
    edges = spark.createDataFrame([(1, 2, 1.0), (2, 3, 1.0), (3, 4, 1.0), (1, 4, 9.0), (7, 8, 1.0)], "src long, dst long, length double")
    assert {(r["node"], r["label"]) for r in network.component_labels(edges).collect()} == {(1, 1), (2, 1), (3, 1), (4, 1), (7, 7), (8, 7)}
    assert network.largest_component(edges).count() == 4
    start = spark.createDataFrame([(0, 1)], "source long, node long")
    got = {r["node"]: r["distance"] for r in network.shortest(network.two_way(edges), start, 2.5).collect()}
    assert got == {1: 0.0, 2: 1.0, 3: 2.0}


def test_nodes_of_components_are_not_sent_to_the_driver(spark, monkeypatch):
    """No join of the loop, of the last step or of the grid is a broadcast of a table that grows with the nodes."""
    from tractlake.plans import domains

    seen, plain = [], network.cut
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    monkeypatch.setattr(network, "cut", lambda df: seen.append(plan(df)) or plain(df))
    edges = domains.grid(spark, "/root/testdata/sf0.001")
    last = plan(network.largest_component(edges))
    assert len(seen) >= 4 and not any("BroadcastHashJoin" in p for p in [plan(edges), *seen])
    assert "SortMergeJoin" in last and set(re.findall(r"BroadcastHashJoin \[(\w+)#", last)) == {"label"}  # the one row of the largest


def test_whole_matrix_has_all_pairs_and_the_nearest_sites(spark):
    from tractlake.plans import registry, standins

    data = "/root/testdata/sf0.001"
    o, s = standins.origins(spark, data).collect(), standins.sites(spark, data).collect()
    want = {(a["origin_id"], b["site_id"]): (abs(a["x"] - b["x"]) + abs(a["y"] - b["y"])) / 80 + 1 for a in o for b in s}
    for name in ("c9_grid_completion", "b26_proxy_times", "g6_distance"):
        rows = registry.QUERIES[name](spark, data).select("origin_id", "site_id").collect()
        assert len(rows) == len(want) and {tuple(r) for r in rows} == set(want)
    got = {(r["origin_id"], r["site_id"]): r["minutes"] for r in standins.matrix(spark, data).collect()}
    assert got.keys() == want.keys()
    finite = {k: v for k, v in got.items() if v is not None}
    for a in o:
        k = a["origin_id"]
        assert min(v for (i, _), v in finite.items() if i == k) == pytest.approx(min(v for (i, j), v in want.items() if i == k and (i + j) % 17))
    near = {(r["origin_id"], r["site_id"]): r["minutes"] for r in standins.sparse_matrix(spark, data).checked().pairs.collect()}
    assert near == {k: v for k, v in finite.items() if v < standins.CAP}


def test_sparse_matrices_refuse_and_count(spark):
    from tractlake.operators.sparse import SparseMatrix

    origins, sites = spark.createDataFrame([(1,), (2,), (3,)], "origin_id long"), spark.createDataFrame([(7, "a"), (8, "b")], "site_id long, kind string")
    pairs = lambda rows: SparseMatrix(spark.createDataFrame(rows, "origin_id long, site_id long, minutes double"), origins, sites.select("site_id"), 120.0)
    m = pairs([(1, 7, 10.0), (1, 8, 30.0), (2, 8, 50.0)]).checked()
    assert tuple(m.completion().first()) == (6, 3, 3, 0.5)
    assert [r["origin_id"] for r in m.stranded().collect()] == [3]
    assert tuple(m.compared(pairs([(1, 7, 10.5), (3, 7, 119.0)]), [1.0, 5.0]).first()) == (6, 2, 90.0, 2, 0, 2)
    assert {tuple(r) for r in m.nearest_by(sites, "kind", ["a", "b"]).collect()} == {(1, "a", 10.0), (1, "b", 30.0), (2, "a", 120.0), (2, "b", 50.0), (3, "a", 120.0), (3, "b", 120.0)}
    assert {tuple(r) for r in m.reached([15.0, 60.0]).collect()} == {(1, 15.0, 1), (1, 60.0, 2), (2, 15.0, 0), (2, 60.0, 1), (3, 15.0, 0), (3, 60.0, 0)}
    s = m.summary([0.0, 0.2, 0.5, 1.0]).first()
    assert (s["n"], s["finite"], s["low"]) == (6, 3, 10.0) and s["q"] == pytest.approx([10.0, 30.0, 85.0, 120.0])
    for rows, what in (([(1, 7, 1.0)] * 2, "repeated"), ([(9, 7, 1.0)], "unknown origin"), ([(1, 9, 1.0)], "unknown site"), ([(1, 7, 120.0)], "not below"), ([(1, 7, None)], "not below")):
        with pytest.raises(ValueError, match=what):
            pairs(rows).checked()
