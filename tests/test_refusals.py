"""Operators that refuse: each raises on what it names, and lets the rest pass."""

import pytest
from pyspark.sql import functions as F

from tractlake.operators import hours, joins, layers, matrix, publishing


def keyed(spark, *keys):
    return spark.createDataFrame([(k, f"v{k}") for k in keys], "k int, v string")


def test_one_to_one(spark):
    a, b = keyed(spark, 1, 2, 3), keyed(spark, 3, 2, 1).withColumnRenamed("v", "w")
    assert joins.one_to_one(a, b, ["k"]).count() == 3
    for left, right in ((a, keyed(spark, 1, 2)), (keyed(spark, 1, 2), a), (keyed(spark, 1, 1, 2, 3), b), (a, keyed(spark, 1, 2, 3, 3))):
        with pytest.raises(ValueError, match="keys differ"):
            joins.one_to_one(left, right, ["k"])


def test_merges_and_restrictions(spark):
    a = keyed(spark, 1, 2)
    with pytest.raises(ValueError, match="repeated key"):
        joins.outer_merge([a, keyed(spark, 2, 2).withColumnRenamed("v", "w")], ["k"])
    with pytest.raises(ValueError, match="spine key"):
        joins.restricted(a, keyed(spark, 1, 5), "k")
    with pytest.raises(ValueError, match="unknown site"):
        joins.answered(a, keyed(spark, 9).withColumnRenamed("v", "w"), "k")
    with pytest.raises(ValueError, match="no citation"):
        joins.cited(a, spark.createDataFrame([(1, "who"), (2, " ")], "k int, c string"), "k", "c")
    with pytest.raises(ValueError, match="repeated key"):
        joins.combined([a, a], ["k"])
    with pytest.raises(ValueError, match="instead of"):
        joins.combined([a], ["k"], 3)
    with pytest.raises(ValueError, match="columns differ"):
        joins.combined([a, a.withColumnRenamed("v", "w")], ["k"])


def test_strict_area(spark):
    ring = lambda *xy: [{"x": float(x), "y": float(y)} for x, y in xy]
    areas = spark.createDataFrame([(1, ring((0, 0), (4, 0), (4, 4), (0, 4), (0, 0))), (2, ring((3, 0), (8, 0), (8, 4), (3, 4), (3, 0)))], "a int, ring array<struct<x:double,y:double>>")
    point = lambda x: spark.createDataFrame([(1, float(x), 1.0)], "p int, x double, y double")
    assert joins.strict_area(point(1), areas, "p", "a", "ring", 2.0).collect()[0]["a"] == 1
    with pytest.raises(ValueError, match="several areas"):
        joins.strict_area(point(3.5), areas, "p", "a", "ring", 2.0)
    with pytest.raises(ValueError, match="no area"):
        joins.strict_area(point(99), areas, "p", "a", "ring", 2.0)


def test_widen_refuses(spark):
    long = spark.createDataFrame([("t", "m", 1.0, 0.1, 1, "publish")], "g string, metric string, estimate double, moe double, tier long, action string")
    assert publishing.widen(long, "g", "metric", ["m"], {"m": "a metric"}).columns == ["g", "m__estimate", "m__moe", "m__tier", "m__action"]
    with pytest.raises(ValueError, match="no description"):
        publishing.widen(long, "g", "metric", ["m"], {})
    with pytest.raises(ValueError, match="repeated metric"):
        publishing.widen(long.union(long), "g", "metric", ["m"], {"m": "a metric"})
    with pytest.raises(ValueError, match="unknown metric"):
        publishing.widen(long, "g", "metric", ["n"], {"n": "another"})


def test_gate_lets_sound_tables_pass(spark):
    t = publishing.Public("tracts", spark.createDataFrame([("a", 1.0, 2.0)], "geoid string, x double, y double"), "geoid", "A")
    assert publishing.gate([t], {"tracts": "A"}, {"tracts": "A"}, {"tracts": t.rows}, (0, 0, 9, 9), {"c": [1.0, 2.0]}).count() == 0


def test_sample_gives_way_to_free_keys_only(spark):
    keys = spark.createDataFrame([(k,) for k in range(20)], "k long")
    got = lambda skipped: [r["k"] for r in matrix.systematic_sample(keys, "k", 5, 4, skipped).orderBy("position").collect()]
    assert got([]) == [0, 5, 10, 15]
    assert got([5, 6, 7, 8, 9]) == [0, 10, 11, 15]  # 10 is taken when its own turn comes
    assert got(list(range(15, 20))) == [0, 5, 10]


def test_ring_reasons_and_hours_of_odd_rows(spark):
    rings = spark.createDataFrame([(1, None), (2, [])], "k int, ring array<struct<x:double,y:double>>")
    assert {r["k"]: r["reason"] for r in layers.ring_faults(rings, "k", "ring").collect()} == {1: "empty", 2: "empty"}
    odd = spark.createDataFrame([("25:00 - 26:00 monday", None), ("sunday", None), ("Monday 09:00-24:00", "June - May")], "hours string, months string")
    assert [r["hours_status"] for r in hours.from_text(odd).collect()] == ["malformed", "malformed", "parsed"]
    assert [r["open_off_season"] for r in hours.from_text(odd).where(F.col("hours_status") == "parsed").collect()] == [True]
