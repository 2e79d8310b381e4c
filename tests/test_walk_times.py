"""The product of walk times doesn't travel."""

from __future__ import annotations

from tractlake.operators import network


def test_product_is_not_shuffled(spark):
    edges = network.two_way(spark.createDataFrame([(1, 2, 5.0), (2, 3, 5.0)], "src long, dst long, length double"))
    o, s = spark.createDataFrame([(1,), (9,)], "origin_id long"), spark.createDataFrame([(3,), (4,)], "site_id long")
    a, b = spark.createDataFrame([(1, 1, 1.0)], "origin_id long, node_id long, distance double"), spark.createDataFrame([(3, 3, 2.0)], "site_id long, node_id long, distance double")
    out = network.walk_times(edges, o, s, a, b, 1.0, 20.0)
    assert {(r["origin_id"], r["site_id"], r["minutes"]) for r in out.collect()} == {(1, 3, 13.0), (1, 4, None), (9, 3, None), (9, 4, None)}
    top = out._jdf.queryExecution().optimizedPlan().toString().splitlines()
    assert not any("Join LeftOuter" in row for row in top)  # the product met what was found in a join by pair, which dealt it out anew
