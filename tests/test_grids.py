"""Products of origins and sites: made in even tasks, nothing of them shuffled."""

import pytest
from pyspark.sql import functions as F

from tractlake.functions import expr as X
from tractlake.operators import joins, runs
from tractlake.plans import registry, standins

DATA = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_a_product_is_made_in_as_many_tasks_as_it_has_work(spark, monkeypatch):
    monkeypatch.setattr(joins, "PAIRS_A_TASK", 100)
    left, right = spark.range(60).coalesce(1), spark.range(40).coalesce(1).withColumnRenamed("id", "other")
    made = joins.crossed(left, right, "id")
    assert "RepartitionByExpression [id" in plan(made) and ", 25" in plan(made)
    assert made.count() == made.distinct().count() == 2400


def test_products_in_blocks_are_whole_and_repeat_blocks(spark, monkeypatch):
    ids = lambda n: spark.range(n).select(((F.col("id") * 7919 + 5) % 900_001).alias("other"))
    left = spark.range(20).union(spark.sql("select cast(null as long)"))
    rows = [tuple(r) for r in joins.crossed_in_blocks(left, ids(2_000), "id").collect()]  # one task
    runs_ = [rows[k : k + 504] for k in range(0, 21 * 504, 504)]
    assert all(len({i for i, _ in run}) == 1 and [j for _, j in run] == [j for _, j in rows[:504]] for run in runs_)
    monkeypatch.setattr(joins, "PAIRS_A_TASK", 10_000)
    made = joins.crossed_in_blocks(left, ids(3_000), "id")
    assert made.count() == made.distinct().count() == 21 * 3_000
    assert joins.crossed_in_blocks(left, ids(3_000).union(ids(1)), "id").count() == 21 * 3_001
    assert joins.crossed_in_blocks(left, ids(0), "id").count() == 0


@pytest.mark.parametrize("name", ["c17_answers", "c15_restrict_matrix", "g6_distance", "b26_proxy_times", "b26_percentiles_by_mode", "c9_grid_completion", "c9_completed_grid"])
def test_products_are_made_in_blocks(spark, name):
    text = registry.QUERIES[name](spark, DATA)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" in text and "BroadcastNestedLoopJoin" not in text


@pytest.mark.parametrize("name", ["c17_answers", "c15_restrict_matrix", "g6_distance", "b26_proxy_times", "b26_percentiles_by_mode", "c9_grid_completion", "c9_completed_grid"])
def test_queries_of_all_pairs_deal_the_origins_to_tasks(spark, name):
    assert "RepartitionByExpression [origin_id" in plan(registry.QUERIES[name](spark, DATA))


@pytest.mark.parametrize("name", ["c9_grid_completion", "c9_completed_grid"])
def test_completed_grids_join_by_origin_and_by_site_not_by_pair(spark, name):
    text = plan(registry.QUERIES[name](spark, DATA))
    joined = [line for line in text.splitlines() if "Join LeftOuter" in line]
    assert len(joined) == 2 and not any("origin_id" in line and "site_id" in line for line in joined)


def test_grids_by_rule_are_those_of_the_join_by_pair(spark):
    o = spark.createDataFrame([(1,), (2,), (2,), (None,)], "origin_id long")
    s = spark.createDataFrame([(7,), (8,), (9,)], "site_id long")
    known_o = spark.createDataFrame([(1, 5.0), (2, 300.0), (None, 1.0)], "origin_id long, ox double")
    known_s = spark.createDataFrame([(7, 1.0), (8, None), (8, 2.0)], "site_id long, x double")
    rule = F.col("ox") + F.col("x")
    listed = known_o.crossJoin(known_s).select("origin_id", "site_id", rule.alias("minutes"))
    want = o.crossJoin(s).join(listed, ["origin_id", "site_id"], "left").select("origin_id", "site_id", X.censored("minutes", 120.0).alias("minutes"))
    rows = lambda df: sorted(map(str, df.collect()))
    assert rows(runs.grid_by_rule(o, s, known_o, known_s, rule, 120.0)) == rows(want)
    with pytest.raises(ValueError, match="repeated site"):
        runs.completed_by_rule(o, s, known_o, known_s, rule, 120.0)


def test_rounding_without_decimals_is_rounding(spark):
    values = [0.0, -0.0, 0.0005, 1.0005, 2.5, -2.4995, 1.0015, 12345.6785, 0.1235, 1e15 / 7, -1e6 / 3, float("inf"), 3.00049999, 7.0 / 2000, None] + [k / 16000 for k in range(-50, 4000)]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    wrong = df.where(~X.rounded(F.col("v"), 3).eqNullSafe(F.round("v", 3)))
    assert wrong.count() == 0
    assert standins.CAP == 120.0


def test_threshold_counts_list_no_pair_beyond_the_largest_threshold(spark, monkeypatch):
    from tractlake.operators.sparse import SparseMatrix

    listed, reached = [], SparseMatrix.reached
    monkeypatch.setattr(SparseMatrix, "reached", lambda m, t: listed.append(m.pairs.agg(F.max("minutes")).first()[0]) or reached(m, t))
    registry.QUERIES["m2_threshold_counts"](spark, DATA)
    assert listed and 44 < listed[0] < 46
