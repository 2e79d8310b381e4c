"""Loops of self-joins: the planner's estimate of a table doesn't grow from round to round."""

from tractlake.operators import shapes


def digits(df):
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())).bit_length()


def test_circles_keep_tables_of_known_size(spark):
    n = 40
    steps = spark.createDataFrame([(k, (k + 1) % n) for k in range(n)], "id long, next long")
    out, rounds = shapes.circles(steps)
    assert {(r["id"], r["label"]) for r in out.collect()} == {(k, 0) for k in range(n)}
    assert rounds > 5 and digits(out) < 40
