"""Counts of pairs by distance against every pair."""

from collections import Counter

import numpy as np
import pytest

from tractlake.operators import distances


@pytest.mark.parametrize("gap", [-2, -1, 0, 1, 3])
def test_correlated_bands_are_exact(gap, monkeypatch):
    monkeypatch.setattr(distances, "WORTH", 0)
    rng = np.random.default_rng(gap + 5)
    width, tiles, size = 40, 5, 600
    points = lambda n, kinds: np.stack([rng.integers(0, width, n), rng.integers(0, width * tiles, n), rng.integers(0, kinds, n), rng.integers(1, 9, n)])
    o, s, allowed = points(300, 3), points(200, 4), rng.random((3, 4)) < 0.7
    got = distances.band_counts(o, s, width, gap * width, tiles, allowed, size)
    want = np.zeros(size, np.int64)
    for x, y, k, w in o.T:
        for x2, y2, k2, w2 in s.T:
            if allowed[k, k2]:
                want[abs(x - x2 - gap * width) + abs(y - y2)] += w * w2
    assert (got == want).all()


def test_counted_matrix(spark):
    rng = np.random.default_rng(3)
    o = [(*map(int, rng.integers(-50, 50, 2)), int(rng.integers(2)), int(rng.integers(3))) for _ in range(60)] + [(None, 1, 0, 2)]
    s = [(*map(int, rng.integers(-50, 50, 2)), int(rng.integers(3))) for _ in range(40)] * 2
    got = distances.counted_matrix(spark.createDataFrame(o, "x int, y int, kind int, part int"), spark.createDataFrame(s, "x int, y int, kind int"), (2, 3), [(0, 1), (1, 2)])
    want = Counter((p, None if x is None or (k, k2) in {(0, 1), (1, 2)} else abs(x - x2) + abs(y - y2)) for x, y, k, p in o for x2, y2, k2 in s)
    assert {(r["part"], r["distance"]): r["pairs"] for r in got.collect()} == want


def test_counted_matrix_of_nothing(spark):
    none = spark.createDataFrame([], "x int, y int, kind int, part int")
    assert distances.counted_matrix(none, none.drop("part"), (1, 1), []).count() == 0


def test_threshold_counts_without_a_list_of_pairs(spark, tmp_path, monkeypatch):
    from tractlake.operators import distances, tree
    from tractlake.plans import registry, standins

    customers = [(k, k % 25) for k in range(-120, 400, 13)] + [(6, 6), (6, 6), (None, 1)]
    suppliers = [(k,) for k in range(-90, 300, 7)] + [(2,), (2,), (None,)]
    spark.createDataFrame(customers, "c_custkey long, c_nationkey int").write.parquet(f"{tmp_path}/customer.parquet")
    spark.createDataFrame(suppliers, "s_suppkey long").write.parquet(f"{tmp_path}/supplier.parquet")
    minutes = {}
    for r in standins.matrix(spark, str(tmp_path)).collect():
        minutes.setdefault(r["origin_id"], []).append(r["minutes"])
    want = sorted((k or -999, t, sum(m is not None and m <= t for m in minutes[k])) for k, _ in customers for t in (10, 15, 20, 30, 45))

    def refused(*_):
        raise AssertionError("pairs are listed")

    monkeypatch.setattr(tree, "pairs_within", refused)
    for looking, seen in ((100_000, 250_000), (10, 9)):
        monkeypatch.setattr(distances, "LOOKING", looking)
        monkeypatch.setattr(distances, "SEEN", seen)
        got = [(r["origin_id"], r["threshold"], r["sites"]) for r in registry.QUERIES["m2_threshold_counts"](spark, str(tmp_path)).collect()]
        assert sorted((k or -999, t, n) for k, t, n in got) == want and sum(n for _, _, n in want) > 40
