"""Trees of cells, parts of graphs, closures, gaps, digest trees and conflation against plain loops."""

import hashlib
import heapq
import math
import random

import pytest

from tractlake.operators import conflation, lineage, network, tree
from tractlake.sources import tables


def crowded(seed, n=400):
    dice = random.Random(seed)
    spots = [(500 + dice.random(), 500 + dice.random()) if dice.random() < 0.9 else (dice.uniform(0, 1000), dice.uniform(0, 1000)) for _ in range(n)]
    return spots + [(500.5, 500.5)] * 40 + [(7.0, 7.0)] * 3


def test_nearest_and_counts_on_crowded_points(spark):
    targets, points = crowded(1), crowded(2, 150)[:150] + [(-900.0, 2000.0), (7.0, 7.0), (500.5, 500.5)]
    t = spark.createDataFrame([(i, *p) for i, p in enumerate(targets)], "t long, x double, y double")
    p = spark.createDataFrame([(i, *q) for i, q in enumerate(points)] + [(999, None, 1.0)], "id long, x double, y double")
    got = {r["id"]: (r["t"], r["distance"]) for r in tree.nearest(p, t, "id", "t", most=8).collect()}
    for i, (x, y) in enumerate(points):
        best = min((math.hypot(x - a, y - b), k) for k, (a, b) in enumerate(targets))
        assert got[i][1] == pytest.approx(best[0]) and got[i][0] == best[1]
    assert got[999] == (None, None)
    counts = {r["id"]: r["n"] for r in tree.counts_within(p, t, "id", 200.0, most=8).collect()}
    assert counts == {i: sum(math.hypot(x - a, y - b) <= 200 for a, b in targets) for i, (x, y) in enumerate(points)} | {999: 0}
    none = t.limit(0)
    assert all(r["t"] is None for r in tree.nearest(p, none, "id", "t").collect())
    assert {r["n"] for r in tree.counts_within(p, none, "id", 5.0).collect()} == {0}
    parts = tree.even_parts(p.where("x is not null"), "id", 20)
    assert parts.count() == len(points) and parts.groupBy("home").count().agg({"count": "max"}).first()[0] <= 20


def test_points_look_into_the_tree_together(spark, monkeypatch):
    """Rows kept follow the groups of places, not the points; counts are those of plain loops, also with several tasks a group and repeated or missing places."""
    dice = random.Random(5)
    spots = [(dice.randrange(100), dice.randrange(100)) for _ in range(600)]
    points = [(i, *map(float, spots[i % 600])) for i in range(3000)] + [(3000, None, 1.0), (3001, math.nan, 1.0), (3002, math.inf, 1.0)]
    targets = [(float(dice.randrange(100)), float(dice.randrange(100))) for _ in range(900)]
    p, t = spark.createDataFrame(points, "id long, x double, y double"), spark.createDataFrame(targets, "x double, y double")
    kept, plain = [], tree.cut
    monkeypatch.setattr(tree, "cut", lambda df: kept.append(plain(df)) or kept[-1])
    monkeypatch.setattr(tree, "TARGETS_A_TASK", 100)
    got = {r["id"]: r["n"] for r in tree.counts_within(p, t, "id", 25.0, most=16, together=50).collect()}
    assert max(df.count() for df in kept) < 3000
    assert got == {i: x is not None and sum((x - a) ** 2 + (y - b) ** 2 <= 625 for a, b in targets) for i, x, y in points}


def brute_times(edges, sources, radius):
    ways = {}
    for a, b, length in edges:
        ways.setdefault(a, []).append((b, length))
    out = {}
    for s in sources:
        heap, done = [(0.0, s)], {}
        while heap:
            d, n = heapq.heappop(heap)
            if n not in done:
                done[n] = d
                for b, length in ways.get(n, ()):
                    if d + length <= radius:
                        heapq.heappush(heap, (d + length, b))
        out |= {(s, n): d for n, d in done.items()}
    return out


def test_rounds_follow_parts_and_not_edges(spark, monkeypatch):
    n, dice = 400, random.Random(3)
    edges = [(k, k + 1, 1.0) for k in range(n - 1)] + [(dice.randrange(n), dice.randrange(n), 5.0) for _ in range(30)]
    both = edges + [(b, a, length) for a, b, length in edges]
    df = spark.createDataFrame(both, "src long, dst long, length double")
    sources = spark.createDataFrame([(0, 0), (250, 250), (399, 399)], "source long, node long")
    homes = spark.createDataFrame([(k, f"h{k // 100}") for k in range(n)], "node long, home string")
    cuts = []
    monkeypatch.setattr(network, "cut", lambda df, real=network.cut: cuts.append(1) or real(df))
    for radius in (1000.0, 40.0):
        cuts.clear()
        got = {(r["source"], r["node"]): r["distance"] for r in network.shortest_by_parts(df, sources, radius, homes, sources_a_task=2).collect()}
        assert got == brute_times(both, [0, 250, 399], radius)
        assert len(cuts) <= 60  # four a round: some fifteen rounds at most, for paths of up to 400 edges


def test_closure_of_a_long_chain_and_a_cycle(spark):
    chain = [(f"n{k:03}", f"n{k + 1:03}") for k in range(300)]
    edges = spark.createDataFrame(chain + [("a", "b"), ("b", "c"), ("c", "a"), ("c", "raw"), (None, "x")], "child string, parent string")
    found = lineage.closure(edges)
    assert found.where("child like 'n%'").count() == 300 * 301 // 2
    assert {r["child"] for r in lineage.cycles(edges).collect()} == {"a", "b", "c"}
    wanted = spark.createDataFrame([("n000",), ("a",), ("raw",)], "child string")
    assert {tuple(r) for r in lineage.raw_sources(edges, wanted).collect()} == {("n000", "n300"), ("a", "raw")}
    assert lineage.closure(edges.limit(0)).count() == 0


def test_first_gap_without_a_limit(spark):
    taken = [("full", k) for k in range(12)] + [("gap", k) for k in (0, 1, 3, 40)] + [("late", 5), ("twice", 0), ("twice", 0)]
    got = {r["s"]: r["next"] for r in lineage.next_free(spark.createDataFrame(taken, "s string, n long"), ["s"], "n").collect()}
    assert got == {"full": 12, "gap": 2, "late": 0, "twice": 1}


def test_digest_trees_do_not_depend_on_splits(spark, tmp_path):
    dice = random.Random(4)
    files = {"empty": b"", "small": b"abc", "even": dice.randbytes(4000), "odd": dice.randbytes(12345)}
    (tmp_path / "deep").mkdir()
    for name, raw in files.items():
        (tmp_path / "deep" / name).write_bytes(raw)

    def brute(raw, leaf, fan):
        level = [hashlib.sha256(raw[k : k + leaf]).digest() for k in range(0, len(raw), leaf)]
        while len(level) > 1:
            level = [hashlib.sha256(b"".join(level[k : k + fan])).digest() for k in range(0, len(level), fan)]
        return level[0].hex()

    for split in (1, 3, 1000):
        got = {r["path"].rsplit("/", 1)[1]: (r["length"], r["tree_sha256"]) for r in tables.tree_digests(spark, str(tmp_path), leaf=100, leaves_a_split=split, fan=5).collect()}
        assert got == {name: (len(raw), brute(raw, 100, 5)) for name, raw in files.items() if raw}  # Spark lists no empty files


def test_conflation_of_planted_names(spark):
    rows = [
        ("a1", "city", "Reading Terminal Market", 0, 0),
        ("a2", "city", "Reading Terminal Market", 0, 0),  # the same place twice in one source stays two
        ("b1", "state", "READING-TERMINAL MARKT", 10, 0),
        ("c1", "survey", "reading terminal  market!", 0, 5),
        ("a3", "city", "Corner Store", 500, 500),
        ("b2", "state", "Corner Shop", 500, 500),  # four edits away
        ("a4", "city", "Deli", 900, 900),
        ("b3", "state", "Deli", 990, 990),  # too far
        ("a5", "city", None, 5, 5),
        ("b4", "state", "", 5, 5),
        ("a6", "city", "Lost", None, None),
    ]
    df = spark.createDataFrame([(i, s, n, None if x is None else float(x), None if y is None else float(y)) for i, s, n, x, y in rows], "id string, source string, name string, x double, y double")
    ranks = {"city": 1, "state": 2, "survey": 3}
    got = {r["id"]: (r["entity"], r["kept"], r["n"]) for r in conflation.conflate(df, "id", "source", "name", ranks, 100.0).collect()}
    assert got.pop("a1") == ("a1", True, 3) and got.pop("b1") == ("a1", False, 3) and got.pop("c1") == ("a1", False, 3)
    assert all(v == (k, True, 1) for k, v in got.items()) and len(got) == 8
    with pytest.raises(ValueError, match="unique"):
        conflation.conflate(df.unionByName(df.limit(1)), "id", "source", "name", ranks, 100.0)
    with pytest.raises(ValueError, match="rank"):
        conflation.conflate(df, "id", "source", "name", {"city": 1}, 100.0)


@pytest.mark.parametrize("seed", [5])
def test_no_match_within_the_edits_is_lost(spark, seed):
    dice = random.Random(seed)

    def edited(name):
        for _ in range(dice.randint(0, 3)):
            k = dice.randint(0, len(name))
            name = dice.choice([name[:k] + dice.choice("abc") + name[k:], name[:k] + name[k + 1 :], name[:k] + dice.choice("abc") + name[k + 1 :]])
        return name

    names = ["".join(dice.choice("abc") for _ in range(dice.randint(1, 9))) for _ in range(25)]
    rows = [(f"{s}{k}", s, edited(n), dice.uniform(0, 30), dice.uniform(0, 30)) for s in "xy" for k, n in enumerate(names)]
    rows = [r for r in rows if r[2]]
    df = spark.createDataFrame([(i, s, 1, n, x, y) for i, s, n, x, y in rows], "id string, source string, rank int, name string, x double, y double")

    def levenshtein(a, b):
        row = list(range(len(b) + 1))
        for i, c in enumerate(a, 1):
            last, row[0] = row[0], i
            for j, e in enumerate(b, 1):
                last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (c != e))
        return row[-1]

    want = {(a[0], b[0], levenshtein(a[2], b[2])) for a in rows for b in rows if a[1] != b[1] and math.hypot(a[3] - b[3], a[4] - b[4]) <= 10 and levenshtein(a[2], b[2]) <= 2}
    assert {(r["a"], r["b"], r["edits"]) for r in conflation.candidates(df, 10.0, 2).collect()} == want


def test_nearest_of_allowed_kinds_matches_brute_force(spark):
    points = [(k, k * 37 % 101, k * 53 % 97, 0b111 ^ 1 << k % 3) for k in range(120)]
    targets = [(k, k * 29 % 103 if k > 60 else 50 + k % 3, k * 31 % 89 if k > 60 else 40, 1 << k % 3) for k in range(150)]
    p, t = spark.createDataFrame(points, "p int, x int, y int, sees int"), spark.createDataFrame(targets, "t int, x int, y int, kind int")
    got = tree.nearest(p, t, "p", "t", 4, manhattan=True, kind="kind", allowed="sees").collect()
    want = {a: min((float(abs(x - u) + abs(y - v)), b) for b, u, v, kind in targets if kind & sees) for a, x, y, sees in points}
    assert {r["p"]: (r["distance"], r["t"]) for r in got} == want
    nothing = tree.nearest(p.withColumn("sees", p["sees"] * 0), t, "p", "t", 4, kind="kind", allowed="sees").collect()
    assert len(nothing) == 120 and all(r["t"] is None for r in nothing)


def test_reusable_run_keeps_one_run_of_each_key(spark):
    runs = spark.createDataFrame([(k, "finished", "p", "a", "b") for k in range(50)], "run int, status string, plan string, points string, inputs string")
    wanted = spark.createDataFrame([("n", "p", "a", "b"), ("m", "p", "a", "c")], "name string, plan string, points string, inputs string")
    out = lineage.reusable_run(runs, wanted)
    assert {r["name"]: r["run"] for r in out.collect()} == {"n": 49, "m": None}
    assert out._jdf.queryExecution().optimizedPlan().toString().count("Aggregate") == 2  # runs are reduced before they meet what is wanted
