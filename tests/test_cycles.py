"""Cycles of lineage without all pairs of ancestors."""

import random

from tractlake.operators import lineage


def by_hand(edges):
    up = {}
    for a, b in edges:
        up.setdefault(a, set()).add(b)
    out = set()
    for start in up:
        seen, todo = set(), list(up[start])
        while todo:
            n = todo.pop()
            if n not in seen:
                seen.add(n)
                todo += up.get(n, ())
        if start in seen:
            out.add(start)
    return out


def test_paths_are_followed_near_cycles_only(spark, monkeypatch):
    edges = [(k, k - 1) for k in range(1, 60)] + [(40, 42)]
    followed, whole = [], lineage.closure
    monkeypatch.setattr(lineage, "closure", lambda e: followed.append(e.count()) or whole(e))
    got = {r["child"] for r in lineage.cycles(spark.createDataFrame(edges, "child long, parent long")).collect()}
    assert got == {40, 41, 42} and followed == [3]


def test_cycles_are_those_of_a_search(spark):
    pick = random.Random(5)
    mixed = [(pick.randrange(60), pick.randrange(60)) for _ in range(55)] + [(70, 70), (80, 81), (81, 82), (None, 3), (3, None)]
    df = spark.createDataFrame([(a, b) for a, b in mixed], "child long, parent long")
    want = by_hand([(a, b) for a, b in mixed if a is not None and b is not None])
    assert want
    for rounds in (40, 1):
        assert {r["child"] for r in lineage.cycles(df, rounds).collect()} == want


def sources_by_hand(edges):
    up, out = {}, set()
    for a, b in edges:
        up.setdefault(a, set()).add(b)
    for start in up:
        seen, todo = set(), list(up[start])
        while todo:
            n = todo.pop()
            if n is not None and n not in seen:
                seen.add(n)
                todo += up.get(n, ())
        out |= {(start, n) for n in seen if n not in up}
    return {(a, b) for a, b in out if a is not None}


def test_sources_are_those_of_a_search_and_no_closure_is_made(spark, monkeypatch):
    def refused(*_):
        raise AssertionError("all pairs of ancestors are listed")

    monkeypatch.setattr(lineage, "closure", refused)
    pick = random.Random(7)
    sparse = [(pick.randrange(50), pick.randrange(70)) for _ in range(60)] + [(k, k - 1) for k in range(200, 240)]
    odd = [(80, 80), (81, 82), (82, 81), (83, 84), (84, 83), (84, 85), (None, 3), (86, None), (87, 86), (3, None), (87, 88), (87, 88)]
    dense = [(100 + a, 100 + b) for a in range(12) for b in range(12) if a != b] + [(111, 300), (105, 301)]
    for edges in (sparse + odd + dense, []):
        df = spark.createDataFrame(edges, "child long, parent long")
        got = [tuple(r) for r in lineage.raw_sources(df, df.select("child").distinct()).collect()]
        assert set(got) == sources_by_hand(edges) and len(got) == len(set(got))
