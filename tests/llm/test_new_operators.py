"""Prefix trie, embedding near-dedup and filter audit against brute force on small tables with every odd case."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from itertools import permutations

import numpy as np
import pytest

from tractlake.llm import embedding_dedup, filter_audit, prefix_trie

# 11 --------------------------------------------------------------------------------------------

CONV = "conv_id long, turn long, role string, text string, depth long, k string, box string"


def talks(seed: int, most: int = 90) -> list[tuple]:
    dice = random.Random(seed)
    rows = []
    shared = [("user" if k % 2 == 0 else "assistant", f"turn {k} ä😀"[: dice.randint(0, 9)]) for k in range(most)]
    for conv in [*range(40), 100, 101, 150, 199, 250, -3, -150, 1000, 1001]:
        n = dice.choice([0, 1, 2, 3, 8, most])
        for k in range(min(n, most)):
            role, text = shared[k] if dice.random() < 0.97 else (dice.choice([None, "user"]), dice.choice([None, "", "other"]))
            rows.append((conv, dice.choice([k, k, k, None]) if k < 2 else k, role, text, 1, "k", "b"))
    rows += [(7, 2, "user", "again", 1, "k", "b")] * 3 + [(None, 1, "user", "nobody", 1, "k", "b")]
    return rows


def brute_trie(rows: list[tuple]) -> set[tuple]:
    name = lambda role, text: hashlib.md5(f"{len(role)}:{role}{text}".encode()).hexdigest()
    own: dict[int, list] = {}
    for conv, turn, role, text, *_ in rows:
        if conv is not None:
            role, text = role or "", text or ""
            own.setdefault(conv, []).append((turn is not None, turn or 0, role, name(role, text), text))
    own = {c: [(r, t) for *_, r, _, t in sorted(v)] for c, v in own.items()}
    built = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        base = c - int(np.fmod(c, 100))
        built[c] = tuple(own.get(base, [])[:h] + turns[h:])
    members: dict[tuple, list] = {}
    for c, turns in built.items():
        for d in range(len(turns) + 1):
            members.setdefault(turns[:d], []).append(c)
    children: dict[tuple, list] = {}
    for p in members:
        if p:
            children.setdefault(p[:-1], []).append(p)
    leaves, saved = {}, {}
    for p in sorted(members, key=len, reverse=True):
        below = children.get(p, [])
        leaves[p] = sum(leaves[q] for q in below) if below else 1
        saved[p] = sum(saved[q] for q in below) + ((len(members[p]) - 1) * len(p[-1][1]) if p else 0)
    ends = lambda p: hashlib.sha256(",".join(map(str, sorted(c for c in members[p] if built[c] == p))).encode()).hexdigest()
    return {(min(m), len(p), min(members[p[:-1]]) if p else None, len(m), len(children.get(p, [])), leaves[p], saved[p], ends(p)) for p, m in members.items()}


def trie_of(spark, rows, most=prefix_trie.MOST, stride=prefix_trie.STRIDE):
    df = spark.createDataFrame(rows, CONV).repartition(3)
    return [tuple(r) for r in prefix_trie.trie(*prefix_trie.rebuilt(prefix_trie.positions(prefix_trie.turns_of(df))), most=most, stride=stride).collect()]


@pytest.mark.parametrize(("seed", "most", "stride"), [(1, 1024, 32), (2, 2, 4)])
def test_trie_matches_brute_force(spark, monkeypatch, seed, most, stride):
    monkeypatch.setattr(prefix_trie, "RUN", 3)
    monkeypatch.setattr(prefix_trie, "CHUNK", 2)
    rows = talks(seed, 90 if stride == 32 else 23)
    got = trie_of(spark, rows, most, stride)
    assert len(got) == len(set(got)) and set(got) == brute_trie(rows)


def test_trie_of_few_rows(spark):
    assert trie_of(spark, []) == []
    assert trie_of(spark, [(None, 1, "user", "x", 1, "k", "b")]) == []
    assert set(trie_of(spark, [(5, None, None, None, 1, "k", "b")])) == brute_trie([(5, None, None, None)])


# 12 --------------------------------------------------------------------------------------------


def near_vectors(seed: int) -> list[tuple]:
    dice = np.random.default_rng(seed)
    unit = lambda x: x / np.linalg.norm(x, axis=-1, keepdims=True)
    rows, base = [], unit(dice.normal(size=(150, 24)))
    for k, x in enumerate(base):
        rows.append((3 * k, (x * dice.uniform(0.5, 9)).tolist()))
    for k, n in ((4, 60), (9, 12), (20, 3)):  # groups of near copies, one of them large
        for j in range(n):
            x = unit(base[k] + dice.normal(size=24) * dice.choice([0.02, 0.06]))
            rows.append((1000 + 100 * k + j, x.tolist()))
    for k in range(60, 130):  # pairs right at the limit and above
        y = dice.normal(size=24)
        y = unit(y - (y @ base[k]) * base[k])
        c = dice.choice([0.895, 0.905, 0.95, 0.99])
        rows.append((9000 + k, (c * base[k] + np.sqrt(1 - c * c) * y).tolist()))
    one = base[5].tolist()
    rows += [(20001, one), (20002, one), (20003, [2 * x for x in one]), (20004, [-x for x in one]), (20005, [1e200 * x for x in one]), (20006, [1e-200 * x for x in one])]
    rows += [(30001, None), (30002, []), (30003, [0.0] * 24), (30004, [float("nan")] + one[1:]), (30005, [None] + one[1:]), (30006, [float("inf")] + one[1:])]
    rows += [(30007, [1.0, 0.0]), (30008, [2.0, 0.0]), (30009, [0.0, 1.0]), (30010, [1.0]), (30010, [1.0]), (None, one), (20001, one)]
    return rows


def brute_links(rows: list[tuple]) -> tuple[dict, dict]:
    valid = {}
    for i, v in rows:
        if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v):
            x = np.array(v) / np.abs(v).max()
            valid[i] = x / np.linalg.norm(x)
    ids = sorted({i for i, _ in rows if i is not None})
    links = {i: set() for i in ids}
    for a in valid:
        for b in valid:
            if a < b and len(valid[a]) == len(valid[b]) and valid[a] @ valid[b] >= 0.9:
                links[a].add(b)
                links[b].add(a)
    root = {}
    for i in ids:
        todo = [i]
        while todo:
            at = todo.pop()
            if at not in root:
                root[at] = i
                todo += links[at]
    return {i: len(x) for i, x in links.items()}, root


def test_near_vectors_match_brute_force(spark, monkeypatch):
    monkeypatch.setattr(embedding_dedup, "BLOCK", 16)
    rows = near_vectors(1)
    df = spark.createDataFrame([(i, v, 1, "x", 2) for i, v in rows], "vec_id long, embedding array<double>, dim int, clump string, p int")
    got = {r["vec_id"]: r for r in embedding_dedup.near_duplicates(df).collect()}
    counts, root = brute_links(rows)
    assert got.keys() == counts.keys()
    # The index may lose pairs right at the limit only; it never makes one up.
    total, found = sum(counts.values()), sum(r["n_links"] for r in got.values())
    assert 0.97 * total <= found <= total and all(r["n_links"] <= counts[i] for i, r in got.items())
    same = [i for i in counts if got[i]["n_links"] == counts[i]]
    assert len(same) >= 0.97 * len(counts)
    assert sum(got[i]["component_id"] == root[i] for i in counts) >= 0.97 * len(counts)
    assert all(r["kept"] == (r["component_id"] == i) for i, r in got.items())
    assert sum(r["clump"] is not None for r in got.values()) >= 30
    for i in (20001, 20002, 20003, 20005, 20006):
        assert got[i]["component_id"] == root[i] == 15
    assert got[30007]["n_links"] == got[30008]["n_links"] == 1 and got[30009]["n_links"] == 0 and got[30010]["n_links"] == 0


def test_no_vectors(spark):
    schema = "vec_id long, embedding array<float>"
    assert embedding_dedup.near_duplicates(spark.createDataFrame([], schema)).count() == 0
    got = embedding_dedup.near_duplicates(spark.createDataFrame([(1, None), (2, [1.0])], schema)).collect()
    assert {(r["vec_id"], r["n_links"], r["component_id"], r["kept"]) for r in got} == {(1, 0, 1, True), (2, 0, 2, True)}


# 13 --------------------------------------------------------------------------------------------


def audited_rows(seed: int) -> tuple[list[tuple], list[tuple]]:
    dice = random.Random(seed)
    words = ["alpha", "beta", "GAMMA", "d#lta", "e", "Ä", "x\u0085y", " "]
    texts = [" ".join(dice.choice(words[: dice.randint(1, 8)]) for _ in range(dice.choice([0, 3, 150, 260]))) for _ in range(30)]
    texts += [None, "", " \t\n\x0b\x0c\r", "A" * 300, " ".join(f"w{k}" for k in range(400))]
    rows = [(dice.choice([None, *range(60)]), dice.choice(texts), dice.choice(["p", "q", None, ""])) for _ in range(150)]
    rows += [rows[0]] * 3
    labels = [(k, dice.choice([0, 1, None]), dice.choice([0, 1, None])) for k in range(0, 60, 2)] + [(2, 1, 0), (None, 1, 1)]
    return rows, labels


def brute_audit(rows, labels):
    good = {d for d, q, _ in labels if d is not None and q == 1}
    toxic = {d for d, _, t in labels if d is not None and t == 1}
    first: dict[str, int] = {}
    for d, t, _ in rows:
        if d is not None:
            first[t or ""] = min(d, first.get(t or "", d))
    docs = []
    for d, t, s in rows:
        t = t or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        fails = {"A": len(w) < 200, "B": 100 * len(set(w)) < 50 * len(w), "C": 100 * len(re.findall("[A-Z]", t)) > 2 * len(t), "D": bool(re.search(r"[#$%&*|]", t)), "E": d is not None and d > first[t]}
        docs.append((s or "", fails, d in good, d in toxic))
    out, removed_by = {}, {}
    for part in {p for p, *_ in docs}:
        own = [x for x in docs if x[0] == part]
        for order in ("".join(p) for p in permutations("ABCDE")):
            left = own
            for k, f in enumerate(order, 1):
                gone, stay = [x for x in left if x[1][f]], [x for x in left if not x[1][f]]
                fail = sum(x[1][f] for x in own)
                only = sum(x[1][f] and sum(x[1].values()) == 1 for x in own)
                out[part, order, k] = [len(stay), len(gone), fail - len(gone), only, sum(x[2] for x in gone), sum(x[3] for x in gone)]
                removed_by[part, f] = removed_by.get((part, f), 0) + len(gone)
                left = stay
    return {(p, o, k, *v, removed_by[p, o[k - 1]]) for (p, o, k), v in out.items()}


def test_filter_audit_matches_brute_force(spark):
    rows, labels = audited_rows(3)
    docs = spark.createDataFrame([(d, t, s, "n", 1, "h") for d, t, s in rows], "doc_id long, text string, source string, n string, cell int, h string").repartition(3)
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = [tuple(r) for r in filter_audit.audit(docs, marks).collect()]
    want = brute_audit(rows, labels)
    assert len(got) == len(want) == len({p or "" for *_, p in rows}) * 600 and set(got) == want
    assert filter_audit.audit(docs.limit(0), marks).count() == 0
    assert {r["good_lost"] + r["toxic_lost"] for r in filter_audit.audit(docs, marks.limit(0)).collect()} == {0}


# 3, 7: a plain call and plain sets in place of caches and filters ---------------------------------


def test_window_savings_match_a_plain_call(spark):
    import zstandard

    from tractlake.llm import toxicity
    from tractlake.llm.common import labelled_texts

    data = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{data}/documents.parquet"), spark.read.parquet(f"{data}/labels.parquet")
    model = toxicity.fit_on(docs, labels)
    texts = labelled_texts(docs, labels, "toxic", 20)

    def saved(window):
        raw = f" {window} ".encode() + model.ordinary[-toxicity.TRAIL_BYTES :]
        sizes = []
        for content in (model.ordinary, model.toxic + model.ordinary):
            book = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            how = zstandard.ZstdCompressionParameters(window_log=15, hash_log=14, chain_log=14, search_log=8, min_match=6, target_length=256, strategy=zstandard.STRATEGY_GREEDY, write_content_size=False, write_checksum=False, write_dict_id=False)
            sizes.append(len(zstandard.ZstdCompressor(dict_data=book, compression_params=how).compress(raw)))
        return max(toxicity.LOW, min(toxicity.HIGH, sizes[0] - sizes[1]))

    for text in [*texts[0], *texts[1], "", "moron moron x"]:
        want = np.zeros(toxicity.HIGH - toxicity.LOW + 1)
        for w in toxicity.windows(text):
            want[saved(w) - toxicity.LOW] += 1
        assert np.allclose(toxicity.Savings(model).count(text), np.log1p(want))


def test_language_counts_match_plain_sets(spark, monkeypatch):
    from tractlake.llm import language

    dice = random.Random(8)
    words = {x: ["".join(dice.choice(letters) for _ in range(dice.randint(2, 6))) for _ in range(60)] for x, letters in (("a", "abcdexyz"), ("b", "defghxyz"), ("c", "éèêëabx"))}
    texts = [(k, " ".join(dice.choice(words[x]) for _ in range(120)), x) for k, x in enumerate("abc" * 20)]
    model = language.fit_on(spark.createDataFrame(texts, "doc_id long, text string, lang string"))
    learned = [(t, x) for k, t, x in texts if zlib.crc32(str(k).encode()) % 4 != 2]
    grams = {x: {} for x in "abc"}
    for t, x in learned:
        for g in language.grams(language.codes_of(t)).tolist():
            grams[x][g] = grams[x].get(g, 0) + 1
    total = {x: sum(c.values()) for x, c in grams.items()}
    often = {x: {g: n / total[x] for g, n in c.items() if n >= language.LEAST} for x, c in grams.items()}
    own = {x: {g for g, s in often[x].items() if s >= language.SHARE * max(o.get(g, 0) for o in often.values())} for x in often}
    for _, t, x in texts:
        found = language.grams(language.codes_of(t))
        counts = dict(zip(model.languages, model.count(found), strict=True))
        for y in "abc":  # the filter finds all of a language's grams and, corrected, hardly any other
            exact = sum(g in own[y] for g in found.tolist())
            assert abs(counts[y] - exact) <= 2 + 0.01 * len(found)
        assert model.predict(t)[0] == x == max("abc", key=lambda y: sum(g in own[y] for g in found.tolist()))


# 2: against the exact optimum -----------------------------------------------------------------------


def fewest_bins(lengths, capacity):
    """The least number of bins, by trying sets of pieces that fill a bin together with the largest one left."""
    from functools import cache

    @cache
    def least(left):
        if not left:
            return 0
        first, rest = left[-1], left[:-1]
        best = len(left)
        for picked in range(1 << len(rest)):
            some = [x for k, x in enumerate(rest) if picked >> k & 1]
            if first + sum(some) <= capacity:
                best = min(best, 1 + least(tuple(x for k, x in enumerate(rest) if not picked >> k & 1)))
        return best

    return least(tuple(sorted(lengths)))


def test_bins_are_as_few_as_can_be(spark):
    from collections import Counter

    from tractlake.llm import packing

    dice, more = random.Random(12), 0
    for _ in range(150):
        capacity = dice.choice([10, 23, 60])
        lengths = [dice.randint(1, capacity) for _ in range(dice.randint(1, 9))]
        plan = packing.plan_bins(dict(Counter(lengths)), capacity)
        more += plan[-1][0] + plan[-1][1] - fewest_bins(lengths, capacity)
        assert plan[-1][0] + plan[-1][1] <= fewest_bins(lengths, capacity) + 1
    assert more <= 3
