"""Corpus operators against brute force on small tables with every odd case."""

from __future__ import annotations

import base64
import hashlib
import math
import os
import random
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pandas as pd
import pytest
import public_tokenizers
import tiktoken
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tractlake.llm import byte_bpe, causal_lm, components, jaccard, language, line_dedup, lm_scoring, packing, quality, suffix_dedup, suffixes, topk, toxicity
from tractlake.llm.common import held_out

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, length long, key string, h string"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def odd_texts() -> list[tuple[int | None, str | None]]:
    dice = random.Random(5)
    word = lambda: "".join(dice.choice(["th", "on", "er", "ion", "que", "ä"]) for _ in range(dice.randint(1, 4)))
    prose = lambda n: " ".join(word() for _ in range(n))
    page = "\n".join(prose(30) for _ in range(8))
    passage = prose(60)
    near = page.split(" ")
    near[10] = near[40] = "changed"
    rows = [
        (1, page),
        (2, page),
        (3, " ".join(near)),
        (4, prose(40) + "\n" + passage + "\n" + prose(30)),
        (5, passage + " " + prose(50)),
        (6, None),
        (7, ""),
        (8, "  \n\t \n"),
        (9, "one two"),
        (10, "one two"),
        (11, "One TWO"),
        (12, "a\n\n\na\nb\nc\na\nb\nc\nd"),
        (13, "日本語 テキスト 😀😀 é é İ Σς ﬁ"),
        (14, "x" * 5000),
        (15, prose(9000)),
        (16, "a  b   c \r\n it's we'll don't 12345 !!?? \x1c\x0b\x0c end "),
        (17, "ab" * 300 + " tail"),
        (None, page),
        (18, passage),
        (18, passage),
        (19, ("word " * 40).strip()),
        (20, "\u0085 \xa0 　 odd spaces"),
        (100, page[:400]),
        (21, page[200:700]),
        (22, "a <|endoftext|> b<|startoftext|><|ENDOFTEXT|>\u212a <|endoftext|"),
    ]
    return rows


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame([(d, t, "en", "s", len(t or ""), 1, "k", "h") for d, t in odd_texts()], SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def rows_of(df):
    return df.collect()


# 1 ---------------------------------------------------------------------------------------------


def brute_lines(docs, least):
    lines = {d: [x for x in (t or "").split("\n")] for d, t in docs}
    words = {d: [x for x in v if WORD.search(x)] for d, v in lines.items()}
    seen, gone = set(), {d: set() for d in lines}
    for d in sorted(words):
        for i in range(len(words[d]) - least + 1):
            run = tuple(words[d][i : i + least])
            if run in seen:
                gone[d].update(range(i, i + least))
            seen.add(run)
    out = {}
    for d, every in lines.items():
        k, kept = 0, []
        for x in every:
            if WORD.search(x):
                if k not in gone[d]:
                    kept.append(x)
                k += 1
            else:
                kept.append(x)
        out[d] = (len(words[d]), len(gone[d]), "\n".join(kept))
    return out


@pytest.mark.parametrize("least", [1, 2, 3, 4])
def test_line_runs_match_brute_force(spark, odd, least):
    want = brute_lines({(d, t) for d, t in odd_texts() if d is not None}, least)
    got = rows_of(line_dedup.digest(odd, least))
    assert len(got) == len(odd_texts())
    for r in got:
        if r["doc_id"] is None:
            assert r["n_removed"] == 0
            continue
        n, gone, kept = want[r["doc_id"]]
        assert (r["n_lines"], r["n_removed"], r["kept_sha256"]) == (n, gone, hashlib.sha256(kept.encode()).hexdigest())


@pytest.mark.parametrize("least, enough", [(3, 50), (3, 20), (5, 70)])
def test_long_passages_of_few_lines_match_brute_force(spark, odd, least, enough):
    dice = random.Random(8)
    prose = lambda n: " ".join(f"{dice.choice('abcdefgh')}{dice.randint(0, 99)}" for _ in range(n))
    one, two, four, short = prose(60), prose(30) + "\n" + prose(30), "\n".join(prose(18) for _ in range(4)), prose(8)
    extra = [(200 + k, "\n".join([prose(12), part, prose(9)] if k % 2 else [prose(12), part])) for k, part in enumerate([one, one, two, two, four, four, short, short])]
    df = odd.unionByName(spark.createDataFrame([(d, t, "en", "s", len(t), 1, "k", "h") for d, t in extra], SCHEMA))
    lines = {d: [x for x in (t or "").split("\n") if WORD.search(x)] for d, t in {(d, t) for d, t in odd_texts() + extra if d is not None}}
    gone = {d: set() for d in lines}
    for size in range(1, least + 1):
        seen = set()
        for d in sorted(lines):
            for i in range(len(lines[d]) - size + 1):
                run = tuple(lines[d][i : i + size])
                if size == least or len(WORD.findall("\n".join(run))) >= enough:
                    if run in seen:
                        gone[d].update(range(i, i + size))
                    seen.add(run)
    got = {r["doc_id"]: r["n_removed"] for r in rows_of(line_dedup.digest(df, least, enough)) if r["doc_id"] is not None}
    assert got == {d: len(x) for d, x in gone.items()}
    if least == 3 and enough == 50:
        assert [got[200 + k] for k in (1, 3, 5, 7)] == [1, 2, 4, 0]


def test_passages_match_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{DATA}/documents.parquet'")
    want = con.execute(line_dedup.ORACLE["passages_line_dedup"]).fetchall()
    got = [tuple(r) for r in rows_of(line_dedup.passages_line_dedup(spark, DATA))]
    assert sorted(got) == sorted(want)


def test_line_removal_keeps_columns_and_empty_tables(odd, empty):
    assert line_dedup.remove_repeats(odd).columns == odd.columns
    assert {r["doc_id"]: r["text"] for r in rows_of(line_dedup.remove_repeats(odd)) if r["doc_id"] == 6} == {6: None}
    assert rows_of(line_dedup.digest(empty)) == []


# 2 ---------------------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def word_ids():
    t = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    return {(d, x): np.asarray([*t.encode(x or "", add_special_tokens=False).ids, 0], "<u4") for d, x in odd_texts()}


@pytest.mark.parametrize("capacity", [64, 2048])
def test_packing_is_whole_and_gapless(odd, word_ids, capacity):
    got = rows_of(packing.pack_documents(odd, capacity))
    total = sum(len(x) for x in word_ids.values()) + len(word_ids[(18, dict(odd_texts())[18])])
    assert sum(r["length"] for r in got) == total
    by_crc = Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got)
    want = Counter((d, k, k * capacity, len(x[k * capacity : (k + 1) * capacity]), zlib.crc32(x[k * capacity : (k + 1) * capacity].tobytes())) for d, t in odd_texts() for x in [word_ids[(d, t)]] for k in range(-(-len(x) // capacity)))
    assert by_crc == want
    bins: dict[int, list] = {}
    for r in got:
        bins.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for b in bins.values():
        at = 0
        for offset, length in sorted(b):
            assert offset == at
            at += length
        assert at <= capacity
    assert len(bins) <= math.ceil(total / capacity) + 1


def test_packing_plan_fills_bins():
    dice = random.Random(1)
    histogram = Counter(dice.randint(1, 100) for _ in range(5000))
    plan = packing.plan_bins(dict(histogram), 100)
    used = Counter()
    for _, times, chosen in plan:
        assert sum(k * n for k, n in chosen.items()) <= 100
        for k, n in chosen.items():
            used[k] += times * n
    assert used == histogram
    least = max(math.ceil(sum(k * n for k, n in histogram.items()) / 100), sum(n for k, n in histogram.items() if k > 50))
    assert plan[-1][0] + plan[-1][1] <= 1.01 * least


def test_packing_of_nothing(empty):
    assert rows_of(packing.pack_documents(empty)) == []


# 3, 7, 9: held-out accuracy on the given tables ---------------------------------------------------


DATA = os.environ.get("TEST_DATA_DIR", "/root/testdata/sf0.1")


def test_toxicity_on_held_out_rows(spark):
    got = toxicity.op3_toxicity(spark, DATA).join(spark.read.parquet(f"{DATA}/labels.parquet"), "doc_id").where("held_out").groupBy("toxic", "predicted").count().collect()
    n = {(r["toxic"], r["predicted"]): r["count"] for r in got}
    assert n.get((1, 1), 0) >= 0.75 * (n.get((1, 1), 0) + n.get((1, 0), 0))
    assert n.get((0, 1), 0) <= 0.01 * n[(0, 0)]


def test_language_on_held_out_rows(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "lang")
    got = language.op7_language(spark, DATA).join(docs, "doc_id").where("held_out").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("double"))).first()[0]
    assert got > 0.97


def test_quality_keeps_good_and_drops_bad(spark):
    labels = spark.read.parquet(f"{DATA}/labels.parquet")
    got = {r["quality"]: r["k"] for r in quality.op9_quality(spark, DATA).where("not base_failed").join(labels, "doc_id").groupBy("quality").agg(F.avg(F.col("kept").cast("double")).alias("k")).collect()}
    assert got[1] > 0.98 and got[0] < 0.1


def test_mixed_documents_get_the_share_of_their_content(spark):
    docs, labels = spark.read.parquet(f"{DATA}/documents.parquet"), spark.read.parquet(f"{DATA}/labels.parquet")
    model = quality.fit_on(docs, labels)
    some = lambda y: [r["text"] for r in docs.join(labels.where(F.col("quality") == y), "doc_id").orderBy("doc_id").limit(60).collect()]
    lines = lambda t: [x for x in t.split("\n") if x.strip()]
    size = lambda x: sum(len(re.sub(r"[\x20\x09-\x0D]", "", y)) for y in x)
    off, between, n = [], 0, 0
    for good, bad in zip(some(1), some(0), strict=False):
        prose, menu = lines(good)[:12], lines(bad)[:6]
        half = len(prose) // 2
        share = model.content_share("\n".join(prose[:half] + menu + prose[half:]))
        off.append(abs(share - size(prose) / (size(prose) + size(menu))))
        between, n = between + (0 < share < 1), n + 1
    assert n == 60 and between >= 0.9 * n and sum(off) / n < 0.08
    assert model.content_share(some(1)[0]) > 0.95


def test_models_on_odd_rows(spark, odd, empty):
    labels = spark.createDataFrame([(d, d % 2, d % 2) for d in (1, 4, 5, 6, 15, 16, 19)], "doc_id long, quality int, toxic int")
    scored = rows_of(toxicity.score(odd, toxicity.fit_on(odd, labels)))
    assert len(scored) == len(odd_texts()) and all(0 <= r["score"] <= 1 for r in scored)
    assert toxicity.fit_on(odd, labels.where("toxic = 1")) is None
    assert {r["score"] for r in rows_of(toxicity.score(odd, None))} == {0.0}
    spoken = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in rows_of(language.predict(odd, language.fit_on(odd)))}
    assert spoken[6] == spoken[7] == spoken[8] == ("und", 0.0) and spoken[15][0] == "en"
    assert {r["lang_pred"] for r in rows_of(language.predict(odd, language.fit_on(empty)))} == {"und"}
    for f in (lambda d: toxicity.score(d, None), lambda d: language.predict(d, language.learn({})), lambda d: quality.judge(d, None)):
        assert rows_of(f(empty)) == []


def test_language_masks_of_many_languages():
    dice = random.Random(6)
    words = [["".join(dice.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(5)) for _ in range(30)] for _ in range(70)]
    texts = {f"l{k:02}": [" ".join(dice.choice(w) for _ in range(200)) for _ in range(3)] for k, w in enumerate(words)}
    model = language.learn({x: (*language.counted(some), sum(len(language.grams(language.codes_of(t))) for t in some)) for x, some in texts.items()})
    assert model.slots.shape[1] == 9
    for k, w in enumerate(words):
        got, score = model.predict(" ".join(dice.choice(w) for _ in range(60)))
        assert got == f"l{k:02}" and 0 < score <= 1
    grams = language.grams(language.codes_of(texts["l69"][0]))
    masks = model.languages_of(grams)
    want = [sum(int(m[k // 8]) >> k % 8 & 1 for m in masks) for k in range(70)]
    assert model.hits(masks).tolist() == want


def test_columns_of_any_name_stay_as_they_are(spark):
    names = ["h", "doc", "gone", "kept", "maybe", "whole", "spot", "h__", "text__", "all", "rank", "length"]
    texts = ["a b c d e f g h i j k l m\nline two is here\nline three is here\nlast one", "own words of the second document stay here always", "a b c d e f g h i j k l m\nline two is here\nline three is here\nlast one"]
    df = spark.createDataFrame([(i, t, *[f"{n}{i}" for n in names]) for i, t in enumerate(texts)], "doc_id long, text string, " + ", ".join(f"`{n}` string" for n in names))
    for f in (line_dedup.remove_repeats, jaccard.keep_one, suffix_dedup.remove_repeats, lambda d: quality.keep_good(d, None)):
        out = f(df)
        assert out.columns == df.columns
        assert all(r[n] == f"{n}{r['doc_id']}" for r in rows_of(out) for n in names)


def brute_quality(text):
    words = WORD.findall(text or "")
    windows = Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    inside = set()
    for i in range(len(words) - 4):
        if windows[tuple(words[i : i + 5])] > 1:
            inside.update(range(i, i + 5))
    seen, dup = set(), 0
    for x in (text or "").split("\n"):
        if WORD.search(x):
            dup += x in seen
            seen.add(x)
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), dup, len(inside)


def test_quality_counts_match_brute_force(odd):
    texts = dict(odd_texts())
    for r in rows_of(quality.judge(odd, None)):
        want = brute_quality(texts[r["doc_id"]])
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == want
        assert r["base_failed"] == (want[0] < 10 or 100 * want[4] > 20 * want[0]) and r["kept"] == (not r["base_failed"])


def test_viterbi_finds_the_best_sequence():
    dice = np.random.default_rng(3)
    for _ in range(20):
        model = quality.LineField(dice.normal(size=(quality.FEATURES, 2)), dice.normal(size=(2, 2)))
        x = dice.normal(size=(6, quality.FEATURES))
        scores = x @ model.emit
        best = max((sum(scores[i, y >> i & 1] for i in range(6)) + sum(model.move[y >> i & 1, y >> (i + 1) & 1] for i in range(5)), y) for y in range(64))[1]
        assert model.decode(x).tolist() == [best >> i & 1 for i in range(6)]


# 4 ---------------------------------------------------------------------------------------------


def test_byte_bpe_equals_the_library(odd, empty):
    with open(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    enc = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    texts = dict(odd_texts())
    for r in rows_of(byte_bpe.digest(odd)):
        text = texts[r["doc_id"]] or ""
        ids = enc.encode_ordinary(text)
        assert (r["n_tokens"], r["ids_sha256"]) == (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest())
        assert r["decoded_sha256"] == hashlib.sha256(text.encode()).hexdigest()
    back = {r["doc_id"]: bytes(r["decoded"]) for r in rows_of(byte_bpe.decode(byte_bpe.encode(odd)))}
    assert all(back[d] == (t or "").encode() for d, t in texts.items())
    assert rows_of(byte_bpe.digest(empty)) == []


# 5 ---------------------------------------------------------------------------------------------


def test_top_k_matches_brute_force(spark, monkeypatch):
    monkeypatch.setattr(topk, "VECTORS_A_BLOCK", 64)
    monkeypatch.setattr(topk, "QUERIES_A_PART", 2)
    monkeypatch.setattr(topk, "STEP", 8)
    dice = np.random.default_rng(2)
    rows = [(int(i), [float(x) for x in dice.normal(size=5)], 1) for i in range(400)]
    rows += [(400, [1.0, None, 0.0, 0.0, 0.0], 1), (500, None, 1), (600, [float("nan")] * 5, 1), (700, [float("inf")] * 5, 1), (800, [], 1), (900, [0.5, 0.5], 1), (901, [0.25, 0.5], 1), (None, [1.0] * 5, 1), (7, rows[7][1], 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, score int")
    vectors = topk.to_integers(df)
    points = topk.choose_pivots(vectors, 6)
    table = topk.pivot_table(vectors, points)
    got = {(r["query_id"], r["rank"]): (r["vec_id"], r["score"]) for r in rows_of(topk.top_k(table, table.where("vec_id % 100 = 0").dropDuplicates(["vec_id"]), points, 10))}
    ints = [(i, [math.floor(1024 * x) for x in v]) for i, v, _ in rows if i is not None and v and all(x is not None and math.isfinite(x) for x in v)]
    want = {}
    for q, v in ints:
        if q % 100 == 0:
            best = sorted((-sum(a * b for a, b in zip(v, w, strict=True)), i) for i, w in ints if i != q and len(w) == len(v))[:10]
            want |= {(q, k): (i, -s) for k, (s, i) in enumerate(best, 1)}
    assert got == want
    none = vectors.where("vec_id < 0")
    assert rows_of(topk.top_k(topk.pivot_table(none, topk.choose_pivots(none)), topk.pivot_table(none, points), points, 10)) == []


def test_ties_and_large_components(spark):
    rows = [(i, [3.0e6 + (i % 5), -2.5e6, 4.0e6, 1.0e6 + i // 50]) for i in range(300)]  # sums beyond 2**53, many equal scores
    rows += [(1000 + i, [4.0e9 + i % 3, 4.0e9, -1.0, 0.5]) for i in range(120)]  # beyond 2**63
    for part in (rows[:300], rows):
        df = spark.createDataFrame(part, "vec_id long, embedding array<double>")
        vectors = topk.to_integers(df)
        points = topk.choose_pivots(vectors, 4)
        table = topk.pivot_table(vectors, points)
        ints = {i: [math.floor(1024 * x) for x in v] for i, v in part}
        fits = all(abs(sum(a * b for a, b in zip(ints[i], ints[j], strict=True))) < 2**63 for i in ints for j in ints if i % 100 == 0)
        if not fits:
            continue
        got = {(r["query_id"], r["rank"]): (r["vec_id"], r["score"]) for r in rows_of(topk.top_k(table, table.where("vec_id % 100 = 0"), points, 10))}
        want = {}
        for q in ints:
            if q % 100 == 0:
                best = sorted((-sum(a * b for a, b in zip(ints[q], w, strict=True)), i) for i, w in ints.items() if i != q)[:10]
                want |= {(q, k): (i, -x) for k, (x, i) in enumerate(best, 1)}
        assert got == want


def test_queries_reach_few_blocks_of_clustered_vectors(spark, monkeypatch):
    monkeypatch.setattr(topk, "VECTORS_A_BLOCK", 50)
    dice = np.random.default_rng(3)
    centres = 8 * dice.normal(size=(12, 6))
    rows = [(int(i), [float(x) for x in centres[i % 12] + 0.05 * dice.normal(size=6)]) for i in range(1200)]
    vectors = topk.to_integers(spark.createDataFrame(rows, "vec_id long, embedding array<double>"))
    points = topk.choose_pivots(vectors, 12)
    placed, ranges = topk.in_blocks(topk.pivot_table(vectors, points), points)
    asking = placed.where("vec_id % 100 = 0").select("vec_id", "v", "d", "dim", F.lit(float("-inf")).alias("floor"))
    first = rows_of(topk.searched(placed, topk.asked_blocks(asking, ranges, 12, True), 10, points))
    least = {}
    for r in first:
        least[r["query_id"]] = min(least.get(r["query_id"], r["score"]), r["score"])
    floors = spark.createDataFrame([(q, float(x)) for q, x in least.items()], "vec_id long, floor double")
    asked = topk.asked_blocks(asking.drop("floor").join(floors, "vec_id").select("vec_id", "v", "d", "dim", "floor"), ranges, 12, False)
    assert len(ranges) >= 12 and asked.count() < 0.5 * len(least) * len(ranges)


# 6 ---------------------------------------------------------------------------------------------


def brute_sets(docs):
    out = {}
    for d, t in docs:
        w = WORD.findall((t or "").translate(LOWER))
        out[d] = {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())
    return out


def brute_components(sets):
    root = {d: d for d in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in sets:
        for b in sets:
            if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {d: find(d) for d in sets}


def test_jaccard_components_match_brute_force(spark, odd, empty, monkeypatch):
    monkeypatch.setattr(jaccard, "BLOCK", 20)
    dice = random.Random(8)
    docs = {d: t for d, t in odd_texts() if d is not None}
    shared = " ".join(f"s{k}" for k in range(40))
    for group in range(12):
        base = [f"w{dice.randint(0, 10**6)}" for _ in range(dice.randint(4, 220))]
        for k in range(dice.randint(1, 12)):
            copy = list(base)
            for _ in range(dice.randint(0, max(1, len(base) // 25))):
                copy[dice.randrange(len(copy))] = f"e{dice.randint(0, 10**6)}"
            docs[1000 + group * 50 + k] = " ".join(copy) + (" " + shared if group % 3 == 0 else "")
    for k in range(60):  # one large group of near copies, which fills several blocks
        words = [f"n{i}" for i in range(150)]
        words[k % 150] = f"x{k}"
        docs[5000 + k] = " ".join(words)
    df = spark.createDataFrame(list(docs.items()), "doc_id long, text string").repartition(5)
    sets = brute_sets(docs.items())
    want = brute_components(sets)
    got = rows_of(jaccard.near_duplicates(df))
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == {d: (len(sets[d]), want[d]) for d in docs}
    once = rows_of(jaccard.near_duplicates(odd))
    assert len(once) == len(odd_texts()) and [r["component_id"] for r in once if r["doc_id"] is None] == [None]
    kept = [r["doc_id"] for r in rows_of(jaccard.keep_one(odd))]
    assert sorted(x for x in kept if x is not None) == sorted({d for d, r in brute_components(brute_sets([x for x in odd_texts() if x[0] is not None])).items() if d == r})
    assert rows_of(jaccard.near_duplicates(empty)) == []


def test_no_link_is_lost_where_the_smallest_hashes_differ(spark, monkeypatch):
    dice = random.Random(5)
    words = lambda n: [f"w{dice.randrange(10**9)}" for _ in range(n)]
    base = words(951)
    hashes = [int(jaccard.shingle_sets([" ".join(base[i : i + 5])])[0][0]) for i in range(947)]
    other = base[:]
    for i in sorted(range(947), key=hashes.__getitem__)[:14]:  # each change takes the shingles around one of the smallest hashes
        other[i + 2] = f"z{i}"
    rows = [(1, " ".join(base)), (2, " ".join(other))]
    line = " ".join(words(60))
    rows += [(i, f"{line} {' '.join(words(dice.choice([3, 6, 10, 15, 20, 40])))}") for i in range(3, 150)]
    for block in (1000, 20):
        monkeypatch.setattr(jaccard, "BLOCK", block)
        got = {r["doc_id"]: r["component_id"] for r in rows_of(jaccard.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")))}
        assert got == brute_components(brute_sets(rows)) and got[2] == 1


def test_signature_tree_loses_no_pair():
    dice = np.random.default_rng(4)
    sets = []
    for _ in range(60):
        base = dice.integers(0, 2**63, 120, dtype=np.uint64)
        for _ in range(3):
            s = base.copy()
            s[: dice.integers(0, 20)] = dice.integers(0, 2**63, 1, dtype=np.uint64)
            sets.append(np.unique(s))
    bits = jaccard.folded([jaccard.bitmap(s) for s in sets])
    found = {tuple(sorted(p)) for p in jaccard.tree_pairs(np.array([len(s) for s in sets]), bits, np.arange(len(sets)))}
    for a in range(len(sets)):
        for b in range(a):
            common = len(np.intersect1d(sets[a], sets[b]))
            if 100 * common >= 80 * (len(sets[a]) + len(sets[b]) - common):
                assert (b, a) in found
    assert len(found) < len(sets) ** 2 / 8


def test_components_of_a_long_chain(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(90, 91), (91, 90), (95, 95)], "a long, b long")
    got = {r["node"]: r["root"] for r in rows_of(components.components(links))}
    assert got == {i: 0 for i in range(41)} | {90: 90, 91: 90}


# 8 ---------------------------------------------------------------------------------------------


def brute_bytes(docs):
    seen, out = {}, {}
    for d, t in sorted(docs, key=lambda x: x[0]):
        raw = (t or "").encode()
        gone = bytearray(len(raw))
        for i in range(len(raw) - 49):
            s = raw[i : i + 50]
            if seen.setdefault(s, d) < d:
                gone[i : i + 50] = b"\1" * 50
        runs = sum(1 for i in range(len(gone)) if gone[i] and (i == 0 or not gone[i - 1]))
        out[d] = (len(raw), sum(gone), runs, hashlib.sha256(bytes(b for b, g in zip(raw, gone, strict=True) if not g)).hexdigest())
    return out


def test_suffix_dedup_matches_brute_force(spark, odd, empty, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "SUFFIXES_A_BLOB", 50)
    monkeypatch.setattr(suffix_dedup, "ANCHORS_A_BLOB", 300)
    monkeypatch.setattr(suffix_dedup, "ANCHORS_A_BUCKET", 200)
    dice = random.Random(9)
    docs = [x for x in odd_texts() if x[0] is not None]
    pool = ["".join(dice.choice("abcd ") for _ in range(dice.randint(20, 140))) for _ in range(30)]
    docs += [(300 + k, "".join(dice.choice(pool) for _ in range(dice.randint(1, 6)))) for k in range(80)]
    want = brute_bytes(docs)
    got = rows_of(suffix_dedup.digest(spark.createDataFrame(docs, "doc_id long, text string").repartition(4)))
    assert len(got) == len(docs)
    for r in got:
        assert (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) == want[r["doc_id"]]
    assert [r["n_removed"] for r in rows_of(suffix_dedup.digest(odd)) if r["doc_id"] is None] == [0]
    assert rows_of(suffix_dedup.digest(empty)) == []
    left = suffix_dedup.remove_repeats(odd)
    assert left.columns == odd.columns and {r["doc_id"] for r in rows_of(left)} >= {1, 4, 9, 14, None}


def test_a_line_in_every_document_and_periodic_texts(spark, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "SUFFIXES_A_BLOB", 700)
    dice = random.Random(8)
    own = lambda n: "".join(dice.choice("abcdefgh ") for _ in range(n))
    line = own(90)
    docs = [(i, own(dice.randint(0, 120)) + line + own(dice.randint(0, 60))) for i in range(300)]
    docs += [(300 + i, dice.choice(["ab", "abc", "a"]) * dice.randint(20, 90) + own(dice.randint(0, 9))) for i in range(60)]
    docs += [(400, "x" * 49), (401, line + "\0" * 60), (402, "\0" * 55), (403, line[:49])]
    want = brute_bytes(docs)
    for r in rows_of(suffix_dedup.digest(spark.createDataFrame(docs, "doc_id long, text string").repartition(5))):
        assert (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) == want[r["doc_id"]], r["doc_id"]


def test_loser_tree_merges_front_coded_runs():
    dice = random.Random(2)
    for k in (1, 2, 3, 7):
        runs = []
        for i in range(k):
            texts = sorted(bytes(dice.choice(b"ab") for _ in range(dice.randint(0, 9))) for _ in range(dice.randint(1, 30)))
            pad = lambda xs, n: np.frombuffer(b"".join(x.ljust(n, b"\0") for x in xs), np.uint8).reshape(-1, n)
            n = len(texts)
            runs.append(suffixes.Suffixes(pad(texts, suffixes.WIDTH), np.array([len(t) for t in texts]), pad([b"l"] * n, suffixes.LEFT), np.ones(n, np.int64), np.full(n, i), np.full(n, -i), np.arange(n)))
        back = [suffixes.read_run(suffixes.front_code(r)) for r in runs]
        for r, (again, _) in zip(runs, back, strict=True):
            assert all((x == y).all() for x, y in zip(vars(r).values(), vars(again).values(), strict=True))
        order, shared = suffixes.merge_runs(back)
        every = suffixes.Suffixes.joined(runs)
        assert sorted(order.tolist()) == list(range(len(every)))
        assert every.keys()[0][order].tolist() == sorted(every.keys()[0].tolist())
        assert (shared == suffixes.shared_with_last(every.rows[order])).all()


# 10 --------------------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def small_model():
    """A vocabulary of 4,000 ids, more than are frequent, pairs of some texts, and weights that are nowhere zero."""
    dice = np.random.default_rng(1)
    counts = dice.integers(0, 50, 4000).astype(float)
    vocabulary = causal_lm.Vocabulary.of(counts, 7)
    texts = [dice.integers(0, 4000, n) for n in (0, 3, 32, 33, 90, 58, 59)]
    _, inputs, targets = causal_lm.framed(texts, 7, vocabulary)
    pairs = causal_lm.Pairs.of(causal_lm.pair_counts(inputs, vocabulary.slot[targets]))
    params = {k: (v + 0.2 * dice.standard_normal(v.shape)).astype(np.float64) for k, v in causal_lm.initial().items()}
    return vocabulary, pairs, params, texts


def test_language_model_is_a_distribution_with_right_gradients(small_model):
    vocabulary, pairs, params, texts = small_model
    window = vocabulary.inputs(np.arange(32))
    top = causal_lm.attend(params, np.tile(window, (1, 1)))["top"][5:6]
    slots = vocabulary.slot
    each = causal_lm.log_probabilities(params, pairs, np.repeat(top, 4000, 0), np.repeat(window[5:6], 4000), slots) / np.log(10) + np.where(slots < 0, vocabulary.rare_log10, 0)
    assert abs((10.0**each).sum() - 1) < 1e-4
    lengths, inputs, targets = causal_lm.framed(texts, 7, vocabulary)
    at, exists, scored = causal_lm.windows_of(lengths)
    assert sorted(at[scored].tolist()) == list(range(len(targets)))
    whole, there, _ = causal_lm.windows_of(lengths, 0)
    assert sorted(whole[there].tolist()) == list(range(len(targets)))  # training sees each target once
    loss, grads = causal_lm.gradients(params, pairs, inputs[at], slots[targets][at], exists)
    for name in params:
        i = np.unravel_index(np.abs(grads[name]).argmax(), grads[name].shape)
        moved = {k: v.copy() for k, v in params.items()}
        moved[name][i] += 1e-4
        assert abs((causal_lm.gradients(moved, pairs, inputs[at], slots[targets][at], exists)[0] - loss) / 1e-4 - grads[name][i]) < 1e-3


def plain_score(params, pairs, vocabulary, ids, end):
    """One text, target by target, with loops for the attention and whole softmaxes."""
    p, c, targets, total = params, causal_lm, [*ids.tolist(), end], 0.0
    inputs = [c.START_SLOT, *vocabulary.inputs(np.array(targets[:-1], np.int64)).tolist()]
    step = c.WINDOW - c.OVERLAP
    for t, target in enumerate(targets):
        first = 0 if t < c.WINDOW else ((t - c.WINDOW) // step + 1) * step
        x = np.stack([p["token"][inputs[k]] + p["place"][k - first] for k in range(first, t + 1)])
        scores = [float(x[-1] @ p["query"] @ (y @ p["key"])) * c.WIDTH**-0.5 for y in x]
        weights = np.exp(np.array(scores) - max(scores))
        z = sum(w * (y @ p["value"]) for w, y in zip(weights / weights.sum(), x, strict=True))
        mid = x[-1] + z @ p["out"]
        top = mid + np.maximum(mid @ p["up"], 0) @ p["down"]
        soft = lambda v: v - np.log(np.exp(v - v.max()).sum()) - v.max()
        slot = int(vocabulary.slot[target])
        kind = slot // c.CLASS_SIZE if slot >= 0 else c.CLASSES - 1
        total += soft(top @ p["class"] + p["class_bias"] + pairs.classes[inputs[t]])[kind] / math.log(10)
        if slot < 0:
            total += vocabulary.rare_log10[target]
        else:
            own = slice(kind * c.CLASS_SIZE, (kind + 1) * c.CLASS_SIZE)
            total += soft(top @ p["member"][kind] + p["member_bias"][kind] + pairs.members[inputs[t], own])[slot % c.CLASS_SIZE] / math.log(10)
    return total


def test_window_scores_match_plain_loops(small_model):
    vocabulary, pairs, params, texts = small_model
    got = causal_lm.score(params, pairs, vocabulary, texts, 7)
    assert np.allclose(got, [plain_score(params, pairs, vocabulary, t, 7) for t in texts], rtol=1e-4)


@pytest.mark.parametrize("common", [0, 5, 1 << 19])
def test_base_scores_match_brute_force(odd, monkeypatch, common):
    monkeypatch.setattr(lm_scoring, "COMMON_WORDS", common)
    monkeypatch.setattr(lm_scoring, "common_words", lambda counts, most=common, f=lm_scoring.common_words: f(counts, most))
    tokens = [(d, [*WORD.findall((t or "").translate(LOWER)), "\0"]) for d, t in odd_texts()]
    out = lambda d: d is None or zlib.crc32(str(d).encode()) % 7 == 2
    count = Counter(w for d, ws in tokens if not out(d) for w in ws)
    n, v = sum(count.values()), len(count)
    want = sorted((str(d), out(d), len(ws), sum(count[w] > 0 for w in ws), n, round(sum(math.log10((count[w] + 1) / (n + v + 1)) for w in ws), 6)) for d, ws in tokens)
    got = rows_of(lm_scoring.base_scores(lm_scoring.with_key(odd)))
    assert sorted((str(r["doc_id"]), r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 6)) for r in got) == want


def test_pair_counts_are_smoothed_in_tasks(spark, monkeypatch):
    """The driver gets a packed row for each slot, no row for each pair, and the shares are those of the whole table of counts."""
    docs = spark.createDataFrame([(i, f"text {i} of the {i % 7}th kind, " * (i % 5)) for i in range(300)], "doc_id long, text string")
    encoded = lm_scoring.subword_ids(lm_scoring.with_key(docs), public_tokenizers.path(lm_scoring.TOKENIZER)).localCheckpoint()
    vocabulary = causal_lm.Vocabulary.of(lm_scoring.id_counts(encoded), lm_scoring.END_ID)
    _, inputs, targets = causal_lm.framed([np.frombuffer(r["ids"], "<u2") for r in encoded.where("not held_out").collect()], lm_scoring.END_ID, vocabulary)
    counts = causal_lm.pair_counts(inputs, vocabulary.slot[targets])
    want, frames = causal_lm.Pairs.of(counts), []
    plain = type(encoded).toPandas
    monkeypatch.setattr(type(encoded), "toPandas", lambda df: frames.append(plain(df)) or frames[-1])
    got = lm_scoring.pairs_of(encoded, vocabulary)
    assert np.array_equal(got.classes, want.classes) and np.array_equal(got.members, want.members)
    assert {tuple(f.columns) for f in frames} == {("target", "n"), ("input", "classes", "members")}
    assert max(map(len, frames)) < (counts > 0).sum()


def test_each_training_document_trains_once(spark, monkeypatch):
    docs = spark.createDataFrame([(i, f"text {i}") for i in range(400)], "doc_id long, text string")
    encoded = lm_scoring.subword_ids(lm_scoring.with_key(docs), public_tokenizers.path(lm_scoring.TOKENIZER))
    trained = spark.sparkContext.accumulator(0)

    def seen(sent, params, rate, number):
        def learn(group):
            trained.add(len(group))
            return pd.DataFrame({"name": pd.Series([], dtype=str), "values": pd.Series([], dtype=object)})

        return learn

    monkeypatch.setattr(lm_scoring, "local_training", seen)
    monkeypatch.setattr(lm_scoring, "GROUP_TOKENS", 50)  # as of a large table
    lm_scoring.train(encoded)
    assert trained.value == encoded.where("not held_out").count() > 0


def test_model_beats_the_word_base_on_held_out_rows(spark):
    got = lm_scoring.op10_lm_scoring(spark, os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")).where("held_out").agg(F.sum("score").alias("score"), F.sum("base_score").alias("base")).first()
    assert got["score"] > got["base"]


def test_language_model_scores_every_row(odd, empty):
    got = rows_of(lm_scoring.score(odd))
    assert len(got) == len(odd_texts()) and all(r["score"] < 0 and math.isfinite(r["score"]) for r in got)
    assert rows_of(lm_scoring.score(empty)) == []


def test_held_out_rule(spark):
    rows = spark.range(200).withColumn("out", held_out("id", 7, 2)).collect()
    assert all(r["out"] == (zlib.crc32(str(r["id"]).encode()) % 7 == 2) for r in rows)
