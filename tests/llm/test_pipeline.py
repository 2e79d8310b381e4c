"""The pipeline on a small table: each stage's decisions take effect, and clean documents get through."""

import random

import corpus_pipeline
from tractlake.llm import registry


def test_pipeline_keeps_clean_documents(spark, tmp_path):
    dice = random.Random(3)
    prose = lambda n: " ".join("".join(dice.choice(["th", "on", "er", "ion"]) + str(dice.randint(0, 99)) for _ in range(2)) for _ in range(n)) + "."
    rows = [(i, "\n".join(prose(15) for _ in range(6)), "en", "a") for i in range(30)]
    passage = prose(60)
    rows += [(100, rows[0][1], "en", "a"), (101, rows[1][1].replace("th", "th", 1) + " x", "en", "a"), (102, prose(40) + "\n" + passage, "en", "a"), (103, prose(40) + "\n" + passage, "en", "a"), (104, None, None, None), (105, "too short", "en", "a")]
    spark.createDataFrame([(*r, len(r[1] or "")) for r in rows], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    names, last = docs.columns, None
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, str(tmp_path)).write.parquet(str(tmp_path / str(k)))
        docs = spark.read.parquet(str(tmp_path / str(k)))
        if k < 4:
            assert docs.columns == names
            last = {r["doc_id"]: r["text"] for r in docs.collect()}
            assert set(range(30)) <= set(last)
    assert not {100, 104, 105} & set(last) and {102, 103} <= set(last)
    assert passage in last[102] and passage not in last[103]
    assert {r["doc_id"] for r in corpus_pipeline.run(spark, str(tmp_path)).collect()} == set(last)


def test_stages_on_no_rows_and_on_columns_of_any_name(spark, tmp_path):
    names = ["h", "doc", "maybe", "kept", "gone", "text__", "h__", "length", "key"]
    schema = "doc_id long, text string, n_chars long, " + ", ".join(f"`{n}` string" for n in names)
    spark.createDataFrame([(0, 1, 0), (1, 0, 1)], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    words = [" ".join(f"word{i}x{k}" for k in range(40)) + "." for i in range(6)]
    rows = [(i, w, len(w), *[f"{n}{i}" for n in names]) for i, w in enumerate([*words, words[2]])] + [(None, words[5], 9, *names), (9, None, None, *names)]
    for some in ([], rows):
        docs = spark.createDataFrame(some, schema)
        for _, stage in corpus_pipeline.STAGES[:4]:
            out = stage(spark, docs, str(tmp_path))
            assert out.columns == docs.columns
            kept = out.collect()
            assert {r["doc_id"] for r in kept} <= {r[0] for r in some}
            assert all(r[n] == f"{n}{r['doc_id']}" for r in kept if r["doc_id"] in range(7) for n in names)
            docs = spark.createDataFrame(kept, schema)
        assert [r["doc_id"] for r in kept if r["doc_id"] == 6] == []
        assert len(stage_rows := corpus_pipeline.STAGES[4][1](spark, docs, str(tmp_path)).collect()) == len(kept), stage_rows


def test_each_dealt_operator_has_a_query():
    names = list(registry.QUERIES)
    assert all(sum(n.startswith(f"op{k}_") for n in names) == 1 for k in range(1, 11)) and "pipeline" in names
