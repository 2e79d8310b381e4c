"""Filter interaction audit: what each filter removes in every order of the filters, from one contingency tensor for each part.

A document fails or passes each of five filters, so it falls into one of 2 x 2 x 2 x 2 x 2 cells. Spark counts the documents of each part by
cell, and separately those of good quality and the toxic ones. Whatever an order of the filters removes, keeps or removes twice is then a
contraction of that tensor: along each axis a step takes the passing slice, the failing slice, or both ("all"), and one einsum over
the selectors of all steps gives every count. No order is ever run over the documents.

Filters (words: maximal runs of `[^\\x20\\x09-\\x0D]`, case-sensitive): A fewer than 200 words; B less than half of the words distinct; C more than 2 % of
the code points in A-Z; D holds one of `#$%&*|`; E identical to the text of a row with a smaller doc_id.

Defined results: a null text is empty, a null source is the empty part; empty texts are equal to each other; rows without doc_id are nobody's
earlier copy and have none; repeated rows count each, and are no copies of one another; a document is good or toxic if any of its labels
says so, and rows without doc_id have no labels; an empty table gives no rows; extra columns are not looked at.
"""

from __future__ import annotations

from itertools import permutations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tractlake.llm.common import small_batches, table

FILTERS = "ABCDE"
LEAST_WORDS, MARKS = 200, "[#$%&*|]"
GAPS = r"[\x20\x09-\x0D]+"
MEASURES = ("n", "good", "toxic")
PASS, FAIL, ALL = (1, 0), (0, 1), (1, 1)
SCHEMA = "part string, filter_order string, step int, kept long, removed long, redundant long, unique_fails long, good_lost long, toxic_lost long, shapley long"


def failures(text: Column) -> list[Column]:
    """For one text, which of the filters A to D it fails."""
    words = F.filter(F.split(text, GAPS), lambda w: w != "")
    counts = F.transform(F.array(words), lambda w: F.struct(F.size(w).alias("n"), F.size(F.array_distinct(w)).alias("d")))[0]
    return [counts["n"] < LEAST_WORDS, 100 * counts["d"] < 50 * counts["n"], 100 * F.regexp_count(text, F.lit("[A-Z]")) > 2 * F.length(text), text.rlike(MARKS)]


def flagged(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """part, doc_id, h (the text's hash), cell (a bit for each filter from A on, E still missing), good and toxic; no texts go further."""
    text = F.coalesce("text", F.lit(""))
    bits = sum((F.when(f, 1 << i).otherwise(0) for i, f in enumerate(failures(text))), F.lit(0))
    slim = docs.select(F.coalesce("source", F.lit("")).alias("part"), F.col("doc_id").cast("long"), F.sha2(text, 256).alias("h"), bits.alias("cell"))
    said = labels.where(F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic"))
    return slim.join(said, "doc_id", "left").na.fill(0, ["good", "toxic"])


def tensors(rows: DataFrame) -> DataFrame:
    """part and, for each measure, its counts in the 32 cells.

    Only equal rows of one text, part and label are brought together, after counting inside tasks: a text in a third of all rows is a few
    rows by then, one for each part and label, and E follows from the smallest doc_id among these.
    """
    like = ["h", "part", "cell", "good", "toxic"]
    ids = rows.groupBy(*like, "doc_id").agg(F.count("*").alias("n"))
    groups = ids.groupBy(*like).agg(F.sum("n").alias("n"), F.min(F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", "n"))).alias("first"), F.sum(F.when(F.col("doc_id").isNull(), F.col("n")).otherwise(0)).alias("nameless"))
    least = groups.groupBy("h").agg(F.min("first.doc_id").alias("least"))
    groups = groups.join(least, "h")
    passing = F.col("nameless") + F.when(F.col("first.doc_id") == F.col("least"), F.col("first.n")).otherwise(0)
    for name, value in (("n0", passing), ("n1", F.col("n") - passing)):
        groups = groups.withColumn(name, value)
    cells = groups.select("part", "good", "toxic", F.explode(F.array(F.struct(F.col("cell").alias("cell"), F.col("n0").alias("n")), F.struct((F.col("cell") + 16).alias("cell"), F.col("n1").alias("n")))).alias("c"))
    cells = cells.groupBy("part", "c.cell").agg(F.sum("c.n").alias("n"), F.sum(F.col("c.n") * F.col("good")).alias("good"), F.sum(F.col("c.n") * F.col("toxic")).alias("toxic"))
    filled = F.map_from_entries(F.collect_list(F.struct("cell", F.struct(*MEASURES))))  # 32 entries at most
    every = cells.groupBy("part").agg(filled.alias("m"))
    return every.select("part", *[F.array(*[F.coalesce(F.element_at("m", F.lit(i))[x], F.lit(0)) for i in range(32)]).alias(x) for x in MEASURES])


def selectors() -> tuple[list[tuple[str, int]], dict[str, np.ndarray]]:
    """Every step of every order, and for each kind of count what each step takes along each axis: (steps, axes, 2)."""
    steps = [("".join(p), k) for p in permutations(FILTERS) for k in range(1, 6)]
    kinds = {"kept": [], "removed": [], "failing": [], "unique_fails": []}
    for order, k in steps:
        own, before = order[k - 1], order[: k - 1]
        kinds["kept"].append([PASS if f == own or f in before else ALL for f in FILTERS])
        kinds["removed"].append([FAIL if f == own else PASS if f in before else ALL for f in FILTERS])
        kinds["failing"].append([FAIL if f == own else ALL for f in FILTERS])
        kinds["unique_fails"].append([FAIL if f == own else PASS for f in FILTERS])
    return steps, {name: np.array(v, np.int64) for name, v in kinds.items()}


def contract(counts: np.ndarray, takes: np.ndarray) -> np.ndarray:
    """(parts, 2, 2, 2, 2, 2) counts, contracted with each step's selectors: (parts, steps)."""
    path = ["einsum_path", (0, 5), (0, 4), (0, 3), (0, 2), (0, 1)]
    return np.einsum("pabcde,sa,sb,sc,sd,se->ps", counts, *[takes[:, i] for i in range(5)], optimize=path)


def audit_of(parts: pd.DataFrame) -> pd.DataFrame:
    """The rows of some parts, given their tensors."""
    steps, takes = selectors()
    # Cell bit i is filter i, so the last axis of the reshaped array is A; turned round, axis i is filter i.
    cube = {m: np.stack(parts[m].to_numpy()).astype(np.int64).reshape(-1, 2, 2, 2, 2, 2).transpose(0, 5, 4, 3, 2, 1) for m in MEASURES}
    got = {name: contract(cube["n"], t) for name, t in takes.items()}
    out = {"kept": got["kept"], "removed": got["removed"], "redundant": got["failing"] - got["removed"], "unique_fails": got["unique_fails"]}
    out |= {"good_lost": contract(cube["good"], takes["removed"]), "toxic_lost": contract(cube["toxic"], takes["removed"])}
    own = np.array([FILTERS.index(order[k - 1]) for order, k in steps])
    summed = np.stack([got["removed"][:, own == f].sum(1) for f in range(5)], 1)
    out["shapley"] = summed[:, own]
    wide = {"part": np.repeat(parts["part"].to_numpy(), len(steps)), "filter_order": np.tile([o for o, _ in steps], len(parts)), "step": np.tile(np.array([k for _, k in steps], np.int32), len(parts))}
    return pd.DataFrame(wide | {name: v.ravel() for name, v in out.items()})


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row for each part, order and step."""

    def run(batches):
        for batch in batches:
            for at in range(0, len(batch), 64):
                yield audit_of(batch.iloc[at : at + 64])

    return tensors(flagged(docs, labels)).mapInPandas(run, SCHEMA)


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


QUERIES = {"op13_filter_audit": op13_filter_audit}
ORACLE = {
    "op13_filter_audit": r"""
WITH docs AS (
  SELECT coalesce(source, '') AS part, doc_id, coalesce(text, '') AS text FROM documents
), said AS (
  SELECT doc_id, max(CAST(quality = 1 AS INTEGER)) AS good, max(CAST(toxic = 1 AS INTEGER)) AS toxic FROM labels WHERE doc_id IS NOT NULL GROUP BY 1
), least AS (SELECT text, min(doc_id) AS least FROM docs GROUP BY 1
), counted AS (
  SELECT part, doc_id, text, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS w FROM docs
), cells AS (
  SELECT part, len(w) < 200 AS a, 100 * len(list_distinct(w)) < 50 * len(w) AS b,
    100 * len(regexp_extract_all(c.text, '[A-Z]')) > 2 * length(c.text) AS c, regexp_matches(c.text, '[#$%&*|]') AS d,
    coalesce(c.doc_id > least.least, false) AS e, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic
  FROM counted c JOIN least ON c.text = least.text LEFT JOIN said ON c.doc_id = said.doc_id
), fails AS (
  SELECT part, MAP {'A': a, 'B': b, 'C': c, 'D': d, 'E': e} AS f, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM cells GROUP BY ALL
), letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x
), orders AS (
  SELECT p.x || q.x || r.x || s.x || t.x AS filter_order FROM letters p, letters q, letters r, letters s, letters t
  WHERE len(list_distinct([p.x, q.x, r.x, s.x, t.x])) = 5
), steps AS (
  SELECT filter_order, step, filter_order[step] AS own, string_split(filter_order[1:step - 1], '') AS before
  FROM orders, (SELECT unnest([1, 2, 3, 4, 5]) AS step)
), judged AS (
  SELECT part, filter_order, step, own, n, good, toxic, f[own] AS bad,
    len(list_filter(before, lambda x: x <> '' AND f[x])) = 0 AS there,
    len(list_filter(['A', 'B', 'C', 'D', 'E'], lambda x: x <> own AND f[x])) = 0 AS alone
  FROM fails, steps
), summed AS (
  SELECT part, filter_order, step, own,
    coalesce(sum(n) FILTER (there AND NOT bad), 0) AS kept, coalesce(sum(n) FILTER (there AND bad), 0) AS removed,
    coalesce(sum(n) FILTER (bad AND NOT there), 0) AS redundant, coalesce(sum(n) FILTER (bad AND alone), 0) AS unique_fails,
    coalesce(sum(good) FILTER (there AND bad), 0) AS good_lost, coalesce(sum(toxic) FILTER (there AND bad), 0) AS toxic_lost
  FROM judged GROUP BY ALL
)
SELECT part, filter_order, CAST(step AS INTEGER) AS step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed, CAST(redundant AS BIGINT) AS redundant,
  CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
  CAST(sum(removed) OVER (PARTITION BY part, own) AS BIGINT) AS shapley
FROM summed
"""
}
