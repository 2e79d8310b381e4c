"""Origin-destination matrices: completeness, agreement of two engines, samples to check by hand, class edges and a verdict."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tractlake.operators.distances import key_counts, pairs_where
from tractlake.operators.spatial import average_rank, quantiles


def sanity(matrix: DataFrame, origins: DataFrame, sites: DataFrame, cap: float, least_share: float) -> DataFrame:
    """One row: expected and given pairs, missing and repeated ones, unreachable, finite, share, censored, and whether the gate opens."""
    expected = origins.agg(F.count("*").alias("a")).join(sites.agg(F.count("*").alias("b"))).select((F.col("a") * F.col("b")).alias("expected"))  # one row
    keys = matrix.groupBy("origin_id", "site_id").agg(F.count("*").alias("n"), F.min("minutes").alias("m"))
    sums = keys.agg(F.sum("n").alias("rows"), F.count("*").alias("pairs"), F.count_if(F.col("n") > 1).alias("repeated"), F.count_if(F.col("m").isNull()).alias("unreachable"), F.count("m").alias("finite"), F.count_if(F.col("m") > cap).alias("censored"))
    out = sums.join(expected).select("expected", "rows", (F.col("expected") - F.col("pairs")).alias("missing"), "repeated", "unreachable", "finite", F.round(F.col("finite") / F.col("expected"), 6).alias("share"), "censored")
    return out.withColumn("gate", (F.col("missing") == 0) & (F.col("repeated") == 0) & (F.col("share") >= least_share))


def sanity_of_counts(counts: DataFrame, origins: DataFrame, sites: DataFrame, cap: float, least_share: float) -> DataFrame:
    """The same of counts(minutes, pairs) of the matrix of all origins and sites, in which a pair is repeated if an origin or a site is."""
    m = F.col("minutes")
    sums = counts.agg(pairs_where().alias("rows"), pairs_where(m.isNull()).alias("unreachable"), pairs_where(m.isNotNull()).alias("finite"), pairs_where(m > cap).alias("censored"))
    out = sums.join(key_counts(origins, sites)).select(F.col("rows").alias("expected"), "rows", (F.col("rows") - F.col("keys")).alias("missing"), "repeated", "unreachable", "finite", F.round(F.col("finite") / F.nullif("rows", F.lit(0)), 6).alias("share"), "censored")  # one row each
    return out.withColumn("gate", (F.col("missing") == 0) & (F.col("repeated") == 0) & (F.col("share") >= least_share))


def stranded(matrix: DataFrame, origins: DataFrame) -> DataFrame:
    """Origins without a finite pair."""
    return origins.select("origin_id").join(matrix.where("minutes IS NOT NULL").select("origin_id"), "origin_id", "left_anti")


def agreement(pairs: DataFrame, a: str, b: str) -> DataFrame:
    """One row on the pairs where both values are there: n, Spearman's (average ranks) and Pearson's correlation, mean and median absolute difference, median ratio."""
    both = pairs.where(F.col(a).isNotNull() & F.col(b).isNotNull()).select(a, b)
    both = both.withColumn("apart", F.abs(F.col(a) - F.col(b))).withColumn("ratio", F.when(F.col(b) != 0, F.col(a) / F.col(b)))
    ranked = average_rank(average_rank(both, a, "rank_a"), b, "rank_b")
    sums = ranked.agg(F.count("*").alias("n"), F.corr("rank_a", "rank_b").alias("spearman"), F.corr(a, b).alias("pearson"), F.avg("apart").alias("mean_difference"))
    for column, name in (("apart", "median_difference"), ("ratio", "median_ratio")):
        sums = sums.join(F.broadcast(quantiles(both, column, [0.5]).select(F.get("q", F.lit(0)).alias(name))))  # one row each
    return sums


def criteria(measures: DataFrame, rules: dict[str, tuple[Column, Column]], pending: list[str]) -> DataFrame:
    """criterion, status and outcome from one row of measures. A rule is (passes, is but a finding); what has no measure yet, or an unknown one, is
    pending. The outcome is reject with a failure, wait with something pending, adopt with findings, else adopt."""
    status = {n: F.when(ok, "pass").when(finding, "finding").when(ok.isNotNull(), "fail").otherwise("pending") for n, (ok, finding) in rules.items()} | {n: F.lit("pending") for n in pending}
    rows = F.array(*[F.struct(F.lit(n).alias("criterion"), s.alias("status")) for n, s in status.items()])
    named = measures.select(rows.alias("rows"))
    has = lambda s: F.exists("rows", lambda r: r["status"] == s)
    outcome = F.when(has("fail"), "reject").when(has("pending"), "wait").when(has("finding"), "adopt with findings").otherwise("adopt")
    return named.select(F.explode("rows").alias("r"), outcome.alias("outcome")).select("r.criterion", "r.status", "outcome")


def systematic_sample(keys: DataFrame, key: str, step: int, count: int, skipped: list) -> DataFrame:
    """position and key of every step-th key in order, `count` of them; a skipped one gives way to the next key that is neither skipped nor taken.

    No more than step * count + 2 * count + the skipped keys can matter, so only so many reach the driver.
    """
    most = step * count + 2 * count + len(skipped)
    order = [r[0] for r in keys.select(key).where(F.col(key).isNotNull()).distinct().orderBy(key).limit(most).collect()]
    barred, taken = set(skipped), []
    for place in range(0, min(len(order), step * count), step):
        while place < len(order) and (order[place] in barred or order[place] in taken):
            place += 1
        if place < len(order):
            taken.append(order[place])
    kind = keys.schema[key].dataType.simpleString()
    return keys.sparkSession.createDataFrame(list(enumerate(taken)), f"position int, `{key}` {kind}")


def pair_selection(matrix: DataFrame, picked: DataFrame, far_positions: list[int]) -> DataFrame:
    """position, origin_id, site_id, rule: the nearest site of each of picked(position, origin_id), at the named positions the farthest finite one; ties to the smaller site."""
    m = matrix.where("minutes IS NOT NULL").join(picked, "origin_id")
    near, far = F.min(F.struct("minutes", "site_id"))["site_id"], F.min(F.struct((-F.col("minutes")).alias("m"), "site_id"))["site_id"]
    best = m.groupBy("position", "origin_id").agg(near.alias("near"), far.alias("far"))
    is_far = F.col("position").isin(far_positions)
    return best.select("position", "origin_id", F.when(is_far, F.col("far")).otherwise(F.col("near")).alias("site_id"), F.when(is_far, "farthest").otherwise("nearest").alias("rule"))


def class_record(df: DataFrame, value: str, classes: int, method: str) -> DataFrame:
    """One row: requested and actual classes and their edges (quantile or equal_interval), rounded to 6 and increasing; one value has one edge and no class."""
    if method == "quantile":
        raw = quantiles(df, value, [k / classes for k in range(classes + 1)]).select("q")
    else:
        low, high = F.min(value).cast("double"), F.max(value).cast("double")
        raw = df.agg(F.array(*[low + (high - low) * (k / classes) for k in range(classes)], high).alias("q"))
    edges = F.array_distinct(F.transform("q", lambda x: F.round(x, 6)))
    return raw.select(F.lit(classes).alias("requested"), (F.size(edges) - 1).alias("actual"), edges.alias("edges"))
