"""Whether a routing engine passes: every criterion of every night from the records of its runs, and what they suggest.

A night is a set of runs; its core runs have repeats. Readings that the gate as written can't decide are the owner's.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Gates:
    """Fixed values that results depend on."""

    wall_seconds: float = 8 * 3600
    budget_bytes: int = 20 * 10**9
    kill_bytes: int = 22 * 10**9
    identical_share: float = 0.999
    largest_minutes: float = 1
    finite_share: float = 0.95
    checks_within: int = 32
    checks: int = 40
    correlation: float = 0.95


PASS, FINDING, FAIL, PENDING, OWNER = "pass", "pass with finding", "fail", "pending", "owner reading"
COMPLETED, KILLED = "completed", "killed-rss"
ENDED = ("finished", "killed-by-evidence")


def judged(df: DataFrame, criterion: Column | str, status: Column) -> DataFrame:
    name = F.lit(criterion) if isinstance(criterion, str) else criterion
    return df.select("night", name.alias("criterion"), F.coalesce(status, F.lit(PENDING)).alias("status"))


def of_nights(nights: DataFrame, runs: DataFrame, gates: Gates) -> DataFrame:
    """wall: the core runs together; rss: no core run killed, the peak of all against the budget and the kill line."""
    core = F.col("core")
    sums = runs.groupBy("night").agg(
        F.bool_and(F.when(core, F.col("run_status") == COMPLETED)).alias("done"),
        F.sum(F.when(core, F.col("wall_seconds"))).alias("wall"),
        F.coalesce(F.bool_or(core & (F.col("run_status") == KILLED)), F.lit(False)).alias("killed"),
        F.max("peak_bytes").alias("peak"),
    )
    of = nights.select("night").join(sums, "night", "left")
    wall = F.when(~F.coalesce("done", F.lit(False)) | F.col("wall").isNull(), PENDING).when(F.col("wall") <= gates.wall_seconds, PASS).otherwise(FAIL)
    peak = F.col("peak")
    rss = F.when(F.col("killed"), FAIL).when(peak.isNull(), PENDING).when(peak > gates.kill_bytes, FAIL).when(peak > gates.budget_bytes, FINDING).otherwise(PASS)
    return judged(of, "wall", wall).unionByName(judged(of, "rss", rss))


def of_runs(runs: DataFrame, repeats: DataFrame, sanity: DataFrame, bounds: DataFrame, gates: Gates) -> DataFrame:
    """determinism and finite_pairs of each core run. Walking runs that the straight-line bound keeps from the gate are the owner's to read."""
    core = runs.where("core").select("night", "run", "mode", "run_status")
    again = runs.where("repeat_of is not null").groupBy("night", F.col("repeat_of").alias("run")).agg(F.bool_and(F.col("run_status") == COMPLETED).alias("again"))
    both = core.join(again, ["night", "run"], "left").join(repeats, ["night", "run"], "left")
    whole = (F.col("pairs") > 0) & (F.col("unmatched") == 0)
    close = (F.col("identical") / F.col("pairs") >= gates.identical_share) & (F.col("largest") <= gates.largest_minutes)
    ready = (F.col("run_status") == COMPLETED) & F.coalesce("again", F.lit(False)) & F.col("pairs").isNotNull()
    determinism = F.when(~ready, PENDING).when(whole & ((F.col("identical") == F.col("pairs")) | close), PASS).otherwise(FAIL)
    named = lambda kind: F.concat(F.lit(f"{kind}:"), "run")
    seen = core.join(sanity, ["night", "run"], "left").join(bounds, ["night", "run"], "left")
    finite = F.when((F.col("run_status") != COMPLETED) | F.col("finite_share").isNull(), PENDING).when(F.col("finite_share") >= gates.finite_share, PASS)
    finite = finite.when((F.col("mode") == "walk") & F.col("reach_share").isNotNull(), OWNER).otherwise(FAIL)
    return judged(both, named("determinism"), determinism).unionByName(judged(seen, named("finite_pairs"), finite))


def of_checks(nights: DataFrame, tallies: DataFrame, concordance: DataFrame, gates: Gates) -> DataFrame:
    """hand_check: enough planner checks within tolerance; concordance: Spearman's correlation with the other engine."""
    of = nights.select("night").join(tallies, "night", "left").join(concordance, "night", "left")
    hand = F.when(F.col("within").isNull(), PENDING).when((F.col("within") >= gates.checks_within) & (F.coalesce("checks", F.lit(gates.checks)) >= gates.checks), PASS).otherwise(FAIL)
    rho = F.when(F.col("spearman").isNull(), PENDING).when(F.col("spearman") >= gates.correlation, PASS).otherwise(FAIL)
    return judged(of, "hand_check", hand).unionByName(judged(of, "concordance", rho))


def criteria(nights: DataFrame, runs: DataFrame, repeats: DataFrame, sanity: DataFrame, bounds: DataFrame, tallies: DataFrame, concordance: DataFrame, gates: Gates = Gates()) -> DataFrame:  # noqa: B008
    """night, criterion and status (pass, pass with finding, fail, pending or owner reading).

    nights(night, state, outcome); runs(night, run, core, mode, run_status, wall_seconds, peak_bytes, repeat_of); repeats(night, run, pairs, unmatched,
    identical, largest); sanity(night, run, finite_share); bounds(night, run, reach_share); tallies(night, within, checks); concordance(night, spearman).
    What a table has no row for is pending.
    """
    return of_nights(nights, runs, gates).unionByName(of_runs(runs, repeats, sanity, bounds, gates)).unionByName(of_checks(nights, tallies, concordance, gates))


def suggestions(nights: DataFrame, found: DataFrame) -> DataFrame:
    """night, readable, suggestion (go, killed-by-evidence, pending, or none of a night that didn't end), and the criteria that fail, wait, are the owner's, or have findings."""
    lists = {"failing": FAIL, "pending": PENDING, "owner_readings": OWNER, "findings": FINDING}
    sums = found.groupBy("night").agg(*[F.array_sort(F.collect_list(F.when(F.col("status") == s, F.col("criterion")))).alias(n) for n, s in lists.items()])  # some criteria a run
    all_ = nights.join(sums, "night", "left")
    readable = F.col("state").isin(*ENDED)
    some = lambda n: F.size(n) > 0
    suggestion = F.when(~readable, "unreadable").when((F.col("outcome") == "killed-by-evidence") | some("failing"), "killed-by-evidence").when(some("pending"), "pending").otherwise("go")
    return all_.select("night", readable.alias("readable"), suggestion.alias("suggestion"), *lists)
