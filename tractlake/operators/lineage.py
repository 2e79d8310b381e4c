"""What is fresh, stale or missing: recorded digests against current ones, and snapshots against their manifests."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tractlake.operators.keeping import cut, settled


def staleness(stages: DataFrame, recorded: DataFrame, current: DataFrame, outputs: DataFrame) -> DataFrame:
    """stage, status and the reasons, of stages(stage, params): recorded(stage, params, inputs map, outputs map) against current(stage, inputs map) and
    outputs(stage, outputs map) as they are now. incomplete: never recorded; missing: an output is gone; altered: an output has another digest; stale:
    inputs or parameters differ; else fresh."""
    a = recorded.select("stage", F.col("params").alias("params_then"), F.col("inputs").alias("inputs_then"), F.col("outputs").alias("outputs_then"), F.lit(True).alias("known"))
    rows = stages.join(a, "stage", "left").join(current.select("stage", "inputs"), "stage", "left").join(outputs.select("stage", "outputs"), "stage", "left")
    keys = lambda m: F.map_keys(F.coalesce(m, F.create_map().cast("map<string,string>")))
    other = lambda then, now: F.filter(F.array_union(keys(F.col(then)), keys(F.col(now))), lambda k: ~F.try_element_at(F.col(then), k).eqNullSafe(F.try_element_at(F.col(now), k)))
    gone = F.filter(keys(F.col("outputs_then")), lambda k: F.try_element_at(F.coalesce("outputs", F.create_map().cast("map<string,string>")), k).isNull())
    altered = F.filter(F.array_except(keys(F.col("outputs_then")), gone), lambda k: F.try_element_at(F.col("outputs_then"), k) != F.try_element_at(F.col("outputs"), k))
    inputs = other("inputs_then", "inputs")
    same = F.col("params").eqNullSafe(F.col("params_then"))
    status = F.when(F.col("known").isNull(), "incomplete").when(F.size(gone) > 0, "missing").when(F.size(altered) > 0, "altered").when((F.size(inputs) > 0) | ~same, "stale").otherwise("fresh")
    reasons = F.array_sort(F.concat(F.transform(gone, lambda k: F.concat(F.lit("gone: "), k)), F.transform(altered, lambda k: F.concat(F.lit("altered: "), k)), F.transform(inputs, lambda k: F.concat(F.lit("input: "), k)), F.when(same, F.array().cast("array<string>")).otherwise(F.array(F.lit("parameters")))))
    return rows.select("stage", status.alias("status"), F.when(F.col("known").isNull(), F.array().cast("array<string>")).otherwise(reasons).alias("reasons"))


def reusable_run(runs: DataFrame, wanted: DataFrame) -> DataFrame:
    """name and the latest run of runs(run, status, plan, points, inputs) for each of wanted(name, plan, points, inputs): the same plan, points and input
    digests, finished or stopped; null if there is none."""
    usable = runs.where(F.col("status").isin("finished", "stopped")).groupBy("plan", "points", "inputs").agg(F.max("run").alias("run"))
    found = wanted.join(usable, ["plan", "points", "inputs"]).groupBy("name").agg(F.max("run").alias("run"))
    return wanted.select("name").join(found, "name", "left")


def snapshot_report(listed: DataFrame, present: DataFrame) -> DataFrame:
    """path and problem: listed(path, digest) by manifests against present(path, digest). missing, digest, extra, or layout for a path that isn't
    <source>/<YYYY-MM-DD[-N]>/<file>."""
    both = listed.select("path", F.col("digest").alias("wanted"), F.lit(True).alias("named")).join(present.select("path", F.col("digest").alias("found"), F.lit(True).alias("there")), "path", "full_outer")
    shape = r"^[a-z][a-z0-9_]*/\d{4}-\d{2}-\d{2}(-[1-9]\d*)?/[^/].*$"
    problem = F.when(F.col("there").isNull(), "missing").when(~F.col("path").rlike(shape), "layout").when(F.col("named").isNull(), "extra").when(F.col("wanted") != F.col("found"), "digest")
    return both.select("path", problem.alias("problem")).where("problem IS NOT NULL")


def closure(edges: DataFrame) -> DataFrame:
    """(child, ancestor) of every path along edges(child, parent), each once.

    Each round joins the pairs that are new to all known ones on both sides, so paths double in length: a chain of n edges takes about log2(n)
    rounds, and a cycle ends as any other path does, once it brings nothing new. Nodes of a cycle are their own ancestors.
    """
    known = new = cut(edges.select("child", F.col("parent").alias("ancestor")).where("child is not null and ancestor is not null").distinct())
    while True:
        on = lambda a, b: a.join(b.select(F.col("child").alias("ancestor"), F.col("ancestor").alias("far")), "ancestor").select("child", F.col("far").alias("ancestor"))
        longer = on(new, known).unionByName(on(known, new)).distinct()
        new = cut(longer.join(known, ["child", "ancestor"], "left_anti"))
        if new.isEmpty():
            return known
        known = cut(known.unionByName(new))


def taken_out(left: DataFrame, seed: int) -> DataFrame:
    """node, of those of left(child, parent) that can go at once: edges that lead past them are no more than their own, and they have the least hash among their neighbours."""
    rank = lambda c: F.xxhash64(c, F.lit(seed))
    side = lambda node, other, up: left.select(F.col(node).alias("node"), rank(other).alias("other"), F.lit(up).alias("up"), F.lit(1 - up).alias("down"))
    nodes = side("child", "parent", 1).unionByName(side("parent", "child", 0)).groupBy("node").agg(F.sum("up").alias("up"), F.sum("down").alias("down"), F.min("other").alias("other"))
    return settled(nodes.where((F.col("up") * F.col("down") <= F.col("up") + F.col("down")) & (rank("node") < F.col("other"))).select("node"))


def raw_sources(edges: DataFrame, wanted: DataFrame) -> DataFrame:
    """(child, source) of each of wanted(child): its ancestors that come from nothing else.

    Pairs of ancestors aren't listed. Each round takes out many nodes that don't touch and that add no edges by going: their children get edges to their
    parents and sources. A chain of n edges is gone in about log(n) rounds. Then the nodes hear, the last one out first, what the parents know that they
    had when they went. What is too dense for that is told edge by edge, in as many rounds as its paths are long; cycles end as nothing is new.
    """
    given = edges.select("child", "parent").where("child is not null and parent is not null").distinct()
    derived = edges.select(F.col("child").alias("parent"), F.lit(False).alias("raw")).where("parent is not null").distinct()
    left = settled(given.join(derived, "parent", "left").select("child", "parent", F.coalesce("raw", F.lit(True)).alias("raw")).where("raw or child <> parent"))
    inner = lambda: left.where("not raw")
    was, now, gone = float("inf"), inner().count(), []
    while 0 < now < 0.95 * was:
        out = taken_out(inner(), len(gone))
        goes = lambda name: out.select(F.col("node").alias(name), F.lit(True).alias(f"{name}_goes"))  # noqa: B023, E731
        seen = settled(left.join(goes("child"), "child", "left").join(goes("parent"), "parent", "left"))
        into = seen.where("parent_goes and not raw").select(F.col("child").alias("below"), F.col("parent").alias("child"))
        gone.append(seen.where("child_goes").select("child", "parent", "raw"))
        past = into.join(gone[-1], "child").select(F.col("below").alias("child"), "parent", "raw").where("child <> parent")
        left = settled(seen.where("child_goes is null and (raw or parent_goes is null)").select("child", "parent", "raw").unionByName(past).distinct())
        was, now = now, inner().count()
    found = new = left.where("raw").select("child", F.col("parent").alias("source"))
    while now and not new.isEmpty():
        heard = inner().join(new.withColumnRenamed("child", "parent"), "parent").select("child", "source").distinct()
        new = settled(heard.join(found, ["child", "source"], "left_anti"))
        found = settled(found.unionByName(new))
    for above in reversed(gone):
        heard = above.where("not raw").join(found.withColumnRenamed("child", "parent"), "parent").select("child", "source")
        found = found.unionByName(settled(heard.unionByName(above.where("raw").select("child", F.col("parent").alias("source"))).distinct()))
    return found.join(wanted, "child", "left_semi").select("child", "source")


def ancestor_range(edges: DataFrame, rounds: int) -> DataFrame | None:
    """child with low and high, the smallest and the largest of its ancestors along edges(child, parent); None if that takes more rounds.

    Each round hears what the parents know, then what the ones it knows know, so a chain in the order of its names takes about the logarithm of its length.
    """
    known = cut(edges.groupBy("child").agg(F.min("parent").alias("low"), F.max("parent").alias("high")))
    for _ in range(rounds):
        of = lambda df, name: df.select(F.col("child").alias(name), F.col("low").alias(f"low_{name}"), F.col("high").alias(f"high_{name}"))
        heard = edges.join(of(known, "parent"), "parent").groupBy("child").agg(F.min("low_parent").alias("low_"), F.max("high_parent").alias("high_"))
        told = known.join(heard, "child", "left").select("child", F.col("low").alias("was_low"), F.col("high").alias("was_high"), F.least("low", "low_").alias("low"), F.greatest("high", "high_").alias("high"))
        told = cut(told)
        new = told.join(of(told, "low"), "low", "left").join(of(told, "high"), "high", "left")
        new = cut(new.select("child", "was_low", "was_high", F.least("low", "low_low").alias("low"), F.greatest("high", "high_high").alias("high")))
        known = new.select("child", "low", "high")
        if new.where("low <> was_low or high <> was_high").isEmpty():
            return known
    return None


def cycles(edges: DataFrame, rounds: int = 40) -> DataFrame:
    """The nodes that are their own ancestors.

    A node on a cycle has an ancestor no smaller and one no larger than itself, so edges of other nodes are left out, again and again until none is;
    paths are followed along what remains only. Where a range isn't known after so many rounds, nothing more is left out.
    """
    left = cut(edges.select("child", "parent").where("child is not null and parent is not null").distinct())
    while (found := ancestor_range(left, rounds)) is not None:
        may = cut(found.where("low <= child and high >= child").select("child"))
        kept = cut(left.join(may, "child", "left_semi").join(may.select(F.col("child").alias("parent")), "parent", "left_semi"))
        done, left = kept.count() == left.count(), kept
        if done:
            break
    return closure(left).where("child = ancestor").select("child")


def next_free(taken: DataFrame, by: list[str], number: str) -> DataFrame:
    """by and next: the smallest number from 0 on that no row of taken(by, number) has; the first gap, without an upper limit."""
    used = taken.select(*by, F.col(number).cast("long").alias("n")).where("n >= 0").unionByName(taken.select(*by).distinct().withColumn("n", F.lit(-1).cast("long"))).distinct()
    after = F.lead("n").over(Window.partitionBy(*by).orderBy("n"))
    return used.withColumn("after", after).where("after is null or after > n + 1").groupBy(*by).agg((F.min("n") + 1).alias("next"))
