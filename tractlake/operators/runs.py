"""Summaries of feeds, runs and series, grid completion, and margins of error of derived estimates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tractlake.functions.expr import censored
from tractlake.operators.distances import pairs_where
from tractlake.operators.joins import crossed_in_blocks, refuse, repeated


def completed(results: DataFrame, origins: DataFrame, sites: DataFrame, cap: float) -> DataFrame:
    """Every pair of an origin and a site with its minutes, missing and longer ones at the cap; a repeated pair is refused. The product is the result."""
    refuse(repeated(results, ["origin_id", "site_id"]), "repeated pair")
    grid = origins.select("origin_id").crossJoin(sites.select("site_id"))
    return grid.join(results.select("origin_id", "site_id", "minutes"), ["origin_id", "site_id"], "left").withColumn("minutes", censored("minutes", cap))


def completed_by_rule(origins: DataFrame, sites: DataFrame, known_origins: DataFrame, known_sites: DataFrame, minutes: Column, cap: float) -> DataFrame:
    """What `completed` gives of a matrix whose minutes are a rule of the columns of a known origin and a known site; those that aren't known are at the cap.

    A join of two products by pair is the product of two joins by key, so only the origins and the sites are joined, and nothing of the product travels.
    """
    refuse(repeated(known_origins, ["origin_id"]), "repeated origin")
    refuse(repeated(known_sites, ["site_id"]), "repeated site")
    return grid_by_rule(origins, sites, known_origins, known_sites, minutes, cap)


def grid_by_rule(origins: DataFrame, sites: DataFrame, known_origins: DataFrame, known_sites: DataFrame, minutes: Column, cap: float) -> DataFrame:
    """The same without refusing: a key that stands twice gives the rows that the join by pair would."""
    copies = lambda df, key: df.withColumn(f"copy_{key}", F.row_number().over(Window.partitionBy(key).orderBy(key)))
    o = origins.select("origin_id").join(copies(known_origins, "origin_id"), "origin_id", "left")
    s = sites.select("site_id").join(copies(known_sites, "site_id"), "site_id", "left")
    known = F.col("copy_origin_id").isNotNull() & F.col("copy_site_id").isNotNull()
    once = (F.coalesce("copy_origin_id", F.lit(1)) == 1) & (F.coalesce("copy_site_id", F.lit(1)) == 1)  # a pair that isn't known is one row
    return crossed_in_blocks(o, s, "origin_id").where(known | once).select("origin_id", "site_id", censored(F.when(known, minutes), cap).alias("minutes"))


def proxy_minutes(metres: Column, cap: float, walk: float = 80.0, ride: float = 300.0, wait: float = 6.0, spread: float = 1.3) -> dict[str, Column]:
    """Median and 85th percentile of walking and of walking with transit, from Manhattan metres; a ride is never slower than the walk, and all are cut at the cap."""
    on_foot = metres / walk
    riding = F.least(on_foot, metres / ride + wait)
    late = F.least(on_foot, riding * spread)
    return {"walk_p50": censored(on_foot, cap), "walk_p85": censored(on_foot, cap), "walk_transit_p50": censored(riding, cap), "walk_transit_p85": censored(late, cap)}


def series_summary(samples: DataFrame, by: str, at: str, value: str, line: float, low: object, high: object) -> DataFrame:
    """by, samples, the peak and its first time, the first time at or over a line, and the peak inside an interval of times."""
    v, t = F.col(value), F.col(at)
    first_peak = F.min(F.struct((-v).alias("v"), t.alias("t")))["t"]
    return samples.where(v.isNotNull()).groupBy(by).agg(F.count("*").alias("samples"), F.max(v).alias("peak"), first_peak.alias("peak_at"), F.min(F.when(v >= line, t)).alias("first_over"), F.max(F.when(t.between(low, high), v)).alias("peak_inside"))


def phases(marks: DataFrame, run: str, phase: str, at: str, done: int, wanted: int, scaled: str) -> DataFrame:
    """run, seconds of each phase (from its first to its last mark) as a map, all seconds, and what `wanted` origins would take if the scaled phase grows in
    proportion from `done` and the others stay."""
    each = marks.groupBy(run, phase).agg((F.max(F.unix_timestamp(at)) - F.min(F.unix_timestamp(at))).cast("double").alias("s"))
    longer = F.when(F.col(phase) == scaled, F.col("s") * wanted / done).otherwise(F.col("s"))
    entries = F.map_from_entries(F.array_sort(F.collect_list(F.struct(phase, "s"))))
    return each.groupBy(run).agg(entries.alias("phases"), F.sum("s").alias("seconds"), F.sum(longer).alias("projected"))


def repeat_agreement(digests: DataFrame, name: str, run: str, digest: str, repeats: int) -> DataFrame:
    """name, whether all of so many runs gave one digest, and the digests that were seen, of which there are as many as runs at most."""
    seen = F.array_sort(F.collect_set(digest))
    out = digests.groupBy(name).agg(F.count_distinct(run).alias("runs"), F.count_if(F.col(digest).isNull()).alias("none"), seen.alias("digests"))
    return out.select(name, ((F.col("runs") == repeats) & (F.col("none") == 0) & (F.size("digests") == 1)).alias("agrees"), "digests")


def layer_summary(points: DataFrame, flag: str, area: str, kind: str, group: str) -> DataFrame:
    """part, value and counts: all rows, flagged and unassigned ones and distinct areas, then rows by kind and by group; one pass for each."""
    one = points.agg(F.count("*").alias("rows"), F.count_if(flag).alias("flagged"), F.count_if(F.col(area).isNull()).alias("unassigned"), F.count_distinct(area).alias("areas"), F.count_distinct(F.when(F.col(flag), F.col(area))).alias("flagged_areas"))
    total = one.selectExpr("stack(5, 'rows', rows, 'flagged', flagged, 'unassigned', unassigned, 'areas', areas, 'flagged areas', flagged_areas) AS (value, n)").select(F.lit("all").alias("part"), "value", "n")
    by = points.groupingSets([[kind], [group]], kind, group).agg(F.count("*").alias("n"), F.grouping(kind).alias("g"))
    return total.unionByName(by.select(F.when(F.col("g") == 0, kind).otherwise(group).alias("part"), F.when(F.col("g") == 0, F.col(kind)).otherwise(F.col(group)).alias("value"), "n"))


def moe_of_sum(moe: Column) -> Column:
    """An aggregate: the margin of a sum of estimates."""
    return F.sqrt(F.sum(moe * moe))


def moe_of_ratio(part: Column, part_moe: Column, whole: Column, whole_moe: Column) -> Column:
    share = part / whole
    return F.when(whole != 0, F.sqrt(part_moe**2 + share**2 * whole_moe**2) / F.abs(whole))


def moe_of_proportion(part: Column, part_moe: Column, whole: Column, whole_moe: Column) -> Column:
    """The margin of part of a whole; where the difference under the root is negative, that of a ratio."""
    under = part_moe**2 - (part / whole) ** 2 * whole_moe**2
    return F.when(whole != 0, F.when(under >= 0, F.sqrt(under) / F.abs(whole)).otherwise(moe_of_ratio(part, part_moe, whole, whole_moe)))


def feed_summary(feeds: DataFrame, present: DataFrame, required: list[str], run_day: str, first_day: str, last_day: str) -> DataFrame:
    """feed, required names that it lacks, its window and whether a day lies inside: feeds(feed, first, last) and present(feed, name)."""
    names = present.groupBy("feed").agg(F.collect_set(F.when(F.col("name").isin(required), F.col("name"))).alias("there"))  # required names at most
    out = feeds.join(names, "feed", "left")
    missing = F.array_sort(F.array_except(F.array(*map(F.lit, required)), F.coalesce("there", F.array().cast("array<string>"))))
    return out.select("feed", missing.alias("missing"), F.col(first_day).alias("first_day"), F.col(last_day).alias("last_day"), F.lit(run_day).cast("date").between(F.col(first_day), F.col(last_day)).alias("inside"))


def run_comparison(a: DataFrame, b: DataFrame, keys: list[str], value: str, band: float) -> DataFrame:
    """One row on two runs over the same keys: pairs in both, in one only, finite in both, with a difference beyond a band, and the difference b - a: least, mean, largest."""
    both = a.select(*keys, F.col(value).alias("a"), F.lit(True).alias("in_a")).join(b.select(*keys, F.col(value).alias("b"), F.lit(True).alias("in_b")), keys, "full_outer")
    d = F.col("b") - F.col("a")
    return both.agg(F.count_if(F.col("in_a") & F.col("in_b")).alias("pairs"), F.count_if(F.col("in_a").isNull() | F.col("in_b").isNull()).alias("one_only"), F.count(d).alias("finite"), F.count_if(F.abs(d) > band).alias("beyond"), F.min(d).alias("least"), F.avg(d).alias("mean"), F.max(d).alias("largest"))


def comparison_of_counts(rows: DataFrame, band: float) -> DataFrame:
    """The same of rows(a, b, shared, pairs), each of which stands for so many pairs, in both runs or in one only."""
    d = F.col("b") - F.col("a")
    mean = F.sum(d * F.col("pairs")) / F.sum(F.when(d.isNotNull(), F.col("pairs")))
    return rows.agg(pairs_where(F.col("shared")).alias("pairs"), pairs_where(~F.col("shared")).alias("one_only"), pairs_where(d.isNotNull()).alias("finite"), pairs_where(F.abs(d) > band).alias("beyond"), F.min(d).alias("least"), mean.alias("mean"), F.max(d).alias("largest"))


def aggregation_sensitivity(parts: DataFrame, areas: DataFrame, area: str, value: str, weight: str) -> DataFrame:
    """area, the value of its parts weighted, its own value, and the difference: parts(area, value, weight) against areas(area, value)."""
    w = F.when(F.col(value).isNotNull(), F.col(weight))
    fine = parts.groupBy(area).agg((F.sum(F.col(value) * w) / F.sum(w)).alias("of_parts"))
    return fine.join(areas.select(area, F.col(value).alias("own")), area).select(area, "of_parts", "own", (F.col("of_parts") - F.col("own")).alias("difference"))


def like_for_like(ours: DataFrame, theirs: DataFrame, key: str, value: str) -> DataFrame:
    """key, ours and theirs on the keys that both have; and how many keys only one has, on each row."""
    both = ours.select(key, F.col(value).alias("ours")).join(theirs.select(key, F.col(value).alias("theirs")), key, "full_outer")
    left_out = both.agg(F.count_if(F.col("theirs").isNull()).alias("only_ours"), F.count_if(F.col("ours").isNull()).alias("only_theirs"))  # one row
    return both.where("ours IS NOT NULL AND theirs IS NOT NULL").join(F.broadcast(left_out))


def acquisitions(files: DataFrame, source: str, size: str, attempts: str, reused: str) -> DataFrame:
    """source, files, bytes, attempts, files that were taken from before, and bytes that were fetched."""
    return files.groupBy(source).agg(F.count("*").alias("files"), F.sum(size).alias("bytes"), F.sum(attempts).alias("attempts"), F.count_if(reused).alias("reused"), F.coalesce(F.sum(F.when(~F.col(reused), F.col(size))), F.lit(0)).alias("fetched"))
