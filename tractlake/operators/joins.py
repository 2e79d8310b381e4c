"""Joins that refuse what doesn't fit: each has a report of the keys at fault, and a form that raises with a sample of it."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tractlake.operators import spatial

SAMPLE = 5
#: Pairs of a product that one task makes, about; rows of a block, 63 groups of 8 as Parquet packs them, and of those that are cut into blocks together.
PAIRS_A_TASK, BLOCK, CUT = 20_000_000, 504, 50_000


def refuse(report: DataFrame, what: str) -> None:
    """Raises if the report has a row, with the first few."""
    found = report.limit(SAMPLE).collect()
    if found:
        raise ValueError(f"{what}: " + "; ".join(str(r.asDict()) for r in found))


def repeated(df: DataFrame, keys: list[str]) -> DataFrame:
    """The keys that stand in more than one row, and in how many."""
    return df.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")


def crossed(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Every pair of a row of each table. The product is made in even tasks: the rows of a small file are one task's otherwise, whatever comes of them."""
    n, m = left.count(), right.count()
    known = right.repartition(1 + m // 1_000_000)  # a stage of its own: its true size decides whether it is broadcast, not an estimate
    return left.repartition(1 + n * m // PAIRS_A_TASK, key).crossJoin(known)


def crossed_in_blocks(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """The same product in another order: a task meets one block of the right table after the other with each row of its part of the left one. Neither side is
    held as a whole, and what is written takes little space: a left row stands in a run, and the right ones come round again at once."""
    n, m = left.count(), right.count()
    tasks = 1 + n * m // PAIRS_A_TASK
    parts = max(1, min(-(-m // BLOCK), tasks))
    part = F.pmod(F.xxhash64(*right.columns), F.lit(1 + m // CUT))
    lists = right.groupBy(part.alias("part")).agg(F.array_sort(F.collect_list(F.struct(*right.columns))).alias("rows"))
    starts = F.explode(F.sequence(F.lit(1), F.size("rows"), F.lit(BLOCK)))
    blocks = lists.select("part", "rows", starts.alias("start")).repartitionByRange(parts, "part", "start").select(F.slice("rows", F.col("start"), F.lit(BLOCK)).alias("block"))
    return blocks.hint("shuffle_replicate_nl").crossJoin(left.repartition(-(-tasks // parts), key)).select(*left.columns, F.inline("block"))


def key_report(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """keys, n_left, n_right and problem of each key that isn't once on either side. One aggregate a side, one join."""
    a, b = left.groupBy(*keys).agg(F.count("*").alias("n_left")), right.groupBy(*keys).agg(F.count("*").alias("n_right"))
    problem = F.when(F.col("n_left").isNull(), "missing left").when(F.col("n_right").isNull(), "missing right").when(F.col("n_left") > 1, "repeated left").when(F.col("n_right") > 1, "repeated right")
    return a.join(b, keys, "full_outer").select(*keys, "n_left", "n_right", problem.alias("problem")).where("problem IS NOT NULL")


def one_to_one(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """The join of two tables that hold the same keys, each once; anything else is refused."""
    refuse(key_report(left, right, keys), "keys differ")
    return left.join(right, keys)


def outer_merge(tables: list[DataFrame], keys: list[str]) -> DataFrame:
    """All keys of all tables with the columns of each; a key that a table repeats is refused."""
    for t in tables:
        refuse(repeated(t, keys), "repeated key")
    return reduce(lambda a, b: a.join(b, keys, "full_outer"), tables)


def restricted(df: DataFrame, spine: DataFrame, key: str) -> DataFrame:
    """The rows of df on the spine; a spine key without a row is refused."""
    refuse(spine.select(key).join(df.select(key), key, "left_anti"), "spine key without a row")
    return df.join(spine.select(key), key, "left_semi")


def strict_area(points: DataFrame, polygons: DataFrame, point_key: str, key: str, ring: str, cell: float) -> DataFrame:
    """points with the one polygon that holds each; a point in none or in several is refused."""
    found = spatial.containing(points, polygons, point_key, key, ring, cell)
    refuse(repeated(found, [point_key]), "point in several areas")
    refuse(points.select(point_key).join(found.select(point_key), point_key, "left_anti"), "point in no area")
    return points.join(found, point_key)


def answered(sites: DataFrame, answers: DataFrame, key: str) -> DataFrame:
    """All sites with their answers, null where there is none; an answer of an unknown site is refused."""
    refuse(answers.select(key).join(sites.select(key), key, "left_anti"), "answer of an unknown site")
    return sites.join(answers, key, "left")


def cited(records: DataFrame, citations: DataFrame, key: str, citation: str) -> DataFrame:
    """records with their citation; a record without one is refused."""
    known = citations.where(F.trim(citation) != "").select(key, citation)
    refuse(records.select(key).distinct().join(known.select(key), key, "left_anti"), "no citation")
    return records.join(known, key)


def combined(runs: list[DataFrame], keys: list[str], expected: int | None = None) -> DataFrame:
    """The rows of all runs in key order; other columns, a repeated key and another count than expected are refused."""
    names = runs[0].columns
    for r in runs[1:]:
        if r.columns != names:
            raise ValueError(f"columns differ: {names} and {r.columns}")
    out = reduce(DataFrame.unionByName, runs)
    refuse(repeated(out, keys), "repeated key")
    if expected is not None and (n := out.count()) != expected:
        raise ValueError(f"{n} rows instead of {expected}")
    return out.orderBy(*keys)


def points_table(origins: DataFrame, sites: DataFrame, key: str, counts: tuple[int, int] | None = None) -> DataFrame:
    """role, key, x, y: origins before destinations, each in key order; repeated keys and other counts are refused."""
    parts = [df.select(F.lit(role).alias("role"), F.lit(k).alias("place"), F.col(key), "x", "y") for k, (role, df) in enumerate((("origin", origins), ("destination", sites)))]
    out = parts[0].unionByName(parts[1])
    refuse(repeated(out, ["role", key]), "repeated point")
    refuse(out.where(F.col("x").isNull() | F.col("y").isNull()), "point without coordinates")
    if counts is not None:
        found = {r["role"]: r["n"] for r in out.groupBy("role").agg(F.count("*").alias("n")).collect()}  # two rows
        if (found.get("origin", 0), found.get("destination", 0)) != counts:
            raise ValueError(f"{found} instead of {counts}")
    return out.orderBy("place", key).drop("place")
