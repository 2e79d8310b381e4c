"""Public tables: widened metrics, written tables with a manifest, and the gate they have to pass."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tractlake.functions import expr as X
from tractlake.operators.joins import refuse, repeated

PARTS = ("estimate", "moe", "tier", "action")


def widen(long: DataFrame, key: str, metric: str, metrics: list[str], descriptions: dict[str, str]) -> DataFrame:
    """One row a key with four columns <metric>__<part> a metric; repeated or unknown metrics, and metrics without description, are refused."""
    if nameless := [m for m in metrics if not descriptions.get(m, "").strip()]:
        raise ValueError(f"no description: {nameless}")
    refuse(repeated(long, [key, metric]), "repeated metric")
    refuse(long.where(~F.col(metric).isin(metrics) | F.col(metric).isNull()).select(metric).distinct(), "unknown metric")
    picked = [F.max(F.when(F.col(metric) == m, F.col(p))).alias(f"{m}__{p}") for m in metrics for p in PARTS]
    return long.groupBy(key).agg(*picked)


def digest(df: DataFrame, columns: list[str]) -> Column:
    """An aggregate that doesn't depend on the order of rows: the sum of a number from each row's SHA-256, as text."""
    row = F.sha2(F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("~")) for c in columns]), 256)
    return F.coalesce(F.sum(F.conv(F.substring(row, 1, 12), 16, 10).cast("decimal(28,0)")), F.lit(0)).cast("string")


@dataclass(frozen=True)
class Public:
    """A table to publish, its key, and its license bucket."""

    name: str
    rows: DataFrame
    key: str
    bucket: str


def manifest(tables: list[Public]) -> DataFrame:
    """name, n, bucket, columns and digest of each table: one aggregate a table."""
    out = None
    for t in tables:
        one = t.rows.agg(F.count("*").alias("n"), digest(t.rows, t.rows.columns).alias("digest"))
        one = one.select(F.lit(t.name).alias("name"), "n", F.lit(t.bucket).alias("bucket"), F.lit(",".join(t.rows.columns)).alias("columns"), "digest")
        out = one if out is None else out.unionByName(one)
    return out


def publish(tables: list[Public], folder: str) -> DataFrame:
    """Writes each table in key order, cells escaped, and returns the manifest of what was written."""
    spark = tables[0].rows.sparkSession
    written = []
    for t in tables:
        cells = [X.escaped_formula(c).alias(c) if kind == "string" else F.col(c) for c, kind in t.rows.dtypes]
        t.rows.select(*cells).orderBy(t.key).write.mode("overwrite").parquet(f"{folder}/{t.name}")
        written.append(Public(t.name, spark.read.parquet(f"{folder}/{t.name}"), t.key, t.bucket))
    found = manifest(written)
    found.write.mode("overwrite").parquet(f"{folder}/manifest")
    return spark.read.parquet(f"{folder}/manifest")


def _counted(df: DataFrame, check: str, detail: Column, bad: Column) -> DataFrame:
    return df.where(bad).groupBy(detail.alias("detail")).agg(F.count("*").alias("count")).select(F.lit(check).alias("check"), "detail", "count")


def gate(tables: list[Public], registry: dict[str, str], derived: dict[str, str], other: dict[str, DataFrame], box: tuple[float, float, float, float], edges: dict[str, list[float]]) -> DataFrame:
    """(check, detail, count) of every fault of the tables that go out; no row means that they may.

    registry: the bucket that each known table is filed under; derived: the bucket that its sources ask for; other: a second rendering of
    a table; box: where coordinates x and y have to lie; edges: class edges of columns.
    """
    spark = tables[0].rows.sparkSession
    named = {t.name: t for t in tables}
    fixed = [("registry", f"{n} isn't registered", 1) for n in named if n not in registry] + [("registry", f"{n} is missing", 1) for n in registry if n not in named]
    fixed += [("label", f"{n}: {t.bucket}", 1) for n, t in named.items() if n in derived and t.bucket != max(derived[n], registry.get(n, "A"))]
    fixed += [("bins", c, 1) for c, e in edges.items() if any(b <= a for a, b in zip(e, e[1:], strict=False))]
    slug = [(t.name, c) for t in tables for c in t.rows.columns]
    names = spark.createDataFrame([(f"{n}.{c}", c) for n, c in slug], "detail string, c string")
    out = _counted(names, "name", F.col("detail"), ~X.proper_name("c"))
    for t in tables:
        texts = [c for c, kind in t.rows.dtypes if kind == "string"]
        if texts:
            cells = t.rows.select(F.explode(F.array(*[F.struct(F.lit(f"{t.name}.{c}").alias("detail"), F.col(c).alias("v")) for c in texts])).alias("s")).select("s.*")
            out = out.unionByName(_counted(cells, "cell", F.col("detail"), ~X.safe_cell("v")))
            leaks = cells.select("detail", F.explode(X.leak_labels("v")).alias("label"))
            out = out.unionByName(_counted(leaks, "leak", F.concat_ws(": ", "detail", "label"), F.lit(True)))
        if {"x", "y"} <= set(t.rows.columns):
            out = out.unionByName(_counted(t.rows, "bounds", F.lit(t.name), ~X.in_box("x", "y", box)))
        out = out.unionByName(_counted(repeated(t.rows, [t.key]), "key", F.lit(f"{t.name}.{t.key}"), F.lit(True)))
        if t.name in other:
            a, b = t.rows.groupBy(t.key).agg(F.count("*").alias("a")), other[t.name].groupBy(t.key).agg(F.count("*").alias("b"))
            both = a.join(b, t.key, "full_outer")
            out = out.unionByName(_counted(both, "parity", F.lit(t.name), ~F.col("a").eqNullSafe(F.col("b"))))
    return out.unionByName(spark.createDataFrame(fixed, "check string, detail string, count bigint")) if fixed else out
