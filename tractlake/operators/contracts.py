"""Data-quality contracts: declared expectations, compiled to one aggregate per table, reported as rows.

Every check returns violations(contract, check, detail, count, sample); an empty result means the table holds.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KINDS = {"int": ("int", "bigint", "smallint", "tinyint"), "float": ("double", "float", "int", "bigint", "smallint"), "str": ("string", "void"), "bool": ("boolean",)}
VIOLATION = "contract string, check string, detail string, count bigint, sample array<string>"


@dataclass(frozen=True)
class Field:
    """What one column must be."""

    name: str
    kind: str
    nullable: bool = True
    low: float | None = None
    high: float | None = None
    allowed: tuple[str, ...] | None = None
    pattern: str | None = None


@dataclass(frozen=True)
class Contract:
    """What one table must be."""

    name: str
    fields: tuple[Field, ...]
    key: tuple[str, ...] = ()
    least_rows: int = 0
    most_rows: int | None = None
    labels: dict[str, tuple[str, str]] = field(default_factory=dict)


def _row_checks(contract: Contract, columns: dict[str, str]) -> list[tuple[str, str, Column, Column]]:
    """(check, detail, offending condition, offending value) of the columns that are there and of the right kind."""
    out = []
    for f in contract.fields:
        if f.name not in columns or columns[f.name] not in KINDS[f.kind]:
            continue
        c = F.col(f.name)
        if not f.nullable:
            out.append(("nulls", f.name, c.isNull(), F.lit("null")))
        if f.low is not None:
            out.append(("minimum", f.name, c < f.low, c.cast("string")))
        if f.high is not None:
            out.append(("maximum", f.name, c > f.high, c.cast("string")))
        if f.allowed is not None:
            out.append(("allowed", f.name, c.isNotNull() & ~c.isin(*f.allowed), c))
        if f.pattern is not None:
            out.append(("pattern", f.name, c.isNotNull() & ~c.rlike(f"^(?:{f.pattern})$"), c))
    return out


def violations(df: DataFrame, contract: Contract, weight: str | None = None) -> DataFrame:
    """Every violation of a contract: schema, values, keys, row count and labels, in one pass and one aggregate by key. weight: for how many rows each one stands."""
    times = F.col(weight) if weight else F.lit(1)
    number = lambda bad: F.coalesce(F.sum(F.when(bad, times)), F.lit(0).cast("long"))
    spark = df.sparkSession
    columns = dict(df.dtypes)
    fixed = [(contract.name, "missing column", f.name, 1, []) for f in contract.fields if f.name not in columns]
    fixed += [(contract.name, "kind", f.name, 1, [columns[f.name]]) for f in contract.fields if f.name in columns and columns[f.name] not in KINDS[f.kind]]
    fixed += [(contract.name, "label", k, 1, [found, wanted]) for k, (found, wanted) in contract.labels.items() if found != wanted]
    checks = _row_checks(contract, columns)
    sums = [number(F.lit(True)).alias("rows")]
    for k, (_, _, bad, value) in enumerate(checks):
        sums += [number(bad).alias(f"n{k}"), F.min(F.when(bad, value)).alias(f"low{k}"), F.max(F.when(bad, value)).alias(f"high{k}")]
    one = df.agg(*sums)
    sample = lambda k: F.array_distinct(F.array_compact(F.array(f"low{k}", f"high{k}")))
    rows = [F.struct(F.lit(check).alias("check"), F.lit(detail).alias("detail"), F.col(f"n{k}").alias("count"), sample(k).alias("sample")) for k, (check, detail, _, _) in enumerate(checks)]
    few, many = F.col("rows") < contract.least_rows, F.lit(False) if contract.most_rows is None else F.col("rows") > contract.most_rows
    rows.append(F.struct(F.lit("rows").alias("check"), F.lit("row count").alias("detail"), F.when(few | many, F.col("rows")).otherwise(0).alias("count"), F.array(F.col("rows").cast("string")).alias("sample")))
    out = one.select(F.inline(F.array(*rows))).where("count > 0").select(F.lit(contract.name).alias("contract"), "check", "detail", "count", "sample")
    if contract.key and all(k in columns for k in contract.key):
        keys = df.groupBy(*contract.key).agg(F.sum(times).alias("n"))
        empty = F.lit(False)
        for k in contract.key:
            empty = empty | F.col(k).isNull()
        text = F.concat_ws("|", *[F.col(k).cast("string") for k in contract.key])
        bad = keys.select(F.when(empty, "null key").when(F.col("n") > 1, "duplicate key").alias("check"), text.alias("text")).where("check IS NOT NULL")
        found = bad.groupBy("check").agg(F.count("*").alias("count"), F.array(F.min("text"), F.max("text")).alias("sample"))
        out = out.unionByName(found.select(F.lit(contract.name).alias("contract"), "check", F.lit(",".join(contract.key)).alias("detail"), "count", F.array_distinct("sample").alias("sample")))
    return out.unionByName(spark.createDataFrame(fixed, VIOLATION)) if fixed else out


def enforce(df: DataFrame, contract: Contract) -> DataFrame:
    """df, or an error that names all violations."""
    found = violations(df, contract).limit(100).collect()
    if found:
        raise ValueError("; ".join(f"{v['contract']}: {v['check']} {v['detail']} ({v['count']})" for v in found))
    return df
