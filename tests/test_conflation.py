"""Names of many records meet once, and lose no match."""

from __future__ import annotations

from pyspark.sql import functions as F

from tractlake.operators import conflation


def test_names_meet_once_for_a_cell(spark):
    """Two names of 300 records in one cell make four pairs of names (before, every record asked for itself)."""
    rows = [(k, "market 12" if k % 2 else "markt 12", float(k % 10), 5.0) for k in range(300)]
    r = spark.createDataFrame(rows, "id long, name string, x double, y double").withColumn("cx", F.lit(0).cast("long")).withColumn("cy", F.lit(0).cast("long"))
    got = [(p["name"], p["name_b"], p["edits"]) for p in conflation.names_nearby(r, 10.0, 2).collect()]
    assert sorted(got) == [("market 12", "market 12", 0), ("market 12", "markt 12", 1), ("markt 12", "market 12", 1), ("markt 12", "markt 12", 0)]
