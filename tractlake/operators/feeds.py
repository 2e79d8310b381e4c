"""Transit feeds: what they lack, their window, the services of given days, and counts; one row a feed."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tractlake.functions import expr as X

#: Columns of a weekly calendar, Monday first.
DAYS = ("monday", "tuesday", "wednesday", "thursday", "friday", "saturday", "sunday")


def services_on(calendar: DataFrame, exceptions: DataFrame, day: str) -> DataFrame:
    """(feed, service_id) that run on a day: by the weekly calendar(feed, service_id, monday.., start_date, end_date) and exceptions(feed, service_id, date,
    exception_type 1 added or 2 removed). Of several exceptions for one day the removal holds."""
    when = F.lit(day).cast("date")
    weekly = F.element_at(F.array(*[F.col(d) == 1 for d in DAYS]), F.weekday(when) + 1)
    key = ["feed", "service_id"]
    base = calendar.where(weekly & when.between(F.col("start_date"), F.col("end_date"))).select(*key)
    that_day = exceptions.where(F.col("date") == when)
    added, removed = (that_day.where(F.col("exception_type") == k).select(*key) for k in (1, 2))
    return base.unionByName(added).distinct().join(removed, key, "left_anti")


def summary(feeds: DataFrame, present: DataFrame, required: dict[str, list[str]], calendar: DataFrame, exceptions: DataFrame, stops: DataFrame, counted: dict[str, DataFrame], days: dict[str, str], box: tuple[float, float, float, float]) -> DataFrame:
    """One row for each of feeds(feed, first_day, last_day): missing (required files, or file:column), covers_<name> and services_<name> of each named day,
    stops, stops_outside_box (without coordinates too), and the rows of each counted table(feed).

    present(feed, file, column) names the columns that a feed's files have, with a null column for a file without any.
    """
    wanted = [f for f in required] + [f"{f}:{c}" for f, columns in required.items() for c in columns]
    there = present.select("feed", F.explode(F.array("file", F.concat_ws(":", "file", "column"))).alias("name")).where(F.col("name").isin(wanted)).groupBy("feed").agg(F.collect_set("name").alias("there"))
    out = feeds.join(there, "feed", "left")
    lacks = F.array_except(F.array(*map(F.lit, wanted)), F.coalesce("there", F.array().cast("array<string>")))
    lacks = F.filter(lacks, lambda n: ~n.contains(":") | ~F.array_contains(lacks, F.substring_index(n, ":", 1)))  # a file that isn't there lacks no columns
    out = out.select("feed", "first_day", "last_day", F.array_sort(lacks).alias("missing"), *[F.coalesce(F.lit(d).cast("date").between(F.col("first_day"), F.col("last_day")), F.lit(False)).alias(f"covers_{n}") for n, d in days.items()])
    counts = {f"services_{n}": services_on(calendar, exceptions, d) for n, d in days.items()} | {"stops": stops, "stops_outside_box": stops.where(~X.in_box("x", "y", box))} | counted
    for name, df in counts.items():
        out = out.join(df.groupBy("feed").agg(F.count("*").alias(name)), "feed", "left").withColumn(name, F.coalesce(name, F.lit(0)))
    return out
