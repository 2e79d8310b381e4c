"""Opening hours as flags: from free text with months, or from an opening and a closing column for each day. Columns only."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values that results depend on.
DAYS = ("monday", "tuesday", "wednesday", "thursday", "friday", "saturday", "sunday")
MONTHS = ("january", "february", "march", "april", "may", "june", "july", "august", "september", "october", "november", "december")
IN_SEASON_MONTH, OFF_SEASON_MONTH = 6, 2
ALL_YEAR = "year-round"
CLOCK = r"(\d{1,2}):([0-5]\d)\s*(am|pm)?"
RANGE = rf"{CLOCK}\s*-\s*{CLOCK}"
DAY_NAME = "(" + "|".join(DAYS) + ")s?"
#: Days, ranges and the words and marks that may join them; any other text is malformed.
WHOLE = rf"^({DAY_NAME}|{RANGE}|and|to|[,&;-]|\s)+$"


def minutes(hour: Column, minute: Column, half: Column) -> Column:
    """Minutes after midnight; null for a clock that there isn't."""
    h, m = hour.try_cast("int"), minute.try_cast("int")
    twelve = F.when(h.between(1, 12), h % 12 + F.when(half == "pm", 12).otherwise(0))
    hours = F.when(half != "", twelve).when(h <= 24, h)
    return F.when((hours * 60 + m) <= 24 * 60, hours * 60 + m)


def once(df: DataFrame, name: str, **values: Column) -> DataFrame:
    """df with a struct of values, each worked out once a row: a generator stands between them and the expressions that use them."""
    return df.select("*", F.explode(F.array(F.struct(*[v.alias(k) for k, v in values.items()]))).alias(name))


def day_flags(text: Column, first: Column, last: Column) -> Column:
    """For each day of the week whether a lower-cased text names it, alone or inside the span from the first to the last place (0: no span)."""
    numbered = F.array(*[F.struct(F.lit(k).alias("k"), F.lit(d).alias("d")) for k, d in enumerate(DAYS, 1)])
    inside = lambda k: (first > 0) & F.when(first <= last, k.between(first, last)).otherwise((k >= first) | (k <= last))
    return F.transform(numbered, lambda day: F.contains(text, day["d"]) | F.coalesce(inside(day["k"]), F.lit(False)))


def in_month(whole_year: Column, first: Column, last: Column, month: int) -> Column:
    """Whether a span of months, by the places of its ends (0: none), holds a month; null if it can't be read."""
    wraps = F.when(first <= last, F.lit(month).between(first, last)).otherwise((F.lit(month) >= first) | (F.lit(month) <= last))
    return F.when(whole_year, F.lit(True)).when((first > 0) & (last > 0), wraps)


def _flagged(sites: DataFrame, status: Column, days: Column, season: Column, off_season: Column) -> DataFrame:
    """sites with the status and four flags; days: an array of seven."""
    fine = lambda c: F.when(F.col("hours_status") == "parsed", c)
    some = lambda at, n: F.exists(F.slice(days, at, n), lambda x: x)
    out = sites.withColumn("hours_status", status)
    return out.withColumns({"open_weekday": fine(some(1, 5)), "open_weekend": fine(some(6, 2)), "open_in_season": fine(season), "open_off_season": fine(off_season)})


def from_text(sites: DataFrame, hours: str = "hours", months: str = "months") -> DataFrame:
    """sites with hours_status (parsed, missing or malformed) and four flags, null unless parsed; a missing span of months is the whole year."""
    place = lambda name, names: F.array_position(F.array(*map(F.lit, names)), name)
    month = f"({'|'.join(MONTHS)})"
    of = once(sites, "text__", h=F.lower(F.trim(hours)), m=F.lower(F.coalesce(F.col(months), F.lit(ALL_YEAR))))
    h, m = F.col("text__.h"), F.col("text__.m")
    days, span = rf"{DAY_NAME}\s*(-|to)\s*{DAY_NAME}", rf"^\s*{month}\s*-\s*{month}\s*$"
    of = once(of, "found__", clocks=F.regexp_extract(h, RANGE, 0), days=F.regexp_extract(h, days, 0), whole=h.rlike(WHOLE), year=F.trim(m) == ALL_YEAR, m1=place(F.regexp_extract(m, span, 1), MONTHS), m2=place(F.regexp_extract(m, span, 2), MONTHS))
    clocks = F.col("found__.clocks")
    of = once(of, "part__", **{f"c{k}": F.regexp_extract(clocks, RANGE, k) for k in range(1, 7)}, d1=place(F.regexp_extract("found__.days", days, 1), DAYS), d2=place(F.regexp_extract("found__.days", days, 3), DAYS))
    part = lambda k: F.col(f"part__.c{k}")
    # "9:00 - 1:00 PM": a first clock without a half has that of the second, or is in the morning if it would come too late.
    same = minutes(part(1), part(2), F.when(part(3) == "", part(6)).otherwise(part(3)))
    early = minutes(part(1), part(2), F.when(part(6) == "", "").otherwise("am"))
    of = once(of, "at__", closes=minutes(part(4), part(5), part(6)), same=same, early=early, days=day_flags(h, F.col("part__.d1"), F.col("part__.d2")))
    closes, same = F.col("at__.closes"), F.col("at__.same")
    opens = F.when((part(3) == "") & ~F.coalesce(same < closes, F.lit(False)), F.col("at__.early")).otherwise(same)
    in_ = lambda month: in_month(F.col("found__.year"), F.col("found__.m1"), F.col("found__.m2"), month)
    of = once(of, "read__", fine=F.col("found__.whole") & (opens < closes) & F.exists("at__.days", lambda x: x) & in_(IN_SEASON_MONTH).isNotNull(), blank=F.coalesce(h, F.lit("")) == "", season=in_(IN_SEASON_MONTH), off=in_(OFF_SEASON_MONTH))
    status = F.when(F.col("read__.blank"), "missing").when(F.coalesce("read__.fine", F.lit(False)), "parsed").otherwise("malformed")
    return _flagged(of, status, F.col("at__.days"), F.col("read__.season"), F.col("read__.off")).drop("text__", "found__", "part__", "at__", "read__")


def from_days(sites: DataFrame) -> DataFrame:
    """The same from columns <day>_open and <day>_close (mon to sun) with times HH:MM: all null is missing, half a pair or no time is malformed."""
    clock = lambda c: F.when(F.col(c).rlike(r"^([01]\d|2[0-3]):[0-5]\d$"), F.col(c))
    names = [d[:3] for d in DAYS]
    empty = reduce(lambda a, b: a & b, [F.col(f"{n}_{e}").isNull() for n in names for e in ("open", "close")])
    bad = reduce(lambda a, b: a | b, [(F.col(f"{n}_open").isNotNull() | F.col(f"{n}_close").isNotNull()) & ~F.coalesce(clock(f"{n}_open") < clock(f"{n}_close"), F.lit(False)) for n in names])
    days = F.array(*[F.col(f"{n}_open").isNotNull() for n in names])
    status = F.when(empty, "missing").when(bad, "malformed").otherwise("parsed")
    return _flagged(sites, status, days, F.lit(True), F.lit(True))


def without_hours(sites: DataFrame) -> DataFrame:
    """Sites of a source that has no hours."""
    return _flagged(sites, F.lit("not_in_source"), F.array(*[F.lit(False)] * 7), F.lit(False), F.lit(False))


def coverage(sites: DataFrame, by: str) -> DataFrame:
    """by, sites, parsed and percent of sites whose hours could be read; sources without hours don't count."""
    counted = sites.where("hours_status <> 'not_in_source'").groupBy(by).agg(F.count("*").alias("sites"), F.count_if(F.col("hours_status") == "parsed").alias("parsed"))
    return counted.withColumn("percent", F.round(100 * F.col("parsed") / F.col("sites"), 6))
