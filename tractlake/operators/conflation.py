"""Conflation: one entity for records of several sources that stand for the same place.

Records match across sources only, so two of one source never merge, however close they lie. Candidates come from an equi-join on a cell of
twice the radius, the length of the name and one of the parts that the name is cut into: names within `edits` edits have at least one of edits + 1
parts in common, so no match is lost and names that differ never meet because a spot is crowded.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tractlake.operators.joins import refuse, repeated
from tractlake.operators.keeping import cut
from tractlake.operators.network import component_labels


def plain_name(name: Column) -> Column:
    """Lower case, every run of other characters than letters and digits one space."""
    return F.trim(F.regexp_replace(F.lower(F.coalesce(name, F.lit(""))), r"[^\p{L}\p{N}]+", " "))


def cuts(length: Column, edits: int) -> list[tuple[Column, Column]]:
    """Where each of edits + 1 parts of a name of some length begins (from 0), and how long it is."""
    parts = edits + 1
    begin = lambda i: F.floor(length * i / parts).cast("int")
    return [(begin(i), begin(i + 1) - begin(i)) for i in range(parts)]


def names_nearby(records: DataFrame, radius: float, edits: int) -> DataFrame:
    """name, cx, cy, name_b, cx_b, cy_b and edits of the names of neighbouring cells within so many edits: a name once for a cell, however many records have it.

    If names match, one of the edits + 1 parts of the one stands in the other unchanged with k edits at most before it, k parts lying before it, and the
    rest at most behind it; so part k moves by k places at most, and by no more than the rest off the difference in length.
    """
    box = [f(c).alias(n) for n, f, c in (("west", F.min, "x"), ("east", F.max, "x"), ("south", F.min, "y"), ("north", F.max, "y"))]
    names = cut(records.groupBy("name", "cx", "cy").agg(*box).withColumn("l", F.length("name")))
    parts = F.array(*[F.struct(F.lit(i).alias("i"), F.substring(F.col("name"), at + 1, n).alias("part")) for i, (at, n) in enumerate(cuts(F.col("l"), edits))])
    posted = names.select(F.col("name").alias("name_b"), F.col("cx").alias("cx_b"), F.col("cy").alias("cy_b"), "l", F.inline(parts))
    around = lambda low, high: F.explode(F.sequence(F.floor((F.col(low) - radius) / (2 * radius)), F.floor((F.col(high) + radius) / (2 * radius))))
    asked = names.select("name", "cx", "cy", F.col("l").alias("own"), "south", "north", around("west", "east").alias("cx_b")).withColumn("cy_b", around("south", "north"))
    asked = asked.withColumn("l", F.explode(F.sequence(F.greatest(F.col("own") - edits, F.lit(0)), F.col("own") + edits)))
    moved = [_shifted(F.col("own") - F.col("l"), at, n, k, edits) for k, (at, n) in enumerate(cuts(F.col("l"), edits))]
    asked = asked.select("name", "cx", "cy", "cx_b", "cy_b", "l", F.explode(F.array_distinct(F.flatten(F.array(*moved)))).alias("p")).select("*", "p.i", "p.part").drop("p").where("part is not null")
    met = asked.join(posted, ["cx_b", "cy_b", "l", "i", "part"]).select("name", "cx", "cy", "name_b", "cx_b", "cy_b", F.levenshtein("name", "name_b", edits).alias("edits"))
    return met.where("edits >= 0").distinct()


def candidates(records: DataFrame, radius: float, edits: int) -> DataFrame:
    """(a, b, source_b, edits, metres), both ways, of records(id, source, rank, name, x, y) of different sources that match. Names meet first, each once for a cell."""
    at = lambda c: F.floor(F.col(c) / (2 * radius))
    r = records.select("id", "source", "name", "x", "y", at("x").alias("cx"), at("y").alias("cy"))
    b = r.select(F.col("id").alias("b"), *[F.col(c).alias(f"{c}_b") for c in ("source", "name", "x", "y", "cx", "cy")])
    metres = F.hypot(F.col("x") - F.col("x_b"), F.col("y") - F.col("y_b"))
    both = r.withColumnRenamed("id", "a").join(names_nearby(r, radius, edits), ["name", "cx", "cy"]).join(b, ["name_b", "cx_b", "cy_b"])
    return both.where((F.col("source") != F.col("source_b")) & (metres <= radius)).select("a", "b", "source", "source_b", "edits", metres.alias("metres"))


def _shifted(longer: Column, at: Column, n: Column, k: int, edits: int) -> Column:
    """The parts of a name that could stand for part k of one that it is longer than by so much."""
    ways = F.filter(F.sequence(F.lit(-k), F.lit(k)), lambda d: F.abs(longer - d) <= edits - k)
    return F.transform(ways, lambda d: F.struct(F.lit(k).alias("i"), F.when(at + d >= 0, F.substring(F.col("name"), at + d + 1, n)).alias("part")))


def conflate(records: DataFrame, key: str, source: str, name: str, ranks: dict[str, int], radius: float, edits: int = 2) -> DataFrame:
    """key, entity (the key of the record that stands for it), kept, and n (records of the entity), for each of records(key, source, name, x, y).

    A record's match in another source is the one with fewest edits, then nearest, then of the smallest key; two records belong together if each is the
    other's match. Of the records that hang together through matches an entity takes one of each source, the one that matches best; the others
    stay entities of their own. The record of the source with the lowest rank is kept. Keys that stand twice are refused, and so are
    sources without a rank; records without name or coordinates match nothing.
    """
    refuse(repeated(records, [key]), "keys aren't unique")
    rank = F.coalesce(*[F.when(F.col(source) == s, r) for s, r in ranks.items()])
    named = records.select(F.col(key).alias("id"), F.col(source).alias("source"), rank.alias("rank"), plain_name(F.col(name)).alias("name"), F.col("x").cast("double").alias("x"), F.col("y").cast("double").alias("y"))
    refuse(named.where("rank is null").select("source").distinct(), "sources without a rank")
    named = cut(named)
    pairs = candidates(named.where("name <> '' and x is not null and y is not null"), radius, edits)
    best = cut(pairs.groupBy("a", "source_b").agg(F.min(F.struct("edits", "metres", "b")).alias("m")).select("a", "m.*"))
    mutual = cut(best.join(best.select(F.col("a").alias("b"), F.col("b").alias("a")), ["a", "b"]))
    strength = mutual.groupBy(F.col("a").alias("id")).agg(F.min(F.struct("edits", "metres")).alias("strength"))
    labels = component_labels(mutual.where("a < b").select(F.col("a").alias("src"), F.col("b").alias("dst"), F.lit(1.0).alias("length"))).withColumnRenamed("node", "id")
    in_one = cut(labels.join(strength, "id").join(named.select("id", "source", "rank"), "id"))
    stays = in_one.groupBy("label", "source").agg(F.min(F.struct("strength", "id", "rank")).alias("s")).select("label", "s.id", "s.rank")
    heads = stays.groupBy("label").agg(F.min(F.struct("rank", "id")).alias("h"), F.count("*").alias("n")).select("label", F.col("h.id").alias("entity"), "n")
    members = stays.join(heads, "label").select("id", "entity", "n")
    out = named.select("id").join(members, "id", "left")
    return out.select(F.col("id").alias(key), F.coalesce("entity", "id").alias("entity"), (F.coalesce("entity", "id") == F.col("id")).alias("kept"), F.coalesce("n", F.lit(1)).alias("n"))
