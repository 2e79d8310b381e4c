"""Catalog operators: search, facets, export and synchronisation of dataset records."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MEDIA_TYPES = {"CSV": "text/csv", "GEOJSON": "application/vnd.geo+json", "JSON": "application/json", "XSLX": "application/vnd.openxmlformats-officedocument.spreadsheetml.sheet", "HTML": "text/html", "SHP": "application/zip"}


def keyword(columns: list[str], words: str) -> Column:
    """Whether any of the columns contains the words, in lower case; null columns don't."""
    out = F.lit(False)
    for c in columns:
        out = out | F.coalesce(F.contains(F.lower(F.col(c)), F.lit(words.lower())), F.lit(False))
    return out


def facet(records: DataFrame, by: str, chosen: Column) -> DataFrame:
    """by, all records, chosen records of each value of a column."""
    return records.groupBy(by).agg(F.count("*").alias("all"), F.count_if(chosen).alias("chosen"))


def media_type(fmt: Column) -> Column:
    out = F.lit("application/octet-stream")
    for name, kind in MEDIA_TYPES.items():
        out = F.when(F.upper(fmt) == name, kind).otherwise(out)
    return out


def differing(old: dict[str, Column], new: dict[str, Column]) -> Column:
    """Names of the fields that differ; missing equals null."""
    return F.array_compact(F.array(*[F.when(~old[k].eqNullSafe(new[k]), F.lit(k)) for k in old]))


def sync_plan(old: DataFrame, new: DataFrame, key: str, fields: list[str], protected: Column | None = None) -> DataFrame:
    """key, action (add, update, delete, unchanged or excluded) and the changed fields."""
    a = old.select(F.col(key).alias("k"), *[F.col(f).alias(f"{f}__old") for f in fields], F.lit(True).alias("was"))
    b = new.select(F.col(key).alias("k"), *[F.col(f).alias(f"{f}__new") for f in fields], F.lit(True).alias("is"))
    both = a.join(b, "k", "full_outer")
    changed = differing({f: F.col(f"{f}__old") for f in fields}, {f: F.col(f"{f}__new") for f in fields})
    action = F.when(F.lit(False) if protected is None else protected, "excluded").when(F.col("was").isNull(), "add").when(F.col("is").isNull(), "delete").when(F.size(changed) > 0, "update").otherwise("unchanged")
    return both.select(F.col("k").alias(key), action.alias("action"), F.when(action == "update", changed).otherwise(F.array().cast("array<string>")).alias("changed"))


def folded_slug(c: Column) -> Column:
    """The second slug rule: accents off, other characters than ASCII dropped, marks dropped, blanks and hyphens folded to one hyphen, none at the ends."""
    plain = F.translate(F.lower(c), "àáâãäåçèéêëìíîïñòóôõöùúûüýÿ", "aaaaaaceeeeiiiinooooouuuuyy")
    kept = F.regexp_replace(F.regexp_replace(plain, r"[^\x00-\x7F]", ""), r"[^a-z0-9_\s-]", "")
    return F.regexp_replace(F.regexp_replace(F.trim(kept), r"[-\s]+", "-"), "^-+|-+$", "")


def searched(records: DataFrame, words: str) -> DataFrame:
    """records whose title, notes, tags or resource names contain the words, in lower case; missing parts contain nothing."""
    text = F.concat_ws("\n", "title", "notes", F.array_join("tags", " "), F.array_join(F.transform("resources", lambda r: r["name"]), " "))
    return records.where(F.contains(F.lower(text), F.lit(words.lower())))


def category_facet(records: DataFrame, chosen: Column, selected: str | None) -> DataFrame:
    """category, all, chosen and selected for every category of records(categories array)."""
    each = records.select(F.explode(F.array_distinct("categories")).alias("category"), chosen.alias("c"))
    return each.groupBy("category").agg(F.count("*").alias("all"), F.count_if("c").alias("chosen")).withColumn("selected", F.coalesce(F.col("category") == F.lit(selected), F.lit(False)))


def mapped_categories(records: DataFrame, key: str, names: str, mapping: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(key, categories) with the mapped names of each record in first-seen order, once each; and (name, records) for names that mapping(name, category) lacks."""
    each = records.select(key, F.posexplode(names).alias("place", "name"))
    met = each.join(mapping.select("name", "category"), "name", "left")
    order = F.array_sort(F.collect_list(F.struct("place", "category")))
    found = met.where("category IS NOT NULL").groupBy(key).agg(F.array_distinct(F.transform(order, lambda s: s["category"])).alias("categories"))
    unknown = met.where("category IS NULL").groupBy("name").agg(F.count_distinct(key).alias("records"))
    return records.select(key).join(found, key, "left").select(key, F.coalesce("categories", F.array().cast("array<string>")).alias("categories")), unknown


def cleaned(html: Column) -> Column:
    """A description without tags, entities decoded, blanks folded."""
    from tractlake.functions.expr import visible_text

    return visible_text(html)


def hub_record(records: DataFrame, prefix: str, base: str) -> DataFrame:
    """Catalog records from records(id, title, description, created_ms, modified_ms, url): prefixed title, cleaned description, dates, four resources."""
    day = lambda c: F.date_format(F.timestamp_millis(c), "yyyy-MM-dd")
    link = lambda name, fmt, tail: F.struct(F.lit(name).alias("name"), F.lit(fmt).alias("format"), F.concat(F.lit(base), F.col("id").cast("string"), F.lit(tail)).alias("url"))
    resources = F.array(F.struct(F.lit("Page").alias("name"), F.lit("HTML").alias("format"), F.col("url").alias("url")), link("Table", "CSV", ".csv"), link("Features", "GEOJSON", ".geojson"), link("Shapes", "SHP", ".zip"))
    return records.select("id", F.concat(F.lit(prefix), "title").alias("title"), cleaned(F.col("description")).alias("notes"), day("created_ms").alias("created"), day("modified_ms").alias("modified"), resources.alias("resources"))


def dcat(records: DataFrame, contacts: dict[str, tuple[str, str]], fallback: tuple[str, str]) -> DataFrame:
    """Export rows of records(id, title, notes, publisher, keywords, modified, license, resources): contact by publisher, keywords split and in lower case,
    a distribution for each resource, whose address is a download only for files."""
    who = lambda k: reduce(lambda a, kv: F.when(F.col("publisher") == kv[0], kv[1][k]).otherwise(a), contacts.items(), F.lit(fallback[k]))
    words = F.filter(F.transform(F.split(F.lower(F.coalesce("keywords", F.lit(""))), " / "), F.trim), lambda w: w != "")
    page = lambda r: F.upper(r["format"]).isin("HTML", "API")
    spread = F.transform("resources", lambda r: F.struct(r["name"].alias("title"), media_type(r["format"]).alias("mediaType"), F.when(page(r), r["url"]).alias("accessURL"), F.when(~page(r), r["url"]).alias("downloadURL")))
    return records.select("id", "title", F.col("notes").alias("description"), "publisher", F.struct(who(0).alias("fn"), who(1).alias("hasEmail")).alias("contactPoint"), words.alias("keyword"), "modified", "license", spread.alias("distribution"))


def full_sync_plan(old: DataFrame, new: DataFrame, key: str, fields: list[str], owner: str, mine: str, protected: list[str]) -> DataFrame:
    """key, action and changed, as sync_plan; a new record whose key another owner's record has is a collision, and only own records are deleted."""
    a = old.select(F.col(key).alias("k"), F.col(owner).alias("owner"), *[F.col(f).alias(f"{f}__old") for f in fields])
    b = new.select(F.col(key).alias("k"), F.lit(True).alias("is"), *[F.col(f).alias(f"{f}__new") for f in fields])
    both = a.join(b, "k", "full_outer").where((F.col("owner") == mine) | F.col("is"))
    changed = differing({f: F.col(f"{f}__old") for f in fields}, {f: F.col(f"{f}__new") for f in fields})
    action = F.when(F.col("k").isin(protected), "excluded").when(F.col("owner").isNull(), "add").when(F.col("owner") != mine, "collision").when(F.col("is").isNull(), "delete").when(F.size(changed) > 0, "update").otherwise("unchanged")
    return both.select(F.col("k").alias(key), action.alias("action"), F.when(action == "update", changed).otherwise(F.array().cast("array<string>")).alias("changed"))


def organizations(packages: DataFrame) -> DataFrame:
    """slug, title, description and packages of each organization of packages(organization struct<name, title, description>); the first description by
    alphabet, an empty one if there is none."""
    o = packages.where("organization.title IS NOT NULL").select(F.col("organization.title").alias("title"), F.nullif(F.trim("organization.description"), F.lit("")).alias("text"))
    return o.groupBy("title").agg(F.min("text").alias("text"), F.count("*").alias("packages")).select(folded_slug(F.col("title")).alias("slug"), "title", F.coalesce("text", F.lit("")).alias("description"), "packages")
