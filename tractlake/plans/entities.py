"""Queries of entity resolution, lineage of any depth, crowded points and large files."""

from __future__ import annotations

from pyspark.sql import functions as F

from tractlake.operators import conflation, lineage, tree
from tractlake.plans.base import Book
from tractlake.plans.standins import read, sites, with_sql
from tractlake.sources import tables

BOOK = Book()
query = BOOK.add

# --- one place in three sources: suppliers, and customers and parts close by under names that differ a little or much

_RECORDS = (
    with_sql("sites")
    + """
, base AS (SELECT site_id, x, y, 'Market ' || site_id * 7919 % 100000 AS name FROM sites
), given AS (
  SELECT 's' || site_id AS id, 'city' AS source, 1 AS rank, name, x, y FROM base
  UNION ALL SELECT 'c' || c_custkey, 'state', 2, CASE c_custkey % 4 WHEN 0 THEN upper(name) WHEN 1 THEN 'N' || name[2:] WHEN 2 THEN name || ' co' ELSE replace(name, ' ', ' - ') END, x + c_custkey % 5 * 20, y
    FROM customer JOIN base ON site_id = c_custkey // 15
  UNION ALL SELECT 'p' || p_partkey, 'survey', 3, CASE p_partkey % 3 WHEN 0 THEN name || 's' WHEN 1 THEN name || 'xyz' ELSE 'the ' || name END, x, y + p_partkey % 7 * 20
    FROM part JOIN base ON site_id = p_partkey // 20
), r AS (SELECT id, source, rank, x, y, trim(regexp_replace(lower(name), '[^\\p{L}\\p{N}]+', ' ', 'g')) AS name FROM given
), pairs AS (
  SELECT a.id AS a, b.id AS b, b.source AS source_b, levenshtein(a.name, b.name) AS edits, sqrt((a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y)) AS metres
  FROM r a JOIN r b ON a.source <> b.source AND abs(a.x - b.x) <= 100 AND abs(a.y - b.y) <= 100 AND levenshtein(a.name, b.name) <= 2
), best AS (
  SELECT a, b, edits, metres FROM (SELECT *, row_number() OVER (PARTITION BY a, source_b ORDER BY edits, metres, b) AS k FROM pairs WHERE metres <= 100) WHERE k = 1
), mutual AS MATERIALIZED (SELECT x.* FROM best x JOIN best y ON x.a = y.b AND x.b = y.a
), reach AS (
  SELECT a AS id, a AS other FROM mutual UNION SELECT reach.id, m.b FROM reach JOIN mutual m ON reach.other = m.a
), labels AS (SELECT id, min(other) AS label FROM reach GROUP BY 1
), strength AS (SELECT a AS id, edits, metres FROM (SELECT *, row_number() OVER (PARTITION BY a ORDER BY edits, metres) AS k FROM mutual) WHERE k = 1
), stays AS (
  SELECT label, id, rank FROM (SELECT label, l.id, rank, row_number() OVER (PARTITION BY label, source ORDER BY edits, metres, l.id) AS k FROM labels l JOIN strength s ON l.id = s.id JOIN r ON l.id = r.id) WHERE k = 1
), heads AS (SELECT label, id AS entity, n FROM (SELECT label, id, row_number() OVER (PARTITION BY label ORDER BY rank, id) AS k, count(*) OVER (PARTITION BY label) AS n FROM stays) WHERE k = 1
), members AS (SELECT s.id, h.entity, h.n FROM stays s JOIN heads h ON s.label = h.label)
SELECT r.id, coalesce(entity, r.id) AS entity, coalesce(entity, r.id) = r.id AS kept, coalesce(n, 1) AS n FROM r LEFT JOIN members m ON r.id = m.id
"""
).replace("WITH ", "WITH RECURSIVE ", 1)


@query("u5_conflation", _RECORDS)
def _(spark, d):
    base = sites(spark, d).select("site_id", "x", "y", F.concat(F.lit("Market "), (F.col("site_id") * 7919 % 100000).cast("string")).alias("name"))
    name, c, p = F.col("name"), F.col("c_custkey"), F.col("p_partkey")
    city = base.select(F.concat(F.lit("s"), "site_id").alias("id"), F.lit("city").alias("source"), "name", "x", "y")
    odd = F.when(c % 4 == 0, F.upper(name)).when(c % 4 == 1, F.concat(F.lit("N"), F.substring(name, 2, 99))).when(c % 4 == 2, F.concat(name, F.lit(" co"))).otherwise(F.replace(name, F.lit(" "), F.lit(" - ")))
    state = read(spark, d, "customer").withColumn("site_id", F.floor(c / 15)).join(base, "site_id").select(F.concat(F.lit("c"), c).alias("id"), F.lit("state").alias("source"), odd.alias("name"), (F.col("x") + c % 5 * 20).alias("x"), "y")
    longer = F.when(p % 3 == 0, F.concat(name, F.lit("s"))).when(p % 3 == 1, F.concat(name, F.lit("xyz"))).otherwise(F.concat(F.lit("the "), name))
    survey = read(spark, d, "part").withColumn("site_id", F.floor(p / 20)).join(base, "site_id").select(F.concat(F.lit("p"), p).alias("id"), F.lit("survey").alias("source"), longer.alias("name"), "x", (F.col("y") + p % 7 * 20).alias("y"))
    return conflation.conflate(city.unionByName(state).unionByName(survey), "id", "source", "name", {"city": 1, "state": 2, "survey": 3}, 100.0)


# --- lineage: chains of 200 tables, with branches and cycles

_LINEAGE = "e AS (SELECT p_partkey AS child, p_partkey - 1 AS parent FROM part WHERE p_partkey % 200 <> 0 UNION ALL SELECT p_partkey, p_partkey - 7 FROM part WHERE p_partkey % 11 = 0 AND p_partkey % 200 > 7 UNION ALL SELECT p_partkey, p_partkey + 2 FROM part WHERE p_partkey % 200 = 150 AND p_partkey + 2 IN (SELECT p_partkey FROM part)), up AS (SELECT child, parent FROM e UNION SELECT up.child, e.parent FROM up JOIN e ON up.parent = e.child)"


def _lineage(spark, d):
    k, part = F.col("p_partkey"), read(spark, d, "part").select("p_partkey")
    step = part.where(k % 200 != 0).select(k.alias("child"), (k - 1).alias("parent"))
    branch = part.where((k % 11 == 0) & (k % 200 > 7)).select(k.alias("child"), (k - 7).alias("parent"))
    back = part.where(k % 200 == 150).select(k.alias("child"), (k + 2).alias("parent")).join(part.select(k.alias("parent")), "parent", "left_semi").select("child", "parent")
    return step.unionByName(branch).unionByName(back)


@query("l1_deep_sources", f"WITH RECURSIVE {_LINEAGE} SELECT child, parent AS source FROM up WHERE parent NOT IN (SELECT child FROM e)")
def _(spark, d):
    edges = _lineage(spark, d)
    return lineage.raw_sources(edges, edges.select("child").distinct())


@query("l1_cycles", f"WITH RECURSIVE {_LINEAGE} SELECT child FROM up WHERE child = parent")
def _(spark, d):
    return lineage.cycles(_lineage(spark, d))


# --- points of which nine in ten lie in one spot

_CROWD = "crowd AS (SELECT l_orderkey * 10 + l_linenumber AS id, CASE WHEN l_orderkey % 10 < 9 THEN 5000 + l_partkey % 41 ELSE l_partkey * 7919 % 27000 END AS x, CASE WHEN l_orderkey % 10 < 9 THEN 5000 + l_suppkey % 37 ELSE l_suppkey * 104729 % 28000 END AS y FROM lineitem)"


def _crowd(spark, d):
    dense = F.col("l_orderkey") % 10 < 9
    x = F.when(dense, 5000 + F.col("l_partkey") % 41).otherwise(F.col("l_partkey") * 7919 % 27000)
    y = F.when(dense, 5000 + F.col("l_suppkey") % 37).otherwise(F.col("l_suppkey") * 104729 % 28000)
    return read(spark, d, "lineitem").select((F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("id"), x.alias("x"), y.alias("y"))


@query("c7_crowded_targets", with_sql("sites") + f", {_CROWD}, far AS (SELECT s.site_id, c.id, (s.x - c.x) * (s.x - c.x) + (s.y - c.y) * (s.y - c.y) AS q FROM sites s, crowd c) SELECT site_id, min(id) AS id, round(sqrt(min(q)), 3) AS metres FROM (SELECT *, min(q) OVER (PARTITION BY site_id) AS least FROM far) WHERE q = least GROUP BY 1")
def _(spark, d):
    return tree.nearest(sites(spark, d), _crowd(spark, d), "site_id", "id").select("site_id", "id", F.round("distance", 3).alias("metres"))


@query("c14_crowded_counts", with_sql("sites") + f", {_CROWD} SELECT site_id, count(id) AS n FROM sites s LEFT JOIN crowd c ON (s.x - c.x) * (s.x - c.x) + (s.y - c.y) * (s.y - c.y) <= 3000 * 3000 GROUP BY 1")
def _(spark, d):
    return tree.counts_within(sites(spark, d), _crowd(spark, d), "site_id", 3000.0)


@query("a9_tree_digests")
def _(spark, d):
    found = tables.tree_digests(spark, f"{d}/lineitem.parquet").unionByName(tables.tree_digests(spark, f"{d}/orders.parquet"))
    return found.select(F.regexp_extract("path", "([^/]+)$", 1).alias("file"), "length", "tree_sha256")
