"""Queries of the projections, filters, predicates and scalar expressions."""

from __future__ import annotations

from pyspark.sql import functions as F

from tractlake.functions import expr as X
from tractlake.operators.joins import crossed_in_blocks
from tractlake.plans.base import Book
from tractlake.plans.standins import from_origins, manhattan, origins, read, sites, with_sql

BOOK = Book()
query = BOOK.add


@query("b1_county_filter", "SELECT c_custkey, c_name FROM customer WHERE c_nationkey = 7 AND c_mktsegment = 'FURNITURE'")
def _(spark, d):
    return read(spark, d, "customer").where((F.col("c_nationkey") == 7) & (F.col("c_mktsegment") == "FURNITURE")).select("c_custkey", "c_name")


@query("b2_summary_level", "SELECT right(c_name, 6) AS geoid, c_nationkey FROM customer WHERE starts_with(c_name, 'Customer#0000001')")
def _(spark, d):
    return read(spark, d, "customer").where(F.col("c_name").startswith("Customer#0000001")).select(F.right("c_name", F.lit(6)).alias("geoid"), "c_nationkey")


@query("b3_open_spells", "SELECT o_orderkey, o_custkey FROM orders WHERE (CASE WHEN o_orderstatus = 'O' THEN NULL ELSE o_orderdate END) IS NULL AND upper(o_orderpriority) = '1-URGENT'")
def _(spark, d):
    ended = F.when(F.col("o_orderstatus") != "O", F.col("o_orderdate"))
    return read(spark, d, "orders").withColumn("ended", ended).where(F.col("ended").isNull() & (F.upper("o_orderpriority") == "1-URGENT")).select("o_orderkey", "o_custkey")


@query("b3b_as_of", "SELECT o_orderpriority, count(*) AS open_spells FROM orders WHERE o_orderdate <= TIMESTAMP '1996-06-30' AND (CASE WHEN o_orderstatus = 'O' THEN NULL ELSE o_orderdate + INTERVAL 90 DAY END > TIMESTAMP '1996-06-30' OR o_orderstatus = 'O') GROUP BY 1")
def _(spark, d):
    day = F.lit("1996-06-30").cast("timestamp")
    spells = read(spark, d, "orders").withColumn("ended", F.when(F.col("o_orderstatus") != "O", F.col("o_orderdate") + F.expr("INTERVAL 90 DAY")))
    return spells.where((F.col("o_orderdate") <= day) & (F.col("ended").isNull() | (F.col("ended") > day))).groupBy("o_orderpriority").agg(F.count("*").alias("open_spells"))


@query("b4_class_filter", "SELECT p_partkey, p_type FROM part WHERE p_type IN ('SMALL', 'LARGE')")
def _(spark, d):
    return read(spark, d, "part").where(F.col("p_type").isin("SMALL", "LARGE")).select("p_partkey", "p_type")


@query("b5_key_parts", "SELECT lpad(CAST(c_nationkey AS VARCHAR), 2, '0') || lpad(CAST(c_custkey % 1000 AS VARCHAR), 3, '0') || lpad(CAST(c_custkey AS VARCHAR), 6, '0') AS geoid FROM customer")
def _(spark, d):
    part = lambda c, n: F.lpad(c.cast("string"), n, "0")
    return read(spark, d, "customer").select(F.concat(part(F.col("c_nationkey"), 2), part(F.col("c_custkey") % 1000, 3), part(F.col("c_custkey"), 6)).alias("geoid"))


@query("b6_scoped_id", "SELECT 'retailers:' || s_suppkey AS site_id, s_name FROM supplier")
def _(spark, d):
    return read(spark, d, "supplier").select(X.scoped_id("retailers", "s_suppkey").alias("site_id"), "s_name")


@query("b7_codes_to_null", "SELECT p_partkey, CASE WHEN p_size NOT IN (7, 13, 24) THEN p_size END AS size FROM part")
def _(spark, d):
    return read(spark, d, "part").select("p_partkey", X.codes_to_null("p_size", (7, 13, 24)).alias("size"))


@query("b8_blank_to_null", "SELECT p_partkey, nullif(trim(CASE WHEN p_partkey % 4 = 0 THEN '   ' ELSE '  ' || p_name || ' ' END), '') AS name FROM part")
def _(spark, d):
    raw = F.when(F.col("p_partkey") % 4 == 0, "   ").otherwise(F.concat(F.lit("  "), F.col("p_name"), F.lit(" ")))
    return read(spark, d, "part").select("p_partkey", X.blank_to_null(raw).alias("name"))


@query("b9_lenient_cast", "SELECT p_partkey, TRY_CAST(CASE WHEN p_partkey % 3 = 0 THEN p_name ELSE CAST(p_size AS VARCHAR) || '.5' END AS DOUBLE) AS number FROM part")
def _(spark, d):
    raw = F.when(F.col("p_partkey") % 3 == 0, F.col("p_name")).otherwise(F.concat(F.col("p_size").cast("string"), F.lit(".5")))
    return read(spark, d, "part").select("p_partkey", X.lenient_number(raw).alias("number"))


@query("b10_strict_date", "SELECT o_orderkey, CAST(o_orderdate AS DATE) AS day FROM orders")
def _(spark, d):
    typed = F.date_format("o_orderdate", "M/d/yyyy")
    return read(spark, d, "orders").select("o_orderkey", F.to_date(typed, "M/d/yyyy").alias("day"))


@query("b11_box", with_sql("origins") + " SELECT coalesce(x BETWEEN 5000 AND 20000 AND y BETWEEN 4000 AND 22000, false) AS inside, count(*) AS n FROM (SELECT CASE WHEN origin_id % 11 = 0 THEN NULL ELSE x END AS x, y FROM origins) GROUP BY 1")
def _(spark, d):
    rows = origins(spark, d).withColumn("x", F.when(F.col("origin_id") % 11 != 0, F.col("x")))
    return rows.groupBy(X.in_box("x", "y", (5000, 4000, 20000, 22000)).alias("inside")).agg(F.count("*").alias("n"))


@query("b12_walkable", "SELECT p_partkey FROM part WHERE p_brand <> 'Brand#11' AND NOT contains(p_name, 'no') AND p_type IN ('SMALL', 'MEDIUM', 'STANDARD')")
def _(spark, d):
    tags = F.create_map(F.lit("highway"), F.col("p_type"), F.lit("foot"), F.col("p_name"), F.lit("area"), F.col("p_brand"))
    ways = read(spark, d, "part").withColumn("tags", tags)
    return ways.where((F.col("tags")["area"] != "Brand#11") & ~F.contains(F.col("tags")["foot"], F.lit("no")) & F.col("tags")["highway"].isin("SMALL", "MEDIUM", "STANDARD")).select("p_partkey")


CLASSES = {"ECONOMY": ("grocery", False), "LARGE": ("supermarket", True), "MEDIUM": ("grocery", False), "PROMO": ("specialty", False), "SMALL": ("convenience", False), "STANDARD": ("supermarket", True)}


@query("b13_classification", "SELECT p_partkey, CASE p_type WHEN 'LARGE' THEN 'supermarket' WHEN 'STANDARD' THEN 'supermarket' WHEN 'PROMO' THEN 'specialty' WHEN 'SMALL' THEN 'convenience' ELSE 'grocery' END AS format_class, p_type IN ('LARGE', 'STANDARD') AS supermarket_format FROM part")
def _(spark, d):
    rules = spark.createDataFrame([(k, *v) for k, v in CLASSES.items()], "p_type string, format_class string, supermarket_format boolean")
    joined = read(spark, d, "part").join(F.broadcast(rules), "p_type", "left")  # the rules are these six rows
    known = F.when(F.col("format_class").isNotNull(), F.col("format_class")).otherwise(F.raise_error(F.concat(F.lit("unknown type "), F.coalesce("p_type", F.lit("(none)")))).cast("string"))
    return joined.select("p_partkey", known.alias("format_class"), "supermarket_format")


CELL = "CASE doc_id % 6 WHEN 0 THEN '=' WHEN 1 THEN '+' WHEN 2 THEN '-' WHEN 3 THEN '@' ELSE '' END || CASE WHEN doc_id % 5 = 0 THEN CAST(doc_id AS VARCHAR) ELSE text END"


def _cells(spark, d):
    lead = F.when(F.col("doc_id") % 6 == 0, "=").when(F.col("doc_id") % 6 == 1, "+").when(F.col("doc_id") % 6 == 2, "-").when(F.col("doc_id") % 6 == 3, "@").otherwise("")
    return read(spark, d, "documents").select("doc_id", F.concat(lead, F.when(F.col("doc_id") % 5 == 0, F.col("doc_id").cast("string")).otherwise(F.col("text"))).alias("cell"))


@query("b14_escape_formula", f"SELECT doc_id, CASE WHEN regexp_matches(cell, '^[=+\\-@\\t\\r]') THEN '''' || cell ELSE cell END AS cell FROM (SELECT doc_id, {CELL} AS cell FROM documents)")
def _(spark, d):
    return _cells(spark, d).select("doc_id", X.escaped_formula("cell").alias("cell"))


@query("b15_safe_cell", f"SELECT doc_id, NOT regexp_matches(cell, '^[=+\\-@\\t\\r]') OR (starts_with(cell, '-') AND regexp_matches(cell, '^-?([0-9]+\\.?[0-9]*|\\.[0-9]+)([eE][-+]?[0-9]+)?$')) AS safe FROM (SELECT doc_id, {CELL} AS cell FROM documents)")
def _(spark, d):
    return _cells(spark, d).select("doc_id", X.safe_cell("cell").alias("safe"))


@query("b16_name_rule", "SELECT p_partkey, regexp_matches(name, '^[a-z][a-z0-9_]*$') AND NOT regexp_matches(name, 'healthy|unhealthy|nutritious|quality|desert|insecur|score|rank|index') AS ok FROM (SELECT p_partkey, replace(p_name, ' ', CASE WHEN p_partkey % 3 = 0 THEN '_' ELSE ' ' END) || CASE WHEN p_partkey % 7 = 0 THEN '_rank' ELSE '' END AS name FROM part)")
def _(spark, d):
    name = F.concat(F.when(F.col("p_partkey") % 3 == 0, F.replace(F.col("p_name"), F.lit(" "), F.lit("_"))).otherwise(F.col("p_name")), F.when(F.col("p_partkey") % 7 == 0, "_rank").otherwise(""))
    return read(spark, d, "part").select("p_partkey", X.proper_name(name).alias("ok"))


_LEAK_TEXT = "text || CASE doc_id % 9 WHEN 0 THEN ' raw/x' WHEN 1 THEN ' curated/y' WHEN 2 THEN ' C:/a' WHEN 3 THEN ' /home/me' WHEN 4 THEN ' pipeline_state.json' ELSE '' END"
_LEAK_SQL = " UNION ALL ".join(f"SELECT doc_id, '{label}' AS label FROM t WHERE regexp_matches(t, '{p}')" for label, p in X.LEAKS)


@query("b17_leak_scan", f"WITH t AS (SELECT doc_id, {_LEAK_TEXT} AS t FROM documents) {_LEAK_SQL}")
def _(spark, d):
    tail = F.element_at(F.array(*[F.lit(x) for x in (" raw/x", " curated/y", " C:/a", " /home/me", " pipeline_state.json", "", "", "", "")]), (F.col("doc_id") % 9 + 1).cast("int"))
    return read(spark, d, "documents").select("doc_id", F.explode(X.leak_labels(F.concat("text", tail))).alias("label"))


@query("b18_metric_column", "SELECT DISTINCT concat_ws('__', 'time', nullif(CASE WHEN l_linestatus = 'O' THEN '' ELSE l_linestatus END, ''), l_returnflag) AS name FROM lineitem")
def _(spark, d):
    return read(spark, d, "lineitem").select(X.metric_column(F.lit("time"), F.when(F.col("l_linestatus") == "O", "").otherwise(F.col("l_linestatus")), "l_returnflag").alias("name")).distinct()


_VISIBLE = r"""trim(regexp_replace(replace(replace(replace(replace(replace(replace(regexp_replace(html, '(?is)<(script|style)[^>]*>.*?</(script|style)>|<!--.*?-->|<[^>]*>', ' ', 'g'), '&nbsp;', ' '), '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#39;', ''''), '&amp;', '&'), '\s+', ' ', 'g'))"""


@query("b19_visible_text", f"SELECT page_id, md5({_VISIBLE}) AS digest, NOT contains({_VISIBLE}, 'the') AS misses_phrase FROM pages")
def _(spark, d):
    text = X.visible_text("html")
    return read(spark, d, "pages").select("page_id", F.md5(text).alias("digest"), (~F.contains(text, F.lit("the"))).alias("misses_phrase"))


@query("b20_canonical", "SELECT event_id, CASE WHEN value = floor(value) THEN CAST(CAST(value AS BIGINT) AS VARCHAR) ELSE printf('%.6f', value) END AS value FROM events")
def _(spark, d):
    return read(spark, d, "events").select("event_id", X.canonical("value").alias("value"))


@query("b21_tolerance", "SELECT event_id, CASE WHEN event_id % 2 = 0 THEN greatest(3.0, value * 0.15) ELSE greatest(10.0, value * 0.25) END AS tolerance FROM events")
def _(spark, d):
    rows = read(spark, d, "events").withColumn("mode", F.when(F.col("event_id") % 2 == 0, "walk").otherwise("walk_transit"))
    return rows.select("event_id", X.tolerance("value", "mode").alias("tolerance"))


@query("b22_snapshot_id", "SELECT o_orderkey, CASE WHEN o_orderkey % 5 <> 4 THEN CAST(o_orderdate AS DATE) END AS day, CASE o_orderkey % 5 WHEN 0 THEN 0 WHEN 1 THEN 1 WHEN 2 THEN 12 WHEN 3 THEN 0 END AS number FROM orders")
def _(spark, d):
    raw = F.concat(F.date_format("o_orderdate", "yyyy-MM-dd"), F.element_at(F.array(*[F.lit(x) for x in ("", "-1", "-12", "", "-01")]), (F.col("o_orderkey") % 5 + 1).cast("int")))
    day, number = X.snapshot_parts(raw)
    return read(spark, d, "orders").select("o_orderkey", day.alias("day"), number.alias("number"))


@query("b23_url_allowed", "SELECT page_id, starts_with(u, 'https://') AND NOT contains(split_part(substr(u, 9), '/', 1), '@') AND regexp_matches(split_part(substr(u, 9), '/', 1), '(^|\\.)example\\.org$') AS allowed FROM (SELECT page_id, CASE page_id % 4 WHEN 0 THEN replace(split_part(url, '?', 1), 'http://', 'https://') WHEN 1 THEN split_part(url, '?', 1) WHEN 2 THEN 'https://me@a.example.org/x' ELSE 'https://notexample.com/x' END AS u FROM pages)")
def _(spark, d):
    plain = F.substring_index("url", "?", 1)
    u = F.when(F.col("page_id") % 4 == 0, F.replace(plain, F.lit("http://"), F.lit("https://"))).when(F.col("page_id") % 4 == 1, plain).when(F.col("page_id") % 4 == 2, "https://me@a.example.org/x").otherwise("https://notexample.com/x")
    return read(spark, d, "pages").select("page_id", X.allowed_url(u, ("example.org",)).alias("allowed"))


@query("b24_reliability", "WITH e AS (SELECT o_custkey, CAST(count(*) AS DOUBLE) AS estimate, CAST(count(*) * (o_custkey % 90) / 100.0 AS DOUBLE) AS moe FROM orders GROUP BY o_custkey), t AS (SELECT *, CASE WHEN moe / 1.645 / estimate * 100 <= 12 THEN 1 WHEN moe / 1.645 / estimate * 100 <= 40 THEN 2 ELSE 3 END AS tier FROM e) SELECT o_custkey, CAST(tier AS BIGINT) AS cv_tier, CASE WHEN tier = 3 THEN 'interval-only' ELSE 'publish' END AS action FROM t")
def _(spark, d):
    e = read(spark, d, "orders").groupBy("o_custkey").agg(F.count("*").cast("double").alias("estimate")).withColumn("moe", F.col("estimate") * (F.col("o_custkey") % 90) / 100)
    return e.withColumn("cv_tier", X.reliability_tier("estimate", "moe")).select("o_custkey", "cv_tier", X.reliability_action("cv_tier").alias("action"))


@query("b25_censor", "SELECT event_id, least(coalesce(CASE WHEN event_id % 10 <> 3 THEN value END, 120.0), 120.0) AS minutes FROM events")
def _(spark, d):
    return read(spark, d, "events").select("event_id", X.censored(F.when(F.col("event_id") % 10 != 3, F.col("value")), 120.0).alias("minutes"))


@query("b26_proxy_times", with_sql("origins", "sites") + " SELECT origin_id, site_id, least((abs(o.x - s.x) + abs(o.y - s.y)) / 80.0 + 1, 120.0) AS walk, least((abs(o.x - s.x) + abs(o.y - s.y)) / 250.0 + 6, 120.0) AS transit FROM origins o CROSS JOIN sites s")
def _(spark, d):
    metres, pairs = manhattan(), crossed_in_blocks(from_origins(spark, d), sites(spark, d).select("site_id", "x", "y"), "origin_id")
    return pairs.select("origin_id", "site_id", X.censored(metres / F.lit(80.0) + 1, 120.0).alias("walk"), X.censored(metres / F.lit(250.0) + 6, 120.0).alias("transit"))


@query("b27_feed_window", "SELECT event_type, strftime(min(ts), '%Y-%m-%d') AS first_day, strftime(max(ts), '%Y-%m-%d') AS last_day, DATE '2024-01-15' BETWEEN CAST(min(ts) AS DATE) AND CAST(max(ts) AS DATE) AS inside FROM events GROUP BY event_type")
def _(spark, d):
    feed = read(spark, d, "events").groupBy("event_type").agg(F.date_format(F.min("ts"), "yyyyMMdd").alias("s"), F.date_format(F.max("ts"), "yyyyMMdd").alias("e"))
    day = lambda c: F.to_date(c, "yyyyMMdd")
    return feed.select("event_type", day("s").cast("string").alias("first_day"), day("e").cast("string").alias("last_day"), F.lit("2024-01-15").cast("date").between(day("s"), day("e")).alias("inside"))


@query("b28_hours", "SELECT event_id, CASE WHEN event_id % 7 = 0 THEN 'missing' WHEN event_id % 7 = 1 OR h2 <= h1 THEN 'malformed' ELSE 'parsed' END AS status, CASE WHEN event_id % 7 > 1 AND h2 > h1 THEN event_id % 7 < 6 END AS open_weekday FROM (SELECT event_id, event_id % 20 AS h1, (event_id * 3) % 24 AS h2 FROM events)")
def _(spark, d):
    e = F.col("event_id")
    days = F.element_at(F.array(*[F.lit(x) for x in ("Mon", "Tue", "Wed", "Fri", "Sun")]), (e % 7 - 1).cast("int"))
    clock = lambda h: F.concat(F.lpad(h.cast("string"), 2, "0"), F.lit(":00"))
    text = F.when(e % 7 == 0, None).when(e % 7 == 1, "by chance").otherwise(F.concat(days, F.lit(" "), clock(e % 20), F.lit("-"), clock((e * 3) % 24)))
    shape = r"^(Mon|Tue|Wed|Thu|Fri|Sat|Sun) (\d{2}):(\d{2})-(\d{2}):(\d{2})$"
    rows = read(spark, d, "events").select("event_id", text.alias("hours"))
    minute = lambda h, m: F.regexp_extract("hours", shape, h).try_cast("int") * 60 + F.regexp_extract("hours", shape, m).try_cast("int")
    fine = F.col("hours").rlike(shape) & (minute(4, 5) > minute(2, 3))
    status = F.when(F.col("hours").isNull(), "missing").when(fine, "parsed").otherwise("malformed")
    return rows.select("event_id", status.alias("status"), F.when(status == "parsed", F.regexp_extract("hours", shape, 1).isin("Mon", "Tue", "Wed", "Thu", "Fri")).alias("open_weekday"))


@query("b29_manifest_rules", "SELECT s_suppkey, CAST(NOT regexp_matches(lower(s_name), '^[a-z][a-z0-9_]*$') AS INTEGER) + CAST(s_acctbal < 0 AS INTEGER) + CAST(s_suppkey % 9 = 0 AS INTEGER) AS problems FROM supplier")
def _(spark, d):
    rules = {"source is no slug": F.lower("s_name").rlike(X.SLUG), "negative size": F.col("s_acctbal") >= 0, "terms missing": F.col("s_suppkey") % 9 != 0}
    found = F.array_compact(F.array(*[F.when(~ok, F.lit(message)) for message, ok in rules.items()]))
    return read(spark, d, "supplier").select("s_suppkey", F.size(found).alias("problems"))


@query("b30_scrub_roots", "SELECT page_id, replace(replace(url, 'http://', '<web>'), 'example.org', '<host>') AS url FROM pages")
def _(spark, d):
    return read(spark, d, "pages").select("page_id", X.scrubbed("url", {"http://": "<web>", "example.org": "<host>"}).alias("url"))
