"""Street-graph operators: edges from ways, components, shortest times."""

from __future__ import annotations

import heapq
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tractlake.operators.keeping import cut


def segments(ways: DataFrame) -> DataFrame:
    """way_id, seq, src, dst of consecutive refs of ways(way_id, refs)."""
    pairs = F.arrays_zip(F.slice("refs", 1, F.size("refs") - 1).alias("src"), F.slice("refs", 2, F.size("refs") - 1).alias("dst"))
    return ways.where(F.size("refs") > 1).select("way_id", F.posexplode(pairs).alias("seq", "p")).select("way_id", "seq", F.col("p.src").alias("src"), F.col("p.dst").alias("dst"))


def two_way(edges: DataFrame) -> DataFrame:
    """Both directions of edges(src, dst, length)."""
    return edges.select("src", "dst", "length").unionByName(edges.select(F.col("dst").alias("src"), F.col("src").alias("dst"), "length"))


#: Values that results depend on: classes of ways nobody walks on, and access words that close a way (as parts of the value).
NOT_WALKED = ("motorway", "motorway_link", "trunk", "trunk_link", "construction", "proposed", "raceway", "bus_guideway", "abandoned", "platform", "corridor", "elevator", "escalator")
CLOSED = ("private", "no")


def walkable(tags: Column) -> Column:
    """Whether a way with these tags can be walked: it is a highway of another class than those closed to walkers, no area, not private,
    and neither foot nor service says no."""
    tag = lambda name: F.coalesce(F.try_element_at(tags, F.lit(name)), F.lit(""))
    closed = lambda c: F.exists(F.array(*map(F.lit, CLOSED)), lambda t: F.contains(c, t))
    barred = F.exists(F.array(*map(F.lit, NOT_WALKED)), lambda t: F.contains(tag("highway"), t))
    return (tag("highway") != "") & ~barred & ~F.contains(tag("area"), F.lit("yes")) & ~closed(tag("access")) & ~F.contains(tag("foot"), F.lit("no")) & ~F.contains(tag("service"), F.lit("private"))


def walkable_network(ways: DataFrame, nodes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The walkable ones of ways(way_id, refs, tags), and those of nodes(node_id, ...) that they use."""
    kept = ways.where(walkable(F.col("tags")))
    return kept, nodes.join(kept.select(F.explode("refs").alias("node_id")).distinct(), "node_id", "left_semi")


def measured(ways: DataFrame, nodes: DataFrame) -> DataFrame:
    """src, dst and length in metres, both ways, of the shortest segment between neighbours of ways(way_id, refs), from nodes(node_id, x, y)."""
    at = lambda end: nodes.select(F.col("node_id").alias(end), F.col("x").cast("double").alias(f"x_{end}"), F.col("y").cast("double").alias(f"y_{end}"))
    placed = segments(ways).where("src <> dst").join(at("src"), "src").join(at("dst"), "dst")
    one_way = placed.select("src", "dst", F.hypot(F.col("x_dst") - F.col("x_src"), F.col("y_dst") - F.col("y_src")).alias("length"))
    return two_way(one_way).groupBy("src", "dst").agg(F.min("length").alias("length"))


def reached_times(edges: DataFrame, origin_snaps: DataFrame, site_snaps: DataFrame, speed: float, cap: float, homes: DataFrame | None = None) -> DataFrame:
    """origin_id, site_id, minutes of the pairs within the cap: snap, shortest path and snap again at a speed in metres a minute.

    Snaps are (id, node_id, distance). Paths are searched up to the radius of the cap only; with homes(node, home), part by part.
    """
    starts = origin_snaps.select(F.col("node_id").alias("source"), F.col("node_id").alias("node")).distinct()
    paths = shortest(edges, starts, speed * cap) if homes is None else shortest_by_parts(edges, starts, speed * cap, homes)
    a = origin_snaps.select("origin_id", F.col("node_id").alias("source"), F.col("distance").alias("before"))
    b = site_snaps.select("site_id", F.col("node_id").alias("node"), F.col("distance").alias("after"))
    minutes = (F.col("before") + F.col("distance") + F.col("after")) / speed
    return paths.join(a, "source").join(b, "node").select("origin_id", "site_id", minutes.alias("minutes")).where(F.col("minutes") <= cap)


def walk_times(edges: DataFrame, origins: DataFrame, sites: DataFrame, origin_snaps: DataFrame, site_snaps: DataFrame, speed: float, cap: float, homes: DataFrame | None = None) -> DataFrame:
    """origin_id, site_id, minutes of all pairs, as reached_times has them; null beyond the cap."""
    from tractlake.operators.joins import crossed  # which needs components for its areas

    found = reached_times(edges, origin_snaps, site_snaps, speed, cap, homes)
    # The whole product is the result. Each origin carries what it reached, so nothing of the product travels or is sorted.
    key = F.col("site_id").cast(sites.schema["site_id"].dataType).alias("site_id")
    each = found.where("site_id is not null").groupBy("origin_id", key).agg(F.collect_list("minutes").alias("minutes"))
    reached = each.groupBy("origin_id").agg(F.map_from_entries(F.collect_list(F.struct("site_id", "minutes"))).alias("reached"))
    o = cut(origins.select("origin_id").join(reached, "origin_id", "left"))
    return crossed(o, sites.select("site_id"), "origin_id").select("origin_id", "site_id", F.explode_outer(F.try_element_at("reached", "site_id")).alias("minutes"))


def graph_counts(edges: DataFrame, snaps: DataFrame) -> DataFrame:
    """One row: nodes, edges (each once), metres, and the largest, the mean and the median of the snap distances."""
    from tractlake.operators.spatial import quantiles  # which needs components for its outlines

    once = edges.where("src < dst")
    nodes = edges.select("src").distinct().agg(F.count("*").alias("nodes"))
    sums = once.agg(F.count("*").alias("edges"), F.coalesce(F.sum("length"), F.lit(0.0)).alias("metres"))
    middle = quantiles(snaps, "distance", [0.5]).select(F.col("q")[0].alias("snap_median"))
    return nodes.join(sums).join(snaps.agg(F.max("distance").alias("snap_max"), F.avg("distance").alias("snap_mean"))).join(middle)  # one row each


def component_labels(edges: DataFrame) -> DataFrame:
    """(node, label): label is the smallest node that it reaches; labels of labels shorten long chains.

    The joins are merge joins in any case: a table of nodes that the planner takes for small would pass through the driver in each round.
    """
    both = cut(edges.select("src", "dst").unionByName(edges.select(F.col("dst").alias("src"), F.col("src").alias("dst"))).distinct())
    labels = cut(both.groupBy("src").agg(F.min("dst").alias("m")).select(F.col("src").alias("node"), F.least("src", "m").alias("label")))
    while True:
        heard = both.join(labels.withColumnRenamed("node", "dst").hint("merge"), "dst").groupBy(F.col("src").alias("node")).agg(F.min("label").alias("heard"))
        told = cut(labels.join(heard.hint("merge"), "node").select("node", F.col("label").alias("old"), F.least("label", "heard").alias("near")))
        far = told.select(F.col("node").alias("near"), F.col("near").alias("far"))
        new = cut(told.join(far.hint("merge"), "near", "left").select("node", "old", F.least("near", F.coalesce("far", "near")).alias("label")))
        labels = new.select("node", "label")
        if not new.where("old <> label").limit(1).count():
            return labels


def largest_component(edges: DataFrame) -> DataFrame:
    """The edges of the component with most nodes, ties to the smallest label."""
    labels = component_labels(edges)
    top = labels.groupBy("label").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "label").limit(1).select("label")
    nodes = labels.join(F.broadcast(top), "label").select(F.col("node").alias("src"))  # top is one row
    return edges.join(nodes.hint("merge"), "src", "left_semi")


def shortest(edges: DataFrame, sources: DataFrame, radius: float, merge_every: int = 8) -> DataFrame:
    """(source, node, distance) of all nodes within radius of each of sources(source, node), along edges(src, dst, length).

    Each round relaxes the edges out of the nodes that got nearer in the round before, and writes only what got nearer; what is known is merged
    every few rounds. It ends when nothing got nearer.
    """
    nearest = lambda parts: reduce(DataFrame.unionByName, parts).groupBy("source", "node").agg(F.min("distance").alias("distance"))
    known = [cut(sources.select("source", "node", F.lit(0.0).alias("distance")))]
    front = known[0]
    while True:
        step = front.join(edges, front["node"] == edges["src"]).select("source", F.col("dst").alias("node"), (F.col("distance") + F.col("length")).alias("distance")).where(F.col("distance") <= radius)
        before = nearest(known).withColumnRenamed("distance", "before")
        front = cut(nearest([step]).join(before, ["source", "node"], "left").where("before IS NULL OR distance < before").select("source", "node", "distance"))
        if not front.limit(1).count():
            return nearest(known)
        known.append(front)
        if len(known) > merge_every:
            known = [cut(nearest(known))]


def grown(seeds: pd.DataFrame, edges: pd.DataFrame, radius: float) -> list[tuple]:
    """(source, node, distance) of the nodes of one part that each source reaches from its seeds(source, node, distance) along edges(src, dst, length)."""
    ways: dict = {}
    for a, b, length in zip(edges["src"], edges["dst"], edges["length"], strict=True):
        ways.setdefault(a, []).append((b, length))
    out = []
    for source, own in seeds.groupby("source"):
        heap, done = [(d, n) for n, d in zip(own["node"], own["distance"], strict=True)], {}
        heapq.heapify(heap)
        while heap:
            d, n = heapq.heappop(heap)
            if n not in done:
                done[n] = d
                for b, length in ways.get(n, ()):
                    if b not in done and d + length <= radius:
                        heapq.heappush(heap, (d + length, b))
        out += [(source, n, d) for n, d in done.items()]
    return out


def shortest_by_parts(edges: DataFrame, sources: DataFrame, radius: float, homes: DataFrame, sources_a_task: int = 256) -> DataFrame:
    """What `shortest` gives, in rounds over parts of the graph: homes(node, home) deals the nodes to parts of bounded size.

    In a round each part that a source has entered at a smaller distance is searched to its borders, and what crosses a border enters the next part.
    So rounds follow the number of borders on a shortest path, not the number of its edges. A task holds one part and the seeds
    of sources_a_task sources or so; a part that more sources enter is searched in several tasks.
    """
    at = lambda end: homes.select(F.col("node").alias(end), F.col("home").alias(f"home_{end}"))
    placed = cut(edges.join(at("src"), "src").join(at("dst"), "dst"))
    inner = placed.where("home_src = home_dst").select(F.col("home_src").alias("home"), "src", "dst", "length")
    across = placed.where("home_src <> home_dst").select("src", "dst", "length", F.col("home_dst").alias("home"))
    kinds = dict(sources.dtypes)
    schema = f"source {kinds['source']}, node {kinds['node']}, distance double"
    nearest = lambda df: df.groupBy("source", "node").agg(F.min("distance").alias("distance"))
    front, known = cut(sources.select("source", "node", F.lit(0.0).alias("distance")).join(homes, "node")), None

    def run(_, seeds: pd.DataFrame, part: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame(grown(seeds, part, radius), columns=["source", "node", "distance"])

    while True:
        load = cut(front.groupBy("home").agg(F.ceil(F.count_distinct("source") / sources_a_task).cast("int").alias("tasks")))
        seeds = front.join(load, "home").withColumn("task", F.pmod(F.xxhash64("source"), F.col("tasks").cast("long")).cast("int"))
        parts = inner.join(load, "home").withColumn("task", F.explode(F.sequence(F.lit(0), F.col("tasks") - 1)))
        found = seeds.groupBy("home", "task").cogroup(parts.groupBy("home", "task")).applyInPandas(run, schema)
        if known is not None:
            found = found.join(known.withColumnRenamed("distance", "before"), ["source", "node"], "left").where("before is null or distance < before").drop("before")
        found = cut(found)
        known = cut(nearest(found if known is None else known.unionByName(found)))
        entered = found.join(across, found["node"] == across["src"]).select("source", F.col("dst").alias("node"), (F.col("distance") + F.col("length")).alias("distance"), "home").where(F.col("distance") <= radius)
        entered = entered.groupBy("source", "node", "home").agg(F.min("distance").alias("distance"))
        front = cut(entered.join(known.withColumnRenamed("distance", "before"), ["source", "node"], "left").where("before is null or distance < before").drop("before"))
        if front.isEmpty():
            return known


def way_complete_clip(nodes: DataFrame, ways: DataFrame, relations: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Ways that touch a node with inside, these with all their nodes and the inside ones, and relations whose members all stay."""
    refs = ways.select("way_id", F.explode("refs").alias("node_id"))
    inside = nodes.where("inside").select("node_id")
    kept_ways = ways.join(refs.join(inside, "node_id", "left_semi").select("way_id").distinct(), "way_id", "left_semi")
    kept_nodes = refs.join(kept_ways.select("way_id"), "way_id", "left_semi").select("node_id").union(inside).distinct()
    members = relations.select("relation_id", F.explode("members").alias("way_id"))
    marked = members.join(kept_ways.select("way_id", F.lit(True).alias("here")), "way_id", "left").groupBy("relation_id").agg(F.bool_and(F.coalesce("here", F.lit(False))).alias("whole"))
    return kept_nodes, kept_ways, relations.join(marked.where("whole"), "relation_id", "left_semi")


def clip_audit(nodes: DataFrame, ways: DataFrame, kept_nodes: DataFrame, kept_ways: DataFrame, bands: dict[str, tuple[int, int]]) -> DataFrame:
    """(check, count): kept nodes outside the box that no kept way refers to, nodes and ways out of their bands, and a missing highway."""
    outside = kept_nodes.join(nodes.where("inside").select("node_id"), "node_id", "left_anti")
    stray = outside.join(kept_ways.select(F.explode("refs").alias("node_id")), "node_id", "left_anti").agg(F.count("*").alias("count")).select(F.lit("unreferenced node").alias("check"), "count")
    counted = [df.agg(F.count("*").alias("count")).where(~F.col("count").between(*bands[n])).select(F.lit(f"{n} out of band").alias("check"), "count") for n, df in (("nodes", kept_nodes), ("ways", kept_ways))]
    roads = kept_ways.agg(F.count_if(F.try_element_at("tags", F.lit("highway")).isNotNull()).alias("n")).where("n = 0").select(F.lit("no highway").alias("check"), F.lit(0).cast("bigint").alias("count"))
    return stray.where("count > 0").unionByName(counted[0]).unionByName(counted[1]).unionByName(roads)
