"""Areas of several parts with holes, and lines: validity, places of points, overlay, and outlines of unions.

A shape column is a ring (array of points), a polygon (array of rings, the first outside, the others holes) or a multipolygon (array of polygons);
points are struct<x, y>. Everything works on one row for each edge, and edges meet through the cells that they cross, never through a product.
Which side of a line a point is on is decided in double precision: exact for whole coordinates below 2**26, else right but for distances near rounding.

Shapes that are null or empty have no edges. Repeated points in a row count once. Distances and areas are planar.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tractlake.functions import geometry as G
from tractlake.operators.keeping import cut, settled
from tractlake.operators.network import component_labels

ENDS = ["x1", "y1", "x2", "y2"]
ID = ["part", "ring", "seq"]


def nesting(df: DataFrame, shape: str) -> int:
    """1 for a ring or line, 2 for a polygon or several lines, 3 for a multipolygon."""
    kind, n = df.schema[shape].dataType, 0
    while isinstance(kind, T.ArrayType):
        kind, n = kind.elementType, n + 1
    return n


def as_parts(df: DataFrame, shape: str) -> Column:
    """Any shape as an array of polygons."""
    return [F.array(F.array(F.col(shape))), F.array(F.col(shape)), F.col(shape)][nesting(df, shape) - 1]


def distinct_points(points: Column) -> Column:
    """Points in a row that are equal, once; zeros without a sign."""
    plain = F.transform(points, lambda p: F.struct((p["x"].cast("double") + 0.0).alias("x"), (p["y"].cast("double") + 0.0).alias("y")))
    return F.filter(plain, lambda p, i: (i == 0) | (p != F.get(plain, i - 1)))


def rings_of(df: DataFrame, key: str, shape: str) -> DataFrame:
    """key, part, ring and points of every ring."""
    parts = df.select(key, F.posexplode(as_parts(df, shape)).alias("part", "rings"))
    return parts.select(key, "part", F.posexplode("rings").alias("ring", "points")).select(key, "part", "ring", distinct_points(F.col("points")).alias("points"))


def edges_of(rings: DataFrame) -> DataFrame:
    """One row for each edge of rings(..., points), with seq and last (the seq of the ring's last edge)."""
    n = F.greatest(F.size("points") - 1, F.lit(0))
    pairs = F.arrays_zip(F.slice("points", 1, n).alias("a"), F.slice("points", 2, n).alias("b"))
    rest = [c for c in rings.columns if c != "points"]
    rows = rings.select(*rest, (n - 1).alias("last"), F.posexplode(pairs).alias("seq", "e"))
    return rows.select(*rest, "seq", "last", F.col("e.a.x").alias("x1"), F.col("e.a.y").alias("y1"), F.col("e.b.x").alias("x2"), F.col("e.b.y").alias("y2"))


def shape_edges(df: DataFrame, key: str, shape: str) -> DataFrame:
    """key, part, ring, seq, last and the ends of every edge."""
    return edges_of(rings_of(df, key, shape))


def in_cells(e: DataFrame, cell: float | Column) -> DataFrame:
    """e with cx, cy: a row for each cell that the edge crosses or touches."""
    size = F.lit(float(cell)) if isinstance(cell, int | float) else cell
    e = e.withColumn("cell_", size)
    low, high, cy = F.least("y1", "y2"), F.greatest("y1", "y2"), F.col("cy")
    e = e.withColumn("cy", F.explode(F.sequence(F.floor(low / F.col("cell_")), F.floor(high / F.col("cell_")))))
    at = lambda y: F.when(F.col("y1") == F.col("y2"), F.col("x1")).otherwise(F.col("x1") + (F.col("x2") - F.col("x1")) * (y - F.col("y1")) / F.nullif(F.col("y2") - F.col("y1"), F.lit(0.0)))
    a, b = at(F.greatest(low, cy * F.col("cell_"))), F.when(F.col("y1") == F.col("y2"), F.col("x2")).otherwise(at(F.least(high, (cy + 1) * F.col("cell_"))))
    slack = (F.abs("x1") + F.abs("x2") + F.col("cell_")) * 1e-9
    west, east = F.least(a, b) - slack, F.greatest(a, b) + slack
    return e.withColumn("cx", F.explode(F.sequence(F.floor(west / F.col("cell_")), F.floor(east / F.col("cell_"))))).drop("cell_")


def meeting(a: dict[str, Column], b: dict[str, Column]) -> Column:
    """How two edges meet: kind (cross, touch, overlap; null: not at all) and the point, or the two ends of the stretch, that they share."""
    point = lambda e, i: F.struct(e[f"x{i}"].alias("x"), e[f"y{i}"].alias("y"))
    side = lambda e, f, i: G.side(e["x1"], e["y1"], e["x2"], e["y2"], f[f"x{i}"], f[f"y{i}"])
    ordered = lambda e: (F.least(point(e, 1), point(e, 2)), F.greatest(point(e, 1), point(e, 2)))
    between = lambda e, p: p["x"].between(F.least(e["x1"], e["x2"]), F.greatest(e["x1"], e["x2"])) & p["y"].between(F.least(e["y1"], e["y2"]), F.greatest(e["y1"], e["y2"]))
    s1, s2, s3, s4 = side(a, b, 1), side(a, b, 2), side(b, a, 1), side(b, a, 2)
    (a0, a1), (b0, b1) = ordered(a), ordered(b)
    low, high = F.greatest(a0, b0), F.least(a1, b1)
    # The crossing of two edges is worked out in one order of the two, so that both get the same point.
    dx, dy, ex, ey = a["x2"] - a["x1"], a["y2"] - a["y1"], b["x2"] - b["x1"], b["y2"] - b["y1"]
    t = ((b["x1"] - a["x1"]) * ey - (b["y1"] - a["y1"]) * ex) / F.nullif(dx * ey - dy * ex, F.lit(0.0))
    crossing = F.struct((a["x1"] + t * dx + 0.0).alias("x"), (a["y1"] + t * dy + 0.0).alias("y"))
    touch = F.when((s1 == 0) & between(a, point(b, 1)), point(b, 1)).when((s2 == 0) & between(a, point(b, 2)), point(b, 2)).when((s3 == 0) & between(b, point(a, 1)), point(a, 1)).when((s4 == 0) & between(b, point(a, 2)), point(a, 2))
    made = lambda kind, p, q: F.struct(F.lit(kind).alias("kind"), p.alias("p"), q.alias("q"))
    level = (s1 == 0) & (s2 == 0)
    return F.when(level & (low < high), made("overlap", low, high)).when(level & (low == high), made("touch", low, low)).when(~level & (s1 * s2 < 0) & (s3 * s4 < 0), made("cross", crossing, crossing)).when(~level & touch.isNotNull(), made("touch", touch, touch))


def meetings(e: DataFrame, by: list[str], ids: list[str], cell: float | Column) -> DataFrame:
    """The pairs of edges with equal `by` that meet, once each: by, the ids (those of the second with an underscore behind) and last, kind, p, q."""
    a = in_cells(e, cell).select(*by, "cx", "cy", *ids, "last", *ENDS)
    b = a.select(*by, "cx", "cy", *[F.col(c).alias(f"{c}_") for c in (*ids, "last", *ENDS)])
    both = a.join(b, [*by, "cx", "cy"]).where(F.struct(*ids) < F.struct(*[f"{c}_" for c in ids]))
    apart = (F.greatest("x1", "x2") < F.least("x1_", "x2_")) | (F.greatest("x1_", "x2_") < F.least("x1", "x2")) | (F.greatest("y1", "y2") < F.least("y1_", "y2_")) | (F.greatest("y1_", "y2_") < F.least("y1", "y2"))
    how = meeting({c: F.col(c) for c in ENDS}, {c: F.col(f"{c}_") for c in ENDS})
    met = both.where(~apart).select("*", F.explode(F.array(how)).alias("m")).where("m is not null")  # a generator, so that it is worked out once
    return met.select(*by, *ids, *[f"{c}_" for c in ids], "last", "m.*").distinct()


#: Bands of a cell's height and parts of its width, in which areas are looked at.
BANDS, PARTS = 8, 2


#: Rows of shapes, lines or points that one task deals with: their files are small and what becomes of them isn't, so bytes tell too little.
ROWS_A_TASK = 20_000


def tasks(*dfs: DataFrame) -> int:
    return 1 + sum(df.count() for df in dfs) // ROWS_A_TASK


def strips(areas: DataFrame, key: str, shape: str, cell: float) -> DataFrame:
    """What areas are made of in each band: key, band, x0, x1, n, odd and the ends of an edge.

    Edges whose stretches of x in the band overlap are a cluster: a row for each with the bounds of the cluster, n (its edges), and whether what lies
    east of it is inside (odd). Between two clusters no edge runs through the band; where that is inside, it is one row with n = 0, bounds excluded.
    """
    height = cell / BANDS
    rings = rings_of(areas.where(F.col(key).isNotNull()), key, shape)
    rings = rings.withColumn("open", F.get("points", F.lit(0)) != F.get("points", F.size("points") - 1))
    e = edges_of(rings.where(F.size("points") > 0).repartition(tasks(areas), key, "part", "ring")).select(key, "open", *ENDS)
    low, high, band = F.least("y1", "y2"), F.greatest("y1", "y2"), F.col("band")
    e = e.withColumn("band", F.explode(F.sequence(F.floor(low / height), F.floor(high / height))))
    at = lambda y: F.col("x1") + (F.col("x2") - F.col("x1")) * (y - F.col("y1")) / F.nullif(F.col("y2") - F.col("y1"), F.lit(0.0))
    a, b = F.coalesce(at(F.greatest(low, band * height)), "x1"), F.coalesce(at(F.least(high, (band + 1) * height)), "x2")
    slack, middle = (F.abs("x1") + F.abs("x2") + cell) * 1e-9, (band + 0.5) * height
    e = e.withColumn("west", F.least(a, b) - slack).withColumn("east", F.greatest(a, b) + slack).withColumn("cuts", ((F.col("y1") > middle) != (F.col("y2") > middle)).cast("long"))
    of_band = Window.partitionBy(key, "band")
    in_order = of_band.orderBy("west", "east").rowsBetween(Window.unboundedPreceding, -1)
    reached = F.max("east").over(in_order)
    # What isn't closed has no inside that a whole stretch could lie in: all its edges of a band are one cluster.
    e = e.withColumn("whole", ~F.max("open").over(of_band)).withColumn("first", reached.isNull() | (F.col("whole") & (F.col("west") > reached)))
    e = e.withColumn("cluster", F.sum(F.col("first").cast("long")).over(of_band.orderBy("west", "east").rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    one, by_cluster = Window.partitionBy(key, "band", "cluster"), of_band.orderBy("cluster")
    e = e.withColumn("first", F.row_number().over(one.orderBy("west", "east")) == 1).withColumn("x0", F.min("west").over(one)).withColumn("x1_", F.max("east").over(one)).withColumn("n", F.count("*").over(one))
    e = e.withColumn("odd", (F.sum("cuts").over(of_band) - F.sum("cuts").over(by_cluster)) % 2 == 1).withColumn("next", F.min("west").over(by_cluster.rangeBetween(1, 1)))
    row = lambda x0, x1, n: F.struct(F.col(x0).alias("x0"), F.col(x1).alias("x9"), n.alias("n"))
    inside = F.when(F.col("first") & F.col("odd") & F.col("next").isNotNull(), row("x1_", "next", F.lit(0).cast("long")))
    return e.select(key, "band", "odd", *ENDS, F.explode(F.array(row("x0", "x1_", F.col("n")), inside)).alias("s")).where("s is not null").select(key, "band", "s.x0", "s.x9", "s.n", "odd", *ENDS)


def located(points: DataFrame, areas: DataFrame, point_key: str, key: str, shape: str, cell: float) -> DataFrame:
    """(point_key, key, inside, edge) of each area that a point lies inside of or on the border of; a point in a hole is in neither.

    Areas are dealt to bands and parts of cells, as strips. A point in a stretch that no edge runs through is inside without a test; one in a cluster
    is tested against the cluster's edges only. Inside, the edges of all rings east of it are odd in number. All of a point and an area meets in one place.
    """
    width, n = cell / PARTS, tasks(points, areas)
    s = strips(areas, key, shape, cell)
    s = s.withColumn("cx", F.explode(F.sequence(F.floor(F.col("x0") / width), F.floor(F.col("x9") / width)))).repartition(n, "cx", "band")
    x, y = F.col("x").cast("double"), F.col("y").cast("double")
    dealt = points.select(point_key, x.alias("x"), y.alias("y"), F.floor(x / width).alias("cx"), F.floor(y / (cell / BANDS)).alias("band")).repartition(n, "cx", "band")
    c = [F.col(n) for n in ("x", "y", *ENDS)]
    odd, edge = F.col("odd") != G.crosses_ray(*c), G.on_edge(*c)
    within = (F.col("x") >= F.col("x0")) & (F.col("x") <= F.col("x9"))
    met = dealt.join(s.where("n < 2"), ["cx", "band"]).where(within & F.when(F.col("n") == 0, (F.col("x") > F.col("x0")) & (F.col("x") < F.col("x9"))).otherwise(odd | edge))
    decided = met.select(point_key, key, F.when(F.col("n") == 0, True).otherwise(odd & ~edge).alias("inside"), ((F.col("n") == 1) & edge).alias("edge"))
    several = dealt.join(s.where("n > 1"), ["cx", "band"]).where(within).groupBy("cx", "band", point_key, key, "odd").agg(F.sum(G.crosses_ray(*c).cast("int")).alias("crossed"), F.max(edge).alias("edge"))
    tested = several.select(point_key, key, ((F.col("odd") != (F.col("crossed") % 2 == 1)) & ~F.col("edge")).alias("inside"), "edge").where("inside or edge")
    return decided.unionByName(tested)


def own_cells(e: DataFrame, key: str) -> DataFrame:
    """e with cell: a width that deals the edges of each shape to about as many cells as it has edges."""
    size = e.groupBy(key).agg(F.greatest(F.max(F.greatest("x1", "x2")) - F.min(F.least("x1", "x2")), F.max(F.greatest("y1", "y2")) - F.min(F.least("y1", "y2"))).alias("w"), F.count("*").alias("n"))
    width = F.when(F.col("w") > 0, F.col("w") / F.ceil(F.sqrt("n"))).otherwise(1.0)
    return e.join(size.select(key, width.alias("cell")), key)


def shape_faults(areas: DataFrame, key: str, shape: str) -> DataFrame:
    """key, reason, n and the first place (x, y) of what makes each shape invalid; valid shapes have no row.

    Of a shape: null, empty. Of a ring: too short (fewer than three different corners), open. Between edges of one ring: crosses itself, touches itself
    (also where edges cross at a corner), overlaps itself, spike. Between rings: rings cross, rings overlap, hole outside, nested holes,
    parts overlap, and interior in pieces (rings that touch in a circle). Rings may touch at points otherwise.
    """
    nothing = F.lit(None).cast("double")
    told = lambda df, reason, x=nothing, y=nothing: df.select(key, (F.lit(reason) if isinstance(reason, str) else reason).alias("reason"), x.alias("x"), y.alias("y"))
    rings = rings_of(areas.where(F.col(shape).isNotNull()), key, shape).where(F.size("points") > 0)
    first, final = F.element_at("points", 1), F.element_at("points", -1)
    early = F.when(F.size("points") < 4, F.when((F.size("points") < 3) | (first == final), "too short").otherwise("open")).when(first != final, "open")
    judged = cut(rings.withColumn("early", early))
    found = told(areas.where(F.col(shape).isNull()), "null")
    found = found.unionByName(told(areas.where(F.col(shape).isNotNull()).join(judged.select(key), key, "left_anti"), "empty"))
    found = found.unionByName(told(judged.where("early is not null"), F.col("early"), first["x"], first["y"]))
    sound = judged.join(judged.where("early is not null").select(key), key, "left_anti").drop("early")
    e = cut(own_cells(edges_of(sound), key))
    met = cut(meetings(e, [key], ID, F.col("cell")))
    one = (F.col("part") == F.col("part_")) & (F.col("ring") == F.col("ring_"))
    adjacent = one & ((F.col("seq_") == F.col("seq") + 1) | ((F.col("seq") == 0) & (F.col("seq_") == F.col("last"))))
    kind = F.col("kind")
    why = F.when(adjacent, F.when(kind == "overlap", "spike")).when(one, F.when(kind == "cross", "crosses itself").when(kind == "touch", "touches itself").otherwise("overlaps itself")).otherwise(F.when(kind == "cross", "rings cross").when(kind == "overlap", "rings overlap"))
    found = found.unionByName(told(met.withColumn("why", why).where("why is not null"), F.col("why"), F.col("p.x"), F.col("p.y")))
    several = rings.groupBy(key).agg(F.count("*").alias("n")).where("n > 1").select(key)
    if not several.isEmpty():
        found = found.unionByName(between_rings(e.join(several, key, "left_semi"), met.where(~one), key))
    return found.groupBy(key, "reason").agg(F.count("*").alias("n"), F.min(F.struct("x", "y")).alias("p")).select(key, "reason", "n", "p.x", "p.y")


def between_rings(e: DataFrame, met: DataFrame, key: str) -> DataFrame:
    """(key, reason, x, y) for holes outside, nested holes, overlapping parts, crossings at corners and interiors in pieces.

    Every ring is cut where others meet it; the middle of each piece lies inside or outside of each other ring near it.
    """
    ids = [key, *ID]
    points = met.select(*ids, F.explode(F.array("p", "q")).alias("c")).unionByName(met.select(key, *[F.col(f"{c}_").alias(c) for c in ID], F.explode(F.array("p", "q")).alias("c"))).distinct()
    pieces = cut(cut_edges(e.select(*ids, *ENDS), points, ids))
    probes = pieces.select(*ids, "x1", "y1", ((F.col("x1") + F.col("x2")) / 2).alias("x"), ((F.col("y1") + F.col("y2")) / 2).alias("y"))
    box = e.groupBy(key, "part", "ring").agg(F.min(F.least("x1", "x2")).alias("bx0"), F.max(F.greatest("x1", "x2")).alias("bx1"), F.min(F.least("y1", "y2")).alias("by0"), F.max(F.greatest("y1", "y2")).alias("by1"))
    # Each probe meets, of every other ring of its shape, only the edges of its own row of cells.
    rows = e.withColumn("cy", F.explode(F.sequence(F.floor(F.least("y1", "y2") / F.col("cell")), F.floor(F.greatest("y1", "y2") / F.col("cell")))))
    rows = rows.select(key, F.col("part").alias("part_"), F.col("ring").alias("ring_"), "cy", *[F.col(c).alias(f"e{c}") for c in ENDS])
    cells = e.groupBy(key).agg(F.first("cell").alias("cell"))
    probes = probes.join(cells, key).withColumn("cy", F.floor(F.col("y") / F.col("cell")))
    other = (F.col("part") != F.col("part_")) | (F.col("ring") != F.col("ring_"))
    inside = probes.join(rows, [key, "cy"]).where(other).groupBy(*ids, "x1", "y1", "x", "y", "part_", "ring_").agg(F.sum(G.crosses_ray(F.col("x"), F.col("y"), F.col("ex1"), F.col("ey1"), F.col("ex2"), F.col("ey2")).cast("int")).alias("n"), F.max(G.on_edge(F.col("x"), F.col("y"), F.col("ex1"), F.col("ey1"), F.col("ex2"), F.col("ey2"))).alias("edge"))
    inside = cut(inside.where("n % 2 = 1 and not edge").select(key, "part", "ring", "seq", "x1", "y1", "x", "y", "part_", "ring_"))
    total = pieces.groupBy(key, "part", "ring").agg(F.count("*").alias("pieces"), F.min(F.struct("x1", "y1")).alias("at"))
    pair = inside.groupBy(key, "part", "ring", "part_", "ring_").agg(F.count("*").alias("n_in"))
    laid = met.where("kind = 'overlap'").select(key, "part", "ring", "part_", "ring_")
    laid = laid.unionByName(laid.select(key, F.col("part_").alias("part"), F.col("ring_").alias("ring"), F.col("part").alias("part_"), F.col("ring").alias("ring_"))).distinct()
    clean = pair.join(laid, [key, "part", "ring", "part_", "ring_"], "left_anti").join(total, [key, "part", "ring"])
    told = lambda df, reason: df.select(key, F.lit(reason).alias("reason"), F.col("at.x1").alias("x"), F.col("at.y1").alias("y"))
    out = told(clean.where("n_in < pieces"), "rings cross")
    whole = clean.where("n_in = pieces")
    out = out.unionByName(told(whole.where("part = part_ and ring > 0 and ring_ > 0"), "nested holes"))
    out = out.unionByName(told(whole.where("part = part_ and ring = 0 and ring_ > 0"), "hole outside"))  # the shell lies in its own hole
    holes = box.where("ring > 0").join(total, [key, "part", "ring"]).join(pair.where("part = part_ and ring_ = 0").select(key, "part", "ring"), [key, "part", "ring"], "left_anti")
    holes = holes.join(laid.where("part = part_ and ring_ = 0").select(key, "part", "ring"), [key, "part", "ring"], "left_anti")
    out = out.unionByName(told(holes, "hole outside"))
    covered = whole.where("part <> part_ and ring = 0").groupBy(key, "part", "part_", "at").agg(F.count("*").alias("depth"))
    out = out.unionByName(told(covered.where("depth % 2 = 1"), "parts overlap"))
    return out.unionByName(interiors_in_pieces(met, key))


def interiors_in_pieces(met: DataFrame, key: str) -> DataFrame:
    """Parts whose rings touch in a circle: rings and touching points as a graph that isn't a forest."""
    touch = met.where("kind = 'touch' and part = part_").select(key, "part", F.explode(F.array("ring", "ring_")).alias("ring"), "p").distinct()
    named = touch.select(key, "part", F.struct(F.col(key).cast("string").alias("k"), "part", F.col("ring").cast("string").alias("n"), F.lit(True).alias("r")).alias("src"), F.struct(F.col(key).cast("string").alias("k"), "part", F.to_json("p").alias("n"), F.lit(False).alias("r")).alias("dst"), "p")
    links = cut(named.select(key, "part", F.to_json("src").alias("src"), F.to_json("dst").alias("dst"), "p", F.lit(1.0).alias("length")))
    if links.isEmpty():
        return links.select(key, F.lit("").alias("reason"), F.col("p.x").alias("x"), F.col("p.y").alias("y"))
    labels = component_labels(links.select("src", "dst", "length"))
    per = links.join(labels.withColumnRenamed("node", "src"), "src").groupBy(key, "part", "label").agg(F.count("*").alias("lines"), (F.count_distinct("src") + F.count_distinct("dst")).alias("nodes"), F.min("p").alias("p"))
    return per.where("lines >= nodes").select(key, F.lit("interior in pieces").alias("reason"), F.col("p.x").alias("x"), F.col("p.y").alias("y"))


def cut_edges(e: DataFrame, points: DataFrame, ids: list[str]) -> DataFrame:
    """e(ids, ends), cut at points(ids, c: struct<x, y>): ids and the ends of every piece, in the direction of its edge."""
    p = lambda x, y: F.struct(F.col(x).alias("x"), F.col(y).alias("y"))
    stops = e.select(*ids, p("x1", "y1").alias("o"), F.explode(F.array(p("x1", "y1"), p("x2", "y2"))).alias("c"))
    stops = stops.unionByName(points.join(e.select(*ids, p("x1", "y1").alias("o")), ids).select(*ids, "o", "c")).distinct()
    way = F.abs(F.col("c.x") - F.col("o.x")) + F.abs(F.col("c.y") - F.col("o.y"))
    order = Window.partitionBy(*ids).orderBy("way", "c")
    rows = stops.withColumn("way", way).withColumn("to", F.lead("c").over(order)).where("to is not null")
    return rows.select(*ids, F.col("c.x").alias("x1"), F.col("c.y").alias("y1"), F.col("to.x").alias("x2"), F.col("to.y").alias("y2"))


def noded(e: DataFrame, ids: list[str], cell: float) -> DataFrame:
    """e(ids, last, ends) cut wherever edges of any shapes meet: crossings, corners on edges, ends of stretches that they share."""
    met = cut(meetings(e, [], ids, cell))
    points = met.select(*ids, F.explode(F.array("p", "q")).alias("c")).unionByName(met.select(*[F.col(f"{c}_").alias(c) for c in ids], F.explode(F.array("p", "q")).alias("c"))).distinct()
    return cut_edges(e.select(*ids, *ENDS), points, ids)


def outline(areas: DataFrame, key: str, shape: str, cell: float) -> DataFrame:
    """The border of the union of all areas as pieces x1, y1, x2, y2 with the union on their left.

    All edges are noded. A piece is border if areas that have it lie on one side of it only and no other area covers it.
    """
    rings = rings_of(areas, key, shape)
    turned = (G.signed_area(F.col("points")) > 0) == (F.col("ring") == 0)  # the shell goes left about, holes right about
    rings = rings.withColumn("points", F.when(turned, F.col("points")).otherwise(F.reverse("points")))
    ids = [key, *ID]
    pieces = cut(noded(edges_of(rings), ids, cell))
    a, b = F.struct(F.col("x1").alias("x"), F.col("y1").alias("y")), F.struct(F.col("x2").alias("x"), F.col("y2").alias("y"))
    # An area may have a piece twice, both ways round: there it is on both sides.
    sided = pieces.select(key, F.least(a, b).alias("a"), F.greatest(a, b).alias("b"), (a < b).alias("left"))
    border = sided.groupBy("a", "b").agg(F.max(F.col("left").cast("int")).alias("l"), F.max((~F.col("left")).cast("int")).alias("r")).where("l + r = 1")
    border = cut(border)
    middles = border.select(F.struct("a", "b").alias("piece"), ((F.col("a.x") + F.col("b.x")) / 2).alias("x"), ((F.col("a.y") + F.col("b.y")) / 2).alias("y"))
    covering = located(middles, areas, "piece", key, shape, cell).where("inside").select("piece.a", "piece.b", key)
    covered = covering.join(sided.select("a", "b", key), ["a", "b", key], "left_anti").select("a", "b").distinct()
    left = border.join(covered, ["a", "b"], "left_anti")
    start, end = F.when(F.col("l") == 1, F.col("a")).otherwise(F.col("b")), F.when(F.col("l") == 1, F.col("b")).otherwise(F.col("a"))
    return left.select(start.alias("s"), end.alias("t")).select(F.col("s.x").alias("x1"), F.col("s.y").alias("y1"), F.col("t.x").alias("x2"), F.col("t.y").alias("y2"))


def following(pieces: DataFrame, within: list[str], sharpest: bool) -> DataFrame:
    """(id, next) of pieces(id, ends, within): at each corner the pieces that arrive and leave alternate round it; each arriving one goes on with its neighbour.

    The sharpest left turn keeps to the wedge of the union that it borders; otherwise it goes on across the gap.
    """
    angle = lambda ax, ay, bx, by: F.atan2(F.col(by) - F.col(ay), F.col(bx) - F.col(ax))
    leaving = pieces.select("id", *within, F.col("x1").alias("x"), F.col("y1").alias("y"), angle("x1", "y1", "x2", "y2").alias("angle"), F.lit(False).alias("arrives"))
    arriving = pieces.select("id", *within, F.col("x2").alias("x"), F.col("y2").alias("y"), angle("x2", "y2", "x1", "y1").alias("angle"), F.lit(True).alias("arrives"))
    corner = Window.partitionBy("x", "y", *within)
    round_it = corner.orderBy("angle", "arrives")
    whole = round_it.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    beside = F.coalesce(F.lag("id").over(round_it), F.last("id").over(whole)) if sharpest else F.coalesce(F.lead("id").over(round_it), F.first("id").over(whole))
    return leaving.unionByName(arriving).withColumn("next", beside).where("arrives").select("id", "next")


def circles(steps: DataFrame) -> tuple[DataFrame, int]:
    """(id, next, label): the smallest id of the circle that each id is on, by doubling how far it looks; and the number of rounds."""
    state, rounds = settled(steps.select("id", "next", F.col("next").alias("jump"), F.least("id", "next").alias("label"))), 1
    while True:
        there = state.select(F.col("id").alias("jump"), F.col("jump").alias("far"), F.col("label").alias("seen"))
        moved = settled(state.join(there, "jump").select("id", "next", F.col("far").alias("jump"), F.least("label", "seen").alias("label"), (F.col("seen") < F.col("label")).alias("new")))
        rounds += 1
        state = moved.drop("new")
        if moved.where("new").isEmpty():
            return state.select("id", "next", "label"), rounds


def closed_rings(border: DataFrame) -> DataFrame:
    """ring_id (its first corner), hole, edges, length, area and ring (its closed points, from the smallest corner on) of directed border pieces.

    Rings are told apart and put in order by list ranking with pointer doubling: as many rounds as the logarithm of the longest ring.
    Borders that touch at a corner are rings of their own, and a ring that comes back to a corner is parted there.
    """
    pieces = cut(cut(border).withColumn("id", F.monotonically_increasing_id()))
    steps, rounds = circles(following(pieces, [], True))
    labelled = pieces.join(steps.select("id", "label"), "id")
    if not labelled.groupBy("x1", "y1", "label").agg(F.count("*").alias("n")).where("n > 1").isEmpty():
        steps, rounds = circles(following(cut(labelled), ["label"], False))
    start = F.col("id") == F.col("label")
    state = steps.select("id", "label", F.when(start, F.col("id")).otherwise(F.col("next")).alias("jump"), F.when(start, 0).otherwise(1).cast("long").alias("left"))
    for _ in range(rounds):
        there = state.select(F.col("id").alias("jump"), F.col("jump").alias("far"), F.col("left").alias("more"))
        state = settled(state.join(there, "jump").select("id", "label", F.col("far").alias("jump"), (F.col("left") + F.col("more")).alias("left")))
    corners = pieces.join(state.select("id", "label", "left"), "id")
    # left counts the steps to the ring's first piece, so the largest comes right behind it.
    spot = F.struct(F.when(F.col("left") == 0, F.lit(-(1 << 62))).otherwise(-F.col("left")).alias("k"), F.col("x1").alias("x"), F.col("y1").alias("y"))
    rings = corners.groupBy("label").agg(F.array_sort(F.collect_list(spot)).alias("c"), F.sum(F.hypot(F.col("x2") - F.col("x1"), F.col("y2") - F.col("y1"))).alias("length"))
    points = F.transform("c", lambda c: F.struct(c["x"].alias("x"), c["y"].alias("y")))
    rings = rings.withColumn("p", points).withColumn("at", F.array_position("p", F.array_min("p")).cast("int"))
    turned = F.concat(F.slice("p", F.col("at"), F.size("p")), F.slice("p", F.lit(1), F.col("at")))
    rings = rings.withColumn("ring", turned).withColumn("area", G.signed_area(F.col("ring")))
    first = F.col("ring")[0]
    return rings.select(F.concat_ws(" ", first["x"].cast("string"), first["y"].cast("string"), F.when(F.col("area") < 0, "hole")).alias("ring_id"), (F.col("area") < 0).alias("hole"), F.size("p").alias("edges"), "length", F.abs("area").alias("area"), "ring")


def dissolve(areas: DataFrame, key: str, shape: str, cell: float) -> DataFrame:
    """The rings of the union of all areas, as closed_rings gives them; holes are those that go right about."""
    return closed_rings(outline(areas, key, shape, cell))


def united(areas: DataFrame, key: str, shape: str, cell: float) -> DataFrame:
    """band, cx, x0, x9: the stretches of each band and part of a cell that lie inside of areas over the band's whole height, as few as there can be.

    How many areas lie over each other makes no difference to them."""
    width = cell / PARTS
    s = strips(areas, key, shape, cell).where("n = 0").select("band", "x0", "x9", F.explode(F.sequence(F.floor(F.col("x0") / width), F.floor(F.col("x9") / width))).alias("cx"))
    s = s.select("band", "cx", F.greatest(F.col("x0"), F.col("cx") * width).alias("x0"), F.least(F.col("x9"), (F.col("cx") + 1) * width).alias("x9")).where("x0 < x9")
    order = Window.partitionBy("band", "cx").orderBy("x0", "x9")
    reached = F.max("x9").over(order.rowsBetween(Window.unboundedPreceding, -1))
    islands = s.withColumn("new", F.coalesce(F.col("x0") > reached, F.lit(True)).cast("int")).withColumn("island", F.sum("new").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    return islands.groupBy("band", "cx", "island").agg(F.min("x0").alias("x0"), F.max("x9").alias("x9")).drop("island")


def covered_runs(s: DataFrame, areas: DataFrame, key: str, shape: str, cell: float) -> DataFrame:
    """s(..., ends) with low and high: the intervals of its parameter in which an edge runs through `united`."""
    width, height, dx, dy = cell / PARTS, cell / BANDS, F.col("x2") - F.col("x1"), F.col("y2") - F.col("y1")
    limits = lambda a, b: (F.least(a, b), F.greatest(a, b))
    when_at = lambda c, d, v: (v - F.col(c)) / F.nullif(d, F.lit(0.0))
    run = s.withColumn("band", F.explode(F.sequence(F.floor(F.least("y1", "y2") / height), F.floor(F.greatest("y1", "y2") / height))))
    low, high = limits(when_at("y1", dy, F.col("band") * height), when_at("y1", dy, (F.col("band") + 1) * height))
    run = run.withColumn("low", F.greatest(low, F.lit(0.0))).withColumn("high", F.least(high, F.lit(1.0))).where("low <= high")
    west, east = limits(F.col("x1") + dx * F.col("low"), F.col("x1") + dx * F.col("high"))
    run = run.withColumn("cx", F.explode(F.sequence(F.floor(west / width), F.floor(east / width))))
    met = run.join(united(areas, key, shape, cell), ["band", "cx"]).where((dx != 0) | F.col("x1").between(F.col("x0"), F.col("x9")))
    low, high = limits(when_at("x1", dx, F.col("x0")), when_at("x1", dx, F.col("x9")))
    return met.withColumn("low", F.greatest("low", low)).withColumn("high", F.least("high", high)).where("low <= high").select(*s.columns, "low", "high")


def left_open(covers: DataFrame, by: list[str]) -> DataFrame:
    """covers(by, low, high) with prior: how far all of the same `by` that begin before a row reach; where low is beyond it, what lies between is open."""
    return covers.withColumn("prior", F.max("high").over(Window.partitionBy(*by).orderBy("low", "high").rowsBetween(Window.unboundedPreceding, -1)))


def overlay(lines: DataFrame, areas: DataFrame, line_key: str, line: str, key: str, shape: str, cell: float) -> DataFrame:
    """line_key, length, outside (the length outside of all areas, their borders counting as inside) and touches, of lines of many points.

    Of each stretch between two points that is left out first which runs through bands inside of areas, however many lie there. The rest
    is cut where borders meet it. What areas cover are intervals of its parameter from 0 to 1: pieces whose middle lies inside, and
    stretches that run along a border; a window unites them, so nothing is covered twice.
    """
    ids = [line_key, "part", "seq"]
    paths = lines.select(line_key, F.posexplode([F.array(F.col(line)), F.col(line)][nesting(lines, line) - 1]).alias("part", "points"))
    paths = paths.select(line_key, "part", distinct_points(F.col("points")).alias("points"))
    s = edges_of(paths.repartition(tasks(lines), line_key, "part")).drop("last")
    ends = lambda df, low, high: df.select(*s.columns, F.explode(F.array(low, high)).alias("low"), F.lit(False).alias("covers")).withColumn("high", F.col("low"))
    marks = covered_runs(s, areas, key, shape, cell).withColumn("covers", F.lit(True)).unionByName(ends(s, F.lit(0.0), F.lit(1.0)))
    gap = F.when(F.col("low") > F.col("prior"), F.struct(F.col("prior").alias("lo"), F.col("low").alias("hi")))
    s = cut(left_open(marks, ids).groupBy(*s.columns).agg(F.collect_list(gap).alias("gaps"), F.max("covers").alias("covered")))
    dx, dy = F.col("x2") - F.col("x1"), F.col("y2") - F.col("y1")
    gaps = s.select(*ids, *ENDS, F.explode("gaps").alias("g")).select(*ids, "g.lo", "g.hi", *ENDS)
    full = {c: F.col(f"full_{c}") for c in ENDS}
    along_at = lambda c, d, t: F.when(F.col(t) == 0, F.col(f"{c}1")).when(F.col(t) == 1, F.col(f"{c}2")).otherwise(F.col(f"{c}1") + d * F.col(t))
    parts = gaps.select(*ids, "lo", "hi", *[F.col(c).alias(f"full_{c}") for c in ENDS], along_at("x", dx, "lo").alias("x1"), along_at("y", dy, "lo").alias("y1"), along_at("x", dx, "hi").alias("x2"), along_at("y", dy, "hi").alias("y2"))
    dealt = in_cells(parts, cell).select(*ids, "lo", "hi", *full.values(), "cx", "cy")
    e = in_cells(shape_edges(areas, key, shape).select(*ENDS), cell).select("cx", "cy", *[F.col(c).alias(f"{c}_") for c in ENDS])
    how = meeting(full, {c: F.col(f"{c}_") for c in ENDS})
    along = lambda p: F.when(F.abs(full["x2"] - full["x1"]) >= F.abs(full["y2"] - full["y1"]), (F.col(f"{p}.x") - full["x1"]) / F.nullif(full["x2"] - full["x1"], F.lit(0.0))).otherwise((F.col(f"{p}.y") - full["y1"]) / F.nullif(full["y2"] - full["y1"], F.lit(0.0)))
    spot = [*ids, "lo", "hi"]
    met = dealt.join(e, ["cx", "cy"]).select(*spot, *full.values(), F.explode(F.array(how)).alias("m")).where("m is not null").select(*spot, *full.values(), "m.*")
    met = met.select(*spot, F.greatest(F.least(along("p"), along("q")), "lo").alias("low"), F.least(F.greatest(along("p"), along("q")), "hi").alias("high"))
    met = cut(met.where("low <= high").distinct())
    stops = gaps.select(*spot, F.explode(F.array("lo", "hi")).alias("t")).unionByName(met.select(*spot, F.explode(F.array("low", "high")).alias("t"))).distinct()
    pieces = stops.withColumn("high", F.lead("t").over(Window.partitionBy(*spot).orderBy("t"))).where("high is not null").withColumnRenamed("t", "low")
    middle = (F.col("low") + F.col("high")) / 2
    probes = cut(pieces.join(s.drop("gaps", "covered"), ids).select(F.struct(*spot, "low", "high").alias("spot"), (F.col("x1") + dx * middle).alias("x"), (F.col("y1") + dy * middle).alias("y")))
    inside = cut(located(probes, areas, "spot", key, shape, cell).where("inside").select("spot.*").distinct())
    covers = inside.unionByName(met.where("low < high").select(*inside.columns)).unionByName(gaps.select(*spot, F.explode(F.array("lo", "hi")).alias("low")).withColumn("high", F.col("low")))
    free = left_open(covers, spot).where("low > prior").groupBy(*ids).agg(F.sum(F.col("low") - F.col("prior")).alias("share"))
    length = F.hypot(dx, dy)
    measured = s.join(free, ids, "left").groupBy(line_key).agg(F.sum(length).alias("length"), F.sum(length * F.coalesce("share", F.lit(0.0))).alias("outside"), F.max("covered").alias("covered"))
    touching = met.select(line_key).unionByName(inside.select(line_key))
    # A path of one point only has no stretch; of any other what it lies in is found with its pieces.
    starts = cut(paths.where(F.size("points") == 1).select(F.struct(line_key, "part").alias("spot"), F.get("points", F.lit(0))["x"].alias("x"), F.get("points", F.lit(0))["y"].alias("y")))
    if not starts.isEmpty():
        touching = touching.unionByName(located(starts, areas, "spot", key, shape, cell).select(f"spot.{line_key}"))
    touching = touching.distinct().withColumn("touches", F.lit(True))
    out = lines.select(line_key).join(measured, line_key, "left").join(touching, line_key, "left")
    return out.select(line_key, F.coalesce("length", F.lit(0.0)).alias("length"), F.coalesce("outside", F.lit(0.0)).alias("outside"), F.coalesce("touches", "covered", F.lit(False)).alias("touches"))
