"""Nearest targets, counts within a radius and parts of even size over uneven points: a tree of cells, walked level by level with joins.

A cell with more than LEAF targets is parted into FAN x FAN cells; those without targets don't exist. All points go down the tree together: each
round joins them to the children of the cells that they still have to look into, and what the bounds of a child rule out is dropped. However
many points or targets one spot holds, no task gets more than the children of a cell or the targets of a leaf for a point.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tractlake.operators.keeping import cut

#: Targets of a cell that isn't parted further, cells that one is parted into along each axis, and the most levels.
LEAF, FAN, LEVELS = 32, 8, 9
#: Where circles are counted: targets of a leaf, places that go down the tree together, those that are met at once, and targets that meet a group in one task.
CIRCLE_LEAF, TOGETHER, BOX, TARGETS_A_TASK = 256, 2048, 64, 200_000


@dataclass(frozen=True)
class Square:
    """The square that all targets lie in."""

    x: float
    y: float
    width: float

    def cell(self, c: str, low: float, level: int) -> Column:
        n = FAN**level
        return F.least(F.floor((F.col(c) - low) / self.width * n), F.lit(n - 1)).cast("long")

    def cells(self, level: int) -> list[Column]:
        """The cell of a target at a level, and its parent's."""
        now = [self.cell("x", self.x, level).alias("ix"), self.cell("y", self.y, level).alias("iy")]
        return now + [F.floor(c / FAN).cast("long").alias(n) for c, n in zip((self.cell("x", self.x, level), self.cell("y", self.y, level)), ("px", "py"), strict=True)]


def square(targets: DataFrame) -> Square | None:
    """None without targets."""
    e = targets.agg(F.min("x").alias("a"), F.min("y").alias("b"), F.max("x").alias("c"), F.max("y").alias("d")).first()
    if e["a"] is None:
        return None
    return Square(e["a"], e["b"], max(e["c"] - e["a"], e["d"] - e["b"]) or 1.0)


def children(targets: DataFrame, within: Square, level: int, most: int) -> DataFrame:
    """Of the targets left at this level the cells with their bounds, how many targets they have (n places, weight in all) and whether they are parted further."""
    box = [f(c).alias(name) for name, f, c in (("x0", F.min, "x"), ("y0", F.min, "y"), ("x1", F.max, "x"), ("y1", F.max, "y"))]
    kinds = F.bit_or("kinds") if "kinds" in targets.columns else F.lit(1).cast("long")
    counted = targets.select("*", *within.cells(level)).groupBy("px", "py", "ix", "iy").agg(F.count("*").alias("n"), F.sum("weight").alias("weight"), kinds.alias("kinds"), *box)
    return counted.withColumn("open", (F.col("n") > most) & F.lit(level < LEVELS))


def places(targets: DataFrame, key: str | None = None, kind: str | None = None) -> DataFrame:
    """x, y, weight, and the smallest key of the targets at each place, for each kind of its own if there are kinds."""
    at = targets.select(F.col("x").cast("double").alias("x"), F.col("y").cast("double").alias("y"), *([key] if key else []), *([kind] if kind else [])).where("x is not null and y is not null")
    return at.groupBy("x", "y", *([kind] if kind else [])).agg(F.count("*").alias("weight"), *([F.min(key).alias(key)] if key else []))


def reach(c: str, low: Column, high: Column) -> tuple[Column, Column]:
    """The least and the largest distance along one axis from a point to a cell's bounds."""
    return F.greatest(low - F.col(c), F.col(c) - high, F.lit(0.0)), F.greatest(F.abs(F.col(c) - low), F.abs(F.col(c) - high))


def beneath(front: DataFrame, cells: DataFrame, level: int) -> DataFrame:
    """front(qx, qy, px, py, ...) beside the children of its cells. All points start at the one cell of the top, whose FAN x FAN children go to every task."""
    return front.join(F.broadcast(cells) if level == 1 else cells, ["px", "py"])


def met(front: DataFrame, cells: DataFrame, level: int) -> DataFrame:
    """front beside the children of its cells, with near and far: the least and largest distance to a target of each."""
    (ax, bx), (ay, by) = reach("qx", F.col("x0"), F.col("x1")), reach("qy", F.col("y0"), F.col("y1"))
    return beneath(front, cells, level).withColumn("near", F.hypot(ax, ay)).withColumn("far", F.hypot(bx, by))


def start(points: DataFrame, key: str, *more: str) -> DataFrame:
    top = F.lit(0).cast("long")
    placed = points.select(key, *more, F.col("x").cast("double").alias("qx"), F.col("y").cast("double").alias("qy")).where("qx is not null and qy is not null")
    return placed.withColumn("px", top).withColumn("py", top)


def parted(targets: DataFrame, cells: DataFrame, within: Square, level: int) -> tuple[DataFrame, DataFrame]:
    """The targets in leaves of this level, with ix and iy, and those in cells that are parted further."""
    named = targets.select("*", *within.cells(level)).drop("px", "py").join(cells.select("ix", "iy", "open"), ["ix", "iy"])
    return named.where("not open").drop("open"), named.where("open").drop("open", "ix", "iy")


def nearest(points: DataFrame, targets: DataFrame, point_key: str, target_key: str, most: int = LEAF, manhattan: bool = False, kind: str | None = None, allowed: str | None = None) -> DataFrame:
    """point_key, target_key and distance of the nearest target, ties to the smaller key; exact. Points without coordinates, and all where there are no targets, get nulls.

    kind and allowed: columns of the targets and of the points; a kind is one bit, and a point only sees targets whose kind is among its allowed bits.
    """
    apart = (lambda a, b: a + b) if manhattan else F.hypot
    one = F.lit(1).cast("long")
    left = cut(places(targets.withColumn("kinds", F.col(kind).cast("long") if kind else one), target_key, "kinds"))
    within = square(left)
    if within is None:
        nothing = targets.select(F.lit(None).cast(points.schema[point_key].dataType).alias(point_key), target_key, F.lit(0.0).alias("distance")).limit(0)
        return points.select(point_key).join(nothing, point_key, "left")
    front, level, found = start(points.withColumn("sees", F.col(allowed).cast("long") if allowed else one), point_key, "sees").repartition(F.col(point_key)).withColumn("bound", F.lit(float("inf"))), 1, None
    (ax, bx), (ay, by) = reach("qx", F.col("x0"), F.col("x1")), reach("qy", F.col("y0"), F.col("y1"))
    while True:
        cells = cut(children(left, within, level, most))
        # The bound of a point is the least of its children's, found by an aggregate that leaves a row for each cell it looks into before anything travels.
        few = F.broadcast(cells) if level <= 2 else cells  # FAN ** 4 at most in the first two levels
        beside = lambda f: f.join(few, ["px", "py"]).where(F.col("kinds").bitwiseAND(F.col("sees")) != 0)  # noqa: B023, E731
        least = beside(front).groupBy(point_key).agg(F.min(apart(bx, by)).alias("least"))
        front = front.join(least, point_key).withColumn("bound", F.least("bound", F.col("least") * (1 + 1e-12)))
        looked = beside(front).withColumn("near", apart(ax, ay)).where("near <= bound")
        looked = cut(looked.select(point_key, "qx", "qy", "sees", "ix", "iy", "open", "near", "bound"))
        leaves, left = parted(left, cells, within, level)
        # The targets of a leaf meet the points that look into it; the best one of each point is a bound for what it still looks into.
        best = looked.where("not open").join(leaves, ["ix", "iy"]).where(F.col("kinds").bitwiseAND(F.col("sees")) != 0)
        best = best.withColumn("distance", apart(F.abs(F.col("qx") - F.col("x")), F.abs(F.col("qy") - F.col("y"))))
        best = best.groupBy(point_key).agg(F.min(F.struct("distance", target_key)).alias("b"))
        more = not cells.where("open").isEmpty()
        found = best if found is None else found.unionByName(best).groupBy(point_key).agg(F.min("b").alias("b"))
        if not more:
            return points.select(point_key).join(found.select(point_key, f"b.{target_key}", "b.distance"), point_key, "left")
        found = cut(found)
        known = found.select(point_key, F.col("b.distance").alias("d"))
        front = looked.where("open").join(known, point_key, "left").withColumn("bound", F.least("bound", F.coalesce("d", "bound") * (1 + 1e-12))).where("near <= bound")
        front = front.select(point_key, "qx", "qy", "sees", F.col("ix").alias("px"), F.col("iy").alias("py"), "bound")
        left, level = cut(left), level + 1


def counts_in_circles(places_: np.ndarray, targets: np.ndarray, radius: float) -> np.ndarray:
    """How much weight of targets (x, y, weight) each of places_ (x, y) has at most radius away. Places are taken in small boxes: what lies inside or outside
    of the circles of a whole box isn't looked at place by place."""
    out, (x, y), weight = np.zeros(len(places_), np.int64), targets[:, :2].T, targets[:, 2]
    strip = max(1, math.isqrt(len(places_) // BOX))
    rank = np.argsort(np.argsort(places_[:, 0], kind="stable"), kind="stable") * strip // max(1, len(places_))
    order = np.lexsort((places_[:, 1], rank))
    for k in range(0, len(order), BOX):
        here = order[k : k + BOX]
        px, py = places_[here].T
        left, right, low, high = px.min(), px.max(), py.min(), py.max()
        near = np.hypot(np.maximum(np.maximum(left - x, x - right), 0), np.maximum(np.maximum(low - y, y - high), 0))
        whole = np.hypot(np.maximum(x - left, right - x), np.maximum(y - low, high - y)) <= radius * (1 - 1e-12)
        edge = np.flatnonzero((near <= radius * (1 + 1e-12)) & ~whole)
        found = np.full(len(here), weight[whole].sum())
        for e in np.array_split(edge, 1 + len(edge) // 4096):
            found += ((px[:, None] - x[e]) ** 2 + (py[:, None] - y[e]) ** 2 <= radius * radius) @ weight[e]
        out[here] = np.rint(found).astype(np.int64)
    return out


def counts_within(points: DataFrame, targets: DataFrame, point_key: str, radius: float, most: int = CIRCLE_LEAF, together: int = TOGETHER) -> DataFrame:
    """point_key and n: how many targets are at most radius away. Places of points go down the tree in groups of at most `together` that lie near each other, each
    place once. Cells that lie inside the circles of a whole group count as they are; the leaves that an edge of them runs through meet the group in tasks of a bounded number of targets."""
    finite = "abs(x) < double('infinity') and abs(y) < double('infinity')"
    at = points.select(point_key, F.col("x").cast("double").alias("x"), F.col("y").cast("double").alias("y"))
    left = cut(places(targets).where(finite))
    within, level, whole, edges, loads = square(left), 1, [], [], []
    if within is None:
        return points.groupBy(point_key).agg(F.lit(0).cast("long").alias("n"))
    spots = at.where(finite).select("x", "y").distinct().select("x", "y", F.struct("x", "y").alias("at"))
    homes = cut(even_parts(spots, "at", together).select("home", "at.x", "at.y"))
    box = [f(c).alias(name) for name, f, c in (("qx0", F.min, "x"), ("qy0", F.min, "y"), ("qx1", F.max, "x"), ("qy1", F.max, "y"))]
    top = F.lit(0).cast("long")
    front = homes.groupBy("home").agg(*box).withColumn("px", top).withColumn("py", top)
    near = F.hypot(*[F.greatest(F.col(f"{c}0") - F.col(f"q{c}1"), F.col(f"q{c}0") - F.col(f"{c}1"), F.lit(0.0)) for c in "xy"])
    far = F.hypot(*[F.greatest(F.col(f"{c}1") - F.col(f"q{c}0"), F.col(f"q{c}1") - F.col(f"{c}0")) for c in "xy"])
    while True:
        cells = cut(children(left, within, level, most))
        looked = beneath(front, cells, level).where(near <= radius * (1 + 1e-12)).withColumn("whole", far <= radius * (1 - 1e-12))
        looked = cut(looked.select("home", "qx0", "qy0", "qx1", "qy1", "ix", "iy", "open", "n", "weight", "whole"))
        whole.append(looked.where("whole").select("home", "weight"))
        leaves, left = parted(left, cells, within, level)
        cutting = looked.where("not whole and not open")
        loads.append(cutting.select("home", "n"))
        edges.append(cutting.select("home", "ix", "iy").join(leaves, ["ix", "iy"]).select("home", F.xxhash64("ix", "iy").alias("cell"), "x", "y", "weight"))
        front = looked.where("open and not whole").select("home", "qx0", "qy0", "qx1", "qy1", F.col("ix").alias("px"), F.col("iy").alias("py"))
        if front.isEmpty():
            break
        left, level = cut(left), level + 1
    stacked = lambda parts: reduce(DataFrame.unionByName, parts)
    load = cut(stacked(loads).groupBy("home").agg(F.ceil(F.sum("n") / TARGETS_A_TASK).cast("int").alias("tasks")))
    met = stacked(edges).join(load, "home").select(F.col("home").alias("circles"), F.pmod("cell", F.col("tasks").cast("long")).cast("int").alias("part"), "x", "y", "weight")
    looking = homes.join(load, "home").select("home", F.explode(F.sequence(F.lit(0), F.col("tasks") - 1)).alias("task"), "x", "y")

    def run(_, own: pd.DataFrame, other: pd.DataFrame) -> pd.DataFrame:
        n = counts_in_circles(own[["x", "y"]].to_numpy(), other[["x", "y", "weight"]].to_numpy(np.float64), radius)
        return pd.DataFrame({"x": own["x"], "y": own["y"], "n": n})

    tested = looking.groupBy("home", "task").cogroup(met.groupBy("circles", "part")).applyInPandas(run, "x double, y double, n long")
    inside = homes.join(stacked(whole).groupBy("home").agg(F.sum("weight").alias("n")), "home").select("x", "y", "n")
    counts = tested.unionByName(inside).groupBy("x", "y").agg(F.sum("n").alias("n"))
    return at.join(counts, ["x", "y"], "left").groupBy(point_key).agg(F.sum(F.coalesce("n", F.lit(0))).alias("n"))


def pairs_within(points: DataFrame, targets: DataFrame, point_key: str, target_key: str, reach_: float, most: int = LEAF) -> DataFrame:
    """(point_key, target_key, distance) of all pairs whose Manhattan distance is at most reach_."""
    left = cut(targets.select(target_key, F.col("x").cast("double").alias("x"), F.col("y").cast("double").alias("y"), F.lit(1).alias("weight")).where("x is not null and y is not null"))
    within = square(left)
    front, level, found = start(points, point_key), 1, points.join(targets, F.lit(False)).select(point_key, target_key, F.lit(0.0).alias("distance"))
    apart = F.abs(F.col("qx") - F.col("x")) + F.abs(F.col("qy") - F.col("y"))
    while within is not None:
        cells = cut(children(left, within, level, most))
        near = F.greatest(F.col("x0") - F.col("qx"), F.col("qx") - F.col("x1"), F.lit(0.0)) + F.greatest(F.col("y0") - F.col("qy"), F.col("qy") - F.col("y1"), F.lit(0.0))
        looked = cut(beneath(front, cells, level).where(near <= reach_).select(point_key, "qx", "qy", "ix", "iy", "open"))
        leaves, left = parted(left, cells, within, level)
        found = found.unionByName(looked.where("not open").join(leaves, ["ix", "iy"]).select(point_key, target_key, apart.alias("distance")).where(F.col("distance") <= reach_))
        front = looked.where("open").select(point_key, "qx", "qy", F.col("ix").alias("px"), F.col("iy").alias("py"))
        if front.isEmpty():
            break
        left, level = cut(left), level + 1
    return found


def even_parts(points: DataFrame, key: str, most: int) -> DataFrame:
    """key and home: points(key, x, y) parted into cells of at most `most` places each, small where they are dense."""
    left = cut(points.select(key, F.col("x").cast("double").alias("x"), F.col("y").cast("double").alias("y"), F.lit(1).alias("weight")))
    within, level, out = square(left), 1, None
    while within is not None:
        cells = cut(children(left, within, level, most))
        leaves, left = parted(left, cells, within, level)
        named = leaves.select(key, F.concat_ws("/", F.lit(str(level)), "ix", "iy").alias("home"))
        out = named if out is None else out.unionByName(named)
        if cells.where("open").isEmpty():
            return out
        left, level = cut(left), level + 1
    return left.select(key, F.lit("").alias("home"))
