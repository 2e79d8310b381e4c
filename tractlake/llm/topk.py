"""Exact top-k search by inner product with a pivot table.

Components become integers floor(1024 x), so scores are exact. Each vector's distances to a fixed number of pivots are
computed once; for a query q and a block of vectors, the largest |d(q,p) - d(x,p)| over all pivots p is a lower bound of their distance, and
with the norms an upper bound of their inner product. For a query and one vector the distances to all pivots together give the largest lower
bound there is (see Frame).

1. Vectors are dealt to blocks of neighbours: those with the same nearest pivot, parted by a hash where they are many. A block has the
   range of its vectors' distances to every pivot, so it has bounds too.
2. Each query searches the block of the best bound first; its k-th best score there is what every other candidate has to reach.
3. A query then goes to those blocks only whose bound reaches that score. Every vector stays in its block: queries travel, and
   vectors are copied only where a block is asked by more than QUERIES_A_PART queries. In a block the candidates of each query are
   evaluated in the order of their bounds, until the next bound is below the k-th best score.

Defined results: vectors that are null, empty, or hold null or non-finite components, and rows without vec_id, take no
part; vectors of different dimension never meet; equal scores go to the smaller vec_id; repeated rows count once each,
though none is a candidate of its own vec_id; a query id that repeats asks with its least vector; a score that has no 64-bit integer is an error; an empty table gives no rows; extra
columns are not looked at.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tractlake.llm.common import cut, table

#: So many pivots are chosen, far from each other, among so many vectors.
PIVOTS, PIVOT_SAMPLE = 48, 512
VECTORS_A_BLOCK, QUERIES_A_PART = 4096, 4096
#: Blocks whose ranges reach every task; a table with more gets larger blocks.
MOST_BLOCKS = 1 << 15
#: Candidates that are evaluated between two looks at the bounds.
STEP = 256


def to_integers(embeddings: DataFrame, scale: int = 1024) -> DataFrame:
    """vec_id and the integer vector of each valid row."""
    x = F.col("embedding")
    fine = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v.cast("double")) & (F.abs(v.cast("double")) < float("inf")))
    rows = embeddings.where(F.col("vec_id").isNotNull() & x.isNotNull() & (F.size(x) > 0)).where(fine)
    return rows.select(F.col("vec_id").cast("long"), F.transform(x, lambda v: F.floor(v.cast("double") * scale)).alias("v"))


def choose_pivots(vectors: DataFrame, pivots: int = PIVOTS) -> np.ndarray:
    """Greedy farthest points of a bounded sample, of the most frequent dimension in it."""
    sample = [r["v"] for r in vectors.orderBy(F.xxhash64("vec_id")).limit(PIVOT_SAMPLE).collect()]
    if not sample:
        return np.zeros((0, 0))
    dims = [len(v) for v in sample]
    points = np.asarray([v for v in sample if len(v) == max(set(dims), key=dims.count)], dtype=np.float64)
    chosen, far = [0], ((points - points[0]) ** 2).sum(1)
    while len(chosen) < min(pivots, len(points)):
        chosen.append(int(far.argmax()))
        far = np.minimum(far, ((points - points[chosen[-1]]) ** 2).sum(1))
    return points[chosen]


def pivot_table(vectors: DataFrame, points: np.ndarray) -> DataFrame:
    """vec_id, v, and d: the distances to the pivots (zeros for other dimensions, which bound nothing)."""

    def run(batches):
        for batch in batches:
            d = np.zeros((len(batch), len(points)))
            same = np.flatnonzero(batch["v"].map(len).to_numpy() == points.shape[1])
            if len(same):
                x = np.stack(batch["v"].to_numpy()[same]).astype(np.float64)
                for k, p in enumerate(points):
                    d[same, k] = np.sqrt(((x - p) ** 2).sum(1))
            yield batch.assign(d=list(d))

    return vectors.mapInPandas(run, "vec_id long, v array<bigint>, d array<double>")


class Frame:
    """What distances to all pivots say together: where a vector lies in the space that the pivots span, and how far off it.

    Two vectors are at least as far apart as their places in that space and the difference of their distances from it allow; no larger lower bound
    follows from the pivot table. Pivots that (nearly) depend on others add nothing and are left out.
    """

    def __init__(self, points: np.ndarray) -> None:
        self.dim = points.shape[1] if len(points) else 0
        chosen, basis = [], np.zeros((0, self.dim))
        for k, p in enumerate(points):
            rest = p - (p @ basis.T) @ basis
            rest -= (rest @ basis.T) @ basis
            if np.sqrt(rest @ rest) > 1e-3 * np.sqrt(p @ p):
                chosen.append(k)
                basis = np.vstack([basis, rest / np.sqrt(rest @ rest)])
        self.chosen, self.square = np.array(chosen, np.int64), (points[chosen] ** 2).sum(1) if chosen else np.zeros(0)
        self.turn = np.linalg.inv(points[chosen] @ basis.T) if chosen else np.zeros((0, 0))

    def place(self, x: np.ndarray, d: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Coordinates in the span of the pivots and the distance from it, from the vectors' norms and their distances to the pivots."""
        square = (x.astype(np.float64) ** 2).sum(1)
        if x.shape[1] != self.dim:
            return np.zeros((len(x), 0)), np.sqrt(square)
        at = ((square[:, None] + self.square - d[:, self.chosen] ** 2) / 2) @ self.turn.T
        return at, np.sqrt(np.maximum(square - (at**2).sum(1), 0))

    def bounds(self, q: np.ndarray, q_d: np.ndarray, x: np.ndarray, x_d: np.ndarray) -> np.ndarray:
        """The largest inner product of each query and vector that their pivot distances allow; rounding never makes it too small."""
        (q_at, q_off), (x_at, x_off) = self.place(q, q_d), self.place(x, x_d)
        size = np.sqrt((q_at**2).sum(1) + q_off**2)[:, None] * np.sqrt((x_at**2).sum(1) + x_off**2)[None, :]
        # A residual is the root of a difference of squares, so its own rounding is the root of theirs.
        return q_at @ x_at.T + (q_off[:, None] + 1e-5 * np.sqrt(size)) * (x_off[None, :] + 1e-5 * np.sqrt(size)) + 1e-6 * size + 1


def scores_of(x: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Exact inner products of integer vectors: in floats where every sum stays a whole number below 2**53, else in 64 bits, else in Python's integers."""
    most = int(np.abs(x).max(initial=0)) * int(np.abs(q).max(initial=0)) * x.shape[1]
    if most < 1 << 53:
        return (x.astype(np.float64) @ q.astype(np.float64)).astype(np.int64)
    if most < 1 << 63:
        return x @ q
    return x.astype(object) @ q.astype(object)


def upper_bounds(q_norm: np.ndarray, q_d: np.ndarray, norm: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """For each query and each range of pivot distances (a vector has low = high) the largest inner product that may be there."""
    apart = np.zeros((len(q_d), len(low)))
    for p in range(q_d.shape[1]):
        d = q_d[:, p, None]
        np.maximum(apart, np.maximum(low[None, :, p] - d, d - high[None, :, p]), out=apart)
    apart = np.maximum(apart - 1e-6 * (1 + apart), 0)  # rounding never makes a bound too tight
    bound = (q_norm[:, None] + norm[None, :] - apart**2) / 2
    return bound + 1e-9 * np.abs(bound) + 1


def search_block(q_ids: np.ndarray, q: np.ndarray, q_d: np.ndarray, floor: np.ndarray, ids: np.ndarray, x: np.ndarray, x_d: np.ndarray, k: int, frame: Frame) -> list[tuple[int, int, int]]:
    """(query, vector, score) of the k best of this block for each query, of those that reach its floor."""
    bound = frame.bounds(q, q_d, x, x_d)
    bound[q_ids[:, None] == ids[None, :]] = -np.inf
    bound[bound < floor[:, None]] = -np.inf
    order = np.argsort(-bound, axis=1, kind="stable")
    out = []
    for i in range(len(q)):
        best: list[tuple[int, int]] = []
        for at in range(0, len(x), STEP):
            top = bound[i, order[i, at]]
            if top == -np.inf or len(best) == k and top < -best[-1][0]:
                break
            now = order[i, at : at + STEP]
            now = now[bound[i, now] > -np.inf]
            scores = scores_of(x[now], q[i])
            keep = sorted(range(len(now)), key=lambda j: (-scores[j], ids[now[j]]))[:k] if scores.dtype == object else np.lexsort((ids[now], -scores))[:k]
            best = sorted(best + [(-int(scores[j]), int(ids[now[j]])) for j in keep if scores[j] >= floor[i]])[:k]
        out += [(int(q_ids[i]), vec, -score) for score, vec in best]
    return out


def in_blocks(vectors: DataFrame, points: np.ndarray) -> tuple[DataFrame, pd.DataFrame]:
    """vectors(vec_id, v, d) with dim and block, and of each dim and block the ranges of its distances, its largest norm and its size."""
    nearest = F.array_position("d", F.array_min("d")) if len(points) else F.lit(0).cast("long")
    placed = vectors.withColumn("dim", F.size("v")).withColumn("home", F.coalesce(nearest, F.lit(0)))
    sizes = placed.groupBy("dim", "home").agg(F.count("*").alias("many")).collect()  # a row for each dimension and pivot
    size = max(VECTORS_A_BLOCK, -(-sum(r["many"] for r in sizes) // MOST_BLOCKS))
    parts = F.lit(1)
    for r in sizes:
        if r["many"] > size:
            parts = F.when((F.col("dim") == r["dim"]) & (F.col("home") == r["home"]), -(-r["many"] // size)).otherwise(parts)
    placed = placed.withColumn("block", F.col("home") * MOST_BLOCKS + F.pmod(F.xxhash64("vec_id"), parts.cast("long"))).drop("home")
    norm = F.aggregate("v", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))
    ranges = [f(F.get("d", F.lit(p))).alias(f"{n}{p}") for p in range(len(points)) for n, f in (("low", F.min), ("high", F.max))]
    return placed, placed.groupBy("dim", "block").agg(F.max(norm).alias("norm"), F.count("*").alias("many"), *ranges).toPandas()  # about MOST_BLOCKS rows at most


def asked_blocks(queries: DataFrame, ranges: pd.DataFrame, pivots: int, first: bool) -> DataFrame:
    """queries(vec_id, v, d, dim, floor) with the block of the best bound (first), or with each other block that reaches their floor."""
    sent = queries.sparkSession.sparkContext.broadcast({dim: part for dim, part in ranges.groupby("dim")})

    def run(batches):
        for batch in batches:
            for dim, part in batch.groupby("dim"):
                blocks = sent.value[dim]
                table = lambda n: blocks[[f"{n}{p}" for p in range(pivots)]].to_numpy(np.float64).reshape(len(blocks), pivots)  # noqa: E731, B023
                low, high, norm, names = table("low"), table("high"), blocks["norm"].to_numpy(np.float64), blocks["block"].to_numpy()
                for at in range(0, len(part), 256):
                    some = part.iloc[at : at + 256]
                    q_norm = np.array([(np.asarray(v, np.float64) ** 2).sum() for v in some["v"]])
                    bound = upper_bounds(q_norm, np.stack(some["d"].to_numpy()).reshape(len(some), pivots), norm, low, high)
                    best = bound.argmax(1)
                    if first:
                        yield some.assign(block=names[best])
                    else:
                        reach = bound >= some["floor"].to_numpy(np.float64)[:, None]
                        reach[np.arange(len(some)), best] = False
                        who, which = np.nonzero(reach)
                        yield some.iloc[who].assign(block=names[which])

    return queries.mapInPandas(run, "vec_id long, v array<bigint>, d array<double>, dim int, floor double, block long")


def searched(placed: DataFrame, asked: DataFrame, k: int, points: np.ndarray) -> DataFrame:
    """(query_id, vec_id, score) of the k best of each block for the queries that ask it."""
    frame = Frame(points)
    load = asked.groupBy("dim", "block").agg(F.ceil(F.count("*") / QUERIES_A_PART).cast("int").alias("parts"))
    load = cut(load)
    queries = asked.join(load, ["dim", "block"]).withColumn("part", F.pmod(F.xxhash64("vec_id"), F.col("parts").cast("long")).cast("int"))
    vectors = placed.join(load, ["dim", "block"]).withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))

    def run(_, a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        found = []
        if len(a) and len(b):
            whole, real = (lambda c: np.stack(c.to_numpy()).astype(np.int64)), (lambda c: np.stack(c.to_numpy()).astype(np.float64))
            for at in range(0, len(a), 512):
                some = a.iloc[at : at + 512]
                found += search_block(some["vec_id"].to_numpy(), whole(some["v"]), real(some["d"]), some["floor"].to_numpy(np.float64), b["vec_id"].to_numpy(), whole(b["v"]), real(b["d"]), k, frame)
        return pd.DataFrame(found, columns=["query_id", "vec_id", "score"])

    keys = ["dim", "block", "part"]
    return queries.groupBy(*keys).cogroup(vectors.groupBy(*keys)).applyInPandas(run, "query_id long, vec_id long, score long")


def once(queries: DataFrame) -> DataFrame:
    """One row for each vec_id, the least vector of those that repeat it."""
    return queries.groupBy("vec_id").agg(F.min(F.struct("v", "d")).alias("q")).select("vec_id", "q.v", "q.d")


def top_k(vectors: DataFrame, queries: DataFrame, points: np.ndarray, k: int) -> DataFrame:
    """query_id, rank, vec_id, score; both inputs as pivot_table gives them."""
    placed, ranges = in_blocks(vectors, points)
    placed = cut(placed)
    asking = queries.select("vec_id", "v", "d", F.size("v").alias("dim"), F.lit(float("-inf")).alias("floor"))
    first = cut(searched(placed, asked_blocks(asking, ranges, len(points), True), k, points))
    kth = first.groupBy(F.col("query_id").alias("vec_id")).agg(F.count("*").alias("n"), F.min("score").alias("least"))
    floor = F.when(F.col("n") >= k, F.col("least").cast("double")).otherwise(F.lit(float("-inf")))
    rest = asking.drop("floor").join(kth, "vec_id", "left").select("vec_id", "v", "d", "dim", F.coalesce(floor, F.lit(float("-inf"))).alias("floor"))
    best = first.unionByName(searched(placed, asked_blocks(rest, ranges, len(points), False), k, points))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op5_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = to_integers(table(spark, sf_dir, "embeddings"))
    points = choose_pivots(vectors)
    with_pivots = cut(pivot_table(vectors, points))
    return top_k(with_pivots, once(with_pivots.where(F.col("vec_id") % 100 == 0)), points, 10)


QUERIES = {"op5_topk": op5_topk}
ORACLE = {
    "op5_topk": """
WITH good AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(CAST(q.v AS DOUBLE[]), CAST(c.v AS DOUBLE[])) AS BIGINT) AS score
  FROM good q JOIN good c ON q.vec_id % 100 = 0 AND c.vec_id <> q.vec_id
), ranked AS (
  SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 10
"""
}
