"""Near duplicates among embeddings: a pivot-permutation index, inverted pivot lists, and verified cosines.

Every vector is described by the NEAREST reference points next to it, in order. Two vectors become candidates when their descriptions share at least
SHARED pivots; candidates are then verified in double precision.

1. Reference points are chosen, far from each other, in a bounded sample; there are more of them the more vectors there are. Every
   vector is described and indexed.
2. Dense spots are taken out of the index first: of each pivot's vectors a few are looked at together, and those that many others lie close to become
   centres. Vectors within half the linking angle of a centre are one clump: by the triangle inequality all its pairs are links, so
   they are counted and never listed, whatever share of the table it holds. The angle between a vector and a centre also settles most
   vectors against a clump as a whole; only what it leaves open is compared vector by vector, in blocks.
3. All others go to inverted lists, keyed by two pivots: those that share SHARED pivots share two of their rarest ones, so pairs of these are
   enough. A pair is met in one list only, the first that both have, its shared pivots are counted there, and its cosine is
   worked out once. Long lists are parted into blocks, and blocks meet pairwise.
4. Links of vectors and clumps are joined to components.

What the index loses are pairs whose descriptions share too few pivots: of pairs right at a cosine of 0.9, 7 in 1,000 with the pivots of 10,000 vectors,
2 in 100 with those of 50,000 and 4 in 100 with those of 250,000 and more (64 dimensions); at 0.95 hardly any.

Defined results: one row for each vec_id; rows without vec_id take no part; of rows that repeat a vec_id the least vector counts; vectors
that are null, empty, all zero, or hold null or non-finite components link with nothing and are kept; vectors of different dimension never
link; equal vectors link; an empty table gives no rows; extra columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tractlake.llm.common import cut, small_batches, table
from tractlake.llm.components import components

LINKED = 0.9
#: Pivots in a description, and those that candidates share at least.
NEAREST, SHARED = 10, 3
#: Reference points: about four times the root of the number of vectors, between these, from a sample of so many vectors.
PIVOTS, PIVOT_SAMPLE = (128, 2048), 4096
#: Vectors of a pivot that are looked at for dense spots, and how many have to lie together.
LOOKED_AT, DENSE = 64, 8
#: Vectors of a clump, or postings of a list, that meet in one task.
BLOCK = 2048
#: Pairs of postings that are compared at once.
PAIRS_A_STEP = 1 << 14
#: Radians that rounding may cost.
SLACK = 1e-6
VECTOR = "vec_id long, v array<double>"


def directions(embeddings: DataFrame) -> DataFrame:
    """vec_id and the unit vector of each vec_id, null where its vector can't link."""
    one = embeddings.where(F.col("vec_id").isNotNull()).groupBy(F.col("vec_id").cast("long").alias("vec_id")).agg(F.min(F.col("embedding").cast("array<double>")).alias("v"))

    def run(batches: Iterable[pd.DataFrame]) -> Iterable[pd.DataFrame]:
        for batch in batches:
            yield batch.assign(v=[unit(x) for x in batch["v"]])

    return one.mapInPandas(run, VECTOR)


def unit(x: np.ndarray | None) -> np.ndarray | None:
    """x at length 1; the largest component comes to 1 first, so that no square overflows or vanishes."""
    x = np.asarray([np.nan if y is None else y for y in x] if x is not None else [], np.float64)
    most = np.abs(x).max(initial=0)
    if not np.isfinite(x).all() or most == 0:
        return None
    x = x / most
    return x / np.sqrt((x * x).sum())


def stack(column: pd.Series) -> np.ndarray:
    return np.stack(column.to_numpy()).astype(np.float64)


def choose_pivots(vectors: DataFrame, number: int) -> dict[int, np.ndarray]:
    """For each dimension of a bounded sample its reference points: greedily those farthest from the ones before."""
    sample: dict[int, list] = {}
    for r in vectors.orderBy(F.xxhash64("vec_id"), "vec_id").limit(PIVOT_SAMPLE).collect():
        sample.setdefault(len(r["v"]), []).append(r["v"])
    out = {}
    for dim, rows in sample.items():
        x = np.asarray(rows, np.float64)
        chosen, near = [0], x @ x[0]
        while len(chosen) < min(number, len(x)) and near.min() < 1 - 1e-9:
            chosen.append(int(near.argmin()))
            near = np.maximum(near, x @ x[chosen[-1]])
        out[dim] = x[chosen]
    return out


def pivots_of(dim: int, chosen: dict[int, np.ndarray]) -> np.ndarray:
    """A dimension that the sample lacks is rare: it gets fixed reference points of its own."""
    if dim in chosen:
        return chosen[dim]
    x = np.random.default_rng(dim).normal(size=(PIVOTS[0], dim))
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def described(vectors: DataFrame, chosen: dict[int, np.ndarray]) -> DataFrame:
    """vectors(vec_id, v) with dim and p: the nearest pivots, the nearest first."""
    sent = vectors.sparkSession.sparkContext.broadcast(chosen)  # PIVOT_SAMPLE vectors at most

    def run(batches: Iterable[pd.DataFrame]) -> Iterable[pd.DataFrame]:
        for batch in batches:
            for dim, part in batch.groupby(batch["v"].map(len)):
                points = pivots_of(dim, sent.value)
                order = np.argsort(-(stack(part["v"]) @ points.T), axis=1, kind="stable")[:, :NEAREST]
                yield part.assign(dim=dim, p=list(order))

    return vectors.mapInPandas(run, f"{VECTOR}, dim int, p array<int>")


def dense_spots(rows: DataFrame, half: float) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Centres by dimension, those first that stand for most vectors: (ids, vectors). At most LOOKED_AT / DENSE for each pivot."""
    home = rows.select("dim", F.col("p")[0].alias("home"), "vec_id", "v")
    sizes = F.broadcast(home.groupBy("dim", "home").agg(F.count("*").alias("many")))  # a row for each pivot
    spread = home.join(sizes, ["dim", "home"]).where(F.pmod(F.xxhash64("vec_id"), F.greatest(F.floor(F.col("many") / LOOKED_AT), F.lit(1))) == 0)

    def run(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("vec_id").head(2 * LOOKED_AT)
        close = stack(part["v"]) @ stack(part["v"]).T >= np.cos(half)
        out, left = [], np.ones(len(part), bool)
        while left.any() and (many := (close & left).sum(1) * left).max() >= DENSE:
            best = int(many.argmax())
            out.append((part["dim"].iloc[0], part["vec_id"].iloc[best], part["v"].iloc[best], many[best] * part["many"].iloc[0] / len(part)))
            left &= ~close[best]
        return pd.DataFrame(out, columns=["dim", "vec_id", "v", "stands_for"])

    found = spread.groupBy("dim", "home").applyInPandas(run, f"dim int, {VECTOR}, stands_for double").orderBy(F.desc("stands_for"), "vec_id").collect()
    out: dict[int, list] = {}
    for r in found:
        out.setdefault(r["dim"], []).append((r["vec_id"], r["v"]))
    return {dim: (np.array([i for i, _ in c], np.int64), np.array([v for _, v in c])) for dim, c in out.items()}


def angles(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(x @ y.T, -1, 1))


def with_clumps(rows: DataFrame, centres: dict[int, tuple[np.ndarray, np.ndarray]], half: float) -> DataFrame:
    """rows with clump (the first centre within half the linking angle, or null) and away (the angle to it)."""
    sent = rows.sparkSession.sparkContext.broadcast(centres)

    def run(batches: Iterable[pd.DataFrame]) -> Iterable[pd.DataFrame]:
        for batch in batches:
            clump, away = np.full(len(batch), -1), np.zeros(len(batch))
            for dim, at in batch.groupby("dim").indices.items():
                if dim in sent.value:
                    far = angles(stack(batch["v"].iloc[at]), sent.value[dim][1])
                    near = far < half - SLACK
                    first, any_near = near.argmax(1), near.any(1)
                    clump[at], away[at] = np.where(any_near, first, -1), far[np.arange(len(at)), first]
            yield batch.assign(clump=pd.Series(clump, index=batch.index, dtype="Int64").where(clump >= 0), away=away)

    return rows.mapInPandas(run, f"{VECTOR}, dim int, p array<int>, clump long, away double")


def touched(rows: DataFrame, centres: dict[int, tuple[np.ndarray, np.ndarray]], clumps: pd.DataFrame, angle: float) -> DataFrame:
    """(vec_id, v, dim, own, clump, whole): the other clumps that a vector may have links into, and whether it has them with all of the clump."""
    radius = {dim: np.full(len(ids), -np.inf) for dim, (ids, _) in centres.items()}
    for dim, clump, away in zip(clumps["dim"], clumps["clump"], clumps["away"], strict=True):
        radius[dim][clump] = away
    sent = rows.sparkSession.sparkContext.broadcast((centres, radius))

    def run(batches: Iterable[pd.DataFrame]) -> Iterable[pd.DataFrame]:
        for batch in batches:
            for dim, part in batch.groupby("dim"):
                if dim not in sent.value[0]:
                    continue
                far, r = angles(stack(part["v"]), sent.value[0][dim][1]), sent.value[1][dim][None, :]
                may = far <= angle + r + SLACK
                own = part["clump"].fillna(-1).to_numpy(np.int64)
                has = np.flatnonzero(own >= 0)
                may[has, own[has]] = False
                who, which = np.nonzero(may)
                out = part.iloc[who][["vec_id", "v", "dim"]]
                yield out.assign(own=own[who], clump=which.astype(np.int64), whole=far[who, which] + r[0, which] <= angle - SLACK)

    return rows.select("vec_id", "v", "dim", "clump").mapInPandas(run, f"{VECTOR}, dim int, own long, clump long, whole boolean")


def compared(asking: DataFrame, members: DataFrame, sizes: DataFrame, linked: float) -> DataFrame:
    """(kind, id, n): links that asking vectors have into a clump (kind asks), and that its members have from vectors outside of clumps (kind gets).

    Both sides are dealt to blocks, so that no task holds a whole clump.
    """
    key = ["dim", "clump"]
    loads = sizes.select(*key, F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks")).join(asking.groupBy(*key).agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("parts")), key)
    loads = cut(loads)
    spread = lambda n, name: F.explode(F.sequence(F.lit(0), F.col(n) - 1)).alias(name)
    mine = lambda n: F.pmod(F.xxhash64("vec_id"), F.col(n).cast("long")).cast("int")
    a = asking.join(loads, key).select("vec_id", "v", "own", *key, mine("parts").alias("part"), spread("blocks", "block"))
    b = members.join(loads, key).select("vec_id", "v", *key, mine("blocks").alias("block"), spread("parts", "part"))

    def run(_, a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        if not len(a) or not len(b):
            return pd.DataFrame([], columns=["asks", "id", "n", "dim", "clump"])
        hit = stack(a["v"]) @ stack(b["v"]).T >= linked
        asks = pd.DataFrame({"asks": True, "id": a["vec_id"].to_numpy(), "n": hit.sum(1)})
        gets = pd.DataFrame({"asks": False, "id": b["vec_id"].to_numpy(), "n": hit[a["own"].to_numpy() < 0].sum(0)})
        out = pd.concat([asks, gets])
        return out[out["n"] > 0].assign(dim=b["dim"].iloc[0], clump=b["clump"].iloc[0])

    cells = [*key, "part", "block"]
    return a.groupBy(*cells).cogroup(b.groupBy(*cells)).applyInPandas(run, "asks boolean, id long, n long, dim int, clump long")


def candidates(single: DataFrame) -> DataFrame:
    """(a, b) of the vectors whose descriptions share enough pivots, each pair once, from lists keyed by two pivots."""
    often = single.select("dim", F.explode("p").alias("pivot")).groupBy("dim", "pivot").agg(F.count("*").alias("many"))
    ranks = often.groupBy("dim").agg(F.map_from_entries(F.collect_list(F.struct("pivot", "many"))).alias("rarity"))  # a row for each dimension, an entry for each pivot
    rare = single.join(F.broadcast(ranks), "dim").select("vec_id", "dim", F.transform(F.array_sort(F.transform("p", lambda x: F.struct(F.element_at("rarity", x).alias("many"), x.alias("pivot")))), lambda x: x["pivot"]).alias("p"))
    # Of SHARED pivots that two descriptions share the two rarest lie before the last SHARED - 2 places.
    use = F.slice("p", 1, F.greatest(F.size("p") - (SHARED - 2), F.least(F.size("p"), F.lit(2))))
    lists = F.flatten(F.transform(use, lambda x, i: F.transform(F.slice(use, i + 2, NEAREST), lambda y: F.struct(x.alias("p1"), y.alias("p2")))))
    lists = F.when(F.size("p") < 2, F.array(F.struct(F.lit(-1).alias("p1"), F.lit(-1).alias("p2")))).otherwise(lists)
    posted = cut(rare.select("vec_id", "dim", "p", F.explode(lists).alias("key")).select("vec_id", "dim", "p", "key.p1", "key.p2"))
    key = ["dim", "p1", "p2"]
    sizes = cut(posted.groupBy(*key).agg(F.count("*").alias("n")).where("n > 1").withColumn("blocks", F.ceil(F.col("n") / BLOCK).cast("int")))
    mine = F.pmod(F.xxhash64("vec_id"), F.col("blocks").cast("long")).cast("int")
    met = posted.join(sizes.select(*key, "blocks"), key).withColumn("block", mine).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    met = met.select("vec_id", "p", "block", *key, F.least("block", "other").alias("x"), F.greatest("block", "other").alias("y"))

    dealt = met.repartition(*key, "x", "y").sortWithinPartitions(*key, "x", "y", "vec_id")
    return dealt.mapInPandas(lists_met, "a long, b long")


def lists_met(batches: Iterable[pd.DataFrame]) -> Iterable[pd.DataFrame]:
    """The pairs of sorted lists, many lists at once; a list whose postings go on in the next batch waits for them."""
    key, rest = ["dim", "p1", "p2", "x", "y"], None
    for batch in batches:
        rows = batch if rest is None else pd.concat([rest, batch], ignore_index=True)
        if len(rows):
            last = (rows[key] == rows[key].iloc[-1]).all(axis=1).to_numpy()
            at = len(rows) - int(last[::-1].argmin()) if not last.all() else 0
            rest = rows.iloc[at:]
            yield pairs_of_lists(rows.iloc[:at])
    if rest is not None:
        yield pairs_of_lists(rest)


def pairs_of_lists(rows: pd.DataFrame) -> pd.DataFrame:
    """(a, b) of whole lists, each at most 2 * BLOCK postings, that share enough pivots and none rarer than the list's own two.

    Rows of a list follow each other, so the pairs of all lists come up by how far apart two rows are.
    """
    out = [np.zeros((0, 2), np.int64)]
    for _, part in rows.groupby("dim", sort=False):
        key = part[["p1", "p2", "x", "y"]].to_numpy()
        first = np.concatenate(([True], (key[1:] != key[:-1]).any(1)))
        starts = np.flatnonzero(first)
        sizes = np.diff(np.append(starts, len(part)))
        place, size = np.arange(len(part)) - np.repeat(starts, sizes), np.repeat(sizes, sizes)
        ids, block, p = part["vec_id"].to_numpy(), part["block"].to_numpy(), stack(part["p"]).astype(np.int64)
        rarer = np.cumsum(p == key[:, 1, None], axis=1) == 0
        two = key[:, 2] != key[:, 3]
        for step in range(1, int(sizes.max())):
            every = np.flatnonzero(place + step < size)
            for at in range(0, len(every), PAIRS_A_STEP):
                i = every[at : at + PAIRS_A_STEP]
                j = i + step
                same = (p[i][:, :, None] == p[j][:, None, :]).any(2)
                keep = (same.sum(1) >= min(SHARED, p.shape[1])) & ((block[i] != block[j]) | ~two[i])
                if p.shape[1] > 1:
                    keep &= (same & rarer[i]).sum(1) == 1
                out.append(np.stack([ids[i[keep]], ids[j[keep]]], 1))
    pairs = np.concatenate(out)
    return pd.DataFrame({"a": pairs[:, 0], "b": pairs[:, 1]})


def verified(pairs: DataFrame, vectors: DataFrame, linked: float) -> DataFrame:
    """The pairs (a, b) whose cosine reaches the limit."""
    x, y = vectors.select(F.col("vec_id").alias("a"), F.col("v").alias("x")), vectors.select(F.col("vec_id").alias("b"), F.col("v").alias("y"))

    def run(batches: Iterable[pd.DataFrame]) -> Iterable[pd.DataFrame]:
        for batch in batches:
            for _, part in batch.groupby(batch["x"].map(len)):
                yield part.loc[np.einsum("ij,ij->i", stack(part["x"]), stack(part["y"])) >= linked, ["a", "b"]]

    return pairs.join(x, "a").join(y, "b").select("a", "b", "x", "y").repartition("a", "b").mapInPandas(run, "a long, b long")


def near_duplicates(embeddings: DataFrame, linked: float = LINKED) -> DataFrame:
    """vec_id, n_links, component_id, kept and clump (null outside of clumps)."""
    every = cut(directions(embeddings))
    vectors = every.where("v is not null")
    number = 1 << int(np.ceil(np.log2(4 * np.sqrt(vectors.count() + 1))))
    rows = cut(described(vectors, choose_pivots(vectors, min(max(number, PIVOTS[0]), PIVOTS[1]))))
    angle = float(np.arccos(linked))
    centres = dense_spots(rows, angle / 2)
    rows = cut(with_clumps(rows, centres, angle / 2))
    key = ["dim", "clump"]
    members, single = rows.where("clump is not null"), rows.where("clump is null")
    clumps = cut(members.groupBy(*key).agg(F.count("*").alias("n"), F.min("vec_id").alias("least"), F.max("away").alias("away")))
    reach = cut(touched(rows, centres, clumps.toPandas(), angle))  # a row for each centre at most
    met = cut(compared(reach.where("not whole"), members, clumps, linked))
    links = cut(verified(candidates(single), single, linked))

    outside = reach.where("whole and own < 0").groupBy(*key).agg(F.count("*").alias("outside"))
    inside = clumps.join(outside, key, "left").select(*key, (F.col("n") - 1 + F.coalesce("outside", F.lit(0))).alias("n"))
    counts = members.select("vec_id", *key).join(inside, key).select("vec_id", "n")
    counts = counts.unionByName(reach.where("whole").join(clumps.select(*key, "n"), key).select("vec_id", "n"))
    counts = counts.unionByName(met.select(F.col("id").alias("vec_id"), "n"))
    counts = counts.unionByName(links.select(F.explode(F.array("a", "b")).alias("vec_id"), F.lit(1).cast("long").alias("n")))
    counts = counts.groupBy("vec_id").agg(F.sum("n").alias("n_links"))

    named = clumps.select(*key, "least")
    home = rows.select("vec_id", *key).join(named, key, "left").select("vec_id", F.coalesce("least", "vec_id").alias("node"), "clump")
    home = cut(home)
    into = reach.where("whole").select("vec_id", *key).unionByName(met.where("asks").select(F.col("id").alias("vec_id"), *key))
    edges = into.join(named, key).join(home, "vec_id").select(F.col("node").alias("a"), F.col("least").alias("b")).distinct().unionByName(links)
    found = home.join(components(edges).select("node", "root"), "node", "left").select("vec_id", F.coalesce("root", "node").alias("root"), "clump")
    out = every.select("vec_id").join(found, "vec_id", "left").join(counts, "vec_id", "left")
    component = F.coalesce("root", "vec_id")
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).alias("n_links"), component.alias("component_id"), (component == F.col("vec_id")).alias("kept"), "clump")


def op12_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return near_duplicates(table(spark, sf_dir, "embeddings")).drop("clump")


QUERIES = {"op12_embedding_dedup": op12_embedding_dedup}
ORACLE = {
    "op12_embedding_dedup": """
WITH RECURSIVE one AS (
  SELECT vec_id, min(CAST(embedding AS DOUBLE[])) AS v FROM embeddings WHERE vec_id IS NOT NULL GROUP BY 1
), good AS (
  SELECT vec_id, v, sqrt(list_inner_product(v, v)) AS norm FROM one
  WHERE v IS NOT NULL AND len(v) > 0 AND len(list_filter(v, lambda x: x IS NOT NULL AND isfinite(x))) = len(v) AND len(list_filter(v, lambda x: x <> 0)) > 0
), links AS MATERIALIZED (
  SELECT a.vec_id AS a, b.vec_id AS b FROM good a JOIN good b ON a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
  WHERE list_inner_product(a.v, b.v) / (a.norm * b.norm) >= 0.9
), reach AS (
  SELECT vec_id AS a, vec_id AS b FROM one
  UNION
  SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a
), roots AS (SELECT a AS vec_id, min(b) AS component_id FROM reach GROUP BY 1
), counts AS (SELECT a AS vec_id, count(*) AS n FROM links GROUP BY 1
)
SELECT r.vec_id, coalesce(n, 0) AS n_links, component_id, r.vec_id = component_id AS kept FROM roots r LEFT JOIN counts c ON r.vec_id = c.vec_id
"""
}
