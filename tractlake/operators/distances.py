"""How many pairs lie at each Manhattan distance, without making the pairs.

Points with whole coordinates are dealt into bands along x, and each band into tiles along y. Where two tiles lie apart on both axes, the distance is a
difference of sums (or differences) of coordinates, so the counts of all their pairs are one correlation of two histograms, by FFT and rounded
to whole numbers. Only tiles that share a band or a row meet pair by pair. Work and memory of a task follow its two bands.
"""

from __future__ import annotations


import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tractlake.operators.keeping import cut

#: Pairs that cost about as much one by one as the correlation of two bands, points of a band, pairs that are held at once,
#: and the most pairs (by weight) whose counts are exact after rounding.
WORTH, HELD, AT_ONCE, EXACT = 60_000_000, 250_000, 1 << 21, 1 << 43
#: Where points count what lies within reach: points and targets of one task.
LOOKING, SEEN = 100_000, 250_000


def _direct(o: np.ndarray, s: np.ndarray, allowed: np.ndarray, into: np.ndarray) -> None:
    """Adds the pairs of columns x, y, kind, weight one by one."""
    for kind in np.unique(o[2]):
        mine, theirs = o[:, o[2] == kind], s[:, allowed[kind, s[2]]]
        step = max(1, AT_ONCE // max(1, theirs.shape[1]))
        plain = theirs[3].max(initial=1) == 1 and mine[3].max(initial=1) == 1
        for a in range(0, mine.shape[1] if theirs.shape[1] else 0, step):
            x, y, _, w = (c[a : a + step, None] for c in mine)
            d = (np.abs(x - theirs[0]) + np.abs(y - theirs[1])).ravel()
            into += np.bincount(d, None if plain else (w * theirs[3]).ravel(), len(into)).astype(np.int64)


def _spectra(p: np.ndarray, along: np.ndarray, tile: np.ndarray, kinds: int, tiles: int, length: int) -> np.ndarray:
    """The transformed histograms of a coordinate by kind and tile."""
    flat = (p[2] * tiles + tile) * length + along
    return np.fft.rfft(np.bincount(flat, p[3], kinds * tiles * length).reshape(kinds, tiles, length))


def band_counts(o: np.ndarray, s: np.ndarray, width: int, gap: int, tiles: int, allowed: np.ndarray, size: int) -> np.ndarray:
    """Pairs by distance of two bands; o and s hold x (from the left edge of the own band), y, kind and weight, the band of s begins gap to the right (negative: left)."""
    out = np.zeros(size, np.int64)
    there = s.copy()
    there[0] += gap
    if gap == 0 or o.shape[1] * s.shape[1] <= WORTH // 4 or float(o[3].sum()) * float(s[3].sum()) > EXACT:
        _direct(o, there, allowed, out)
        return out
    to, ts = o[1] // width, s[1] // width
    for k in np.unique(to):
        _direct(o[:, to == k], there[:, ts == k], allowed, out)
    if gap < 0:  # mirrored, so that s lies to the right
        o, s = o.copy(), s.copy()
        o[0], s[0] = width - 1 - o[0], width - 1 - s[0]
        gap = -gap
    kinds, length = allowed.shape, 1 << (4 * width - 3).bit_length()
    lags = np.arange(-(2 * width - 2), 2 * width - 1)
    for up in (True, False):
        yo, ys = (p[1] - t * width if up else width - 1 - (p[1] - t * width) for p, t in ((o, to), (s, ts)))
        mine = _spectra(o, o[0] + yo, to, kinds[0], tiles, length).conj()
        theirs = np.tensordot(allowed.astype(float), _spectra(s, s[0] + ys, ts, kinds[1], tiles, length), 1)
        for e in range(1, tiles):
            a, b = (mine[:, : tiles - e], theirs[:, e:]) if up else (mine[:, e:], theirs[:, : tiles - e])
            found = np.rint(np.fft.irfft(np.einsum("ktf,ktf->f", a, b), length)).astype(np.int64)[lags]
            at = lags + gap + e * width
            keep = (found != 0) & (at >= 0) & (at < size)
            out[at[keep]] += found[keep]
    return out


def distance_counts(origins: DataFrame, sites: DataFrame, kinds: tuple[int, int], barred: list[tuple[int, int]]) -> DataFrame:
    """part, distance and pairs: how many pairs of origins(x, y, kind, part) and sites(x, y, kind) lie at each Manhattan distance, in each part of the origins.

    Coordinates are whole numbers; kinds count from 0, as many as `kinds` says of origins and of sites, and barred pairs of kinds don't count.
    Points without coordinates don't count either. Nothing is sampled; rows that are alike travel once, with their number.
    """
    number = lambda c: F.col(c).cast("long").alias(c)
    o = origins.where("x is not null and y is not null").groupBy(number("part"), number("x"), number("y"), number("kind")).agg(F.count("*").alias("weight"))
    s = sites.where("x is not null and y is not null").groupBy(number("x"), number("y"), number("kind")).agg(F.count("*").alias("weight"))
    ends = [f(c).alias(n + c) for c in ("x", "y") for n, f in (("a", F.min), ("z", F.max))]
    both = o.agg(F.count("*").alias("n"), F.count_distinct("part").alias("parts"), *ends).unionByName(s.agg(F.count("*").alias("n"), F.lit(1).cast("long").alias("parts"), *ends)).collect()  # two rows
    if any(r["n"] == 0 for r in both):
        return o.select("part", F.lit(0).cast("long").alias("distance"), F.col("weight").alias("pairs")).limit(0)
    x0, y0 = min(r["ax"] for r in both), min(r["ay"] for r in both)
    wide, high = max(r["zx"] for r in both) - x0 + 1, max(r["zy"] for r in both) - y0 + 1
    pairs = both[0]["n"] * both[1]["n"] // both[0]["parts"]
    bands = max(1, round((pairs / WORTH) ** (1 / 3)), -(-max(r["n"] for r in both) // HELD))  # as many as balance both kinds of work
    width = -(-wide // bands)
    bands, tiles, size = -(-wide // width), -(-high // width), wide + high
    allowed = np.ones(kinds, bool)
    for a, b in barred:
        allowed[a, b] = False
    all_bands, mine = F.sequence(F.lit(0), F.lit(bands - 1)), F.floor((F.col("x") - x0) / width).cast("int")
    placed = [(F.col("x") - x0 - mine * width).alias("x"), (F.col("y") - y0).alias("y"), "kind", "weight"]
    parts = o.select(F.col("part").alias("of")).distinct()  # as few as the parts of the result
    left = o.select("part", mine.alias("a"), *placed).withColumn("b", F.explode(all_bands))
    right = s.select(mine.alias("b"), *placed).withColumn("a", F.explode(all_bands)).crossJoin(parts).withColumnRenamed("of", "part")

    def count(key: tuple, a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        found = np.zeros(0, np.int64)
        if len(a) and len(b):
            found = band_counts(*(t[["x", "y", "kind", "weight"]].to_numpy(np.int64).T for t in (a, b)), width, (int(key[2]) - int(key[1])) * width, tiles, allowed, size)
        at = np.flatnonzero(found)
        return pd.DataFrame({"part": key[0], "distance": at, "pairs": found[at]})

    key = ["part", "a", "b"]
    each = left.groupBy(*key).cogroup(right.groupBy(*key)).applyInPandas(count, "part long, distance long, pairs long")
    return each.groupBy("part", "distance").agg(F.sum("pairs").alias("pairs"))


class Ranks:
    """Of ranks in a row, how many in a stretch of it are below a limit, for many stretches at once: a wavelet matrix, a bit of the ranks a level."""

    def __init__(self, ranks: np.ndarray) -> None:
        self.levels = []
        for bit in range(len(ranks).bit_length() - 1, -1, -1):
            high = (ranks >> bit) & 1 == 1
            self.levels.append((bit, np.concatenate([[0], np.cumsum(~high)])))
            ranks = np.concatenate([ranks[~high], ranks[high]])

    def below(self, a: np.ndarray, z: np.ndarray, limit: np.ndarray) -> np.ndarray:
        """In places a to z, z excluded; a limit is at most the number of ranks."""
        found = np.zeros(len(a), np.int64)
        for bit, low in self.levels:
            la, lz, high = low[a], low[z], (limit >> bit) & 1 == 1
            found += np.where(high, lz - la, 0)
            a, z = np.where(high, low[-1] + a - la, la), np.where(high, low[-1] + z - lz, lz)
        return found


def counts_in_diamonds(points: np.ndarray, targets: np.ndarray, radii: list[int]) -> np.ndarray:
    """For each of points (x, y) and each radius how many targets (x, y) are at most so far away, by Manhattan distance: turned by 45 degrees, a diamond is a square."""
    u, v = targets[0] + targets[1], targets[0] - targets[1]
    order = np.argsort(u, kind="stable")
    u, v = u[order], v[order]
    by_v = np.argsort(v, kind="stable")
    ranks = np.empty(len(v), np.int64)
    ranks[by_v] = np.arange(len(v))
    tree, high = Ranks(ranks), v[by_v]
    pu, pv, out = points[0] + points[1], points[0] - points[1], np.zeros((len(radii), points.shape[1]), np.int64)
    for k, r in enumerate(radii):
        a, z = np.searchsorted(u, pu - r, "left"), np.searchsorted(u, pu + r, "right")
        if r >= 0:
            out[k] = tree.below(a, z, np.searchsorted(high, pv + r, "right")) - tree.below(a, z, np.searchsorted(high, pv - r, "left"))
    return out


def counts_within_reach(points: DataFrame, targets: DataFrame, key: str, radii: list[int]) -> DataFrame:
    """key and n, an array: how many targets(x, y, kind) lie within each radius of the points(key, x, y, barred) of a key, but for those whose kind is the point's barred one.

    Coordinates are whole numbers, distances Manhattan. No pair is listed: targets are dealt to bands of even size across one diagonal, large ones to several
    parts, and each point meets the bands that its largest radius runs into. Tasks hold so many points and targets at most.
    """
    number = lambda c: F.col(c).cast("long").alias(c)
    kind = lambda c: F.coalesce(F.col(c).cast("long"), F.lit(-1 if c == "kind" else -2).cast("long")).alias(c)
    p = points.where("x is not null and y is not null").select(key, number("x"), number("y"), kind("barred"))
    t = targets.where("x is not null and y is not null").select(number("x"), number("y"), kind("kind"))
    n, m, widest, u = p.count(), t.count(), max(radii), F.col("x") + F.col("y")
    if not n or not m or widest < 0:
        return points.select(key, F.array_repeat(F.lit(0).cast("long"), len(radii)).alias("n")).limit(0)
    bands = -(-m // SEEN)
    edges = sorted(set(t.agg(F.percentile_approx(u, [k / bands for k in range(1, bands)], 100 * bands)).first()[0])) if bands > 1 else []  # a number for each band
    band = lambda c: sum((c > e).cast("int") for e in edges) if len(edges) < 50 else F.size(F.filter(F.array(*map(F.lit, edges)), lambda e: e < c))
    band_of = band if edges else lambda c: F.lit(0)
    t = t.withColumn("band", band_of(u))
    sizes = {r["band"]: r["n"] for r in t.groupBy("band").agg(F.count("*").alias("n")).collect()}  # as few as the bands
    slots = 1 + n // LOOKING
    parts = F.element_at(F.create_map(*[F.lit(x) for b, size in sizes.items() for x in (b, -(-size // SEEN))]), F.col("band"))
    t = t.withColumn("part", F.pmod(F.xxhash64("x", "y", F.monotonically_increasing_id()), parts)).withColumn("slot", F.explode(F.sequence(F.lit(0), F.lit(slots - 1))))
    p = p.withColumn("slot", F.pmod(F.xxhash64(key, "x", "y"), F.lit(slots)).cast("int")).withColumn("band", F.explode(F.sequence(band_of(u - widest), band_of(u + widest))))
    p = p.where(F.col("band").isin(list(sizes))).withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), parts.cast("long") - 1)))

    def run(own: pd.DataFrame, other: pd.DataFrame) -> pd.DataFrame:
        at, there = own[["x", "y"]].to_numpy(np.int64).T, other[["x", "y"]].to_numpy(np.int64).T
        out, barred, kinds = counts_in_diamonds(at, there, radii), own["barred"].to_numpy(), other["kind"].to_numpy()
        for k in np.intersect1d(barred, kinds):
            out[:, barred == k] -= counts_in_diamonds(at[:, barred == k], there[:, kinds == k], radii)
        return pd.DataFrame({key: own[key]} | {f"n{k}": c for k, c in enumerate(out)})

    kept = ", ".join([f"{key} {points.schema[key].dataType.simpleString()}", *[f"n{k} long" for k in range(len(radii))]])
    by = ["band", "part", "slot"]
    each = p.groupBy(*by).cogroup(t.groupBy(*by)).applyInPandas(run, kept)
    return each.groupBy(key).agg(F.array(*[F.sum(f"n{k}") for k in range(len(radii))]).alias("n"))


def counted_matrix(origins: DataFrame, sites: DataFrame, kinds: tuple[int, int], barred: list[tuple[int, int]]) -> DataFrame:
    """part, distance and pairs, as distance_counts gives them, and with a null distance the number of pairs in each part that have none: every pair of
    origins and sites is counted in one row. Kept, as all summaries of a matrix start from these few rows."""
    counts = distance_counts(origins, sites, kinds, barred)
    expected = origins.groupBy(F.col("part").cast("long").alias("part")).agg(F.count("*").alias("n")).join(sites.agg(F.count("*").alias("m")))  # one row
    counts = cut(counts)
    rest = expected.join(counts.groupBy("part").agg(F.sum("pairs").alias("found")), "part", "left")
    none = rest.select("part", F.lit(None).cast("long").alias("distance"), (F.col("n") * F.col("m") - F.coalesce("found", F.lit(0))).alias("pairs")).where("pairs > 0")
    return counts.unionByName(none)


def key_counts(origins: DataFrame, sites: DataFrame) -> DataFrame:
    """One row on the pairs of origin_id and site_id: keys, how many there are, and repeated, how many of them stand more than once."""
    side = lambda t, k, a: t.groupBy(k).agg(F.count("*").alias("n")).agg(F.count("*").alias(a), F.count_if(F.col("n") == 1).alias(f"{a}_once"))
    both = side(origins, "origin_id", "o").join(side(sites, "site_id", "s"))  # one row each
    return both.select((F.col("o") * F.col("s")).alias("keys"), (F.col("o") * F.col("s") - F.col("o_once") * F.col("s_once")).alias("repeated"))


def pairs_where(condition: Column | None = None) -> Column:
    """An aggregate over such rows: how many pairs fulfil a condition."""
    n = F.col("pairs") if condition is None else F.when(condition, F.col("pairs"))
    return F.coalesce(F.sum(n), F.lit(0).cast("long"))
