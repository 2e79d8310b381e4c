"""N-gram Jaccard join: word-shingle sets of similarity 0.8 or more are linked, found with signature trees.

1. Each text becomes a set of shingle hashes; texts with equal sets form one class and are represented by one document.
2. Documents with the same minimum hash are checked against the smallest of them, so that most groups are known early.
3. Two sets with similarity s share a shingle among the first (1 - s) n + 1 of each, in any common order. The order is: shingles that
   are rare in a sample of the corpus by their hashes, then the frequent ones by their counts; a sample decides cost only, as any order
   gives every link. These prefixes, whole, meet by ranges of hashes; shingles known to be frequent skip that exchange. Only shingles
   of several early components go on, with the most that two sets that meet there first can have in common (what
   follows it in each).
4. Each shingle's documents are joined by signature trees: leaves hold documents ordered by size, each node the OR of token bitmaps and
   a size range; a dual traversal prunes pairs of nodes that can't hold enough overlap, or hold one component only. What is left
   is checked on the whole sets. A shingle of very many documents is split by size, and each size into blocks.

Defined results: null texts and texts without words have no set and no link (n_shingles 0, component their own id); rows
without doc_id keep a null component; repeated rows give repeated results; extra columns are not looked at. Shingles have 64-bit
hashes; sets are compared by 48 bits of them, and prefixes meet by 40 (what meets by chance is told apart by the sets).
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tractlake.llm.common import cut, from_planes, likely_in, planes, split_by, table, text_calls, tidy, unused
from tractlake.llm.components import components
from tractlake.llm.words import mix, shingle_sets

WIDTH, PERCENT = 5, 80
#: One document in so many shows which shingles are frequent (at least so often in the sample, at most so many shingles).
ORDER_SAMPLE, ORDER_LEAST, ORDER_TOKENS = 16, 4, 1 << 19
#: Bits of a bitmap: at least four a token, within these bounds.
LEAST_BITS, MOST_BITS = 256, 4096
#: Prefix shingles that one group of the exchange holds, and that a task gathers before it sends them.
TOKENS_A_BUCKET, TOKENS_A_BLOB = 400_000, 750_000
KEYS = 3
#: Larger prefix groups are split by size and into blocks, and pairs of blocks are joined; smaller ones share a task's group of about so many rows.
BLOCK, ROWS_A_HOME = 1000, 2000
#: Sizes of two steps apart, or more, are too far apart for a link.
SIZE_STEP = math.log(100 / PERCENT + 1e-4)
#: Bytes of a token where sets are compared, and where prefixes are.
SET_BYTES, PREFIX_BYTES = 6, 5
LEAF, FANOUT = 16, 8
#: Pairs of nodes that are compared at once.
PAIRS_A_STEP = 4096


def prefix_length(n: int, percent: int = PERCENT) -> int:
    """Tokens of a set of n that any set of at least that similarity must meet, in any order."""
    return n - -(-percent * n // 100) + 1


class Order:
    """The common order of tokens: those not in a bounded list of frequent ones by value, then the listed ones, rarer first."""

    def __init__(self, tokens: np.ndarray, counts: np.ndarray) -> None:
        by_value = np.argsort(tokens)
        self.tokens = tokens[by_value]
        rank = np.empty(len(tokens), np.int32)
        rank[np.lexsort((tokens, counts))] = np.arange(1, len(tokens) + 1)
        self.rank = rank[by_value]
        self.hint = np.zeros(1 << 22, bool)  # by leading bits
        self.hint[(tokens >> np.uint64(42)).astype(np.int64)] = True

    def ranks(self, tokens: np.ndarray) -> np.ndarray:
        """0 for tokens that aren't listed, else their place among the listed ones."""
        out = np.zeros(len(tokens), np.int32)
        near = np.flatnonzero(self.hint[(tokens >> np.uint64(42)).astype(np.int64)])
        at = np.minimum(np.searchsorted(self.tokens, tokens[near]), max(0, len(self.tokens) - 1))
        same = self.tokens[at] == tokens[near]
        out[near[same]] = self.rank[at[same]]
        return out


def prefix_of(tokens: np.ndarray, rank: np.ndarray, percent: int = PERCENT) -> tuple[np.ndarray, int]:
    """The first tokens of a set (sorted by value) in the common order, and how many of them, the last ones, are listed as frequent."""
    most = prefix_length(len(tokens), percent)
    if not rank.any():
        return tokens[:most], 0
    order = np.argsort(rank, kind="stable")[:most]
    return tokens[order], int((rank[order] > 0).sum())


def packed(tokens: np.ndarray, size: int) -> bytes:
    """The leading `size` bytes of each 64-bit token; their order stays the same."""
    return np.ascontiguousarray((tokens >> np.uint64(64 - 8 * size)).astype("<u8").view(np.uint8).reshape(-1, 8)[:, :size]).tobytes()


def unpacked(raw: bytes, size: int) -> np.ndarray:
    out = np.zeros((len(raw) // size, 8), np.uint8)
    out[:, :size] = np.frombuffer(raw, np.uint8).reshape(-1, size)
    return out.view("<u8").ravel()


def text_sets(docs: DataFrame, order: Order) -> DataFrame:
    """doc_id, n, the set's digest (h1, h2), its prefix (packed, in the common order), how many of it are frequent, a bitmap, and KEYS minimum hashes.

    Texts without words have n = 0.
    """
    shared = docs.sparkSession.sparkContext.broadcast(order)  # ORDER_TOKENS numbers at most

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for part in text_calls(list(zip(batch["doc_id"], batch["text"], strict=True))):
                with np.errstate(over="ignore"):
                    sets = shingle_sets([t for _, t in part], WIDTH)
                    every = np.concatenate(sets)
                    at, ranks = 0, shared.value.ranks(every)
                    for (doc, _), tokens in zip(part, sets, strict=True):
                        if not len(tokens):
                            rows.append((doc, 0, 0, 0, b"", 0, b"", []))
                            continue
                        h = [int(x.view(np.int64)) for x in (tokens.sum(dtype=np.uint64), mix(tokens ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64))]
                        keys = [int(mix(tokens + np.uint64(k) * np.uint64(0x9E3779B97F4A7C15)).min().view(np.int64)) for k in range(1, KEYS + 1)]
                        prefix, frequent = prefix_of(tokens, ranks[at : at + len(tokens)])
                        at += len(tokens)
                        rows.append((doc, len(tokens), *h, packed(prefix, PREFIX_BYTES), frequent, bitmap(tokens).tobytes(), keys))
            yield pd.DataFrame(rows, columns=["doc_id", "n", "h1", "h2", "prefix", "frequent", "bits", "keys"]).astype({"doc_id": "Int64"})

    rows = docs.select(F.col("doc_id").cast("long"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    return rows.mapInPandas(tidy(run), "doc_id long, n long, h1 long, h2 long, prefix binary, frequent long, bits binary, keys array<long>")


def common_order(docs: DataFrame) -> Order:
    """From the shingles that are frequent in every ORDER_SAMPLE-th document (by a hash of its id)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for part in text_calls([(0, t) for t in batch["text"]], 1 << 20):
                every, n = np.unique(np.concatenate(shingle_sets([t for _, t in part], WIDTH)), return_counts=True)
                yield pd.DataFrame({"token": every.view(np.int64), "n": n})

    sample = docs.where((F.pmod(F.xxhash64("doc_id"), F.lit(ORDER_SAMPLE)) == 0) & F.col("text").isNotNull()).select("text")
    found = sample.mapInPandas(run, "token long, n long").groupBy("token").agg(F.sum("n").alias("n")).where(F.col("n") >= ORDER_LEAST)
    rows = found.orderBy(F.desc("n"), "token").limit(ORDER_TOKENS).toPandas()
    return Order(rows["token"].to_numpy(np.int64).view(np.uint64), rows["n"].to_numpy(np.int64))


def met_in_exchange(heads: DataFrame, buckets: int) -> DataFrame:
    """What documents of several roots in heads(doc_id, root, n, prefix, frequent) have in common among their rare prefix tokens.

    Of a token of at most LEAF documents, which are one leaf, the pairs (a, b) whose sizes and reach allow a link; of others rows
    (token, doc_id, root, reach).
    """

    def send(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[tuple[int, int, int, bytes]] = []
        size = 0
        squeeze = zstandard.ZstdCompressor(level=1, write_checksum=False)

        def blobs() -> pd.DataFrame:
            tokens = unpacked(b"".join([p for *_, p in held]), PREFIX_BYTES)
            many = np.array([len(p) // PREFIX_BYTES for *_, p in held])
            docs, roots, sizes = (np.repeat(np.array([h[k] for h in held], np.int64), many) for k in range(3))
            reach = sizes - (np.arange(len(tokens)) - np.repeat(np.cumsum(many) - many, many))
            bucket = (tokens * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(40)) % np.uint64(buckets)
            order = np.argsort(bucket, kind="stable")
            ids, at = np.unique(bucket[order], return_index=True)
            rows = []
            for b, here in zip(ids.tolist(), np.split(order, at[1:]), strict=True):
                here = here[np.argsort(tokens[here])]
                blob = b"".join((planes(tokens[here], PREFIX_BYTES), planes(docs[here], 8), planes(docs[here] - roots[here], 8), planes(reach[here], 4), planes(sizes[here] - reach[here], 4)))
                rows.append((b, len(here), squeeze.compress(blob)))
            return pd.DataFrame(rows, columns=["bucket", "n", "blob"])

        for batch in batches:
            for doc, root, n, prefix, frequent in zip(*(batch[c].tolist() for c in ("doc_id", "root", "n", "prefix", "frequent")), strict=True):
                rare = prefix[: len(prefix) - PREFIX_BYTES * frequent]
                held.append((doc, root, n, rare))
                size += len(rare) // PREFIX_BYTES
                if size >= TOKENS_A_BLOB:
                    yield blobs()
                    held, size = [], 0
        if size:
            yield blobs()

    def meet(group: pd.DataFrame) -> pd.DataFrame:
        expand = zstandard.ZstdDecompressor()
        tokens, docs, roots, reach, before = [], [], [], [], []
        for n, blob in zip(group["n"].tolist(), group["blob"], strict=True):
            raw, at = expand.decompress(blob), 0
            for out, width in ((tokens, PREFIX_BYTES), (docs, 8), (roots, 8), (reach, 4), (before, 4)):
                out.append(from_planes(raw[at : at + width * n], width, n))
                at += width * n
        tokens, docs, reach, before = np.concatenate(tokens), *(np.concatenate(x).view(np.int64) for x in (docs, reach, before))
        roots = docs - np.concatenate(roots).view(np.int64)
        order = np.argsort(tokens, kind="stable")
        first = np.flatnonzero(np.concatenate(([True], tokens[order][1:] != tokens[order][:-1])))
        several = np.minimum.reduceat(roots[order], first) < np.maximum.reduceat(roots[order], first)
        many = np.diff(np.append(first, len(order)))
        few = np.repeat(several & (many <= LEAF), many)
        on = order[few]
        a, b = leaf_pairs(tokens[on], docs[on], roots[on], reach[on] + before[on], reach[on])
        found = pd.DataFrame({"a": a, "b": b})
        on = order[np.repeat(several, many) & ~few]
        return pd.concat([found, pd.DataFrame({"token": tokens[on].view(np.int64), "doc_id": docs[on], "root": roots[on], "reach": reach[on]})]).astype("Int64")

    sent = heads.select("doc_id", "root", "n", "prefix", "frequent").mapInPandas(tidy(send), "bucket long, n long, blob binary")
    return sent.groupBy("bucket").applyInPandas(meet, "a long, b long, token long, doc_id long, root long, reach long")


def leaf_pairs(tokens: np.ndarray, docs: np.ndarray, roots: np.ndarray, sizes: np.ndarray, reach: np.ndarray, percent: int = PERCENT) -> tuple[np.ndarray, np.ndarray]:
    """The distinct pairs of documents, smaller first, of different roots that have the same token (sorted) at places that allow a link."""
    found = []
    for step in range(1, LEAF):
        i = np.flatnonzero(tokens[step:] == tokens[:-step])
        if not len(i):
            break
        j = i + step
        fits = (roots[i] != roots[j]) & (100 * np.minimum(sizes[i], sizes[j]) >= percent * np.maximum(sizes[i], sizes[j]))
        fits &= (100 + percent) * np.minimum(reach[i], reach[j]) >= percent * (sizes[i] + sizes[j])
        found.append(np.sort(np.stack([docs[i[fits]], docs[j[fits]]], 1), axis=1))
    pairs = np.unique(np.concatenate(found), axis=0) if found else np.zeros((0, 2), np.int64)
    return pairs[:, 0], pairs[:, 1]


def frequent_rows(heads: DataFrame) -> DataFrame:
    """(token, doc_id, root, reach) for the frequent prefix tokens of heads."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            tokens = [unpacked(p[len(p) - PREFIX_BYTES * f :], PREFIX_BYTES) for p, f in zip(batch["prefix"], batch["frequent"].tolist(), strict=True)]
            last = (batch["n"] - batch["prefix"].map(len) // PREFIX_BYTES + batch["frequent"]).to_numpy()
            many = batch["frequent"].to_numpy()
            reach = [top - np.arange(k) for top, k in zip(last.tolist(), many.tolist(), strict=True)]
            if len(batch):
                yield pd.DataFrame({"token": np.concatenate(tokens).view(np.int64), "doc_id": np.repeat(batch["doc_id"].to_numpy(), many), "root": np.repeat(batch["root"].to_numpy(), many), "reach": np.concatenate(reach)})

    return heads.where("frequent > 0").select("doc_id", "root", "n", "prefix", "frequent").mapInPandas(run, "token long, doc_id long, root long, reach long")


def whole_sets(docs: DataFrame, pairs: DataFrame) -> DataFrame:
    """doc_id and tokens (packed) of the documents in pairs(a, b), and of a few others that a filter can't tell from them."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for part in text_calls(list(zip(batch["doc_id"], batch["text"], strict=True))):
                sets = shingle_sets([t for _, t in part], WIDTH)
                yield pd.DataFrame({"doc_id": [d for d, _ in part], "tokens": [packed(x, SET_BYTES) for x in sets]})

    rows = docs.where(F.col("text").isNotNull()).select(F.col("doc_id").cast("long"), "text")
    return likely_in(rows, pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct(), run, "doc_id long, tokens binary")


def bitmap(tokens: np.ndarray) -> np.ndarray:
    """64-bit words of a bitmap whose width is a power of two."""
    width = min(MOST_BITS, max(LEAST_BITS, 1 << int(4 * len(tokens) - 1).bit_length()))
    out = np.zeros(width, np.uint8)
    out[(tokens >> np.uint64(8)).astype(np.int64) & (width - 1)] = 1
    return np.packbits(out).view(np.uint64)


def folded(bits: list[np.ndarray]) -> np.ndarray:
    """All bitmaps at the width of the narrowest."""
    width = min(map(len, bits))
    return np.stack([np.bitwise_or.reduce(b.reshape(-1, width), axis=0) for b in bits])


def tree_pairs(sizes: np.ndarray, bits: np.ndarray, groups: np.ndarray, sides: np.ndarray | None = None, percent: int = PERCENT, reach: np.ndarray | None = None) -> list[tuple[int, int]]:
    """Pairs of different groups (and different sides, if given) that may reach the similarity.

    An overlap is at most the common bits plus, for either set, the tokens beyond one a bit, and at most the reach of either set. A
    link needs (100 + percent) * overlap >= percent * (sum of the sizes).
    """
    order = np.lexsort((groups, sizes))
    reach = sizes[order] if reach is None else reach[order]
    sizes, bits, groups = sizes[order], bits[order], groups[order]
    sides = None if sides is None else sides[order]
    spare = sizes - np.bitwise_count(bits).sum(1).astype(np.int64)
    levels = []
    at = np.arange(0, len(sizes), LEAF)
    node = {"bits": np.bitwise_or.reduceat(bits, at), "low": np.minimum.reduceat(sizes, at), "high": np.maximum.reduceat(sizes, at), "spare": np.maximum.reduceat(spare, at), "reach": np.maximum.reduceat(reach, at), "first": np.minimum.reduceat(groups, at), "last": np.maximum.reduceat(groups, at)}
    levels.append(node)
    while len(levels[-1]["low"]) > 1:
        below = levels[-1]
        at = np.arange(0, len(below["low"]), FANOUT)
        levels.append({"bits": np.bitwise_or.reduceat(below["bits"], at)} | {k: f.reduceat(below[k], at) for k, f in (("low", np.minimum), ("high", np.maximum), ("spare", np.maximum), ("reach", np.maximum), ("first", np.minimum), ("last", np.maximum))})

    def possible(level: dict, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        fits = (100 * level["high"][i] >= percent * level["low"][j]) & (100 * level["high"][j] >= percent * level["low"][i])
        fits &= (level["first"][i] != level["last"][j]) | (level["last"][i] != level["first"][j])
        fits = np.flatnonzero(fits)
        out = np.zeros(len(i), bool)
        for part in range(0, len(fits), PAIRS_A_STEP):
            on = fits[part : part + PAIRS_A_STEP]
            a, b = i[on], j[on]
            common = np.bitwise_count(level["bits"][a] & level["bits"][b]).sum(1).astype(np.int64) + np.minimum(level["spare"][a], level["spare"][b])
            common = np.minimum(common, np.minimum(level["reach"][a], level["reach"][b]))
            out[on] = (100 + percent) * common >= percent * (level["low"][a] + level["low"][b])
        return out

    def opened(i: np.ndarray, j: np.ndarray, fan: int, n: int) -> tuple[np.ndarray, np.ndarray]:
        a = (i[:, None, None] * fan + np.arange(fan)[None, :, None] + np.zeros((1, 1, fan), np.int64)).ravel()
        b = (j[:, None, None] * fan + np.arange(fan)[None, None, :] + np.zeros((1, fan, 1), np.int64)).ravel()
        same = np.repeat(i == j, fan * fan)
        ok = (a < n) & (b < n) & (~same | (a <= b))
        return a[ok], b[ok]

    i = j = np.zeros(1, np.int64)
    for depth in range(len(levels) - 1, 0, -1):
        ok = possible(levels[depth], i, j)
        i, j = opened(i[ok], j[ok], FANOUT, len(levels[depth - 1]["low"]))
    ok = possible(levels[0], i, j)
    i, j = i[ok], j[ok]
    found: list[tuple[int, int]] = []
    single = {"bits": bits, "low": sizes, "high": sizes, "spare": spare, "reach": reach, "first": groups, "last": groups}
    for part in range(0, len(i), 2048):
        a, b = opened(i[part : part + 2048], j[part : part + 2048], LEAF, len(sizes))
        apart = (a != b) & (groups[a] != groups[b])
        if sides is not None:
            apart &= sides[a] != sides[b]
        a, b = a[apart], b[apart]
        ok = possible(single, a, b)
        found += zip(order[a[ok]].tolist(), order[b[ok]].tolist(), strict=True)
    return found


def plausible(pairs: DataFrame, marks: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The rows of pairs(a, b) that the bitmaps of marks(doc_id, n, bits) don't rule out."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            keep = []
            for n, m, x, y in zip(batch["n"].tolist(), batch["m"].tolist(), batch["x"], batch["y"], strict=True):
                both = folded([np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)])
                spare = min(k - int(np.bitwise_count(b).sum()) for k, b in zip((n, m), both, strict=True))
                common = min(n, m, int(np.bitwise_count(both[0] & both[1]).sum()) + spare)
                keep.append((100 + percent) * common >= percent * (n + m))
            yield batch.loc[np.array(keep, dtype=bool), ["a", "b"]]

    left = marks.select(F.col("doc_id").alias("a"), "n", F.col("bits").alias("x"))
    right = marks.select(F.col("doc_id").alias("b"), F.col("n").alias("m"), F.col("bits").alias("y"))
    return pairs.join(left, "a").join(right, "b").mapInPandas(tidy(run), "a long, b long")


def checked(pairs: DataFrame, sets: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The rows of pairs(a, b) whose whole sets reach the similarity."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            keep = []
            for x, y in zip(batch["x"], batch["y"], strict=True):
                s, t = unpacked(x, SET_BYTES), unpacked(y, SET_BYTES)
                common = 0
                if 100 * min(len(s), len(t)) >= percent * max(len(s), len(t)):
                    at = np.minimum(np.searchsorted(t, s), len(t) - 1)
                    common = int((t[at] == s).sum())
                keep.append(100 * common >= percent * (len(s) + len(t) - common))
            yield batch.loc[np.array(keep, dtype=bool), ["a", "b"]]

    left = sets.select(F.col("doc_id").alias("a"), F.col("tokens").alias("x"))
    right = sets.select(F.col("doc_id").alias("b"), F.col("tokens").alias("y"))
    return pairs.join(left, "a").join(right, "b").select("a", "b", "x", "y").mapInPandas(tidy(run), "a long, b long")


def group_pairs(rows: DataFrame, marks: DataFrame) -> DataFrame:
    """Candidate pairs (a, b) from rows(token, doc_id, root, reach) and marks(doc_id, n, bits) by signature trees, one for each token or pair of blocks."""
    rows = cut(rows)
    sized = cut(rows.groupBy("token").agg(F.count("*").alias("members"), F.min("root").alias("low"), F.max("root").alias("high")).where("low < high"))
    homes = max(16, -(-int(sized.agg(F.coalesce(F.sum("members"), F.lit(0))).first()[0]) // ROWS_A_HOME))
    placed = rows.join(sized.select("token", "members"), "token").join(marks, "doc_id")
    small = placed.where(F.col("members") <= BLOCK).select("token", "doc_id", "n", "bits", "root", "reach", F.lit(-1).alias("band"), F.lit(0).alias("own"), F.lit(0).alias("i"), F.lit(0).alias("j"), F.pmod(F.xxhash64("token"), F.lit(homes)).alias("home"))
    step = F.floor(F.log(F.col("n")) / SIZE_STEP).cast("int")
    large = placed.where(F.col("members") > BLOCK).withColumn("band", F.explode(F.array(step, step - 1)))
    bands = cut(rows.join(sized.where(F.col("members") > BLOCK).select("token"), "token").join(marks.select("doc_id", "n"), "doc_id").withColumn("band", F.explode(F.array(step, step - 1))).groupBy("token", "band").agg(F.count("*").alias("many")))
    large = large.join(bands, ["token", "band"]).withColumn("blocks", F.ceil(F.col("many") / BLOCK).cast("int"))
    large = large.withColumn("own", F.pmod(F.xxhash64("doc_id"), F.col("blocks").cast("long")).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    large = large.select("token", "doc_id", "n", "bits", "root", "reach", "band", "own", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j")).withColumn("home", F.xxhash64("token", "band", "i", "j"))

    def run(group: pd.DataFrame) -> pd.DataFrame:
        found: set[tuple[int, int]] = set()
        for (_, _, i, j), part in group.groupby(["token", "band", "i", "j"], sort=False):
            docs, roots = part["doc_id"].to_numpy(), part["root"].to_numpy()
            if len(docs) < 2 or (roots == roots[0]).all():
                continue
            bits = folded([np.frombuffer(b, np.uint64) for b in part["bits"]])
            sides = None if i == j else part["own"].to_numpy()
            found.update((int(min(docs[a], docs[b])), int(max(docs[a], docs[b]))) for a, b in tree_pairs(part["n"].to_numpy(), bits, roots, sides, reach=part["reach"].to_numpy()))
        return pd.DataFrame(sorted(found), columns=["a", "b"], dtype="int64")

    return small.unionByName(large).groupBy("home").applyInPandas(run, "a long, b long").distinct()


def spanning_links(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(doc_id, n, head) of every row with an id, head being the document that stands for its set; links (a, b) between heads, enough of
    them to connect whatever links connect (inside a group that is known to hang together no more are looked for)."""
    rows = docs.select("doc_id", "text").where(F.col("doc_id").isNotNull())
    sets = cut(text_sets(rows, common_order(rows)))
    heads = cut(sets.where("n > 0").groupBy("n", "h1", "h2").agg(F.min("doc_id").alias("head")))
    members = sets.join(heads, ["n", "h1", "h2"], "left").select("doc_id", "n", F.coalesce("head", "doc_id").alias("head"))
    own = cut(sets.join(heads.select("n", "h1", "h2", F.col("head").alias("doc_id")), ["n", "h1", "h2", "doc_id"], "left_semi").dropDuplicates(["doc_id"]).drop("h1", "h2"))
    marks = own.select("doc_id", "n", "bits")
    keyed = own.select("doc_id", F.posexplode("keys").alias("k", "key"))
    centres = cut(keyed.groupBy("k", "key").agg(F.min("doc_id").alias("a"), F.count("*").alias("many")).where("many > 1").drop("many"))
    stars = keyed.join(centres, ["k", "key"]).where("a <> doc_id").select("a", F.col("doc_id").alias("b")).distinct()
    stars = cut(plausible(stars, marks))
    early = cut(checked(stars, whole_sets(rows, stars)))
    roots = components(early)
    placed = own.join(roots.withColumnRenamed("node", "doc_id"), "doc_id", "left").select("doc_id", "n", "prefix", "frequent", F.coalesce("root", "doc_id").alias("root"))
    total = own.agg(F.coalesce(F.sum(F.length("prefix") / PREFIX_BYTES - F.col("frequent")), F.lit(0))).first()[0]
    met = cut(met_in_exchange(placed, max(1, -(-int(total) // TOKENS_A_BUCKET))))
    single = plausible(met.where("a is not null").select("a", "b").distinct(), marks)
    grouped = group_pairs(met.where("token is not null").select("token", "doc_id", "root", "reach").unionByName(frequent_rows(placed)), marks)
    later = cut(single.unionByName(grouped).distinct())
    late = cut(checked(later, whole_sets(rows, later)))
    return members, early.unionByName(late)


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles and component_id of each row of docs(doc_id, text)."""
    members, links = spanning_links(docs)
    roots = components(links)
    joined = members.join(roots.withColumnRenamed("node", "head"), "head", "left").select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("root", "head").alias("component_id"))
    without = docs.where(F.col("doc_id").isNull()).select(F.col("doc_id").cast("long"), "text")
    if without.limit(1).count():
        joined = joined.unionByName(text_sets(without, Order(np.zeros(0, np.uint64), np.zeros(0, np.int64))).select("doc_id", F.col("n").alias("n_shingles"), F.lit(None).cast("long").alias("component_id")))
    return joined


def keep_one(docs: DataFrame) -> DataFrame:
    """The rows of docs, all columns, that stand for their component: those of its smallest doc_id, once each.

    Rows without doc_id stay.
    """
    others = cut(near_duplicates(docs).where(F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.max("component_id").alias("head"), F.count("*").alias("n")).where("doc_id <> head or n > 1"))
    (maybe,) = unused(docs, "maybe")
    tested = split_by(docs, others.select("doc_id"), maybe)
    doubted = tested.where(F.col(maybe)).join(others.where("doc_id <> head").select("doc_id"), "doc_id", "left_anti").select(*tested.columns)
    once = doubted.where(F.col("doc_id").isNotNull()).dropDuplicates(["doc_id"]).unionByName(doubted.where(F.col("doc_id").isNull()))
    return tested.where(~F.col(maybe)).unionByName(once).select(*docs.columns)


def op6_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


QUERIES = {"op6_jaccard": op6_jaccard}
ORACLE = {
    "op6_jaccard": """
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS ws FROM documents
), s AS (
  SELECT doc_id, CASE WHEN len(ws) >= 5 THEN list_distinct(list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' ')))
    WHEN len(ws) > 0 THEN [array_to_string(ws, ' ')] ELSE [] END AS sh FROM w
), sets AS (SELECT min(doc_id) AS head, list_sort(sh) AS sh, len(sh) AS n FROM s GROUP BY 2, 3 HAVING len(list_sort(sh)) > 0
), t AS (SELECT head, n, unnest(sh) AS g FROM sets
), c AS (SELECT a.head AS a, b.head AS b, a.n AS na, b.n AS nb, count(*) AS o FROM t a JOIN t b ON a.g = b.g AND a.head < b.head GROUP BY ALL
), e AS (SELECT a, b FROM c WHERE 100 * o >= 80 * (na + nb - o)
), both_ways AS (SELECT a, b FROM e UNION ALL SELECT b, a FROM e
), r AS (SELECT head AS x, head AS y FROM sets UNION SELECT r.x, both_ways.b FROM r JOIN both_ways ON r.y = both_ways.a
), m AS (SELECT x, min(y) AS root FROM r GROUP BY x)
SELECT s.doc_id, CAST(len(s.sh) AS BIGINT) AS n_shingles, coalesce(m.root, s.doc_id) AS component_id
FROM s LEFT JOIN sets ON list_sort(s.sh) = sets.sh LEFT JOIN m ON m.x = sets.head
"""
}
