"""Prefix trie of conversations, built from burst tries.

A turn's id is a hash of its role and text; a conversation is the sequence of its turn ids. Sequences are parted into pieces of STRIDE turns, and
a shard holds the pieces that follow one common beginning, so that the longest conversation is many rows, never one.

1. A shard starts as one container of suffixes, here the distinct pieces with how many conversations have each. Containers of more than
   `most` pieces burst: their pieces go to new containers by the next turn id, and the old container becomes a trie head. Equal conversations
   are one piece and never make a container large; STRIDE rounds suffice for any data.
2. What remains is sorted inside its container and swept once: a stack of open nodes follows the common prefix of neighbours and closes each node with
   the counts of its subtree.
3. Trie heads add up the containers under them, deepest heads first. A later shard's counts reach the pieces before it as sums by
   conversation: each node and each leaf is credited to its smallest member once.

Places inside a conversation come from a sort of all turns by ranges, and lists of ends are hashed chunk by chunk, so neither a conversation
nor a node that holds a third of all rows has to fit in one task.

Defined results: rows without conv_id take no part; null role or text is empty; turns are ordered by turn, null first, equal turns by role and then by
turn id; repeated rows are turns of their own; an empty table gives no rows, not even a root; extra columns are not looked at. Turn ids and the
ids of common beginnings have 128 bits.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tractlake.llm.common import crc_text, cut, small_batches, table

#: Turns of a piece, and pieces of a container that isn't burst.
STRIDE, MOST = 32, 1024
#: Pieces of one conversation that are summed up in one group, and ids of one chunk of a list of ends.
RUN, CHUNK = 1024, 8192
#: No conversation takes over more turns than this.
LENT = 5
NOBODY = hashlib.sha256(b"").hexdigest()
NODE = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def turns_of(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, k (the turn's id) and chars (code points of its text); texts go no further."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    k = F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text))
    return conversations.where(F.col("conv_id").isNotNull()).select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), role.alias("role"), k.alias("k"), F.length(text).cast("long").alias("chars"))


def before(rows: DataFrame, key: str, run: str, value: dict[str, str]) -> DataFrame:
    """For each key and run, the sums of all earlier runs of the key."""
    parts = rows.groupBy(key, run).agg(*[F.sum(v).alias(v) for v in value])
    earlier = Window.partitionBy(key).orderBy(run).rowsBetween(Window.unboundedPreceding, -1)
    return parts.select(key, run, *[F.coalesce(F.sum(v).over(earlier), F.lit(0)).alias(name) for v, name in value.items()])


def positions(turns: DataFrame) -> DataFrame:
    """conv_id, pos (from 0), k, chars."""
    dealt = cut(turns.repartitionByRange("conv_id", "turn", "role", "k").withColumn("run", F.spark_partition_id()).withColumn("one", F.lit(1).cast("long")))
    inside = Window.partitionBy("conv_id", "run").orderBy("turn", "role", "k")
    local = dealt.withColumn("at", F.row_number().over(inside) - 1)
    return local.join(before(dealt, "conv_id", "run", {"one": "skip"}), ["conv_id", "run"]).select("conv_id", (F.col("at") + F.col("skip")).alias("pos"), "k", "chars")


def rebuilt(placed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(conv_id, length) of every rebuilt conversation, and its turns(conv_id, at, k, chars).

    The first h turns are those of conversation c - c % 100, the others a conversation's own after its first h; h is crc32(c) % 6.
    """
    known = cut(placed.groupBy("conv_id").agg(F.count("*").alias("n")))
    convs = known.withColumn("h", crc_text("conv_id") % (LENT + 1)).withColumn("base", F.col("conv_id") - F.col("conv_id") % 100)
    convs = convs.join(known.select(F.col("conv_id").alias("base"), F.col("n").alias("lent")), "base", "left")
    convs = cut(convs.withColumn("taken", F.least("h", F.coalesce("lent", F.lit(0)))).withColumn("length", F.col("taken") + F.greatest(F.col("n") - F.col("h"), F.lit(0))))
    own = placed.join(convs.select("conv_id", "h", "taken"), "conv_id").where("pos >= h").select("conv_id", (F.col("pos") - F.col("h") + F.col("taken")).alias("at"), "k", "chars")
    heads = placed.where(F.col("pos") < LENT).select(F.col("conv_id").alias("base"), F.col("pos").alias("at"), "k", "chars")
    lent = convs.where("taken > 0").select("conv_id", "base", "taken").join(heads, "base").where("at < taken").select("conv_id", "at", "k", "chars")
    return convs.select("conv_id", "length"), own.unionByName(lent)


def pieces_of(lengths: DataFrame, turns: DataFrame, stride: int) -> DataFrame:
    """conv_id, seg, piece (its id), ks and lens of every piece; the last one of a conversation is shorter than stride, maybe empty."""
    spot = F.struct((F.col("at") % stride).alias("spot"), "k", "chars")
    full = turns.groupBy("conv_id", F.floor(F.col("at") / stride).alias("seg")).agg(F.array_sort(F.collect_list(spot)).alias("t"))  # stride turns at most
    full = full.select("conv_id", "seg", F.col("t.k").alias("ks"), F.col("t.chars").alias("lens"))
    empty = lengths.where(F.col("length") % stride == 0).select("conv_id", F.floor(F.col("length") / stride).alias("seg"), F.array().cast("array<string>").alias("ks"), F.array().cast("array<bigint>").alias("lens"))
    return full.unionByName(empty).withColumn("piece", F.md5(F.array_join("ks", "")))


def summed_before(rows: DataFrame, values: list[str]) -> DataFrame:
    """conv_id, seg and, for each value, the sum over the conversation's earlier pieces."""
    rows = rows.withColumn("run", F.floor(F.col("seg") / RUN))
    inside = Window.partitionBy("conv_id", "run").orderBy("seg").rowsBetween(Window.unboundedPreceding, -1)
    local = rows.select("conv_id", "run", "seg", *[F.coalesce(F.sum(v).over(inside), F.lit(0)).alias(v) for v in values])
    earlier = before(rows, "conv_id", "run", {v: f"{v}_before" for v in values})
    return local.join(earlier, ["conv_id", "run"]).select("conv_id", "seg", *[(F.col(v) + F.col(f"{v}_before")).alias(v) for v in values])


def sharded(pieces: DataFrame, lengths: DataFrame, stride: int) -> DataFrame:
    """The pieces with shard (what all its pieces follow) and head_chars (of the turn just before)."""
    first = pieces.where("seg = 0").withColumn("shard", F.lit("0")).withColumn("head_chars", F.lit(0).cast("long"))
    chain = pieces.join(lengths.where(F.col("length") >= stride).select("conv_id"), "conv_id", "left_semi")
    names = chain.select("conv_id", "seg", *[F.xxhash64(F.lit(salt), "seg", "piece").cast("decimal(38,0)").alias(f"s{salt}") for salt in (1, 2)])
    heads = summed_before(names, ["s1", "s2"]).where("seg > 0").select("conv_id", "seg", F.md5(F.concat_ws(" ", "seg", "s1", "s2")).alias("shard"))
    lasts = chain.select("conv_id", (F.col("seg") + 1).alias("seg"), F.try_element_at("lens", F.lit(-1)).alias("head_chars"))
    later = chain.where("seg > 0").join(heads, ["conv_id", "seg"]).join(lasts.where("head_chars is not null"), ["conv_id", "seg"])
    return first.unionByName(later)


def digests(ends: DataFrame) -> DataFrame:
    """shard, piece, ends_sha256: of the ids of the conversations that end there, ascending. ends: shard, piece, conv_id.

    Ids are sorted by ranges and joined to chunks. A list of one chunk is hashed in place; the chunks of a longer one pass through one hash
    state in their order, as a SHA-256 demands, a batch at a time.
    """
    key = ["shard", "piece"]
    dealt = cut(ends.repartitionByRange(*key, "conv_id").withColumn("run", F.spark_partition_id()))
    order = Window.partitionBy(*key, "run").orderBy("conv_id")
    parts = dealt.withColumn("part", F.floor((F.row_number().over(order) - 1) / CHUNK))
    ids = F.array_join(F.transform(F.array_sort(F.collect_list("conv_id")), lambda x: x.cast("string")), ",")
    chunks = cut(parts.groupBy(*key, "run", "part").agg(ids.alias("ids")))
    whole = chunks.groupBy(*key).agg(F.count("*").alias("n"), F.min("ids").alias("ids"))
    short = whole.where("n = 1").select(*key, F.sha2("ids", 256).alias("ends_sha256"))

    def run(batches: Iterable[pd.DataFrame]) -> Iterable[pd.DataFrame]:
        at, state = None, None
        for batch in batches:
            done = []
            for shard, piece, text in zip(batch["shard"], batch["piece"], batch["ids"], strict=True):
                if (shard, piece) != at:
                    if at:
                        done.append((*at, state.hexdigest()))
                    at, state = (shard, piece), hashlib.sha256(text.encode())
                else:
                    state.update(b"," + text.encode())
            yield pd.DataFrame(done, columns=[*key, "ends_sha256"])
        if at:
            yield pd.DataFrame([(*at, state.hexdigest())], columns=[*key, "ends_sha256"])

    long = chunks.join(whole.where("n > 1").select(*key), key, "left_semi").repartition(*key).sortWithinPartitions(*key, "run", "part")
    return short.unionByName(long.select(*key, "ids").mapInPandas(run, "shard string, piece string, ends_sha256 string"))


def suffixes(pieces: DataFrame) -> DataFrame:
    """The distinct pieces of every shard: n conversations, the smallest of them, and the tails' sums."""
    rest = [F.first(c).alias(c) for c in ("seg", "ks", "lens", "head_chars")]
    return pieces.groupBy("shard", "piece").agg(F.count("*").alias("n"), F.min("conv_id").alias("least"), F.sum("tail_leaves").alias("tail_leaves"), F.sum("tail_saved").alias("tail_saved"), *rest)


def burst(found: DataFrame, most: int) -> tuple[DataFrame, list[DataFrame]]:
    """The suffixes in containers (box, level, and the head above: up, up_conv) that hold at most `most`, and by level the heads that burst."""
    active = found.withColumn("box", F.col("shard")).withColumn("level", F.lit(0)).withColumn("up", F.lit(None).cast("string")).withColumn("up_conv", F.lit(None).cast("long"))
    settled, heads = None, []
    while True:
        active, level = cut(active), len(heads)
        same = [F.first(c).alias(c) for c in ("seg", "up", "up_conv")] + [F.first(F.get("lens", F.lit(level - 1)) if level else F.col("head_chars")).alias("chars")]
        here = F.size("ks") == level
        large = active.groupBy("box").agg(F.count("*").alias("pieces"), F.sum("n").alias("n"), F.min("least").alias("least"), F.max(F.when(here, F.col("ends_sha256"))).alias("ends_sha256"), *same)
        large = cut(large.where(F.col("pieces") > most))
        if large.isEmpty():
            return (settled.unionByName(active) if settled else active), heads
        heads.append(large)
        told = active.join(large.select("box", F.col("least").alias("box_conv")), "box", "left")
        still = told.where("box_conv is null").drop("box_conv")
        settled = settled.unionByName(still) if settled else still
        moved = told.where(F.col("box_conv").isNotNull() & ~here).withColumn("up", F.col("box")).withColumn("up_conv", F.col("box_conv"))
        active = moved.withColumn("box", F.md5(F.concat("box", F.get("ks", F.lit(level))))).withColumn("level", F.lit(level + 1)).drop("box_conv")


class Open:
    """A node whose subtree is still being swept."""

    __slots__ = ("depth", "chars", "n", "least", "children", "leaves", "saved", "ends", "below")

    def __init__(self, depth: int, chars: int) -> None:
        self.depth, self.chars = depth, chars
        self.n = self.children = self.leaves = self.saved = 0
        self.least, self.ends, self.below = None, None, []

    def count(self, n: int, least: int) -> None:
        self.n += n
        self.least = least if self.least is None else min(self.least, least)

    def close(self, seg: int, stride: int) -> tuple:
        """Its row but for the parent; those below it get theirs."""
        if self.depth < stride:  # a node at stride is the head of a later shard, which has its row
            self.leaves += not self.children
            self.saved += (self.n - 1) * self.chars
        return (self.least, seg * stride + self.depth, self.n, self.children, self.leaves, self.saved, self.ends, (self.n - 1) * self.chars, self.depth == stride)


SWEPT = "conv_id long, depth long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string, own long, link boolean, parent_conv_id long, up string, level int, top boolean"


def sweep(batches: Iterable[pd.DataFrame], stride: int) -> Iterable[pd.DataFrame]:
    """The rows of all nodes of sorted containers; the topmost of each container is marked."""
    rows: list[tuple] = []
    stack: list[Open] = []
    box = seg = level = up = up_conv = None
    last: list[str] = []

    def shut(down_to: int) -> None:
        while len(stack) > 1 and stack[-1].depth > down_to:
            node = stack.pop()
            parent = stack[-1]
            row = node.close(seg, stride)
            rows.extend((*x, node.least, None, None, False) for x in node.below)
            parent.below.append(row)
            parent.count(node.n, node.least)
            parent.children += 1
            parent.leaves += node.leaves
            parent.saved += node.saved

    def finish() -> None:
        shut(level)
        node = stack.pop()
        row = node.close(seg, stride)
        rows.extend((*x, node.least, None, None, False) for x in node.below)
        rows.append((*row, up_conv, up, level, True))

    names = ["box", "seg", "level", "up", "up_conv", "ks", "lens", "head_chars", "n", "least", "ends_sha256", "tail_leaves", "tail_saved"]
    for batch in batches:
        batch["up_conv"] = batch["up_conv"].astype(object).where(batch["up_conv"].notna(), None)
        for b, s, v, u, c, ks, lens, head_chars, n, least, ends, leaves, saved in zip(*[batch[x].tolist() for x in names], strict=True):
            if b != box:
                if stack:
                    finish()
                box, seg, level, up, up_conv, last = b, s, v, u, None if c is None else int(c), ks
                stack.append(Open(level, int(lens[level - 1]) if level else head_chars))
                same = level
            else:
                same, end = level, min(len(last), len(ks))
                while same < end and last[same] == ks[same]:
                    same += 1
                shut(same)
            for d in range(same, len(ks)):
                stack.append(Open(d + 1, int(lens[d])))
            node = stack[-1]
            node.count(n, least)
            if len(ks) == stride:
                node.leaves += leaves
                node.saved += saved
            else:
                node.ends = ends
            last = ks
        yield pd.DataFrame(rows, columns=[x.split()[0] for x in SWEPT.split(", ")]).astype({"parent_conv_id": "Int64", "level": "Int32"})
        rows.clear()
    if stack:
        finish()
        yield pd.DataFrame(rows, columns=[x.split()[0] for x in SWEPT.split(", ")]).astype({"parent_conv_id": "Int64", "level": "Int32"})


def nodes_of(pieces: DataFrame, ends: DataFrame, most: int, stride: int) -> tuple[DataFrame, DataFrame]:
    """The nodes (NODE and own, what each node itself saves) of the shards of pieces, and links(conv_id, depth, parent_conv_id) to the heads of later shards."""
    boxes, heads = burst(suffixes(pieces).join(ends, ["shard", "piece"], "left"), most)
    swept = cut(boxes.repartition("box").sortWithinPartitions("box", "ks").mapInPandas(lambda batches: sweep(batches, stride), SWEPT))
    nodes = swept.where("not link").select(*NODE, "own")
    under = swept.where("top and up is not null").select("up", "level", "n_leaves", "saved_tokens")
    for level in reversed(range(len(heads))):
        sums = under.where(F.col("level") == level + 1).groupBy(F.col("up").alias("box")).agg(F.count("*").alias("n_children"), F.sum("n_leaves").alias("n_leaves"), F.sum("saved_tokens").alias("below"))
        own = (F.col("n") - 1) * F.col("chars")
        done = heads[level].join(sums, "box").withColumn("own", own).withColumn("saved_tokens", F.col("below") + own)
        done = cut(done.select(F.col("least").alias("conv_id"), (F.col("seg") * stride + level).alias("depth"), F.col("up_conv").alias("parent_conv_id"), F.col("n").alias("n_convs"), "n_children", "n_leaves", "saved_tokens", "ends_sha256", "own", "up", F.lit(level).alias("level")))
        nodes = nodes.unionByName(done.select(*NODE, "own"))
        under = under.unionByName(done.where("up is not null").select("up", "level", "n_leaves", "saved_tokens"))
    return nodes, swept.where("link").select("conv_id", "depth", "parent_conv_id")


def trie(lengths: DataFrame, turns: DataFrame, most: int = MOST, stride: int = STRIDE) -> DataFrame:
    """One row for each distinct beginning of the conversations (conv_id, length) with turns (conv_id, at, k, chars): NODE."""
    pieces = cut(pieces_of(lengths, turns, stride))
    longer = not pieces.where("seg > 0").isEmpty()
    pieces = cut(sharded(pieces, lengths, stride)) if longer else pieces.withColumn("shard", F.lit("0")).withColumn("head_chars", F.lit(0).cast("long"))
    pieces = pieces.withColumn("tail_leaves", F.lit(0).cast("long")).withColumn("tail_saved", F.lit(0).cast("long"))
    ends = digests(pieces.where(F.size("ks") < stride).select("shard", "piece", "conv_id"))
    if longer:
        ends = cut(ends)
        later, _ = nodes_of(pieces.where("seg > 0"), ends, most, stride)
        worth = later.groupBy("conv_id", F.floor(F.col("depth") / stride).alias("seg")).agg(F.sum("own").alias("saved"), F.count_if(F.col("n_children") == 0).alias("leaves"))
        chain = pieces.join(lengths.where(F.col("length") >= stride).select("conv_id"), "conv_id", "left_semi").select("conv_id", "seg")
        worth = cut(chain.join(worth, ["conv_id", "seg"], "left").na.fill(0, ["saved", "leaves"]))
        total = worth.groupBy("conv_id").agg(F.sum("saved").alias("all_saved"), F.sum("leaves").alias("all_leaves"))
        so_far = summed_before(worth, ["saved", "leaves"]).withColumnsRenamed({"saved": "was_saved", "leaves": "were_leaves"})
        tails = worth.join(so_far, ["conv_id", "seg"]).join(total, "conv_id").select("conv_id", "seg", (F.col("all_saved") - F.col("was_saved") - F.col("saved")).alias("s"), (F.col("all_leaves") - F.col("were_leaves") - F.col("leaves")).alias("l"))
        pieces = pieces.join(tails, ["conv_id", "seg"], "left").withColumn("tail_saved", F.coalesce("s", F.lit(0))).withColumn("tail_leaves", F.coalesce("l", F.lit(0))).drop("s", "l")
    nodes, links = nodes_of(pieces, ends, most, stride)
    nodes = nodes.drop("own")
    if longer:
        head = (F.col("depth") % stride == 0) & (F.col("depth") > 0)
        nodes = nodes.where(~head).unionByName(nodes.where(head).drop("parent_conv_id").join(links, ["conv_id", "depth"], "left"))
    return nodes.select(*[F.coalesce(c, F.lit(NOBODY)).alias(c) if c == "ends_sha256" else F.col(c) for c in NODE])


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return trie(*rebuilt(cut(positions(turns_of(table(spark, sf_dir, "conversations"))))))


QUERIES = {"op11_prefix_trie": op11_prefix_trie}
ORACLE = {
    "op11_prefix_trie": """
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text,
    md5(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS k
  FROM conversations WHERE conv_id IS NOT NULL
), placed AS (
  SELECT conv_id, k, length(text) AS chars, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, k) - 1 AS pos FROM t
), bytes AS (
  SELECT conv_id, count(*) AS n, list_concat([4294967295::BIGINT], list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda c: ascii(c)::BIGINT)) AS b
  FROM placed GROUP BY conv_id
), known AS (
  SELECT conv_id, n, conv_id - conv_id % 100 AS base,
    xor(4294967295::BIGINT, list_reduce(b, lambda s, x: list_reduce([xor(s, x), 0, 0, 0, 0, 0, 0, 0, 0],
      lambda a, z: CASE WHEN a % 2 = 1 THEN xor(a // 2, 3988292384::BIGINT) ELSE a // 2 END))) % 6 AS h
  FROM bytes
), convs AS (
  SELECT c.conv_id, c.n, c.h, c.base, least(c.h, coalesce(b.n, 0)) AS taken FROM known c LEFT JOIN known b ON c.base = b.conv_id
), turns AS (
  SELECT conv_id, taken + pos - h + 1 AS d, k, chars FROM placed JOIN convs USING (conv_id) WHERE pos >= h
  UNION ALL
  SELECT c.conv_id, p.pos + 1, p.k, p.chars FROM convs c JOIN placed p ON p.conv_id = c.base AND p.pos < c.taken
), paths AS (
  SELECT conv_id, d, chars, md5(string_agg(k, '') OVER (PARTITION BY conv_id ORDER BY d)) AS path FROM turns
  UNION ALL
  SELECT conv_id, 0, 0, '' FROM convs
), linked AS (
  SELECT conv_id, d, chars, path, lag(path) OVER o AS up, lead(d) OVER o IS NULL AS ends FROM paths WINDOW o AS (PARTITION BY conv_id ORDER BY d)
), nodes AS (
  SELECT d, path, any_value(up) AS up, any_value(chars) AS chars, min(conv_id) AS conv_id, count(*) AS n,
    sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (ends), '')) AS ends_sha256
  FROM linked GROUP BY d, path
), children AS (
  SELECT d - 1 AS d, up AS path, count(*) AS n_children FROM nodes WHERE d > 0 GROUP BY ALL
), owned AS (
  SELECT n.*, coalesce(n_children, 0) AS n_children FROM nodes n LEFT JOIN children c ON n.d = c.d AND n.path = c.path
), below AS (
  SELECT a.d, a.path, count(*) FILTER (v.n_children = 0) AS n_leaves, sum((v.n - 1) * v.chars) AS saved_tokens
  FROM owned v JOIN paths a ON a.conv_id = v.conv_id AND a.d <= v.d GROUP BY ALL
)
SELECT o.conv_id, CAST(o.d AS BIGINT) AS depth, p.conv_id AS parent_conv_id, o.n AS n_convs, o.n_children, b.n_leaves, CAST(b.saved_tokens AS BIGINT) AS saved_tokens, o.ends_sha256
FROM owned o JOIN below b ON o.d = b.d AND o.path = b.path LEFT JOIN owned p ON p.d = o.d - 1 AND p.path = o.up
"""
}
