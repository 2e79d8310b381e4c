"""Suffix-array dedup of bytes: whatever a 50-byte string covers that also starts in an earlier document is removed.

Not all suffixes are sorted, but those at anchors. Each 50-byte string has one anchor, the K-byte string in it of least
hash, at a place that depends on the string alone; so equal strings have equal anchors, and an anchor whose K bytes occur in
one document only needs no further look.

1. Copies: a text that equals that of an earlier document goes as a whole.
2. Tasks send the hashes of their anchors, sorted, by ranges; those found in several documents return to their documents. An
   anchor that several documents of a task share is known at once: one of them is sent on for all, so that an anchor of every
   document is met once a task.
3. These documents send the suffixes at such anchors as sorted, front-coded runs (equal contexts of a task as one, that of the
   least document). Loser trees merge the runs by their known common prefixes. A string that starts `o` bytes left of its anchor
   equals another one if their suffixes share 50 - o bytes, which the merged prefix lengths tell, and their left parts share o
   bytes, which the same lengths of the sorted left parts tell; in each class of equal strings the least document keeps its bytes.

Defined results: a null text counts as empty; texts below 50 bytes lose nothing; rows without doc_id lose nothing and
are nobody's earlier document; rows that repeat a doc_id don't match each other, whatever their texts; an empty table gives no
rows; extra columns are not looked at. Anchors and equal texts are told apart by hashes (of 64, and of 128 bits or more where
they alone decide about texts); strings are compared as they are.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tractlake.llm.common import cut, from_planes, give_back, likely_in, planes, split_by, table, tidy, unused
from tractlake.llm.suffixes import LEFT, WIDTH, Suffixes, front_code, merge_runs, read_run, shared_with_last
from tractlake.llm.words import prefix_sums, stretch_hashes

LENGTH, K = WIDTH, WIDTH - LEFT
#: Bytes hashed in one call; anchors a task gathers before it sends them; anchors in a group of the
#: first exchange, and groups of the second for each of the first.
CALL_BYTES, ANCHORS_A_BLOB = 1 << 18, 1_000_000
DOCS_A_BLOB = 1 << 16
ANCHORS_A_BUCKET, SUFFIXES_A_BLOB, SUFFIX_BUCKETS = 600_000, 100_000, 3
HASH_BITS = 32
EMPTY_SHA = hashlib.sha256(b"").hexdigest()


def anchors(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """For each run of strings with one anchor: text, hash of the anchor, its place, and the first and last start of the strings."""
    raw = np.frombuffer(b"".join(texts), np.uint8)
    n, width = len(raw), LENGTH - K + 1
    if n < LENGTH:
        return (np.zeros(0, np.int64),) * 5
    ends = np.cumsum([len(t) for t in texts])
    with np.errstate(over="ignore"):
        at = np.arange(n - K + 1)
        hashes = stretch_hashes(prefix_sums(raw), at, at + K)
    least = (hashes & np.uint64(0xFFFFFFFF00000000)) | at.astype(np.uint64)  # equal hashes: the leftmost
    span = 1
    while 2 * span <= width:
        least = np.minimum(least[:-span], least[span:])
        span *= 2
    if span < width:
        least = np.minimum(least[: len(least) - (width - span)], least[width - span :])
    place = (least & np.uint64(0xFFFFFFFF)).astype(np.int64)  # one for each string of LENGTH bytes
    owner = np.repeat(np.arange(len(texts)), [len(t) for t in texts])
    whole = owner[: n - LENGTH + 1] == owner[LENGTH - 1 :]
    start = np.flatnonzero(whole)
    new = np.concatenate(([True], (place[start][1:] != place[start][:-1]) | (np.diff(start) != 1))) if len(start) else np.zeros(0, bool)
    first = np.flatnonzero(new)
    last = np.concatenate((first[1:] - 1, [len(start) - 1])) if len(first) else first
    f, e = start[first], start[last]
    p = place[f]
    doc = owner[f]
    base = np.concatenate(([0], ends[:-1]))[doc]
    return doc, hashes[p], p - base, f - base, e - base


def _calls(items: list[tuple], size_of) -> Iterator[list[tuple]]:
    """Lists of items of about CALL_BYTES together."""
    part, size = [], 0
    for x in items:
        part.append(x)
        size += size_of(x)
        if size >= CALL_BYTES:
            yield part
            part, size = [], 0
    if part:
        yield part


def send_anchors(docs: DataFrame, buckets: int) -> DataFrame:
    """Rows of sorted anchor hashes by bucket, with the number of each one's document and the doc_ids of these numbers."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ids: list[int] = []
        found: list[tuple[np.ndarray, np.ndarray]] = []
        seen: dict[bytes, int] = {}
        size = 0
        squeeze = zstandard.ZstdCompressor(level=1, write_checksum=False)

        def blobs() -> pd.DataFrame:
            number, hashes = np.concatenate([x for x, _ in found]), np.concatenate([x for _, x in found])
            key = ((hashes >> np.uint64(HASH_BITS)) % np.uint64(buckets) << np.uint64(HASH_BITS)) | (hashes & np.uint64((1 << HASH_BITS) - 1))
            order = np.argsort(key, kind="stable")
            number, key = number[order], key[order]
            doc_ids = np.array(ids, np.int64)
            fresh = np.concatenate(([True], key[1:] != key[:-1]))
            many = np.repeat(np.diff(np.append(np.flatnonzero(fresh), len(key))), np.diff(np.append(np.flatnonzero(fresh), len(key)))) > 1
            rows = []
            for kind, on in ((0, fresh), (1, many)):
                k, m, local = key[on], number[on], many[on]
                cuts = np.searchsorted(k >> np.uint64(HASH_BITS), np.arange(buckets + 1)).tolist()
                for b, (i, j) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)):
                    if i < j:
                        mine, numbers = np.unique(m[i:j], return_inverse=True)
                        low = k[i:j] & np.uint64((1 << HASH_BITS) - 1)
                        blob = b"".join((planes(np.diff(low, prepend=np.uint64(0)), HASH_BITS // 8), planes(numbers, 2), planes(np.diff(doc_ids[mine], prepend=0), 8), np.packbits(local[i:j]).tobytes()))
                        to = b if kind == 0 else (b + int(doc_ids[mine[0]])) % buckets  # known ones pass through any bucket
                        rows.append((to, b if kind else -1, j - i, len(mine), squeeze.compress(blob)))
            return pd.DataFrame(rows, columns=["bucket", "of", "n", "docs", "blob"])

        for batch in batches:
            for part in _calls([(d, t) for d, t in zip(batch["doc_id"].tolist(), batch["text"], strict=True) if len(t) >= LENGTH // 4], lambda r: len(r[1])):
                fresh = []
                for doc, text in part:
                    raw = text.encode("utf-8", "surrogatepass")
                    key = hashlib.blake2b(raw, digest_size=16).digest()
                    if len(raw) < LENGTH or key in seen and seen[key] < doc:
                        continue  # a copy of an earlier document goes as a whole
                    seen[key] = doc
                    fresh.append((doc, raw))
                if not fresh:
                    continue
                if size >= ANCHORS_A_BLOB or len(ids) + len(fresh) > DOCS_A_BLOB:
                    yield blobs()
                    ids, found, seen, size = [], [], {}, 0
                doc, hashes, *_ = anchors([raw for _, raw in fresh])
                order = np.lexsort((hashes, doc))
                doc, hashes = doc[order], hashes[order]
                once = np.concatenate(([True], (doc[1:] != doc[:-1]) | (hashes[1:] != hashes[:-1]))) if len(doc) else np.zeros(0, bool)
                found.append(((doc[once] + len(ids)).astype(np.uint32), hashes[once]))
                ids += [d for d, _ in fresh]
                size += int(once.sum())
        if found:
            yield blobs()

    return docs.mapInPandas(tidy(run), "bucket int, of int, n int, docs int, blob binary")


def meet_anchors(sent: DataFrame) -> DataFrame:
    """(doc_id, anchor): the anchors, as bucket and hash in one number, that stand in several documents."""

    def read(rows: pd.DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        expand = zstandard.ZstdDecompressor()
        low, docs, known = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)], [np.zeros(0, bool)]
        for n, m, blob in zip(rows["n"].tolist(), rows["docs"].tolist(), rows["blob"], strict=True):
            raw, a = expand.decompress(blob), HASH_BITS // 8 * n
            low.append(np.cumsum(from_planes(raw[:a], HASH_BITS // 8, n)))
            ids = np.cumsum(from_planes(raw[a + 2 * n : a + 2 * n + 8 * m], 8, m).view(np.int64))
            docs.append(ids[from_planes(raw[a : a + 2 * n], 2, n).astype(np.int64)])
            known.append(np.unpackbits(np.frombuffer(raw[a + 2 * n + 8 * m :], np.uint8), count=n).astype(bool))
        return np.concatenate(low), np.concatenate(docs), np.concatenate(known)

    def run(group: pd.DataFrame) -> pd.DataFrame:
        low, docs, known = read(group[group["of"] < 0])
        order = np.argsort(low, kind="stable")
        same = low[order][1:] == low[order][:-1]
        many = np.zeros(len(low), bool)
        many[order[1:][same]] = True
        many[order[:-1][same]] = True
        many &= ~known  # those are told by the rows that pass through
        anchor, doc = [low[many] | np.uint64(group["bucket"].iloc[0]) << np.uint64(HASH_BITS)], [docs[many]]
        for bucket, rows in group[group["of"] >= 0].groupby("of"):
            low, docs, _ = read(rows)
            anchor.append(low | np.uint64(bucket) << np.uint64(HASH_BITS))
            doc.append(docs)
        return pd.DataFrame({"doc_id": np.concatenate(doc), "anchor": np.concatenate(anchor).view(np.int64)})

    return sent.groupBy("bucket").applyInPandas(run, "doc_id long, anchor long")


def packed_texts(rows: DataFrame, ids: DataFrame | None = None) -> DataFrame:
    """doc_id, h (a hash of the text) and the compressed text of rows(doc_id, text); with ids, of theirs and a few others."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        squeeze = zstandard.ZstdCompressor(level=1, write_checksum=False)
        for batch in batches:
            for at in range(0, len(batch), 500):
                part = batch.iloc[at : at + 500]
                yield pd.DataFrame({"doc_id": part["doc_id"], "h": part["h"], "packed": [squeeze.compress(t.encode("utf-8", "surrogatepass")) for t in part["text"]]})

    keyed, schema = rows.withColumn("h", F.xxhash64("text")), "doc_id long, h long, packed binary"
    return keyed.mapInPandas(tidy(run), schema) if ids is None else likely_in(keyed, ids.select("doc_id").distinct(), run, schema)


def send_suffixes(docs: DataFrame, anchor_buckets: int, buckets: int) -> DataFrame:
    """Front-coded runs of suffixes at the anchors that docs(doc_id, h, packed, found) share; found holds their numbers."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[tuple[np.ndarray, Suffixes]] = []
        size = 0
        expand = zstandard.ZstdDecompressor()

        def blobs() -> pd.DataFrame:
            bucket, every = np.concatenate([b for b, _ in held]), Suffixes.joined([x for _, x in held])
            suffix, left = every.keys()
            order = np.lexsort((every.doc, left, suffix, bucket))
            bucket, every = bucket[order], every.take(order)
            other = np.ones(len(order), bool)
            other[1:] = (bucket[1:] != bucket[:-1]) | (every.length[1:] != every.length[:-1]) | (every.left_length[1:] != every.left_length[:-1]) | (every.rows[1:] != every.rows[:-1]).any(1) | (every.left[1:] != every.left[:-1]).any(1)
            head = np.flatnonzero(other)[np.cumsum(other) - 1]
            again = every.doc != every.doc[head]  # the same context stands in an earlier document
            cuts = np.flatnonzero(np.concatenate(([True], bucket[1:] != bucket[:-1]))).tolist()
            rows = []
            for i, j in zip(cuts, [*cuts[1:], len(bucket)], strict=True):
                mine = np.arange(i, j)
                gone = mine[again[i:j]]
                done = np.stack([every.doc[gone], every.text[gone], every.start[gone], every.start[gone] + every.left_length[gone] + every.length[gone]], 1)
                rows.append((int(bucket[i]), front_code(every.take(mine[~again[i:j]])), done.astype("<i8").tobytes()))
            return pd.DataFrame(rows, columns=["bucket", "run", "done"])

        for batch in batches:
            rows = list(zip(batch["doc_id"].tolist(), batch["packed"], batch["h"].tolist(), batch["found"], strict=True))
            for part in _calls(rows, lambda r: 3 * len(r[1])):
                texts = [expand.decompress(t) for _, t, _, _ in part]
                doc, hashes, place, first, last = anchors(texts)
                mine = hashes & np.uint64((1 << HASH_BITS) - 1) | (hashes >> np.uint64(HASH_BITS)) % np.uint64(anchor_buckets) << np.uint64(HASH_BITS)
                bounds = np.searchsorted(doc, np.arange(len(part) + 1)).tolist()
                wanted = np.zeros(len(doc), bool)
                for k, (_, _, _, found) in enumerate(part):
                    want = np.sort(np.asarray(found, np.int64).view(np.uint64))
                    here = slice(bounds[k], bounds[k + 1])
                    wanted[here] = want[np.minimum(np.searchsorted(want, mine[here]), len(want) - 1)] == mine[here]
                if not wanted.any():
                    continue
                raw = np.frombuffer(b"".join(texts) + bytes(WIDTH), np.uint8)
                base = np.cumsum([0, *map(len, texts)])[doc[wanted]]
                p, f, e = place[wanted], first[wanted], last[wanted] + LENGTH
                right, left = np.arange(WIDTH), np.arange(LEFT)
                rights = np.where(right < (e - p)[:, None], raw[(base + p)[:, None] + right], 0).astype(np.uint8)
                lefts = np.where(left < (p - f)[:, None], raw[np.maximum((base + p)[:, None] - 1 - left, 0)], 0).astype(np.uint8)
                of = doc[wanted]
                ids, hs = np.array([r[0] for r in part], np.int64), np.array([r[2] for r in part], np.int64)
                held.append(((hashes[wanted] % np.uint64(buckets)).astype(np.int64), Suffixes(rights, e - p, lefts, p - f, ids[of], hs[of], f)))
                size += len(of)
                if size >= SUFFIXES_A_BLOB:
                    yield blobs()
                    held, size = [], 0
        if held:
            yield blobs()

    return docs.mapInPandas(tidy(run), "bucket long, run binary, done binary")


def removed_spans(every: Suffixes, order: np.ndarray, shared: np.ndarray) -> np.ndarray:
    """(doc, text hash, start, end) of what earlier documents cover, from suffixes and their merged order with the lengths shared there."""
    near = np.append(shared[1:], 0) >= K
    near |= shared >= K  # suffixes without a neighbour of K equal bytes match nothing
    kept = np.flatnonzero(near)
    if not len(kept):
        return np.zeros((0, 4), np.int64)
    right = np.where(np.concatenate(([True], np.diff(kept) != 1)), 0, shared[kept])
    every = every.take(order[kept])
    n = len(every)
    left_order = np.argsort(every.keys()[1], kind="stable")
    left = shared_with_last(every.left[left_order])
    left_after, right_after = np.append(left[1:], 0), np.append(right[1:], 0)
    covered = np.zeros((n, LEFT + 2), bool)  # by bytes left of the anchor, and one more that stays False
    left_class = np.empty(n, np.int64)
    for o in range(LEFT + 1):
        fits = (every.left_length >= o) & (every.length >= LENGTH - o) & (np.maximum(right, right_after) >= LENGTH - o)
        if o:
            alone = np.zeros(n, bool)
            alone[left_order] = np.maximum(left, left_after) < o
            fits &= ~alone
        at = np.flatnonzero(fits)
        if not len(at):
            continue
        left_class[left_order] = np.cumsum(left < o)
        key = np.cumsum(right < LENGTH - o)[at] * (n + 1) + left_class[at]
        by_key = np.argsort(key, kind="stable")
        new = np.concatenate(([True], key[by_key][1:] != key[by_key][:-1]))
        docs = every.doc[at[by_key]]
        least = np.minimum.reduceat(docs, np.flatnonzero(new))[np.cumsum(new) - 1]
        covered[at[by_key[docs > least]], o] = True
    edge = np.diff(covered.astype(np.int8), axis=1, prepend=0)
    who, low = np.nonzero(edge == 1)
    high = np.nonzero(edge == -1)[1] - 1
    place = every.start[who] + every.left_length[who]
    return np.stack([every.doc[who], every.text[who], place - high, place - low + LENGTH], 1)


def meet_suffixes(sent: DataFrame) -> DataFrame:
    """(doc_id, h, spans): packed [start, end) pairs to remove."""

    def run(group: pd.DataFrame) -> pd.DataFrame:
        runs = [read_run(x) for x in group["run"]]
        order, shared = merge_runs(runs)
        every = Suffixes.joined([r for r, _ in runs])
        del runs
        spans = np.concatenate((removed_spans(every, order, shared), np.frombuffer(b"".join(group["done"]), "<i8").reshape(-1, 4)))
        spans = spans[np.lexsort((spans[:, 1], spans[:, 0]))]
        first = np.flatnonzero(np.concatenate(([True], (spans[1:, :2] != spans[:-1, :2]).any(1)))) if len(spans) else np.zeros(0, np.int64)
        pairs = [x[:, 2:].astype("<i8").tobytes() for x in np.split(spans, first[1:])] if len(first) else []
        del every, order, shared
        give_back()
        return pd.DataFrame({"doc_id": spans[first, 0], "h": spans[first, 1], "spans": pairs})

    return sent.groupBy("bucket").applyInPandas(run, "doc_id long, h long, spans binary")


def kept_bytes(raw: bytes, spans: list[bytes]) -> tuple[bytes, int, int]:
    """What is left of a text, how many bytes went, and in how many maximal runs."""
    pairs = np.frombuffer(b"".join(spans), "<i8").reshape(-1, 2)
    change = np.zeros(len(raw) + 1, np.int64)
    np.add.at(change, pairs[:, 0], 1)
    np.add.at(change, pairs[:, 1], -1)
    gone = np.cumsum(change)[:-1] > 0
    runs = int((gone & ~np.concatenate(([False], gone[:-1]))).sum())
    return np.frombuffer(raw, np.uint8)[~gone].tobytes(), int(gone.sum()), runs


def dedup(docs: DataFrame, with_text: bool = False) -> tuple[DataFrame, DataFrame]:
    """(facts, changed): facts has doc_id, h, n_bytes, sha256 and copy for every row; changed has doc_id, h, n_removed, n_spans,
    kept_sha256, and with_text the kept text, of the documents that lose some bytes but aren't copies."""
    rows = docs.select(F.col("doc_id").cast("long"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    facts = cut(rows.select("doc_id", F.xxhash64("text").alias("h"), F.octet_length("text").cast("long").alias("n_bytes"), F.sha2("text", 256).alias("sha256")))
    firsts = cut(facts.where(F.col("doc_id").isNotNull() & (F.col("n_bytes") >= LENGTH)).groupBy("sha256").agg(F.min("doc_id").alias("first"), F.count("*").alias("n")).where("n > 1").select("sha256", "first"))
    facts = cut(facts.join(firsts, "sha256", "left").select("doc_id", "h", "n_bytes", "sha256", F.coalesce(F.col("doc_id") > F.col("first"), F.lit(False)).alias("copy")))
    size = facts.agg(F.coalesce(F.sum("n_bytes"), F.lit(0))).first()[0]
    anchor_buckets = max(1, -(-int(size) * 2 // ((LENGTH - K + 2) * ANCHORS_A_BUCKET)))
    named = rows.where(F.col("doc_id").isNotNull())
    found = meet_anchors(send_anchors(named, anchor_buckets)).groupBy("doc_id").agg(F.collect_list("anchor").alias("found"))
    found = found.join(facts.where("copy").select("doc_id"), "doc_id", "left_anti")
    sent = send_suffixes(packed_texts(named).join(found, "doc_id"), anchor_buckets, SUFFIX_BUCKETS * anchor_buckets)
    spans = cut(meet_suffixes(sent).groupBy("doc_id", "h").agg(F.collect_list("spans").alias("spans")))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        expand = zstandard.ZstdDecompressor()
        for batch in batches:
            out = []
            for text, found in zip(batch["packed"], batch["spans"], strict=True):
                kept, gone, runs = kept_bytes(expand.decompress(text), list(found))
                out.append((gone, runs, hashlib.sha256(kept).hexdigest(), *([kept.decode("utf-8", "ignore")] if with_text else [])))
            got = pd.DataFrame(out, columns=["n_removed", "n_spans", "kept_sha256", *(["kept"] if with_text else [])])
            yield pd.concat([batch[["doc_id", "h"]].reset_index(drop=True), got], axis=1)

    texts = packed_texts(named, spans)
    changed = texts.join(spans, ["doc_id", "h"]).mapInPandas(tidy(run), "doc_id long, h long, n_removed long, n_spans long, kept_sha256 string" + ", kept string" * with_text)
    return facts, changed


def digest(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and kept_sha256 of each row of docs(doc_id, text)."""
    facts, changed = dedup(docs)
    all_of_it = F.col("copy")
    joined = facts.join(changed.dropDuplicates(["doc_id", "h"]), ["doc_id", "h"], "left")
    return joined.select(
        "doc_id",
        "n_bytes",
        F.when(all_of_it, F.col("n_bytes")).otherwise(F.coalesce("n_removed", F.lit(0))).alias("n_removed"),
        F.when(all_of_it, F.lit(1)).otherwise(F.coalesce("n_spans", F.lit(0))).cast("long").alias("n_spans"),
        F.when(all_of_it, F.lit(EMPTY_SHA)).otherwise(F.coalesce("kept_sha256", "sha256")).alias("kept_sha256"),
    )


def remove_repeats(docs: DataFrame) -> DataFrame:
    """docs, all columns, with what is left of each text; documents of which no word is left go.

    A character that loses only some of its bytes goes with them.
    """
    facts, changed = dedup(docs, with_text=True)
    doc, h, maybe, kept = unused(docs, "doc", "h", "maybe", "kept")
    left = changed.select(F.col("doc_id").alias(doc), F.col("h").alias(h), F.col("kept").alias(kept))
    gone = facts.where("copy").select(F.col("doc_id").alias(doc), F.col("h").alias(h), F.lit("").alias(kept))
    edits = cut(left.unionByName(gone).dropDuplicates([doc, h]))

    tested = split_by(docs, edits.select(F.col(doc).alias("doc_id")), maybe)
    joined = tested.where(F.col(maybe)).withColumn(doc, F.col("doc_id").cast("long")).withColumn(h, F.xxhash64(F.coalesce("text", F.lit("")))).join(edits, [doc, h], "left")
    text = F.when(F.col(kept).isNull(), F.col("text")).otherwise(F.col(kept))
    edited = joined.withColumn("text", text).where(F.col(kept).isNull() | F.col("text").rlike(r"[^\x20\x09-\x0D]"))
    return tested.where(~F.col(maybe)).select(*docs.columns).unionByName(edited.select(*docs.columns))


def op8_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digest(table(spark, sf_dir, "documents"))


QUERIES = {"op8_suffix_dedup": op8_suffix_dedup}
ORACLE: dict[str, str] = {}
