"""Best-fit packing of token sequences by minimum bin slack.

Documents are tokenised, closed with an end id, and cut into pieces of at most the capacity. How full a sequence can be
depends on lengths alone, so the plan is made on the histogram of lengths, which has at most `capacity` rows however
many documents there are: the longest piece left opens a bin, a bitset subset-sum over the lengths that are left finds the
fullest combination with it, and that combination is taken as often as the counts allow. The plan then goes back
to the pieces: the n-th piece of a length (in an order of salted groups, so that a frequent length is no single
task) takes the n-th place planned for that length.

Defined results: a null text counts as empty; an empty document is the end id alone (one piece of length 1); repeated rows
are packed once each; an empty table gives no rows; extra columns of the input are not looked at. Special tokens
written out in a text are ordinary text.
"""

from __future__ import annotations

import unicodedata
import zlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pandas as pd
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tractlake.llm.common import chunks, cut, table, text_calls, tidy
from tractlake.llm.words import prefix_sums, stretch_hashes

CAPACITY = 2048
END_ID = 0
#: Distinct words whose ids a worker keeps at most; when they are so many, the table starts anew.
TABLE_WORDS = 1 << 20
CHARS_A_CALL = 1 << 19
#: Pre-tokens of more characters are left to the tokenizer, with their whole text.
LONGEST_WORD = 256
#: Pieces that one task numbers; a length with more is split into salted groups.
PIECES_A_GROUP = 100_000

#: Kinds of code points in the pre-token pattern of the tokenizer file: runs of letters, single numbers, runs of all else but space.
SPACE, LETTER, NUMBER, OTHER = range(4)
#: What the pattern splits off after an apostrophe of its own.
SUFFIXES = ("s", "t", "re", "ve", "m", "ll", "d")

_coders: dict[str, "WordCoder"] = {}


@cache
def kinds() -> np.ndarray:
    """The kind of every code point; white space by Unicode's property, as the tokenizer has it."""
    category = np.frombuffer("".join(map(unicodedata.category, map(chr, range(0x110000)))).encode(), np.uint8)[::2]
    out = np.select([category == ord("L"), category == ord("N"), category == ord("Z")], [LETTER, NUMBER, SPACE], OTHER).astype(np.uint8)
    out[[*range(0x09, 0x0E), 0x85]] = SPACE
    return out


def pretokens(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the pre-tokens of some lower-cased code points start and end; a space stands last."""
    kind = kinds()[codes]
    first = np.concatenate(([True], (kind[1:] != kind[:-1]) | (kind[1:] == NUMBER)))
    edge = np.flatnonzero(first)
    quote = edge[:-1][(codes[edge[:-1]] == ord("'")) & (np.diff(edge) == 1) & (kind[edge[1:]] == LETTER)]
    if len(quote):
        padded = np.concatenate((codes, np.zeros(2, codes.dtype)))
        taken = np.zeros(len(quote), np.int64)
        for suffix in SUFFIXES:
            fits = (taken == 0) & np.logical_and.reduce([padded[quote + 1 + k] == ord(x) for k, x in enumerate(suffix)])
            taken[fits] = len(suffix)
        cut_at = quote[taken > 0]
        first[cut_at + 1] = False
        first[cut_at + 1 + taken[taken > 0]] = True
    starts = np.flatnonzero(first)
    ends = np.append(starts[1:], len(codes))
    on = kind[starts] != SPACE
    return starts[on], ends[on]


class WordCoder:
    """Token ids of texts. Pre-tokens are told apart by 64-bit hashes of their code points; each is encoded once while the table holds it."""

    def __init__(self, file: str) -> None:
        self.file, self.full = file, None
        self.words = Tokenizer.from_file(file)
        self.words.encode_special_tokens = True
        self.words.normalizer = None
        self.added = [t.content.lower() for t in self.words.get_added_tokens_decoder().values()]
        ends = [i for token, i in self.words.get_vocab().items() if token.endswith("</w>")]
        self.closes = np.zeros(max(self.words.get_vocab().values()) + 1, bool)
        self.closes[ends] = True
        self.forget()

    def forget(self) -> None:
        """Empties the table."""
        self.keys, self.first, self.many = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.flat = np.zeros(0, "<u4")

    def _encode_pretokens(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of pre-tokens, and how many each has; many in one call, as each ends with the first id that closes a word."""
        found, many = [], []
        for part in chunks(words, 2000):
            ids = np.asarray(self.words.encode_batch_fast([" ".join(part)], add_special_tokens=False)[0].ids, dtype="<u4")
            ends = np.flatnonzero(self.closes[ids]) + 1
            if len(ends) != len(part) or ends[-1] != len(ids):
                each = [np.asarray(self.words.encode(x, add_special_tokens=False).ids, dtype="<u4") for x in part]
                ids, ends = np.concatenate(each), np.cumsum([len(x) for x in each])
            found.append(ids)
            many.append(np.diff(ends, prepend=0))
        return np.concatenate(found), np.concatenate(many)

    def _learn(self, keys: np.ndarray, words: list[str]) -> None:
        """Adds words by their hashes, which are sorted and not in the table."""
        ids, many = self._encode_pretokens(words)
        first = len(self.flat) + np.cumsum(many) - many
        at = np.searchsorted(self.keys, keys)
        self.keys, self.first, self.many = np.insert(self.keys, at, keys), np.insert(self.first, at, first), np.insert(self.many, at, many)
        self.flat = np.concatenate((self.flat, ids))

    def _whole(self, text: str) -> np.ndarray:
        """The ids of an odd text, by the tokenizer as it is; few workers ever need it."""
        if self.full is None:
            self.full = Tokenizer.from_file(self.file)
        return np.asarray(self.full.encode(text, add_special_tokens=False).ids, dtype="<u4")

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text, unsigned 32-bit."""
        odd = {i for i, x in enumerate(texts) if "Σ" in x}  # Python lower-cases it by its neighbours
        plain = ["" if i in odd else (x if x.isascii() else unicodedata.normalize("NFC", x)).lower() for i, x in enumerate(texts)]
        for token in self.added:  # a marker in a text is the tokenizer's own token
            odd.update(i for i, x in enumerate(plain) if token in x)
        text_ends = np.cumsum([len(x) + 1 for x in plain])
        joined = " ".join([*plain, ""])
        codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), "<u4")
        starts, ends = pretokens(codes)
        odd.update(np.searchsorted(text_ends, starts[ends - starts > LONGEST_WORD], side="right").tolist())
        with np.errstate(over="ignore"):
            hashes, place, inverse = np.unique(stretch_hashes(prefix_sums(codes), starts, ends), return_index=True, return_inverse=True)
        at = np.searchsorted(self.keys, hashes)
        new = np.ones(len(hashes), bool)
        inside = np.flatnonzero(at < len(self.keys))
        new[inside] = self.keys[at[inside]] != hashes[inside]
        if new.any():
            if len(self.keys) + int(new.sum()) > TABLE_WORDS:  # the table starts anew, with all words of this call
                self.forget()
                new[:] = True
            self._learn(hashes[new], [joined[a:b] for a, b in zip(starts[place[new]].tolist(), ends[place[new]].tolist(), strict=True)])
            at = np.searchsorted(self.keys, hashes)
        first, many = self.first[at][inverse], self.many[at][inverse]
        after = np.cumsum(many)
        ids = self.flat[np.repeat(first - (after - many), many) + np.arange(int(after[-1]) if len(after) else 0)]
        bounds = np.concatenate(([0], after))[np.searchsorted(starts, text_ends)].tolist()
        out = [ids[a:b] for a, b in zip([0, *bounds[:-1]], bounds, strict=True)]
        for i in odd:
            out[i] = self._whole(texts[i])
        return out


def coder(file: str) -> WordCoder:
    """One coder for each Python worker."""
    if file not in _coders:
        _coders[file] = WordCoder(file)
    return _coders[file]


def pieces(docs: DataFrame, file: str | None = None, capacity: int = CAPACITY, end_id: int = END_ID, with_ids: bool = False) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 of each piece of docs(doc_id, text), and with_ids the packed ids."""
    file = file or public_tokenizers.path("word_bpe_49k.json")
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long" + ", ids binary" * with_ids
    end = np.asarray([end_id], dtype="<u4").tobytes()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        words = coder(file)
        for batch in batches:
            rows: list[tuple] = []
            for part in text_calls(list(zip(batch["doc_id"], batch["text"], strict=True)), CHARS_A_CALL):
                for (doc, _), ids in zip(part, words.encode([x for _, x in part]), strict=True):
                    raw = ids.tobytes() + end
                    for k, at in enumerate(range(0, len(raw), 4 * capacity)):
                        ids = raw[at : at + 4 * capacity]
                        rows.append((doc, k, at // 4, len(ids) // 4, zlib.crc32(ids), *([ids] if with_ids else [])))
            out = pd.DataFrame(rows, columns=["doc_id", "piece", "start", "length", "ids_crc32", *(["ids"] if with_ids else [])])
            yield out.astype({"doc_id": "Int64"})

    return docs.select(F.col("doc_id").cast("long"), F.coalesce(F.col("text"), F.lit("")).alias("text")).mapInPandas(tidy(run), schema)


def fullest(first: int, counts: dict[int, int], capacity: int) -> dict[int, int]:
    """The combination of the lengths left that fills a bin best beside a piece of length first: how many of each."""
    room = capacity - first
    left = dict(counts)
    left[first] -= 1
    reach, mask, steps = 1, (1 << (room + 1)) - 1, []
    for length in sorted((x for x, n in left.items() if n and x <= room), reverse=True):
        many, share = min(left[length], room // length), 1
        while many and not reach >> room & 1:
            take = min(share, many)
            steps.append((length, take, reach))
            reach |= (reach << (length * take)) & mask
            many -= take
            share *= 2
        if reach >> room & 1:
            break
    at, chosen = reach.bit_length() - 1, {first: 1}
    for length, take, before in reversed(steps):
        if not before >> at & 1:
            at -= length * take
            chosen[length] = chosen.get(length, 0) + take
    return chosen


def plan_bins(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, dict[int, int]]]:
    """(first bin, number of bins, pieces of each length in a bin), from the histogram of lengths."""
    left, plan, bins = {k: n for k, n in histogram.items() if n}, [], 0
    while left:
        chosen = fullest(max(left), left, capacity)
        times = min(left[x] // n for x, n in chosen.items())
        plan.append((bins, times, chosen))
        bins += times
        for x, n in chosen.items():
            left[x] -= times * n
            if not left[x]:
                del left[x]
    return plan


def places(plan: list[tuple[int, int, dict[int, int]]]) -> dict[int, np.ndarray]:
    """For each length its runs of places: (first rank, first bin, pieces of it in a bin, offset of the first one)."""
    taken: dict[int, int] = {}
    runs: dict[int, list[tuple[int, int, int, int]]] = {}
    for first, times, chosen in plan:
        offset = 0
        for length, n in chosen.items():
            runs.setdefault(length, []).append((taken.get(length, 0), first, n, offset))
            taken[length] = taken.get(length, 0) + times * n
            offset += n * length
    return {k: np.asarray(v, dtype=np.int64) for k, v in runs.items()}


def pack(cut_pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Adds sequence_id and offset to pieces(doc_id, piece, length, ...). They are read twice: give a checkpoint or a table."""
    spark = cut_pieces.sparkSession
    histogram = {r["length"]: r["n"] for r in cut_pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}  # capacity rows at most
    runs = spark.sparkContext.broadcast(places(plan_bins(histogram, capacity)))  # bounded by the plan over capacity lengths
    salts = max(1, -(-max(histogram.values(), default=0) // PIECES_A_GROUP) * 4)
    salted = cut_pieces.withColumn("salt__", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(salts)))
    before = Window.partitionBy("length").orderBy("salt__").rowsBetween(Window.unboundedPreceding, -1)
    offsets = salted.groupBy("length", "salt__").agg(F.count("*").alias("n")).select("length", "salt__", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base__"))
    inside = Window.partitionBy("length", "salt__").orderBy("doc_id", "piece")
    ranked = salted.withColumn("rank__", F.row_number().over(inside)).join(offsets, ["length", "salt__"]).withColumn("rank__", F.col("rank__") - 1 + F.col("base__"))
    names = [c for c in cut_pieces.columns]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in cut_pieces.schema) + ", sequence_id long, offset long"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rank, length = batch["rank__"].to_numpy(), batch["length"].to_numpy()
            sequence, offset = np.zeros(len(batch), np.int64), np.zeros(len(batch), np.int64)
            for x in np.unique(length):
                here = np.flatnonzero(length == x)
                run_of = runs.value[int(x)]
                row = run_of[np.searchsorted(run_of[:, 0], rank[here], side="right") - 1]
                nth = rank[here] - row[:, 0]
                sequence[here] = row[:, 1] + nth // row[:, 2]
                offset[here] = row[:, 3] + nth % row[:, 2] * x
            yield batch[names].assign(sequence_id=sequence, offset=offset)

    return ranked.select(*names, "rank__").mapInPandas(run, schema)


def pack_documents(docs: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    return pack(cut(pieces(docs, capacity=capacity)), capacity)


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"))


QUERIES = {"op2_packing": op2_packing}
ORACLE: dict[str, str] = {}
