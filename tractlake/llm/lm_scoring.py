"""Language-model scoring of whole texts, beside a word-unigram base.

Texts become subword ids once; a causal self-attention model (causal_lm) starts from how often each id follows which in all training
documents and is trained by rounds of local training and averaging: the training documents are parted over the rounds, so that each
one trains, whole, in one group of one round, whatever the size of the table. A round deals its documents to groups of about
GROUP_TOKENS tokens, trains a copy of the model in each group, and averages the copies, as whole numbers, so that their order doesn't matter; inside a call sums run in the order of its rows, so scores can differ in the seventh digit with how rows are dealt. Then every text is scored in overlapping windows that score each id
once, its end included.

The base counts the words of all training documents. A bounded table of the commonest words goes to every task; all other words
meet their counts in a join.

Defined results: a null text counts as empty, of which only the end is scored; rows without doc_id are held out; without
any training document all counts are 0 and the model keeps its initial weights; repeated rows are scored once each;
extra columns are not looked at. Words are told apart by 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tractlake.llm import causal_lm
from tractlake.llm.common import chunks, cut, give_back, held_out, table, text_calls, tidy
from tractlake.llm.packing import CHARS_A_CALL, coder
from tractlake.llm.words import word_hashes

TOKENIZER, VOCABULARY_SIZE, END_ID = "word_bpe_49k.json", 49408, 49407
ROUNDS = ((0.05, 0), (0.04, 1), (0.025, 2), (0.015, 3), (0.008, 4))  # learning rate, number
#: Weights are averaged in steps of one part in so many.
STEPS = 1 << 24
GROUP_TOKENS = 500_000
#: The commonest words, at most so many, that every task gets with their counts.
COMMON_WORDS = 1 << 19
#: Stands for the end of a text among the hashes of words.
END_WORD = np.uint64(0)
DOCS_A_CALL = 128


def with_key(docs: DataFrame) -> DataFrame:
    """doc_id, text (null: empty), held_out, and a key of both doc_id and text."""
    rows = docs.select(F.col("doc_id").cast("long"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    return rows.withColumn("held_out", held_out("doc_id", 7, 2)).withColumn("key", F.xxhash64("doc_id", "text"))


def subword_ids(rows: DataFrame, file: str) -> DataFrame:
    """key, held_out, n (ids) and the packed unsigned 16-bit ids of each row."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        words = coder(file)
        for batch in batches:
            ids = [x.astype("<u2").tobytes() for part in text_calls([(0, t) for t in batch["text"]], CHARS_A_CALL) for x in words.encode([t for _, t in part])]
            yield pd.DataFrame({"key": batch["key"], "held_out": batch["held_out"], "n": [len(x) // 2 for x in ids], "ids": ids})

    return rows.select("key", "held_out", "text").mapInPandas(tidy(run), "key long, held_out boolean, n long, ids binary")


def parts_of(packed: Iterable[bytes], most: int = 1 << 18) -> Iterator[list[np.ndarray]]:
    """Lists of texts of about so many ids together, so that what is worked out at once stays small."""
    part: list[np.ndarray] = []
    size = 0
    for ids in packed:
        part.append(np.frombuffer(ids, "<u2"))
        size += len(part[-1])
        if size >= most:
            yield part
            part, size = [], 0
    if part:
        yield part


def id_counts(encoded: DataFrame) -> np.ndarray:
    """How often each id occurs in training documents, ends included; VOCABULARY_SIZE rows at most reach the driver."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(VOCABULARY_SIZE, np.int64)
        for batch in batches:
            total += np.bincount(np.frombuffer(b"".join(batch["ids"]), "<u2"), minlength=VOCABULARY_SIZE)
            total[END_ID] += len(batch)
        at = np.flatnonzero(total)
        yield pd.DataFrame({"id": at, "n": total[at]})

    found = encoded.where(~F.col("held_out")).select("ids").mapInPandas(run, "id long, n long").groupBy("id").agg(F.sum("n").alias("n")).toPandas()
    out = np.zeros(VOCABULARY_SIZE)
    out[found["id"].to_numpy(np.int64)] = found["n"].to_numpy(np.float64)
    return out


def pairs_of(encoded: DataFrame, vocabulary: causal_lm.Vocabulary) -> causal_lm.Pairs:
    """The smoothed shares of what follows each id in training documents. Tasks smooth the counts of an input slot each, so that the driver
    gets one packed row for each of at most causal_lm.INPUTS slots, not their counts."""
    sent = encoded.sparkSession.sparkContext.broadcast(vocabulary)
    width = causal_lm.FREQUENT + 1

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(causal_lm.INPUTS * width, np.int32)
        for batch in batches:
            for part in parts_of(batch["ids"]):
                _, inputs, targets = causal_lm.framed(part, END_ID, sent.value)
                at, n = np.unique(causal_lm.pairs_in(inputs, sent.value.slot[targets]), return_counts=True)
                total[at] += n
        at = np.flatnonzero(total)
        yield pd.DataFrame({"pair": at.astype(np.int32), "n": total[at].astype(np.int64)})

    found = encoded.where(~F.col("held_out")).select("ids").mapInPandas(tidy(run), "pair int, n long").groupBy("pair").agg(F.sum("n").alias("n"))
    counts = cut(found.select(F.floor(F.col("pair") / width).cast("int").alias("input"), (F.col("pair") % width).alias("target"), "n"))
    followed = np.zeros(width)
    kinds = counts.groupBy("target").agg(F.count("*").alias("n")).toPandas()  # `width` rows at most
    followed[kinds["target"].to_numpy(np.int64)] = kinds["n"].to_numpy(np.float64)
    alone = causal_lm.Pairs.shares(followed)

    def smooth(group: pd.DataFrame) -> pd.DataFrame:
        row = np.zeros((1, width))
        row[0, group["target"].to_numpy(np.int64)] = group["n"].to_numpy(np.float64)
        got = causal_lm.Pairs.smoothed(row, alone)
        return pd.DataFrame({"input": group["input"].iloc[:1], "classes": [got.classes.tobytes()], "members": [got.members.tobytes()]})

    never = causal_lm.Pairs.smoothed(np.zeros((1, width)), alone)  # of a slot that nothing follows
    out = causal_lm.Pairs(np.repeat(never.classes, causal_lm.INPUTS, 0), np.repeat(never.members, causal_lm.INPUTS, 0))
    rows = counts.groupBy("input").applyInPandas(smooth, "input int, classes binary, members binary").toPandas()
    for slot, classes, members in rows.itertuples(index=False):
        out.classes[slot], out.members[slot] = np.frombuffer(classes, np.float32), np.frombuffer(members, np.float32)
    return out


def local_training(sent, params: causal_lm.Params, rate: float, number: int):
    """A function that trains a copy of params on the texts of one group; sent: vocabulary and pairs."""

    def learn(group: pd.DataFrame) -> pd.DataFrame:
        vocabulary, pairs = sent.value
        texts = [np.frombuffer(x, "<u2") for x in group.sort_values(["key", "n"])["ids"]]
        lengths, inputs, targets = causal_lm.framed(texts, END_ID, vocabulary)
        at, exists, _ = causal_lm.windows_of(lengths, 0)
        done = causal_lm.train(params, pairs, inputs[at], vocabulary.slot[targets][at], exists, rate=rate, seed=number)
        return pd.DataFrame({"name": list(done), "values": [np.rint(v.ravel().astype(np.float64) * STEPS).astype(np.int64).tolist() for v in done.values()]})

    return learn


def parted(encoded: DataFrame, groups: int) -> DataFrame:
    """The training rows with the one round and the group in it where each of them trains."""
    at = F.pmod(F.xxhash64("key", F.lit(100)), F.lit(groups * len(ROUNDS)))
    return encoded.where(~F.col("held_out")).withColumn("round", at % len(ROUNDS)).withColumn("group", F.floor(at / len(ROUNDS)))


@dataclass
class Model:
    vocabulary: causal_lm.Vocabulary
    pairs: causal_lm.Pairs
    params: causal_lm.Params


def train(encoded: DataFrame) -> Model:
    """The averaged model after all rounds; without a training document, the one it starts from."""
    counts = id_counts(encoded)
    vocabulary = causal_lm.Vocabulary.of(counts, END_ID)
    pairs, params = pairs_of(encoded, vocabulary), causal_lm.initial()
    total = counts.sum()
    if not total:
        return Model(vocabulary, pairs, params)
    sent = encoded.sparkSession.sparkContext.broadcast((vocabulary, pairs))  # sizes fixed by causal_lm
    dealt = parted(encoded, max(1, round(total / len(ROUNDS) / GROUP_TOKENS)))
    for rate, number in ROUNDS:
        learn = local_training(sent, params, rate, number)
        learned = dealt.where(F.col("round") == number).select("key", "n", "ids", "group").groupBy("group").applyInPandas(learn, "name string, values array<long>")
        mean = learned.select("name", F.posexplode("values").alias("at", "value")).groupBy("name", "at").agg((F.sum("value") / F.count("*") / STEPS).alias("value")).toPandas()
        if len(mean):
            by_name = {name: part.sort_values("at")["value"].to_numpy(np.float32) for name, part in mean.groupby("name")}
            params = {k: by_name[k].reshape(causal_lm.SHAPES[k]) for k in params}
        give_back()
    return Model(vocabulary, pairs, params)


def model_scores(encoded: DataFrame, model: Model) -> DataFrame:
    """key and the model's log10 probability of the text, its end included."""
    sent = encoded.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        m = sent.value
        for batch in batches:
            out = [causal_lm.score(m.params, m.pairs, m.vocabulary, part, END_ID) for part in parts_of(batch["ids"])]
            yield pd.DataFrame({"key": batch["key"], "score": np.concatenate(out) if out else np.zeros(0)})

    return encoded.select("key", "ids").mapInPandas(tidy(run), "key long, score double")


def word_counts(rows: DataFrame) -> DataFrame:
    """(word, n) over all training documents, ends included."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [word_hashes(part)[0] for part in chunks(list(batch["text"]), DOCS_A_CALL)]
            words, n = np.unique(np.concatenate(found), return_counts=True)
            yield pd.DataFrame({"word": np.append(words, END_WORD).view(np.int64), "n": np.append(n, len(batch))})

    return rows.where(~F.col("held_out")).select("text").mapInPandas(run, "word long, n long").groupBy("word").agg(F.sum("n").alias("n"))


def common_words(counts: DataFrame, most: int = COMMON_WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Words (sorted) and counts above the least count that at most `most` words reach."""
    sizes = counts.groupBy("n").agg(F.count("*").alias("words")).toPandas().sort_values("n", ascending=False)
    few = sizes[sizes["words"].cumsum() <= most]
    if not len(few):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    got = counts.where(F.col("n") >= int(few["n"].min())).toPandas()  # at most `most` rows
    words = got["word"].to_numpy(np.int64).view(np.uint64)
    order = np.argsort(words)
    return words[order], got["n"].to_numpy(np.int64)[order]


def base_scores(rows: DataFrame) -> DataFrame:
    """doc_id, key, held_out, n_tokens, n_known, train_tokens and base_score of each row."""
    counts = cut(word_counts(rows))
    sums = counts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("all"), F.count("*").alias("distinct")).first()
    denominator = sums["all"] + sums["distinct"] + 1
    words, n = common_words(counts)
    logs = np.log10((n + 1) / denominator)
    sent = rows.sparkSession.sparkContext.broadcast((words, logs))  # COMMON_WORDS entries at most

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known, value = sent.value
        for batch in batches:
            out = []
            for part in chunks(list(batch["text"]), DOCS_A_CALL):
                found, first = word_hashes(part)
                for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
                    mine = np.append(found[a:b], END_WORD)
                    each, many = np.unique(mine, return_counts=True)
                    at = np.minimum(np.searchsorted(known, each), max(0, len(known) - 1))
                    hit = known[at] == each if len(known) else np.zeros(len(each), bool)
                    out.append((len(mine), int(many[hit].sum()), float((value[at[hit]] * many[hit]).sum()), each[~hit].view(np.int64).tolist(), many[~hit].tolist()))
            got = pd.DataFrame(out, columns=["n_tokens", "n_common", "common", "rare", "rare_n"])
            yield pd.concat([batch[["doc_id", "key", "held_out"]].reset_index(drop=True), got], axis=1).astype({"doc_id": "Int64"})

    schema = "doc_id long, key long, held_out boolean, n_tokens long, n_common long, common double, rare array<long>, rare_n array<long>"
    first = cut(rows.mapInPandas(run, schema))
    rare = first.select("key", F.explode(F.arrays_zip("rare", "rare_n")).alias("w")).select("key", F.col("w.rare").alias("word"), F.col("w.rare_n").alias("many")).dropDuplicates(["key", "word"])
    met = rare.join(counts, "word", "left").groupBy("key").agg(
        F.sum(F.when(F.col("n").isNotNull(), F.col("many")).otherwise(0)).alias("n_rare"),
        F.sum(F.col("many") * F.log10((F.coalesce("n", F.lit(0)) + 1) / F.lit(float(denominator)))).alias("rare_sum"),
    )
    return first.drop("rare", "rare_n").join(met, "key", "left").select(
        "doc_id",
        "key",
        "held_out",
        "n_tokens",
        (F.col("n_common") + F.coalesce("n_rare", F.lit(0))).alias("n_known"),
        F.lit(int(sums["all"])).cast("long").alias("train_tokens"),
        (F.col("common") + F.coalesce("rare_sum", F.lit(0.0))).alias("base_score"),
    )


def score(docs: DataFrame, file: str | None = None) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of each row of docs(doc_id, text)."""
    rows = with_key(docs)
    encoded = cut(subword_ids(rows, file or public_tokenizers.path(TOKENIZER)))
    scored = model_scores(encoded, train(encoded))
    return base_scores(rows).join(scored.dropDuplicates(["key"]), "key").select("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op10_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score(table(spark, sf_dir, "documents"))


QUERIES = {"op10_lm_scoring": op10_lm_scoring}
ORACLE: dict[str, str] = {}
