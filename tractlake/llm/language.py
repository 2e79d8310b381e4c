"""Language identification by bit-sliced n-gram filters.

The grams of two to four letters (word edges included) of a bounded sample of labelled documents are entered into one Bloom
filter whose slots hold a bit for each language: one look-up at HASHES slots, and-ed, returns every language that contains the gram.
For each language the grams of a text that it contains are counted, the expected false positives, known from how full
its slice is, are taken off, and the largest corrected count decides; the score is its share of all corrected counts.

Defined results: a null text and one without a letter are `und` with score 0.0; a text none of whose grams is known gets the
first language learned (the commonest), with score 0.0; without any training row every text is `und`; rows with null lang or doc_id
teach nothing; repeated rows are judged once each; extra columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tractlake.llm.common import held_out, table

#: About so many documents of each language are learned from, whole.
SAMPLE_DOCS = 1500
SIZES = (2, 3, 4)
#: Grams kept for each language, which bounds what reaches the driver; a gram belongs to a language that uses it at least SHARE times as often as the language that uses it most.
GRAMS, SHARE, LEAST = 30_000, 0.3, 3
SLOTS_LOG2, HASHES = 20, 3
UNKNOWN = "und"
#: The eight bits of each byte.
BITS = np.arange(256)[:, None] >> np.arange(8) & 1


@cache
def letters() -> np.ndarray:
    """Which code points are letters."""
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), dtype=bool, count=0x110000)


def codes_of(text: str) -> np.ndarray:
    """Code points of the lower-cased text; whatever is no letter becomes one space, also at both ends."""
    raw = np.frombuffer(f" {text.lower()} ".encode("utf-32-le", "surrogatepass"), dtype="<u4")
    flat = np.where(letters()[raw], raw, 32).astype(np.uint64)
    gap = flat == 32
    return flat[~(gap & np.roll(gap, 1)) | (np.arange(len(flat)) == 0)] if len(flat) else flat


def grams(codes: np.ndarray) -> np.ndarray:
    """64-bit hashes of all grams of SIZES code points."""
    out = []
    with np.errstate(over="ignore"):
        h = codes + np.uint64(0x9E3779B97F4A7C15)
        for n in range(2, max(SIZES) + 1):
            if len(codes) < n:
                break
            h = (h[:-1] ^ (h[:-1] >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) + codes[n - 1 :]
            if n in SIZES:
                x = (h ^ (h >> np.uint64(32))) * np.uint64(0x94D049BB133111EB)
                out.append(x ^ (x >> np.uint64(31)))
    return np.concatenate(out) if out else np.zeros(0, np.uint64)


class Filter:
    """A Bloom filter with a bit for each language in every slot; a slot has as many bytes as the languages need."""

    def __init__(self, languages: list[str]) -> None:
        self.languages = languages
        self.slots = np.zeros((1 << SLOTS_LOG2, max(1, -(-len(languages) // 8))), np.uint8)

    @staticmethod
    def places(hashes: np.ndarray) -> list[np.ndarray]:
        mask = np.uint64((1 << SLOTS_LOG2) - 1)
        return [((hashes >> np.uint64(shift)) & mask).astype(np.int64) for shift in (0, 21, 43)[:HASHES]]

    def add(self, hashes: np.ndarray, language: int) -> None:
        for at in self.places(hashes):
            self.slots[at, language // 8] |= np.uint8(1 << language % 8)

    def languages_of(self, hashes: np.ndarray) -> np.ndarray:
        """Bit masks, a byte for eight languages, of all languages that contain each gram."""
        found = None
        for at in self.places(hashes):
            found = self.slots[at] if found is None else found & self.slots[at]
        return found

    def false_positives(self) -> np.ndarray:
        return (self.hits(self.slots) / len(self.slots)) ** HASHES

    def hits(self, masks: np.ndarray) -> np.ndarray:
        """In how many of the masks each language is."""
        by_byte = [np.bincount(masks[:, k], minlength=256) @ BITS for k in range(masks.shape[1])]
        return np.concatenate(by_byte)[: len(self.languages)].astype(np.float64)

    def count(self, hashes: np.ndarray) -> np.ndarray:
        """Grams in each language, false positives taken off."""
        return np.maximum(0, (self.hits(self.languages_of(hashes)) - len(hashes) * self.wrong) / (1 - self.wrong))

    def close(self) -> Filter:
        self.wrong = np.minimum(self.false_positives(), 0.99)
        return self

    def predict(self, text: str) -> tuple[str, float]:
        codes = codes_of(text)
        if not self.languages or not (codes != 32).any():
            return UNKNOWN, 0.0
        counts = self.count(grams(codes))
        best = int(counts.argmax())
        return self.languages[best], float(counts[best] / counts.sum()) if counts.sum() > 0 else 0.0


def counted(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The grams of some texts and how often each occurs."""
    found = [grams(codes_of(t)) for t in texts]
    return np.unique(np.concatenate(found) if found else np.zeros(0, np.uint64), return_counts=True)


def learn(counts: dict[str, tuple[np.ndarray, np.ndarray, int]]) -> Filter:
    """A filter from the commonest grams of each language, their counts, and the number of all grams of its texts."""
    model = Filter(list(counts))
    every = np.unique(np.concatenate([k for k, _, _ in counts.values()])) if counts else np.zeros(0, np.uint64)
    most = np.zeros(len(every))
    for keys, n, total in counts.values():
        at = np.searchsorted(every, keys)
        most[at] = np.maximum(most[at], n / max(1, total))
    for i, (keys, n, total) in enumerate(counts.values()):
        model.add(keys[n / max(1, total) >= SHARE * most[np.searchsorted(every, keys)]], i)
    return model.close()


def fit_on(docs: DataFrame, sample_docs: int = SAMPLE_DOCS) -> Filter:
    """A filter from documents that aren't held out; GRAMS grams of each language reach the driver."""
    known = docs.select("doc_id", "text", F.col("lang").cast("string").alias("lang")).where(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out("doc_id", 4, 2))
    sizes = known.groupBy("lang").count()
    dice = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20))
    chosen = known.join(F.broadcast(sizes), "lang").where(dice * F.col("count") < (1 << 20) * sample_docs)  # a row for each language

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for lang, part in batch.groupby("lang"):
                keys, n = counted(list(part["text"]))
                yield pd.DataFrame({"lang": lang, "gram": keys.view(np.int64), "n": n})

    found = chosen.select("lang", "text").mapInPandas(run, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    total = F.sum("n").over(Window.partitionBy("lang"))
    place = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "gram"))
    rows = found.select("*", total.alias("total"), place.alias("place")).where((F.col("place") <= GRAMS) & (F.col("n") >= LEAST)).toPandas()
    counts = {}
    for r in sizes.orderBy(F.desc("count"), "lang").collect():
        mine = rows[rows["lang"] == r["lang"]].sort_values("gram")
        counts[r["lang"]] = (mine["gram"].to_numpy(np.int64).view(np.uint64), mine["n"].to_numpy(np.int64), int(mine["total"].max()) if len(mine) else 0)
    return learn(counts)


def predict(docs: DataFrame, model: Filter) -> DataFrame:
    """doc_id, lang_pred and score of each row of docs(doc_id, text)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            got = [(UNKNOWN, 0.0) if t is None else model.predict(t) for t in batch["text"]]
            yield pd.DataFrame({"doc_id": batch["doc_id"], "lang_pred": [x for x, _ in got], "score": np.asarray([x for _, x in got], dtype=np.float64)}).astype({"doc_id": "Int64"})

    return docs.select(F.col("doc_id").cast("long"), "text").mapInPandas(run, "doc_id long, lang_pred string, score double")


def op7_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return predict(docs, fit_on(docs)).select("doc_id", held_out("doc_id", 4, 2).alias("held_out"), "lang_pred", "score")


QUERIES = {"op7_language": op7_language}
ORACLE: dict[str, str] = {}
