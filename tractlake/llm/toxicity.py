"""Toxicity by compression distance.

Two zstandard dictionaries are made from a bounded sample of labelled documents. Neither is what zstandard's own trainer gives: the
ordinary one holds the commonest words of ordinary documents, the toxic one is a list of the words and beginnings of words that are
far commoner in toxic documents (the README says why, with figures). A text is cut into windows of one word each, spaces included;
each is compressed with the ordinary dictionary and with toxic before ordinary content. How many windows of the whole text save how many bytes by the toxic content is what a logistic curve, calibrated on
the training rows, turns into a score.

Defined results: null and empty texts get the score of a text with nothing saved; a table without usable labels (no toxic or no
ordinary training row) gives every row the score 0.0; rows with a null label or doc_id teach nothing; repeated rows are scored
once each; extra columns are not looked at. Only the text enters a score.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tractlake.llm.common import held_out, labelled_texts, table

#: Labelled documents of each class that the model is fitted on: the bound of what reaches the driver.
SAMPLE_DOCS = 2000
ORDINARY_BYTES, TOXIC_BYTES = 8192, 4096
#: Each window is compressed before so many bytes of ordinary content.
TRAIL_BYTES = 64
#: Windows whose savings a worker keeps at most.
CACHE_ENTRIES = 600_000
PUNCTUATION = dict.fromkeys(map(ord, ".,;:!?\"()[]{}<>|*#$%&=+/\\-_~`"), " ")
#: Savings of a window, in bytes, count as at least LOW and at most HIGH.
LOW, HIGH = -1, 6
RIDGE = 0.3
#: A span is telling if in so many toxic documents, and such a share of them, at least, and so many times commoner there than in
#: ordinary ones; for the commonest spans a lower ratio will do.
LEAST_DOCS, LEAST_SHARE, LEAST_RATIO = 3, 0.03, 15.0
COMMON_SHARE, COMMON_RATIO = 0.1, 5.0
PREFIXES = range(5, 11)
WORD = re.compile(r"[^\W\d_]+")


def windows(text: str) -> list[str]:
    """The words of the text in lower case, without the punctuation around them."""
    return text.lower().translate(PUNCTUATION).split()


def spans_of(text: str) -> set[str]:
    """Words between spaces, and their beginnings, which are shared by inflected forms."""
    words = set(WORD.findall(text.lower()))
    return {f" {w} " for w in words} | {f" {w[:k]}" for w in words for k in PREFIXES if len(w) > k}


@dataclass
class Model:
    ordinary: bytes
    toxic: bytes
    weights: np.ndarray

    def compressors(self) -> tuple[zstandard.ZstdCompressor, zstandard.ZstdCompressor]:
        def make(content: bytes) -> zstandard.ZstdCompressor:
            found = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            settings = zstandard.ZstdCompressionParameters(window_log=15, hash_log=14, chain_log=14, search_log=8, min_match=6, target_length=256, strategy=zstandard.STRATEGY_GREEDY, write_content_size=False, write_checksum=False, write_dict_id=False)
            return zstandard.ZstdCompressor(dict_data=found, compression_params=settings)

        return make(self.ordinary), make(self.toxic + self.ordinary)

    def score(self, saved: np.ndarray) -> float:
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, float(self.weights[:-1] @ saved + self.weights[-1])))))


class Savings(dict):
    """Bytes that the toxic content saves on a window, LOW to HIGH; kept for CACHE_ENTRIES windows, else compressed again."""

    def __init__(self, model: Model) -> None:
        super().__init__()
        self.plain, self.both = model.compressors()
        self.trail = model.ordinary[-TRAIL_BYTES:]  # a frame of few bytes is stored as it is, and its last bytes are never matched

    def __missing__(self, window: str) -> int:
        raw = f" {window} ".encode() + self.trail
        gain = max(LOW, min(HIGH, len(self.plain.compress(raw)) - len(self.both.compress(raw))))
        if len(self) < CACHE_ENTRIES and len(window) <= 64:
            self[window] = gain
        return gain

    def count(self, text: str) -> np.ndarray:
        """Logarithms of one plus how many windows of the text save how many bytes, from LOW or fewer to HIGH or more."""
        gains = np.fromiter(map(self.__getitem__, windows(text)), dtype=np.int64)
        return np.log1p(np.bincount(gains - LOW, minlength=HIGH - LOW + 1))


def _fit_curve(x: np.ndarray, toxic: np.ndarray) -> np.ndarray:
    """Weights of a logistic curve on the window counts, the last one its offset; damped Newton steps with a ridge."""
    x = np.hstack([x, np.ones((len(x), 1))])
    ridge = np.full(x.shape[1], RIDGE)
    ridge[-1] = 0.01
    b = np.zeros(x.shape[1])

    def loss(b: np.ndarray) -> float:
        z = x @ b
        return float(np.logaddexp(0, z).sum() - toxic @ z + 0.5 * ridge @ b**2)

    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(x @ b, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + np.diag(ridge), x.T @ (toxic - p) - ridge * b)
        size = 1.0
        while size > 1e-4 and loss(b + size * step) > loss(b):
            size /= 2
        b = b + size * step
        if size * np.abs(step).max() < 1e-6:
            break
    return b


def without_copies(texts: list[str]) -> list[str]:
    """Texts none of whose three minimum hashes over runs of three words was seen before: near copies would make their words telling."""
    seen: set[tuple[int, int]] = set()
    out = []
    for t in texts:
        words = t.lower().split()
        runs = [" ".join(words[i : i + 3]).encode() for i in range(max(1, len(words) - 2))]
        keys = {(k, min(zlib.crc32(r, k) for r in runs)) for k in (1, 2, 3)}
        if not keys & seen:
            out.append(t)
        seen |= keys
    return out


def dictionaries(toxic: list[str], ordinary: list[str]) -> Model:
    """A model with both dictionaries, and no weights yet."""
    count = [Counter(), Counter()]
    for k, texts in enumerate((ordinary, toxic)):
        for t in texts:
            count[k].update(spans_of(t))
    n_o, n_t = max(1, len(ordinary)), max(1, len(toxic))
    least = max(LEAST_DOCS, n_t * LEAST_SHARE)
    ratio = {s: n * n_o / ((count[0][s] + 0.5) * n_t) for s, n in count[1].items() if n >= least}
    telling = {s: count[1][s] / n_t * math.log(r) for s, r in ratio.items() if r >= (COMMON_RATIO if count[1][s] >= COMMON_SHARE * n_t else LEAST_RATIO)}
    picked, size = [], 0
    for s in sorted(shortest(telling, count[1]), key=lambda s: (-telling[s], s)):
        if size + len(s.encode()) <= TOXIC_BYTES:
            picked.append(s)
            size += len(s.encode())
    common = sorted((s for s in count[0] if s.endswith(" ")), key=lambda s: (-count[0][s], s))
    plain = "".join(common)[: ORDINARY_BYTES // 2].encode() if common else b" the "
    return Model(plain, trained(picked), np.zeros(HIGH - LOW + 2))


def fit(toxic: list[str], ordinary: list[str]) -> Model:
    """Dictionaries from one half of the sample, the curve from savings of the other half."""
    toxic, ordinary = without_copies(toxic), without_copies(ordinary)
    model = dictionaries(toxic[::2], ordinary[::2])
    savings = Savings(model)
    rows = [(t, 0.0) for t in ordinary[1::2] or ordinary] + [(t, 1.0) for t in toxic[1::2] or toxic]
    model.weights = _fit_curve(np.stack([savings.count(t) for t, _ in rows]), np.array([y for _, y in rows]))
    return model


def shortest(telling: dict[str, float], docs: Counter) -> list[str]:
    """Of a word and its beginnings, the longest one that no shorter beginning clearly outnumbers."""
    kept = []
    for s in telling:
        stem = s.strip()
        shorter = [f" {stem[:k]}" for k in PREFIXES if k < len(stem)]
        longer = [x for x in telling if x != s and x.startswith(s)] if not s.endswith(" ") else []
        if not any(docs[x] > 1.3 * docs[s] and x in telling for x in shorter) and not any(1.3 * docs[x] >= docs[s] for x in longer):
            kept.append(s)
    return kept


def trained(spans: list[str]) -> bytes:
    """The toxic dictionary: telling spans, the most telling last. It stands before the ordinary content, whose offsets stay the same."""
    return "".join(reversed(spans)).encode() or b"\0"


def fit_on(docs: DataFrame, labels: DataFrame, sample_docs: int = SAMPLE_DOCS) -> Model | None:
    """A model from labelled rows that aren't held out; None if a class has no row."""
    texts = labelled_texts(docs, labels, "toxic", sample_docs, ~held_out("doc_id", 3, 1))
    return fit(texts[1], texts[0]) if texts[0] and texts[1] else None


def score(docs: DataFrame, model: Model | None) -> DataFrame:
    """doc_id and score of each row of docs(doc_id, text)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        savings = Savings(model) if model else None
        for batch in batches:
            got = [model.score(savings.count(t)) if savings is not None else 0.0 for t in batch["text"]]
            yield pd.DataFrame({"doc_id": batch["doc_id"], "score": np.asarray(got, dtype=np.float64)}).astype({"doc_id": "Int64"})

    return docs.select(F.col("doc_id").cast("long"), F.coalesce(F.col("text"), F.lit("")).alias("text")).mapInPandas(run, "doc_id long, score double")


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scored = score(docs, fit_on(docs, table(spark, sf_dir, "labels")))
    return scored.select("doc_id", held_out("doc_id", 3, 1).alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


QUERIES = {"op3_toxicity": op3_toxicity}
ORACLE: dict[str, str] = {}
