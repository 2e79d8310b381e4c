"""Quality rules by line sequence labelling.

A linear-chain conditional random field labels each line of a document content or boilerplate; Viterbi decoding finds the best
sequence, and the share of word characters in content lines decides. It is fitted in numpy on a bounded sample of labelled
documents. Only documents have labels, so those of their lines are latent: they start as the document's, then the model of each round says what
they are, leaning towards the document's label. Chains for the fit mix stretches of lines of many documents, as a page mixes content with
boilerplate, so transitions say how long a stretch lasts and not that a document is of one kind throughout. Two base rules (too few words; too
many words in repeated five-word windows) reject a document beforehand.

Defined results: a null text counts as empty and fails the base rules; without labelled rows of both kinds only the base rules
decide; lines without a word are never labelled; repeated rows are judged once each; extra columns are not looked at.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tractlake.llm.common import WORD_GAPS, labelled_docs, table, tidy, unused

#: Labelled documents of each kind that the model is fitted on: the bound of what reaches the driver.
SAMPLE_DOCS = 1000
#: Lines of a chain of the fit; stretches of a document that count in it, and lines of one at most.
CHAIN, STRETCHES, LONGEST_STRETCH = 64, 32, 8
#: Log odds that a line has its document's label, before it is looked at.
LEAN = 2.0
#: Least share of content among the word characters of a document that is kept.
LEAST_CONTENT = 0.5
LEAST_WORDS, WINDOW, MOST_REPEATED_PERCENT = 10, 5, 20
SYMBOLS = b"#*$%&|<>"
GAPS = WORD_GAPS.encode()
UPPER = bytes(range(65, 91))
LOWER = bytes(range(97, 123))
DIGITS = b"0123456789"
PLAIN = UPPER + LOWER + DIGITS + GAPS + bytes(range(128, 256))
MULTIPLIERS = np.array([0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F], dtype=np.uint64)
EPOCHS, RATE, RIDGE = (80, 30, 30), 0.15, 1e-3


def repeated_words(words: list[bytes], window: int = WINDOW) -> int:
    """Words that lie in a window of so many words found twice or more."""
    n = len(words) - window + 1
    if n < 2:
        return 0
    ids = np.fromiter(map(hash, words), dtype=np.int64, count=len(words)).view(np.uint64)
    with np.errstate(over="ignore"):
        ids = ids ^ (ids >> np.uint64(31))
        mixed = sum((ids[k : k + n] * MULTIPLIERS[k] for k in range(1, window)), ids[:n] * MULTIPLIERS[0])
    order = np.argsort(mixed, kind="stable")
    same = mixed[order][1:] == mixed[order][:-1]
    if not same.any():
        return 0
    twice = np.zeros(n, bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    covered = np.zeros(len(words) + 1, np.int64)
    np.add.at(covered, np.flatnonzero(twice), 1)
    np.add.at(covered, np.flatnonzero(twice) + window, -1)
    return int((np.cumsum(covered)[:-1] > 0).sum())


def counts_of(text: str) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.split()  # at the six ASCII gaps
    chars = len(text) - (len(raw) - len(raw.translate(None, GAPS)))
    lines = [x for x in text.split("\n") if x.strip(WORD_GAPS)]
    return len(words), chars, len(raw) - len(raw.translate(None, SYMBOLS)), len(lines) - len(set(lines)), repeated_words(words)


def line_features(lines: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Features of each line of one document, and its word characters."""
    seen: set[str] = set()
    rows, sizes = [], []
    for line in lines:
        raw = line.encode("utf-8", "surrogatepass")
        words = raw.split()
        n, size = len(words), max(1, len(raw))
        upper, lower = len(raw) - len(raw.translate(None, UPPER)), len(raw) - len(raw.translate(None, LOWER))
        digits = len(raw) - len(raw.translate(None, DIGITS))
        marks = len(raw.translate(None, PLAIN))
        rows.append(
            (
                1.0,
                upper / max(1, upper + lower),
                min(1.0, 4 * marks / size),
                min(1.0, (len(raw) - len(raw.translate(None, SYMBOLS))) / n),
                min(1.0, raw.count(b"!") / n),
                digits / size,
                1 - len(set(words)) / n,
                float(n < 4),
                float(raw.rstrip()[-1:] not in b".!?:\"')"),
                min(2.0, size / n / 8),
                float(line in seen),
            )
        )
        seen.add(line)
        sizes.append(size - (len(raw) - len(raw.translate(None, GAPS))))
    return np.array(rows).reshape(-1, FEATURES), np.array(sizes, dtype=np.float64)


FEATURES = 11


class LineField:
    """A linear-chain conditional random field with two labels: 0 boilerplate, 1 content."""

    def __init__(self, emit: np.ndarray, move: np.ndarray) -> None:
        self.emit, self.move = emit, move

    def decode(self, features: np.ndarray) -> np.ndarray:
        """The best label sequence, by Viterbi's recursion."""
        scores = (features @ self.emit).tolist()
        (a, b), (c, d) = self.move.tolist()
        best0, best1 = scores[0]
        back = []
        for s0, s1 in scores[1:]:
            from0 = 0 if best0 + a >= best1 + c else 1
            from1 = 0 if best0 + b > best1 + d else 1
            back.append((from0, from1))
            best0, best1 = (best0 + a if from0 == 0 else best1 + c) + s0, (best0 + b if from1 == 0 else best1 + d) + s1
        label = int(best1 >= best0)
        out = [label]
        for step in reversed(back):
            label = step[label]
            out.append(label)
        return np.array(out[::-1])

    def content_share(self, text: str) -> float:
        lines = [x for x in text.split("\n") if x.strip(WORD_GAPS)]
        if not lines:
            return 0.0
        features, sizes = line_features(lines)
        return float(sizes[self.decode(features) == 1].sum() / max(1.0, sizes.sum()))


def stretches(text: str) -> list[np.ndarray]:
    """The features of the lines of a document, looked at as a whole, in stretches of 1 to 8 lines; of long documents as many stretches as count, spread over all of it."""
    lines = [x for x in text.split("\n") if x.strip(WORD_GAPS)]
    if not lines:
        return []
    features, _ = line_features(lines)
    dice = np.random.default_rng(zlib.crc32(text.encode("utf-8", "surrogatepass")))
    ends = np.cumsum(dice.integers(1, LONGEST_STRETCH + 1, len(lines)))
    parts = np.split(features, ends[ends < len(lines)])
    return parts if len(parts) <= STRETCHES else [parts[k] for k in sorted(dice.permutation(len(parts))[:STRETCHES])]


def mixed(parts: list[np.ndarray], beliefs: list[np.ndarray], seed: int = 0) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Chains of CHAIN lines from the stretches of many documents in a random order: features, beliefs and which places are filled.

    A page has content beside boilerplate, so stretches of both kinds follow each other; the rarer kind comes up more often, until both have as many lines.
    """
    dice, kind = np.random.default_rng(seed), np.array([b[:, 1].mean() >= 0.5 for b in beliefs])
    sizes = np.array([len(p) for p in parts])
    order = []
    most = max(sizes[kind].sum(), sizes[~kind].sum())
    for some in (np.flatnonzero(kind), np.flatnonzero(~kind)):
        if len(some):
            order += np.tile(some, -(-most // sizes[some].sum()))[: int(len(some) * most / sizes[some].sum())].tolist()
    order = dice.permutation(order)
    x, q = np.concatenate([parts[k] for k in order]), np.concatenate([beliefs[k] for k in order])
    n = -(-len(x) // CHAIN)
    on = np.arange(n * CHAIN).reshape(n, CHAIN) < len(x)
    fill = lambda v: np.concatenate([v, np.zeros((n * CHAIN - len(v), v.shape[1]))]).reshape(n, CHAIN, -1)
    return fill(x), fill(q), on


def marginals(scores: np.ndarray, move: np.ndarray, on: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of chains side by side the probabilities of each line's label and of each pair of neighbours, by the forward-backward recursion."""
    n, longest = on.shape
    forward, backward = np.zeros((n, longest, 2)), np.zeros((n, longest, 2))
    forward[:, 0] = scores[:, 0]
    for t in range(1, longest):
        forward[:, t] = np.where(on[:, t, None], np.logaddexp(forward[:, t - 1, :1] + move[0], forward[:, t - 1, 1:] + move[1]) + scores[:, t], forward[:, t - 1])
    for t in range(longest - 2, -1, -1):
        ahead = scores[:, t + 1] + backward[:, t + 1]
        backward[:, t] = np.where(on[:, t + 1, None], np.logaddexp(move[:, 0] + ahead[:, :1], move[:, 1] + ahead[:, 1:]), 0)
    total = np.logaddexp(forward[:, -1, 0], forward[:, -1, 1])
    node = np.exp(forward + backward - total[:, None, None]) * on[..., None]
    pair = np.exp(forward[:, :-1, :, None] + move + (scores + backward)[:, 1:, None, :] - total[:, None, None, None]) * on[:, 1:, None, None]
    return node, pair


def climb(model: LineField, x: np.ndarray, q: np.ndarray, on: np.ndarray, epochs: int) -> LineField:
    """Adam on the mean conditional log likelihood of what is believed of the labels, with exact gradients."""
    emit, move = model.emit.copy(), model.move.copy()
    moments = [np.zeros_like(p) for p in (emit, emit, move, move)]
    pair_truth = np.einsum("ntj,ntk->ntjk", q[:, :-1], q[:, 1:]) * on[:, 1:, None, None]
    for step in range(1, epochs + 1):
        node, pair = marginals(x @ emit, move, on)
        grads = (np.einsum("ntf,ntj->fj", x, q - node) / on.sum() - RIDGE * emit, (pair_truth - pair).sum((0, 1)) / on.sum() - RIDGE * move)
        for p, g, at in ((emit, grads[0], 0), (move, grads[1], 2)):
            moments[at] = 0.9 * moments[at] + 0.1 * g
            moments[at + 1] = 0.99 * moments[at + 1] + 0.01 * g**2
            p += RATE * (moments[at] / (1 - 0.9**step)) / (np.sqrt(moments[at + 1] / (1 - 0.99**step)) + 1e-8)
    return LineField(emit, move)


def believed(model: LineField, parts: list[np.ndarray], good: list[int]) -> list[np.ndarray]:
    """What the lines of stretches are, given the model and that most lines of a good document are content and of a bad one boilerplate."""
    longest = max(map(len, parts))
    x, on = np.zeros((len(parts), longest, FEATURES)), np.zeros((len(parts), longest), bool)
    for k, p in enumerate(parts):
        x[k, : len(p)], on[k, : len(p)] = p, True
    lean = np.where(np.array(good)[:, None, None] == 1, np.array([-LEAN, LEAN]) / 2, np.array([LEAN, -LEAN]) / 2)
    node, _ = marginals(x @ model.emit + lean, model.move, on)
    return [node[k, : len(p)] for k, p in enumerate(parts)]


def fit(parts: list[np.ndarray], good: list[int]) -> LineField:
    """Labels of lines are latent: they start as their document's, and in each round what is believed of them comes from the model of the round before."""
    beliefs = [np.tile(np.eye(2)[y], (len(p), 1)) for p, y in zip(parts, good, strict=True)]
    model = LineField(np.zeros((FEATURES, 2)), np.zeros((2, 2)))
    for k, epochs in enumerate(EPOCHS):
        if k:
            beliefs = believed(model, parts, good)
        model = climb(model, *mixed(parts, beliefs), epochs)
    return model


def fit_on(docs: DataFrame, labels: DataFrame, sample_docs: int = SAMPLE_DOCS) -> LineField | None:
    """A model from labelled documents; None if either kind is missing. Whole texts become features in tasks; STRETCHES of each document reach the driver at most."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [(d, y, k, f.astype(np.float64).tobytes()) for d, y, t in zip(batch["doc_id"], batch["label"], batch["text"], strict=True) for k, f in enumerate(stretches(t))]
            yield pd.DataFrame(rows, columns=["doc_id", "label", "k", "features"])

    found = labelled_docs(docs, labels, "quality", sample_docs).select(F.col("doc_id").cast("long"), "label", "text").mapInPandas(tidy(run), "doc_id long, label int, k int, features binary")
    rows = found.orderBy("label", F.xxhash64("doc_id"), "doc_id", "k").collect()
    if {r["label"] for r in rows} != {0, 1}:
        return None
    return fit([np.frombuffer(r["features"], np.float64).reshape(-1, FEATURES) for r in rows], [r["label"] for r in rows])


def judge(docs: DataFrame, model: LineField | None) -> DataFrame:
    """The counts of each row of docs(doc_id, text), base_failed, content_share and kept."""
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for text in batch["text"]:
                counts = counts_of(text)
                failed = counts[0] < LEAST_WORDS or 100 * counts[4] > MOST_REPEATED_PERCENT * counts[0]
                share = model.content_share(text) if model else 1.0
                rows.append((*counts, failed, share, not failed and share >= LEAST_CONTENT))
            out = pd.DataFrame(rows, columns=[*names, "base_failed", "content_share", "kept"])
            out.insert(0, "doc_id", batch["doc_id"].to_numpy())
            yield out.astype({"doc_id": "Int64"})

    schema = "doc_id long, " + ", ".join(f"{x} long" for x in names) + ", base_failed boolean, content_share double, kept boolean"
    return docs.select(F.col("doc_id").cast("long"), F.coalesce(F.col("text"), F.lit("")).alias("text")).mapInPandas(tidy(run), schema)


def keep_good(docs: DataFrame, model: LineField | None) -> DataFrame:
    """The rows of docs that are kept, all columns as they are."""
    names = docs.columns
    (whole,) = unused(docs, "whole")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            kept = []
            for text in batch[whole]:
                n, *_, repeated = counts_of(text)
                kept.append(n >= LEAST_WORDS and 100 * repeated <= MOST_REPEATED_PERCENT * n and (model is None or model.content_share(text) >= LEAST_CONTENT))
            yield batch.loc[np.array(kept, dtype=bool), names]

    return docs.withColumn(whole, F.coalesce(F.col("text"), F.lit(""))).mapInPandas(tidy(run), docs.schema)


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return judge(docs, fit_on(docs, table(spark, sf_dir, "labels")))


QUERIES = {"op9_quality": op9_quality}
ORACLE: dict[str, str] = {}
