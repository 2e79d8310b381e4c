"""Vectorised word and shingle hashes, shared by the operators that compare texts by their words."""

from __future__ import annotations

import numpy as np

from tractlake.llm.common import WORD_GAPS

BASE = np.uint64(0x9E3779B97F4A7C15)
BASE_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
STEPS = np.array([0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB], dtype=np.uint64)
GAP_BYTES = np.zeros(256, bool)
GAP_BYTES[list(WORD_GAPS.encode())] = True
LOWER_ASCII = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))

_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE and its inverse to the powers 0 to n - 1, modulo 2**64."""
    if len(_powers[0]) < n:
        for k, base in enumerate((BASE, BASE_INVERSE)):
            steps = np.full(2 * n, base, np.uint64)
            steps[0] = 1
            _powers[k] = np.multiply.accumulate(steps)
    return _powers[0][:n], _powers[1][:n]


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads 64-bit values over all bits, one to one."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def prefix_sums(raw: np.ndarray) -> np.ndarray:
    """Sums that give the hash of any stretch of bytes by one subtraction."""
    out = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * powers(len(raw))[0], out=out[1:])
    return out


def stretch_hashes(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes of the stretches [start, end), equal for equal bytes wherever they stand."""
    inverse = powers(len(sums))[1]
    return mix((sums[ends] - sums[starts]) * inverse[starts] + (ends - starts).astype(np.uint64) * STEPS[0])


def word_bounds(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the words of some bytes start, and where each ends."""
    gap = GAP_BYTES[raw]
    edges = np.diff(np.concatenate(([1], gap.view(np.int8), [1])))
    return np.flatnonzero(edges == -1), np.flatnonzero(edges == 1)


def word_hashes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of all texts, A-Z lower-cased, and where each text's words begin (one more at the end)."""
    blobs = [t.encode("utf-8", "surrogatepass").translate(LOWER_ASCII) for t in texts]
    raw = np.frombuffer(b" ".join(blobs) + b" ", np.uint8)
    starts, ends = word_bounds(raw)
    with np.errstate(over="ignore"):
        words = stretch_hashes(prefix_sums(raw), starts, ends)
    text_ends = np.cumsum([len(b) + 1 for b in blobs])
    return words, np.concatenate(([0], np.searchsorted(starts, text_ends)))


def shingle_sets(texts: list[str], width: int = 5) -> list[np.ndarray]:
    """The set of each text as sorted distinct 64-bit hashes: of runs of `width` words, or of all words if there are fewer."""
    words, first = word_hashes(texts)
    with np.errstate(over="ignore"):
        n = max(0, len(words) - width + 1)
        runs = mix(sum((words[k : k + n] * STEPS[k] for k in range(1, width)), words[:n] * STEPS[0])) if n else words[:0]
        out = []
        for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
            if b - a >= width:
                out.append(np.unique(runs[a : b - width + 1]))
            elif b > a:
                out.append(mix(np.array([(words[a:b] * STEPS[: b - a]).sum() + np.uint64(b - a)], np.uint64)))
            else:
                out.append(np.zeros(0, np.uint64))
    return out
