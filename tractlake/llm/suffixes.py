"""Front-coded sorted suffix runs, and a loser tree that merges them without comparing a known common prefix again.

A suffix is a row of WIDTH bytes, closed with zeros where it is shorter; its length says how much of it counts.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import zstandard

WIDTH, LEFT = 50, 34


def shared_with_last(rows: np.ndarray) -> np.ndarray:
    """How many leading bytes each row has in common with the one before it."""
    out = np.zeros(len(rows), np.int64)
    if len(rows) > 1:
        other = rows[1:] != rows[:-1]
        out[1:] = np.where(other.any(1), other.argmax(1), rows.shape[1])
    return out


@dataclass
class Suffixes:
    """Suffixes, what stands left of each (nearest byte first), and where they stand: document, hash of its text, start of what stands left."""

    rows: np.ndarray
    length: np.ndarray
    left: np.ndarray
    left_length: np.ndarray
    doc: np.ndarray
    text: np.ndarray
    start: np.ndarray

    def __len__(self) -> int:
        return len(self.length)

    def take(self, at: np.ndarray) -> Suffixes:
        return Suffixes(*(x[at] for x in vars(self).values()))

    @staticmethod
    def joined(parts: list[Suffixes]) -> Suffixes:
        return Suffixes(*(np.concatenate(xs) for xs in zip(*(vars(p).values() for p in parts), strict=True)))

    def keys(self) -> tuple[np.ndarray, np.ndarray]:
        """Suffixes and left parts as byte strings that sort."""
        return np.ascontiguousarray(self.rows).view(f"S{WIDTH}").ravel(), np.ascontiguousarray(self.left).view(f"S{LEFT}").ravel()


def front_code(run: Suffixes) -> bytes:
    """A sorted run as compressed bytes: each suffix as the length it shares with the one before, and the rest of it."""
    shared = shared_with_last(run.rows)
    column = np.arange(WIDTH)
    tails = run.rows[(column >= shared[:, None]) & (column < run.length[:, None])]
    lefts = run.left[np.arange(LEFT) < run.left_length[:, None]]
    owners, owner = np.unique(np.stack([run.doc, run.text], 1), axis=0, return_inverse=True)
    head = np.array([len(run), len(owners)], "<u4")
    parts = (head, shared.astype("u1"), run.length.astype("u1"), run.left_length.astype("u1"), owner.ravel().astype("<u4"), run.start.astype("<u4"), owners.astype("<i8"), tails, lefts)
    return zstandard.ZstdCompressor(level=1, write_checksum=False).compress(b"".join(p.tobytes() for p in parts))


def read_run(blob: bytes) -> tuple[Suffixes, np.ndarray]:
    """A run, and the length that each suffix shares with the one before."""
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), np.uint8)
    n, m = raw[:8].view("<u4").tolist()
    shared, length, left_length = raw[8 : 8 + 3 * n].reshape(3, n).astype(np.int64)
    at = 8 + 3 * n
    owner, start = raw[at : at + 8 * n].copy().view("<u4").reshape(2, n).astype(np.int64)
    at += 8 * n
    owners = raw[at : at + 16 * m].copy().view("<i8").reshape(m, 2)
    at += 16 * m
    sizes = np.maximum(0, length - shared)
    column = np.arange(WIDTH)
    own = np.zeros((n, WIDTH), np.uint8)
    own[(column >= shared[:, None]) & (column < length[:, None])] = raw[at : at + int(sizes.sum())]
    source = np.where(column >= shared[:, None], np.arange(n)[:, None], 0)
    np.maximum.accumulate(source, axis=0, out=source)  # the last suffix that spelled this column out
    rows = np.take_along_axis(own, source, axis=0)
    left = np.zeros((n, LEFT), np.uint8)
    left[np.arange(LEFT) < left_length[:, None]] = raw[at + int(sizes.sum()) :]
    return Suffixes(rows, length, left, left_length, owners[owner, 0], owners[owner, 1], start), shared


def merge_runs(runs: list[tuple[Suffixes, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """The order of all suffixes of the runs, numbered run by run, and the length that each shares with the one before in that order.

    Every run keeps the length its front suffix shares with the last winner. Of two runs the one that shares more comes first,
    as both are not below the last winner; only if they share equally much are bytes compared, from there on.
    """
    k = 1
    while k < len(runs):
        k *= 2
    bases = np.cumsum([0, *(len(r) for r, _ in runs)]).tolist()
    texts = [r.rows.tobytes() for r, _ in runs]
    known = [s.tolist() for _, s in runs]
    sizes = [len(s) for s in known] + [0] * (k - len(runs))
    places = [0] * k
    fronts: list[bytes | None] = [t[:WIDTH] or None for t in texts] + [None] * (k - len(runs))
    shares, losers = [0] * k, [0] * k

    def beats(a: int, b: int) -> bool:
        """Whether run a comes before run b; the loser's share becomes the one with the winner."""
        x, y = fronts[a], fronts[b]
        if x is None or y is None:
            return x is not None
        s = shares[a]
        if s != shares[b]:
            return s > shares[b]
        p, q = int.from_bytes(x[s:], "big"), int.from_bytes(y[s:], "big")
        first = p <= q
        shares[b if first else a] = WIDTH - ((p ^ q).bit_length() + 7) // 8
        return first

    def play(node: int) -> int:
        if node >= k:
            return node - k
        a, b = play(2 * node), play(2 * node + 1)
        if beats(a, b):
            losers[node] = b
            return a
        losers[node] = a
        return b

    winner = play(1) if k > 1 else 0
    order, lengths = [], []
    for _ in range(bases[-1]):
        at = places[winner]
        order.append(bases[winner] + at)
        lengths.append(shares[winner])
        at += 1
        places[winner] = at
        if at < sizes[winner]:
            fronts[winner], shares[winner] = texts[winner][WIDTH * at : WIDTH * at + WIDTH], known[winner][at]
        else:
            fronts[winner] = None
        node = (winner + k) // 2
        while node:
            if beats(losers[node], winner):
                losers[node], winner = winner, losers[node]
            node //= 2
    return np.array(order, np.int64), np.array(lengths, np.int64)
