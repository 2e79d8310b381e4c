"""A small causal self-attention language model in numpy.

One attention layer over windows of WINDOW subword ids, then a two-level softmax: the FREQUENT commonest ids in classes of CLASS_SIZE,
and one more class for all other ids, within which an id has its smoothed share of the training ids. So the
probabilities of all ids sum to one, and a score costs two short softmaxes.

The logits are the sum of what the layers say and of the smoothed logarithms of how often each id follows the last one in training
(Pairs), so that training starts from the best guess by the last id alone and learns what the rest of the window tells.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

WINDOW, OVERLAP = 32, 6
WIDTH, HIDDEN = 16, 32
FREQUENT, CLASS_SIZE, RARE_INPUTS = 2048, 64, 64
CLASSES = FREQUENT // CLASS_SIZE + 1
BATCH = 256
SHAPES = {
    "token": (FREQUENT + RARE_INPUTS + 1, WIDTH),
    "place": (WINDOW, WIDTH),
    "query": (WIDTH, WIDTH),
    "key": (WIDTH, WIDTH),
    "value": (WIDTH, WIDTH),
    "out": (WIDTH, WIDTH),
    "up": (WIDTH, HIDDEN),
    "down": (HIDDEN, WIDTH),
    "class": (WIDTH, CLASSES),
    "class_bias": (CLASSES,),
    "member": (CLASSES - 1, WIDTH, CLASS_SIZE),
    "member_bias": (CLASSES - 1, CLASS_SIZE),
}
INPUTS = FREQUENT + RARE_INPUTS + 1
CAUSAL = np.tril(np.ones((WINDOW, WINDOW), np.float32))
ONES = np.ones((WINDOW, 1), np.float32)
MEMBERS = np.ones(CLASS_SIZE, np.float32)
START_SLOT = FREQUENT + RARE_INPUTS

Params = dict[str, np.ndarray]


@dataclass
class Vocabulary:
    """Slots of ids: 0 to FREQUENT - 1 for the commonest, and the log share of every other id among the others."""

    slot: np.ndarray
    rare_log10: np.ndarray

    @staticmethod
    def of(counts: np.ndarray, always: int) -> Vocabulary:
        """From the count of each id in training; the id `always` is a frequent one in any case."""
        order = np.lexsort((np.arange(len(counts)), -counts))
        order = np.concatenate(([always], order[order != always]))
        slot = np.full(len(counts), -1, np.int32)
        slot[order[:FREQUENT]] = np.arange(min(FREQUENT, len(counts)))
        rare = np.where(slot < 0, counts + 1.0, 0.0)
        return Vocabulary(slot, np.log10(np.where(rare > 0, rare, 1) / max(1.0, rare.sum())))

    def inputs(self, ids: np.ndarray) -> np.ndarray:
        slot = self.slot[ids]
        return np.where(slot < 0, FREQUENT + ids % RARE_INPUTS, slot)


@dataclass
class Pairs:
    """For each input slot the logarithms of the shares of classes, and of ids in their class, that follow it."""

    classes: np.ndarray
    members: np.ndarray

    @staticmethod
    def of(followers: np.ndarray) -> Pairs:
        """From how often each target (a slot, or FREQUENT for another id) follows each input slot."""
        return Pairs.smoothed(followers, Pairs.shares((followers > 0).sum(0)))

    @staticmethod
    def shares(followed: np.ndarray) -> np.ndarray:
        """The share of each target by how many different slots it follows, and one half more each."""
        alone = followed + 0.5
        return alone / alone.sum()

    @staticmethod
    def smoothed(followers: np.ndarray, alone: np.ndarray) -> Pairs:
        """Witten and Bell's smoothing by the shares `alone`, each row by itself: followers may be any rows of the whole table."""
        kinds = (followers > 0).sum(1, keepdims=True) + 1.0
        joint = (followers + kinds * alone) / (followers.sum(1, keepdims=True) + kinds)
        inside = joint[:, :FREQUENT].reshape(len(joint), CLASSES - 1, CLASS_SIZE)
        sums = inside.sum(2)
        members = np.log(inside / sums[:, :, None]).reshape(len(joint), FREQUENT)
        return Pairs(np.log(np.concatenate((sums, joint[:, FREQUENT:]), 1)).astype(np.float32), members.astype(np.float32))


def pairs_in(inputs: np.ndarray, slots: np.ndarray) -> np.ndarray:
    """The number of each pair of an input slot and the target that follows it."""
    return inputs.astype(np.int64) * (FREQUENT + 1) + np.where(slots < 0, FREQUENT, slots)


def pair_counts(inputs: np.ndarray, slots: np.ndarray) -> np.ndarray:
    """How often each target follows each input slot."""
    return np.bincount(pairs_in(inputs, slots), minlength=INPUTS * (FREQUENT + 1)).reshape(INPUTS, FREQUENT + 1)


def initial(seed: int = 7) -> Params:
    """Small random weights; the softmaxes start from the pairs alone."""
    dice = np.random.default_rng(seed)
    params = {k: (dice.standard_normal(s) * (0.3 if k in ("token", "place") else 1 / np.sqrt(s[-2] if len(s) > 1 else 1)) * (0.1 if k in ("down", "out") else 1)).astype(np.float32) for k, s in SHAPES.items()}
    for k in ("class", "class_bias", "member", "member_bias"):
        params[k] *= np.float32(0)
    return params


def windows_of(lengths: np.ndarray, overlap: int = OVERLAP) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Positions (windows x WINDOW) into the concatenated targets, which of them exist, and which of them a window scores.

    Windows step by WINDOW - overlap; all but the first leave the first `overlap` targets to the window before, so that each
    target is scored once.
    """
    step = WINDOW - overlap
    many = np.where(lengths <= WINDOW, 1, 1 + -(-(lengths - WINDOW) // step))
    many = np.where(lengths == 0, 0, many)
    base = np.concatenate(([0], np.cumsum(lengths)[:-1]))
    owner = np.repeat(np.arange(len(lengths)), many)
    nth = np.arange(len(owner)) - np.repeat(np.cumsum(many) - many, many)
    local = nth[:, None] * step + np.arange(WINDOW)[None, :]
    exists = local < lengths[owner][:, None]
    scored = exists & ((nth[:, None] == 0) | (np.arange(WINDOW)[None, :] >= overlap))
    return np.minimum(base[owner][:, None] + local, max(0, int(lengths.sum()) - 1)), exists, scored


def attend(p: Params, x_in: np.ndarray, for_gradient: bool = False) -> dict[str, np.ndarray]:
    """Masked attention over a batch of windows of input slots, with what the gradients need."""
    x = p["token"][x_in] + p["place"]
    n = len(x)
    flat = x.reshape(-1, WIDTH)
    q, k, v = ((flat @ p[w]).reshape(n, WINDOW, WIDTH) for w in ("query", "key", "value"))
    q *= np.float32(WIDTH**-0.5)
    weights = q @ k.transpose(0, 2, 1)
    np.minimum(weights, np.float32(60), out=weights)
    np.exp(weights, out=weights)
    weights *= CAUSAL
    if for_gradient:
        weights /= weights.sum(-1, keepdims=True)
        z = weights @ v
    else:
        z = weights @ v
        z /= (weights @ ONES)
    mid = flat + z.reshape(-1, WIDTH) @ p["out"]
    up = mid @ p["up"]
    np.maximum(up, 0, out=up)
    return {"x": x, "q": q, "k": k, "v": v, "weights": weights, "z": z, "mid": mid, "up": up, "top": mid + up @ p["down"]}


def log_probabilities(p: Params, pairs: Pairs, top: np.ndarray, last: np.ndarray, slot: np.ndarray, want_gradient: bool = False):
    """Natural log of the two softmaxes at each row of top, after the input slot last, for its target slot (-1: one of the other ids), and gradients."""
    cls = np.where(slot < 0, CLASSES - 1, slot // CLASS_SIZE)
    logits = top @ p["class"]
    logits += p["class_bias"]
    logits += pairs.classes[last]
    np.minimum(logits, np.float32(80), out=logits)
    np.exp(logits, out=logits)
    total = logits @ np.ones(CLASSES, np.float32)
    rows = np.arange(len(top))
    chosen = np.maximum(logits[rows, cls] / total, np.float32(1e-30))
    order = np.argsort(cls.astype(np.uint8), kind="stable")
    bounds = np.searchsorted(cls[order], np.arange(CLASSES + 1)).tolist()
    grads: Params = {}
    d_top = None
    if want_gradient:
        d = logits / total[:, None]
        d[rows, cls] -= 1
        grads = {"class": top.T @ d, "class_bias": d.sum(0), "member": np.zeros_like(p["member"]), "member_bias": np.zeros_like(p["member_bias"])}
        d_top = d @ p["class"].T
    for c in range(CLASSES - 1):
        a, b = bounds[c], bounds[c + 1]
        if a == b:
            continue
        here = order[a:b]
        h = top[here]
        inner = h @ p["member"][c]
        inner += p["member_bias"][c]
        inner += pairs.members[last[here], c * CLASS_SIZE : (c + 1) * CLASS_SIZE]
        np.minimum(inner, np.float32(80), out=inner)
        np.exp(inner, out=inner)
        sums = inner @ MEMBERS
        within = slot[here] - c * CLASS_SIZE
        chosen[here] *= np.maximum(inner[rows[: b - a], within] / sums, np.float32(1e-7))
        if want_gradient:
            d = inner / sums[:, None]
            d[rows[: b - a], within] -= 1
            grads["member"][c] = h.T @ d
            grads["member_bias"][c] = d.sum(0)
            d_top[here] += d @ p["member"][c].T
    out = np.log(chosen)
    return (out, d_top, grads) if want_gradient else out


def gradients(p: Params, pairs: Pairs, x_in: np.ndarray, slot: np.ndarray, exists: np.ndarray) -> tuple[float, Params]:
    """Mean negative log probability over the existing targets, and its gradient."""
    s = attend(p, x_in, True)
    on = np.flatnonzero(exists.ravel())
    logp, d_on, g = log_probabilities(p, pairs, s["top"][on], x_in.ravel()[on], slot.ravel()[on], True)
    d_top = np.zeros_like(s["top"])
    d_top[on] = d_on
    n = len(x_in)
    g["down"] = s["up"].T @ d_top
    d_up = (d_top @ p["down"].T) * (s["up"] > 0)
    g["up"] = s["mid"].T @ d_up
    d_mid = d_top + d_up @ p["up"].T
    g["out"] = s["z"].reshape(-1, WIDTH).T @ d_mid
    d_z = (d_mid @ p["out"].T).reshape(n, WINDOW, WIDTH)
    d_w = d_z @ s["v"].transpose(0, 2, 1)
    d_v = s["weights"].transpose(0, 2, 1) @ d_z
    d_s = s["weights"] * (d_w - (d_w * s["weights"]).sum(-1, keepdims=True))
    d_q, d_k = d_s @ s["k"] * np.float32(WIDTH**-0.5), d_s.transpose(0, 2, 1) @ s["q"]  # q is scaled already
    flat = s["x"].reshape(-1, WIDTH)
    d_x = d_mid.copy()
    for name, d in (("query", d_q), ("key", d_k), ("value", d_v)):
        d = d.reshape(-1, WIDTH)
        g[name] = flat.T @ d
        d_x += d @ p[name].T
    g["place"] = d_x.reshape(n, WINDOW, WIDTH).sum(0)
    g["token"] = np.stack([np.bincount(x_in.ravel(), weights=d_x[:, j], minlength=len(p["token"])) for j in range(WIDTH)], 1)
    scale = np.float32(1 / max(1, len(on)))
    return float(-logp.mean()), {k: (v * scale).astype(np.float32) for k, v in g.items()}


def train(params: Params, pairs: Pairs, x_in: np.ndarray, slot: np.ndarray, exists: np.ndarray, rate: float = 0.01, batch: int = 128, seed: int = 1) -> Params:
    """One pass of Adam over shuffled windows, the rate falling to a tenth."""
    p = {k: v.copy() for k, v in params.items()}
    m = {k: np.zeros_like(v) for k, v in p.items()}
    v2 = {k: np.zeros_like(v) for k, v in p.items()}
    order = np.random.default_rng(seed).permutation(len(x_in))
    steps = -(-len(order) // batch)
    for t in range(steps):
        pick = order[t * batch : (t + 1) * batch]
        _, g = gradients(p, pairs, x_in[pick], slot[pick], exists[pick])
        now = rate * (1 - 0.9 * t / steps)
        for k in p:
            m[k] = 0.9 * m[k] + 0.1 * g[k]
            v2[k] = 0.98 * v2[k] + 0.02 * g[k] ** 2
            p[k] -= np.float32(now) * (m[k] / np.float32(1 - 0.9 ** (t + 1))) / (np.sqrt(v2[k] / np.float32(1 - 0.98 ** (t + 1))) + np.float32(1e-8))
    return p


def framed(texts: list[np.ndarray], end: int, vocabulary: Vocabulary) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Lengths, input slots and target ids of texts of ids: each text closed by the end id, its inputs one place behind."""
    lengths = np.array([len(t) + 1 for t in texts])
    targets = np.concatenate([np.append(t.astype(np.int64), end) for t in texts]) if texts else np.zeros(0, np.int64)
    inputs = np.concatenate(([START_SLOT], vocabulary.inputs(targets[:-1]))) if len(targets) else targets
    inputs[np.concatenate(([0], np.cumsum(lengths)[:-1])).astype(np.int64)] = START_SLOT
    return lengths, inputs, targets


def score(params: Params, pairs: Pairs, vocabulary: Vocabulary, texts: list[np.ndarray], end: int) -> np.ndarray:
    """log10 probability of each text of ids, its end included."""
    if not texts:
        return np.zeros(0)
    lengths, inputs, targets = framed(texts, end, vocabulary)
    at, _, scored = windows_of(lengths)
    slots, rare = vocabulary.slot[targets], vocabulary.rare_log10[targets]
    each = np.where(slots < 0, rare, 0.0)
    for k in range(0, len(at), BATCH):
        part, on = at[k : k + BATCH], scored[k : k + BATCH].ravel()
        places = part.ravel()[on]
        each[places] += log_probabilities(params, pairs, attend(params, inputs[part])["top"][on], inputs[places], slots[places]) / np.log(10)
    return np.add.reduceat(each, np.concatenate(([0], np.cumsum(lengths)[:-1])))
