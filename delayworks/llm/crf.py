"""Linear-chain conditional random field with two labels: exact marginals and fitting in numpy.

A batch of sequences is one long chain whose transitions are cut at the starts. With two labels the forward message is
one number, the odds of label 1, and a step maps it by a fractional linear function. Those functions compose, so the
chain is cut into equal blocks: all blocks compose their steps side by side, the block products are chained, and a second
sweep inside the blocks gives every message. Cost is linear, memory is a few arrays of the chain's length, and a sequence
may be as long as it likes.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

CLIP = 30.0


@dataclass
class Chain:
    """Fitted weights. ``emission[slot]`` holds the log odds of label 1 for each value of that feature slot."""

    emission: list[np.ndarray]
    bias: float
    start: float
    trans: np.ndarray  # log scores, [from, to]

    def logits(self, features: list[np.ndarray]) -> np.ndarray:
        total = np.full(len(features[0]), self.bias)
        for weights, values in zip(self.emission, features):
            total += weights[values]
        return total

    def marginals(self, features: list[np.ndarray], starts: np.ndarray) -> np.ndarray:
        if not len(starts):
            return np.zeros(0)
        logits = self.logits(features)
        ahead, behind = messages(logits, starts, self.start, self.trans)
        odds = ahead * behind
        return odds / (1.0 + odds)


def _sweep(a, b, c, d, first):
    """Values x_t = (a_t + b_t x_{t-1}) / (c_t + d_t x_{t-1}) for all t, with x_{-1} = ``first``."""
    n = len(a)
    width = max(1, int(np.sqrt(n / 4)))
    blocks = -(-n // width)
    pad = blocks * width - n

    def shaped(x, fill):
        return np.ascontiguousarray(np.concatenate([x, np.full(pad, fill)]).reshape(blocks, width).T)

    a, b, c, d = shaped(a, 0.0), shaped(b, 1.0), shaped(c, 1.0), shaped(d, 0.0)
    # a step as a matrix on (x, 1): [[b, a], [d, c]]
    pb, pa, pd, pc = np.ones(blocks), np.zeros(blocks), np.zeros(blocks), np.ones(blocks)
    for t in range(width):
        pb, pa, pd, pc = b[t] * pb + a[t] * pd, b[t] * pa + a[t] * pc, d[t] * pb + c[t] * pd, d[t] * pa + c[t] * pc
        if t % 4 == 3:
            scale = 1.0 / np.maximum(np.maximum(pa, pb), np.maximum(pc, pd))
            pa, pb, pc, pd = pa * scale, pb * scale, pc * scale, pd * scale
    enter = np.empty(blocks)
    x = first
    for k, (ka, kb, kc, kd) in enumerate(zip(pa.tolist(), pb.tolist(), pc.tolist(), pd.tolist())):
        enter[k] = x
        x = (ka + kb * x) / (kc + kd * x)
    out = np.empty((width, blocks))
    x = enter
    for t in range(width):
        x = (a[t] + b[t] * x) / (c[t] + d[t] * x)
        out[t] = x
    return out.T.reshape(-1)[:n]


def messages(logits: np.ndarray, starts: np.ndarray, start: float, trans: np.ndarray):
    """Forward odds (own evidence included) and backward odds at every position."""
    gain = np.exp(np.clip(logits, -CLIP, CLIP))
    t = np.exp(np.clip(trans - trans.max(), -CLIP, 0))
    a, b = gain * t[0, 1], gain * t[1, 1]
    c, d = np.full(len(gain), t[0, 0]), np.full(len(gain), t[1, 0])
    a[starts], b[starts] = gain[starts] * np.exp(np.clip(start, -CLIP, CLIP)), 0.0
    c[starts], d[starts] = 1.0, 0.0
    ahead = _sweep(a, b, c, d, 1.0)
    # backward: s_t = (t10 + t11 u) / (t00 + t01 u), u = gain_{t+1} s_{t+1}; 1 where a sequence ends
    n = len(gain)
    follows = np.empty(n)
    follows[:-1], follows[-1] = gain[1:], 1.0
    a, b = np.full(n, t[1, 0]), t[1, 1] * follows
    c, d = np.full(n, t[0, 0]), t[0, 1] * follows
    ends = np.zeros(n, bool)
    ends[:-1], ends[-1] = starts[1:], True
    a[ends], b[ends], c[ends], d[ends] = 1.0, 0.0, 1.0, 0.0
    behind = _sweep(a[::-1], b[::-1], c[::-1], d[::-1], 1.0)[::-1]
    return ahead, behind


def fit(features: list[np.ndarray], sizes: list[int], labels: np.ndarray, starts: np.ndarray, weight: np.ndarray | None = None,
        rounds: int = 80, ridge: float = 1e-3, rate: float = 0.15) -> Chain:
    """Maximum-likelihood weights by full-batch gradient steps (Adam). ``weight`` scales the loss of whole sequences."""
    n = len(labels)
    weight = np.ones(n) if weight is None else weight
    total = weight.sum()
    if not n or not total:
        return Chain([np.zeros(s) for s in sizes], 0.0, 0.0, np.zeros((2, 2)))
    edges = np.cumsum([0, *sizes])
    theta = np.zeros(edges[-1] + 6)
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    inner = ~starts
    y = labels.astype(float)
    before = np.concatenate([[0.0], y[:-1]])
    seen = np.array([(w * (p == i) * (q == j)).sum() for i in (0, 1) for j in (0, 1)
                     for w, p, q in [(weight[inner], before[inner], y[inner])]])

    def chain() -> Chain:
        return Chain([theta[edges[k]:edges[k + 1]] for k in range(len(sizes))], theta[-6], theta[-5], theta[-4:].reshape(2, 2))

    for step in range(1, rounds + 1):
        model = chain()
        logits = model.logits(features)
        ahead, behind = messages(logits, starts, model.start, model.trans)
        p = ahead * behind / (1.0 + ahead * behind)
        gap = weight * (y - p)
        grad = np.zeros_like(theta)
        for k, size in enumerate(sizes):
            grad[edges[k]:edges[k + 1]] = np.bincount(features[k], gap, minlength=size)
        grad[-6], grad[-5] = gap.sum(), gap[starts].sum()
        # pair marginals: forward of the left place, transition, evidence and backward of the right place
        left = np.concatenate([[1.0], ahead[:-1]])[inner]
        right = (np.exp(np.clip(logits, -CLIP, CLIP)) * behind)[inner]
        t = np.exp(model.trans - model.trans.max())
        pair = np.stack([np.full(len(left), t[0, 0]), t[0, 1] * right, t[1, 0] * left, t[1, 1] * left * right])
        pair *= weight[inner] / pair.sum(axis=0)
        grad[-4:] = seen - pair.sum(axis=1)
        grad = grad / total - ridge * theta / max(1.0, total ** 0.5)
        m, v = 0.9 * m + 0.1 * grad, 0.99 * v + 0.01 * grad ** 2
        theta += rate * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.99 ** step)) + 1e-9)
    return chain()


def logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray | None = None, rounds: int = 30, ridge: float = 1e-2) -> tuple[float, float]:
    """Slope and intercept of a one-variable logistic regression (Newton steps)."""
    w = np.ones(len(x)) if weight is None else weight
    design, beta = np.stack([x, np.ones(len(x))], axis=1), np.array([1.0, 0.0])
    prior = beta.copy()
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(design @ beta, -CLIP, CLIP)))
        grad = design.T @ (w * (y - p)) - ridge * (beta - prior)
        hess = (design * (w * p * (1 - p))[:, None]).T @ design + ridge * np.eye(2)
        beta = beta + np.clip(np.linalg.solve(hess, grad), -2, 2)
    return float(beta[0]), float(beta[1])
