"""Learning a partition of vectors from a bounded sample: balanced pieces of its neighbour graph, and a small network
that names the likely pieces of any vector. All of it works on the sample's rows only."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

HIDDEN = 128         # width of the classifier's only hidden layer
EPOCHS, BATCH, RATE = 8, 256, 3e-3
SMOOTHING, ROUNDS = 60, 30


def _bisect(a: np.ndarray, b: np.ndarray, n: int, first: int, rng: np.random.Generator) -> np.ndarray:
    """Two sides (False, True) of a graph with edges a[i]-b[i], exactly ``first`` nodes on the first, few edges between.

    A random vector is smoothed over the graph until neighbours agree, which leaves its slowest direction; the
    order along it gives the sides, and pairs of nodes that both gain are then exchanged.
    """
    degree = np.maximum(np.bincount(a, minlength=n), 1).astype(float)
    x = rng.standard_normal(n)
    for _ in range(SMOOTHING):
        x -= (x * degree).sum() / degree.sum()
        x = 0.5 * x + 0.5 * np.bincount(a, weights=x[b], minlength=n) / degree
        x /= max(np.abs(x).max(), 1e-300)
    side = np.ones(n, bool)
    side[np.argsort(x, kind="stable")[:first]] = False
    for _ in range(ROUNDS):
        other = np.bincount(a, weights=(side[a] != side[b]), minlength=n)
        gain = 2 * other - np.bincount(a, minlength=n) + rng.random(n) * 0.5
        left, right = np.flatnonzero(~side), np.flatnonzero(side)
        left, right = left[np.argsort(-gain[left])], right[np.argsort(-gain[right])]
        m = min(len(left), len(right))
        good = int((gain[left[:m]] + gain[right[:m]] > 1.0).sum())  # sums fall, so these are the first
        if not good:
            break
        swap = max(1, good // 2)   # half of them: nodes that move together change each other's gain
        side[left[:swap]], side[right[:swap]] = True, False
    return side


def balanced_pieces(neighbours: np.ndarray, pieces: int, seed: int = 1) -> np.ndarray:
    """The piece of every node of the graph whose i-th node is joined to ``neighbours[i]`` (-1: none); sizes differ by
    one at most, by halving and halving again."""
    n, k = neighbours.shape
    rng = np.random.default_rng(seed)
    a, b = np.repeat(np.arange(n), k), neighbours.ravel()
    a, b = a[b >= 0], b[b >= 0]
    a, b = np.concatenate([a, b]), np.concatenate([b, a])
    out = np.zeros(n, np.int64)
    work = [(np.arange(n), a, b, 0, pieces)]
    while work:
        nodes, a, b, low, count = work.pop()
        if count == 1 or len(nodes) == 0:
            out[nodes] = low
            continue
        half = count // 2
        side = _bisect(a, b, len(nodes), len(nodes) * half // count, rng)
        place = np.where(side, np.cumsum(side), np.cumsum(~side)) - 1
        for s, at, c in ((False, low, half), (True, low + half, count - half)):
            inside = (side[a] == s) & (side[b] == s)
            work.append((nodes[side == s], place[a[inside]], place[b[inside]], at, c))
    return out


@dataclass(frozen=True)
class Router:
    """One hidden layer from a vector to the chances of the pieces."""
    centre: np.ndarray
    width: np.ndarray
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: np.ndarray

    def scores(self, x: np.ndarray) -> np.ndarray:
        h = np.maximum(((x - self.centre) / self.width).astype(np.float32) @ self.w1 + self.b1, 0)
        return h @ self.w2 + self.b2

    def likeliest(self, x: np.ndarray, m: int) -> np.ndarray:
        """The m likeliest pieces of every row, likeliest first."""
        return np.argsort(-self.scores(x), axis=1, kind="stable")[:, :m]


def train_router(x: np.ndarray, target: np.ndarray, seed: int = 1) -> Router:
    """Cross-entropy to the rows of ``target`` (shares of the pieces among a row's neighbours), by Adam."""
    rng = np.random.default_rng(seed)
    n, d = x.shape
    centre, width = x.mean(axis=0), x.std(axis=0)
    width = np.where(width > 0, width, 1.0)
    z = ((x - centre) / width).astype(np.float32)
    p = [rng.normal(0, np.sqrt(2 / d), (d, HIDDEN)), np.zeros(HIDDEN), rng.normal(0, np.sqrt(1 / HIDDEN), (HIDDEN, target.shape[1])),
         np.zeros(target.shape[1])]
    p = [v.astype(np.float32) for v in p]
    m1, m2 = [np.zeros_like(v) for v in p], [np.zeros_like(v) for v in p]
    step, total = 0, EPOCHS * (-(-n // BATCH))
    for _ in range(EPOCHS):
        order = rng.permutation(n)
        for at in range(0, n, BATCH):
            rows = order[at:at + BATCH]
            zi, ti = z[rows], target[rows]
            h = np.maximum(zi @ p[0] + p[1], 0)
            s = h @ p[2] + p[3]
            s = np.exp(s - s.max(axis=1, keepdims=True))
            g = (s / s.sum(axis=1, keepdims=True) - ti) / len(rows)
            gh = (g @ p[2].T) * (h > 0)
            step += 1
            rate = RATE * (1 - step / (total + 1)) * np.sqrt(1 - 0.999 ** step) / (1 - 0.9 ** step)
            for i, grad in enumerate((zi.T @ gh, gh.sum(axis=0), h.T @ g, g.sum(axis=0))):
                m1[i] += 0.1 * (grad - m1[i])
                m2[i] += 0.001 * (grad * grad - m2[i])
                p[i] -= (rate * m1[i] / (np.sqrt(m2[i]) + 1e-8)).astype(np.float32)
    return Router(centre, width, *p)
