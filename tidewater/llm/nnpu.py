"""Learning from positive and unlabelled rows by the non-negative risk estimator.

For a class prior pi the risk is
    pi E_p[l(z)] + max(0, E_u[l(-z)] - pi E_p[l(-z)]),    l(z) = log(1 + exp(-z)).
A step descends the sum as long as the bracket is not negative; otherwise it
ascends the bracket, so that a flexible model can't drive the negative part of
the risk below zero.  The prior is estimated from the same two samples by the
best-bin rule.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


def _sigmoid(z):
    return 0.5 * (1 + np.tanh(0.5 * z))


@dataclass
class Linear:
    mean: np.ndarray | None           # None: rows are taken as they are
    scale: np.ndarray | None
    weight: np.ndarray
    bias: float

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of the positive class."""
        return _sigmoid((x if self.mean is None else (x - self.mean) / self.scale) @ self.weight + self.bias)


class Rows:
    """0/1 rows by the columns they hold: ``columns[offsets[i]:offsets[i + 1]]`` are those of row i."""

    def __init__(self, columns: np.ndarray, offsets: np.ndarray, width: int):
        self.columns, self.offsets, self.shape = columns, offsets, (len(offsets) - 1, width)
        self.row = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))

    def __len__(self) -> int:
        return self.shape[0]

    def __matmul__(self, w: np.ndarray) -> np.ndarray:
        return np.bincount(self.row, weights=w[self.columns], minlength=len(self))

    def back(self, dz: np.ndarray) -> np.ndarray:
        return np.bincount(self.columns, weights=dz[self.row], minlength=self.shape[1])

    def take(self, rows: np.ndarray) -> Rows:
        n = np.diff(self.offsets)[rows]
        off = np.concatenate([[0], np.cumsum(n)])
        return Rows(self.columns[np.repeat(self.offsets[rows] - off[:-1], n) + np.arange(off[-1])], off, self.shape[1])

    def __getitem__(self, part: slice) -> Rows:
        return self.take(np.arange(len(self))[part])


class _Adam:
    def __init__(self, size, rate):
        self.m, self.v, self.t, self.rate = np.zeros(size), np.zeros(size), 0, rate

    def step(self, w, g):
        self.t += 1
        self.m += 0.1 * (g - self.m)
        self.v += 0.001 * (g * g - self.v)
        return w - self.rate * (self.m / (1 - 0.9**self.t)) / (np.sqrt(self.v / (1 - 0.999**self.t)) + 1e-8)


def fit(x_p: np.ndarray, x_u: np.ndarray, prior: float, steps: int = 400, rate: float = 0.05, l2: float = 1e-4,
        centre: bool = True) -> Linear:
    """Linear model of least non-negative risk; deterministic.  Without ``centre`` the rows may be ``Rows``."""
    d = x_u.shape[1]
    mean, scale, p, u = None, None, x_p, x_u
    if centre:
        mean, scale = x_u.mean(axis=0), np.maximum(x_u.std(axis=0), 1e-3)
        p, u = ((x_p - mean) / scale).astype(np.float32), ((x_u - mean) / scale).astype(np.float32)
    w, adam = np.zeros(d + 1), _Adam(d + 1, rate)
    w[d] = np.log(prior / (1 - prior))

    def back(x, dz):
        down = x.back(dz) if isinstance(x, Rows) else x.T @ dz.astype(np.float32)
        return np.append(down, dz.sum()) / len(x)

    for _ in range(steps):
        zp, zu = p @ w[:d].astype(np.float32) + w[d], u @ w[:d].astype(np.float32) + w[d]
        bracket = np.logaddexp(0, zu).mean() - prior * np.logaddexp(0, zp).mean()
        g_bracket = back(u, _sigmoid(zu)) - prior * back(p, _sigmoid(zp))
        g = prior * back(p, _sigmoid(zp) - 1) + g_bracket if bracket >= 0 else -g_bracket
        g[:d] += l2 * w[:d]
        w = adam.step(w, g)
    return Linear(mean, scale, w[:d].copy(), float(w[d]))


def estimate_prior(x_p: np.ndarray, x_u: np.ndarray, centre: bool = True, steps: int = 150, l2: float = 1e-2) -> float:
    """Share of positives among unlabelled rows.

    A positive-against-unlabelled model is fitted on every other row; on the rest
    the least ratio of the shares above a threshold, u / p plus a bound on its
    error, is the best bin: where only positives remain, the ratio is the prior.
    """
    if len(x_p) < 4 or len(x_u) < 4:
        return 0.5
    model = fit(x_p[::2], x_u[::2], 0.5, steps=steps, centre=centre, l2=l2)
    s_p, s_u = np.sort(model.score(x_p[1::2])), np.sort(model.score(x_u[1::2]))
    share_p = 1 - np.searchsorted(s_p, s_p, side="left") / len(s_p)
    share_u = 1 - np.searchsorted(s_u, s_p, side="left") / len(s_u)
    error = np.sqrt(np.log(40) / 2) * (1 / np.sqrt(len(s_u)) + 1 / np.sqrt(len(s_p)))
    best = int(np.argmin((share_u + error) / share_p))
    return float(np.clip(share_u[best] / share_p[best], 0.01, 0.99))
