"""SetSketch: registers of exponentially spaced, truncated minima of a set's hash values.

Register i keeps floor(1 - log_b(min / a)) of the smallest of the set's i-th hash values, taken
as exponentially distributed, cut to 0 .. q + 1. Sketches merge by the larger register. Equal
registers show similarity, and larger and smaller ones, with the sizes of the sets, give a joint
estimate of it by maximum likelihood.
"""

from __future__ import annotations

import numpy as np

#: The base, rate and truncation of the registers: two bytes each.
BASE, RATE, TOP = 1.001, 20.0, 65534
#: 25 bands of 5 registers: a pair of similarity 0.85 shares no band with probability 4e-7.
ROWS, BANDS = 5, 25
REGISTERS = ROWS * BANDS
_SEEDS = np.random.default_rng(20240817).integers(0, 2**63, (2, REGISTERS), dtype=np.uint64)
MULTIPLIERS, ADDENDS = _SEEDS * np.uint64(2) + np.uint64(1)


def registers(hashes: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """The sketch of each of the non-empty sets hashes[start : next start], a row each."""
    minima = np.empty((len(starts), REGISTERS))
    for i in range(REGISTERS):
        values = hashes * MULTIPLIERS[i]
        values += ADDENDS[i]
        minima[:, i] = np.minimum.reduceat(values, starts)
    least = -np.log1p(-(minima + 1.0) / 2.0**64 * (1 - 2.0**-53))
    spaced = np.floor(1 - np.log(least / RATE) / np.log(BASE))
    return np.clip(spaced, 0, TOP + 1).astype(np.uint16)


def merge(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The sketch of the union."""
    return np.maximum(a, b)


def _p(x: np.ndarray) -> np.ndarray:
    return -np.log1p(-x * (BASE - 1) / BASE) / np.log(BASE)


def log_likelihood(j, share, larger, smaller, equal):
    """Of similarity j: share = n_u / (n_u + n_v); registers of u larger, smaller or equal."""
    above = np.maximum(_p(share - (1 - share) * j), 1e-12)
    below = np.maximum(_p((1 - share) - share * j), 1e-12)
    same = np.maximum(1 - above - below, 1e-12)
    return larger * np.log(above) + smaller * np.log(below) + equal * np.log(same)


def may_reach(
    u: np.ndarray, v: np.ndarray, n_u: np.ndarray, n_v: np.ndarray, similarity: float, slack=10.0
) -> np.ndarray:
    """Whether the pairs (rows of u and v) may be as similar as asked.

    True where the most likely similarity is at least that, or where the asked one's log
    likelihood is within `slack` of the best: 10 is 4.5 standard deviations. Sets whose sizes
    differ too much cannot reach it at all.
    """
    n_u, n_v = n_u.astype(float), n_v.astype(float)
    most = np.minimum(n_u, n_v) / np.maximum(n_u, n_v)
    found = most >= similarity - 1e-9
    at = np.flatnonzero(found)
    share = (n_u / (n_u + n_v))[at]
    larger, smaller = (u[at] > v[at]).sum(1), (u[at] < v[at]).sum(1)
    equal = u.shape[1] - larger - smaller
    low, high = np.zeros(len(at)), most[at]
    for _ in range(14):  # the likelihood has one peak: thirds close in on it
        left, right = low + (high - low) / 3, high - (high - low) / 3
        up = log_likelihood(left, share, larger, smaller, equal) < log_likelihood(
            right, share, larger, smaller, equal
        )
        low, high = np.where(up, left, low), np.where(up, high, right)
    best = (low + high) / 2
    behind = log_likelihood(best, share, larger, smaller, equal) - log_likelihood(
        np.full(len(at), similarity), share, larger, smaller, equal
    )
    found[at] = (best >= similarity) | (behind <= slack)
    return found
