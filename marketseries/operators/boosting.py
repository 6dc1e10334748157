"""Boosted regression trees grown whole in one place, from the draws and sums of Spark ML's learner.

Spark ML starts jobs for every level of every tree: on a few thousand rows the jobs are all of the time. Here a fit is a
loop over arrays. Thresholds, gains, ties, drawn columns and pseudo-residuals follow Spark's definitions in the order of
its sums, so that the trees are those of ``GBTRegressor`` (squared loss, no row sampling, 32 bins, one row in a leaf at
least) over the same rows in one partition. Beyond 10,000 rows Spark takes its thresholds from a sample, this module from
all rows.
"""

from __future__ import annotations

from collections.abc import Iterable
from functools import lru_cache
from math import ceil

import numpy as np

#: Bins of a column, as in Spark ML by default.
BINS = 32
#: Rows times columns whose sums are taken at once.
CELLS = 1 << 20
_MASK = np.uint64((1 << 48) - 1)


def thresholds(column: np.ndarray, bins: int = BINS) -> np.ndarray:
    """Where a column may be split: between all its values, or closest to equal shares of its rows."""
    values, counts = np.unique(column, return_counts=True)
    middles = (values[:-1] + values[1:]) / 2
    splits = min(bins, len(column)) - 1
    if len(middles) <= splits:
        return middles
    stride = len(column) / (splits + 1)
    out, target = [], stride
    passed = np.cumsum(counts)
    for i, (before, after) in enumerate(zip(passed[:-1].tolist(), passed[1:].tolist())):
        if abs(before - target) < abs(after - target):
            out.append(i)
            target += stride
    return middles[out]


@lru_cache
def _jumps(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Factors and terms that carry a state of Java's generator 1 to n steps on."""
    factors = np.cumprod(np.full(n, 0x5DEECE66D, np.uint64))
    terms = np.uint64(0xB) * np.cumsum(np.concatenate([np.ones(1, np.uint64), factors[:-1]]))
    return factors & _MASK, terms & _MASK


def _mixed(words: np.ndarray, h: np.ndarray) -> np.ndarray:
    """MurmurHash3 of the bytes of 64-bit ``words``, most significant first, on from ``h``."""
    u = np.uint32
    for k in ((words >> np.uint64(32)).astype(u), words.astype(u)):
        k = k.byteswap() * u(0xCC9E2D51)
        h = h ^ ((k << u(15) | k >> u(17)) * u(0x1B873593))
        h = (h << u(13) | h >> u(19)) * u(5) + u(0xE6546B64)
    h = h ^ u(8)
    h = (h ^ h >> u(16)) * u(0x85EBCA6B)
    h = (h ^ h >> u(13)) * u(0xC2B2AE35)
    return h ^ h >> u(16)


class Draws:
    """Columns that the nodes of a tree may be split on, node after node."""

    def __init__(self, seed: int, columns: int, share: float):
        self.state = np.uint64((seed ^ 0x5DEECE66D) & int(_MASK))
        self.columns, self.taken = columns, columns if share == 1 else ceil(share * columns)

    def next(self, nodes: int) -> np.ndarray:
        """For each of the next ``nodes`` its columns, in the order in which equal gains are decided."""
        out = np.tile(np.arange(self.taken), (nodes, 1))
        if self.taken == self.columns:
            return out
        factors, terms = _jumps(1 << (2 * nodes - 1).bit_length())
        states = (self.state * factors[: 2 * nodes] + terms[: 2 * nodes]) & _MASK
        self.state = states[-1]
        halves = (states >> np.uint64(16)).astype(np.uint32).view(np.int32).astype(np.int64)
        words = ((halves[::2] << 32) + halves[1::2]).view(np.uint64)
        low = _mixed(words, np.full(nodes, 0x3C074A61, np.uint32))
        seeds = _mixed(words, low).astype(np.uint64) << np.uint64(32) | low
        for column in range(self.taken, self.columns):
            bits = []
            for k in (26, 27):
                seeds = seeds ^ seeds << np.uint64(21)
                seeds = seeds ^ seeds >> np.uint64(35)
                seeds = seeds ^ seeds << np.uint64(4)
                bits.append((seeds & np.uint64((1 << k) - 1)).astype(np.int64))
            at = (((bits[0] << 27) + bits[1]) * 2.0**-53 * (column + 1)).astype(np.int64)
            hit = np.flatnonzero(at < self.taken)
            out[hit, at[hit]] = column
        return out


def _variance(s: np.ndarray) -> np.ndarray:
    """Variance from counts, sums and sums of squares."""
    return (s[2] - s[1] * s[1] / s[0]) / s[0]


def _histograms(codes: np.ndarray, at: np.ndarray, target: np.ndarray, nodes: int, width: int) -> np.ndarray:
    """Counts, sums and sums of squares up to each bin: (3, nodes, columns, width). Rows add up in their order."""
    n, columns = codes.shape
    out = np.zeros((3, nodes * columns * width))
    step = max(1, CELLS // max(n, 1))
    for a in range(0, columns, step):
        part = codes[:, a : a + step]
        cells = (part + (np.arange(a, a + part.shape[1]) * width + (at * (columns * width))[:, None])).ravel()
        for i, weight in enumerate((None, target, target * target)):
            out[i] += np.bincount(cells, weight if weight is None else np.repeat(weight, part.shape[1]), out.shape[1])
    return out.reshape(3, nodes, columns, width).cumsum(axis=3)


def grow(codes: np.ndarray, target: np.ndarray, depth: int, draws: Draws) -> np.ndarray:
    """What one tree says for every row of ``codes``; it is grown on the first rows, one for each ``target``."""
    n, width = len(target), max(2, int(codes.max()) + 1)
    at, value = np.zeros(len(codes), np.int64), np.full(len(codes), target.sum() / n)
    node, nodes, alive = None, 1, np.arange(len(codes))
    for level in range(depth):
        if not nodes:
            break
        own = alive[: np.searchsorted(alive, n)]
        sums = _histograms(codes[own], at[own], target[own], nodes, width)
        left, whole = sums[..., :-1], sums[..., -1:]
        right = whole - left
        order, each = draws.next(nodes), np.arange(nodes)
        if node is None:  # the sums of the root are those of the first split that is looked at
            first = next((f for f in order[0] if 0 < left[0, 0, f, 0] < n), order[0, 0])
            node = (left + right)[:, :, first, 0]
        with np.errstate(divide="ignore", invalid="ignore"):
            impurity = _variance(node)[:, None, None]
            gain = impurity - left[0] / whole[0] * _variance(left) - right[0] / whole[0] * _variance(right)
        gain = np.where((left[0] > 0) & (right[0] > 0), gain, -np.inf)
        split = gain.argmax(axis=2)
        top = np.take_along_axis(np.take_along_axis(gain, split[:, :, None], 2)[:, :, 0], order, 1)
        picked = top.argmax(axis=1)
        column = order[each, picked]
        split = split[each, column]
        below = left[:, each, column, split]
        children = np.stack([below, whole[:, each, column, 0] - below], axis=2)
        inner = top[each, picked] > 0
        with np.errstate(divide="ignore", invalid="ignore"):
            says = np.where(inner[:, None], children[1] / children[0], (node[1] / node[0])[:, None]).ravel()
            pure = np.abs(_variance(children)) < np.finfo(float).eps
        children = children.reshape(3, -1)
        # what was put on the stack last is taken first
        kept = np.flatnonzero((inner[:, None] & ~pure).ravel() & (level + 1 < depth))[::-1]
        to = np.full(2 * nodes, -1)
        to[kept] = np.arange(len(kept))
        mine = at[alive]
        goes = 2 * mine + (codes[alive, column[mine]] > split[mine])
        value[alive], at[alive] = says[goes], to[goes]
        node, nodes, alive = children[:, kept], len(kept), alive[to[goes] >= 0]
    return value


def boosted_errors(
    x: np.ndarray, y: np.ndarray, test_x: np.ndarray, test_y: np.ndarray, rounds: Iterable[int], depth: int, rate: float, share: float = 1.0, seed: int = 0
) -> dict[int, float]:
    """Sum of squared errors over the test rows after each of ``rounds`` boosting rounds, all from one run."""
    rounds, n = set(rounds), len(y)
    if not (n and np.isfinite(x).all() and np.isfinite(y).all()):
        raise ValueError("boosted trees need training rows, and neither nulls nor values that are not finite in them")
    cuts = [thresholds(x[:, j]) for j in range(x.shape[1])]
    both = np.concatenate([x, test_x])
    codes = np.stack([np.searchsorted(c, both[:, j]).astype(np.uint8) for j, c in enumerate(cuts)], axis=1)
    out, said = {}, np.zeros(len(both))
    for m in range(max(rounds)):
        target = 2.0 * (y - said[:n]) if m else y
        own = grow(codes, target, depth, Draws(seed + m, x.shape[1], share))
        said = said + own * rate if m else own
        if m + 1 in rounds:
            out[m + 1] = float(((said[n:] - test_y) ** 2).sum())
    return out
