"""Suffix sorting of a shard by induction, with common-prefix lengths; queues go to disk beyond their memory."""

from __future__ import annotations

import os
import tempfile
from collections.abc import Iterator

import numpy as np

from marketseries.llm.batches import keeps

_rng = np.random.default_rng(400)
_BYTE = _rng.integers(0, 1 << 64, 256, np.uint64)
_P = np.uint64(0x9E3779B97F4A7C15)
_P_INVERSE = np.uint64(pow(int(_P), -1, 1 << 64))
_power_tables: dict[int, np.ndarray] = {}
keeps("suffixes", _power_tables.clear)


def powers(base: np.uint64, n: int) -> np.ndarray:
    """base ** 0, 1, ... modulo 2**64; the longest table made so far is kept."""
    have = _power_tables.get(int(base))
    if have is None or len(have) < n:
        have = np.full(max(n, 1 << 16), base, np.uint64)
        have[0] = 1
        have = np.multiply.accumulate(have)
        if n <= 1 << 24:
            _power_tables[int(base)] = have
    return have[:n]


class PrefixHash:
    """Hashes of all strings of a text, from sums over its prefixes."""

    def __init__(self, data: np.ndarray):
        n = len(data)
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(_BYTE[data] * powers(_P, n), out=self.sums[1:])
        self.back = powers(_P_INVERSE, n + 1)

    def of(self, begin: np.ndarray, length) -> np.ndarray:
        return (self.sums[begin + length] - self.sums[begin]) * self.back[begin]


class BucketQueue:
    """Priority queue whose keys are bytes: first in, first out within a key. Rows are (position, common prefix).

    Beyond ``memory`` bytes the rows of all keys are appended to one file for each key in a folder of the task.
    """

    def __init__(self, memory: int):
        self.memory, self.held = memory, 0
        self.rows: list[list[np.ndarray]] = [[] for _ in range(256)]
        self.folder: tempfile.TemporaryDirectory | None = None
        self.on_disk = [0] * 256
        self.read = [0] * 256

    def add(self, key: int, rows: np.ndarray) -> None:
        self.rows[key].append(rows)
        self.held += rows.nbytes
        if self.held > self.memory:
            self.folder = self.folder or tempfile.TemporaryDirectory(prefix="induce-")
            for k, parts in enumerate(self.rows):
                if parts:
                    with open(os.path.join(self.folder.name, str(k)), "ab") as f:
                        for p in parts:
                            np.ascontiguousarray(p).tofile(f)
                    self.on_disk[k] += sum(len(p) for p in parts)
                    self.rows[k] = []
            self.held = 0

    def take(self, key: int) -> Iterator[np.ndarray]:
        """Rows of a key in the order of their arrival, also those that arrive meanwhile."""
        most = max(1, self.memory // 64)
        while True:
            if self.read[key] < self.on_disk[key]:
                n = min(most, self.on_disk[key] - self.read[key])
                rows = np.fromfile(os.path.join(self.folder.name, str(key)), np.int64, 2 * n, offset=16 * self.read[key]).reshape(-1, 2)
                self.read[key] += n
                yield rows
            elif self.rows[key]:
                rows, self.rows[key] = np.concatenate(self.rows[key]), []
                self.held -= rows.nbytes
                yield rows
            else:
                return

    def close(self) -> None:
        if self.folder:
            self.folder.cleanup()


class _Induction:
    """Sorts the suffixes of one type from those of the other, with the common prefix of each with its forerunner."""

    def __init__(self, text: np.ndarray, wanted: np.ndarray, memory: int):
        self.text, self.wanted = text, wanted
        self.queue = BucketQueue(memory)
        self.since = np.full(256, -1, np.int64)  # least common prefix since a key last got a row

    def scan(self, rows: np.ndarray) -> None:
        """Rows in sorted order: each passes its predecessor in the text on, if that is of the wanted type."""
        position, common = rows[:, 0], rows[:, 1]
        before = position - 1
        at = np.flatnonzero((position > 0) & self.wanted[before])
        least = int(common.min())
        if not len(at):
            np.minimum(self.since, least, out=self.since)
            return
        keys = self.text[before[at]]
        order = np.argsort(keys, kind="stable")
        at, keys = at[order], keys[order]
        head = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
        # common prefixes from the row after the key's last one up to this one
        begin = np.empty_like(at)
        begin[1:] = at[:-1] + 1
        begin[head] = 0
        ends = np.empty(2 * len(at), np.int64)
        ends[0::2], ends[1::2] = begin, at + 1
        padded = np.append(common, 1 << 40)
        value = np.minimum.reduceat(padded, ends)[0::2]
        own = keys[head].astype(int)
        value[head] = np.minimum(value[head], self.since[own])
        out = np.stack([before[at], value + 1], axis=1)
        last = np.append(head[1:], len(at))
        np.minimum(self.since, least, out=self.since)
        for k, a, b in zip(own.tolist(), head.tolist(), last.tolist()):
            self.queue.add(k, out[a:b])
            rest = common[at[b - 1] + 1 :]
            self.since[k] = int(rest.min()) if len(rest) else 1 << 40


def _types(text: np.ndarray) -> np.ndarray:
    """True where a suffix is smaller than the next one."""
    n = len(text)
    step = np.sign(text[1:].astype(np.int16) - text[:-1])
    other = np.where(step != 0, np.arange(n - 1), n)
    nearest = np.minimum.accumulate(other[::-1])[::-1]
    out = np.zeros(n, bool)
    known = nearest < n
    out[:-1][known] = step[nearest[known]] > 0
    return out


def _run_lengths(text: np.ndarray) -> np.ndarray:
    change = np.append(np.flatnonzero(text[1:] != text[:-1]) + 1, len(text))
    return np.repeat(change, np.diff(np.append(0, change))) - np.arange(len(text))


def _doubled(rank: np.ndarray, most: int) -> np.ndarray:
    """Order of the suffixes of a string of names by their first ``most`` names at least; only ties are sorted again."""
    n = len(rank)
    order = np.argsort(rank, kind="stable")
    active, key, reach = np.arange(n), rank[order], 1
    place = np.empty(n, np.int64)
    while True:
        head = np.append(True, key[1:] != key[:-1])
        place[order[active]] = active[np.maximum.accumulate(np.where(head, np.arange(len(head)), 0))]
        active = active[~(head & np.append(head[1:], True))]
        if not len(active) or reach > most:
            return order
        own = order[active]
        ahead = np.where(own + reach < n, place[np.minimum(own + reach, n - 1)] + 1, 0)
        key = place[own] << np.int64(32) | ahead
        by = np.argsort(key, kind="stable")
        order[active], key = own[by], key[by]
        reach *= 2


def _induced(text, small, lms, common, memory) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Positions and common prefixes of all suffixes, by first byte from the largest down, each part in ascending order.

    ``lms`` are the sorted leftmost small suffixes with their common prefixes.
    """
    run = _run_lengths(text)
    head = np.searchsorted(text[lms], np.arange(257)) if len(lms) else np.zeros(257, int)
    large = _Induction(text, ~small, memory)
    parts: list[list[np.ndarray]] = [[] for _ in range(256)]
    large.scan(np.array([[len(text), 0]]))  # the empty suffix comes before all
    for c in range(256):
        for rows in large.queue.take(c):
            parts[c].append(rows)
            large.scan(rows)
        if head[c] < head[c + 1]:
            rows = np.stack([lms[head[c] : head[c + 1]], common[head[c] : head[c + 1]]], axis=1)
            rows[0, 1] = min(run[parts[c][-1][-1, 0]], run[rows[0, 0]]) if parts[c] else 0
            large.scan(rows)
    large.queue.close()
    less = _Induction(text, small, memory)
    for c in range(255, -1, -1):
        own: list[np.ndarray] = []
        for rows in less.queue.take(c):
            own.append(rows)
            less.scan(rows)
        low = np.concatenate(parts[c]) if parts[c] else np.zeros((0, 2), np.int64)
        high = np.concatenate(own)[::-1] if own else np.zeros((0, 2), np.int64)
        parts[c] = []
        join = min(run[low[-1, 0]], run[high[0, 0]]) if len(low) and len(high) else 0
        if len(low):
            down = low[::-1].copy()
            down[1:, 1] = low[::-1][:-1, 1]
            down[0, 1] = join
            less.scan(down)
        if len(high):
            # descending rows hold the common prefix with the larger neighbour
            shifted = np.append(join, high[:-1, 1])
            high = np.stack([high[:, 0], shifted], axis=1)
        rows = np.concatenate([low, high])
        if len(rows):
            rows[0, 1] = 0
            yield rows[:, 0], rows[:, 1]
    less.queue.close()


def sorted_suffixes(text: np.ndarray, depth: int, memory: int = 64_000_000) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Suffixes of a byte string in parts by first byte: positions in the order of their first ``depth`` bytes at least,
    and the common prefix of each with the one before it (exact up to ``depth``).

    Leftmost small suffixes are sorted first: their substrings by one induction, which names them; the string of names,
    about a third as long, by doubling. Their order and common prefixes then induce those of all suffixes.
    """
    small = _types(text)
    lms = np.flatnonzero(small[1:] & ~small[:-1]) + 1
    if not len(lms):
        yield from _induced(text, small, lms, lms, memory)
        return
    hashed = PrefixHash(text)
    rough = lms[np.argsort(text[lms], kind="stable")]
    is_lms = np.zeros(len(text), bool)
    is_lms[lms] = True
    found = [p[is_lms[p]] for p, _ in _induced(text, small, rough, np.zeros_like(rough), memory)]
    order = np.concatenate(found[::-1])
    following = np.append(lms[1:], len(text) - 1)
    length = np.empty(len(text), np.int64)
    length[lms] = following - lms + 1
    size, mark = length[order], hashed.of(order, length[order])
    new = np.append(True, (size[1:] != size[:-1]) | (mark[1:] != mark[:-1]))
    new[order == lms[-1]] = True  # the last one runs to the end and equals no other
    new[1:] |= (order == lms[-1])[:-1]
    name = np.empty(len(text), np.int64)
    name[order] = np.cumsum(new) - 1
    # a name stands for two bytes at least that the next does not share
    order = lms[_doubled(name[lms], depth // 2)]
    left, right = order[:-1], order[1:]
    most = np.minimum(depth, len(text) - np.maximum(left, right))
    low, high = np.zeros(len(left), np.int64), most
    while (low < high).any():
        middle = (low + high + 1) // 2
        same = hashed.of(left, middle) == hashed.of(right, middle)
        low, high = np.where(same, middle, low), np.where(same, high, middle - 1)
    yield from _induced(text, small, order, np.append(0, low), memory)
