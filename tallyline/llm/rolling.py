"""Hashes of all runs of ``k`` words, comparisons of long stretches of words, and words put together again."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from tallyline.llm.blocks import _BASE, mix, powers

_INVERSE = pow(int(_BASE), -1, 1 << 64)
_down = np.ones(1, np.uint64)
#: Two primes below 2**31 and a base for each: stretches are equal if both remainders are.
PRIMES = ((2147483647, 1103515245), (2147483629, 1664525013))
_tables: dict[int, np.ndarray] = {}


def rolling(hashes: np.ndarray, k: int) -> np.ndarray:
    """One hash for each run of ``k`` neighbouring values; the caller leaves out runs that cross texts."""
    global _down
    n = len(hashes)
    if n < k:
        return np.zeros(0, np.uint64)
    if len(_down) < n:
        more = np.full(max(n, 2 * len(_down)), np.uint64(_INVERSE))
        more[0] = 1
        _down = np.cumprod(more)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(hashes * powers(n), out=sums[1:])
    return mix((sums[k:] - sums[:-k]) * _down[: n - k + 1])


def least_of(values: np.ndarray, width: int) -> np.ndarray:
    """The smallest of every ``width`` neighbours, by doubling."""
    if len(values) < width:
        return values[:0]
    out, reach = values, 1
    while 2 * reach <= width:
        out = np.minimum(out[:-reach], out[reach:])
        reach *= 2
    if reach < width:
        out = np.minimum(out[: len(out) - (width - reach)], out[width - reach :])
    return out


def _prime_powers(prime: int, base: int, n: int) -> np.ndarray:
    table = _tables.get(prime, np.ones(1, np.uint64))
    p = np.uint64(prime)
    while len(table) < n:
        step = np.uint64(int(table[-1]) * base % prime)
        table = np.concatenate([table, table * step % p])
    _tables[prime] = table
    return table


class Stretches:
    """Longest common extensions of many pairs of positions at once, by prefix sums and halving."""

    def __init__(self, hashes: np.ndarray):
        self.sums, self.powers = [], []
        for prime, base in PRIMES:
            table = _prime_powers(prime, base, len(hashes) + 1)
            sums = np.zeros(len(hashes) + 1, np.uint64)
            np.cumsum(hashes % np.uint64(prime) * table[: len(hashes)] % np.uint64(prime), out=sums[1:])
            self.sums.append(sums)
            self.powers.append(table)

    def equal(self, i: np.ndarray, j: np.ndarray, n: np.ndarray) -> np.ndarray:
        """Whether the ``n`` values from ``i`` on are those from ``j`` on; ``i <= j``."""
        same = np.ones(len(i), bool)
        for (prime, _), sums, table in zip(PRIMES, self.sums, self.powers):
            p = np.uint64(prime)
            same &= (sums[i + n] - sums[i]) % p * table[j - i] % p == (sums[j + n] - sums[j]) % p
        return same

    def forward(self, i: np.ndarray, j: np.ndarray, most: np.ndarray) -> np.ndarray:
        """How many values from ``i`` on equal those from ``j`` on, up to ``most``."""
        return self._longest(most, lambda n, at: self.equal(i[at], j[at], n))

    def backward(self, i: np.ndarray, j: np.ndarray, most: np.ndarray) -> np.ndarray:
        """How many values before ``i`` equal those before ``j``, up to ``most``."""
        return self._longest(most, lambda n, at: self.equal(i[at] - n, j[at] - n, n))

    @staticmethod
    def _longest(most: np.ndarray, holds) -> np.ndarray:
        low, high = np.zeros(len(most), np.int64), most.astype(np.int64)
        while (open_ := np.flatnonzero(low < high)).size:
            middle = (low[open_] + high[open_] + 1) // 2
            good = holds(middle, open_)
            low[open_[good]] = middle[good]
            high[open_[~good]] = middle[~good] - 1
        return low


def spread(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each of ``counts`` repeats of a row: the row, and its number among the row's repeats."""
    row = np.repeat(np.arange(len(counts)), counts)
    first = np.cumsum(counts) - counts
    return row, np.arange(len(row)) - first[row]


def joined(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, owner: np.ndarray, texts: int) -> pa.Array:
    """The words, in the order given, as one text per owner with a blank between words; owners ascend."""
    sizes = ends - starts + 1
    at = np.cumsum(sizes) - sizes
    out = np.full(int(sizes.sum()), 32, np.uint8)
    first = 0
    while first < len(starts):  # bounded temporary memory
        last = max(int(np.searchsorted(at, at[first] + (1 << 20), "left")), first + 1)
        row, within = spread((sizes - 1)[first:last])
        out[at[first + row] + within] = data[starts[first + row] + within]
        first = last
    bounds = np.searchsorted(owner, np.arange(texts + 1))
    place = np.r_[at, len(out)][bounds]
    raw = out.tobytes()
    return pa.array([raw[a : max(b - 1, a)] for a, b in zip(place[:-1].tolist(), place[1:].tolist())], pa.binary()).cast(pa.string())
