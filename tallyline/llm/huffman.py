"""Canonical, length-limited Huffman codes over integer ids, with numpy on whole blocks.

A block is a bit string of codes, most significant bit first, with the bit offset of every ``STEP``-th id kept as
a checkpoint, so the stretches between checkpoints decode side by side, each step by one table look-up.
"""

from __future__ import annotations

import numpy as np

MAX_LENGTH = 20
STEP = 256


def code_lengths(counts: np.ndarray, longest: int = MAX_LENGTH) -> np.ndarray:
    """The lengths of an optimal prefix code with none over ``longest`` (package-merge); 0 for a count of 0."""
    lengths = np.zeros(len(counts), np.int64)
    used = np.flatnonzero(counts)
    if len(used) > 1 << longest:
        raise ValueError(f"{len(used)} ids need codes longer than {longest} bits")
    if len(used) < 2:
        lengths[used] = 1
        return lengths
    order = used[np.argsort(counts[used], kind="stable")]
    weights = counts[order].astype(np.float64)
    levels, row, leaf = [], weights, np.ones(len(order), bool)
    for _ in range(longest):
        levels.append(leaf)
        pairs = row[: len(row) // 2 * 2].reshape(-1, 2).sum(1)
        row = np.concatenate([weights, pairs])
        leaf = np.arange(len(row)) < len(weights)
        at = np.argsort(row, kind="stable")
        row, leaf = row[at], leaf[at]
    taken = 2 * len(order) - 2
    for leaf in reversed(levels):
        leaves = int(leaf[:taken].sum())
        lengths[order[:leaves]] += 1
        taken = 2 * (taken - leaves)
    return lengths


def canonical_codes(lengths: np.ndarray) -> np.ndarray:
    """Codes in order of length, then id."""
    codes = np.zeros(len(lengths), np.uint64)
    used = np.flatnonzero(lengths)
    used = used[np.lexsort((used, lengths[used]))]
    longest = int(lengths.max(initial=0))
    widths = np.uint64(1) << (longest - lengths[used]).astype(np.uint64)
    codes[used] = (np.cumsum(widths) - widths) >> (longest - lengths[used]).astype(np.uint64)
    return codes


def decoding_table(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """For every string of as many bits as the longest code has: the id it starts with, that code's length."""
    longest = max(1, int(lengths.max(initial=0)))
    used = np.flatnonzero(lengths)
    used = used[np.lexsort((used, lengths[used]))]
    ids, steps = np.zeros(1 << longest, np.int32), np.ones(1 << longest, np.int8)
    repeats = 1 << (longest - lengths[used])
    filled = int(repeats.sum())
    ids[:filled] = np.repeat(used, repeats)
    steps[:filled] = np.repeat(lengths[used], repeats)
    return ids, steps, longest


def encode_block(ids: np.ndarray, codes: np.ndarray, lengths: np.ndarray) -> tuple[bytes, np.ndarray]:
    """The bits of all ids, padded to whole 32-bit words, and the checkpoints."""
    if not len(ids):
        return b"", np.zeros(0, np.uint32)
    size = lengths[ids]
    at = np.cumsum(size) - size
    total = int(at[-1] + size[-1])
    if total >= 1 << 32:
        raise ValueError("a block holds at most 2**32 bits")
    values = codes[ids] << (64 - size - (at & 31)).astype(np.uint64)
    word = at >> 5
    first = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
    out = np.zeros(total // 32 + 2, np.uint64)
    out[word[first]] += np.add.reduceat(values >> np.uint64(32), first)
    out[word[first] + 1] += np.add.reduceat(values & np.uint64(0xFFFFFFFF), first)
    return out.astype(">u4").tobytes(), at[::STEP].astype(np.uint32)


def decode_block(data: bytes, checkpoints: np.ndarray, n: int, table) -> np.ndarray:
    """The ``n`` ids of a block; all stretches advance together."""
    if not n:
        return np.zeros(0, np.int32)
    ids, steps, longest = table
    raw = np.frombuffer(data + bytes(8), np.uint8)
    windows = np.ndarray((len(raw) - 3,), ">u4", raw, strides=(1,))
    at = checkpoints.astype(np.int64)
    end = 8 * len(data)
    out = np.empty((STEP, len(at)), np.int32)
    for t in range(STEP):
        index = ((windows[at >> 3].astype(np.uint32) << (at & 7).astype(np.uint32)) >> np.uint32(32 - longest)).astype(np.int64)
        out[t] = ids[index]
        at = np.minimum(at + steps[index], end)
    return out.T.reshape(-1)[:n]
