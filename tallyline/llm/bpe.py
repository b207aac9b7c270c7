"""Token ids of a byte-level BPE vocabulary, as the ``tokenizers`` library gives them for whole texts.

The pre-tokeniser's pattern never lets a token reach from a character that is no white space into white space
that follows it: white space opens a token or fills it, and what it looks ahead to is the next character only.
So a text may be cut at every such place (a *stable boundary*), whatever stands further left or right, and the
ids of the parts, joined, are the ids of the text. Equal parts are encoded once.
"""

from __future__ import annotations

import os
from functools import lru_cache

import numpy as np

from tallyline.llm.blocks import WHITE, _RANDOM, span_hashes

#: The last bytes of the white space characters beyond ASCII that take two or three bytes in UTF-8.
_WIDE = np.array([0xC285, 0xC2A0], np.int32)
_WIDER = np.array(
    [0xE19A80, *range(0xE28080, 0xE2808B), 0xE280A8, 0xE280A9, 0xE280AF, 0xE2819F, 0xE38080], np.int32
)
CACHE_PARTS = 1 << 19


def stable_boundaries(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Byte positions where a part starts: at each text's start, and at ASCII white space after a character that is
    neither white space nor a control character."""
    n = len(data)
    starts = np.zeros(n + 1, bool)
    if n > 1:
        solid = data > 0x20
        solid &= data != 0x7F
        wide = np.flatnonzero(data >= 0x80)  # last bytes of wide white space are in 0x80..0xAF
        if len(wide):
            b0, b1 = data[wide].astype(np.int32), data[np.maximum(wide - 1, 0)].astype(np.int32)
            b2 = data[np.maximum(wide - 2, 0)].astype(np.int32)
            two, three = b1 << 8 | b0, b2 << 16 | b1 << 8 | b0
            solid[wide[np.isin(two, _WIDE) | np.isin(three, _WIDER)]] = False
        starts[1:n] = WHITE[data[1:]] & solid[:-1]
    starts[at] = True
    starts[n] = False
    return np.flatnonzero(starts)


class PartEncoder:
    """Encodes texts part by part, equal parts once; remembers up to ``CACHE_PARTS`` parts between calls.

    A subclass says where parts start and encodes distinct parts: where each one's ids begin, how many, all ids.
    """

    def __init__(self):
        self._known = np.zeros(0, np.uint64)
        self._from = np.zeros(0, np.int64)
        self._count = np.zeros(0, np.int64)
        self._ids = np.zeros(0, np.int32)

    def boundaries(self, data: np.ndarray, at: np.ndarray) -> np.ndarray:
        raise NotImplementedError

    def encode_parts(self, data, starts, ends) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        raise NotImplementedError

    def _look_up(self, data, starts, ends):
        """For each part where its ids begin in the store and how many they are."""
        hashes = span_hashes(data, starts, ends, _RANDOM)
        distinct, first, which = np.unique(hashes, return_index=True, return_inverse=True)
        place = np.searchsorted(self._known, distinct)
        known = np.zeros(len(distinct), bool)
        if len(self._known):
            near = np.minimum(place, len(self._known) - 1)
            known = self._known[near] == distinct
        fresh = np.flatnonzero(~known)
        if len(fresh):
            if len(self._known) + len(fresh) > CACHE_PARTS:
                self._known, self._from, self._count = self._known[:0], self._from[:0], self._count[:0]
                self._ids = self._ids[:0]
                fresh = np.arange(len(distinct))
            begin, counts, ids = self.encode_parts(data, starts[first[fresh]], ends[first[fresh]])
            keys = np.concatenate([self._known, distinct[fresh]])
            order = np.argsort(keys, kind="stable")
            self._known = keys[order]
            self._from = np.concatenate([self._from, begin + len(self._ids)])[order]
            self._count = np.concatenate([self._count, counts])[order]
            self._ids = np.concatenate([self._ids, ids])
        place = np.searchsorted(self._known, distinct)
        return self._from[place][which], self._count[place][which]

    def counts(self, data: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Number of ids of each text."""
        starts = self.boundaries(data, at)
        total = np.zeros(len(at) - 1, np.int64)
        if len(starts):
            _, counts = self._look_up(data, starts, np.r_[starts[1:], len(data)])
            np.add.at(total, np.searchsorted(at, starts, "right") - 1, counts)
        return total

    def encode(self, data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after another, and the number of each."""
        starts = self.boundaries(data, at)
        total = np.zeros(len(at) - 1, np.int64)
        if not len(starts):
            return np.zeros(0, np.int32), total
        begin, counts = self._look_up(data, starts, np.r_[starts[1:], len(data)])
        np.add.at(total, np.searchsorted(at, starts, "right") - 1, counts)
        shift = np.repeat(begin - (np.cumsum(counts) - counts), counts)
        return self._ids[shift + np.arange(len(shift))], total


class BpeEncoder(PartEncoder):
    """Of one vocabulary file of the ``tokenizers`` library."""

    def __init__(self, path: str):
        super().__init__()
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.size = self.tokenizer.get_vocab_size(with_added_tokens=True)
        self.bytes_of = np.array([len(self.tokenizer.id_to_token(i) or "") for i in range(self.size)], np.int64)

    def boundaries(self, data: np.ndarray, at: np.ndarray) -> np.ndarray:
        return stable_boundaries(data, at)

    def _alone(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        found = [np.array(x.ids, np.int32) for x in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        return np.array([len(x) for x in found], np.int64), np.concatenate([*found, np.zeros(0, np.int32)])

    def encode_parts(self, data, starts, ends) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of distinct parts: many parts that begin with white space and end solidly make one string."""
        last = data[ends - 1]
        joined = WHITE[data[starts]] & (last > 0x20) & (last < 0x7F)
        counts = np.zeros(len(starts), np.int64)
        pieces: dict[int, np.ndarray] = {}
        raw = data.tobytes()
        rest = np.flatnonzero(~joined)
        together = np.flatnonzero(joined)
        lengths = (ends - starts)[together]
        groups = np.split(together, np.searchsorted(np.cumsum(lengths), np.arange(1 << 12, int(lengths.sum()) + 1, 1 << 12)))
        groups = [g for g in groups if len(g)]
        texts = [b"".join([raw[s:e] for s, e in zip(starts[g].tolist(), ends[g].tolist())]).decode() for g in groups]
        flat, order = [], []
        for g, x in zip(groups, self.tokenizer.encode_batch_fast(texts, add_special_tokens=False) if texts else []):
            ids = np.array(x.ids, np.int32)
            reached = np.cumsum(self.bytes_of[ids])
            edge = np.cumsum((ends - starts)[g])
            upto = np.searchsorted(reached, edge, "left") + 1
            if not np.array_equal(reached[upto - 1], edge):  # a vocabulary of another kind: no joining
                rest = np.concatenate([rest, g])
                continue
            counts[g] = np.diff(np.r_[0, upto])
            flat.append(ids)
            order.append(g)
        if len(rest):
            alone = [raw[s:e].decode() for s, e in zip(starts[rest].tolist(), ends[rest].tolist())]
            counts[rest], ids = self._alone(alone)
            flat.append(ids)
            order.append(rest)
        order = np.concatenate([*order, np.zeros(0, np.int64)])
        ids = np.concatenate([*flat, np.zeros(0, np.int32)])
        begin = np.zeros(len(starts), np.int64)
        begin[order] = np.cumsum(counts[order]) - counts[order]
        return begin, counts, ids


@lru_cache(maxsize=4)
def encoder(path: str) -> BpeEncoder:
    return BpeEncoder(path)
