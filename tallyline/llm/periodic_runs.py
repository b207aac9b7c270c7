"""Periodic runs of words, found on a grammar of the words, and texts with each run cut to its first period.

A run is a stretch of words with smallest period q (words q apart are identical) of at least ``LEAST`` words and at
least three periods that no neighbouring word extends.

The words of a slice of texts become numbers, and Re-Pair writes these as a grammar: rounds replace each pair of
neighbours that occurs oftener than the pairs it overlaps (ties: the smaller pair) by a nonterminal, until no pair is
replaced twice. No pair crosses two texts; a slice is some 2 MB of whole texts, or one longer text. What is left of a text
is halved into a balanced tree, so that every node has two children.

A run lies in one lowest node of the derivation tree and crosses the boundary between its children. So each nonterminal
is looked at once, at one of its places: a run that crosses its boundary has, on the longer side, q + 4 words or more, so
the four words at the boundary come again q words on (or back). Each such q is extended both ways inside the nonterminal
by longest common extensions. What is found is carried over to all places that the nonterminal derives, and of the
intervals of one period only the maximal ones stay: a nonterminal may cut a run off, but then a higher one holds it whole.

Words are compared by 64-bit hashes, stretches by two remainders of some 31 bits. No rows are shuffled; memory grows with
the longest text. Null, empty and blank texts have no words and no runs. Other columns pass through; columns with the
names of the results are replaced.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyline.llm.blocks import text_slices, tidy, words
from tallyline.llm.rolling import Stretches, joined, rolling, spread
from tallyline.llm.tables import add_text_columns, fields, table

LEAST = 24
PERIODS = 3
#: So many words at a boundary must come again; see ``LEAST``: the longer side of a run has q + 4 words.
SEED = 4
#: Candidates that are extended at a time.
AT_ONCE = 1 << 19


class Grammar:
    """The rules of Re-Pair over numbered words, and what is left of each text."""

    def __init__(self, numbers: np.ndarray, owner: np.ndarray):
        self.terminals = int(numbers.max(initial=-1)) + 1
        self.left, self.right, self.place, self.rounds = [], [], [], []
        self.symbols, self.at, self.owner = numbers.astype(np.int64), np.arange(len(numbers)), owner
        made = self.terminals
        while (picked := self._pairs()) is not None:
            first, pair = picked
            code, where, which = np.unique(pair, return_index=True, return_inverse=True)
            size = np.int64(made)
            self.left.append(code // size)
            self.right.append(code % size)
            self.place.append(self.at[first[where]])
            self.rounds.append((made, made + len(code)))
            self.symbols[first] = made + which
            stays = np.ones(len(self.symbols), bool)
            stays[first + 1] = False
            self.symbols, self.at, self.owner = self.symbols[stays], self.at[stays], self.owner[stays]
            made += len(code)
        self.made = made
        none = np.zeros(0, np.int64)
        self.left = np.concatenate([none, *self.left])
        self.right = np.concatenate([none, *self.right])
        self.place = np.concatenate([none, *self.place])
        self.length = np.ones(made, np.int64)
        for low, high in self.rounds:
            a, b = self.left[low - self.terminals : high - self.terminals], self.right[low - self.terminals : high - self.terminals]
            self.length[low:high] = self.length[a] + self.length[b]

    def _pairs(self) -> tuple[np.ndarray, np.ndarray] | None:
        """Where pairs are replaced this round, and these pairs as numbers."""
        if len(self.symbols) < 2:
            return None
        size = self.terminals + sum(len(x) for x in self.left)
        codes = self.symbols[:-1] * np.int64(size) + self.symbols[1:]
        inside = np.flatnonzero(self.owner[:-1] == self.owner[1:])
        pairs, which, counts = np.unique(codes[inside], return_inverse=True, return_counts=True)
        never = len(pairs)
        rank = np.empty(never, np.int64)
        rank[np.argsort(-counts, kind="stable")] = np.arange(never)
        rank[counts < 2] = never
        # one stretch per group of neighbours of one rank: a word repeated is a pair that overlaps itself
        order = np.full(len(codes) + 2, never + 1)
        order[inside + 1] = rank[which]
        begins = np.flatnonzero(order[1:-1] != order[:-2]) + 1
        lasts = np.r_[begins[1:], len(order) - 1] - 1
        value = order[begins]
        wins = (value < never) & (order[begins - 1] > value) & (order[lasts + 1] > value)
        begins, lasts = begins[wins], lasts[wins]
        row, step = spread((lasts - begins) // 2 + 1)
        first = begins[row] + 2 * step - 1
        pair = codes[first]
        _, which, counts = np.unique(pair, return_inverse=True, return_counts=True)
        twice = counts[which] > 1
        return (first[twice], pair[twice]) if twice.any() else None

    def nodes(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Start, boundary and end of one place of each node: nonterminals first, then the halves of what is left."""
        lengths = self.length[self.terminals :]
        found = [(self.place, self.place + self.length[self.left], self.place + lengths)]
        at, owner = self.at, self.owner
        ends = at + self.length[self.symbols]
        while len(at):
            new = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
            within = np.arange(len(at)) - np.repeat(new, np.diff(np.r_[new, len(at)]))
            pairs = np.flatnonzero((within[:-1] % 2 == 0) & (within[1:] % 2 == 1))
            if not len(pairs):
                break
            found.append((at[pairs], at[pairs + 1], ends[pairs + 1]))
            ends[pairs] = ends[pairs + 1]
            stays = within % 2 == 0
            at, ends, owner = at[stays], ends[stays], owner[stays]
        return tuple(np.concatenate(x) for x in zip(*found))

    def places(self, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rule number and position of every derivation of the rules marked in ``wanted``."""
        holds = np.zeros(self.made, bool)
        holds[self.terminals :] = wanted
        for low, high in self.rounds:
            rules = slice(low - self.terminals, high - self.terminals)
            holds[low:high] |= holds[self.left[rules]] | holds[self.right[rules]]
        some = holds[self.symbols]
        symbols, at, rules, positions = self.symbols[some], self.at[some], [], []
        for low, _ in reversed(self.rounds):
            own = symbols >= low
            rule, here = symbols[own] - self.terminals, at[own]
            rules.append(rule[wanted[rule]])
            positions.append(here[wanted[rule]])
            children = np.r_[self.left[rule], self.right[rule]]
            begin = np.r_[here, here + self.length[self.left[rule]]]
            more = holds[children]
            symbols, at = np.r_[symbols[~own], children[more]], np.r_[at[~own], begin[more]]
        none = np.zeros(0, np.int64)
        return np.concatenate([none, *rules]), np.concatenate([none, *positions])


def runs_of(hashes: np.ndarray, owner: np.ndarray):
    """Text number, start (in all words), length and period of every run, by text, start and period."""
    none = tuple(np.zeros(0, np.int64) for _ in range(4))
    if len(hashes) < LEAST:
        return none
    _, numbers = np.unique(hashes, return_inverse=True)
    grammar = Grammar(numbers, owner)
    low, middle, high = grammar.nodes()
    node, start, end, period = _crossing(hashes, owner, low, middle, high)
    if not len(node):
        return none
    rules = len(grammar.place)
    wanted = np.zeros(rules, bool)
    wanted[node[node < rules]] = True
    rule, at = grammar.places(wanted)
    # every run of a rule, at every place of the rule
    by_rule = np.argsort(node, kind="stable")
    first, last = np.searchsorted(node[by_rule], rule), np.searchsorted(node[by_rule], rule, "right")
    row, step = spread(last - first)
    run = by_rule[first[row] + step]
    moved = at[row] - low[node[run]]
    once = node >= rules
    start, end, period = (
        np.r_[start[once], start[run] + moved], np.r_[end[once], end[run] + moved], np.r_[period[once], period[run]]
    )
    return _maximal(owner, start, end, period)


def _maximal(owner, start, end, period):
    """Intervals that none of the same text and period holds."""
    text = owner[start]
    order = np.lexsort((-end, start, period, text))
    start, end, period, text = start[order], end[order], period[order], text[order]
    new = np.r_[True, (text[1:] != text[:-1]) | (period[1:] != period[:-1])]
    group = np.cumsum(new)
    # ends grow by more than any text from group to group, so one running maximum serves all groups
    far = end + group * np.int64(len(owner) + 1)
    before = np.r_[-1, np.maximum.accumulate(far)[:-1]]
    stays = new | (far > before)
    start, end, period, text = start[stays], end[stays], period[stays], text[stays]
    order = np.lexsort((period, start, text))
    return text[order], start[order], (end - start)[order], period[order]


def _crossing(hashes, owner, low, middle, high):
    """Node, start, end and period of the runs that cross the boundaries of nodes, as far as the nodes reach."""
    big = np.flatnonzero(high - low >= LEAST)
    seeds = rolling(hashes, SEED)
    inside = owner[SEED - 1 :] == owner[: len(seeds)]
    _, kind = np.unique(seeds + owner[: len(seeds)].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15), return_inverse=True)
    spot = np.flatnonzero(inside)
    width = np.int64(len(hashes) + 1)
    keys = np.sort(kind[spot] * width + spot)

    def again(at, first, last):
        """Of seeds at ``at``: the range of the sorted keys of equal seeds from ``first`` to ``last``."""
        base = kind[at] * width
        return np.searchsorted(keys, base + first), np.searchsorted(keys, base + last, "right")

    reach = (high - low) // PERIODS
    ahead = big[(middle[big] + SEED <= high[big])]
    ahead = ahead[middle[ahead] + SEED < high[ahead]]
    behind = big[middle[big] - SEED > low[big]]
    at_a, at_b = middle[ahead], middle[behind] - SEED
    a = again(at_a, at_a + 1, np.minimum(high[ahead] - SEED, at_a + reach[ahead]))
    b = again(at_b, np.maximum(low[behind], at_b - reach[behind]), at_b - 1)
    nodes, at = np.r_[ahead, behind], np.r_[at_a, at_b]
    first, last = np.r_[a[0], b[0]], np.r_[a[1], b[1]]
    some = np.flatnonzero(last > first)
    nodes, at, first, count = nodes[some], at[some], first[some], (last - first)[some]

    compare, found = None, []
    total = np.cumsum(count)
    begin = 0
    while begin < len(nodes):
        stop = max(int(np.searchsorted(total, (total[begin - 1] if begin else 0) + AT_ONCE, "right")), begin + 1)
        row, step = spread(count[begin:stop])
        row += begin
        other = keys[first[row] + step] % width
        i, j = np.minimum(at[row], other), np.maximum(at[row], other)
        node, q = nodes[row], j - i
        compare = compare or Stretches(hashes)
        start = i - compare.backward(i, j, i - low[node])
        end = j + compare.forward(i, j, high[node] - j)
        good = end - start >= np.maximum(LEAST, PERIODS * q)
        node, start, end, q = node[good], start[good], end[good], q[good]
        # of the periods of one stretch the smallest: the others are its multiples
        order = np.lexsort((q, end, start, node))
        node, start, end, q = node[order], start[order], end[order], q[order]
        new = np.ones(len(node), bool)
        new[1:] = (node[1:] != node[:-1]) | (start[1:] != start[:-1]) | (end[1:] != end[:-1])
        found.append((node[new], start[new], end[new], q[new]))
        begin = stop
    if not found:
        return tuple(np.zeros(0, np.int64) for _ in range(4))
    node, start, end, q = (np.concatenate(x) for x in zip(*found))
    order = np.lexsort((q, end, start, node))
    node, start, end, q = node[order], start[order], end[order], q[order]
    new = np.ones(len(node), bool)
    new[1:] = (node[1:] != node[:-1]) | (start[1:] != start[:-1]) | (end[1:] != end[:-1])
    return node[new], start[new], end[new], q[new]


def collapse_runs(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with the runs of each text and what is left without repetitions.

    ``n_words``; ``n_runs``; ``start`` (word number from 0), ``length``, ``period`` and ``exponent_milli`` of the run with the
    greatest length / period (ties: smallest start, then period; null without runs); ``runs``, one line
    ``start,length,period`` for each, by start and period; ``collapsed``, the words without those that a run holds after
    its first period, with one blank between them.
    """

    def maker():
        def compute(data, at):
            texts = len(at) - 1
            starts, ends, owner, hashes = words(data, at)
            base = np.searchsorted(owner, np.arange(texts))
            text, start, length, period = runs_of(hashes, owner)
            gone = np.zeros(len(starts) + 1, np.int64)
            np.add.at(gone, start + period, 1)
            np.add.at(gone, start + length, -1)
            kept = np.cumsum(gone[:-1]) == 0
            # exact: quotients of such small numbers are equal only if the fractions are
            order = np.lexsort((period, start, -(length % np.maximum(period, 1)) / np.maximum(period, 1), -(length // np.maximum(period, 1)), text))
            _, at_best = np.unique(text[order], return_index=True)
            best = order[at_best]
            columns = []
            for values in (start - base[text], length, period, 1000 * length // np.maximum(period, 1)):
                column = np.zeros(texts, np.int64)
                column[text[best]] = values[best]
                empty = np.ones(texts, bool)
                empty[text[best]] = False
                columns.append(pa.array(column, mask=empty))
            lines = [""] * texts
            for t, s, n, p in zip(text.tolist(), (start - base[text]).tolist(), length.tolist(), period.tolist()):
                lines[t] += f"{s},{n},{p}\n"
            return [
                np.diff(np.r_[base, len(owner)]), np.bincount(text, minlength=texts), *columns, lines,
                joined(data, starts[kept], ends[kept], owner[kept], texts),
            ]

        return compute

    made = fields(
        n_words="long", n_runs="long", start="long", length="long", period="long", exponent_milli="long",
        runs="string", collapsed="string",
    )
    return add_text_columns(docs, text, made, maker, drop_text=True)


def looped(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``text`` of ``docs``, with the tails of every tenth text repeated as the query's contract says.

    Let h be the crc32 of the decimal id and g = floor(h / 10). If 10 divides h, word i >= a of the n words becomes word
    a + (i - a) % p, with a = g % n and p = 1 + floor((n - a) / (3 + g % 8)). Rows without an id stay as they are.
    """
    rows = docs.select("doc_id", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in tidy(batches):
            ids = batch.column(0)
            sums = np.array([1 if i is None else zlib.crc32(str(i).encode()) for i in ids.to_pylist()], np.int64)
            for first, data, at in text_slices(batch.column(1)):
                texts = len(at) - 1
                own = sums[first : first + texts]
                changed = np.flatnonzero(own % 10 == 0)
                plain = batch.column(1).slice(first, texts)
                if len(changed):
                    starts, ends, owner, _ = words(data, at)
                    base = np.searchsorted(owner, np.arange(texts + 1))
                    n = np.diff(base)
                    g = own // 10
                    a = g % np.maximum(n, 1)
                    p = 1 + (n - a) // (3 + g % 8)
                    number = np.arange(len(owner)) - base[owner]
                    loops = (own % 10 == 0)[owner] & (number >= a[owner])
                    number[loops] = (a[owner] + (number - a[owner]) % p[owner])[loops]
                    source = base[owner] + number
                    new = joined(data, starts[source], ends[source], owner, texts)
                    plain = pa.compute.if_else(pa.array(own % 10 == 0), new, plain)
                yield pa.RecordBatch.from_arrays([ids.slice(first, texts), plain], names=["doc_id", "text"])

    return rows.mapInArrow(run, rows.schema)


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = collapse_runs(looped(table(spark, sf_dir, "documents")))
    return found.select(
        "doc_id", "n_runs", "start", "length", "period", "exponent_milli",
        F.sha2("runs", 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
