"""Benchmark passages in documents, by the q-gram lemma in diagonal bands and banded alignment.

Both sides are normalised byte by byte: A-Z lower-cased, every run of ASCII characters that are neither letters nor
digits is one space. Items are cut into windows of ``WINDOW`` normalised bytes, one every ``STRIDE`` and one at the end
(an item shorter than that is one window), so that any ``PASSAGE`` bytes of an item hold a whole window: every passage of
``PASSAGE`` normalised bytes or more (some 13 words) is found, from wherever in an item. A window of w bytes may be found with at most k = w // 10 edits. If it
is, text and window share at least w - q + 1 - q * k of their q-grams (q = 8), all within k diagonals.

1. Every q-gram of a text is one 64-bit integer; a bitmap, then binary search, tells which occur in the items.
2. The hits are counted per item and band of diagonals. Bands are twice as wide as the edits shift, and each overlaps the
   next by half, so the hits of one occurrence are together in one band. A window stays if its band has enough.
3. A window that stands in the text byte for byte is found. Otherwise it is aligned with the band's stretch of text (free
   ends in the text); it is found if at most k edits remain.
4. Found windows of one item that overlap or touch are one region.

Slices of texts are searched in stretches of ``PIECE`` bytes, overlapping by a window and its band, so memory does not
grow with a text. Items go to all tasks in blocks of at most ``ITEM_BYTES`` bytes; more items mean more passes.
Null or empty texts and items, and items of fewer than ``SHORTEST`` normalised bytes, which chance could match, are
found nowhere.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyline.llm.blocks import column_bytes, text_slices, tidy
from tallyline.llm.tables import aliased, near, restored, table
from tallyline.session import saved

Q = 8
PASSAGE = 71
WINDOW = 64
STRIDE = PASSAGE - WINDOW + 1
SHORTEST = 32
PIECE = 1 << 20
_CELLS = 1 << 20
ITEM_BYTES = 16 << 20

_FOLD = np.full(256, 0x20, np.uint8)
_FOLD[0x30:0x3A] = np.arange(0x30, 0x3A)
_FOLD[0x41:0x5B] = np.arange(0x61, 0x7B)
_FOLD[0x61:0x7B] = np.arange(0x61, 0x7B)
_FOLD[0x80:] = np.arange(0x80, 0x100)


def normalised(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Normalised bytes, where each text's begin, and the place of each byte in ``data``."""
    folded = _FOLD[data]
    keep = np.ones(len(data), bool)
    if len(data) > 1:
        keep[1:] = (folded[1:] != 0x20) | (folded[:-1] != 0x20)
    first = at[:-1][np.diff(at) > 0]
    keep[first] = folded[first] != 0x20
    place = np.flatnonzero(keep)
    return folded[place], np.searchsorted(place, at), place


def grams(data: np.ndarray) -> np.ndarray:
    """The q-gram at each position but the last q - 1, as an integer."""
    if len(data) < Q:
        return np.zeros(0, np.uint64)
    raw = np.ascontiguousarray(data)
    return np.ndarray((len(raw) - Q + 1,), "<u8", raw, strides=(1,)).astype(np.uint64)


def _slot(values: np.ndarray) -> np.ndarray:
    return ((values * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(42)).astype(np.int64)


class Items:
    """Normalised items, their windows and a sorted list of their q-grams."""

    def __init__(self, ids: list, texts: list[str]):
        data, at = column_bytes(pa.array(texts, pa.string()))
        self.ids = ids
        self.data, self.at, _ = normalised(data[at[0] : at[-1]], at - at[0])
        every = grams(self.data)
        owner = np.searchsorted(self.at, np.arange(len(every)), "right") - 1
        whole = np.arange(len(every)) + Q <= self.at[owner + 1] if len(every) else np.zeros(0, bool)
        long = np.diff(self.at)[owner] >= SHORTEST
        place = np.flatnonzero(whole & long)
        order = place[np.argsort(every[place], kind="stable")]
        self.grams, first = np.unique(every[order], return_index=True)
        self.first = np.r_[first, len(order)]
        self.posting = order
        self.owner = owner
        self.bitmap = np.zeros(1 << 22, bool)
        self.bitmap[_slot(self.grams)] = True
        item, start, end = [], [], []
        for i, (a, b) in enumerate(zip(self.at[:-1].tolist(), self.at[1:].tolist())):
            if b - a < SHORTEST:
                continue
            starts = [*range(a, b - WINDOW, STRIDE), max(a, b - WINDOW)]
            item += [i] * len(starts)
            start += starts
            end += [min(s + WINDOW, b) for s in starts]
        self.window_item = np.array(item, np.int64)
        self.window_start = np.array(start, np.int64)
        self.window_end = np.array(end, np.int64)
        width = self.window_end - self.window_start
        self.window_need = np.maximum(width - Q + 1 - Q * _budget(width), 1)
        #: The least that a window of the item asks for.
        self.least = np.full(len(ids), 1 << 30, np.int64)
        np.minimum.at(self.least, self.window_item, self.window_need)
        self.item_windows = np.searchsorted(self.window_item, np.arange(len(ids) + 1))


def _budget(width):
    """Edits that a window of this many bytes may need; never so many that no q-gram need be shared."""
    return np.minimum(width // 10, (width - Q) // Q)


#: How far diagonals of one occurrence may lie apart, and half the width of a band.
SHIFT = int(_budget(WINDOW)) + 1


def _pieces(begin: int, end: int) -> Iterator[tuple[int, int]]:
    overlap = 2 * (WINDOW + 4 * SHIFT)
    while True:
        yield begin, min(begin + PIECE, end)
        if begin + PIECE >= end:
            return
        begin += PIECE - overlap


def _candidates(items: Items, plain: np.ndarray, texts: np.ndarray, begin: int, end: int):
    """Windows and bands with enough common q-grams in one stretch of texts: text, window, band, first and last hit.

    ``texts`` are the places in ``plain`` where the texts start and end; no q-gram reaches into the next text."""
    every = grams(plain[begin:end])
    hit = np.flatnonzero(items.bitmap[_slot(every)])
    if not len(hit) or not len(items.grams):
        return
    which = np.searchsorted(items.grams, every[hit])
    which[which == len(items.grams)] = 0
    real = items.grams[which] == every[hit]
    hit, which = hit[real] + begin, which[real]
    owner = np.searchsorted(texts, hit, "right") - 1
    inside = hit + Q <= texts[owner + 1]
    hit, which, owner = hit[inside], which[inside], owner[inside]
    n = items.first[which + 1] - items.first[which]
    here, owner = np.repeat(hit, n), np.repeat(owner, n)
    there = items.posting[np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n) + np.repeat(items.first[which], n)]
    item = items.owner[there]
    band = (here - (there - items.at[item]) + SHIFT * (1 << 24)) // SHIFT
    # each hit is in its own band and in the one below, which reaches up to it; most bands have too few, by a count
    # over hashed bands that can only be too high
    need = items.least[item]
    cell = (band * len(items.ids) + item) & (_CELLS - 1)
    below = ((band - 1) * len(items.ids) + item) & (_CELLS - 1)
    count = np.bincount(cell, minlength=_CELLS)
    count += np.bincount(below, minlength=_CELLS)
    keep, also = count[cell] >= need, count[below] >= need
    owner, item, here, there = (np.concatenate([x[keep], x[also]]) for x in (owner, item, here, there))
    band = np.concatenate([band[keep], band[also] - 1])
    if not len(item):
        return
    order = np.lexsort((there, band, item, owner))
    owner, item, band, here, there = owner[order], item[order], band[order], here[order], there[order]
    new = np.r_[True, (item[1:] != item[:-1]) | (band[1:] != band[:-1]) | (owner[1:] != owner[:-1])]
    first = np.flatnonzero(new)
    size = np.diff(np.r_[first, len(item)])
    seen = np.cumsum(new | np.r_[True, there[1:] != there[:-1]])
    keep = seen[first + size - 1] - seen[first] + 1 >= items.least[item[first]]
    for f, s in zip(first[keep].tolist(), size[keep].tolist()):
        lo, hi = items.item_windows[item[f]], items.item_windows[item[f] + 1]
        starts, ends, need = items.window_start[lo:hi], items.window_end[lo:hi], items.window_need[lo:hi]
        a = f + np.searchsorted(there[f : f + s], starts)
        b = f + np.searchsorted(there[f : f + s], ends - Q, "right")
        for k in np.flatnonzero(b > a).tolist():
            x, y = int(a[k]), int(b[k])
            if seen[y - 1] - seen[x] + 1 >= need[k]:
                diagonal = (int(band[f]) - (1 << 24)) * SHIFT
                yield int(owner[f]), int(lo) + k, diagonal, int(here[x:y].min()), int(here[x:y].max()) + Q


def alignment(pattern: np.ndarray, text: np.ndarray) -> int:
    """The fewest edits that make the pattern a part of the text."""
    row = np.zeros(len(text) + 1, np.int64)
    column = np.arange(len(text) + 1)
    for i, c in enumerate(pattern, 1):
        step = np.empty_like(row)
        step[0] = i
        step[1:] = np.minimum(row[:-1] + (text != c), row[1:] + 1)
        row = np.minimum.accumulate(step - column) + column
    return int(row.min())


def found_regions(items: Items, plain: np.ndarray, texts: np.ndarray) -> list[tuple[int, int, int, int, int, int, int]]:
    """Text, item, start and end in the text, start and end in the item, most edits of a window; all normalised."""
    found: dict[tuple[int, int, int], tuple[int, int, int]] = {}
    aligned: dict[tuple[int, bytes], int] = {}
    for begin, end in _pieces(0, len(plain)):
        for text, window, diagonal, first, last in _candidates(items, plain, texts, begin, end):
            start, stop = int(items.window_start[window]), int(items.window_end[window])
            key = (text, window, first)
            if key in found and found[key][2] == 0:
                continue
            pattern = items.data[start:stop]
            at = diagonal + start - int(items.at[items.window_item[window]])
            low, high = max(at - SHIFT, int(texts[text])), min(at + 3 * SHIFT + len(pattern), int(texts[text + 1]))
            part = plain[low:high]
            # a text that repeats itself has the same stretch again and again
            seen = window, part.tobytes()
            if seen not in aligned:
                aligned[seen] = 0 if pattern.tobytes() in seen[1] else alignment(pattern, part)
            edits = aligned[seen]
            if edits <= int(_budget(stop - start)) and (key not in found or edits < found[key][2]):
                found[key] = (first, last, edits)
    # two bands may see more or less of one occurrence; the better one counts
    once: list[list[int]] = []
    for (t, w, a), (_, b, e) in sorted(found.items()):
        if once and once[-1][:2] == [t, w] and a < once[-1][3]:
            once[-1][3:] = max(once[-1][3], b), min(once[-1][4], e)
        else:
            once.append([t, w, a, b, e])
    rows = sorted(
        (t, int(items.window_item[w]), a - int(texts[t]), b - int(texts[t]), int(items.window_start[w]), int(items.window_end[w]), e)
        for t, w, a, b, e in once
    )
    merged: list[list[int]] = []
    for text, item, a, b, s, e, edits in rows:
        s, e = s - int(items.at[item]), e - int(items.at[item])
        if merged and merged[-1][:2] == [text, item] and a <= merged[-1][3] + Q:
            last = merged[-1]
            last[3], last[4], last[5], last[6] = max(last[3], b), min(last[4], s), max(last[5], e), max(last[6], edits)
        else:
            merged.append([text, item, a, b, s, e, edits])
    return [tuple(m) for m in merged]


def _item_blocks(benchmark: DataFrame, item_id: str, text: str, block_bytes: int) -> Iterator[list]:
    """Items in lists whose texts have at most ``block_bytes`` bytes together (or one item), by id."""
    rows = benchmark.select(F.col(item_id).alias("id"), F.col(text).alias("text")).where("octet_length(text) > 0")
    size = F.octet_length("text").cast("long")
    total = rows.agg(F.sum(size)).first()[0] or 0
    if total <= block_bytes:
        yield rows.orderBy("id", "text").collect()
        return
    running = Window.partitionBy("part").orderBy("id", "text").rowsBetween(Window.unboundedPreceding, 0)
    parted = rows.withColumn("part", F.pmod(F.xxhash64("id", "text"), F.lit(1 + total // block_bytes)))
    numbered = parted.withColumn("block", (F.sum(size).over(running) / block_bytes).cast("long"))
    for r in numbered.groupBy("part", "block").count().orderBy("part", "block").toLocalIterator():
        mine = numbered.where((F.col("part") == r["part"]) & (F.col("block") == r["block"]))
        yield mine.select("id", "text").orderBy("id", "text").collect()


def benchmark_hits(
    docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id",
    item_text: str = "text", block_bytes: int = ITEM_BYTES,
) -> DataFrame:
    """One row per region of a text that repeats an item: doc_id, item_id, doc_start and doc_end (bytes of the text as
    it is, from the first to the last common q-gram), item_start and item_end (bytes of the normalised item), edits
    (the most that one of its windows needed)."""
    id_type, item_type = docs.schema[doc_id].dataType, benchmark.schema[item_id].dataType
    schema = T.StructType([T.StructField("doc_id", id_type), T.StructField("item_id", item_type)])
    for name in ("doc_start", "doc_end", "item_start", "item_end", "edits"):
        schema = schema.add(name, T.LongType())
    source = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    session = docs.sparkSession
    out = session.createDataFrame([], schema)
    for block in _item_blocks(benchmark, item_id, item_text, block_bytes):
        shared = session.sparkContext.broadcast(([r["id"] for r in block], [r["text"] for r in block]))
        out = out.union(source.mapInArrow(_search(shared, schema), schema))
    return out


def _search(shared, schema: T.StructType):
    def run(batches):
        items = Items(*shared.value)
        for batch in tidy(batches):
            rows, owners = [], []
            for first, data, at in text_slices(batch.column(1)):
                plain, begin, place = normalised(data, at)
                for i, item, a, b, s, e, edits in found_regions(items, plain, begin):
                    a, b = place[begin[i] + a] - at[i], place[begin[i] + b - 1] + 1 - at[i]
                    owners.append(first + i)
                    rows.append((items.ids[item], int(a), int(b), s, e, edits))
            if rows:
                columns = list(zip(*rows))
                kind = pa.int64()
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(owners)), pa.array(columns[0]), *[pa.array(c, kind) for c in columns[1:]]],
                    names=schema.names,
                )

    return run


def without_benchmark(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` whose text repeats no item. Rows that share an id go together; a null id always stays."""
    hits = saved(benchmark_hits(docs, benchmark, doc_id, text).select(F.col("doc_id").alias("hit")).distinct(), "hits")
    plain, names = aliased(docs)
    stays = plain.join(near(hits), F.col(names[docs.columns.index(doc_id)]) == F.col("hit"), "left_anti")
    return restored(stays, names, docs.columns)


def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return benchmark_hits(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
