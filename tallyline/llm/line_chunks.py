"""Removal of multi-line passages that many documents share, found as content-defined chunks of lines.

Lines end at ``\\n``. A rolling hash over the hashes of the last one or two lines decides whether a chunk ends here; on
average every second line does, so chunks start again at the same lines wherever a passage stands. Independent
hashes cut each text ``SEEDS`` times, over one line and over two by turns, as few cuttings miss short passages. A
line of ``LONG_WORDS`` words or more is a passage by itself (a paragraph that was never wrapped): it is its own chunk, so that
of a passage of 50 words on one line or two, one chunk at least is always found.

A chunk counts if it has two lines or more with ``LEAST_WORDS`` words together, or is such a long line. Chunks are
counted over all documents. Of equal ones (same hash, then the same bytes) the first by doc_id and position stays, the
others are removed with their line ends. No line is lost everywhere: an occurrence goes only if an earlier one stands.

Null and empty texts stay as they are. A text of which every line is removed becomes empty. Rows with the same doc_id
and text count as one, and all stay. Other columns pass through; a column named ``removed_bytes`` is replaced.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyline.llm.blocks import _BASE, _RANDOM, mix, powers, span_hashes, text_slices, word_spans, tidy
from tallyline.llm.tables import HOT_ROWS, aliased, meet, near, restored, table, without
from tallyline.session import saved

SEEDS = 16
MODULUS = 2
LEAST_WORDS = 10
LONG_WORDS = 25


def lines_of(data: np.ndarray, at: np.ndarray):
    """Starts, ends and text numbers of all lines of the texts that are not empty, and the words in each."""
    full = np.flatnonzero(np.diff(at) > 0)
    breaks = np.flatnonzero(data == 10)
    inside = np.searchsorted(at, breaks, "right") - 1
    owner = np.concatenate([full, inside])
    starts = np.concatenate([at[full], breaks + 1])
    ends = np.concatenate([at[full + 1], breaks])
    by_start, by_end = np.lexsort((owner, starts)), np.lexsort((owner, ends))
    starts, ends, owner = starts[by_start], ends[by_end], owner[by_start]
    begun, _ = word_spans(data, at)
    return starts, ends, owner, np.searchsorted(begun, ends) - np.searchsorted(begun, starts)


def chunks_of(data: np.ndarray, at: np.ndarray):
    """Hash, text number, start and end of every chunk that counts, of all cuttings."""
    starts, ends, owner, words = lines_of(data, at)
    if not len(starts):
        return np.zeros(0, np.uint64), *(np.zeros(0, np.int64) for _ in range(3))
    hashes = span_hashes(data, starts, ends, _RANDOM)
    new_text = np.r_[True, owner[1:] != owner[:-1]]
    long = words >= LONG_WORDS
    before = np.where(new_text, np.uint64(0), np.r_[np.uint64(0), hashes[:-1]])
    found = [(hashes[long], owner[long], starts[long], ends[long])]
    for seed in range(1, SEEDS + 1):
        rolled = hashes * np.uint64(2 * seed + 1)
        rolled = mix(rolled + before * np.uint64(_BASE) if seed % 2 == 0 else rolled)
        close = (rolled % np.uint64(MODULUS) == 0) | long | np.r_[new_text[1:], True] | np.r_[long[1:], False]
        last = np.flatnonzero(close)
        first = np.r_[0, last[:-1] + 1]
        n = last - first + 1
        within = np.arange(len(hashes)) - np.repeat(first, n)
        whole = mix(np.add.reduceat(hashes * powers(int(n.max()) + 1)[within], first) + np.uint64(seed))
        counts = (n > 1) & (np.add.reduceat(words, first) >= LEAST_WORDS)
        found.append((whole[counts], owner[first[counts]], starts[first[counts]], ends[last[counts]]))
    return tuple(np.concatenate(x) for x in zip(*found))


def dedup_lines(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with the later copies of repeated chunks cut out of the text, and ``removed_bytes``."""
    docs = without(docs, ["removed_bytes"])
    plain, names = aliased(docs)
    id_, text_ = (names[docs.columns.index(c)] for c in (doc_id, text))
    # 128 bits name a row by its id and text
    row, twin = F.xxhash64(id_, text_), F.xxhash64(F.lit(1), text_, id_)
    keyed = plain.select(row.alias("row"), twin.alias("twin"), F.col(id_).alias("id"), F.col(text_).alias("text"))
    kind = docs.schema[doc_id].dataType.simpleString()

    def cut(batches):
        for batch in tidy(batches):
            for first, data, at in text_slices(batch.column(3)):
                hashes, owner, starts, ends = chunks_of(data, at)
                own = pa.array(owner + first)
                yield pa.RecordBatch.from_arrays(
                    [
                        *[batch.column(k).take(own) for k in range(3)], pa.array(hashes.view(np.int64)),
                        pa.array(starts - at[owner]), pa.array(ends - at[owner]),
                    ],
                    names=["row", "twin", "id", "hash", "start", "end"],
                )

    chunks = saved(keyed.mapInArrow(cut, f"row long, twin long, id {kind}, hash long, start long, end long"), "chunks")
    repeated = saved(chunks.groupBy("hash").agg(F.count("*").alias("n")).where("n > 1"), "repeated")
    # equal rows count once
    found = saved(meet(chunks, repeated, ["hash"]).distinct(), "repeated")
    place = F.struct("id", "row", "twin", "start")
    firsts = found.groupBy("hash").agg(F.min(place).alias("f"), F.count("*").alias("n"), F.count("*").alias("copies"))
    firsts = saved(firsts, "firsts")
    first = (F.col("row") == F.col("f.row")) & (F.col("twin") == F.col("f.twin")) & (F.col("start") == F.col("f.start"))
    spans = meet(found, firsts, ["hash"]).withColumn("first", first).groupBy("row", "twin").agg(
        F.collect_list(F.struct("hash", "copies", "start", "end", "first")).alias("spans")
    )
    pieces = (
        keyed.join(near(spans, found), ["row", "twin"])
        .select("row", "twin", F.col("text").cast("binary").alias("raw"), F.explode("spans").alias("s"))
        .select("row", "twin", "s.*", F.expr("substring(raw, cast(s.start + 1 as int), cast(s.end - s.start as int))").alias("bytes"))
    )
    pieces = saved(pieces, "pieces", "zstd")
    # the copies of a chunk are dealt over salts, and its first bytes sent to each
    salts = F.floor(F.col("copies") / HOT_ROWS).cast("int")
    kept = pieces.where("first").select("hash", "copies", F.col("bytes").alias("first_bytes")).dropDuplicates(["hash"])
    kept = kept.select("hash", "first_bytes", F.explode(F.sequence(F.lit(0), salts)).alias("salt"))
    copies = pieces.where("not first").withColumn("salt", F.pmod(F.xxhash64("row", "start"), salts + 1).cast("int"))
    gone = (
        copies.join(kept, ["hash", "salt"]).where("bytes = first_bytes")
        .groupBy("row", "twin").agg(F.collect_set(F.struct("start", "end")).alias("gone"))
    )
    rest = near(saved(gone, "removed").toDF("g_row", "g_twin", "gone"), found)
    met = plain.join(rest, (row == F.col("g_row")) & (twin == F.col("g_twin")), "left").select(*names, "gone")
    schema = T.StructType([*plain.schema.fields, T.StructField("removed_bytes", T.LongType())])
    at_text = names.index(text_)

    def rewrite(batches):
        for batch in tidy(batches):
            for first, data, at in text_slices(batch.column(at_text)):
                n = len(at) - 1
                own = [c.slice(first, n) for c in batch.columns[: len(names)]]
                lists = batch.column(len(names)).slice(first, n)
                removed = np.zeros(n, np.int64)
                touched = np.flatnonzero(np.asarray(pa.compute.list_value_length(lists).fill_null(0)))
                if len(touched):
                    raw, whole = data.tobytes(), at.tolist()
                    texts = [raw[a:b] for a, b in zip(whole, whole[1:])]
                    for i in touched.tolist():
                        spans = lists[i].values
                        starts, ends = (spans.field(k).to_numpy() for k in ("start", "end"))
                        cut_text = _left(texts[i], starts, ends)
                        removed[i] = len(texts[i]) - len(cut_text)
                        texts[i] = cut_text
                    empty = np.asarray(own[at_text].is_null())
                    own[at_text] = pa.array(texts, pa.binary(), mask=empty).cast(pa.string())
                yield pa.RecordBatch.from_arrays([*own, pa.array(removed)], names=schema.names)

    return restored(met.mapInArrow(rewrite, schema), names, docs.columns, "removed_bytes")


def _left(raw: bytes, starts: np.ndarray, ends: np.ndarray) -> bytes:
    """The text without these stretches, each with the line break after it, or, where one reaches the text's end, the one
    before it."""
    order = np.lexsort((ends, starts))
    reach = np.maximum.accumulate(ends[order] + 1)
    begins = np.r_[starts[order], len(raw)]
    out = b"".join([raw[a:b] for a, b in zip(np.r_[0, reach].tolist(), begins.tolist()) if b > a])
    return out.removesuffix(b"\n") if ends.max() == len(raw) else out


def op10_line_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", "removed_bytes", "text")
