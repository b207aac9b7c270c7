"""Removal of repeated stretches of words, found by fixed blocks as anchors.

A window is ``WINDOW`` neighbouring words of one text. A word goes if a window that covers it stands, word for word, in a
document with a smaller id too. Windows are judged on the texts as given.

- Index. Each text is cut into non-overlapping blocks of half a window from its first word on. Every window holds a whole
  block of its own text, so a repeated window holds a block of the document that it repeats.
- Probes. Every rolling run of as many words, at every offset, is looked up in the index. Probes and blocks are keyed by the
  least hash of the word runs of half a block in them, and neighbouring probes with one key travel as one row, about one for
  seven words. A key is alive if a block of one document and a probe of a later one have it.
- Extension. Windows around live keys are compared in full by the hashes of their two halves (128 bits with the key that
  brings equal windows together); the smallest id that has a window wins, and windows that go join into maximal stretches.
  Windows that share their least word run travel as one row, so that a third of all documents may share a passage without
  a row for each of its words.

Texts with the same words are first brought together by a 128-bit hash, so that of a group of copies one is searched; the
others go whole, if they have a window. Nothing is paired: keys are counted and joined, and of keys with very many rows, at
most ``HOT_KEYS`` whatever the input, the table goes to all tasks instead of their rows to one.

Null, empty and shorter texts have no window and stay. Rows without an id neither lose nor remove words. Rows of one id do
not remove each other's words. Equal rows get equal results. Other columns pass through; columns named as the results are
replaced.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyline.llm.blocks import mix, text_slices, tidy, words
from tallyline.llm.rolling import joined, least_of, rolling
from tallyline.llm.tables import BROADCAST_ROWS, aliased, meet, near, restored, split_hot, table, without
from tallyline.session import saved

WINDOW = 50
#: Windows of one row.
PACKED = 32
_ODD = np.uint64(0x9E3779B97F4A7C15)


def _spans_of(owner: np.ndarray, hashes: np.ndarray, width: int, texts: int):
    """Of a slice: the number of words and the first word of each text, block hashes, and least keys of blocks."""
    base = np.searchsorted(owner, np.arange(texts + 1))
    half = rolling(hashes, width)
    gram = width // 2
    keys = least_of(rolling(hashes, gram), width - gram + 1)
    inside = owner[width - 1 :] == owner[: len(half)] if len(half) else np.zeros(0, bool)
    return base, half, keys, inside


def _lists(values: np.ndarray, owner: np.ndarray, texts: np.ndarray, kind: pa.DataType) -> pa.Array:
    """One list for each of ``texts`` of the values of it; owners ascend."""
    first, last = np.searchsorted(owner, texts), np.searchsorted(owner, texts, "right")
    taken = np.concatenate([values[a:b] for a, b in zip(first.tolist(), last.tolist())] or [values[:0]])
    return pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(last - first)].astype(np.int32)), pa.array(taken, kind))


def _probes(window: int):
    """Of each text with a window: two hashes of all its words, and the keys of its probes and whether a block has one."""
    width = (window + 1) // 2

    def run(batches):
        for batch in tidy(batches):
            for first, data, at in text_slices(batch.column(2)):
                texts = len(at) - 1
                _, _, owner, hashes = words(data, at)
                base, _, keys, inside = _spans_of(owner, hashes, width, texts)
                n = np.diff(base)
                long = np.flatnonzero(n >= window)
                if not len(long):
                    continue
                place = np.arange(len(owner), dtype=np.uint64) - base[owner].astype(np.uint64)
                whole = []
                for seed in (1, 2):
                    sums = np.r_[np.uint64(0), np.cumsum(mix(hashes + mix(place * _ODD + np.uint64(seed))))]
                    whole.append(sums[base[long + 1]] - sums[base[long]])
                spot = np.flatnonzero(inside)
                own, key = owner[spot], keys[spot]
                block = (spot - base[own]) % width == 0
                new = np.ones(len(spot), bool)
                new[1:] = (own[1:] != own[:-1]) | (key[1:] != key[:-1])
                group = np.cumsum(new) - 1
                has_block = np.zeros(int(new.sum()), bool)
                has_block[group[block]] = True
                own, key = own[new], key[new]
                order = np.lexsort((~has_block, key, own))
                own, key, has_block = own[order], key[order], has_block[order]
                new = np.ones(len(own), bool)
                new[1:] = (own[1:] != own[:-1]) | (key[1:] != key[:-1])
                own, key, has_block = own[new], key[new], has_block[new]
                rows = pa.array(long + first)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(rows), batch.column(1).take(rows),
                        *[pa.array(w.view(np.int64)) for w in whole],
                        _lists(key.view(np.int64), own, long, pa.int64()), _lists(has_block, own, long, pa.bool_()),
                    ],
                    names=["id", "mark", "c1", "c2", "keys", "blocks"],
                )

    return run


def _windows(window: int):
    """The windows around live keys, packed by their least word run."""
    width = (window + 1) // 2

    def run(batches):
        for batch in tidy(batches):
            live = batch.column(3)
            for first, data, at in text_slices(batch.column(2)):
                texts = len(at) - 1
                _, _, owner, hashes = words(data, at)
                base, half, keys, inside = _spans_of(owner, hashes, width, texts)
                n = len(hashes) - window + 1
                if n <= 0:
                    continue
                lists = live.slice(first, texts)
                wanted = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
                of = np.repeat(np.arange(texts), np.asarray(lists.value_lengths().fill_null(0)))
                alive = np.zeros(len(half) + 1, np.int64)
                hit = np.isin(mix(keys + owner[: len(keys)].astype(np.uint64) * _ODD), mix(wanted + of.astype(np.uint64) * _ODD))
                np.cumsum(hit & inside, out=alive[1:])
                anchored = alive[window - width + 1 :][:n] > alive[:n]
                spot = np.flatnonzero(anchored & (owner[window - 1 :] == owner[:n]))
                if not len(spot):
                    continue
                gram = width // 2
                least = least_of(rolling(hashes, gram), window - gram + 1)[spot]
                value = mix(half[spot] * _ODD + half[spot + window - width])
                new = np.ones(len(spot), bool)
                new[1:] = (np.diff(spot) > 1) | (least[1:] != least[:-1]) | (owner[spot[1:]] != owner[spot[:-1]])
                begin = np.flatnonzero(new)
                within = np.arange(len(spot)) - np.repeat(begin, np.diff(np.r_[begin, len(spot)]))
                begin = np.flatnonzero(within % PACKED == 0)
                own = owner[spot[begin]]
                rows = pa.array(own + first)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(least[begin].view(np.int64)), batch.column(0).take(rows), batch.column(1).take(rows),
                        pa.array((spot[begin] - base[own]).astype(np.int32)),
                        pa.ListArray.from_arrays(
                            pa.array(np.r_[begin, len(spot)].astype(np.int32)), pa.array(value.view(np.int64))
                        ),
                    ],
                    names=["least", "id", "mark", "first", "windows"],
                )

    return run


def repeated_spans(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", window: int = WINDOW) -> DataFrame:
    """``id``, ``mark`` (hash of the text) and what goes of each text that loses words.

    ``whole`` is true of later copies of a whole text; else ``starts`` and ``ends`` (exclusive) are word numbers.
    """
    if window < 8:
        raise ValueError("a window has at least 8 words")
    kind = docs.schema[doc_id].dataType.simpleString()
    source = docs.select(F.col(doc_id).alias("id"), F.xxhash64(F.col(text)).alias("mark"), F.col(text).alias("text"))
    source = source.where("id is not null and text is not null")
    probes = saved(
        source.mapInArrow(
            _probes(window), f"id {kind}, mark long, c1 long, c2 long, keys array<long>, blocks array<boolean>"
        ), "probes",
    )

    # of the texts with the same words, one is searched: that of the smallest id
    same = probes.groupBy("c1", "c2").agg(F.min("id").alias("least"), F.max("id").alias("most"), F.count("*").alias("n"))
    same = saved(same.where("least < most").select("c1", "c2", "least", "n"), "copies")
    copies = saved(
        meet(probes.select("id", "mark", "c1", "c2"), same, ["c1", "c2"]).where("id > least").select("id", "mark").distinct(),
        "copies",
    )
    probes = probes.join(near(copies), ["id", "mark"], "left_anti")

    zipped = F.explode(F.arrays_zip("keys", "blocks")).alias("k")
    keys = saved(probes.select("id", "mark", zipped).select("id", "mark", F.col("k.keys").alias("key"), F.col("k.blocks").alias("block")), "keys")
    indexed = keys.groupBy("key").agg(
        F.min(F.when(F.col("block"), F.col("id"))).alias("least"), F.max("id").alias("most"), F.count("*").alias("n")
    )
    alive = saved(indexed.where("least < most").select("key", "n"), "alive")
    # up to ``BROADCAST_ROWS`` live keys go to the rows of keys, so that these travel once, to be counted, and not twice
    found = keys.select("id", "mark", "key")
    found = found.join(F.broadcast(alive.drop("n")), "key") if alive.count() <= BROADCAST_ROWS else meet(found, alive, ["key"])
    live = saved(found.groupBy("id", "mark").agg(F.collect_set("key").alias("keys")), "live")
    few = source.join(near(live.select("id", "mark")), ["id", "mark"], "left_semi")
    windows = saved(
        few.join(near(live, live.select(F.explode("keys"))), ["id", "mark"]).select("id", "mark", "text", "keys").mapInArrow(
            _windows(window), f"least long, id {kind}, mark long, first int, windows array<long>"
        ), "windows",
    )

    met = windows.groupBy("least").agg(F.min("id").alias("a"), F.max("id").alias("b"), F.count("*").alias("n"))
    met = saved(met.where("a < b").select("least", "n"), "met")
    hot, _ = split_hot(met)
    each = F.posexplode("windows").alias("o", "value")
    own = ["least", "id", "mark", "first"]
    # all but the hot rows meet by their least word run; equal windows then stand in the same task
    cold = windows.join(hot, "least", "left_anti").repartition("least").select(*own, each)
    smallest = F.min("id").over(Window.partitionBy("least", "value"))
    cold = cold.withColumn("of", smallest).where("of < id").groupBy(*own).agg(F.collect_list("o").alias("o"))
    # the hot ones by their windows
    warm = windows.join(hot, "least").select(*own, each)
    firsts = warm.groupBy("least", "value").agg(F.min("id").alias("of"), F.max("id").alias("b"), F.count("*").alias("n"))
    firsts = saved(firsts.where("of < b").drop("b"), "firsts")
    warm = meet(warm, firsts, ["least", "value"]).where("of < id").groupBy(*own).agg(F.collect_list("o").alias("o"))
    starts = F.array_sort(F.flatten(F.collect_list(F.expr("transform(o, x -> first + x)"))))
    gone = cold.unionByName(warm).groupBy("id", "mark").agg(starts.alias("s"))
    gone = gone.select(
        "id", "mark", F.lit(False).alias("whole"),
        F.expr(f"filter(s, (x, i) -> i = 0 or x - get(s, i - 1) > {window})").alias("starts"),
        F.expr(f"transform(filter(s, (x, i) -> i = size(s) - 1 or get(s, i + 1) - x > {window}), x -> x + {window})").alias("ends"),
    )
    none = F.lit(None).cast("array<int>")
    return saved(gone.unionByName(copies.select("id", "mark", F.lit(True).alias("whole"), none.alias("starts"), none.alias("ends"))), "gone")


def dedup_substrings(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", window: int = WINDOW) -> DataFrame:
    """``docs`` with ``n_words``, ``n_removed`` and ``kept``, the words that stay with one blank between them."""
    docs = without(docs, ["n_words", "n_removed", "kept"])
    gone = repeated_spans(docs, doc_id, text, window).withColumnsRenamed({"id": "g_id", "mark": "g_mark"})
    gone = near(gone, gone.select(F.explode_outer("starts")))
    plain, names = aliased(docs)
    id_, text_ = (names[docs.columns.index(c)] for c in (doc_id, text))
    met = plain.join(gone, (F.col(id_) == F.col("g_id")) & (F.xxhash64(text_) == F.col("g_mark")), "left")
    met = met.select(*names, "whole", "starts", "ends")
    made = [T.StructField("n_words", T.LongType()), T.StructField("n_removed", T.LongType()), T.StructField("kept", T.StringType())]
    schema = T.StructType([*plain.schema.fields, *made])
    at_text = names.index(text_)

    def run(batches):
        for batch in tidy(batches):
            k = len(names)
            whole = np.asarray(batch.column(k).fill_null(False))
            for first, data, at in text_slices(batch.column(at_text)):
                texts = len(at) - 1
                starts, ends, owner, _ = words(data, at)
                base = np.searchsorted(owner, np.arange(texts + 1))
                change = np.zeros(len(owner) + 1, np.int64)
                for column, step in ((k + 1, 1), (k + 2, -1)):
                    lists = batch.column(column).slice(first, texts)
                    of = np.repeat(base[:-1], np.asarray(lists.value_lengths().fill_null(0)))
                    np.add.at(change, of + lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64), step)
                kept = (np.cumsum(change[:-1]) == 0) & ~whole[first : first + texts][owner]
                n = np.diff(base)
                left = np.bincount(owner[kept], minlength=texts)
                own = [c.slice(first, texts) for c in batch.columns[:k]]
                yield pa.RecordBatch.from_arrays(
                    [*own, pa.array(n, pa.int64()), pa.array(n - left, pa.int64()), joined(data, starts[kept], ends[kept], owner[kept], texts)],
                    names=[*names, "n_words", "n_removed", "kept"],
                )

    return restored(met.mapInArrow(run, schema), names, docs.columns, "n_words", "n_removed", "kept")


def op12_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = dedup_substrings(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))
