"""Near-duplicate documents by min-max hashing of word shingles, links confirmed on full sets.

A document's set is its distinct runs of five lower-cased words (see ``shingle_hashes``). Each of 40 hash functions is
evaluated once per shingle and leaves two values, its minimum and its maximum, so 40 evaluations give a signature of
80; four values (two functions) make one of 20 bands. Two sets of similarity 0.85 share no band with a probability
of 4e-7.

1. Equal sets (by a 128-bit fingerprint) are one class, represented by its smallest doc_id; only classes go on.
2. Classes that share a band meet in blocks of at most ``BLOCK`` members: a band's bucket of any size is cut into
   blocks, and every pair of its blocks meets in one group, so no task holds a bucket and no pair is written out.
   Pairs whose signatures agree in 52 of 80 places (similarity 0.65; a pair at 0.85 falls below with 3e-7) are
   tied together, in the first band that the two share.
3. What is tied together meets again with the full sets, which give all intersections exactly; of the confirmed
   links a spanning forest is written, which has the same components.
4. Connected components over the forest.

A text that is null, empty or without words has an empty set and is linked with nothing; a text of fewer than five words
is one shingle. A row without doc_id is returned unlinked with a null component and is kept. Rows that
repeat a doc_id are all returned, with the smallest component found for any of them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyline.llm.blocks import FOLDED, _BASE, mix, shingle_hashes, text_slices, words, tidy
from tallyline.llm.components import connected_components
from tallyline.llm.tables import near, table
from tallyline.session import saved

WIDTH = 5
PERCENT = 85
FUNCTIONS = 40
BANDS = 20
BLOCK = 512
AGREEING = 52
SALTS = 32
#: Text worked on at once; smaller than elsewhere, as two values per function and shingle are alive.
SLICE = 1 << 20

_MULTIPLY = mix(np.arange(1, FUNCTIONS + 1, dtype=np.uint64) * np.uint64(_BASE)) | np.uint64(1)
_ADD = mix(np.arange(1001, FUNCTIONS + 1001, dtype=np.uint64) * np.uint64(_BASE))


def distinct_sets(data: np.ndarray, at: np.ndarray, width: int = WIDTH) -> list[np.ndarray]:
    """The sorted distinct shingles of each text of a slice."""
    _, _, owner, hashes = words(data, at, FOLDED)
    shingles, owner = shingle_hashes(hashes, owner, width)
    cuts = np.searchsorted(owner, np.arange(len(at)))
    return [np.unique(shingles[a:b]) for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist())]


def min_max(flat: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Signatures (one row per set) of the sets that begin at ``starts``; none is empty."""
    out = np.empty((len(starts), 2 * FUNCTIONS), np.uint32)
    for k in range(FUNCTIONS):
        values = ((flat * _MULTIPLY[k] + _ADD[k]) >> np.uint64(32)).astype(np.uint32)
        out[:, 2 * k] = np.minimum.reduceat(values, starts)
        out[:, 2 * k + 1] = np.maximum.reduceat(values, starts)
    return out


def band_keys(signatures: np.ndarray) -> np.ndarray:
    """One 64-bit key per band; the band's number is part of it."""
    rows = signatures.shape[1] // BANDS
    keys = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64) * np.uint64(_BASE), (len(signatures), BANDS))
    for r in range(rows):
        keys = mix(keys * np.uint64(_BASE) + signatures[:, r::rows].astype(np.uint64))
    return keys


def signatures(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """doc_id, n_shingles, fingerprint (two longs), signature and band keys; the last two null for empty sets."""
    schema = T.StructType([
        T.StructField("doc_id", T.LongType()), T.StructField("n_shingles", T.LongType()),
        T.StructField("f1", T.LongType()), T.StructField("f2", T.LongType()),
        T.StructField("signature", T.BinaryType()), T.StructField("bands", T.ArrayType(T.LongType())),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in tidy(batches):
            for first, data, at in text_slices(batch.column(1), SLICE):
                sets = distinct_sets(data, at, width)
                sizes = np.array([len(s) for s in sets], np.int64)
                full = np.flatnonzero(sizes)
                flat = np.concatenate([*sets, np.zeros(0, np.uint64)])
                starts = (np.cumsum(sizes) - sizes)[full]
                prints = np.zeros((2, len(sets)), np.uint64)
                signed: list = [None] * len(sets)
                keys: list = [None] * len(sets)
                if len(full):
                    prints[0, full] = np.add.reduceat(flat, starts)
                    prints[1, full] = np.bitwise_xor.reduceat(mix(flat * np.uint64(_BASE)), starts)
                    values = min_max(flat, starts)
                    for i, v, k in zip(full.tolist(), values.astype("<u4"), band_keys(values).view(np.int64)):
                        signed[i], keys[i] = v.tobytes(), k
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(first, len(sets)), pa.array(sizes),
                        pa.array(prints[0].view(np.int64)), pa.array(prints[1].view(np.int64)),
                        pa.array(signed, pa.binary()), pa.array(keys, pa.list_(pa.int64())),
                    ],
                    names=schema.names,
                )

    return docs.select("doc_id", "text").mapInArrow(run, schema)


def runs_of(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[pa.Table]:
    """Rows of sorted batches, one table per run of equal values in the first ``keys`` columns."""
    left: list[pa.RecordBatch] = []
    last = None
    for batch in tidy(batches):
        if not batch.num_rows:
            continue
        columns = [batch.column(k).to_numpy(zero_copy_only=False) for k in range(keys)]
        change = np.zeros(batch.num_rows, bool)
        for c in columns:
            change[1:] |= c[1:] != c[:-1]
        cuts = [0, *np.flatnonzero(change).tolist(), batch.num_rows]
        head = tuple(c[0] for c in columns)
        if left and head != last:
            yield pa.Table.from_batches(left)
            left = []
        for a, b in zip(cuts[:-2], cuts[1:-1]):
            yield pa.Table.from_batches([*left, batch.slice(a, b - a)])
            left = []
        left.append(batch.slice(cuts[-2], cuts[-1] - cuts[-2]))
        last = tuple(c[-1] for c in columns)
    if left:
        yield pa.Table.from_batches(left)


def _labels(tied: np.ndarray) -> np.ndarray:
    """The smallest index reachable from each by a symmetric boolean matrix."""
    n = len(tied)
    label = np.arange(n)
    for i in range(n):
        if label[i] == i:
            reached = np.zeros(n, bool)
            front = np.array([i])
            reached[i] = True
            while len(front):
                reach = tied[front].any(0) & ~reached
                reached |= reach
                front = np.flatnonzero(reach)
            label[reached] = i
    return label


def _alike(values: np.ndarray, band: int) -> np.ndarray:
    """Which signatures agree in ``AGREEING`` places and share no band before ``band``; in strips of bounded size."""
    n, width = len(values), values.shape[1] // BANDS
    out = np.empty((n, n), bool)
    step = max(1, (1 << 22) // (n * values.shape[1]))
    for a in range(0, n, step):
        same = values[a : a + step, None, :] == values[None, :, :]
        out[a : a + step] = same.sum(2) >= AGREEING
        if band:
            before = same[:, :, : band * width].reshape(len(same), n, band, width)
            out[a : a + step] &= ~before.all(3).any(2)
    return out


def tied_groups(members: DataFrame) -> DataFrame:
    """``gid``, ``rep``: members that may be alike meet in a group of at most two blocks."""

    def run(batches):
        for rows in runs_of(batches, 3):
            if rows.num_rows < 2:
                continue
            key, i, j = (rows.column(c)[0].as_py() for c in range(3))
            band = rows.column(3)[0].as_py()
            block = rows.column(4).to_numpy()
            values = np.frombuffer(b"".join(rows.column(6).to_pylist()), "<u4").reshape(rows.num_rows, -1)
            tied = _alike(values, band)
            if i != j:
                tied &= block[:, None] != block[None, :]
            np.fill_diagonal(tied, False)
            touched = np.flatnonzero(tied.any(0))
            if not len(touched):
                continue
            label = _labels(tied[np.ix_(touched, touched)])
            salt = mix(np.array([key, i, j], np.int64).view(np.uint64))
            gid = mix((salt * np.array([3, 5, 7], np.uint64)).sum(dtype=np.uint64) + label.astype(np.uint64))
            reps = rows.column(5).to_numpy()[touched]
            yield pa.RecordBatch.from_arrays([pa.array(gid.view(np.int64)), pa.array(reps)], names=["gid", "rep"])

    return (
        members.select("key", "i", "j", "band", "block", "rep", "signature")
        .repartition("key", "i", "j")
        .sortWithinPartitions("key", "i", "j")
        .mapInArrow(run, "gid long, rep long")
    )


def intersections(sets: list[np.ndarray]) -> np.ndarray:
    """How many values each two sets have in common, by products of slices of the membership matrix."""
    n = len(sets)
    if n == 2:
        both = len(np.intersect1d(sets[0], sets[1], assume_unique=True))
        return np.array([[len(sets[0]), both], [both, len(sets[1])]])
    owner = np.repeat(np.arange(n), [len(s) for s in sets])
    _, which, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = times > 1
    number = np.cumsum(shared) - 1
    keep = shared[which]
    owner, column = owner[keep], number[which[keep]]
    out = np.zeros((n, n))
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    step = max(1024, (1 << 23) // n)
    for a in range(0, int(shared.sum()), step):
        lo, hi = np.searchsorted(column, [a, a + step])
        part = np.zeros((n, step), np.float32)
        part[owner[lo:hi], column[lo:hi] - a] = 1
        out += part @ part.T
    out[np.arange(n), np.arange(n)] = [len(s) for s in sets]
    return np.rint(out).astype(np.int64)


def confirmed_links(groups: DataFrame, docs: DataFrame, percent: int = PERCENT, width: int = WIDTH) -> DataFrame:
    """``a``, ``b``: a spanning forest of the links that the full sets confirm within each group."""
    wanted = near(groups.select("rep").distinct())
    texts = docs.select("doc_id", "text").join(wanted, F.col("doc_id") == F.col("rep"), "left_semi")

    def sets_of(batches):
        for batch in tidy(batches):
            for first, data, at in text_slices(batch.column(1), SLICE):
                sets = distinct_sets(data, at, width)
                flat = np.concatenate([*sets, np.zeros(0, np.uint64)]).view(np.int64)
                ends = np.cumsum([0, *[len(s) for s in sets]])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, len(sets)), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat))],
                    names=["rep", "shingles"],
                )

    sets = texts.mapInArrow(sets_of, "rep long, shingles array<bigint>").where(F.size("shingles") > 0)

    def run(batches):
        for rows in runs_of(batches, 1):
            if rows.num_rows < 2:
                continue
            reps = rows.column(1).to_numpy()
            members = rows.column(2).combine_chunks()
            values = members.values.to_numpy().view(np.uint64)
            at = members.offsets.to_numpy()
            found = [values[a:b] for a, b in zip(at[:-1], at[1:])]
            both = intersections(found)
            size = np.array([len(s) for s in found])
            linked = 100 * both >= percent * (size[:, None] + size[None, :] - both)
            np.fill_diagonal(linked, False)
            label = _labels(linked)
            tied = np.flatnonzero(label != np.arange(len(label)))
            if len(tied):
                yield pa.RecordBatch.from_arrays([pa.array(reps[tied]), pa.array(reps[label[tied]])], names=["a", "b"])

    return (
        groups.join(sets, "rep").select("gid", "rep", "shingles")
        .repartition("gid").sortWithinPartitions("gid", "rep")
        .mapInArrow(run, "a long, b long")
    )


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", percent: int = PERCENT, width: int = WIDTH) -> DataFrame:
    """doc_id, n_shingles, component_id (the smallest doc_id of the group) and kept, one row per row of ``docs``."""
    if not 80 <= percent <= 100:
        raise ValueError("bands and agreement are laid out for similarities of 0.8 and more")
    docs = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    signed = saved(signatures(docs, width), "signatures")
    usable = signed.where("n_shingles > 0 and doc_id is not null")
    classes = usable.groupBy("f1", "f2", "n_shingles").agg(F.min("doc_id").alias("rep"), F.count("*").alias("n"))
    own = classes.select(F.col("rep").alias("doc_id"), "f1", "f2")
    reps = usable.join(own, ["doc_id", "f1", "f2"], "left_semi").dropDuplicates(["f1", "f2"])
    reps = reps.withColumnRenamed("doc_id", "rep")
    keys = saved(reps.select("rep", F.posexplode("bands").alias("band", "key")), "bands")
    buckets = keys.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    blocks = F.expr(f"cast(ceil(n / {BLOCK}) as int)")
    placed = keys.join(buckets, "key").select("key", "band", "rep", blocks.alias("blocks"))
    placed = placed.withColumn("block", F.expr("cast(pmod(xxhash64(rep, key), blocks) as int)"))
    placed = placed.select("*", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
    placed = placed.select("key", "band", "rep", "block", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"))
    groups = saved(tied_groups(placed.join(reps.select("rep", "signature"), "rep")), "groups")
    links = confirmed_links(groups, docs, percent, width)
    found = connected_components(links.toDF("a", "b").distinct())
    found = saved(found, "components")
    named = (
        _copies(usable, classes.where("n > 1").join(found, F.col("rep") == F.col("node"), "left"))
        .union(found.select("node", "component"))
        .groupBy("doc_id").agg(F.min("component").alias("found"))
    )
    component = F.when(F.col("n_shingles") > 0, F.coalesce("found", "doc_id")).otherwise(F.col("doc_id"))
    return (
        signed.select("doc_id", "n_shingles").join(named, "doc_id", "left")
        .withColumn("component_id", component)
        .select("doc_id", "n_shingles", "component_id", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)).alias("kept"))
    )


def _copies(usable: DataFrame, classes: DataFrame) -> DataFrame:
    """``doc_id`` and ``component`` of all rows in the given classes.

    One class may hold a large share of the rows, so its rows are dealt out over ``SALTS`` keys."""
    salted = classes.select(
        "f1", "f2", F.coalesce("component", "rep").alias("component"),
        F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"),
    )
    rows = usable.select("doc_id", "f1", "f2", F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)).cast("int").alias("salt"))
    return rows.join(salted, ["f1", "f2", "salt"]).select("doc_id", "component")


def op2_minmax_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))
