"""Token ids of all documents as Huffman-coded block files in document order, and reading them back.

``write_token_files`` leaves three tables in a folder:

* ``code``: the code length of each id that occurs, from the counts over all documents;
* ``blocks``: part, block, start (ids before the block in its part), the document ids and lengths, checkpoints
  and bits; a block holds whole documents, in ascending order of doc_id (ties by text, null first);
* ``parts``: how many ids stand before each part.

Parts are ranges of doc_id. Blocks are independent: one is read with the code and its own row alone.
Null and empty texts are the end id alone. An empty table gives empty files.
"""

from __future__ import annotations

import zlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyline.llm import huffman
from tallyline.llm.blocks import text_slices, tidy
from tallyline.llm.bpe import encoder
from tallyline.llm.tables import table
from tallyline.session import shared_folder

END_ID = 0
#: Text of a block; one longer text makes a block of its own.
BLOCK_BYTES = 1 << 20


def token_blocks(docs: DataFrame, vocabulary: str, doc_id: str = "doc_id", text: str = "text", end_id: int = END_ID) -> DataFrame:
    """Plain blocks of ids: part, block, start, n_ids, doc_ids, lengths, ids (little-endian, 2 or 4 bytes each)."""
    kind = docs.schema[doc_id].dataType
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = (
        docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
        .repartitionByRange(parts, "doc_id")
        .sortWithinPartitions("doc_id", "text")
    )
    schema = T.StructType([
        T.StructField("part", T.IntegerType()), T.StructField("block", T.LongType()),
        T.StructField("start", T.LongType()), T.StructField("n_ids", T.LongType()),
        T.StructField("doc_ids", T.ArrayType(kind)), T.StructField("lengths", T.ArrayType(T.LongType())),
        T.StructField("ids", T.BinaryType()),
    ])

    def run(batches):
        own, part, block, start = encoder(vocabulary), TaskContext.get().partitionId(), 0, 0
        width = np.uint16 if own.size <= 1 << 16 else np.uint32
        for batch in tidy(batches):
            for first, data, at in text_slices(batch.column(1), BLOCK_BYTES):
                ids, counts = own.encode(data, at)
                ids = np.insert(ids, np.cumsum(counts), end_id).astype(width)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([part], pa.int32()), pa.array([block], pa.int64()), pa.array([start], pa.int64()),
                        pa.array([len(ids)], pa.int64()), _one_list(batch.column(0).slice(first, len(counts))),
                        _one_list(pa.array(counts + 1, pa.int64())), pa.array([ids.tobytes()], pa.binary()),
                    ],
                    names=schema.names,
                )
                block, start = block + 1, start + len(ids)

    return ordered.mapInArrow(run, schema)


def _one_list(values: pa.Array) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)


def id_counts(blocks: DataFrame, size: int) -> DataFrame:
    """How often each id occurs: one row per id and task, then a sum."""
    width = np.uint16 if size <= 1 << 16 else np.uint32

    def run(batches):
        total = np.zeros(size, np.int64)
        for batch in tidy(batches):
            for ids in batch.column(0):
                total += np.bincount(np.frombuffer(ids.as_buffer(), width), minlength=size)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int64()), pa.array(total[used])], names=["id", "n"])

    return blocks.select("ids").mapInArrow(run, "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))


def write_token_files(
    docs: DataFrame, folder: str, vocabulary: str, doc_id: str = "doc_id", text: str = "text",
    end_id: int = END_ID, longest: int = huffman.MAX_LENGTH,
) -> None:
    """Encode all texts, code the ids by their global counts and write the block files below ``folder``."""
    spark = docs.sparkSession
    size = encoder(vocabulary).size
    token_blocks(docs, vocabulary, doc_id, text, end_id).write.option("compression", "zstd").parquet(f"{folder}/ids")
    blocks = spark.read.parquet(f"{folder}/ids")

    counts = np.zeros(size, np.int64)
    for row in id_counts(blocks, size).collect():  # one row per id of the vocabulary at most
        counts[row["id"]] = row["n"]
    lengths = huffman.code_lengths(counts, longest)
    used = np.flatnonzero(lengths)
    spark.createDataFrame(
        pa.table({"id": pa.array(used, pa.int64()), "length": pa.array(lengths[used], pa.int64())}),
        schema="id long, length long",
    ).coalesce(1).write.parquet(f"{folder}/code")
    codes = huffman.canonical_codes(lengths)
    width = np.uint16 if size <= 1 << 16 else np.uint32

    schema = T.StructType([f for f in blocks.schema if f.name != "ids"])
    schema = schema.add("checkpoints", T.BinaryType()).add("bits", T.BinaryType())

    def run(batches):
        for batch in tidy(batches):
            for k in range(batch.num_rows):
                row = batch.slice(k, 1)
                ids = np.frombuffer(row.column(6)[0].as_buffer(), width).astype(np.int64)
                bits, checkpoints = huffman.encode_block(ids, codes, lengths)
                more = [pa.array([checkpoints.astype("<u4").tobytes()], pa.binary()), pa.array([bits], pa.binary())]
                yield pa.RecordBatch.from_arrays([*row.columns[:6], *more], names=schema.names)

    order = ["part", "block", "start", "n_ids", "doc_ids", "lengths", "ids"]
    blocks.select(order).mapInArrow(run, schema).write.option("compression", "none").parquet(f"{folder}/blocks")
    written = spark.read.parquet(f"{folder}/blocks")
    sums = written.groupBy("part").agg(F.sum("n_ids").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row per part
    sums.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before")).write.parquet(f"{folder}/parts")


@lru_cache(maxsize=2)
def _table(lengths: bytes):
    return huffman.decoding_table(np.frombuffer(lengths, np.int64))


def _read(spark: SparkSession, folder: str, field: T.StructField, per_document) -> DataFrame:
    rows = spark.read.parquet(f"{folder}/code").collect()  # one row per id of the vocabulary at most
    lengths = np.zeros(max((r["id"] for r in rows), default=0) + 1, np.int64)
    for r in rows:
        lengths[r["id"]] = r["length"]
    packed = lengths.tobytes()
    blocks = spark.read.parquet(f"{folder}/blocks")
    kind = blocks.schema["doc_ids"].dataType.elementType
    # one row per part, so at most as many as the files were written with
    blocks = blocks.join(F.broadcast(spark.read.parquet(f"{folder}/parts")), "part").select(
        (F.col("before") + F.col("start")).alias("start"), "n_ids", "doc_ids", "lengths", "checkpoints", "bits"
    )
    schema = T.StructType([
        T.StructField("doc_id", kind), T.StructField("start", T.LongType()),
        T.StructField("n_tokens", T.LongType()), field,
    ])

    def run(batches):
        decoding = _table(packed)
        for batch in tidy(batches):
            for k in range(batch.num_rows):
                start, n, owners, counts, checkpoints, bits = (c[k] for c in batch.columns)
                ids = huffman.decode_block(
                    bits.as_py(), np.frombuffer(checkpoints.as_buffer(), "<u4"), n.as_py(), decoding
                )
                counts = counts.values.to_numpy(zero_copy_only=False)
                ends = np.cumsum(counts)
                yield pa.RecordBatch.from_arrays(
                    [owners.values, pa.array(start.as_py() + ends - counts), pa.array(counts), per_document(ids, ends)],
                    names=schema.names,
                )

    return blocks.mapInArrow(run, schema)


def read_token_files(spark: SparkSession, folder: str) -> DataFrame:
    """doc_id, start (ids of all documents before), n_tokens and ids, from the files alone."""

    def lists(ids, ends):
        return pa.ListArray.from_arrays(pa.array(np.r_[0, ends], pa.int32()), pa.array(ids, pa.int32()))

    return _read(spark, folder, T.StructField("ids", T.ArrayType(T.IntegerType())), lists)


def read_token_digests(spark: SparkSession, folder: str) -> DataFrame:
    """doc_id, start, n_tokens and the crc32 of the ids as little-endian 32-bit integers, from the files alone."""

    def digests(ids, ends):
        raw = memoryview(ids.astype("<u4").tobytes())
        at = [0, *(4 * ends).tolist()]
        return pa.array([zlib.crc32(raw[a:b]) for a, b in zip(at, at[1:])], pa.int64())

    return _read(spark, folder, T.StructField("ids_crc32", T.LongType()), digests)


def op5_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    folder = shared_folder(spark, "token-files")
    write_token_files(table(spark, sf_dir, "documents"), folder, public_tokenizers.path("byte_bpe_50k.json"))
    return read_token_digests(spark, folder)
