"""Ingestion that can be resumed: each line is decoded and stored exactly once."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from tallyline import schema as S
from tallyline.functions.render import render_line
from tallyline.operators.decode import decode_lines
from tallyline.operators.policy import records
from tallyline.operators.transforms import Transform, filter_then_transform
from tallyline.session import stored
from tallyline.sinks.publish import exists
from tallyline.sources.lines import count_lines, literal, read_lines, with_line_numbers


# A batch is committed, or done over after a crash, as a whole.
BYTES_PER_BATCH = 64 << 30
LEDGER = "file_path string, lines_before long, lines long, batch long"


def read_line_stream(spark: SparkSession, path: str, files_per_batch: int | None = None) -> DataFrame:
    """The lines of a folder to which files are added. Streams have no line order.

    A batch is so many files, or else as many as make ``BYTES_PER_BATCH`` (one file at least).
    """
    reader = spark.readStream
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    else:
        reader = reader.option("maxBytesPerTrigger", str(BYTES_PER_BATCH))
    return reader.text(path).select(
        F.make_valid_utf8("value").alias("line"), F.col("_metadata.file_path").alias("file_path")
    )


def ingest(
    spark: SparkSession,
    path: str,
    output: str,
    checkpoint: str,
    files_per_batch: int | None = None,
) -> None:
    """Decode all files that are new since the last call into a Parquet table.

    The table holds every line, malformed ones with their status, so summaries,
    dead letters and outputs are plain queries over it. After a crash, a call
    with the same checkpoint goes on where the last one was committed.
    """
    decoded = decode_lines(read_line_stream(spark, path, files_per_batch))
    _run(decoded.writeStream.format("parquet"), output, checkpoint)


def ingest_lines(
    spark: SparkSession,
    path: str,
    output: str,
    checkpoint: str,
    predicate: Column | None = None,
    transform: Transform | None = None,
    files_per_batch: int | None = None,
) -> None:
    """Like ``ingest``, but filter, transform and store the rendered lines as text."""
    good = records(decode_lines(read_line_stream(spark, path, files_per_batch)))
    kept = filter_then_transform(good, F.lit(True) if predicate is None else predicate, transform)
    _run(kept.select(render_line().alias("value")).writeStream.format("text"), output, checkpoint)


def ingest_numbered(
    spark: SparkSession, path: str, output: str, checkpoint: str, files_per_batch: int | None = None
) -> None:
    """Like ``ingest``, with ``line_no`` in the file and ``input_no`` in all of the input, files in order of arrival.

    Files of one micro-batch stand in order of their names. A ledger below ``output`` has, for every file, its batch, its
    lines and the lines before it; a batch starts where the ledger of the earlier ones ends. The files of a batch are fixed
    by the checkpoint, and lines and ledger of a batch are written over when it is done again, so a run that was
    interrupted and resumed gives the numbers of one that was not.
    """
    names = read_line_stream(spark, path, files_per_batch).select("file_path")

    def store(batch: DataFrame, number: int) -> None:
        files = [literal(path) for path in sorted(r[0] for r in batch.distinct().collect())]
        if not files:
            return
        before = 0
        if exists(spark, f"{output}/ledger"):
            ledger = spark.read.schema(LEDGER).parquet(f"{output}/ledger").filter(F.col("batch") < number)
            before = ledger.agg(F.sum("lines")).first()[0] or 0
        lines = with_line_numbers(read_lines(spark, files))
        with stored(count_lines(lines, ["file_path"]), "counts") as counts:
            earlier = Window.orderBy("file_path").rowsBetween(Window.unboundedPreceding, -1)
            # one row per file of the batch
            first = F.coalesce(F.sum("lines_read").over(earlier), F.lit(0)) + before
            offsets = counts.select("file_path", first.alias("lines_before"), F.col("lines_read").alias("lines"))
            with stored(offsets, "offsets") as ledger:
                numbered = lines.join(F.broadcast(ledger.drop("lines")) if len(files) <= 1 << 20 else ledger.drop("lines"), "file_path")
                numbered = numbered.withColumn("input_no", F.col("lines_before") + F.col("line_no"))
                decoded = decode_lines(numbered.select("line", "file_path", "line_no", "input_no"))
                decoded.write.mode("overwrite").parquet(f"{output}/lines/batch={number}")
                ledger.write.mode("overwrite").parquet(f"{output}/ledger/batch={number}")

    query = (
        names.writeStream.foreachBatch(store).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )
    query.awaitTermination()


def read_numbered(spark: SparkSession, output: str) -> DataFrame:
    """The lines that ``ingest_numbered`` has stored; ``input_no`` is their order."""
    return spark.read.parquet(f"{output}/lines").drop("batch")


def read_ledger(spark: SparkSession, output: str) -> DataFrame:
    """``file_path, lines_before, lines, batch`` of every file taken in."""
    return spark.read.schema(LEDGER).parquet(f"{output}/ledger")


def _run(writer, output: str, checkpoint: str) -> None:
    query = (
        writer.option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start(output)
    )
    query.awaitTermination()


def read_ingested(spark: SparkSession, output: str) -> DataFrame:
    return spark.read.parquet(output)
