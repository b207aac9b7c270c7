"""Batches of a fixed number of lines, and their results in order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tallyline import schema as S
from tallyline.functions.render import render_line
from tallyline.operators.aggregates import EMPTY
from tallyline.operators.decode import decode_lines
from tallyline.operators.exact import exact_fold
from tallyline.operators.policy import records
from tallyline.operators.transforms import Transform, filter_then_transform
from tallyline.session import stored
from tallyline.sinks.publish import discard, exists
from tallyline.sources.lines import SPLIT_NAME


def with_chunks(lines: DataFrame, size: int, line_no: str = "line_no") -> DataFrame:
    """Add ``chunk_id`` from 0 and ``start_line`` from 1; the last batch may be short."""
    check_chunk_size(size)
    return lines.withColumn("chunk_id", F.expr(f"(`{line_no}` - 1) div {size}")).withColumn(
        "start_line", F.col("chunk_id") * size + 1
    )


def check_chunk_size(size: int) -> None:
    if size <= 0:
        raise ValueError("the chunk size must be positive")


def chunk_sizes(lines: DataFrame, size: int, by: Sequence[str] = ()) -> DataFrame:
    """``chunk_id, start_line, size`` of every batch; any batch size will do."""
    return with_chunks(lines, size).groupBy(*by, "chunk_id", "start_line").agg(
        F.count(F.lit(1)).alias("size")
    )


def gather_chunks(lines: DataFrame, size: int, by: Sequence[str] = ()) -> DataFrame:
    """One row per batch, with its lines in order as an array.

    A batch has to fit into a row; ``chunk_sizes`` and ``fold_by_chunk`` gather nothing.
    """
    check_chunk_size(size)
    gathered = with_chunks(lines, size).groupBy(*by, "chunk_id", "start_line").agg(
        F.count(F.lit(1)).alias("size"),
        F.sort_array(F.collect_list(F.struct("line_no", "line"))).alias("_lines"),
    )
    return gathered.withColumn("lines", F.col("_lines.line")).drop("_lines")


def process_chunks(
    lines: DataFrame,
    size: int,
    predicate: Column | None = None,
    transform: Transform | None = None,
    by: Sequence[str] = (),
) -> DataFrame:
    """Decode, filter, transform, render and fold each batch of numbered lines.

    One row per batch: ``sequence``, ``partial`` (count, sum, min, max) and
    ``output_lines``, also where no line is left. Within a batch the sum is
    taken in line order, so it never depends on how rows were spread. A batch
    has to fit into a row. Number several files as one, or name them in ``by``.
    """
    check_chunk_size(size)
    chunked = with_chunks(lines, size)
    keys = [*by, "chunk_id"]
    kept = records(decode_lines(chunked.select(*keys, "line_no", "line")))
    kept = filter_then_transform(kept, F.lit(True) if predicate is None else predicate, transform)
    rows = kept.select(
        *keys,
        F.struct("line_no", F.col(S.VALUE_COLUMN).alias("v"), render_line().alias("line")).alias("r"),
    )
    # Every line names its batch, so that none is lost. These rows are not decoded,
    # carry nothing, and fold to one per batch and task before the shuffle.
    names = chunked.select(*keys).withColumn("r", F.lit(None).cast(rows.schema["r"].dataType))
    gathered = rows.unionByName(names).groupBy(*keys).agg(
        F.sort_array(F.collect_list("r")).alias("r")
    )
    values = F.col("r.v")
    partial = F.struct(
        F.size("r").cast("long").alias("count"),
        F.aggregate(values, F.lit(EMPTY["sum"]), lambda total, v: total + v).alias("sum"),
        F.coalesce(F.array_min(values), F.lit(EMPTY["min"])).alias("min"),
        F.coalesce(F.array_max(values), F.lit(EMPTY["max"])).alias("max"),
    )
    return gathered.select(
        *by,
        F.col("chunk_id").alias("sequence"),
        partial.alias("partial"),
        F.col("r.line").alias("output_lines"),
    )


def process_runs(
    lines: DataFrame,
    size: int,
    path: str,
    predicate: Column | None = None,
    transform: Transform | None = None,
    by: Sequence[str] = (),
) -> None:
    """``process_chunks`` for batches of any size: below ``path``, ``lines`` and ``partials`` as Parquet.

    Nothing is gathered. ``lines`` (``sequence, line_no, line``) are dealt by ranges of batch and line and sorted within
    them, so a large batch is many sorted runs in files that follow one another. ``partials`` (``sequence, count, sum, min,
    max``) has every batch; its sums are exact and rounded once, whatever the order. The lines are read and decoded once.
    """
    check_chunk_size(size)
    keys = [*by, "chunk_id"]
    named = [*by, F.col("chunk_id").alias("sequence")]
    decoded = decode_lines(with_chunks(lines, size).select(*keys, "line_no", "line"))
    with stored(decoded.select(*keys, "line_no", *S.RECORD_COLUMNS, "status"), "decoded") as table:
        kept = filter_then_transform(records(table), F.lit(True) if predicate is None else predicate, transform)
        kept = kept.select(*keys, "line_no", S.VALUE_COLUMN, render_line().alias("line"))
        with stored(kept, "changed") as rows:
            ordered = rows.select(*named, "line_no", "line")
            order = [*by, "sequence", "line_no"]
            ordered.repartitionByRange(*order).sortWithinPartitions(*order).write.parquet(f"{path}/lines")
            # every line names its batch, so that none is lost
            names = table.select(*keys, F.lit(None).cast("double").alias(S.VALUE_COLUMN))
            folded = exact_fold(rows.select(*keys, S.VALUE_COLUMN).unionByName(names), keys)
            folded.select(*named, *EMPTY).write.parquet(f"{path}/partials")


def in_input_order(df: DataFrame, keys: Sequence[str] = S.INPUT_ORDER) -> DataFrame:
    """Files by name, splits by offset, lines as they stand."""
    return df.orderBy(*keys)


def resequence(results: DataFrame) -> DataFrame:
    """The output lines of batch results that arrived in any order.

    Lines come in order of ``sequence``, up to the first number that is missing;
    ``sequence`` is unique and starts at 0. The results are read for the missing
    number, for the sort's ranges and for the lines: pass a stored table.
    """
    gap = _first_missing(results, 0)
    return (
        results.filter(F.col("sequence") < gap.scalar())
        .select("sequence", F.posexplode("output_lines").alias("pos", "line"))
        .orderBy("sequence", "pos")
    )


def _first_missing(results: DataFrame, start: int) -> DataFrame:
    """The smallest number from ``start`` on that no result has, as one row."""
    # Number n is missing when n - 1 is there (or n is the start) and n is not.
    present = results.select(F.col("sequence").alias("n"), F.lit(True).alias("there"))
    due = results.select((F.col("sequence") + 1).alias("n"), F.lit(False).alias("there"))
    first = results.sparkSession.range(start, start + 1).select(F.col("id").alias("n"), F.lit(False).alias("there"))
    return (
        present.unionByName(due).unionByName(first)
        .groupBy("n").agg(F.bool_or("there").alias("there"))
        .filter(~F.col("there"))
        .agg(F.min("n"))
    )


class Resequencer:
    """Puts batch results that arrive in several calls into order, and gives out each line once.

    ``folder`` holds what lasts from call to call: the number that is due, and the results that wait for it. Lines go to
    ``output`` as Parquet (``sequence, pos, line``), a folder ``split=<first>-<end>`` for each call that brought some; the
    names sort like the lines. The state is written last and in one file, so a call that fails can be made again: what it had
    written is written over. Results with a number that was given out, or that waits already, are passed over.
    """

    def __init__(self, spark: SparkSession, folder: str, output: str):
        self.spark, self.folder, self.output = spark, folder.rstrip("/"), output.rstrip("/")

    def state(self) -> tuple[int, int]:
        """The number of calls made, and the sequence number that is due."""
        if not exists(self.spark, f"{self.folder}/due"):
            return 0, 0
        # appended to by one small file per call; the last one counts
        row = self.spark.read.json(f"{self.folder}/due", schema="call long, due long").orderBy(F.desc("call")).first()
        return (row["call"], row["due"]) if row else (0, 0)

    def deliver(self, results: DataFrame) -> tuple[int, int]:
        """Take in results (``sequence, output_lines``); the range of numbers given out by this call, the end exclusive."""
        call, due = self.state()
        arrived = results.select("sequence", "output_lines").filter(F.col("sequence") >= due)
        if call:
            before = self.spark.read.parquet(f"{self.folder}/waiting-{call}").filter(F.col("sequence") >= due)
            new = arrived.join(before, "sequence", "left_anti")
            arrived = before.unionByName(new)
        place = f"{self.folder}/waiting-{call + 1}"
        arrived.dropDuplicates(["sequence"]).write.mode("overwrite").parquet(place)
        waiting = self.spark.read.parquet(place)
        end = _first_missing(waiting, due).first()[0]
        if end > due:
            lines = waiting.filter(F.col("sequence") < end).select(
                "sequence", F.posexplode("output_lines").alias("pos", "line")
            )
            name = SPLIT_NAME % (due, end)
            lines.orderBy("sequence", "pos").write.mode("overwrite").parquet(f"{self.output}/split={name}")
        now = self.spark.createDataFrame([(call + 1, end)], "call long, due long")
        now.coalesce(1).write.mode("append").json(f"{self.folder}/due")
        if call:
            discard(self.spark, f"{self.folder}/waiting-{call}")
        return due, end
