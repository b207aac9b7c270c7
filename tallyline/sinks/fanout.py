"""One pass over decoded lines that writes everything a run wants to know, each kind of row into its own folder.

Kinds: ``line``, the rendered records, final as they are; ``ledger``, a short row for every line of the input: where it stands,
what became of it, its value; ``dead``, the malformed lines. Numbers of lines are not known in the pass. They come
from the ledger: its rows per split, added up.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from tallyline import schema as S
from tallyline.functions.render import render_line
from tallyline.operators.aggregates import average, fold_columns
from tallyline.operators.decode import is_malformed
from tallyline.operators.exact import exact_fold
from tallyline.session import stored
from tallyline.sinks.lines import file_folder
from tallyline.sinks.publish import exists
from tallyline.sources.lines import BROADCAST_BYTES, SPLIT_NAME

LINE, LEDGER, DEAD = "line", "ledger", "dead"
#: More tasks than this, and the names of their part files no longer sort like their numbers.
MOST_PARTS = 99_999
#: Offsets of so many splits, 32 bytes each, may go through the driver.
FEW_SPLITS = 10_000
STOPPED_AT = "malformed line at "


@dataclass(frozen=True)
class Files:
    """The files of an input, numbered in input order."""

    paths: Sequence[str]

    def table(self, spark: SparkSession) -> DataFrame:
        rows = spark.createDataFrame(list(enumerate(self.paths)), "file_no long, file_path string")
        return F.broadcast(rows) if sum(map(len, self.paths)) <= BROADCAST_BYTES else rows

    def number(self, df: DataFrame) -> DataFrame:
        """Add ``file_no``; a file that was not listed stops the job."""
        if len(self.paths) <= 1:
            return df.withColumn("file_no", F.lit(0).cast("long"))
        unknown = F.raise_error(F.lit("a file came up that was not listed")).cast("long")
        met = df.join(self.table(df.sparkSession), "file_path", "left")
        return met.withColumn("file_no", F.coalesce("file_no", unknown))

    def name(self, df: DataFrame) -> DataFrame:
        """``file_path`` for ``file_no``."""
        return df.join(self.table(df.sparkSession), "file_no").drop("file_no")


def stop_at_malformed() -> Column:
    """The status of a line, or the end of the job and the position of the line if it is malformed."""
    position = F.concat(F.lit(STOPPED_AT), F.to_json(F.struct(F.col("file_path"))))
    return F.when(is_malformed(), F.raise_error(position).cast("string")).otherwise(F.col("status"))


def write_kinds(
    rows: DataFrame, files: Files, path: str, in_order: bool, gzip: bool = False, per_file: bool = False,
    ledger: bool = False, dead: bool = False,
) -> None:
    """Write ``rows`` (positions, record, ``status``, ``kept``; for the dead ``line`` and ``reason``) below ``path``.

    Where the tasks have the splits of the input in order (``in_order``), so have the part files. Else every split gets a
    folder named by its rank, so nothing is sorted but the rows of each task; all rows of a split must be in one task.
    """
    rows = files.number(rows)
    place = file_folder() if per_file else F.format_string(SPLIT_NAME, "file_no", "block_start")
    place = F.lit("all") if in_order else place
    wanted = [F.when(F.col("kept"), F.struct(F.lit(LINE).alias("kind"), place.alias("place"), render_line().alias("line")))]
    if ledger:
        fate = F.when(F.col("kept"), "k").otherwise(F.col("status"))
        text = F.concat_ws(",", "file_no", "block_start", "row_id", fate, F.col(S.VALUE_COLUMN).cast("string"))
        wanted.append(F.struct(F.lit(LEDGER).alias("kind"), F.lit("all").alias("place"), text.alias("line")))
    if dead:
        text = F.to_json(F.struct("file_no", "block_start", "row_id", "line", "status", "reason"))
        wanted.append(F.when(is_malformed(), F.struct(F.lit(DEAD).alias("kind"), F.lit("all").alias("place"), text.alias("line"))))
    if len(wanted) == 1:
        tagged = rows.filter("kept").select("row_id", wanted[0].alias("r"))
    else:
        each = F.explode(F.filter(F.array(*wanted), lambda r: r.isNotNull()))
        tagged = rows.select("row_id", each.alias("r"))
    by = ["kind"] if in_order else ["kind", "file" if per_file else "split"]
    tagged = tagged.select("r.kind", F.col("r.place").alias(by[-1] if not in_order else "place"), "row_id", "r.line")
    if not in_order:
        # the writer wants the rows of a folder together; a sort by these columns keeps the order of lines
        tagged = tagged.sortWithinPartitions(*by, "row_id")
    writer = tagged.select(*by, "line").write.option("lineSep", "\n").partitionBy(*by)
    writer = writer.option("compression", "gzip") if gzip else writer
    with _open_files(rows.sparkSession, len(wanted) if in_order else 0):
        writer.text(path)


@contextmanager
def _open_files(spark: SparkSession, folders: int) -> Iterator[None]:
    """Let each task keep a file open for so many folders, so that their rows need no sort to be parted."""
    key = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(key)
    spark.conf.set(key, str(folders))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    """``file_no, block_start, row_id, status, kept, value`` of every line."""
    parts = F.split(F.col("value"), ",")
    kept = parts[3] == "k"
    return _texts(spark, path).select(
        parts[0].cast("long").alias("file_no"), parts[1].cast("long").alias("block_start"),
        parts[2].cast("long").alias("row_id"), F.when(kept, S.OK).otherwise(parts[3]).alias("status"),
        kept.alias("kept"), F.when(kept, F.get(parts, F.lit(4)).cast("double")).alias(S.VALUE_COLUMN),
        F.lit(True).alias("is_line"),
    )


def read_dead(spark: SparkSession, path: str) -> DataFrame:
    row = "file_no long, block_start long, row_id long, line string, status string, reason string"
    return _texts(spark, path).select(F.from_json("value", row).alias("r")).select("r.*")


def _texts(spark: SparkSession, path: str) -> DataFrame:
    """The rows of a kind; a kind without rows has no folder."""
    if not exists(spark, path):
        return spark.createDataFrame([], "value string")
    return spark.read.schema("value string").text(path)


def split_offsets(ledger: DataFrame) -> DataFrame:
    """For each split, the lines of its file before it and the row id of its first line."""
    splits = ledger.filter("is_line").groupBy("file_no", "block_start").agg(
        F.count(F.lit(1)).alias("in_split"), F.min("row_id").alias("first_row")
    )
    earlier = Window.partitionBy("file_no").orderBy("block_start").rowsBetween(Window.unboundedPreceding, -1)
    return splits.select(
        "file_no", "block_start", "first_row", F.coalesce(F.sum("in_split").over(earlier), F.lit(0)).alias("before")
    )


@contextmanager
def near_offsets(offsets: DataFrame) -> Iterator[DataFrame]:
    """The offsets as a table for a block: of up to ``FEW_SPLITS`` held by the driver, of more stored."""
    few = offsets.limit(FEW_SPLITS + 1).collect()
    if len(few) <= FEW_SPLITS:
        yield F.broadcast(offsets.sparkSession.createDataFrame(few, offsets.schema))
    else:
        with stored(offsets, "offsets") as table:
            yield F.broadcast(table) if table.count() * 64 <= BROADCAST_BYTES else table


def with_numbers(rows: DataFrame, offsets: DataFrame) -> DataFrame:
    """Add ``line_no``, by the offsets of the splits."""
    met = rows.join(offsets, ["file_no", "block_start"])
    number = F.col("row_id") - F.col("first_row") + F.col("before") + 1
    return met.withColumn("line_no", number).drop("first_row", "before")


def fold_ledger(ledger: DataFrame, by: Sequence[str], exact_scale: int | None = None, exact: bool = False) -> DataFrame:
    """Count, sum, min, max and average of the kept, for each group, also where none is kept."""
    if exact:
        return exact_fold(ledger, by, F.when(F.col("kept"), F.col(S.VALUE_COLUMN)))
    folded = ledger.groupBy(*by).agg(*fold_columns(F.col("kept"), exact_scale=exact_scale))
    return folded.withColumn("avg", average())


def summarise_files(ledger: DataFrame, files: Files, exact_scale: int | None = None, exact: bool = False) -> DataFrame:
    """One summary row per input file, files without lines too; the counts add up to those of the run."""
    line, ok = F.col("is_line"), F.col("status") == S.OK
    counts = [
        F.count_if(line).alias("lines_read"),
        F.count_if(line & (F.col("status") == S.BLANK)).alias("blank"),
        F.count_if(line & is_malformed()).alias("malformed"),
        (F.count_if(line & ok) - F.count_if(F.col("kept"))).alias("filtered_out"),
    ]
    folded = fold_ledger(ledger, ["file_no"], exact_scale, exact).drop("avg")
    by_file = ledger.groupBy("file_no").agg(*counts).join(folded, "file_no")
    empty = {"lines_read": 0, "blank": 0, "malformed": 0, "filtered_out": 0, "count": 0, "sum": 0.0,
             "min": float("inf"), "max": float("-inf")}
    all_files = ledger.sparkSession.createDataFrame(list(enumerate(files.paths)), "file_no long, file_path string")
    full = all_files.join(by_file, "file_no", "left").select(
        "file_no", "file_path", *[F.coalesce(c, F.lit(v)).alias(c) for c, v in empty.items()]
    )
    return full.withColumn("records", F.col("count")).withColumn("avg", average())
