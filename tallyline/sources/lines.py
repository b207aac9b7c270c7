"""Text files as lines, with where each line came from and its number."""

from __future__ import annotations

import re
from collections.abc import Sequence
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from tallyline.session import pin_split_plan, saved

# Offsets are broadcast up to this size, some two million splits; more are joined.
BROADCAST_BYTES = 256 * 1024 * 1024


def read_lines(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """Every physical line once, scanned in parallel splits.

    LF, CRLF and CR end a line and are not part of it; a byte order mark at the
    start of a file is dropped; bytes that are no UTF-8 become U+FFFD. A missing
    path fails here. ``file_path, block_start, row_id`` sort into input order.
    """
    pin_split_plan(spark)
    paths = [path] if isinstance(path, str) else list(path)
    return spark.read.text(paths).select(
        F.make_valid_utf8("value").alias("line"),
        F.col("_metadata.file_path").alias("file_path"),
        F.col("_metadata.file_block_start").alias("block_start"),
        F.monotonically_increasing_id().alias("row_id"),
    )


def with_line_numbers(
    lines: DataFrame, across: Sequence[str] = (), broadcast_bytes: int = BROADCAST_BYTES
) -> DataFrame:
    """Add ``line_no``, 1-based in each file, to all the lines of ``read_lines``.

    ``across`` numbers all files as one input instead, in the order of these
    columns, each the same for all lines of a file or of a split.

    Two scans and no shuffle of lines. The first, run at once, counts the lines
    of every split; the counts before a split, added up, number its lines. Row
    ids are consecutive within a split, so one offset per split is enough.
    """
    spark = lines.sparkSession
    split = list(dict.fromkeys(["file_path", "block_start", *across]))
    splits = lines.groupBy(*split).agg(
        F.count(F.lit(1)).alias("in_split"), F.min("row_id").alias("first_row")
    )
    # One row per split, so even a single window over all of them is small.
    files = Window.orderBy(*across) if across else (
        Window.partitionBy("file_path").orderBy("block_start")
    )
    earlier = files.rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("in_split").over(earlier), F.lit(0))
    offsets = saved(
        splits.select("file_path", "block_start", "first_row", before.alias("before")), "splits"
    )
    size = offsets.agg(F.sum(F.octet_length("file_path") + 64)).first()[0] or 0
    if size <= broadcast_bytes:
        offsets = F.broadcast(offsets)

    # Both scans must have cut the files alike; the same task must have read the
    # split. Anything else stops the job instead of giving wrong numbers.
    task = F.shiftright("row_id", 33)
    same = F.col("first_row").isNotNull() & (task == F.shiftright("first_row", 33))
    number = F.col("row_id") - F.col("first_row") + F.col("before") + 1
    moved = F.raise_error(F.lit("the splits changed between two scans of the input")).cast("long")
    return lines.join(offsets, ["file_path", "block_start"], "left").select(
        *[F.col(c) for c in lines.columns], F.when(same, number).otherwise(moved).alias("line_no")
    )


def count_lines(lines: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Lines read, blank and malformed ones included."""
    return lines.groupBy(*by).agg(F.count(F.lit(1)).alias("lines_read"))


def number_of(lines: DataFrame, position) -> int:
    """The line number of one row of ``read_lines`` of a single file, from its three position columns.

    Tasks have the splits of a file in order, so in the first task the row id is the number, and nothing is read.
    """
    if position["row_id"] < 1 << 33:
        return position["row_id"] + 1
    start, row = F.col("block_start"), F.col("row_id")
    earlier = (start < position["block_start"]) | (
        (start == position["block_start"]) & (row < position["row_id"])
    )
    return lines.filter(earlier).count() + 1


def files_in_order(lines: DataFrame) -> list[str]:
    """The files that a plan reads, as ``file_path`` names them, in input order."""
    return sorted({path.replace("file:///", "file:/", 1) for path in lines.inputFiles()})


def literal(path: str) -> str:
    """A path as readers take it, from one as ``file_path`` names it: there a blank is %20, and nothing is a pattern."""
    return re.sub(r"([\[\]{}*?\\])", r"\\\1", unquote(path))


def head_lines(spark: SparkSession, path: str | Sequence[str], n: int) -> DataFrame:
    """The first ``n`` lines with ``line_no``, files in order of their names; later files are not opened.

    The lines go through the driver, so ``n`` is for looking at an input. Of a file no more splits are read than hold them.
    """
    if n <= 0:
        raise ValueError("the number of lines must be positive")
    found = []
    for file in files_in_order(read_lines(spark, path)):
        found += [r[0] for r in read_lines(spark, literal(file)).select("line").take(n - len(found))]
        if len(found) >= n:
            break
    return spark.createDataFrame(list(enumerate(found, start=1)), "line_no long, line string")


def strip_bom(lines: DataFrame, line_no: str = "line_no") -> DataFrame:
    """Drop a byte order mark from line 1 of lines that come from no file."""
    line = F.col("line")
    marked = (F.col(line_no) == 1) & line.startswith("\ufeff")
    return lines.withColumn("line", F.when(marked, F.substring(line, 2, 2**31 - 1)).otherwise(line))


#: In an ordered output of several files: one folder for each split, named by the number of its file and its offset.
SPLIT_NAME = "%010d-%016d"


def read_ordered(spark: SparkSession, path: str) -> DataFrame:
    """The part files of an ordered output, with ``part_no``, a text that sorts like the output, as first sort key.

    That is the name of the split's folder, or else the number of the part: beyond 99,999 parts their names no longer
    sort like the numbers.
    """
    number = F.lpad(F.regexp_extract("file_path", r"/part-(\d+)", 1), 12, "0")
    folder = F.regexp_extract("file_path", r"/split=(\d+-\d+)/", 1)
    return read_lines(spark, path).withColumn("part_no", F.when(folder != "", folder).otherwise(number))


# The order of the splits of an ordered output, and of its lines.
PART_ORDER = ("part_no", "file_path", "block_start")
OUTPUT_ORDER = ("part_no", "block_start", "row_id")
