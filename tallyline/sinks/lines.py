"""Lines to text files, in input order."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from tallyline import schema as S
from tallyline.session import stored
from tallyline.sources.lines import files_in_order, literal


def write_lines(
    df: DataFrame,
    path: str,
    column: str = "line",
    gzip: bool = False,
    order_by: Sequence[str] = (),
) -> None:
    """Write ``column`` as UTF-8 text, one line per row, replacing what is there.

    Rows stay in the order they have, or are sorted by ``order_by``; the part
    files, taken by number, are the output. A failing job publishes nothing.
    """
    rows = df.orderBy(*order_by) if order_by else df
    _text(rows.select(column), gzip).text(path)


def write_one_file(df: DataFrame, path: str, order_by: Sequence[str], column: str = "line") -> None:
    """As ``write_lines`` sorted by ``order_by``, but all lines in one part file.

    Many tasks sort and store the lines; the one task that writes the file
    reads them part by part, in order, and neither sorts nor holds them.
    """
    spark = df.sparkSession
    with stored(df.orderBy(*order_by).select(column), "ordered") as rows:
        # parts are named by their number, of five digits or more
        files = sorted(files_in_order(rows), key=lambda f: (len(f), f))
        parts = [spark.read.schema(rows.schema).parquet(literal(f)) for f in files]
        write_lines(reduce(DataFrame.union, parts, rows.limit(0)).coalesce(1), path, column)


def file_folder() -> Column:
    """``<name>~<mark>`` of the row's file.

    The mark is the crc32 of the file's whole path, whatever other files there
    are, so files of one name stay apart.
    """
    mark = F.lower(F.lpad(F.hex(F.crc32(F.col("file_path").cast("binary"))), 8, "0"))
    return F.concat(F.substring_index("file_path", "/", -1), F.lit("~"), mark)


def write_lines_per_file(
    df: DataFrame, path: str, column: str = "line", gzip: bool = False
) -> None:
    """One folder ``file=<name>~<mark>`` for each input file, each in input order.

    Spark hands out the splits of a file in order, so a sort within each task
    is enough: no rows move, and a file that holds most of the data is still
    written by many tasks.
    """
    rows = df.withColumn("file", file_folder()).sortWithinPartitions("file", *S.INPUT_ORDER)
    _text(rows.select("file", column), gzip).partitionBy("file").text(path)


def _text(rows: DataFrame, gzip: bool):
    writer = rows.write.mode("overwrite").option("lineSep", "\n")
    return writer.option("compression", "gzip") if gzip else writer
