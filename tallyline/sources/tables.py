"""Records from files that are typed already: JSON lines and Parquet."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tallyline import schema as S
from tallyline.functions.numbers import parse_double


def read_jsonl(spark: SparkSession, path: str) -> DataFrame:
    """One JSON object per line with the five columns; other keys are ignored.

    Like decoded CSV lines: an empty line is blank, a line that is no object is
    ``bad_json``, one that lacks a text ``column_count``, and the value, number
    or text, has to read as a double.
    """
    lines = spark.read.text(path).select(
        F.make_valid_utf8("value").alias("line"), F.col("_metadata.file_path").alias("file_path")
    )
    return decode_json(lines).drop("reason")


def decode_json(lines: DataFrame) -> DataFrame:
    """Add the record, ``status`` and ``reason`` to lines of JSON; see ``read_jsonl``."""
    fields = ", ".join(f"{c} STRING" for c in S.RECORD_COLUMNS)
    parsed = F.from_json(
        "line", f"{fields}, _bad STRING", {"columnNameOfCorruptRecord": "_bad"}
    )
    # The generator parses each line once; see decode_lines.
    rows = lines.select("*", F.inline(F.array(F.struct(parsed.alias("_r")))))
    typed = rows.select(*lines.columns, "_r.*").withColumn(
        S.VALUE_COLUMN, parse_double(S.VALUE_COLUMN)
    )
    status = (
        F.when(F.col("line") == "", S.BLANK)
        .when(F.col("_bad").isNotNull(), S.BAD_JSON)
        .otherwise(_status())
    )
    return _with_reason(typed.withColumn("status", status).drop("_bad"))


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    """A Parquet table with the five columns, by name."""
    return as_records(spark.read.parquet(path))


def read_parquet_rows(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """A Parquet table as a run reads it: positions, the record, ``status``, ``reason``, and the row as JSON in ``line``.

    A row's place is its file, the split that it came with, and its number in the file.
    """
    paths = [path] if isinstance(path, str) else list(path)
    rows = spark.read.parquet(*paths).select(
        *S.RECORD_COLUMNS,
        F.col("_metadata.file_path").alias("file_path"),
        F.col("_metadata.file_block_start").alias("block_start"),
        F.col("_metadata.row_index").alias("row_id"),
        F.to_json(F.struct(*S.RECORD_COLUMNS)).alias("line"),
    )
    return _with_reason(as_records(rows))


def as_records(df: DataFrame) -> DataFrame:
    """Bring a table with the five columns to the record types, with a status.

    Columns beyond the five are kept. Filters on the record columns still reach
    a Parquet scan.
    """
    others = [c for c in df.columns if c not in S.RECORD_COLUMNS]
    return df.select(
        *others,
        *[F.col(c).cast("string").alias(c) for c in S.TEXT_COLUMNS],
        F.col(S.VALUE_COLUMN).cast("double").alias(S.VALUE_COLUMN),
    ).withColumn("status", _status())


def _with_reason(df: DataFrame) -> DataFrame:
    words = {
        S.BAD_JSON: "not a JSON object", S.COLUMN_COUNT: "a text column is missing", S.NON_NUMERIC: "no number as value",
        S.NAN_VALUE: "value must not be NaN",
    }
    reason = F.lit(None).cast("string")
    for status, text in words.items():
        reason = F.when(F.col("status") == status, text).otherwise(reason)
    return df.withColumn("reason", reason)


def _status() -> Column:
    value = F.col(S.VALUE_COLUMN)
    missing = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in S.TEXT_COLUMNS])
    return (
        F.when(missing, S.COLUMN_COUNT)
        .when(value.isNull(), S.NON_NUMERIC)
        .when(F.isnan(value), S.NAN_VALUE)
        .otherwise(S.OK)
    )
