"""Run summaries: what was read, kept and dropped, and how runs add up."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tallyline import schema as S
from tallyline.operators.aggregates import average, fold_columns
from tallyline.operators.decode import is_malformed


class ReconciliationError(AssertionError):
    """The counts of a run do not add up."""


def line_counts() -> list[Column]:
    """Counts over decoded lines, nothing filtered away."""
    return [
        F.count(F.lit(1)).alias("lines_read"),
        F.count_if(F.col("status") == S.BLANK).alias("blank"),
        F.count_if(is_malformed()).alias("malformed"),
        F.count_if(F.col("status") == S.OK).alias("well_formed"),
    ]


def summarise(
    decoded: DataFrame,
    predicate: Column | None = None,
    value: Column | None = None,
    by: Sequence[str] = (),
    exact_scale: int | None = None,
) -> DataFrame:
    """One summary row, or one per ``by`` (``("file_path",)`` gives one per file).

    A single pass over all decoded lines. ``value`` is the transformed value,
    taken of kept records only; the default is the value as read. A pandas
    predicate sees the other lines too, with NULLs.
    """
    passes = F.lit(True) if predicate is None else F.coalesce(predicate, F.lit(False))
    kept = (F.col("status") == S.OK) & passes
    filtered_out = F.count_if((F.col("status") == S.OK) & ~passes).alias("filtered_out")
    totals = decoded.groupBy(*by).agg(
        *line_counts(), filtered_out, *fold_columns(kept, value, exact_scale)
    )
    return totals.select(
        *by, "lines_read", "blank", "malformed", "filtered_out",
        F.col("count").alias("records"), "count", "sum", "min", "max", average().alias("avg"),
    )


def unreconciled(summary: DataFrame) -> DataFrame:
    """The summary rows whose counts do not add up; there should be none."""
    accounted = F.col("blank") + F.col("malformed") + F.col("filtered_out") + F.col("records")
    return summary.filter(
        (F.col("records") != F.col("count")) | (F.col("lines_read") != accounted)
    )


def append_history(run: DataFrame, path: str) -> None:
    """Add the summary of a run, with its ``duration_s``, to a run-history table."""
    run.select("lines_read", "records", "malformed", "duration_s").write.mode("append").parquet(path)


def run_totals(history: DataFrame) -> DataFrame:
    """Cumulative metrics over all runs of a history table."""
    totals = history.agg(
        F.count(F.lit(1)).alias("runs"),
        *[
            F.coalesce(F.sum(c), F.lit(0)).alias(c)
            for c in ("lines_read", "records", "malformed")
        ],
        F.coalesce(F.sum("duration_s"), F.lit(0.0)).alias("duration_s"),
    )
    return totals.withColumn(
        "lines_per_s", F.try_divide(F.col("lines_read"), F.col("duration_s"))
    )


def read_history(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)
