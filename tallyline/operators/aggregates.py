"""Count, sum, min, max and average: over everything, per batch, and merged."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Row, functions as F

from tallyline import schema as S

# The aggregate of no records.
EMPTY = {"count": 0, "sum": 0.0, "min": math.inf, "max": -math.inf}

NOT_A_NUMBER = "an aggregate came out as NaN"
_LONG_MAX = 2**63 - 1


class AggregateError(ArithmeticError):
    """An aggregate that no set of records can have."""


def fold(df: DataFrame, by: Sequence[str] = (), exact_scale: int | None = None) -> DataFrame:
    """``count, sum, min, max, avg`` of the value, one row, or one row per ``by``.

    Partial sums are added up in no fixed order, and double addition depends on
    the order in its last digits. With ``exact_scale``, values are added as
    decimals with so many places, which is the same however rows are spread;
    infinities, values beyond 28 digits and digits beyond those places make it
    a double sum again: nothing is rounded away.
    """
    return _finish(df.groupBy(*by).agg(*fold_columns(exact_scale=exact_scale)), by)


def fold_columns(
    kept: Column | None = None, value: Column | None = None, exact_scale: int | None = None
) -> list[Column]:
    """The aggregate expressions of :func:`fold`, over rows where ``kept`` holds."""
    value = F.col(S.VALUE_COLUMN) if value is None else value
    if kept is not None:
        value = F.when(kept, value)
    return [
        (F.count(F.lit(1)) if kept is None else F.count_if(kept)).alias("count"),
        F.coalesce(_total(value, exact_scale), F.lit(EMPTY["sum"])).alias("sum"),
        F.coalesce(F.min(value), F.lit(EMPTY["min"])).alias("min"),
        F.coalesce(F.max(value), F.lit(EMPTY["max"])).alias("max"),
    ]


def _total(value: Column, exact_scale: int | None) -> Column:
    if exact_scale is None:
        return F.sum(value)
    decimal = value.try_cast(f"decimal(28,{exact_scale})")
    misfit = F.bool_or(value.isNotNull() & (decimal.isNull() | (decimal.cast("double") != value)))
    return F.when(misfit, F.sum(value)).otherwise(F.sum(decimal).cast("double"))


def average() -> Column:
    """Sum by count; NaN of nothing."""
    return F.when(F.col("count") == 0, F.lit(math.nan)).otherwise(F.col("sum") / F.col("count"))


def fold_by_chunk(df: DataFrame, exact_scale: int | None = None) -> DataFrame:
    """One partial per batch that has records; see ``merge_partials``."""
    return fold(df, by=("chunk_id",), exact_scale=exact_scale)


def fold_batches(lines: DataFrame, kept: DataFrame, exact_scale: int | None = None) -> DataFrame:
    """One partial per file and batch of ``lines``, also where none of its lines is among the ``kept``."""
    keys = ["file_path", "chunk_id"]
    folded = fold(kept, by=keys, exact_scale=exact_scale)
    return lines.select(*keys).distinct().join(folded, keys, "left").select(
        *keys,
        *[F.coalesce(name, F.lit(value)).alias(name) for name, value in EMPTY.items()],
        F.coalesce("avg", F.lit(math.nan)).alias("avg"),
    )


def merge_partials(
    partials: DataFrame, by: Sequence[str] = (), exact_scale: int | None = None
) -> DataFrame:
    """Roll partials up into one aggregate, or into one per ``by``."""
    # The count is added up wider than it is stored, so that an overflow is seen
    # whether or not the session checks long arithmetic.
    count = F.coalesce(F.sum(F.col("count").cast("decimal(19,0)")), F.lit(0).cast("decimal(29,0)"))
    overflow = F.raise_error(F.lit("aggregate count overflow")).cast("long")
    merged = partials.groupBy(*by).agg(
        F.when(count > F.lit(_LONG_MAX), overflow).otherwise(count.cast("long")).alias("count"),
        F.coalesce(_total(F.col("sum"), exact_scale), F.lit(EMPTY["sum"])).alias("sum"),
        F.coalesce(F.min("min"), F.lit(EMPTY["min"])).alias("min"),
        F.coalesce(F.max("max"), F.lit(EMPTY["max"])).alias("max"),
    )
    return _finish(merged, by)


def _finish(aggregate: DataFrame, by: Sequence[str]) -> DataFrame:
    wrong = F.isnan("sum") | F.isnan("min") | F.isnan("max")
    stop = F.raise_error(F.lit(NOT_A_NUMBER)).cast("long")
    count = F.when(wrong, stop).otherwise(F.col("count")).alias("count")
    return aggregate.select(*by, count, "sum", "min", "max", average().alias("avg"))


def check_aggregate(row: Row | dict) -> None:
    """Refuse a negative count and NaN (the sum of both infinities is one)."""
    if row["count"] < 0:
        raise AggregateError("an aggregate counts fewer than no records")
    if any(math.isnan(row[name]) for name in ("sum", "min", "max")):
        raise AggregateError(NOT_A_NUMBER)
