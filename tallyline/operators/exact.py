"""Sums of doubles that are the same however rows are spread: added exactly, rounded once.

A double is a whole number of units of some power of two. Values are counted in units that depend on their size alone, one
bin for eight exponents, as 64-bit numbers; whole numbers add up exactly in any order, so bins are ordinary partial
aggregates. Only at the end are the few bins of a group put together and rounded to the nearest double.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from tallyline import schema as S
from tallyline.operators.aggregates import EMPTY, average

#: Exponents in a bin: a mantissa of 53 bits, these, and some for an exponent that is off by one fit in 63 bits.
STEP = 8
BINS = "array<struct<bin:int,total:decimal(38,0)>>"


def _parts(value: Column) -> tuple[Column, Column]:
    """The bin of a finite value, and the value in units of ``2 ** (STEP * bin)``; both null for others."""
    finite = value.isNotNull() & ~F.isnan(value) & (F.abs(value) < F.lit(math.inf))
    exponent = F.floor(F.log2(F.abs(value)))
    bin_ = F.when(finite & (value != 0), F.floor((exponent - 53) / STEP).cast("int"))
    up = -bin_ * STEP
    half = F.floor(up / 2)
    # powers of two, in two steps, as one alone may be beyond the largest double; each product is exact
    units = value * F.pow(F.lit(2.0), half) * F.pow(F.lit(2.0), up - half)
    return bin_, units.cast("long")


def exact_partials(df: DataFrame, by: Sequence[str] = (), value: Column | None = None) -> DataFrame:
    """``count, min, max, bins`` and the counts of infinities and NaN, per group: partials that merge without loss.

    Rows whose value is null name their group and count for nothing, so a group of such rows alone has an empty partial.
    """
    value = F.col(S.VALUE_COLUMN) if value is None else value
    bin_, units = _parts(value)
    rows = df.select(*by, value.alias("v"), bin_.alias("bin"), units.alias("units"))
    binned = rows.groupBy(*by, "bin").agg(
        F.count("v").alias("count"), F.min("v").alias("min"), F.max("v").alias("max"),
        F.sum(F.col("units").cast("decimal(28,0)")).alias("total"),
        F.count_if(F.isnan("v")).alias("nans"),
        F.count_if(F.col("v") == math.inf).alias("highs"), F.count_if(F.col("v") == -math.inf).alias("lows"),
    )
    return _gather(binned.withColumn("some", F.when(F.col("total").isNotNull(), F.struct("bin", "total"))), by)


def _gather(rows: DataFrame, by: Sequence[str]) -> DataFrame:
    """One row per group from one row per bin; no group has more bins than doubles have exponents."""
    sums = [F.coalesce(F.sum(c), F.lit(0).cast("long")).alias(c) for c in ("count", "nans", "highs", "lows")]
    return rows.groupBy(*by).agg(
        *sums,
        F.coalesce(F.min("min"), F.lit(EMPTY["min"])).alias("min"),
        F.coalesce(F.max("max"), F.lit(EMPTY["max"])).alias("max"),
        F.array_sort(F.collect_list("some")).cast(BINS).alias("bins"),
    )


def merge_exact(partials: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Partials of ``exact_partials`` rolled up into coarser groups, bin by bin."""
    others = ["nans", "highs", "lows", "min", "max", "count"]
    each = partials.select(*by, *others, F.posexplode_outer("bins").alias("nth", "one"))
    # a partial's counts go along with the first of its bins
    first = F.coalesce("nth", F.lit(0)) == 0
    binned = each.groupBy(*by, F.col("one.bin").alias("bin")).agg(
        F.sum("one.total").alias("total"),
        *[F.sum(F.when(first, F.col(c))).alias(c) for c in ("count", "nans", "highs", "lows")],
        F.min("min").alias("min"), F.max("max").alias("max"),
    )
    return _gather(binned.withColumn("some", F.when(F.col("bin").isNotNull(), F.struct("bin", "total"))), by)


def finish_exact(partials: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """``count, sum, min, max, avg``: the sum rounded once. Both infinities, or a NaN, sum to NaN."""

    @F.pandas_udf("double")
    def rounded(bins: pd.Series) -> pd.Series:
        return bins.map(lambda rows: _round([(r["bin"], int(r["total"])) for r in rows]))

    special = (
        F.when((F.col("nans") > 0) | ((F.col("highs") > 0) & (F.col("lows") > 0)), F.lit(math.nan))
        .when(F.col("highs") > 0, F.lit(math.inf)).when(F.col("lows") > 0, F.lit(-math.inf))
    )
    summed = partials.withColumn("sum", F.coalesce(special, rounded("bins")))
    return summed.select(*by, "count", "sum", "min", "max").withColumn("avg", average())


def _round(bins: Sequence[tuple[int, int]]) -> float:
    """The double nearest to the sum of ``total * 2 ** (STEP * bin)``, ties to even; infinite beyond the largest."""
    if not bins:
        return 0.0
    lowest = min(b for b, _ in bins)
    whole = sum(total << STEP * (b - lowest) for b, total in bins)
    shift = STEP * lowest
    try:
        return float(whole << shift) if shift >= 0 else whole / (1 << -shift)
    except OverflowError:
        return math.inf if whole > 0 else -math.inf


def exact_fold(df: DataFrame, by: Sequence[str] = (), value: Column | None = None) -> DataFrame:
    """``count, sum, min, max, avg`` with the sum of any doubles exact to the last bit, in any order and partitioning."""
    return finish_exact(exact_partials(df, by, value), by)
