"""Record transforms: functions from DataFrame to DataFrame.

They may rewrite the record columns and must keep all others.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from functools import reduce

import pandas as pd
from pyspark.sql import DataFrame, functions as F

from tallyline import schema as S

Transform = Callable[[DataFrame], DataFrame]


def identity() -> Transform:
    return lambda df: df


def scale_value(factor: float) -> Transform:
    """Multiply the value by a finite factor."""
    check_factor(factor)
    return lambda df: df.withColumn(S.VALUE_COLUMN, F.col(S.VALUE_COLUMN) * F.lit(float(factor)))


def check_factor(factor: float) -> None:
    if not math.isfinite(factor):
        raise ValueError("the scale factor must be finite")


def upper_level() -> Transform:
    return lambda df: df.withColumn("level", F.upper("level"))


def chain(*steps: Transform) -> Transform:
    return lambda df: reduce(lambda d, step: step(d), steps, df)


def in_pandas(change: Callable[[pd.DataFrame], pd.DataFrame]) -> Transform:
    """A transform written in pandas, for what columns cannot express.

    ``change`` gets a batch of rows and returns as many rows with the same columns.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield change(batch)

    return lambda df: df.mapInPandas(run, df.schema)


def reject_nan(df: DataFrame) -> DataFrame:
    """Stop the job when a transform has made a value NaN, whatever the policy.

    The check is part of the value itself, so no filter can get ahead of it
    where the value is used.
    """
    value = F.col(S.VALUE_COLUMN)
    error = F.raise_error(F.lit("a transform made a value NaN")).cast("double")
    return df.withColumn(S.VALUE_COLUMN, F.when(F.isnan(value), error).otherwise(value))


def filter_then_transform(df: DataFrame, predicate, transform: Transform | None = None) -> DataFrame:
    """Filter on the values as read, then transform what is left."""
    kept = df.filter(predicate)
    return reject_nan(transform(kept)) if transform else kept
