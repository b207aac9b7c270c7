"""Row filters, as boolean columns over the record columns."""

from __future__ import annotations

import math
from collections.abc import Callable
from functools import reduce

import pandas as pd
from pyspark.sql import Column, functions as F

from tallyline import schema as S


def accept_all() -> Column:
    return F.lit(True)


def level_in(*levels: str) -> Column:
    """Exact, case-sensitive; no levels at all accept everything."""
    return F.col("level").isin(*levels) if levels else accept_all()


def source_in(*sources: str) -> Column:
    """Exact, case-sensitive; no sources at all accept everything."""
    return F.col("source").isin(*sources) if sources else accept_all()


def value_between(low: float | None = None, high: float | None = None) -> Column:
    """Both ends inclusive; a missing end is open."""
    check_range(low, high)
    ends = []
    if low is not None:
        ends.append(F.col(S.VALUE_COLUMN) >= F.lit(float(low)))
    if high is not None:
        ends.append(F.col(S.VALUE_COLUMN) <= F.lit(float(high)))
    return all_of(*ends)


def check_range(low: float | None, high: float | None) -> None:
    if any(end is not None and math.isnan(end) for end in (low, high)):
        raise ValueError("a range needs bounds that are numbers")
    if low is not None and high is not None and low > high:
        raise ValueError("the lower bound must not exceed the upper bound")


def all_of(*predicates: Column) -> Column:
    return reduce(lambda a, b: a & b, predicates) if predicates else accept_all()


def any_of(*predicates: Column) -> Column:
    return reduce(lambda a, b: a | b, predicates) if predicates else ~accept_all()


def matching(test: Callable[[pd.DataFrame], pd.Series]) -> Column:
    """A filter written in pandas, for what columns cannot express.

    ``test`` gets a batch of records and answers with one boolean per row.
    """

    @F.pandas_udf("boolean")
    def run(batch: pd.DataFrame) -> pd.Series:
        return test(batch)

    return run(F.struct(*S.RECORD_COLUMNS))


def build_predicate(
    level: str | None = None,
    source: str | None = None,
    min_value: float | None = None,
    max_value: float | None = None,
) -> Column:
    """The filter that text options describe; options left out add nothing.

    Lists are split at commas and their entries are not trimmed. Blank text, and
    text of commas only, mean no filter.
    """
    parts = []
    for text, member in ((level, level_in), (source, source_in)):
        if text is not None and text.strip():
            # Empty entries at the end of the list do not count.
            parts.append(member(*text.rstrip(",").split(",")) if text.strip(",") else accept_all())
    if min_value is not None or max_value is not None:
        parts.append(value_between(min_value, max_value))
    return all_of(*parts)
