"""Looking at a large input: every n-th line, and the types of its columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tallyline import schema as S
from tallyline.functions.grammar import JAVA_DOUBLE
from tallyline.operators.decode import decode_lines


def every_nth(lines: DataFrame, n: int, line_no: str = "line_no") -> DataFrame:
    """Lines 1, n + 1, 2n + 1 and so on."""
    if n <= 0:
        raise ValueError("n must be positive")
    return lines.filter((F.col(line_no) - 1) % n == 0)


def infer_types(lines: DataFrame, first: int | None = None) -> DataFrame:
    """The narrowest type that fits every text of a column: one row, five columns.

    Looks at the lines numbered up to ``first``, or at all of them. Lines that
    are not five well-quoted fields have no say; with none left all is string.
    Numbering reads the whole input: ``infer_types(head_lines(spark, path, n))``
    opens only the files that hold the first ``n`` lines.
    """
    if first is not None:
        if first <= 0:
            raise ValueError("the number of lines must be positive")
        lines = lines.filter(F.col("line_no") <= first)
    seen = decode_lines(lines, value_text="_text").filter(F.col("_text").isNotNull())
    texts = {**{name: F.col(name) for name in S.TEXT_COLUMNS}, S.VALUE_COLUMN: F.col("_text")}
    return seen.agg(*[_narrowest(text).alias(name) for name, text in texts.items()])


def _narrowest(text: Column) -> Column:
    whole = F.bool_and(text.rlike(r"^[+-]?\d+$") & text.try_cast("bigint").isNotNull())
    number = F.bool_and(text.rlike(JAVA_DOUBLE))
    time = F.bool_and(
        text.rlike(r"^\d{4}-\d\d-\d\d([T ]|$)") & text.try_cast("timestamp").isNotNull()
    )
    return (
        F.when(whole, F.lit("bigint"))
        .when(number, F.lit("double"))
        .when(time, F.lit("timestamp"))
        .otherwise(F.lit("string"))
    )
