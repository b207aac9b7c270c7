"""Text to double and back, by Java's rules."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from tallyline.functions.grammar import JAVA_DOUBLE


def parse_double(name: str) -> Column:
    """The double that Java reads from a text column, NULL where it reads none."""
    return F.expr(parse_double_sql(name))


def parse_double_sql(c: str) -> str:
    # Spark's cast reads what Java reads, and more spellings of infinity and NaN.
    # Those all hold the letter n, and only then is the pattern needed.
    return f"""CASE WHEN (contains({c}, 'n') OR contains({c}, 'N')) AND NOT rlike({c}, r'{JAVA_DOUBLE}')
        THEN NULL ELSE try_cast({c} AS DOUBLE) END"""


def double_text(value: Column) -> Column:
    """``1.0``, ``1.0E7``, ``-0.0``, ``Infinity``: the text Java prints."""
    return value.cast("string")
