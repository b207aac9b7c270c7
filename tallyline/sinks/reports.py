"""Side outputs of a run: the malformed lines and the summary."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from tallyline.operators.policy import dead_letters


def write_dead_letters(decoded: DataFrame, path: str, keep: Sequence[str] = ("line_no",)) -> None:
    """The malformed lines as JSON lines, with status and reason."""
    dead_letters(decoded, keep).write.mode("overwrite").json(path)


def write_summary(summary: DataFrame, path: str) -> None:
    """A run summary, a row or one row per file, as JSON lines."""
    summary.coalesce(1).write.mode("overwrite").json(path)


def write_json(rows: DataFrame, path: str) -> None:
    """Report rows as JSON lines."""
    rows.write.mode("overwrite").json(path)
