"""What to do about malformed lines: drop and count them, or stop at the first."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from tallyline import schema as S
from tallyline.operators.decode import diagnostic, is_malformed

SKIP = "skip"
FAIL_FAST = "fail_fast"


class MalformedLineError(ValueError):
    """A line could not be decoded and the policy is to stop."""


def records(decoded: DataFrame) -> DataFrame:
    """The well-formed lines; blank and malformed ones are dropped."""
    return decoded.filter(F.col("status") == S.OK)


def skip_malformed(decoded: DataFrame) -> DataFrame:
    return records(decoded)


def fail_fast(decoded: DataFrame, line_no: str = "line_no") -> DataFrame:
    """Raise for the malformed line with the lowest number, if there is one.

    This is a job of its own, run before anything is written: a check inside the
    plan could be skipped by a filter that Spark moves below it.
    """
    message = diagnostic(F.col(line_no), F.col("reason"))
    first = decoded.filter(is_malformed()).agg(F.min_by(message, line_no)).first()[0]
    if first is not None:
        raise MalformedLineError(first)
    return records(decoded)


def apply_policy(decoded: DataFrame, policy: str = SKIP, line_no: str = "line_no") -> DataFrame:
    check_policy(policy)
    return fail_fast(decoded, line_no) if policy == FAIL_FAST else skip_malformed(decoded)


def check_policy(policy: str) -> None:
    if policy not in (SKIP, FAIL_FAST):
        raise ValueError(f"policy must be {SKIP!r} or {FAIL_FAST!r}, not {policy!r}")


def dead_letters(decoded: DataFrame, keep: Sequence[str] = ("line_no",)) -> DataFrame:
    """The malformed lines with what is wrong with them."""
    return decoded.filter(is_malformed()).select(*keep, "line", "status", "reason")
