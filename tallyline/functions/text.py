"""Text expressions: trimming, control characters, quoting, formula guard."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from tallyline.functions.grammar import TRIM_CHARS, WIDE_SPACES

# First characters a spreadsheet takes for the start of a formula.
FORMULA_STARTS = ("=", "+", "-", "@", "\t", "\r")


def trim_controls(name: str) -> Column:
    """Drop blanks and control characters (U+0000 to U+0020) at both ends."""
    return F.expr(trim_controls_sql(name))


def trim_spaces(name: str) -> Column:
    """Like :func:`trim_controls`, and Unicode white space as well."""
    return F.expr(trim_spaces_sql(name))


# As SQL text, since decoding trims every field: a Column of as many nodes takes
# hundreds of calls to the JVM each time a plan is made.


def trim_controls_sql(c: str, edges: str | None = None) -> str:
    """``edges`` is a cheaper text whose ends are blank when those of ``c`` are."""
    return f"CASE WHEN {_solid(edges or c)} THEN {c} ELSE btrim({c}, {_literal(TRIM_CHARS)}) END"


def trim_spaces_sql(c: str, ascii_only: str | None = None) -> str:
    """``ascii_only`` tells that there is no Unicode white space."""
    plain = ascii_only or f"octet_length({c}) = length({c})"
    wide = _literal(TRIM_CHARS + WIDE_SPACES)
    return f"CASE WHEN {plain} AND {_solid(c)} THEN {c} ELSE btrim({c}, {wide}) END"


def _solid(c: str) -> str:
    # Strings compare by bytes, so this looks at the first byte only, and is
    # false for the empty string; the last byte is taken without counting
    # characters. Most fields end solid and skip the trim proper.
    return f"({c} >= '!' AND substring(CAST({c} AS BINARY), -1, 1) >= X'21')"


def _literal(chars: str) -> str:
    return "'" + "".join(f"\\u{ord(c):04x}" for c in chars) + "'"


def blank_controls(c: Column) -> Column:
    """Replace control characters, so that text cannot forge log lines."""
    return F.regexp_replace(c, r"\p{Cntrl}", " ")


def guard_formula(c: Column) -> Column:
    """Put ``'`` before text that a spreadsheet would run as a formula."""
    return F.when(_starts_formula(c), F.concat(F.lit("'"), c)).otherwise(c)


def quote_field(c: Column) -> Column:
    """Quote text that holds a comma or a quote, doubling its quotes."""
    return F.when(_needs_quotes(c), _quoted(c, F.lit('"'))).otherwise(c)


def escape_field(c: Column) -> Column:
    """Formula guard, then quoting: how a text field is written to a line."""
    mark = F.when(_starts_formula(c), F.lit("'")).otherwise(F.lit(""))
    # The guard adds neither comma nor quote, so the bare text decides.
    return F.when(
        _needs_quotes(c), _quoted(c, F.concat(F.lit('"'), mark))
    ).otherwise(F.concat(mark, c))


def _starts_formula(c: Column) -> Column:
    return F.left(c, F.lit(1)).isin(*FORMULA_STARTS)


def _needs_quotes(c: Column) -> Column:
    return F.contains(c, F.lit(",")) | F.contains(c, F.lit('"'))


def _quoted(c: Column, opening: Column) -> Column:
    return F.concat(opening, F.replace(c, F.lit('"'), F.lit('""')), F.lit('"'))
