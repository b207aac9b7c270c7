"""Lines to records: quoting, trimming, column count, number, status."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tallyline import schema as S
from tallyline.functions.grammar import FIELD, FIVE_FIELDS, WELL_QUOTED
from tallyline.functions.numbers import parse_double_sql
from tallyline.functions.text import blank_controls, trim_controls_sql, trim_spaces_sql


def decode_lines(
    lines: DataFrame, line: str = "line", value_text: str | None = None
) -> DataFrame:
    """Add the five record columns, ``status`` and ``reason`` to each line.

    One row in, one row out; nothing is dropped here (see ``skip_malformed`` and
    ``fail_fast``). The text columns are NULL where the line has not five
    well-quoted fields, ``value`` where the fifth is no number. ``reason`` says
    in words what is wrong with a malformed line. ``value_text`` names a column
    for the fifth field as text, if that is wanted too.
    """
    text = f"`{line}`"
    names = S.TEXT_COLUMNS + ("_value_text",)
    ends = _once(
        lines,
        _before=f"""CASE WHEN contains({text}, '"') THEN substring_index({text}, '"', 1) END""",
        _after=f"""CASE WHEN contains({text}, '"') THEN substring_index({text}, '"', -1) END""",
    )
    quoted = _once(ends, _quoted=_only_quoted_field(text))
    split = _once(quoted, _raw=_raw_fields(text))
    taken = _once(
        split,
        _ascii=f"octet_length({text}) = length({text})",
        **{f"_{i}": f"CASE WHEN size(_raw) = 5 THEN get(_raw, {i}) END" for i in range(5)},
    )
    cleaned = _once(taken, **{n: _clean(f"_{i}") for i, n in enumerate(names)})
    typed = _once(cleaned, **{S.VALUE_COLUMN: parse_double_sql("_value_text")})
    extra = [f"_value_text AS `{value_text}`"] if value_text else []
    return typed.selectExpr("*", f"{_status(text)} AS status").selectExpr(
        *[f"`{c}`" for c in lines.columns],
        *S.RECORD_COLUMNS,
        "status",
        f"{_reason(text)} AS reason",
        *extra,
    )


def _once(df: DataFrame, **columns: str) -> DataFrame:
    """Add columns, given as SQL text, that are computed once per row, whoever reads them.

    Catalyst copies a plain column's expression into every filter and column
    above it. The one-row generator is a step it does not look through, and it
    keeps the code of each step small enough for the JVM to compile.
    """
    fields = ", ".join(f"{sql} AS `{name}`" for name, sql in columns.items())
    return df.selectExpr("*", f"inline(array(struct({fields})))")


def is_malformed(status: Column | None = None) -> Column:
    status = F.col("status") if status is None else status
    return status.isin(*S.MALFORMED)


def diagnostic(line_no: Column, reason: Column) -> Column:
    """The message for a malformed line, free of control characters."""
    # Fixed value: the message's beginning.
    return F.concat(
        F.lit("Malformed CSV at line "), line_no.cast("string"), F.lit(": "), blank_controls(reason)
    )


def _only_quoted_field(line: str) -> str:
    """What is between the quotes, if the line has one quoted field and no other quotes.

    Cut out by bytes: counting characters costs more than all the rest here.
    """
    width = f"octet_length({line}) - octet_length(_before) - octet_length(_after) - 2"
    inner = f"CAST(substring(CAST({line} AS BINARY), octet_length(_before) + 2, {width}) AS STRING)"
    # Inside, quotes come in pairs only.
    return f"""CASE WHEN {width} >= 0
        AND (_before = '' OR endswith(_before, ',')) AND (_after = '' OR startswith(_after, ','))
        AND NOT contains(replace({inner}, '""', ''), '"') THEN {inner} END"""


def _raw_fields(line: str) -> str:
    """The fields as an array, uncleaned; NULL for a line that the pattern rejects.

    Three ways with one result, cheapest first. A line without quotes splits at
    its commas; so does one with a single quoted field, where ``"`` stands for
    that field. Of all others, quoted fields come with their opening quote and
    without their closing one.
    """
    return f"""CASE
        WHEN _before IS NULL THEN split({line}, ',', -1)
        WHEN _quoted IS NOT NULL THEN split(concat(_before, '"', _after), ',', -1)
        WHEN rlike({line}, r'{FIVE_FIELDS}') THEN {_fields_of(line)} END"""


def _fields_of(well_quoted: str) -> str:
    return f"regexp_extract_all(concat(',', {well_quoted}), r'{FIELD}', 1)"


def _clean(field: str) -> str:
    """Trim a raw field; take a quoted one out of its quotes."""
    rest = f"substring({field}, 2)"
    return f"""CASE
        WHEN NOT startswith({field}, '"') THEN {trim_spaces_sql(field, "_ascii")}
        WHEN {field} IS NOT NULL AND _quoted IS NOT NULL THEN {_unquote("_quoted")}
        ELSE {_unquote(rest)} END"""


def _unquote(inner: str) -> str:
    return trim_controls_sql(f"""replace({inner}, '""', '"')""", edges=inner)


def _status(line: str) -> str:
    return f"""CASE
        WHEN {line} = '' THEN '{S.BLANK}'
        WHEN size(_raw) = 5 THEN CASE
            WHEN {S.VALUE_COLUMN} IS NULL THEN '{S.NON_NUMERIC}'
            WHEN isnan({S.VALUE_COLUMN}) THEN '{S.NAN_VALUE}'
            ELSE '{S.OK}' END
        WHEN _raw IS NOT NULL OR rlike({line}, r'{WELL_QUOTED}') THEN '{S.COLUMN_COUNT}'
        ELSE '{S.BAD_QUOTING}' END"""


def _reason(line: str) -> str:
    # The wording of the reasons.
    found = f"CASE WHEN _raw IS NOT NULL THEN size(_raw) ELSE size({_fields_of(line)}) END"
    return f"""CASE status
        WHEN '{S.COLUMN_COUNT}' THEN concat('expected 5 columns but found ', {found})
        WHEN '{S.NON_NUMERIC}' THEN concat('non-numeric value: \\'', _value_text, '\\'')
        WHEN '{S.NAN_VALUE}' THEN 'value must not be NaN'
        WHEN '{S.BAD_QUOTING}' THEN 'quoted field does not end at a comma or line end' END"""
