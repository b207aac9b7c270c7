"""Record to CSV line."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from tallyline.functions.numbers import double_text
from tallyline.functions.text import escape_field
from tallyline.schema import TEXT_COLUMNS, VALUE_COLUMN


def render_line() -> Column:
    """The line of the record in the current row. The value is never guarded.

    Line breaks in texts (from sources other than lines) become blanks: a record is one line.
    """
    fields = [F.translate(escape_field(F.col(name)), "\r\n", "  ") for name in TEXT_COLUMNS]
    return F.concat_ws(",", *fields, double_text(F.col(VALUE_COLUMN)))
