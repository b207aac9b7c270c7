from tallyline.functions.numbers import double_text, parse_double
from tallyline.functions.render import render_line
from tallyline.functions.text import (
    blank_controls,
    escape_field,
    guard_formula,
    quote_field,
    trim_controls,
    trim_spaces,
)

__all__ = [
    "blank_controls",
    "double_text",
    "escape_field",
    "guard_formula",
    "parse_double",
    "quote_field",
    "render_line",
    "trim_controls",
    "trim_spaces",
]
