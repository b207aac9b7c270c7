"""Patterns of the line and number grammar (Java regular expressions).

All repetitions are possessive, so matching is linear in the line and uses no
stack, however long a field is.
"""

# The CSV grammar. Blanks around a field are Java white space; a
# quoted field doubles its quotes and ends at a comma or the end of the line;
# an unquoted field may hold quotes, but not start with one.
_SPACE = r"\p{javaWhitespace}*+"
_QUOTED = r'"(?:[^"]++|"")*+"'
_UNQUOTED = r'(?!")[^,]*+'
_FIELD = f"{_SPACE}(?:{_QUOTED}{_SPACE}|{_UNQUOTED})"

WELL_QUOTED = f"^{_FIELD}(?:,{_FIELD})*+$"
FIVE_FIELDS = f"^{_FIELD}(?:,{_FIELD}){{4}}$"

# One field of a well-quoted line that has a comma put before it, so that no
# match is empty. Group 1 is the field without the blanks before it; a quoted
# one keeps its opening quote and loses the closing one.
FIELD = f',{_SPACE}("(?:[^"]++|"")*+|{_UNQUOTED})'

# The texts Java reads as a double.
JAVA_DOUBLE = (
    r"^[\x00-\x20]*+[+-]?(?:NaN|Infinity"
    r"|(?:(?:\d++\.?\d*+|\.\d++)(?:[eE][+-]?\d++)?"
    r"|0[xX](?:[0-9a-fA-F]++\.?|[0-9a-fA-F]*+\.[0-9a-fA-F]++)[pP][+-]?\d++)"
    r"[fFdD]?)[\x00-\x20]*+$"
)

# The characters Java's String.trim removes, and Java's
# white space (Character.isWhitespace) beyond them.
TRIM_CHARS = "".join(map(chr, range(0x21)))
WIDE_SPACES = (
    "        "
    "      　"
)
