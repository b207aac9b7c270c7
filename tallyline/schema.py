"""The record: five columns in a fixed order, read by position, no header."""

from pyspark.sql import types as T

# The column names, in file order.
TEXT_COLUMNS = ("timestamp", "level", "source", "message")
VALUE_COLUMN = "value"
RECORD_COLUMNS = TEXT_COLUMNS + (VALUE_COLUMN,)

RECORD_SCHEMA = T.StructType(
    [T.StructField(name, T.StringType(), False) for name in TEXT_COLUMNS]
    + [T.StructField(VALUE_COLUMN, T.DoubleType(), False)]
)

# What a line turned out to be. Anything but OK and BLANK is malformed.
OK = "ok"
BLANK = "blank"
BAD_QUOTING = "bad_quoting"
COLUMN_COUNT = "column_count"
NON_NUMERIC = "non_numeric"
NAN_VALUE = "nan_value"
BAD_JSON = "bad_json"
MALFORMED = (BAD_QUOTING, COLUMN_COUNT, NON_NUMERIC, NAN_VALUE, BAD_JSON)

# Where a line came from; the three together sort lines into input order.
INPUT_ORDER = ("file_path", "block_start", "row_id")
