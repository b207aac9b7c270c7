"""Random lines against a decoder that reads one character at a time."""

import random

import pytest
from pyspark.sql import functions as F

from tallyline.operators.decode import decode_lines

ALPHABET = ['"', ",", " ", "a", "1", "\t", "　", "é", '""', '",', ',"', "1.5", "\x01"]
WHITE = " \t\n\x0b\x0c\r\x1c\x1d\x1e\x1f　"
LOW = "".join(map(chr, range(33)))


def fields_of(line):
    """The fields, or None where a quoted field does not end properly."""
    fields, i = [], 0
    while True:
        while i < len(line) and line[i] in WHITE:
            i += 1
        text = ""
        if i < len(line) and line[i] == '"':
            i += 1
            while True:
                if i == len(line):
                    return None
                if line[i] != '"':
                    text += line[i]
                    i += 1
                elif line[i + 1:i + 2] == '"':
                    text += '"'
                    i += 2
                else:
                    break
            i += 1
            while i < len(line) and line[i] in WHITE:
                i += 1
            if i < len(line) and line[i] != ",":
                return None
            text = text.strip(LOW)
        else:
            end = line.find(",", i)
            end = len(line) if end < 0 else end
            text, i = line[i:end].strip(LOW + WHITE), end
        fields.append(text)
        if i == len(line):
            return fields
        i += 1


def expected(line):
    if not line:
        return ("blank", None)
    fields = fields_of(line)
    if fields is None:
        return ("bad_quoting", None)
    if len(fields) != 5:
        return ("column_count", None)
    try:
        float(fields[4].replace("_", "x").replace("é", "x").replace(" ", "x"))
    except ValueError:
        return ("non_numeric", tuple(fields[:4]))
    return ("ok", tuple(fields[:4]))


@pytest.mark.parametrize("seed", [1, 2])
def test_random_lines(spark, seed):
    rnd = random.Random(seed)
    lines = []
    for _ in range(20_000):
        if rnd.random() < 0.5:
            line = "".join(rnd.choices(ALPHABET, k=rnd.randrange(14)))
        else:
            fields = ["".join(rnd.choices(ALPHABET, k=rnd.randrange(4))) for _ in range(4)]
            quoted = ['"' + f.replace('"', '""') + '"' if rnd.random() < 0.6 else f for f in fields]
            line = ",".join(quoted + [rnd.choice(["1.5", '" 1 "', "x", ""])])
        lines.append(line)
    df = spark.createDataFrame([(line,) for line in lines], "line string")
    rows = decode_lines(df).select(
        "line", "status", F.struct("timestamp", "level", "source", "message").alias("fields")
    ).collect()
    seen = set()
    for r in rows:
        status, fields = expected(r.line)
        got = None if r.fields.timestamp is None else tuple(r.fields)
        assert (r.status, got) == (status, fields), repr(r.line)
        seen.add(status)
    assert len(seen) == 5
