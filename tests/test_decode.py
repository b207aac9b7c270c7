import math

import pytest
from pyspark.sql import functions as F

from tallyline.functions.grammar import FIELD
from tallyline.operators.decode import decode_lines
from tallyline.operators.policy import MalformedLineError, apply_policy, fail_fast, records
from tallyline.sources.lines import read_lines, strip_bom, with_line_numbers


def lines_of(spark, *lines):
    rows = [(i, line) for i, line in enumerate(lines, start=1)]
    return spark.createDataFrame(rows, "line_no long, line string").repartition(3)


def decoded(spark, *lines):
    rows = decode_lines(lines_of(spark, *lines)).orderBy("line_no").collect()
    return [(r.timestamp, r.level, r.source, r.message, r.value, r.status) for r in rows]


GOOD = {
    "1999-12-31 23:59:58,HIGH,boiler 3,valve open,-17.25":
        ("1999-12-31 23:59:58", "HIGH", "boiler 3", "valve open", -17.25),
    '0915,LOW,pump,"slow, then fast",8': ("0915", "LOW", "pump", "slow, then fast", 8.0),
    '0915,LOW,pump,"the ""big"" one",8': ("0915", "LOW", "pump", 'the "big" one', 8.0),
    "  0915,LOW  ,   pump ,idle ,  8  ": ("0915", "LOW", "pump", "idle", 8.0),
    '\t"ts" , "IN,FO" ,s, " m ""x"" " ,"1.5"': ("ts", "IN,FO", "s", 'm "x"', 1.5),
    ',,,,1': ("", "", "", "", 1.0),
    ',"",,"",1': ("", "", "", "", 1.0),
    'a,"",,"b,c",1': ("a", "", "", "b,c", 1.0),
    'a,b"q",c"",d,1e3': ("a", 'b"q"', 'c""', "d", 1000.0),
    'a,b,c,"""",1': ("a", "b", "c", '"', 1.0),
    '"a","b","c","d,e","1.5"': ("a", "b", "c", "d,e", 1.5),
    "　a ,b,c,d,1": ("a", "b", "c", "d", 1.0),
    'a,b,c,"　d ",1': ("a", "b", "c", "　d", 1.0),
    "a ,b,c,d,1": ("a ", "b", "c", "d", 1.0),
    "\x01a\x02,b,c,d,\x031\x04": ("a", "b", "c", "d", 1.0),
}

BAD = {
    "": "blank",
    "   ": "column_count",
    "0915,LOW,pump": "column_count",
    "0915,LOW,pump,idle,8,9,": "column_count",
    '"a,b",c,d,1': "column_count",
    "0915,LOW,pump,idle,eight": "non_numeric",
    "0915,LOW,pump,idle,": "non_numeric",
    'a,b,c,d,""': "non_numeric",
    "a,b,c,d,nan": "non_numeric",
    "a,b,c,d,inf": "non_numeric",
    "a,b,c,d,infinity": "non_numeric",
    "a,b,c,d,1 2": "non_numeric",
    "a,b,c,d,0x10": "non_numeric",
    "a,b,c,d,NaN": "nan_value",
    "a,b,c,d,-NaN": "nan_value",
    'a,b,c,"x"y,1': "bad_quoting",
    'a,b,c,"x,1': "bad_quoting",
    'a,b,c,""",1': "bad_quoting",
    '"': "bad_quoting",
    '","': "column_count",
}


def test_good_lines(spark):
    got = decoded(spark, *GOOD)
    assert got == [(*want, "ok") for want in GOOD.values()]


def test_bad_lines(spark):
    got = [row[-1] for row in decoded(spark, *BAD)]
    assert got == list(BAD.values())


NUMBERS = {
    "1": 1.0, "+1.5": 1.5, "-.5": -0.5, "5.": 5.0, "1e3": 1000.0, "1E-3": 0.001, "1d": 1.0,
    "2.5F": 2.5, "0x1p3": 8.0, "0x.8P1f": 1.0, "Infinity": math.inf, "-Infinity": -math.inf,
    "+Infinity": math.inf, "1e999": math.inf, "-0.0": -0.0,
}


def test_numbers_as_java_reads_them(spark):
    got = decoded(spark, *[f"a,b,c,d,{text}" for text in NUMBERS])
    assert [r[4] for r in got] == list(NUMBERS.values())
    refused = ["", "e5", "1e", "--1", "1_000", "1,5", "NANA", "Infinit", "INF", "+inf", "0x1", "1dd"]
    got = decoded(spark, *[f'a,b,c,d,"{text}"' for text in refused])
    assert [r[-1] for r in got] == ["non_numeric"] * len(refused)


def test_quoted_and_unquoted_ways_agree(spark):
    """Lines without quotes are split at commas; the pattern gives the same fields."""
    plain = ["a,b,c,d,1", ",,,,", " a , b,c ,d, 1 ", ",x,,y,2", "a,b", ",", "x"]
    df = lines_of(spark, *plain)
    by_pattern = F.regexp_extract_all(F.concat(F.lit(","), "line"), F.lit(FIELD), F.lit(1))
    rows = df.select(by_pattern.alias("p"), F.split("line", ",", -1).alias("s")).collect()
    for r in rows:
        assert [x.strip() for x in r.p] == [x.strip() for x in r.s]


def test_blank_lines_are_neither_records_nor_malformed(spark):
    got = decoded(spark, "", "0915,LOW,pump,idle,8", "", "", "0916,HIGH,pump,busy,9")
    assert [r[-1] for r in got] == ["blank", "ok", "blank", "blank", "ok"]


def test_bom_on_line_one_only(spark):
    mark = "﻿"
    first, second = (
        decode_lines(strip_bom(lines_of(spark, f"{mark}0915,LOW,pump,idle,8", f"{mark}0915,LOW,pump,idle,8")))
        .orderBy("line_no").collect()
    )
    assert first.timestamp == "0915"
    assert second.timestamp == f"{mark}0915"


def test_skip_keeps_the_good_lines(spark):
    df = decode_lines(lines_of(spark, "half a line", "0915,LOW,pump,idle,8", "0916,LOW,pump,idle,many"))
    assert [r.timestamp for r in apply_policy(df).collect()] == ["0915"]
    assert df.filter("status not in ('ok', 'blank')").count() == 2


def test_fail_fast_names_the_first_bad_line(spark):
    good = ["0915,LOW,pump,idle,8"] * 11
    df = decode_lines(lines_of(spark, *good, "0915,LOW,pump", *good, "x"))
    with pytest.raises(MalformedLineError, match="line 12: expected 5 columns but found 3"):
        apply_policy(df, "fail_fast")
    clean = decode_lines(lines_of(spark, *good, ""))
    assert fail_fast(clean).count() == 11
    with pytest.raises(ValueError):
        apply_policy(clean, "ignore")


def test_message_has_no_control_characters(spark):
    df = decode_lines(lines_of(spark, "0915,LOW,pump,idle,none\n\rforged entry"))
    with pytest.raises(MalformedLineError) as e:
        fail_fast(df)
    assert "none  forged entry" in str(e.value)
    assert not set("\r\n") & set(str(e.value))


def test_ten_megabyte_fields(spark, tmp_path):
    size = 10 * 1024 * 1024
    units = ["a", 'x""', "  ", "b,", '",,"']
    fields = ["<" + unit * (size // len(unit)) + ">" for unit in units[:4]]
    lines = [f'0915,LOW,pump,"{field}",8' for field in fields]
    lines += [f'0915,"LO,W",pump,"{field}",8' for field in fields]
    lines += [f'0915,LOW,pump,{"a " * (size // 2)},8', "x," * (size // 2), 'a,"' + units[4] * (size // 4)]
    (tmp_path / "in").write_text("\n".join(lines))
    rows = decode_lines(with_line_numbers(read_lines(spark, str(tmp_path / "in")))).orderBy("line_no")
    got = rows.select("status", "message").collect()
    assert [r.status for r in got[:9]] == ["ok"] * 9
    assert [r.status for r in got[9:]] == ["column_count", "bad_quoting"]
    for r, want in zip(got, fields + fields + ["a " * (size // 2 - 1) + "a"]):
        assert r.message == want.replace('""', '"')


def test_decoding_happens_once_under_filters(spark):
    df = decode_lines(lines_of(spark, "a,b,c,d,1")).filter("status = 'ok' and level = 'b' and value > 0")
    df = df.select("message", "value")
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_extract_all") == 1
