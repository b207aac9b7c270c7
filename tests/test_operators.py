import math

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import Row, functions as F

from tallyline.functions import double_text, escape_field, guard_formula, quote_field, render_line
from tallyline.operators import aggregates as A
from tallyline.operators import predicates as P
from tallyline.operators import transforms as T
from tallyline.operators.compare import difference, fingerprint, same_rows
from tallyline.operators.decode import decode_lines
from tallyline.operators.policy import records
from tallyline.operators.preview import every_nth, infer_types

SCHEMA = "timestamp string, level string, source string, message string, value double"


def log(spark, *rows):
    full = [("ts", *r) if len(r) == 4 else r for r in rows]
    return spark.createDataFrame(full, SCHEMA)


def values(spark, *vs):
    return log(spark, *[("INFO", "s", "m", float(v)) for v in vs])


@pytest.fixture(scope="module")
def sample(spark):
    return log(
        spark,
        ("ERROR", "a", "one", 1.0), ("WARN", "b", "two", 2.0), ("error", "a", "three", 3.0),
        ("INFO", "c", "four", -4.0), ("INFO", "b", "five", math.inf),
    ).cache()


def messages(df):
    return sorted(r.message for r in df.collect())


@pytest.mark.parametrize("predicate, want", [
    (lambda: P.level_in("ERROR"), ["one"]),
    (lambda: P.level_in("ERROR", "WARN"), ["one", "two"]),
    (lambda: P.level_in(), ["five", "four", "one", "three", "two"]),
    (lambda: P.source_in("a"), ["one", "three"]),
    (lambda: P.source_in(), ["five", "four", "one", "three", "two"]),
    (lambda: P.value_between(1, 3), ["one", "three", "two"]),
    (lambda: P.value_between(-math.inf, 2), ["four", "one", "two"]),
    (lambda: P.value_between(low=3), ["five", "three"]),
    (lambda: P.value_between(high=1), ["four", "one"]),
    (lambda: P.value_between(), ["five", "four", "one", "three", "two"]),
    (lambda: P.all_of(P.source_in("a"), P.value_between(low=2)), ["three"]),
    (lambda: P.any_of(P.source_in("c"), P.level_in("WARN")), ["four", "two"]),
    (lambda: P.accept_all(), ["five", "four", "one", "three", "two"]),
    (lambda: P.matching(lambda b: b["message"].str.startswith("t")), ["three", "two"]),
    (lambda: P.build_predicate(), ["five", "four", "one", "three", "two"]),
    (lambda: P.build_predicate(level="", source="  "), ["five", "four", "one", "three", "two"]),
    (lambda: P.build_predicate(level=",,"), ["five", "four", "one", "three", "two"]),
    (lambda: P.build_predicate(level="ERROR, WARN"), ["one"]),
    (lambda: P.build_predicate(level="ERROR,ERROR,"), ["one"]),
    (lambda: P.build_predicate(level="INFO", source="b,c", max_value=0), ["four"]),
])
def test_filters(sample, predicate, want):
    assert messages(sample.filter(predicate())) == want


def test_bad_ranges_are_refused():
    for low, high in ((2, 1), (math.nan, 1), (0, math.nan)):
        with pytest.raises(ValueError):
            P.value_between(low, high)


def test_accept_all_leaves_no_filter(sample):
    plan = sample.filter(P.build_predicate())._jdf.queryExecution().optimizedPlan().toString()
    assert "Filter" not in plan


def test_transforms(spark, sample):
    assert [r.value for r in T.scale_value(2)(values(spark, 1, 2.5)).collect()] == [2.0, 5.0]
    assert {r.level for r in T.upper_level()(sample).collect()} == {"ERROR", "WARN", "INFO"}
    assert T.identity()(sample) is sample
    reverse = T.in_pandas(lambda b: b.assign(message=b["message"].str[::-1]))
    assert messages(T.chain(reverse, reverse)(sample)) == messages(sample)
    for factor in (math.nan, math.inf, -math.inf):
        with pytest.raises(ValueError):
            T.scale_value(factor)


def test_filter_sees_values_before_the_transform(spark):
    df = log(spark, ("low", "tank", "a", 6.0), ("LOW", "tank", "b", 6.0), ("low", "tank", "c", 41.0))
    out = T.filter_then_transform(
        df, P.level_in("low") & P.value_between(high=10), T.chain(T.scale_value(3), T.upper_level())
    )
    assert [tuple(r)[1:] for r in out.collect()] == [("LOW", "tank", "a", 18.0)]


def test_nan_from_a_transform_stops_the_job(spark):
    out = T.filter_then_transform(values(spark, math.inf), F.lit(True), T.scale_value(0))
    with pytest.raises(PySparkException, match="made a value NaN"):
        A.fold(out).collect()
    with pytest.raises(PySparkException, match="made a value NaN"):
        out.filter("level = 'INFO'").select(render_line()).collect()


def test_fold(spark):
    assert A.fold(values(spark, 7.5, -2, 0.5, 8)).first() == Row(count=4, sum=14.0, min=-2.0, max=8.0, avg=3.5)
    empty = A.fold(values(spark, 1).filter("false")).first()
    assert tuple(empty)[:4] == (0, 0.0, math.inf, -math.inf)
    assert math.isnan(empty.avg)
    exact = A.fold(values(spark, *[0.1] * 10), exact_scale=2).first()
    assert exact.sum == 1.0
    for huge in (math.inf, 1e200):
        assert A.fold(values(spark, 0.1, huge), exact_scale=2).first().sum == huge
    tiny = A.fold(values(spark, 4e-5, 4e-5, 4e-5), exact_scale=4).first()
    assert tiny.sum == pytest.approx(1.2e-4) and tiny.min == 4e-5


PARTIAL = "count long, sum double, min double, max double"


def test_merge(spark):
    a, b = (4, 6.5, -3.0, 7.25), (1, 3.5, 3.5, 3.5)
    want = Row(count=5, sum=10.0, min=-3.0, max=7.25, avg=2.0)
    assert A.merge_partials(spark.createDataFrame([a, b], PARTIAL)).first() == want
    assert A.merge_partials(spark.createDataFrame([b, a], PARTIAL)).first() == want
    none = A.merge_partials(spark.createDataFrame([], PARTIAL)).first()
    assert tuple(none)[:4] == (0, 0.0, math.inf, -math.inf)


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_count_overflow_is_seen(spark, ansi):
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        rows = [(2**63 - 1, 0.0, 0.0, 0.0), (1, 0.0, 0.0, 0.0)]
        with pytest.raises(PySparkException, match="overflow"):
            A.merge_partials(spark.createDataFrame(rows, PARTIAL)).collect()
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)


def test_aggregate_invariants(spark):
    A.check_aggregate(A.EMPTY)
    with pytest.raises(A.AggregateError):
        A.check_aggregate({**A.EMPTY, "count": 2, "sum": math.nan})
    both = values(spark, math.inf, -math.inf).withColumn("chunk_id", F.lit(1))
    parts = spark.createDataFrame([(1, math.inf, 0.0, 1.0), (1, -math.inf, 0.0, 1.0)], PARTIAL)
    for aggregate in (A.fold(both), A.fold(both, exact_scale=2), A.fold_by_chunk(both), A.merge_partials(parts)):
        with pytest.raises(PySparkException, match="came out as NaN"):
            aggregate.select("count").collect()
    with pytest.raises(A.AggregateError):
        A.check_aggregate({**A.EMPTY, "count": -1})


def test_partials_merge_to_the_fold(spark):
    df = spark.range(1000).select(
        F.col("id").alias("line_no"), (F.col("id") * 0.25).alias("value"),
        (F.col("id") % 7).alias("chunk_id"),
    )
    assert A.merge_partials(A.fold_by_chunk(df)).first() == A.fold(df).first()


ESCAPES = {
    "": "", "plain": "plain", "one, two": '"one, two"', 'the "x" of it': '"the ""x"" of it"',
    "=SUM(A1)": "'=SUM(A1)", "@home": "'@home", "+1": "'+1", "-1": "'-1", "\tx": "'\tx",
    "\rx": "'\rx", "=a,b": '"\'=a,b"', '-"q"': '"\'-""q"""', "a=b": "a=b", " =a": " =a",
}


def test_escape(spark):
    df = spark.createDataFrame([(k, v) for k, v in ESCAPES.items()], "k string, v string")
    for r in df.select("k", "v", escape_field(F.col("k")).alias("got"),
                       quote_field(guard_formula(F.col("k"))).alias("steps")).collect():
        assert r.got == r.v == r.steps


def test_render(spark):
    df = log(spark, ("0900", "LOW", "pump", "stop, then go", 3.25), ("0901", "LOW", "=A1+B2", "@noon", -8.0))
    assert [r[0] for r in df.select(render_line()).collect()] == [
        '0900,LOW,pump,"stop, then go",3.25', "0901,LOW,'=A1+B2,'@noon,-8.0",
    ]


def test_double_text(spark):
    wants = {1.0: "1.0", 1e7: "1.0E7", 1e-4: "1.0E-4", -0.0: "-0.0", math.inf: "Infinity"}
    got = values(spark, *wants).select(double_text(F.col("value"))).collect()
    assert [r[0] for r in got] == list(wants.values())


def test_decode_undoes_render(spark):
    texts = ["", "a,b", '"', '""', 'x"y', ',"', "a b", "'q'", '","', "ß, é"]
    df = log(spark, *[(t, u, v, "m", 1.5) for t in texts for u in texts for v in texts])
    lines = df.select("*", render_line().alias("line"))
    back = records(decode_lines(lines.select("line"))).select(*SCHEMA.replace(" string", "").replace(" double", "").split(", "))
    assert same_rows(df, back)


def test_difference(spark):
    a = spark.createDataFrame([(1, "x"), (1, "x"), (2, "y")], "n long, t string")
    b = spark.createDataFrame([(1, "x"), (2, "y"), (3, "z")], "n long, t string")
    assert {tuple(r) for r in difference(a, b).collect()} == {(1, "x", 1), (3, "z", -1)}
    assert same_rows(a, a.repartition(3)) and not same_rows(a, b)
    assert fingerprint(a).first() == fingerprint(a.repartition(3)).first() != fingerprint(b).first()


def numbered(spark, *lines):
    return spark.createDataFrame(list(enumerate(lines, start=1)), "line_no long, line string")


def test_every_nth(spark):
    df = numbered(spark, *"abcdefg")
    assert [r.line for r in every_nth(df, 3).orderBy("line_no").collect()] == ["a", "d", "g"]
    with pytest.raises(ValueError):
        every_nth(df, 0)


def test_infer_types(spark):
    df = numbered(
        spark, "2024-01-01T00:00:00Z,1,1.5,x,42", "2024-01-02,2,2e3,7,43", "bad line", "2024,3,NaN,y,z",
    )
    assert tuple(infer_types(df, 3).first()) == ("timestamp", "bigint", "double", "string", "bigint")
    assert tuple(infer_types(df).first()) == ("string", "bigint", "double", "string", "string")
    wide = numbered(spark, "a,9223372036854775807,9223372036854775808,-9223372036854775808,1")
    assert tuple(infer_types(wide).first()) == ("string", "bigint", "double", "bigint", "bigint")
