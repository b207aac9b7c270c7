import gzip
import json
import random
from pathlib import Path

import pytest
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import functions as F

from tallyline import schema as S
from tallyline.__main__ import main
from tallyline.operators import batches as B
from tallyline.operators.compare import same_rows
from tallyline.operators.decode import decode_lines
from tallyline.operators.policy import MalformedLineError, records
from tallyline.operators.predicates import any_of, level_in, matching, value_between
from tallyline.operators.transforms import in_pandas, scale_value
from tallyline.plans.run import RunOptions, run_pipeline
from tallyline.plans.summary import ReconciliationError, read_history, run_totals, summarise, unreconciled
from tallyline.sinks.lines import write_lines
from tallyline.sources.lines import PART_ORDER, count_lines, read_lines, read_ordered, with_line_numbers
from tallyline.sources.tables import as_records, read_jsonl, read_parquet
from tallyline.streaming.ingest import ingest, ingest_lines, read_ingested


@pytest.fixture
def small_splits(spark):
    keys = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = {k: spark.conf.get(k) for k in keys}
    for k in keys:
        spark.conf.set(k, "3000")
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def put(path, *lines, end="\n"):
    path.write_bytes("".join(line + end for line in lines).encode())
    return str(path)


def text_of(folder):
    parts = sorted(Path(folder).rglob("part-*"), key=lambda p: (str(p.parent), p.name))
    return [
        line
        for p in parts
        for line in (gzip.open(p, "rt") if p.suffix == ".gz" else p.open()).read().splitlines()
    ]


GRADES = ("low", "mid", "high")


def readings(n, seed=1):
    """Readings of some pumps, a grade each by how full the tank is."""
    rnd = random.Random(seed)
    out = []
    for i in range(n):
        full = round(rnd.gauss(50, 30), 3)
        out.append(f"day {i // 96} quarter {i % 96},{GRADES[i % 3]},pump {rnd.randrange(4)},reading {i},{full}")
    return out


# --- scan ------------------------------------------------------------------------------


def test_every_line_once_over_many_splits(spark, tmp_path, small_splits):
    lines = [f"line {i} " + "x" * (i % 50) for i in range(1000)]
    df = read_lines(spark, put(tmp_path / "a.txt", *lines))
    assert df.rdd.getNumPartitions() > 7
    got = with_line_numbers(df).orderBy("line_no").collect()
    assert [r.line for r in got] == lines
    assert [r.line_no for r in got] == list(range(1, 1001))
    assert [r.line for r in B.in_input_order(df).collect()] == lines


@pytest.mark.parametrize("limit", [1 << 28, 0])
def test_numbers_per_file_and_across_files(spark, tmp_path, small_splits, limit):
    files = {f"f{i}": [f"{i}:{j}" for j in range(n)] for i, n in enumerate((900, 0, 1, 2500, 30))}
    for name, lines in files.items():
        put(tmp_path / name, *lines)
    df = read_lines(spark, str(tmp_path))
    numbered = with_line_numbers(df, broadcast_bytes=limit)
    plan = numbered._jdf.queryExecution().optimizedPlan().toString()
    assert ("broadcast" in plan) == (limit > 0)
    for r in numbered.collect():
        assert files[r.file_path.rsplit("/", 1)[1]][r.line_no - 1] == r.line
    across = with_line_numbers(df, across=("file_path", "block_start"), broadcast_bytes=limit)
    want = [line for name in sorted(files) for line in files[name]]
    assert [r.line for r in across.orderBy("line_no").collect()] == want


def test_changed_splits_are_noticed(spark, tmp_path, small_splits):
    path = put(tmp_path / "a", *[f"line {i}" for i in range(2000)])
    numbered = with_line_numbers(read_lines(spark, path))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "5000")
    spark.conf.set("spark.sql.files.openCostInBytes", "5000")
    with pytest.raises(PySparkException, match="splits changed"):
        numbered.agg(F.max("line_no")).collect()


@pytest.mark.parametrize("raw, want", [
    (b"a\r\nb\r\n", ["a", "b"]),
    (b"a\nb\nc", ["a", "b", "c"]),
    (b"a\rb\n\nc\n", ["a", "b", "", "c"]),
    (b"", []),
    (b"\xef\xbb\xbfa\n\xef\xbb\xbfb\n", ["a", "﻿b"]),
    (b"a\xffb\n\xe2\x82\n", ["a�b", "�"]),
])
def test_line_ends_marks_and_bytes(spark, tmp_path, raw, want):
    (tmp_path / "a").write_bytes(raw)
    df = read_lines(spark, str(tmp_path / "a"))
    got = with_line_numbers(df).orderBy("line_no").collect()
    assert [r.line for r in got] == want
    assert count_lines(df).first()[0] == len(want)


def test_missing_input_fails_before_the_output_is_touched(spark, tmp_path):
    kept = put(tmp_path / "out", "old")
    with pytest.raises(AnalysisException, match="PATH_NOT_FOUND"):
        run_pipeline(spark, RunOptions(input=str(tmp_path / "none"), output=kept))
    assert Path(kept).read_text() == "old\n"


def test_jsonl_and_parquet(spark, tmp_path):
    good = {"timestamp": "t", "level": "INFO", "source": "s", "message": "a,b", "value": 1.5}
    rows = [good, {**good, "value": "2e3", "more": 1}, {**good, "value": None},
            {k: v for k, v in good.items() if k != "level"}, {**good, "value": "NaN"}]
    path = put(tmp_path / "a", *map(json.dumps, rows), "", "{broken", "7")
    df = read_jsonl(spark, path)
    assert sorted(r.status for r in df.collect()) == sorted([
        "ok", "ok", "non_numeric", "column_count", "nan_value", "blank", "bad_json", "bad_json",
    ])
    kept = records(df).select(*S.RECORD_COLUMNS)
    kept.write.parquet(str(tmp_path / "p"))
    assert same_rows(records(read_parquet(spark, str(tmp_path / "p"))).select(*S.RECORD_COLUMNS), kept)


def test_filters_reach_the_parquet_scan(spark, tmp_path):
    path = str(tmp_path / "p")
    decode_lines(spark.createDataFrame([("a,b,c,d,1",)], "line string")).write.parquet(path)
    df = records(as_records(spark.read.parquet(path))).filter(level_in("x") & value_between(1, 2))
    plan = df.select("message")._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(value,1.0)" in plan and "level" in plan.split("PushedFilters")[1]


# --- batches ---------------------------------------------------------------------------


def numbered(spark, *lines):
    df = spark.createDataFrame(list(enumerate(lines, start=1)), "line_no long, line string")
    return df.repartition(3)


def test_batches(spark):
    df = numbered(spark, *"abcde")
    rows = B.gather_chunks(df, 2).orderBy("chunk_id").collect()
    assert [(r.chunk_id, r.start_line, r["size"], r.lines) for r in rows] == [
        (0, 1, 2, ["a", "b"]), (1, 3, 2, ["c", "d"]), (2, 5, 1, ["e"]),
    ]
    assert [r["size"] for r in B.chunk_sizes(df, 3).orderBy("chunk_id").collect()] == [3, 2]
    assert B.chunk_sizes(df.filter("false"), 3).count() == 0
    for size in (0, -1):
        with pytest.raises(ValueError):
            B.with_chunks(df, size)
    (whole,) = B.gather_chunks(df, 10**9).collect()
    assert whole.size == df.count() == len(whole.lines)


def test_process_batches_keeps_empty_ones(spark):
    df = numbered(
        spark, "6:00,high,p,one,2.0", "6:15,low,p,two,99.0", "", "bad", "7:00,high,p,five,-1", "7:15,high,p,six,0.5",
    )
    rows = B.process_chunks(df, 2, level_in("high"), scale_value(2)).orderBy("sequence").collect()
    assert [r.sequence for r in rows] == [0, 1, 2]
    assert [tuple(r.partial) for r in rows] == [
        (1, 4.0, 4.0, 4.0), (0, 0.0, float("inf"), float("-inf")), (2, -1.0, -2.0, 1.0),
    ]
    assert [r.output_lines for r in rows] == [
        ["6:00,high,p,one,4.0"], [], ["7:00,high,p,five,-2.0", "7:15,high,p,six,1.0"],
    ]


def test_resequence(spark):
    def run(*batches):
        df = spark.createDataFrame(list(batches), "sequence long, output_lines array<string>")
        return [r.line for r in B.resequence(df).collect()]

    assert run((1, ["c"]), (0, ["a", "b"])) == ["a", "b", "c"]
    assert run((3, ["d"]), (1, ["b"]), (0, ["a"])) == ["a", "b"]
    assert run((0, ["a"]), (1, []), (2, ["c"])) == ["a", "c"]
    assert run((1, ["b"]), (2, ["c"])) == []


# --- sinks and runs --------------------------------------------------------------------


def test_output_equals_input(spark, tmp_path, small_splits):
    lines = readings(1000)
    path = put(tmp_path / "in.csv", *lines)
    result = run_pipeline(spark, RunOptions(input=path, output=str(tmp_path / "out")))
    assert text_of(tmp_path / "out") == lines
    assert (result.lines_read, result.records, result.malformed, result.count) == (1000, 1000, 0, 1000)
    assert len(list((tmp_path / "out").glob("part-*"))) > 7


def test_one_level_of_five(spark, tmp_path, small_splits):
    lines = readings(1000)
    path = put(tmp_path / "in.csv", *lines)
    options = RunOptions(input=path, output=str(tmp_path / "out"), level="high", gzip=True)
    result = run_pipeline(spark, options)
    assert (result.records, result.filtered_out) == (333, 667)
    assert text_of(tmp_path / "out") == [line for line in lines if ",high," in line]
    assert all(p.name.endswith(".gz") for p in (tmp_path / "out").glob("part-*"))
    again = run_pipeline(spark, options)
    assert text_of(tmp_path / "out") == [line for line in lines if ",high," in line]
    assert again.count == 333


def test_golden_file(spark, tmp_path):
    lines = ['6:00,low,pump 1,"fine, so far",12', "6:15,high,pump 2,-rising,97.5", "6:30,high,pump 1,=spill,1e3"]
    run_pipeline(spark, RunOptions(input=put(tmp_path / "in", *lines), output=str(tmp_path / "out"), level="high"))
    assert text_of(tmp_path / "out") == ["6:15,high,pump 2,'-rising,97.5", "6:30,high,pump 1,'=spill,1000.0"]


def test_skip_counts_and_reports(spark, tmp_path):
    path = put(tmp_path / "in", "6:00,low,pump 1,fine,12", "half,a line", "", "6:15,high,pump 2,rising,97.5", "a,b,c,d,x")
    out = {k: str(tmp_path / k) for k in ("output", "dead_letters", "summary", "history", "partials")}
    options = RunOptions(input=path, max_value=50, chunk_size=2, **out)
    result = run_pipeline(spark, options)
    assert (result.lines_read, result.blank, result.malformed, result.filtered_out, result.records) == (5, 1, 2, 1, 1)
    dead = spark.read.json(out["dead_letters"]).orderBy("line_no").collect()
    assert [(r.line_no, r.line, r.status) for r in dead] == [
        (2, "half,a line", "column_count"), (5, "a,b,c,d,x", "non_numeric"),
    ]
    summary = spark.read.json(out["summary"]).first()
    assert (summary.lines_read, summary.sum, summary.avg) == (5, 12.0, 12.0)
    assert unreconciled(result.to_frame(spark)).isEmpty()
    partials = spark.read.parquet(out["partials"]).orderBy("chunk_id").collect()
    assert [(r.chunk_id, r["count"], r.sum, r.min) for r in partials] == [
        (0, 1, 12.0, 12.0), (1, 0, 0.0, float("inf")), (2, 0, 0.0, float("inf")),
    ]
    run_pipeline(spark, options)
    totals = run_totals(read_history(spark, out["history"])).first()
    assert (totals.runs, totals.lines_read, totals.records, totals.malformed) == (2, 10, 2, 4)
    assert totals.lines_per_s == pytest.approx(10 / totals.duration_s)


def test_fail_fast_writes_nothing(spark, tmp_path, small_splits):
    lines = readings(500) + ["half,a line"] + readings(10) + ["nothing"]
    path = put(tmp_path / "in", *lines)
    options = RunOptions(input=path, output=str(tmp_path / "out"), policy="fail_fast")
    with pytest.raises(MalformedLineError, match="line 501: expected 5 columns but found 2"):
        run_pipeline(spark, options)
    assert not (tmp_path / "out").exists()
    put(tmp_path / "in", *lines[:500])
    assert run_pipeline(spark, options).records == 500


def test_custom_filter_and_transform(spark, tmp_path):
    path = put(tmp_path / "in", *readings(100))
    seen_only_kept = in_pandas(lambda b: b.assign(message=b["message"] + "!", value=b["value"].clip(20)))
    options = RunOptions(
        input=path, output=str(tmp_path / "out"), value_scale=0.5,
        predicate=F.col("message").endswith("7"), transform=seen_only_kept,
    )
    result = run_pipeline(spark, options)
    got = text_of(tmp_path / "out")
    assert [g.split(",")[3] for g in got] == [f"reading {i}!" for i in range(7, 100, 10)]
    assert (result.records, result.min) == (10, 20.0)


def test_pandas_filter_sees_good_records_only(spark, tmp_path):
    path = put(tmp_path / "in", *readings(20), "bad", "")

    def even(batch):
        assert batch["message"].notna().all()
        return batch["message"].str.split().str[-1].astype(int) % 2 == 0

    options = RunOptions(input=path, output=str(tmp_path / "out"), predicate=matching(even))
    result = run_pipeline(spark, options)
    assert (result.records, result.filtered_out, result.malformed, result.blank) == (10, 10, 1, 1)
    assert len(text_of(tmp_path / "out")) == 10


def test_directory_in_order_and_per_file(spark, tmp_path, small_splits):
    parts = {f"{name}.csv": readings(n, seed=n) for name, n in (("b", 300), ("a", 120), ("c", 1))}
    (tmp_path / "in").mkdir()
    for name, lines in parts.items():
        put(tmp_path / "in" / name, *lines)
    flat = RunOptions(input=str(tmp_path / "in"), output=str(tmp_path / "flat"))
    result = run_pipeline(spark, flat)
    assert (result.lines_read, result.records) == (421, 421)
    assert text_of(tmp_path / "flat") == [x for name in sorted(parts) for x in parts[name]]
    split = RunOptions(input=str(tmp_path / "in"), output=str(tmp_path / "split"), per_file=True)
    assert run_pipeline(spark, split).records == 421
    for name, lines in parts.items():
        (folder,) = (tmp_path / "split").glob(f"file={name}*")
        assert text_of(folder) == lines
    by_file = summarise(decode_lines(read_lines(spark, str(tmp_path / "in"))), by=("file_path",))
    got = {r.file_path.rsplit("/", 1)[1]: r.lines_read for r in by_file.collect()}
    assert got == {name: len(lines) for name, lines in parts.items()}


def old_output(folder):
    folder.mkdir()
    put(folder / "part-00000", "what an earlier run left")
    return text_of(folder)


def leftovers(folder):
    return [p for p in folder.iterdir() if p.name.startswith(".")]


def test_output_over_input_is_refused(spark, tmp_path):
    (tmp_path / "in").mkdir()
    for name in ("a", "b"):
        put(tmp_path / "in" / name, *readings(5))
    source, lines = str(tmp_path / "in"), text_files(tmp_path / "in")
    for wrong in (
        {"output": source}, {"output": source + "/out"}, {"output": str(tmp_path)}, {"output": f"file://{source}/"},
        {"input": source + "/*", "output": source + "/c"}, {"summary": str(tmp_path / "out")},
        {"dead_letters": source + "/dead"}, {"partials": str(tmp_path / "out" / "p")},
    ):
        with pytest.raises(ValueError, match="overlap"):
            run_pipeline(spark, RunOptions(**{"input": source, "output": str(tmp_path / "out"), **wrong}))
    assert text_files(tmp_path / "in") == lines and not (tmp_path / "out").exists()


def text_files(folder):
    return {p.name: p.read_text() for p in folder.iterdir()}


def test_counts_under_a_sorting_transform(spark, tmp_path):
    path = put(tmp_path / "in", *readings(1000), "bad", "")
    options = RunOptions(
        input=path, output=str(tmp_path / "out"), level="high",
        transform=lambda df: df.repartition(5).orderBy(F.col("value").desc()),
    )
    result = run_pipeline(spark, options)
    assert (result.lines_read, result.filtered_out, result.records) == (1002, 667, 333)
    assert text_of(tmp_path / "out") == [line for line in readings(1000) if ",high," in line]


def test_a_predicate_that_is_never_true(spark, tmp_path):
    path = put(tmp_path / "in", *readings(10))
    for never in (any_of(), F.lit(False), F.lit(None).cast("boolean")):
        result = run_pipeline(spark, RunOptions(input=path, output=str(tmp_path / "out"), predicate=never))
        assert (result.lines_read, result.filtered_out, result.records) == (10, 10, 0)
        assert text_of(tmp_path / "out") == []


def test_a_transform_that_drops_rows_does_not_add_up(spark, tmp_path):
    path = put(tmp_path / "in", *readings(10))
    before = old_output(tmp_path / "out")
    with pytest.raises(ReconciliationError):
        run_pipeline(spark, RunOptions(input=path, output=str(tmp_path / "out"), transform=lambda df: df.limit(3)))
    assert text_of(tmp_path / "out") == before


def test_partials_and_dead_letters_of_two_files(spark, tmp_path):
    (tmp_path / "in").mkdir()
    put(tmp_path / "in" / "a", *readings(3))
    put(tmp_path / "in" / "b", *readings(2), "bad")
    out = {k: str(tmp_path / k) for k in ("output", "dead_letters", "partials")}
    run_pipeline(spark, RunOptions(input=str(tmp_path / "in"), chunk_size=2, **out))
    rows = spark.read.parquet(out["partials"]).collect()
    got = sorted((r.file_path.rsplit("/", 1)[1], r.chunk_id, r["count"]) for r in rows)
    assert got == [("a", 0, 2), ("a", 1, 1), ("b", 0, 2), ("b", 1, 0)]
    (dead,) = spark.read.json(out["dead_letters"]).collect()
    assert dead.file_path.endswith("/b") and dead.line_no == 3


def test_folders_per_file_do_not_depend_on_other_files(spark, tmp_path):
    names = []
    for folder in ("in/x", "in/y"):
        (tmp_path / folder).mkdir(parents=True)
        put(tmp_path / folder / "a", *readings(4))
        inputs = str(tmp_path / "in" / "*")
        run_pipeline(spark, RunOptions(input=inputs, output=str(tmp_path / "out"), per_file=True))
        names.append({p.name for p in (tmp_path / "out").glob("file=*")})
    assert len(names[0]) == 1 and names[0] < names[1] and len(names[1]) == 2


def test_both_infinities_stop_the_run(spark, tmp_path):
    path = put(tmp_path / "in", "t,l,s,m,Infinity", "t,l,s,m,-Infinity")
    before = old_output(tmp_path / "out")
    with pytest.raises(ArithmeticError, match="NaN"):
        run_pipeline(spark, RunOptions(input=path, output=str(tmp_path / "out")))
    assert text_of(tmp_path / "out") == before and not leftovers(tmp_path)


def test_failed_write_fails_the_run(spark, tmp_path):
    path = put(tmp_path / "in", *readings(10))
    put(tmp_path / "file", "in the way")
    with pytest.raises(Exception):
        run_pipeline(spark, RunOptions(input=path, output=str(tmp_path / "file" / "below")))


def test_failed_job_publishes_nothing(spark, tmp_path):
    path = put(tmp_path / "in", "t,l,s,m,Infinity")
    before = old_output(tmp_path / "out")
    with pytest.raises(PySparkException, match="made a value NaN"):
        run_pipeline(spark, RunOptions(input=path, output=str(tmp_path / "out"), value_scale=0.0))
    put(tmp_path / "in", "t,l,s,m,1", "no line")
    with pytest.raises(MalformedLineError):
        run_pipeline(spark, RunOptions(input=path, output=str(tmp_path / "out"), policy="fail_fast"))
    assert text_of(tmp_path / "out") == before and not leftovers(tmp_path)


def test_empty_input(spark, tmp_path):
    path = put(tmp_path / "in")
    result = run_pipeline(spark, RunOptions(input=path, output=str(tmp_path / "out")))
    assert (result.lines_read, result.count, result.sum, result.min) == (0, 0, 0.0, float("inf"))
    assert text_of(tmp_path / "out") == []


@pytest.mark.parametrize("wrong", [
    {"input": ""}, {"output": ""}, {"policy": "x"}, {"chunk_size": 0}, {"min_value": 2, "max_value": 1},
    {"value_scale": float("inf")}, {"value_scale": float("nan")}, {"min_value": float("nan")},
])
def test_options_are_checked(wrong):
    with pytest.raises(ValueError):
        RunOptions(**{"input": "a", "output": "b", **wrong})


def test_results_do_not_depend_on_splits(spark, tmp_path, small_splits):
    path = put(tmp_path / "in", *readings(3000), "x")
    results = []
    for size in ("3000", "100000000"):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        spark.conf.set("spark.sql.files.openCostInBytes", size)
        df = with_line_numbers(read_lines(spark, path))
        results.append((
            df.rdd.getNumPartitions(),
            summarise(decode_lines(df), level_in("mid"), exact_scale=12).first(),
            [tuple(r) for r in B.process_chunks(df, 100, level_in("mid")).orderBy("sequence").collect()],
        ))
    assert results[0][0] > 1 == results[1][0]
    assert results[0][1:] == results[1][1:]


def test_ordered_read_sorts_parts_by_number(spark, tmp_path):
    for n, line in ((99999, "a"), (100000, "b"), (7, "z")):
        put(tmp_path / f"part-{n:05}-x.txt", line)
    df = with_line_numbers(read_ordered(spark, str(tmp_path)), across=PART_ORDER)
    assert [r.line for r in df.orderBy("line_no").collect()] == ["z", "a", "b"]


def test_write_replaces(spark, tmp_path):
    out = str(tmp_path / "out")
    for text in ("old", "new"):
        write_lines(spark.createDataFrame([(text,)], "line string"), out)
    assert text_of(out) == ["new"]


# --- streams ---------------------------------------------------------------------------


def test_resumed_ingestion_stores_each_line_once(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    args = [spark, str(folder), str(tmp_path / "table"), str(tmp_path / "cp")]
    put(folder / "a", *readings(50), "bad", "")
    put(folder / "b", *readings(20))
    ingest(*args, files_per_batch=1)
    ingest(*args)
    put(folder / "c", *readings(7))
    ingest(*args)
    ingest(*args)
    df = read_ingested(spark, args[2])
    assert {r[0]: r[1] for r in df.groupBy("status").count().collect()} == {
        "ok": 77, "column_count": 1, "blank": 1,
    }
    out = [spark, str(folder), str(tmp_path / "out"), str(tmp_path / "cp2")]
    ingest_lines(*out, predicate=level_in("high"), transform=scale_value(2))
    ingest_lines(*out, predicate=level_in("high"), transform=scale_value(2))
    assert len(text_of(tmp_path / "out")) == 16 + 6 + 2


# --- command line ----------------------------------------------------------------------


def test_command_line(spark, tmp_path, capsys):
    path = put(tmp_path / "in", *readings(100), "bad")
    main(["-i", path, "-o", str(tmp_path / "out"), "--level", "high,mid", "--value-scale", "2"])
    assert "records: 66" in capsys.readouterr().out
    assert len(text_of(tmp_path / "out")) == 66
    with pytest.raises(MalformedLineError, match="line 101"):
        main(["-i", path, "-o", str(tmp_path / "out"), "--fail-fast"])
    with pytest.raises(SystemExit):
        main(["-i", path])
