"""Runs: one pass for everything, order without a sort, early stops, publishing, formats, sums and deliveries."""

import gzip
import json
import math
import os
import random
from fractions import Fraction
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tallyline import schema as S
from tallyline.operators import batches as B
from tallyline.operators.exact import exact_fold, exact_partials, finish_exact, merge_exact
from tallyline.operators.policy import MalformedLineError
from tallyline.operators.preview import infer_types
from tallyline.plans import run as R
from tallyline.plans.run import RunOptions, run_pipeline
from tallyline.sinks import publish as U
from tallyline.sources.lines import PART_ORDER, files_in_order, head_lines, read_lines, read_ordered, with_line_numbers
from tallyline.streaming import ingest as I
from tests.test_files import put, readings, small_splits, text_of  # noqa: F401 - a fixture

REPORTS = ("dead_letters", "summary", "history", "partials", "file_summary")


def some_files(folder, *sizes, bad=()):
    folder.mkdir()
    for i, n in enumerate(sizes):
        lines = readings(n, seed=i)
        for at in bad:
            if at < n:
                lines[at] = "cut off"
        put(folder / f"f{i:03}", *lines)
    return str(folder)


# --- order -------------------------------------------------------------------------------


def sources_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_many_files_keep_their_order_without_an_exchange(spark, tmp_path, small_splits, monkeypatch):  # noqa: F811
    path = some_files(tmp_path / "in", 900, 0, 30, 700, 1)
    plans = []
    text = R.K.write_kinds
    monkeypatch.setattr(R.K, "write_kinds", lambda rows, *a, **b: (plans.append(sources_of(rows)), text(rows, *a, **b)))
    result = run_pipeline(spark, RunOptions(input=path, output=str(tmp_path / "out"), level="high,mid"))
    assert result.lines_read == 1631 and "Exchange" not in plans[0]
    want = [x for i, n in enumerate((900, 0, 30, 700, 1)) for x in readings(n, seed=i) if ",low," not in x]
    assert text_of(tmp_path / "out") == want
    df = with_line_numbers(read_ordered(spark, str(tmp_path / "out")), across=PART_ORDER)
    assert [r.line for r in df.orderBy("line_no").collect()] == want
    manifest = [json.loads(x) for x in (tmp_path / "out" / "_manifest").read_text().splitlines()]
    assert [(m["file_no"], m["file_path"][-4:]) for m in manifest] == [(i, f"f{i:03}") for i in range(5)]
    assert len(list((tmp_path / "out").glob("split=*"))) > 10


def test_beyond_99999_parts_one_file_has_named_splits(spark, tmp_path, small_splits, monkeypatch):  # noqa: F811
    monkeypatch.setattr(R.K, "MOST_PARTS", 3)
    path = put(tmp_path / "in", *readings(800))
    run_pipeline(spark, RunOptions(input=path, output=str(tmp_path / "out")))
    assert text_of(tmp_path / "out") == readings(800)
    names = sorted(p.name for p in (tmp_path / "out").glob("split=*"))
    assert len(names) > 7 and names[0] == "split=0000000000-0000000000000000"


def test_ordered_read_of_more_splits_than_part_numbers_hold(spark, tmp_path):
    for file, block, line in ((99_999, 5, "b"), (100_000, 0, "c"), (99_999, 10**12, "bb"), (7, 0, "a")):
        folder = tmp_path / f"split={file:010}-{block:016}"
        folder.mkdir()
        put(folder / "part-00003-x.txt", line)
    df = with_line_numbers(read_ordered(spark, str(tmp_path)), across=PART_ORDER)
    assert [r.line for r in df.orderBy("line_no").collect()] == ["a", "b", "bb", "c"]


def test_paths_with_blanks_and_percents(spark, tmp_path):
    folder = tmp_path / "a b%20c"
    some_files(folder, 20, 10, bad=(5,))
    out = {k: str(tmp_path / k) for k in ("output", "dead_letters", "file_summary")}
    result = run_pipeline(spark, RunOptions(input=str(folder), **out))
    assert (result.lines_read, result.malformed) == (30, 2)
    assert [r.line_no for r in spark.read.json(out["dead_letters"]).collect()] == [6, 6]
    with pytest.raises(MalformedLineError, match="line 6:"):
        run_pipeline(spark, RunOptions(input=str(folder), output=out["output"], policy="fail_fast"))
    put(folder / "A [1] {x}*", "first", "cut off")
    assert [r.line for r in head_lines(spark, str(folder), 3).orderBy("line_no").collect()][:2] == ["first", "cut off"]
    with pytest.raises(MalformedLineError, match="line 1:"):
        run_pipeline(spark, RunOptions(input=str(folder), output=out["output"], policy="fail_fast"))


# --- one pass ----------------------------------------------------------------------------


def bytes_read(spark):
    statistics = spark._jvm.org.apache.hadoop.fs.FileSystem.getAllStatistics()
    return sum(s.getBytesRead() for s in statistics)


def test_all_reports_come_from_one_scan(spark, tmp_path):
    path = some_files(tmp_path / "in", 3000, 2000, bad=(7, 1500))
    for file in Path(path).iterdir():  # wide lines, so that a second scan would show
        file.write_text("".join(line.replace("reading", "reading " + "x" * 2000) + "\n" for line in file.read_text().splitlines()))
    size = sum(f.stat().st_size for f in Path(path).iterdir())
    out = {k: str(tmp_path / k) for k in ("output", *REPORTS)}
    before = bytes_read(spark)
    result = run_pipeline(spark, RunOptions(input=path, chunk_size=1000, **out))
    assert size < bytes_read(spark) - before < 1.3 * size
    assert (result.lines_read, result.malformed) == (5000, 4)
    dead = spark.read.json(out["dead_letters"]).orderBy("file_path", "line_no").collect()
    assert [(r.file_path[-4:], r.line_no, r.line, r.status) for r in dead] == [
        (f, n, "cut off", "column_count") for f in ("f000", "f001") for n in (8, 1501)
    ]
    partials = spark.read.parquet(out["partials"]).orderBy("file_path", "chunk_id").collect()
    assert [r["count"] for r in partials] == [999, 999, 1000, 999, 999]
    files = spark.read.json(out["file_summary"]).orderBy("file_no").collect()
    assert [(r.lines_read, r.malformed, r.records) for r in files] == [(3000, 2, 2998), (2000, 2, 1998)]


@pytest.mark.parametrize("custom, per_file", [(False, False), (True, False), (False, True)])
def test_reports_agree_whatever_the_way(spark, tmp_path, small_splits, custom, per_file):  # noqa: F811
    path = some_files(tmp_path / "in", 500, 0, 300, bad=(3, 77))
    out = {k: str(tmp_path / k) for k in ("output", *REPORTS)}
    more = {"predicate": F.col("level") != "low"} if custom else {"level": "mid,high"}
    options = RunOptions(input=path, value_scale=2.0, chunk_size=64, per_file=per_file, gzip=True, **more, **out)
    result = run_pipeline(spark, options)
    good = {(i, n): x for i, size in enumerate((500, 0, 300)) for n, x in enumerate(readings(size, seed=i)) if n not in (3, 77)}
    kept = {at: x for at, x in good.items() if ",low," not in x}
    assert (result.records, result.filtered_out) == (len(kept), len(good) - len(kept))
    assert len(text_of(tmp_path / "out" if False else out["output"])) == len(kept)
    files = spark.read.json(out["file_summary"]).orderBy("file_no").collect()
    assert [(r.lines_read, r.malformed, r.records, r.filtered_out) for r in files] == [
        (size, 2 if size else 0, sum(at[0] == i for at in kept), sum(at[0] == i for at in good) - sum(at[0] == i for at in kept))
        for i, size in enumerate((500, 0, 300))
    ]
    rows = spark.read.parquet(out["partials"]).collect()
    got = {(int(r.file_path[-3:]), r.chunk_id): r["count"] for r in rows}
    want = {(i, c): 0 for i, size in enumerate((500, 0, 300)) for c in range(-(-size // 64))}
    for i, n in kept:
        want[i, n // 64] += 1
    assert got == want
    assert math.isclose(sum(r.sum for r in rows), result.sum)


def test_reports_of_an_empty_input(spark, tmp_path):
    out = {k: str(tmp_path / k) for k in ("output", *REPORTS)}
    result = run_pipeline(spark, RunOptions(input=put(tmp_path / "in"), **out))
    assert (result.lines_read, result.sum) == (0, 0.0) and text_of(out["output"]) == []
    assert spark.read.parquet(out["partials"]).count() == 0
    (file,) = spark.read.json(out["file_summary"]).collect()
    assert (file.lines_read, file["count"]) == (0, 0)


# --- early stop --------------------------------------------------------------------------


def test_a_bad_first_line_stops_before_the_rest_is_read(spark, tmp_path, small_splits):  # noqa: F811
    """Tasks take the larger files first; the last one cannot be read at all, and is not reached."""
    path = some_files(tmp_path / "in", *[200] * 40, bad=())
    put(Path(path) / "f000", "bad", *readings(400))
    (Path(path) / "z.gz").write_bytes(gzip.compress(b"x" * 100)[:20])
    for _ in range(2):
        with pytest.raises(MalformedLineError, match="line 1: expected 5 columns but found 1"):
            run_pipeline(spark, RunOptions(input=path, output=str(tmp_path / "out"), policy="fail_fast"))
    assert not (tmp_path / "out").exists()


@pytest.mark.parametrize("custom", [False, True])
def test_the_first_of_several_bad_lines_is_named(spark, tmp_path, small_splits, custom):  # noqa: F811
    path = some_files(tmp_path / "in", 300, 900, 2000, 500, bad=(450, 460, 1999))
    more = {"predicate": F.col("level") == "none"} if custom else {"level": "none"}
    for _ in range(2):
        with pytest.raises(MalformedLineError, match="line 451:"):
            run_pipeline(spark, RunOptions(input=path, output=str(tmp_path / "out"), policy="fail_fast", **more))


# --- publishing --------------------------------------------------------------------------


def files_below(folder):
    return sorted((str(p.relative_to(folder)), p.read_bytes()) for p in folder.rglob("*") if p.is_file() and not p.name.endswith(".crc"))


def report_run(tmp_path, path, **more):
    out = {k: str(tmp_path / "out" / k) for k in ("output", *REPORTS)}
    return RunOptions(input=path, **out, **more)


@pytest.mark.parametrize("step", [0, 1, 2, 6, 10])
def test_a_fault_at_any_move_leaves_everything_old(spark, tmp_path, monkeypatch, step):
    first = put(tmp_path / "one", *readings(30), "bad")
    run_pipeline(spark, report_run(tmp_path, first))
    before = files_below(tmp_path / "out")
    calls, move = [], U._move

    def failing(spark, source, target):
        calls.append(target)
        if len(calls) == step + 1:
            raise OSError("gone")
        move(spark, source, target)

    monkeypatch.setattr(U, "_move", failing)
    with pytest.raises(OSError, match="gone"):
        run_pipeline(spark, report_run(tmp_path, put(tmp_path / "two", *readings(90), "worse")))
    assert files_below(tmp_path / "out") == before


def test_a_driver_that_dies_is_undone_by_the_next_run(spark, tmp_path, monkeypatch):
    run_pipeline(spark, report_run(tmp_path, put(tmp_path / "one", *readings(30), "bad")))
    before = files_below(tmp_path / "out")
    calls, move = [], U._move

    class Death(BaseException):
        pass

    def dying(spark, source, target):
        calls.append(target)
        if len(calls) == 6:
            raise Death
        move(spark, source, target)

    with monkeypatch.context() as patch:
        patch.setattr(U, "_move", dying)
        patch.setattr(U, "_undo", lambda *a: (_ for _ in ()).throw(Death()))
        patch.setattr(U, "discard", lambda *a: None)
        with pytest.raises(Death):
            run_pipeline(spark, report_run(tmp_path, put(tmp_path / "two", *readings(90))))
    assert files_below(tmp_path / "out") != before
    assert U.recover(spark, str(tmp_path / "out" / "output")) == 1
    left = [x for x in files_below(tmp_path / "out") if not x[0].startswith(".")]
    assert left == before
    assert run_pipeline(spark, report_run(tmp_path, str(tmp_path / "two"))).records == 90


def test_a_history_that_cannot_be_written_keeps_the_old_output(spark, tmp_path):
    out, history = str(tmp_path / "out"), put(tmp_path / "file", "in the way")
    run_pipeline(spark, RunOptions(input=put(tmp_path / "one", *readings(5)), output=out))
    with pytest.raises(Exception):
        run_pipeline(spark, RunOptions(input=put(tmp_path / "two", *readings(9)), output=out, history=f"{history}/h"))
    assert text_of(out) == readings(5) and not [p for p in tmp_path.iterdir() if p.name.startswith(".out")]


# --- formats -----------------------------------------------------------------------------


@pytest.mark.parametrize("kind", ["jsonl", "parquet"])
def test_typed_input(spark, tmp_path, kind):
    rows = [(f"t{i}", "high" if i % 3 else "low", "p" if i % 10 else None, f"m,{i}", float(i) if i % 7 else None) for i in range(500)]
    df = spark.createDataFrame(rows, "timestamp string, level string, source string, message string, value double")
    path = str(tmp_path / "in")
    writer = df.coalesce(1).write
    writer.json(path) if kind == "jsonl" else writer.option("parquet.block.size", 4096).parquet(path)
    out = {k: str(tmp_path / k) for k in ("output", *REPORTS)}
    result = run_pipeline(spark, RunOptions(input=path, input_format=kind, level="high", chunk_size=100, **out))
    good = [i for i in range(500) if i % 10 and i % 7]
    assert (result.lines_read, result.malformed, result.records) == (500, 500 - len(good), sum(i % 3 > 0 for i in good))
    assert text_of(out["output"]) == [f't{i},high,p,"m,{i}",{float(i)}' for i in good if i % 3]
    dead = {r.line_no: r.status for r in spark.read.json(out["dead_letters"]).collect()}
    assert dead == {i + 1: "column_count" if i % 10 == 0 else "non_numeric" for i in range(500) if i not in set(good)}
    counts = [r["count"] for r in spark.read.parquet(out["partials"]).orderBy("chunk_id").collect()]
    assert counts == [sum(i % 3 > 0 and i // 100 == c for i in good) for c in range(5)]
    with pytest.raises(MalformedLineError, match="line 1: a text column is missing"):
        run_pipeline(spark, RunOptions(input=path, input_format=kind, output=out["output"], policy="fail_fast"))
    with pytest.raises(ValueError):
        RunOptions(input="a", output="b", input_format="avro")


# --- heads -------------------------------------------------------------------------------


def test_the_head_opens_no_later_file(spark, tmp_path):
    path = some_files(tmp_path / "in", 50)
    for i in range(99):
        (tmp_path / "in" / f"g{i:03}.gz").write_bytes(b"\x1f\x8b no archive")
    head = head_lines(spark, path, 20)
    assert [(r.line_no, r.line) for r in head.collect()] == list(enumerate(readings(50, seed=0)[:20], start=1))
    assert infer_types(head).first().value == "double"
    with pytest.raises(Exception):
        head_lines(spark, path, 51)
    with pytest.raises(ValueError):
        head_lines(spark, path, 0)
    assert len(files_in_order(read_lines(spark, path))) == 100


# --- exact sums --------------------------------------------------------------------------


def doubles(rng, n):
    kinds = [lambda: rng.uniform(-1, 1) * 10 ** rng.randint(-300, 300), lambda: rng.choice([1e300, -1e300, 1e-300, 5e-324, -5e-324]),
             lambda: float(rng.randint(-(2**53), 2**53)), lambda: rng.gauss(0, 1), lambda: 0.0, lambda: -0.0,
             lambda: rng.choice([1.7976931348623157e308, -1.7976931348623157e308]), lambda: 2.0 ** rng.randint(-1074, 1000)]
    return [rng.choice(kinds)() for _ in range(n)]


def test_sums_are_exact_in_any_partitioning(spark):
    rng = random.Random(3)
    values = [(k, v) for k in range(12) for v in doubles(rng, 400)]
    df = spark.createDataFrame(values, "k int, value double")

    def exact(k):
        total = sum((Fraction(v) for key, v in values if key == k), Fraction(0))
        try:
            return total.numerator / total.denominator
        except OverflowError:
            return math.inf if total > 0 else -math.inf

    want = {k: exact(k) for k in range(12)}
    for n in (1, 8, 64):
        assert {r.k: r.sum for r in exact_fold(df.repartition(n), by=("k",)).collect()} == want
    parts = exact_partials(df.withColumn("part", F.abs(F.hash("value")) % 5), by=("k", "part"))
    merged = finish_exact(merge_exact(parts, by=("k",)), by=("k",)).collect()
    assert {r.k: (r["count"], r.sum) for r in merged} == {k: (400, want[k]) for k in want}


def test_exact_runs_do_not_depend_on_splits(spark, tmp_path, small_splits):  # noqa: F811
    rng = random.Random(8)
    values = [v for v in doubles(rng, 900) if abs(v) < 1e300]
    path = put(tmp_path / "in", *[f"t,l,s,m,{v!r}" for v in values])
    want = sum(map(Fraction, values), Fraction(0))
    for size in ("3000", "100000000"):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        partials = str(tmp_path / f"p{size}")
        result = run_pipeline(spark, RunOptions(input=path, output=str(tmp_path / "out"), exact=True, partials=partials, chunk_size=100))
        assert result.sum == want.numerator / want.denominator
        for r in spark.read.parquet(partials).collect():
            part = sum(map(Fraction, values[r.chunk_id * 100 : r.chunk_id * 100 + 100]), Fraction(0))
            assert r.sum == part.numerator / part.denominator


@pytest.mark.parametrize("values, want", [
    ([], 0.0), ([None], 0.0), ([-0.0], 0.0), ([math.inf, 1.0], math.inf), ([-math.inf, 1e308, 1e308], -math.inf),
    ([math.inf, -math.inf], math.nan), ([math.nan, 1.0], math.nan), ([1e308, 1e308, -1e308], 1e308), ([1e308, 1e308], math.inf),
    ([0.1] * 10, 1.0), ([1e16, 1.0, -1e16], 1.0), ([5e-324, 5e-324], 1e-323),
])
def test_unusual_sums(spark, values, want):
    row = exact_fold(spark.createDataFrame([(v,) for v in values], "value double")).first()
    assert (row.sum == want or (math.isnan(row.sum) and math.isnan(want))) and row["count"] == sum(v is not None for v in values)


# --- batches and deliveries ----------------------------------------------------------------


def test_a_large_batch_is_many_sorted_runs(spark, tmp_path):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    n = 200_000
    lines = spark.range(n).select((F.col("id") + 1).alias("line_no"), F.concat(F.lit("t,l,s,m,"), (F.col("id") / 4).cast("string")).alias("line"))
    B.process_runs(lines.repartition(7), 150_000, str(tmp_path / "runs"))
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    parts = sorted((tmp_path / "runs" / "lines").glob("part-*"))
    assert len(parts) > 4
    rows = [r for p in parts for r in spark.read.parquet(str(p)).select("sequence", "line_no").collect()]
    assert [r.line_no for r in rows] == list(range(1, n + 1))
    partials = spark.read.parquet(str(tmp_path / "runs" / "partials")).orderBy("sequence").collect()
    assert [(r.sequence, r["count"], r.sum) for r in partials] == [
        (0, 150_000, sum(range(150_000)) / 4), (1, 50_000, sum(range(150_000, n)) / 4),
    ]


def test_runs_equal_gathered_batches(spark, tmp_path):
    lines = spark.createDataFrame(
        [(i + 1, x) for i, x in enumerate(["6:00,high,p,one,2.0", "6:15,low,p,two,99.0", "", "bad", "7:00,high,p,x,-1", "a,high,c,d,0.5"])],
        "line_no long, line string",
    )
    B.process_runs(lines, 2, str(tmp_path / "runs"), F.col("level") == "high")
    want = B.process_chunks(lines, 2, F.col("level") == "high").orderBy("sequence").collect()
    got = spark.read.parquet(str(tmp_path / "runs" / "partials")).orderBy("sequence").collect()
    assert [(r.sequence, tuple(r.partial)) for r in want] == [(r.sequence, (r["count"], r.sum, r.min, r.max)) for r in got]
    out = spark.read.parquet(str(tmp_path / "runs" / "lines")).orderBy("sequence", "line_no").collect()
    assert [x for r in want for x in r.output_lines] == [r.line for r in out]


def test_each_delivery_gives_out_the_new_prefix(spark, tmp_path):
    def results(*numbers):
        return spark.createDataFrame([(n, [f"{n}a", f"{n}b"][: n % 3]) for n in numbers], "sequence long, output_lines array<string>")

    def desk():  # a new one each time: what lasts is in the folder
        return B.Resequencer(spark, str(tmp_path / "state"), str(tmp_path / "lines"))

    assert desk().deliver(results(2, 4, 1)) == (0, 0)
    assert desk().deliver(results(0, 2)) == (0, 3)
    assert desk().deliver(results()) == (3, 3)
    assert desk().deliver(results(0, 5, 7, 3, 3)) == (3, 6)
    assert desk().deliver(results(6)) == (6, 8)
    lines = spark.read.parquet(str(tmp_path / "lines")).orderBy("split", "sequence", "pos").collect()
    assert [r.line for r in lines] == [x for n in range(8) for x in [f"{n}a", f"{n}b"][: n % 3]]
    assert desk().state() == (5, 8)
    assert len(list((tmp_path / "state").glob("waiting-*"))) == 1


def test_a_delivery_that_fails_is_made_again(spark, tmp_path, monkeypatch):
    desk = B.Resequencer(spark, str(tmp_path / "state"), str(tmp_path / "lines"))
    batch = spark.createDataFrame([(0, ["a"]), (1, ["b"])], "sequence long, output_lines array<string>")
    with monkeypatch.context() as patch:
        patch.setattr(spark, "createDataFrame", lambda *a, **b: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            desk.deliver(batch)
    assert desk.state() == (0, 0) and desk.deliver(batch) == (0, 2)
    assert spark.read.parquet(str(tmp_path / "lines")).count() == 2


# --- numbered ingestion --------------------------------------------------------------------


def deliver(folder, names):
    folder.mkdir(exist_ok=True)
    for name in names:
        put(folder / name, *readings(5 + ord(name[0]) % 7, seed=ord(name[0])), "bad", "")
        os.utime(folder / name, (ord(name[0]) * 1000,) * 2)


def ingested(spark, folder):
    rows = I.read_numbered(spark, str(folder)).select("input_no", "line_no", "line", "status").orderBy("input_no").collect()
    return [tuple(r) for r in rows]


def test_interrupted_and_resumed_equals_one_run(spark, tmp_path, monkeypatch):
    deliver(tmp_path / "in", "abc")
    args = [spark, str(tmp_path / "in"), str(tmp_path / "whole"), str(tmp_path / "cp1")]
    I.ingest_numbered(*args, files_per_batch=1)
    want = ingested(spark, tmp_path / "whole")
    assert [r[0] for r in want] == list(range(1, len(want) + 1)) and [r[1] for r in want][-1] == 5 + ord("c") % 7 + 2

    args = [spark, str(tmp_path / "in"), str(tmp_path / "broken"), str(tmp_path / "cp2")]
    numbers, calls = I.with_line_numbers, []

    def failing(lines):
        calls.append(1)
        if len(calls) == 2:
            raise RuntimeError("interrupted")
        return numbers(lines)

    with monkeypatch.context() as patch:
        patch.setattr(I, "with_line_numbers", failing)
        with pytest.raises(Exception, match="interrupted"):
            I.ingest_numbered(*args, files_per_batch=1)
    assert len(ingested(spark, tmp_path / "broken")) < len(want)
    I.ingest_numbered(*args, files_per_batch=1)
    assert ingested(spark, tmp_path / "broken") == want
    deliver(tmp_path / "in", "d")
    I.ingest_numbered(*args)
    I.ingest_numbered(*args)
    after = ingested(spark, tmp_path / "broken")
    assert after[: len(want)] == want and [r[0] for r in after] == list(range(1, len(after) + 1))
    ledger = I.read_ledger(spark, str(tmp_path / "broken")).orderBy("lines_before").collect()
    assert [r.file_path[-1] for r in ledger] == list("abcd") and sum(r.lines for r in ledger) == len(after)
    assert spark.read.schema(S.RECORD_SCHEMA).parquet(str(tmp_path / "broken" / "lines")).count() == len(after)
