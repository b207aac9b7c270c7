"""One query per operator over the given tables: ``name(spark, sf_dir) -> DataFrame``."""

from __future__ import annotations

from functools import reduce

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession, functions as F

from tallyline import schema as S
from tallyline.functions import guard_formula, quote_field, render_line
from tallyline.functions.text import blank_controls
from tallyline.operators import aggregates as A
from tallyline.operators import batches as B
from tallyline.operators import predicates as P
from tallyline.operators import transforms as T
from tallyline.operators.compare import difference
from tallyline.operators.decode import decode_lines, diagnostic
from tallyline.operators.exact import exact_fold, exact_partials, finish_exact, merge_exact
from tallyline.operators.policy import MalformedLineError, dead_letters, records
from tallyline.operators.preview import every_nth, infer_types
from tallyline.plans import tables as L
from tallyline.plans.run import RunOptions, RunResult, run_pipeline
from tallyline.plans.summary import append_history, read_history, run_totals, summarise, unreconciled
from tallyline.session import saved, shared_folder
from tallyline.sinks.lines import write_lines, write_one_file
from tallyline.sinks.publish import publishing
from tallyline.sources.lines import PART_ORDER, head_lines, read_lines, read_ordered, strip_bom, with_line_numbers
from tallyline.sources.tables import as_records, read_jsonl
from tallyline.streaming.ingest import ingest, ingest_lines, ingest_numbered, read_ingested, read_ledger, read_numbered

QUERIES = {}

RECORD = ("line_no", *S.RECORD_COLUMNS)
# Values have two decimals, scaled ones three: exact as decimals, in any order.
PLACES = 4


def query(function):
    QUERIES[function.__name__] = function
    return function


def _decoded(spark: SparkSession, sf: str) -> DataFrame:
    return decode_lines(L.log_lines(spark, sf))


def _dirty(spark: SparkSession, sf: str) -> DataFrame:
    return decode_lines(L.dirty_lines(spark, sf))


def _customers(spark: SparkSession, sf: str) -> DataFrame:
    return records(decode_lines(L.to_lines(L.log_customers(spark, sf)))).select(*RECORD)


def _events(spark: SparkSession, sf: str) -> DataFrame:
    return records(_decoded(spark, sf)).select(*RECORD)


# --- decode, filter, scale, fold ---------------------------------------------------------


@query
def q_flagship(spark, sf):
    kept = T.filter_then_transform(
        _events(spark, sf),
        P.level_in("error", "purchase") & P.value_between(5.0, 100.0),
        T.scale_value(0.5),
    )
    return A.fold(kept, exact_scale=PLACES)


@query
def q_lineitem_pipeline(spark, sf):
    lines = L.log_lineitem(spark, sf).select(render_line().alias("line"))
    kept = T.filter_then_transform(
        records(decode_lines(lines)),
        P.level_in("A", "N") & P.value_between(1000.0, 60000.0),
        T.scale_value(0.5),
    )
    return A.fold(kept, exact_scale=PLACES)


# --- decoding ----------------------------------------------------------------------------


@query
def q_decode_clean(spark, sf):
    return _events(spark, sf)


@query
def q_decode_dirty(spark, sf):
    return records(_dirty(spark, sf)).select(*RECORD)


@query
def q_decode_documents(spark, sf):
    return records(decode_lines(L.to_lines(L.log_documents(spark, sf)))).select(*RECORD)


@query
def q_line_status(spark, sf):
    return _dirty(spark, sf).groupBy("status").agg(F.count(F.lit(1)).alias("lines"))


@query
def q_dead_letter(spark, sf):
    return dead_letters(_dirty(spark, sf)).select(
        "line_no", "status", diagnostic(F.col("line_no"), F.col("reason")).alias("message")
    )


# --- filters -----------------------------------------------------------------------------


@query
def q_filter_level(spark, sf):
    return _events(spark, sf).filter(P.level_in("error", "purchase"))


@query
def q_filter_source(spark, sf):
    return _events(spark, sf).filter(P.source_in("svc-1", "svc-3"))


@query
def q_filter_range(spark, sf):
    return _customers(spark, sf).filter(P.value_between(-500.0, 500.0))


@query
def q_filter_min_only(spark, sf):
    return _customers(spark, sf).filter(P.value_between(low=-100.0))


@query
def q_filter_max_only(spark, sf):
    return _customers(spark, sf).filter(P.value_between(high=0.0))


@query
def q_filter_and(spark, sf):
    return _events(spark, sf).filter(P.all_of(P.level_in("view"), P.value_between(low=20.0)))


@query
def q_filter_or(spark, sf):
    return _events(spark, sf).filter(P.any_of(P.level_in("signup"), P.source_in("svc-2")))


@query
def q_filter_options(spark, sf):
    options = {"level": "error,click", "source": "svc-1", "min_value": 10.0, "max_value": 60.0}
    return _events(spark, sf).filter(P.build_predicate(**options))


@query
def q_filter_accept_all(spark, sf):
    return _events(spark, sf).filter(P.build_predicate(level=",", source=" "))


@query
def q_custom_predicate(spark, sf):
    return _events(spark, sf).filter(P.matching(lambda batch: batch["message"].str.len() % 2 == 0))


# --- transforms --------------------------------------------------------------------------


@query
def q_scale(spark, sf):
    return T.scale_value(0.5)(_events(spark, sf))


@query
def q_upper_level(spark, sf):
    return T.upper_level()(_events(spark, sf))


@query
def q_custom_transform(spark, sf):
    def label(batch):
        return batch.assign(message=batch["level"] + ": " + batch["message"])

    return T.in_pandas(label)(_events(spark, sf))


@query
def q_filter_before_transform(spark, sf):
    return T.filter_then_transform(
        _events(spark, sf),
        P.level_in("error") & P.value_between(low=40.0),
        T.chain(T.scale_value(0.5), T.upper_level()),
    )


# --- aggregates --------------------------------------------------------------------------


@query
def q_aggregate(spark, sf):
    return A.fold(_events(spark, sf), exact_scale=PLACES)


@query
def q_aggregate_empty(spark, sf):
    nothing = _events(spark, sf).filter(P.level_in("no such level"))
    return A.fold(nothing).select(
        "count", *[F.col(c).cast("string").alias(c) for c in ("sum", "min", "max", "avg")]
    )


@query
def q_partials(spark, sf):
    return A.fold_by_chunk(B.with_chunks(_events(spark, sf), 2000), exact_scale=PLACES)


@query
def q_merge_partials(spark, sf):
    return A.merge_partials(q_partials(spark, sf), exact_scale=PLACES)


# --- batches -----------------------------------------------------------------------------


@query
def q_chunks(spark, sf):
    return B.chunk_sizes(L.log_lines(spark, sf), 300)


@query
def q_gather_chunks(spark, sf):
    gathered = B.gather_chunks(L.dirty_lines(spark, sf).select("line_no", "line"), 100)
    blank = F.size(F.filter("lines", lambda line: line == "")).alias("blank")
    return gathered.select("chunk_id", "start_line", "size", blank, F.element_at("lines", -1).alias("last"))


def _batches(spark, sf):
    return B.process_chunks(
        L.log_lines(spark, sf), 50, P.value_between(low=200.0), T.scale_value(0.5)
    )


@query
def q_process_chunks(spark, sf):
    some = F.col("partial.count") > 0
    return _batches(spark, sf).select(
        "sequence",
        "partial.count",
        "partial.sum",
        F.when(some, F.col("partial.min")).alias("min"),
        F.when(some, F.col("partial.max")).alias("max"),
        F.concat_ws("\n", "output_lines").alias("output"),
    )


@query
def q_resequence(spark, sf):
    return B.resequence(saved(_batches(spark, sf), "batches"))


@query
def q_resequence_gap(spark, sf):
    """Batch 3 never arrives; what follows it waits."""
    arrived = _batches(spark, sf).filter(F.col("sequence") != 3)
    return B.resequence(saved(arrived, "batches"))


@query
def q_difference(spark, sf):
    """Damaged and undamaged records, where they differ."""
    dirty = records(_dirty(spark, sf)).select(*RECORD)
    return difference(dirty, L.log_events(spark, sf).select(*RECORD))


# --- rendering ---------------------------------------------------------------------------


@query
def q_render(spark, sf):
    return L.log_lines(spark, sf)


@query
def q_render_documents(spark, sf):
    return L.to_lines(L.log_documents(spark, sf))


@query
def q_formula_guard(spark, sf):
    log = L.log_customers(spark, sf).withColumn("message", F.col("value").cast("string"))
    return log.select(
        "line_no", guard_formula(F.col("message")).alias("guarded"), render_line().alias("line")
    )


@query
def q_quote(spark, sf):
    return L.log_events(spark, sf).select("line_no", quote_field(F.col("message")).alias("quoted"))


# --- files -------------------------------------------------------------------------------


def _written(spark, sf, lines, gzip=False):
    path = shared_folder(spark, "lines")
    write_lines(lines, path, gzip=gzip, order_by=("line_no",))
    return path


@query
def q_line_numbers(spark, sf):
    path = _written(spark, sf, L.dirty_lines(spark, sf))
    return with_line_numbers(read_ordered(spark, path), across=PART_ORDER).select(
        "line_no", F.length("line").alias("width")
    )


def _round_trip(spark, sf, gzip):
    path = _written(spark, sf, L.log_lines(spark, sf), gzip)
    numbered = with_line_numbers(read_ordered(spark, path), across=PART_ORDER)
    return numbered.select("line_no", "line")


@query
def q_scan_round_trip(spark, sf):
    return _round_trip(spark, sf, gzip=False)


@query
def q_gzip_round_trip(spark, sf):
    return _round_trip(spark, sf, gzip=True)


@query
def q_directory(spark, sf):
    """Two inputs read together, a summary for each."""
    root = shared_folder(spark, "inputs")
    write_lines(L.dirty_lines(spark, sf), f"{root}/events", order_by=("line_no",))
    write_lines(L.to_lines(L.log_customers(spark, sf)), f"{root}/customers", order_by=("line_no",))
    lines = read_lines(spark, [f"{root}/events", f"{root}/customers"])
    folder = F.element_at(F.split("file_path", "/"), -2)
    return summarise(
        decode_lines(lines.withColumn("folder", folder)), by=("folder",), exact_scale=PLACES
    )


@query
def q_jsonl(spark, sf):
    path = shared_folder(spark, "jsonl")
    L.log_events(spark, sf).write.json(path)
    return records(read_jsonl(spark, path)).select(*S.RECORD_COLUMNS)


@query
def q_jsonl_line_breaks(spark, sf):
    """Texts of several lines, from JSON lines to output lines: one line per record."""
    path, output = shared_folder(spark, "jsonl"), shared_folder(spark, "lines")
    breaks = L.load(spark, sf, "documents").select("doc_id", "text")
    log = L.log_documents(spark, sf).join(breaks, F.col("line_no") == F.col("doc_id") + 1)
    log.withColumn("message", F.col("text")).select(*S.RECORD_COLUMNS).write.json(path)
    write_lines(records(read_jsonl(spark, path)).select(render_line().alias("line")), output)
    return read_lines(spark, output).select("line")


@query
def q_parquet_records(spark, sf):
    return records(as_records(L.log_customers(spark, sf))).filter(
        P.level_in("BUILDING") & P.value_between(low=0.0)
    ).select(*RECORD)


# --- runs --------------------------------------------------------------------------------


@query
def q_summary(spark, sf):
    return summarise(
        _dirty(spark, sf),
        P.level_in("error", "click"),
        F.col(S.VALUE_COLUMN) * F.lit(0.5),
        exact_scale=PLACES,
    )


def _run(spark, path, **options) -> tuple[RunResult, str]:
    output = shared_folder(spark, "output")
    return run_pipeline(spark, RunOptions(input=path, output=output, **options)), output


@query
def q_run_summary(spark, sf):
    path = _written(spark, sf, L.dirty_lines(spark, sf))
    result, _ = _run(spark, path, level="error,click", value_scale=0.5, exact_scale=PLACES)
    return result.to_frame(spark).select(
        "lines_read", "blank", "malformed", "filtered_out", "records", "min", "max", "sum"
    )


@query
def q_run_output(spark, sf):
    path = _written(spark, sf, L.dirty_lines(spark, sf))
    _, output = _run(spark, path, level="error,click", min_value=20.0, gzip=True)
    numbered = with_line_numbers(read_ordered(spark, output), across=PART_ORDER)
    return numbered.select("line_no", "line")


@query
def q_reconcile(spark, sf):
    path = _written(spark, sf, L.dirty_lines(spark, sf))
    result, output = _run(spark, path, source="svc-0,svc-2")
    written = read_lines(spark, output).agg(F.count(F.lit(1)).alias("output_lines"))
    summary = result.to_frame(spark)
    wrong = unreconciled(summary).agg(F.count(F.lit(1)).alias("unreconciled"))
    return written.select(
        "output_lines",
        F.lit(result.records).cast("long").alias("records"),
        F.lit(result.count).cast("long").alias("count"),
        F.lit(result.lines_read).cast("long").alias("lines_read"),
        wrong.scalar().alias("unreconciled"),
    )


def _two_folders(spark, sf):
    root = shared_folder(spark, "inputs")
    write_lines(L.dirty_lines(spark, sf), f"{root}/events", order_by=("line_no",))
    write_lines(L.to_lines(L.log_customers(spark, sf)), f"{root}/customers", order_by=("line_no",))
    return f"{root}/*"


def _counts(result, spark):
    return result.to_frame(spark).select("lines_read", "blank", "malformed", "filtered_out", "records")


@query
def q_run_no_match(spark, sf):
    """A filter that is never true still counts every line."""
    path = _written(spark, sf, L.dirty_lines(spark, sf))
    return _counts(_run(spark, path, predicate=F.lit(False))[0], spark)


@query
def q_run_sorting_transform(spark, sf):
    """A transform that moves the rows changes neither the counts nor the order of the output."""
    path = _written(spark, sf, L.dirty_lines(spark, sf))
    result, output = _run(
        spark, path, level="error,click", transform=lambda df: df.orderBy(F.col(S.VALUE_COLUMN).desc())
    )
    numbered = with_line_numbers(read_ordered(spark, output), across=PART_ORDER)
    counts = [F.lit(getattr(result, c)).cast("long").alias(c) for c in ("lines_read", "filtered_out", "records")]
    return numbered.select("line_no", "line", *counts)


@query
def q_run_partials(spark, sf):
    """Batches of several files stay apart: every key once, and per folder they merge to its fold."""
    partials = shared_folder(spark, "partials")
    _run(spark, _two_folders(spark, sf), partials=partials, chunk_size=70, exact_scale=PLACES)
    rows = spark.read.parquet(partials).withColumn("folder", F.element_at(F.split("file_path", "/"), -2))
    keys = rows.groupBy("folder").agg(
        (F.countDistinct("file_path", "chunk_id") == F.count("*")).alias("keys_are_unique")
    )
    return A.merge_partials(rows, by=("folder",), exact_scale=PLACES).join(keys, "folder")


@query
def q_run_dead_letters(spark, sf):
    """Dead letters name the line that stands at their number."""
    dead, source = shared_folder(spark, "dead"), _two_folders(spark, sf)
    _run(spark, source, dead_letters=dead)
    lines = with_line_numbers(read_lines(spark, source)).select("file_path", "line_no", F.col("line").alias("there"))
    return (
        spark.read.json(dead).join(lines, ["file_path", "line_no"], "left")
        .groupBy("status").agg(F.count("*").alias("lines"), F.count_if(F.col("line") == F.col("there")).alias("found"))
    )


@query
def q_failed_run(spark, sf):
    """Runs that fail leave the input and an older output as they were."""
    source = _written(spark, sf, L.dirty_lines(spark, sf))
    output = _written(spark, sf, L.to_lines(L.log_customers(spark, sf)))
    value = F.col(S.VALUE_COLUMN)
    endless = F.when(value < 50, F.lit(float("inf"))).otherwise(F.lit(float("-inf")))
    failures = {
        "malformed": {"policy": "fail_fast"},
        "nan": {"transform": lambda df: df.withColumn(S.VALUE_COLUMN, F.lit(float("nan")))},
        "opposite infinities": {"transform": lambda df: df.withColumn(S.VALUE_COLUMN, endless)},
        "overlap": {"output": source},
    }
    rows = []
    for name, options in failures.items():
        try:
            run_pipeline(spark, RunOptions(**{"input": source, "output": output, **options}))
            error = None
        except Exception as e:  # noqa: BLE001 - the name is the result
            error = type(e).__name__
        left = [read_lines(spark, place).count() for place in (source, output)]
        rows.append((name, error, *left))
    return spark.createDataFrame(rows, "failure string, error string, input_lines long, output_lines long")


@query
def q_run_history(spark, sf):
    path = _written(spark, sf, L.dirty_lines(spark, sf))
    history = shared_folder(spark, "history")
    for level in ("error", "click", "error,click,view"):
        result, _ = _run(spark, path, level=level)
        append_history(result.to_frame(spark), history)
    return run_totals(read_history(spark, history)).select(
        "runs", "lines_read", "records", "malformed"
    )


# --- runs over several files, other formats, faults ------------------------------------------


def _numbered_output(spark, output):
    return with_line_numbers(read_ordered(spark, output), across=PART_ORDER).select("line_no", "line")


@query
def q_run_many_files(spark, sf):
    """One flat output of many files, in input order without a sort."""
    _, output = _run(spark, _two_folders(spark, sf), min_value=20.0)
    return _numbered_output(spark, output)


@query
def q_run_file_summary(spark, sf):
    """A summary per file, from the pass that writes the output; they add up to that of the run."""
    place = shared_folder(spark, "files")
    result, _ = _run(
        spark, _two_folders(spark, sf), level="error,click,BUILDING", file_summary=place, exact_scale=PLACES
    )
    counts = ("lines_read", "blank", "malformed", "filtered_out", "records")
    schema = ", ".join(f"{c} long" for c in counts) + ", file_path string, min double, max double"
    files = spark.read.schema(schema).json(place).withColumn("folder", F.element_at(F.split("file_path", "/"), -2))
    total = files.agg(*[F.sum(c).alias(c) for c in counts]).first()
    adds_up = F.lit(all(total[c] == getattr(result, c) for c in counts))
    by_folder = files.groupBy("folder").agg(*[F.sum(c).alias(c) for c in counts], F.min("min").alias("min"), F.max("max").alias("max"))
    return by_folder.withColumn("adds_up", adds_up)


@query
def q_first_malformed(spark, sf):
    """A run that must stop names the first malformed line, wherever its task comes."""
    root = shared_folder(spark, "inputs")
    clean, dirty = L.to_lines(L.log_customers(spark, sf)), L.dirty_lines(spark, sf)
    late = clean.withColumn("line", F.when(F.col("line_no") == clean.count(), "cut off").otherwise(F.col("line")))
    places = {"early": dirty, "late": late, "none": clean}
    rows = []
    for name, lines in places.items():
        path = f"{root}/{name}"
        write_one_file(lines, path, order_by=("line_no",))
        output = shared_folder(spark, "output")
        try:
            found = str(run_pipeline(spark, RunOptions(input=path, output=output, policy="fail_fast")).records)
        except MalformedLineError as e:
            found = str(e)
        rows.append((name, found))
    both = shared_folder(spark, "output")
    try:
        run_pipeline(spark, RunOptions(input=f"{root}/*", output=both, policy="fail_fast"))
    except MalformedLineError as e:
        rows.append(("all", str(e)))
    return spark.createDataFrame(rows, "input string, found string")


def _damaged(spark, sf):
    log = L.log_events(spark, sf)
    n = F.col("line_no")
    return (
        log.withColumn("value", F.when(n % 7 != 0, F.col("value"))).withColumn("source", F.when(n % 11 != 0, F.col("source")))
        .orderBy("line_no").select(*S.RECORD_COLUMNS)
    )


def _typed_run(spark, path, input_format):
    dead = shared_folder(spark, "dead")
    result, output = _run(spark, path, input_format=input_format, level="error,click", dead_letters=dead)
    lost = spark.read.json(dead).agg(F.count("*").alias("n"), F.count_if(F.col("status") == S.COLUMN_COUNT).alias("m")).first()
    counts = {"lines_read": result.lines_read, "malformed": result.malformed, "dead": lost["n"], "no_source": lost["m"]}
    numbered = _numbered_output(spark, output)
    return numbered.select("line_no", "line", *[F.lit(v).cast("long").alias(c) for c, v in counts.items()])


@query
def q_run_jsonl(spark, sf):
    path = shared_folder(spark, "jsonl")
    _damaged(spark, sf).write.json(path)
    return _typed_run(spark, path, "jsonl")


@query
def q_run_parquet(spark, sf):
    path = shared_folder(spark, "parquet")
    _damaged(spark, sf).write.parquet(path)
    return _typed_run(spark, path, "parquet")


@query
def q_publish_faults(spark, sf):
    """Several outputs, and a fault before each of their moves: all are old, or all are new."""
    old, new = L.to_lines(L.log_customers(spark, sf)), L.log_lines(spark, sf)

    def put(lines, places):
        write_lines(lines, places["output"])
        write_lines(lines, places["summary"])
        lines.groupBy().count().write.mode("append").parquet(places["history"])

    rows = []
    for fault in range(6):
        root = shared_folder(spark, "publish")
        places = {name: f"{root}/{name}" for name in ("output", "summary", "history")}
        put(old, places)

        def fail(move):
            if move == fault:
                raise OSError("the file system is gone")

        error = None
        try:
            with publishing(spark, places, added=("history",), before_move=fail) as staged:
                put(new, staged)
        except OSError as e:
            error = str(e)
        lines = [read_lines(spark, places[name]).count() for name in ("output", "summary")]
        rows.append((fault, error, *lines, spark.read.parquet(places["history"]).count()))
    return spark.createDataFrame(rows, "fault int, error string, output_lines long, summary_lines long, runs long")


# --- sums, batches and deliveries ----------------------------------------------------------


@query
def q_exact_sums(spark, sf):
    """Sums of doubles of all sizes, equal to the last bit in 1, 8 and 64 partitions."""
    quarter = F.floor(F.col("value") * 4) / 4
    log = L.log_events(spark, sf).select("level", quarter.alias("v"))
    signs = F.array(*[F.lit(float(x)) for x in (1, 1e300, -1e300, 1e-300, -1e-300, 1e16, -1e16)])

    def values(rows):
        return rows.select("level", F.explode(signs).alias("by"), "v").select("level", (F.col("v") * F.col("by")).alias("value"))

    # rows are dealt before each becomes seven values
    rows = [
        exact_fold(values(log.repartition(n)), by=("level",)).select(F.lit(n).alias("partitions"), "level", "count", "sum")
        for n in (1, 8, 64)
    ]
    merged = finish_exact(merge_exact(exact_partials(values(log).withColumn("part", F.col("value") > 0), by=("level", "part")), by=("level",)), by=("level",))
    rows.append(merged.select(F.lit(0).alias("partitions"), "level", "count", "sum"))
    return reduce(DataFrame.unionByName, rows)


@query
def q_process_runs(spark, sf):
    """Batches as sorted runs: no batch is gathered, every batch has its partial."""
    path = shared_folder(spark, "runs")

    def eighths(df):
        return df.withColumn(S.VALUE_COLUMN, F.floor(F.col(S.VALUE_COLUMN) * 4) / 8)

    B.process_runs(L.log_lines(spark, sf), 50, path, P.value_between(low=200.0), eighths)
    lines = spark.read.parquet(f"{path}/lines").groupBy("sequence").agg(
        F.count("*").alias("lines"), F.min_by("line", "line_no").alias("first"), F.max_by("line", "line_no").alias("last")
    )
    some = F.col("count") > 0
    partials = spark.read.parquet(f"{path}/partials").select(
        "sequence", "count", "sum", F.when(some, F.col("min")).alias("min"), F.when(some, F.col("max")).alias("max")
    )
    return partials.join(lines, "sequence", "left").withColumn("lines", F.coalesce("lines", F.lit(0).cast("long")))


@query
def q_resequence_deliveries(spark, sf):
    """Three deliveries out of order: each call gives out what is due by then, and no line twice."""
    batches, root = saved(_batches(spark, sf), "batches"), shared_folder(spark, "deliveries")
    desk = B.Resequencer(spark, f"{root}/state", f"{root}/lines")
    call = (F.col("sequence") * 7 + F.col("sequence") % 4) % 3
    ends = []
    for n in range(3):
        ends.append(desk.deliver(batches.filter(call <= n)))  # what came before comes again
    lines = spark.read.parquet(f"{root}/lines").select("sequence", "pos", "line")
    given = reduce(lambda c, n: F.when(F.col("sequence") < ends[n][1], n).otherwise(c), (2, 1, 0), F.lit(None))
    return lines.withColumn("call", given.cast("int"))


# --- previews and streams ----------------------------------------------------------------


@query
def q_every_nth(spark, sf):
    return every_nth(L.log_lines(spark, sf), 10)


@query
def q_infer_types(spark, sf):
    return infer_types(L.log_lines(spark, sf))


@query
def q_infer_types_dirty(spark, sf):
    return infer_types(L.dirty_lines(spark, sf))


@query
def q_resume(spark, sf):
    """Two deliveries and an idle call: every line is stored once."""
    root = shared_folder(spark, "stream")
    incoming, table, checkpoint = (f"{root}/{name}" for name in ("in", "table", "checkpoint"))
    L.dirty_lines(spark, sf).select("line").write.text(incoming)
    ingest(spark, incoming, table, checkpoint)
    customers = L.to_lines(L.log_customers(spark, sf))
    customers.select("line").write.mode("append").text(incoming)
    ingest(spark, incoming, table, checkpoint)
    ingest(spark, incoming, table, checkpoint)
    return read_ingested(spark, table).groupBy("status").agg(F.count(F.lit(1)).alias("lines"))


@query
def q_ingest_lines(spark, sf):
    root = shared_folder(spark, "stream")
    incoming, output, checkpoint = (f"{root}/{name}" for name in ("in", "out", "checkpoint"))
    L.dirty_lines(spark, sf).select("line").write.text(incoming)
    for _ in range(2):
        ingest_lines(
            spark, incoming, output, checkpoint, P.level_in("purchase"), T.scale_value(0.5)
        )
    return read_lines(spark, output).select("line")


@query
def q_head_lines(spark, sf):
    """The first lines of many files; the types of these lines alone."""
    path = _written(spark, sf, L.dirty_lines(spark, sf))
    head = head_lines(spark, path, 40)
    clean = _written(spark, sf, L.log_lines(spark, sf))
    types = infer_types(head_lines(spark, clean, 3)).first()
    return head.select("line_no", F.length("line").alias("width"), *[F.lit(v).alias(f"type_of_{c}") for c, v in types.asDict().items()])


@query
def q_ingest_numbered(spark, sf):
    """Deliveries to a stream, numbered in order of arrival through all of them."""
    root = shared_folder(spark, "stream")
    incoming, output, checkpoint = (f"{root}/{name}" for name in ("in", "out", "checkpoint"))
    for lines in (L.dirty_lines(spark, sf), L.to_lines(L.log_customers(spark, sf))):
        lines.orderBy("line_no").select("line").write.mode("append").text(incoming)
        ingest_numbered(spark, incoming, output, checkpoint)
    ledger = read_ledger(spark, output)
    return read_numbered(spark, output).join(ledger, "file_path").select(
        "input_no", "status", F.length("line").alias("width"), (F.col("input_no") - F.col("lines_before") == F.col("line_no")).alias("fits")
    )


# --- small ones --------------------------------------------------------------------------


@query
def q_line_ends(spark, sf):
    """LF, CRLF and CR end a line, and a file may end without one."""
    root, lines = shared_folder(spark, "ends"), L.log_lines(spark, sf)
    found = []
    for name, end in (("lf", "\n"), ("crlf", "\r\n"), ("cr", "\r")):
        lines.select("line").write.option("lineSep", end).text(f"{root}/{name}")
        found.append(read_lines(spark, f"{root}/{name}").select(F.lit(name).alias("line_end"), "line"))
    return reduce(DataFrame.unionByName, found)


@query
def q_invalid_bytes(spark, sf):
    """Bytes that are no UTF-8 become the replacement character."""
    path = shared_folder(spark, "bytes")
    broken = F.concat(F.col("message").cast("binary"), F.unhex(F.lit("FF")), F.lit("!").cast("binary"))
    L.log_events(spark, sf).select(broken.cast("string").alias("line")).write.text(path)
    return read_lines(spark, path).select("line")


@query
def q_byte_order_mark(spark, sf):
    """A mark goes at the start of a file, and on line 1 of lines that come from none; elsewhere it stays."""
    mark, path = "\ufeff", shared_folder(spark, "marks")
    lines = L.log_lines(spark, sf)
    marked = lines.withColumn("line", F.concat(F.lit(mark), "line"))
    write_one_file(marked, path, order_by=("line_no",))
    file = with_line_numbers(read_ordered(spark, path), across=PART_ORDER).select("line_no", "line")
    return file.select(F.lit("file").alias("source"), "line_no", "line").unionByName(
        strip_bom(marked).select(F.lit("memory").alias("source"), "line_no", "line")
    )


def _outcome(spark, output, **options):
    try:
        run_pipeline(spark, RunOptions(output=output, **options))
        return None
    except Exception as e:  # noqa: BLE001 - the name is the result
        return type(e).__name__


@query
def q_missing_input(spark, sf):
    """A run without input or without a place for its output fails, and what is there stays."""
    output = _written(spark, sf, L.log_lines(spark, sf))
    file = f"{output}/{read_lines(spark, output).select('file_path').first()[0].rsplit('/', 1)[1]}"
    source = _written(spark, sf, L.to_lines(L.log_customers(spark, sf)))
    cases = {
        "no input": _outcome(spark, output, input=shared_folder(spark, "nothing")),
        "output below a file": _outcome(spark, f"{file}/below", input=source),
    }
    left = [read_lines(spark, place).count() for place in (output, source)]
    return spark.createDataFrame(
        [(name, error is not None, *left) for name, error in cases.items()],
        "failure string, failed boolean, output_lines long, input_lines long",
    )


@query
def q_long_fields(spark, sf):
    """A field of more than 10 MB decodes unchanged."""
    long = L.log_documents(spark, sf).filter(F.length("message") >= 1000)
    longest = long.agg(F.max_by("line_no", F.struct(F.length("message"), "line_no"))).first()[0]
    times = F.when(F.col("line_no") == longest, F.ceil(F.lit(10 * 2**20) / F.length("message"))).otherwise(1)
    lines = L.to_lines(long.withColumn("message", F.repeat("message", times.cast("int"))))
    return records(decode_lines(lines)).select("line_no", F.length("message").alias("width"), F.md5(F.col("message").cast("binary")).alias("digest"))


@query
def q_identity(spark, sf):
    return T.filter_then_transform(_events(spark, sf), F.lit(True), T.identity())


@query
def q_count_overflow(spark, sf):
    """Partials with counts that add up beyond a long stop the merge; those that just fit do not."""
    partials = A.fold_by_chunk(B.with_chunks(_events(spark, sf), 100)).filter("chunk_id < 2")
    rows = []
    for name, count in (("fits", 2**62 - 1), ("overflows", 2**62)):
        try:
            found = str(A.merge_partials(partials.withColumn("count", F.lit(count))).first()["count"])
        except PySparkException as e:
            found = "overflow" if "aggregate count overflow" in str(e) else str(e)
        rows.append((name, found))
    return spark.createDataFrame(rows, "case string, found string")


@query
def q_control_characters(spark, sf):
    noisy = F.concat(F.lit("\x07"), F.col("message"), F.lit("\x00\x1f\x7f\n"), F.col("level"))
    return L.log_events(spark, sf).select("line_no", blank_controls(noisy).alias("plain"))


@query
def q_throughput(spark, sf):
    """Lines per second are the lines read by the run's own time, in the result and in the JSON summary."""
    place = shared_folder(spark, "summary")
    result, _ = _run(spark, _written(spark, sf, L.dirty_lines(spark, sf)), summary=place)
    written = spark.read.json(place)
    fits = abs(result.lines_per_s * result.duration_s - result.lines_read) < 1e-3
    return written.select(
        "lines_read", "blank", "malformed", "filtered_out", "records", "min", "max",
        (F.lit(fits) & (F.col("duration_s") > 0)).alias("fits"),
    )
