"""The whole run: text in, filtered and transformed text out, and a summary."""

from __future__ import annotations

import time
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from contextlib import ExitStack
from dataclasses import asdict, dataclass
from functools import partial

from pyspark.sql import Column, DataFrame, Observation, Row, SparkSession, functions as F

from tallyline import schema as S
from tallyline.operators import policy as P
from tallyline.operators.aggregates import EMPTY, check_aggregate, fold_columns
from tallyline.operators.batches import check_chunk_size, with_chunks
from tallyline.operators.decode import decode_lines, is_malformed
from tallyline.operators.exact import exact_fold
from tallyline.operators.policy import MalformedLineError, check_policy, records
from tallyline.operators.predicates import all_of, build_predicate, check_range
from tallyline.operators.transforms import (
    Transform,
    chain,
    check_factor,
    filter_then_transform,
    reject_nan,
    scale_value,
)
from tallyline.plans.summary import ReconciliationError, append_history, line_counts
from tallyline.session import stored
from tallyline.sinks import fanout as K
from tallyline.sinks.publish import adopt, check_apart, publishing, recover, scratch, write_note
from tallyline.sinks.reports import write_json, write_summary
from tallyline.sources.lines import files_in_order, literal, number_of, read_lines
from tallyline.sources.tables import decode_json, read_parquet_rows

FORMATS = ("text", "jsonl", "parquet")
#: What a run may write, by option.
PLACES = ("output", "dead_letters", "summary", "history", "partials", "file_summary")


@dataclass(frozen=True)
class RunOptions:
    """What to read, keep, change and write; checked when it is made.

    ``predicate`` and ``transform`` come on top of the text options: the filter
    must hold as well, the transform runs after the scaling. ``exact`` makes all
    sums, of any doubles, the same to the last bit however the input is split;
    ``exact_scale`` does so in one pass for values of so many decimal places.
    """

    input: str
    output: str
    policy: str = P.SKIP
    gzip: bool = False
    level: str | None = None
    source: str | None = None
    min_value: float | None = None
    max_value: float | None = None
    value_scale: float | None = None
    predicate: Column | None = None
    transform: Transform | None = None
    per_file: bool = False
    dead_letters: str | None = None
    summary: str | None = None
    history: str | None = None
    partials: str | None = None
    chunk_size: int = 2000
    exact_scale: int | None = None
    input_format: str = "text"
    file_summary: str | None = None
    exact: bool = False

    def __post_init__(self) -> None:
        if not self.input or not self.output:
            raise ValueError("input and output are required")
        check_policy(self.policy)
        if self.input_format not in FORMATS:
            raise ValueError(f"the input format must be one of {', '.join(FORMATS)}")
        check_chunk_size(self.chunk_size)
        check_range(self.min_value, self.max_value)
        if self.value_scale is not None:
            check_factor(self.value_scale)

    def keeps(self) -> Column:
        built = build_predicate(self.level, self.source, self.min_value, self.max_value)
        return built if self.predicate is None else all_of(built, self.predicate)

    def needs_ledger(self) -> bool:
        return bool(self.partials or self.dead_letters or self.file_summary or self.exact)

    def change(self) -> Transform | None:
        steps = [] if self.value_scale is None else [scale_value(self.value_scale)]
        if self.transform is not None:
            steps.append(self.transform)
        return chain(*steps) if steps else None


@dataclass(frozen=True)
class RunResult:
    lines_read: int
    blank: int
    malformed: int
    filtered_out: int
    records: int
    count: int
    sum: float
    min: float
    max: float
    avg: float
    duration_s: float

    @property
    def lines_per_s(self) -> float:
        return self.lines_read / self.duration_s if self.duration_s else float("nan")

    def to_frame(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame([Row(**asdict(self))])


def read_input(spark: SparkSession, path: str | Sequence[str], input_format: str = "text") -> DataFrame:
    """The lines or rows of an input, decoded: positions, ``line``, the record, ``status`` and ``reason``."""
    if input_format == "parquet":
        return read_parquet_rows(spark, path)
    lines = read_lines(spark, path)
    return decode_json(lines) if input_format == "jsonl" else decode_lines(lines)


def run_pipeline(spark: SparkSession, options: RunOptions) -> RunResult:
    """Read, decode, filter, transform, write in input order, and count.

    Everything is written beside its place and moved there once the counts are
    checked, all or nothing: a run that fails leaves input, output and reports as they were.
    The input is read and decoded once, whatever is wanted: output, dead letters and a ledger for the other reports
    come out of one pass, and the counters ride along with it. A predicate or transform of the caller's may do anything to
    the plan above the counters, so then the decoded lines are stored once, and counted and written from there.
    """
    started = time.monotonic()
    places = {name: getattr(options, name) for name in PLACES}
    check_apart(spark, [options.input], places)
    recover(spark, options.output)
    decoded = read_input(spark, options.input, options.input_format)
    files = K.Files(files_in_order(decoded))
    if options.policy == P.FAIL_FAST:
        # every line is counted by its status, so none gets by
        decoded = decoded.withColumn("status", K.stop_at_malformed())
    with publishing(spark, places, added=("history",)) as new, scratch(spark, options.output) as kinds:
        try:
            with ExitStack() as stack:
                if options.predicate is None and options.transform is None:
                    counts, ledger, dead = _in_one_pass(spark, options, decoded, files, kinds)
                else:
                    counts, ledger, dead = _from_store(spark, options, decoded, files, kinds, stack)
                adopt(spark, f"{kinds}/kind={K.LINE}", new["output"])
                if len(files.paths) > 1 and not options.per_file:
                    names = [{"file_no": i, "file_path": path} for i, path in enumerate(files.paths)]
                    write_note(spark, f"{new['output']}/_manifest", names)
                if options.exact:
                    counts |= exact_fold(ledger.where("kept")).drop("avg").first().asDict()
                result = _result(counts, started)
                _write_reports(spark, options, result, files, ledger, dead, new)
        except Exception as failure:
            if options.policy != P.FAIL_FAST or K.STOPPED_AT not in str(failure):
                raise
            _raise_first_malformed(spark, options, files, str(failure))
            raise
    return result


def _in_one_pass(spark, options: RunOptions, decoded: DataFrame, files: K.Files, kinds: str):
    """Counts, ledger and dead letters of a run with text options, from the pass that writes its output."""
    in_order = len(files.paths) <= 1 and not options.per_file and decoded.rdd.getNumPartitions() <= K.MOST_PARTS
    keeps = F.coalesce(options.keeps(), F.lit(False))
    good = F.col("status") == S.OK
    counted, folded = Observation(), Observation()
    needed = ["line", "reason"] if options.dead_letters else []
    seen = decoded.select(*S.INPUT_ORDER, *S.RECORD_COLUMNS, "status", *needed, (good & keeps).alias("kept")).observe(
        counted, *line_counts(), F.count_if(good & ~F.col("kept")).alias("filtered_out")
    )
    # what is not kept has no value, so that no transform can fail on it
    seen = seen.withColumn(S.VALUE_COLUMN, F.when(F.col("kept"), F.col(S.VALUE_COLUMN)))
    if options.change() is not None:
        seen = reject_nan(options.change()(seen))
    seen = seen.observe(folded, *fold_columns(F.col("kept"), exact_scale=options.exact_scale))
    wants = {"ledger": options.needs_ledger(), "dead": bool(options.dead_letters)}
    K.write_kinds(seen, files, kinds, in_order, options.gzip, options.per_file, **wants)
    ledger = K.read_ledger(spark, f"{kinds}/kind={K.LEDGER}") if wants["ledger"] else None
    return {**counted.get, **folded.get}, ledger, lambda: K.read_dead(spark, f"{kinds}/kind={K.DEAD}")


def _from_store(spark, options: RunOptions, decoded: DataFrame, files: K.Files, kinds: str, stack: ExitStack):
    """The same from the stored lines, for a predicate or transform of the caller's."""
    keeps = F.coalesce(options.keeps(), F.lit(False))
    needed = ["line", "reason"] if options.dead_letters else []
    table = stack.enter_context(
        stored(decoded.select(*S.INPUT_ORDER, *S.RECORD_COLUMNS, "status", *needed), "decoded")
    )
    counts = table.agg(*line_counts()).first().asDict()
    verdicts = records(table).select(keeps.alias("passes"))
    counts |= verdicts.agg(F.count_if(~F.col("passes")).alias("filtered_out")).first().asDict()
    changed = filter_then_transform(records(table), options.keeps(), options.change())
    changed = changed.select(*S.INPUT_ORDER, *S.RECORD_COLUMNS, "status", F.lit(True).alias("kept"))
    kept = stack.enter_context(stored(changed, "changed"))
    counts |= kept.agg(*fold_columns(exact_scale=options.exact_scale)).first().asDict()
    # a transform may have moved rows: those of a split come together again
    K.write_kinds(
        kept.repartition("file_path", "block_start"), files, kinds, False, options.gzip, options.per_file
    )
    ledger = None
    if options.needs_ledger():
        place = ["file_no", "block_start", "row_id", "status"]
        lines = files.number(table).select(
            *place, F.lit(False).alias("kept"), F.lit(None).cast("double").alias(S.VALUE_COLUMN), F.lit(True).alias("is_line")
        )
        ledger = files.number(kept).select(*place, "kept", S.VALUE_COLUMN, F.lit(False).alias("is_line")).unionByName(lines)
    return counts, ledger, lambda: files.number(table.filter(is_malformed())).drop("file_path")


def _raise_first_malformed(spark: SparkSession, options: RunOptions, files: K.Files, failure: str) -> None:
    """Raise for the first malformed line of the input; some task has stopped at one, in the file that ``failure`` names.

    Only that file and those before it can hold the first one. Those before are searched in groups that grow, and of the
    file itself no more splits are read than needed.
    """
    named = [i for i, path in enumerate(files.paths) if f'{{"file_path":"{path}"}}' in failure]
    last = named[0] if named else len(files.paths) - 1
    position, begin, size = F.struct(*S.INPUT_ORDER), 0, 1
    first = None
    while first is None and begin < last:
        group = files.paths[begin : min(begin + size, last)]
        bad = read_input(spark, [literal(p) for p in group], options.input_format).filter(is_malformed())
        first = bad.agg(F.min_by(F.struct(*S.INPUT_ORDER, "reason"), position)).first()[0]
        begin, size = begin + size, 2 * size
    path = literal(first["file_path"] if first else files.paths[last])
    rows = read_input(spark, path, options.input_format)
    found = rows.filter(is_malformed()).select(*S.INPUT_ORDER, P.diagnostic(F.lit("{line_no}"), F.col("reason")).alias("message")).take(1)
    if found:
        number = found[0]["row_id"] + 1 if options.input_format == "parquet" else number_of(rows, found[0])
        raise MalformedLineError(found[0]["message"].replace("{line_no}", str(number), 1)) from None


def _result(counts: dict, started: float) -> RunResult:
    check_aggregate(counts)
    counts = dict(counts)
    well_formed = counts.pop("well_formed")
    accounted = counts["blank"] + counts["malformed"] + counts["filtered_out"] + counts["count"]
    if counts["lines_read"] != accounted:
        raise ReconciliationError(f"the counts do not add up: {counts}, {well_formed} well formed")
    return RunResult(
        **counts,
        records=counts["count"],
        avg=counts["sum"] / counts["count"] if counts["count"] else float("nan"),
        duration_s=time.monotonic() - started,
    )


def _write_reports(spark, options: RunOptions, result: RunResult, files: K.Files, ledger, dead, new: dict) -> None:
    def write_files() -> None:
        write_json(K.summarise_files(ledger, files, options.exact_scale, options.exact), new["file_summary"])

    def write_dead(offsets: DataFrame) -> None:
        bad = files.name(K.with_numbers(dead(), offsets))
        write_json(bad.select("file_path", "line_no", "line", "status", "reason"), new["dead_letters"])

    def write_partials(offsets: DataFrame) -> None:
        numbered = with_chunks(K.with_numbers(ledger, offsets), options.chunk_size)
        folded = K.fold_ledger(numbered, ["file_no", "chunk_id"], options.exact_scale, options.exact)
        files.name(folded).select("file_path", "chunk_id", *EMPTY, "avg").write.parquet(new["partials"])

    jobs = []
    if new["summary"]:
        jobs.append(lambda: write_summary(result.to_frame(spark), new["summary"]))
    if new["history"]:
        jobs.append(lambda: append_history(result.to_frame(spark).coalesce(1), new["history"]))
    if new["file_summary"]:
        jobs.append(write_files)
    with ExitStack() as stack:
        if new["dead_letters"] or new["partials"]:
            offsets = stack.enter_context(K.near_offsets(K.split_offsets(ledger)))
            jobs += [partial(write, offsets) for write, name in ((write_dead, "dead_letters"), (write_partials, "partials")) if new[name]]
        # small jobs that wait for one another's last tasks if they run one by one
        with ThreadPoolExecutor(max(len(jobs), 1)) as pool:
            for done in [pool.submit(job) for job in jobs]:
                done.result()
