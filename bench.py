"""Headline queries at one scale; prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) names the tables, BENCH_CPUS the
cores, BENCH_RUNS the timed runs of each query after one to warm up (median).
"""

from __future__ import annotations

import json
import os
import statistics
import time

from pyspark.sql import SparkSession, functions as F

from tallyline.operators.decode import decode_lines
from tallyline.plans import queries as Q
from tallyline.plans import tables as L
from tallyline.functions import render_line
from tallyline.plans.run import RunOptions, run_pipeline
from tallyline.plans.summary import summarise
from tallyline.session import shared_folder
from tallyline.sources.lines import read_lines, with_line_numbers

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "3"))
# Lines of the one long run, made of copies of the events.
LONG = int(os.environ.get("BENCH_LINES", "10000000"))

# Over the tables, which hold one file each.
TABLE_QUERIES = (
    "q_flagship", "q_lineitem_pipeline", "q_decode_dirty", "q_decode_documents", "q_filter_options",
    "q_summary", "q_merge_partials", "q_chunks", "q_process_chunks", "q_resequence",
    "q_difference", "q_render", "q_render_documents",
)


def session() -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("bench")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.driver.memory", "12g")
        # Local files are small; a cluster keeps the defaults of 4 and 128 MB.
        .config("spark.sql.files.openCostInBytes", str(256 * 1024))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def consume(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def run_long(spark: SparkSession) -> dict:
    """Read, decode and write ``LONG`` lines once; none may be lost or malformed."""
    log = L.log_events(spark, SF_DIR)
    copies = max(1, LONG // log.count())
    text = shared_folder(spark, "bench-long")
    copied = log.repartition(4 * int(CPUS)).withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(copies))))
    copied.select(render_line()).write.text(text)
    result = run_pipeline(spark, RunOptions(input=text, output=shared_folder(spark, "bench-out")))
    assert result.lines_read == result.records and result.malformed == 0, result
    return {"lines": result.lines_read, "s": round(result.duration_s, 2), "lines_per_s": round(result.lines_per_s)}


def main() -> None:
    spark = session()
    text = shared_folder(spark, "bench-lines")
    L.log_lineitem(spark, SF_DIR).select(render_line()).write.text(text)
    lines = read_lines(spark, text)
    options = {"level": "A,N", "min_value": 1000.0, "max_value": 60000.0, "value_scale": 0.5}

    def run(**more):
        return run_pipeline(
            spark, RunOptions(input=text, output=shared_folder(spark, "bench-out"), **options, **more)
        )

    work = {
        name: (lambda name=name: consume(Q.QUERIES[name](spark, SF_DIR))) for name in TABLE_QUERIES
    }
    work["text_scan"] = lambda: lines.count()
    work["text_line_numbers"] = lambda: consume(with_line_numbers(lines))
    work["text_summary"] = lambda: summarise(decode_lines(lines)).collect()
    work["text_run"] = lambda: run()
    work["text_run_reports"] = lambda: run(
        dead_letters=shared_folder(spark, "bench-dead"), partials=shared_folder(spark, "bench-partials")
    )
    work["text_run_gzip"] = lambda: run(gzip=True)
    work["text_run_fail_fast"] = lambda: run(policy="fail_fast")

    seconds = {}
    for name, job in work.items():
        times = []
        for _ in range(RUNS + 1):
            started = time.perf_counter()
            job()
            times.append(time.perf_counter() - started)
        seconds[name] = round(statistics.median(times[1:]), 3)

    count = lines.count()
    long_run = run_long(spark)
    print(json.dumps({
        "metric": "sum of median query times",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
        "lines": count,
        "run_lines_per_s": round(count / seconds["text_run"]),
        "long_run": long_run,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
