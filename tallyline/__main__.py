"""``spark-submit`` entry: ``python -m tallyline --input IN --output OUT [options]``."""

from __future__ import annotations

import argparse
from collections.abc import Sequence
from dataclasses import asdict

from pyspark.sql import SparkSession

from tallyline.operators.policy import FAIL_FAST, SKIP
from tallyline.plans.run import FORMATS, RunOptions, RunResult, run_pipeline


def options(arguments: Sequence[str] | None = None) -> RunOptions:
    parser = argparse.ArgumentParser(prog="tallyline", description=__doc__)
    parser.add_argument("-i", "--input", required=True, help="text file or folder")
    parser.add_argument("-o", "--output", required=True, help="folder for the output lines")
    parser.add_argument("--gzip", action="store_true")
    parser.add_argument("--fail-fast", action="store_true", help="stop at the first malformed line")
    parser.add_argument("--level", help="accepted levels, with commas between")
    parser.add_argument("--source", help="accepted sources, with commas between")
    parser.add_argument("--min-value", type=float)
    parser.add_argument("--max-value", type=float)
    parser.add_argument("--value-scale", type=float)
    parser.add_argument("--chunk-size", type=int, default=2000, help="lines per batch of --partials")
    parser.add_argument("--exact", action="store_true", help="sums to the last bit, in any order")
    parser.add_argument("--per-file", action="store_true", help="an output folder per input file")
    parser.add_argument("--input-format", choices=FORMATS, default="text")
    for report in ("dead-letters", "summary", "history", "partials", "file-summary"):
        parser.add_argument(f"--{report}", metavar="PATH")
    given = vars(parser.parse_args(arguments))
    return RunOptions(policy=FAIL_FAST if given.pop("fail_fast") else SKIP, **given)


def main(arguments: Sequence[str] | None = None) -> RunResult:
    chosen = options(arguments)
    spark = SparkSession.builder.appName("tallyline").getOrCreate()
    result = run_pipeline(spark, chosen)
    for name, value in asdict(result).items():
        print(f"{name}: {value}")
    return result


if __name__ == "__main__":
    main()
