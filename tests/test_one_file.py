"""Inputs of one file, and of one partition, at size: no task sorts all lines, or is sent more than the rows given."""

import re
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tallyline.plans.queries import QUERIES
from tallyline.sinks.lines import write_one_file

SMALL = "/root/testdata/sf0.001"


@pytest.fixture
def many_parts(spark):
    settings = {
        "spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.files.maxPartitionBytes": "1000",
        "spark.sql.files.openCostInBytes": "1",
    }
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def test_one_file_in_order_from_many_parts(spark, many_parts, tmp_path):
    numbers = [i * 7919 % 5003 for i in range(5000)]
    lines = spark.createDataFrame([(n, f"line {n}") for n in numbers], "n long, line string").repartition(7)
    for name, rows in (("all", numbers), ("none", [])):
        path = tmp_path / "a b" / name
        write_one_file(lines if rows else lines.limit(0), str(path), order_by=("n",))
        files = list(Path(path).glob("part-*"))
        assert len(files) == 1 or not rows
        assert [x for f in files for x in f.read_text().splitlines()] == [f"line {n}" for n in sorted(rows)]


@pytest.mark.parametrize("name, marks", [("q_byte_order_mark", 2), ("q_first_malformed", 0)])
def test_no_task_sorts_the_whole_input(spark, monkeypatch, name, marks):
    def one_range(self, n, *columns):
        raise AssertionError("all lines in one partition")

    monkeypatch.setattr(type(spark.range(1)), "repartitionByRange", one_range)
    rows = QUERIES[name](spark, SMALL)
    if marks:
        assert rows.where(~F.col("line").startswith("\ufeff")).count() == marks
    else:
        assert rows.count() == 4


def test_exact_sums_deal_rows_before_they_become_seven(spark):
    plan = QUERIES["q_exact_sums"](spark, SMALL)._jdf.queryExecution().optimizedPlan().toString()
    assert [int(n) for n in re.findall(r"Repartition (\d+), true", plan)] == [1, 8, 64]
    assert not re.search(r"Repartition \d+, true(?:(?!Relation).)*Generate", plan, re.S)
