"""Log tables made from the given tables, for queries, tests and timings.

``log_*`` are records of the five columns; ``log_lines`` and ``dirty_lines`` are
text lines, numbered from 1 by the event id, which has no gaps.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tallyline import schema as S
from tallyline.functions.render import render_line
from tallyline.functions.text import quote_field

_STAMP = "yyyy-MM-dd'T'HH:mm:ss'Z'"


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def log_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "events").select(
        (F.col("event_id") + 1).alias("line_no"),
        F.date_format("ts", _STAMP).alias("timestamp"),
        F.col("event_type").alias("level"),
        F.concat(F.lit("svc-"), (F.col("user_id") % 4).cast("string")).alias("source"),
        F.col("props").alias("message"),
        "value",
    )


def log_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Values of both signs."""
    return load(spark, sf_dir, "customer").select(
        (F.col("c_custkey") + 1).alias("line_no"),
        F.lit("2024-01-01T00:00:00Z").alias("timestamp"),
        F.col("c_mktsegment").alias("level"),
        F.concat(F.lit("nation-"), F.col("c_nationkey").cast("string")).alias("source"),
        F.col("c_name").alias("message"),
        F.col("c_acctbal").alias("value"),
    )


def log_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The large one; no quotes in its lines."""
    return load(spark, sf_dir, "lineitem").select(
        F.date_format("l_shipdate", _STAMP).alias("timestamp"),
        F.col("l_returnflag").alias("level"),
        F.col("l_linestatus").alias("source"),
        F.concat_ws(
            " ", F.lit("order"), F.col("l_orderkey").cast("string"),
            F.lit("line"), F.col("l_linenumber").cast("string"),
        ).alias("message"),
        F.col("l_extendedprice").alias("value"),
    )


def log_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Long messages with commas and quotes; line breaks become blanks."""
    return load(spark, sf_dir, "documents").select(
        (F.col("doc_id") + 1).alias("line_no"),
        F.lit("2024-01-01T00:00:00Z").alias("timestamp"),
        F.col("lang").alias("level"),
        "source",
        F.translate("text", "\r\n", "  ").alias("message"),
        F.col("n_chars").cast("double").alias("value"),
    )


def to_lines(log: DataFrame) -> DataFrame:
    """``line_no, line``, rendered as the engine writes them."""
    return log.select("line_no", render_line().alias("line"))


def log_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return to_lines(log_events(spark, sf_dir))


def dirty_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``log_lines`` with thirteen kinds of damage, by event id modulo 50."""
    log = log_events(spark, sf_dir).withColumn("m", (F.col("line_no") - 1) % 50)
    value = F.col("value").cast("string")
    texts = {name: quote_field(F.col(name)) for name in S.TEXT_COLUMNS}

    def line(last, pad="", **other):
        fields = [*{**texts, **other}.values(), last]
        return F.concat_ws(",", *[F.concat(F.lit(pad), f, F.lit(pad)) for f in fields])

    message = F.replace("message", F.lit('"'), F.lit('""'))
    kinds = [
        F.lit(""),
        F.concat_ws(",", *texts.values()),
        F.concat(line(value), F.lit(",extra")),
        line(F.lit("abc")),
        line(F.lit("NaN")),
        line(value, message=F.concat(F.lit('"'), message)),
        line(value, pad=" "),
        line(value, source=F.concat(F.lit("="), F.col("source"))),
        F.lit("   "),
        line(F.lit("nan")),
        line(value, message=F.concat(F.lit('"'), message, F.lit('"x'))),
        line(value, timestamp=F.lit("")),
        line(F.concat(value, F.lit("d"))),
    ]
    damaged = F.when(F.col("m") == 0, kinds[0])
    for m, kind in enumerate(kinds[1:], start=1):
        damaged = damaged.when(F.col("m") == m, kind)
    return log.select("line_no", damaged.otherwise(line(value)).alias("line"))
