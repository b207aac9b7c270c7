"""The training-data pipeline over ``documents``: five stages, each on all that the one before it kept.

Rows without an id pass the stages that remove by id. Extra columns pass through all stages but the last.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyline.llm.compression_quality import fit_quality, score_quality
from tallyline.llm.decontaminate import without_benchmark
from tallyline.llm.line_chunks import dedup_lines
from tallyline.llm.minmax_dedup import near_duplicates
from tallyline.llm.pieces import encode_pieces
from tallyline.llm.tables import aliased, near, restored, table
from tallyline.session import saved

MODEL = public_tokenizers.path("piece_bpe_32k.model")


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the compression classifier takes for good text."""
    model = fit_quality(docs, table(spark, sf_dir, "labels"))
    plain, names = aliased(docs)
    scored = score_quality(plain, model, names[docs.columns.index("text")]).where("predicted = 1")
    return restored(scored, names, docs.columns)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages that an earlier document has; a document with nothing left goes."""
    plain, names = aliased(docs)
    id_, text = (names[docs.columns.index(c)] for c in ("doc_id", "text"))
    cleaned = dedup_lines(plain, id_, text).where(f"removed_bytes = 0 or octet_length({text}) > 0")
    if "n_chars" in docs.columns:
        chars = names[docs.columns.index("n_chars")]
        now = F.when(F.col("removed_bytes") > 0, F.length(text)).otherwise(F.col(chars))
        cleaned = cleaned.withColumn(chars, now.cast(docs.schema["n_chars"].dataType))
    return restored(cleaned, names, docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: the one with the smallest id."""
    gone = saved(near_duplicates(docs).where("not kept").select(F.col("doc_id").alias("gone")).distinct(), "gone")
    plain, names = aliased(docs)
    stays = plain.join(near(gone), F.col(names[docs.columns.index("doc_id")]) == F.col("gone"), "left_anti")
    return restored(stays, names, docs.columns)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no passage of the benchmark."""
    return without_benchmark(docs, table(spark, sf_dir, "benchmark"))


def sentencepiece(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of each text, and whether they give the text again."""
    return encode_pieces(docs.select("doc_id", "text"), MODEL, check=True, drop_text=True)


STAGES = [
    ("quality_classifier", quality_classifier),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("decontaminate", decontaminate),
    ("sentencepiece", sentencepiece),
]
#: Compression, content-defined chunks, alignment and segmentation have no SQL; the tests hold the rows against a
#: brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = saved(stage(spark, docs, sf_dir), name)
    return docs
