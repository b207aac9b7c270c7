from pyspark.sql import functions as F

from tallyline.llm.compression_quality import fit_quality, op3_compression_quality, score_quality
from tests.llm.brute import edge_docs, empty_docs

SF = "/root/testdata/sf0.1"


def test_held_out_accuracy(spark):
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    rows = [r for r in op3_compression_quality(spark, SF).collect() if r.held_out and r.doc_id in labels]
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in rows)
    good = [r.predicted for r in rows if labels[r.doc_id] == 1]
    bad = [r.predicted for r in rows if labels[r.doc_id] == 0]
    assert sum(good) / len(good) > 0.985 and sum(bad) / len(bad) < 0.05


def test_labels_of_held_out_rows_do_not_count(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2
    turned = labels.withColumn("quality", F.when(held, 1 - F.col("quality")).otherwise(F.col("quality")))
    assert fit_quality(docs, labels) == fit_quality(docs, turned)


def test_edges(spark):
    docs = edge_docs(spark)
    labels = spark.createDataFrame([(4, 1), (7, 1), (8, 0), (9, 0), (9, 1), (None, 1), (5, None)], "doc_id long, quality int")
    rows = score_quality(docs, fit_quality(docs, labels)).collect()
    assert len(rows) == 13 and all(0 <= r.score <= 1 for r in rows)
    assert len({r.score for r in rows if not r.text}) == 1
    nothing = fit_quality(docs, labels.where("quality = 1"))
    assert nothing is None
    assert {r.score for r in score_quality(docs, nothing).collect()} == {0.5}
    assert score_quality(empty_docs(spark), fit_quality(docs, labels)).count() == 0
    assert fit_quality(empty_docs(spark), labels) is None
