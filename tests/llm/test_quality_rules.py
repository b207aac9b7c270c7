import zlib

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from tallyline.llm.quality_rules import apply_rules, fit_rules, op9_quality_rules, rule_counts
from tests.llm import brute

NAMES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
TEXT = st.lists(st.sampled_from(["a", "b", "é#", " ", " ", "\n", "x y z v w ", "|", "\t", "one line\n"]), max_size=40).map("".join)


@given(st.lists(TEXT, min_size=1, max_size=5))
@settings(max_examples=200, deadline=None)
def test_counts(texts):
    raw = [t.encode() for t in texts]
    data = np.frombuffer(b"".join(raw), np.uint8)
    counts, _ = rule_counts(data, np.cumsum([0, *map(len, raw)]))
    assert list(zip(*(c.tolist() for c in counts))) == [brute.rule_counts(t)[:5] for t in texts]


def test_documents_and_held_out_accuracy(spark):
    sf_dir = "/root/testdata/sf0.1"
    texts = brute.texts_of(spark, sf_dir)
    rows = op9_quality_rules(spark, sf_dir).collect()
    for r in rows[::7]:
        assert tuple(r[n] for n in NAMES) == brute.rule_counts(texts[r.doc_id])
        assert not (r.base_failed and r.kept)
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    held = [r for r in rows if r.doc_id in labels and zlib.crc32(str(r.doc_id).encode()) % 4 == 2 and not r.base_failed]
    good = [r.kept for r in held if labels[r.doc_id] == 1]
    bad = [r.kept for r in held if labels[r.doc_id] == 0]
    assert sum(good) / len(good) > 0.98 and sum(bad) / len(bad) < 0.06


def test_edges(spark):
    docs = brute.edge_docs(spark)
    labels = spark.createDataFrame([(4, 1), (7, 1), (8, 0), (9, 0)], "doc_id long, quality int")
    rows = apply_rules(docs, fit_rules(docs, labels)).collect()
    assert [tuple(r[n] for n in NAMES) for r in rows] == [brute.rule_counts(r.text) for r in rows]
    assert all(0 <= r.quality <= 1 for r in rows) and not any(r.kept for r in rows if not r.text)
    assert fit_rules(docs, labels.where("quality = 0")) is None
    assert {r.kept for r in apply_rules(docs, None).collect() if not r.base_failed} == {True}
    assert apply_rules(brute.empty_docs(spark), None).count() == 0


def test_a_repeated_id_gives_one_sample_row(spark):
    from pyspark.sql import functions as F

    from tallyline.llm import labelled

    texts = spark.range(5000).select(F.lit(4).cast("long").alias("doc_id"), F.concat(F.lit("text "), F.col("id").cast("string")).alias("text"))
    docs = texts.unionByName(brute.edge_docs(spark).select("doc_id", "text").where("doc_id <> 4"))
    labels = spark.createDataFrame([(4, 1), (7, 1), (8, 0), (9, 0)], "doc_id long, quality int")
    rows = labelled.labelled_sample(docs, labels, 10).collect()
    assert len({r.id for r in rows}) == len(rows) <= 4 and 4 in {r.id for r in rows}
    again = labelled.labelled_sample(docs.repartition(7), labels, 10).collect()
    assert sorted(map(tuple, rows), key=str) == sorted(map(tuple, again), key=str)


def test_the_sample_is_bounded_by_its_numbers(spark, monkeypatch):
    from tallyline.llm import quality_rules

    docs = spark.read.parquet(f"{brute.SMALL}/documents.parquet")
    labels = spark.read.parquet(f"{brute.SMALL}/labels.parquet")
    whole = fit_rules(docs, labels)
    monkeypatch.setattr(quality_rules, "SAMPLE_ENTRIES", 20_000)
    part = fit_rules(docs, labels)
    assert np.count_nonzero(np.abs(part[0]) > 1e-6) < np.count_nonzero(np.abs(whole[0]) > 1e-6)
