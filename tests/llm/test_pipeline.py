import public_tokenizers

import corpus_pipeline
from tallyline.llm.compression_quality import fit_quality, score_quality
from tallyline.llm.pieces import pieces
from tests.llm import brute

SF = "/root/testdata/sf0.01"


def test_equals_brute_force(spark):
    """The classifier's verdicts are taken as they are; every later stage is done over in plain Python."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    scored = score_quality(docs, fit_quality(docs, labels)).where("predicted = 1")
    texts = {r.doc_id: r.text for r in scored.collect()}
    cut = brute.dedup_lines(texts)
    texts = {i: x for i, x in cut.items() if x or not texts[i]}
    groups = brute.near_duplicates(texts)
    texts = {i: x for i, x in texts.items() if groups[i][2]}
    items = [r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    gone = brute.contaminated(texts, items)
    rows = corpus_pipeline.run(spark, SF).collect()
    assert {r.doc_id for r in rows} == set(texts) - gone and gone
    own = pieces(public_tokenizers.path("piece_bpe_32k.model"))
    import numpy as np

    for r in rows[::20]:
        assert r.round_trip and own.decode_ids(np.array(r.pieces, np.int64), np.array([len(r.pieces)])) == [texts[r.doc_id].replace("▁", " ")]


def test_clashing_columns_pass_unchanged(spark):
    docs, own = brute.clashing(spark.read.parquet("/root/testdata/sf0.001/documents.parquet"))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, "/root/testdata/sf0.001")
        assert out.columns == docs.columns, name
        rows = out.select("doc_id", *[f"`{n}`" for n in own]).collect()
        assert 0 < len(rows) and all(r[n] == f"{n} of {r.doc_id}" for r in rows for n in own), name
    assert corpus_pipeline.STAGES[-1][1](spark, docs, "/root/testdata/sf0.001").count() == docs.count()


def test_stages_keep_the_columns(spark, tmp_path):
    docs = brute.edge_docs(spark)
    folder = str(tmp_path)
    spark.createDataFrame([(4, 1), (7, 1), (8, 0), (9, 0)], "doc_id long, quality int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([(1, "no such passage in any of the texts at all")], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    for rows in (docs, brute.empty_docs(spark)):
        for name, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, rows, folder)
            assert out.columns == rows.columns, name
            assert out.count() <= rows.count()
        assert corpus_pipeline.STAGES[-1][1](spark, rows, folder).count() == rows.count()
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_classifier", "line_dedup", "near_dedup", "decontaminate", "sentencepiece"]
