import random

from tallyline.llm.line_chunks import dedup_lines, op10_line_chunks
from tests.llm import brute


def result(df):
    return {r.doc_id: r.text for r in df.collect()}


def test_equals_brute_force(spark):
    for sf_dir in (brute.SMALL, "/root/testdata/sf0.01"):
        texts = brute.texts_of(spark, sf_dir)
        rows = op10_line_chunks(spark, sf_dir).collect()
        want = brute.dedup_lines(texts)
        assert {r.doc_id: r.text for r in rows} == want
        assert all(r.removed_bytes == len((texts[r.doc_id] or "").encode()) - len(want[r.doc_id].encode()) for r in rows)
        assert any(r.removed_bytes for r in rows)


def lines(seed, n, words):
    return [" ".join(f"w{seed}x{i}y{j}" for j in range(words)) for i in range(n)]


def test_passages_are_found_wherever_they_stand(spark):
    """A long paragraph, and passages of eight short lines, each in ten documents of other lines."""
    paragraph = " ".join(f"p{j}" for j in range(55))
    short = ["\n".join(lines(f"s{k}", 8, 8)) for k in range(20)]
    texts = {}
    for i in range(200):
        own = lines(i, 6, 10)
        passage = paragraph if i % 20 == 0 else short[i % 20]
        texts[i] = "\n".join([*own[: i % 5], passage, *own[i % 5 :]])
    got = result(dedup_lines(spark.createDataFrame(list(texts.items()), "doc_id long, text string")))
    assert got == brute.dedup_lines(texts)
    assert sum(paragraph in x for x in got.values()) == 1 and paragraph in got[0]
    assert sum(any(s in x for s in short) for x in got.values()) <= 21  # the first of each, and hardly more
    assert all(line in got[i] for i in texts for line in lines(i, 6, 10))  # what is a document's own stays


def test_equal_hashes_are_not_enough(spark, monkeypatch):
    from tallyline.llm import line_chunks

    whole = line_chunks.chunks_of

    def colliding(data, at):
        hashes, owner, starts, ends = whole(data, at)
        return hashes * 0 + 1, owner, starts, ends

    monkeypatch.setattr(line_chunks, "chunks_of", colliding)
    a, b = " ".join(f"a{i}" for i in range(30)), " ".join(f"b{i}" for i in range(30))
    got = result(dedup_lines(spark.createDataFrame([(1, a), (2, b), (3, a)], "doc_id long, text string")))
    assert got[1] == a and got[2] == b


def test_edges(spark):
    extra = [(11, "a b c d e f\ng h i j k l\n"), (12, "a b c d e f\ng h i j k l\n"), (13, "\n\n\n"), (14, "\n\n\n")]
    docs = brute.edge_docs(spark, extra)
    cleaned = dedup_lines(docs.withColumnRenamed("block", "removed_bytes"))
    assert cleaned.columns == [c for c in docs.columns if c != "block"] + ["removed_bytes"]
    rows = cleaned.collect()
    got = {r.doc_id: r.text for r in rows if r.doc_id is not None}
    assert len(rows) == 17 and got[1] is None and got[2] == "" and got[3] == " \n\t\n" and got[13] == "\n\n\n"
    assert got[11] == extra[0][1] and got[12] == ""
    assert sum(r.doc_id == 6 and r.removed_bytes == 0 for r in rows) == 2
    assert got[7] is not None and got[8].endswith("more")
    assert dedup_lines(brute.empty_docs(spark)).count() == 0


def test_short_wrapped_passages_are_found(spark):
    """Passages of 51 words and more on 3, 4 and 5 lines, each in two documents among other lines."""
    rnd, texts, passages = random.Random(3), {}, {}
    for k in range(600):
        n = 3 + k % 3
        passages[k] = "\n".join(lines(f"p{k}", n, 17 if n == 3 else 13 if n == 4 else 11))
        for i in (k, 1000 + k):
            before, after = lines(f"b{i}", 1 + rnd.randrange(4), 9), lines(f"a{i}", 1 + rnd.randrange(4), 9)
            texts[i] = "\n".join([*before, passages[k], *after])
    got = result(dedup_lines(spark.createDataFrame(list(texts.items()), "doc_id long, text string")))
    missed = [sum(passages[k] in got[1000 + k] for k in passages if k % 3 == j) / 200 for j in range(3)]
    print("missed on 3, 4, 5 lines:", missed)
    assert all(got[k] == texts[k] for k in passages)
    assert missed[0] <= 0.1 and missed[1] <= 0.02 and missed[2] <= 0.01


def test_other_columns_stay(spark):
    docs, own = brute.clashing(spark.read.parquet("/root/testdata/sf0.001/documents.parquet"))
    rows = dedup_lines(docs).collect()
    assert all(r[n] == f"{n} of {r.doc_id}" for r in rows for n in own if n != "removed_bytes")
    plain = result(dedup_lines(docs.select("doc_id", "text")))
    assert {r.doc_id: r.text for r in rows} == plain


def test_a_text_of_many_cuts_is_rewritten_in_linear_time(spark):
    """200,000 lines, every second chunk of them a copy; 10 MB in seconds."""
    import time

    copied = [" ".join(f"c{i}w{j}" for j in range(25)) for i in range(300)]
    text = "\n".join(x for i in range(60_000) for x in (copied[i % 300], f"own line {i} " + "x " * 12))
    docs = spark.createDataFrame([(1, "\n".join(copied)), (2, text)], "doc_id long, text string")
    started = time.monotonic()
    got = result(dedup_lines(docs))
    assert time.monotonic() - started < 60 and len(text) > 10_000_000
    assert got[2].split("\n") == [f"own line {i} " + "x " * 12 for i in range(60_000)]


def test_hot_hashes_are_split(spark, monkeypatch):
    from tallyline.llm import line_chunks, tables

    monkeypatch.setattr(tables, "HOT_ROWS", 2)
    monkeypatch.setattr(tables, "HOT_KEYS", 1 << 30)
    monkeypatch.setattr(line_chunks, "HOT_ROWS", 2)
    texts = brute.texts_of(spark, "/root/testdata/sf0.01")
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    assert result(dedup_lines(docs)) == brute.dedup_lines(texts)
