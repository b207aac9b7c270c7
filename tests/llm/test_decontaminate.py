import random

from tallyline.llm.decontaminate import Items, alignment, benchmark_hits, op6_decontaminate, without_benchmark
from tests.llm import brute


def items_of(spark, sf_dir=brute.SMALL):
    return {r.item_id: r.text for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()}


def test_finds_every_whole_item(spark):
    for sf_dir in (brute.SMALL, "/root/testdata/sf0.01"):
        texts, items = brute.texts_of(spark, sf_dir), items_of(spark, sf_dir)
        rows = op6_decontaminate(spark, sf_dir).collect()
        want = brute.contaminated(texts, items.values())
        assert want and want <= {r.doc_id for r in rows}
        for r in rows:  # whatever else is found holds most of an item's window
            raw = texts[r.doc_id].encode()[r.doc_start : r.doc_end]
            assert r.edits <= 9 and r.item_end - r.item_start >= 32
            assert len(raw) >= 0.8 * (r.item_end - r.item_start) - 20
        assert {r.doc_id for r in rows} - want == set()


def edited(text, share, rnd):
    out = list(text)
    for _ in range(int(len(text) * share)):
        k, what = rnd.randrange(len(out)), rnd.random()
        if what < 0.34:
            out[k] = "z"
        elif what < 0.67:
            out.insert(k, "q")
        else:
            del out[k]
    return "".join(out)


def test_finds_edited_items_and_leaves_clean_texts(spark):
    rnd, items = random.Random(5), items_of(spark)
    texts = brute.texts_of(spark)
    dirty = brute.contaminated(texts, items.values())
    clean = [x for i, x in texts.items() if i not in dirty and len(x) > 300]
    rows = []
    for k, item in items.items():
        rows.append((k, f"{rnd.choice(clean)[:200]} {edited(item, 0.05, rnd)} {rnd.choice(clean)[-200:]}"))
        rows.append((k + 1000, item.upper().replace(" ", " \n,")))
        rows.append((k + 2000, rnd.choice(clean)))
        rows.append((k + 3000, edited(item, 0.5, rnd)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    bench = spark.createDataFrame(list(items.items()), "item_id long, text string")
    hits = {(r.doc_id, r.item_id) for r in benchmark_hits(docs, bench).collect()}
    found = {i for i, _ in hits}
    assert {(k, k) for k in items} <= hits and {(k + 1000, k) for k in items} <= hits
    assert not [i for i in found if i >= 2000]
    assert {r.doc_id for r in without_benchmark(docs, bench).collect()} == {i for i, _ in rows} - found
    in_blocks = benchmark_hits(docs, bench, block_bytes=2000)
    assert {(r.doc_id, r.item_id) for r in in_blocks.collect()} == hits


def test_repetitive_and_long_texts(spark):
    item = "the end of the end of the end of the tale was told by the end of the day and night"
    long = "the end of " * 60_000
    docs = spark.createDataFrame([(1, long), (2, long + item), (3, item * 3)], "doc_id long, text string")
    bench = spark.createDataFrame([(7, item), (8, None), (9, "short one"), (10, "")], "item_id long, text string")
    assert {r.doc_id for r in benchmark_hits(docs, bench).collect()} == {2, 3}


def test_alignment():
    import numpy as np

    def edits(a, b):
        return alignment(np.frombuffer(a, np.uint8), np.frombuffer(b, np.uint8))

    assert edits(b"abcdef", b"xxabcdefyy") == 0
    assert edits(b"abcdef", b"xxabXdefyy") == 1 and edits(b"abcdef", b"abdef") == 1 and edits(b"abcdef", b"abcXdef") == 1
    assert edits(b"abc", b"") == 3


def test_edges(spark):
    bench = spark.createDataFrame([(1, "the same row twice, and nothing else in it but this")], "item_id long, text string")
    docs = brute.edge_docs(spark)
    assert sorted(r.doc_id for r in benchmark_hits(docs, bench).collect()) == [6, 6]
    kept = without_benchmark(docs, bench)
    assert kept.columns == docs.columns and kept.count() == 11
    assert benchmark_hits(docs, bench.where("item_id > 5")).count() == 0
    assert benchmark_hits(brute.empty_docs(spark), bench).count() == 0
    assert Items([], []).window_start.size == 0


def test_finds_every_passage(spark):
    """71 normalised bytes of a longer item, from every offset."""
    rnd = random.Random(8)
    word = lambda: "".join(rnd.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rnd.randrange(2, 9)))
    items = {i: " ".join(word() for _ in range(20 + 12 * i)) for i in range(4)}
    rows, want = [], set()
    for i, item in items.items():
        for k in range(len(item) - 71 + 1):
            rows.append((1000 * i + k, " ".join(word() for _ in range(9)) + " " + item[k : k + 71] + " " + " ".join(word() for _ in range(9))))
            want.add((1000 * i + k, i))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    bench = spark.createDataFrame(list(items.items()), "item_id long, text string")
    assert {(r.doc_id, r.item_id) for r in benchmark_hits(docs, bench).collect()} == want


def test_every_occurrence_is_a_region(spark):
    item = "a short passage about four grey geese"
    text = f"{item}, well above it; {item}, quite below it; {item}"
    docs = spark.createDataFrame([(1, text), (2, "q" * 150 + " " + text)], "doc_id long, text string")
    bench = spark.createDataFrame([(7, item)], "item_id long, text string")
    rows = benchmark_hits(docs, bench).collect()
    texts = {1: text, 2: "q" * 150 + " " + text}
    assert sorted((r.doc_id, texts[r.doc_id][r.doc_start : r.doc_end]) for r in rows) == [(i, item) for i in (1, 1, 1, 2, 2, 2)]
