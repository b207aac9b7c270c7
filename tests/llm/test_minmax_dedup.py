import numpy as np

from tallyline.llm.components import connected_components
from tallyline.llm.minmax_dedup import BANDS, band_keys, intersections, min_max, near_duplicates, op2_minmax_dedup
from tests.llm import brute


def result(df):
    return {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in df.collect()}


def test_equals_brute_force(spark):
    for sf_dir in (brute.SMALL, "/root/testdata/sf0.01"):
        assert result(op2_minmax_dedup(spark, sf_dir)) == brute.near_duplicates(brute.texts_of(spark, sf_dir))


def test_chains_stars_and_large_groups(spark):
    """More near copies than a block holds, of which many are alike only by way of others."""
    rng = np.random.default_rng(3)
    base = [f"w{i}" for i in range(150)]
    texts = {0: " ".join(base)}
    for i in range(1, 700):
        own = list(base)
        for k in rng.choice(150, rng.integers(0, 4), replace=False):
            own[k] = f"v{rng.integers(0, 10**6)}"
        texts[i] = " ".join(own)
    for i in range(700, 720):  # a chain: each differs a little more
        base = [*base[2:], f"c{i}", f"d{i}"]
        texts[i] = " ".join(base)
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    assert result(near_duplicates(docs)) == brute.near_duplicates(texts)


def test_edges(spark):
    rows = near_duplicates(brute.edge_docs(spark)).collect()
    assert len(rows) == 13
    by_id = {r.doc_id: r for r in rows if r.doc_id is not None}
    assert [by_id[i].n_shingles for i in (1, 2, 3, 4, 9)] == [0, 0, 0, 1, 1]
    assert [by_id[i].component_id for i in (1, 2, 3, 4, 5, 6, 7, 8)] == [1, 2, 3, 4, 4, 6, 7, 7]
    assert [(r.component_id, r.kept) for r in rows if r.doc_id is None] == [(None, True)] * 2
    assert near_duplicates(brute.empty_docs(spark)).count() == 0


def test_signatures_estimate_similarity():
    rng = np.random.default_rng(5)
    agree = []
    for _ in range(40):
        a = rng.integers(0, 1 << 63, 400).astype(np.uint64)
        b = np.r_[a[:300], rng.integers(0, 1 << 63, 50).astype(np.uint64)]
        values = min_max(np.r_[a, b], np.array([0, 400]))
        agree.append((values[0] == values[1]).mean())
        assert band_keys(values).shape == (2, BANDS)
    assert abs(np.mean(agree) - 300 / 450) < 0.02


def test_intersections_by_products():
    rng = np.random.default_rng(6)
    sets = [np.unique(rng.integers(0, 300, n)).astype(np.uint64) for n in (5, 80, 200, 1, 120)]
    want = [[len(np.intersect1d(a, b)) for b in sets] for a in sets]
    assert intersections(sets).tolist() == want
    assert intersections(sets[:2]).tolist() == [row[:2] for row in want[:2]]


def test_components(spark):
    edges = [(1, 2), (2, 3), (3, 4), (9, 8), (8, 7), (5, 5), (4, 10), (10, 11), (11, 12), (20, 12)]
    df = spark.createDataFrame(edges, "a long, b long")
    got = {r.node: r.component for r in connected_components(df).collect()}
    assert got == {1: 1, 2: 1, 3: 1, 4: 1, 10: 1, 11: 1, 12: 1, 20: 1, 7: 7, 8: 7, 9: 7}
    assert connected_components(df.where("a > 100")).count() == 0
