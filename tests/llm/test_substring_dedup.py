"""Repeated stretches against a plain look-up of every window."""

import random
import re

import pytest

from tallyline.llm import substring_dedup as D
from tallyline.llm import tables
from tests.check_oracles import compare, duck

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain(rows, k=50):
    first = {}
    for i, text in rows:
        w = WORD.findall(text or "")
        for a in range(len(w) - k + 1):
            if i is not None:
                key = tuple(w[a : a + k])
                first[key] = min(first.get(key, i), i)
    out = []
    for i, text in rows:
        w = WORD.findall(text or "")
        gone = set()
        for a in range(len(w) - k + 1):
            if i is not None and first[tuple(w[a : a + k])] < i:
                gone.update(range(a, a + k))
        out.append((i, len(w), len(gone), " ".join(x for j, x in enumerate(w) if j not in gone)))
    return sorted(out, key=str)


def some_rows(rng, words):
    vocabulary = [f"w{i}é" if i % 7 == 0 else f"w{i}" for i in range(words)]
    passages = [[rng.choice(vocabulary) for _ in range(rng.choice([49, 50, 51, 60, 75, 120, 300]))] for _ in range(12)]
    rows = []
    for i in range(250):
        ws = []
        for _ in range(rng.randint(0, 4)):
            passage, mode = rng.choice(passages), rng.random()
            a = rng.randrange(len(passage)) if mode > 0.4 else 0
            ws += passage[a : a + rng.randint(40, 80)] if mode < 0.7 else [rng.choice(vocabulary) for _ in range(rng.randint(0, 90))]
        if ws and rng.random() < 0.2:
            ws[rng.randrange(len(ws))] = "edit"
        text = " ".join(ws).replace(" ", "\n", rng.randint(0, 3)) + "  "
        rows.append((None if rng.random() < 0.02 else rng.choice([i, i, i // 3]), None if rng.random() < 0.03 else text))
    return rows + rows[:30] + [(1000 + i, " ".join(passages[0] * 3)) for i in range(150)]


@pytest.mark.parametrize("seed, words, hot", [(0, 30, False), (1, 3000, False), (2, 3000, True)])
def test_equals_a_plain_look_up(spark, monkeypatch, seed, words, hot):
    if hot:  # nearly every key takes the way of the hot ones
        monkeypatch.setattr(tables, "HOT_ROWS", 3)
        monkeypatch.setattr(tables, "HOT_KEYS", 1 << 30)
    rows = some_rows(random.Random(seed), words)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert sorted(map(tuple, D.dedup_substrings(docs).drop("text").collect()), key=str) == plain(rows)


@pytest.mark.parametrize("hot", [False, True])
def test_live_keys_of_any_number(spark, monkeypatch, hot):
    met, rows = [], some_rows(random.Random(4), 3000)
    monkeypatch.setattr(D, "meet", lambda rows, found, keys: met.append(keys) or tables.meet(rows, found, keys))
    if hot:
        monkeypatch.setattr(tables, "HOT_ROWS", 3)
        monkeypatch.setattr(tables, "HOT_KEYS", 1 << 30)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    for few in (True, False):
        monkeypatch.setattr(D, "BROADCAST_ROWS", 1 << 20 if few else 0)
        met.clear()
        assert sorted(map(tuple, D.dedup_substrings(docs).drop("text").collect()), key=str) == plain(rows)
        assert (["key"] in met) == (not few)  # if few, rows of keys do not travel to them


def test_other_windows_and_text_ids(spark):
    rows = [(f"d{i}", " ".join(f"w{j}" for j in range(i, i + 20))) for i in range(30)]
    for window in (9, 14):
        got = D.dedup_substrings(spark.createDataFrame(rows, "doc_id string, text string"), window=window).drop("text").collect()
        assert sorted(map(tuple, got), key=str) == plain(rows, window)


def test_clashing_columns_and_empty_tables(spark):
    text = " ".join(f"w{j}" for j in range(60))
    schema = "id int, doc_id long, whole string, text string, mark int, starts int, `a.b` int, __row int, KEPT string"
    docs = spark.createDataFrame([(9, 1, "a", text, 1, 2, 3, 4, "k"), (8, 2, "b", text + " x", 5, 6, 7, 8, "k")], schema)
    got = D.dedup_substrings(docs)
    assert got.columns == [*docs.columns[:-1], "n_words", "n_removed", "kept"]
    assert sorted(map(tuple, got.collect())) == [
        (8, 2, "b", text + " x", 5, 6, 7, 8, 61, 60, "x"), (9, 1, "a", text, 1, 2, 3, 4, 60, 0, text),
    ]
    assert D.dedup_substrings(docs.limit(0)).count() == 0


def test_query_equals_sql(spark):
    sf = "/root/testdata/sf0.001"
    assert compare(spark, duck(sf), sf, "op12_substring_dedup") is None
