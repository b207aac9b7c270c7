"""Runs against a plain search for every period, and what becomes of unusual rows."""

import hashlib
import random
import zlib

import duckdb
import numpy as np
import pytest

from tallyline.llm.blocks import words
from tallyline.llm.oracles import crc32
from tallyline.llm.periodic_runs import collapse_runs, looped, op13_periodic_runs, runs_of
from tests.check_oracles import compare, duck


def plain_runs(ws):
    out = []
    for q in range(1, len(ws) // 3 + 1):
        i = 0
        while i + q < len(ws):
            s = i
            while i + q < len(ws) and ws[i] == ws[i + q]:
                i += 1
            if i > s and i + q - s >= max(24, 3 * q) and not any(a <= s and i + q <= b for a, b, _ in out):
                out.append((s, i + q, q))
            i += i == s
    return sorted((s, e - s, q) for s, e, q in out)


def some_words(rng):
    n = rng.choice([0, 10, 24, 30, 60, 120, 200])
    letters = "abcdefghijklmnopqrst"[: rng.choice([1, 2, 2, 3, 5, 20])]
    ws = [rng.choice(letters) for _ in range(n)]
    if n and rng.random() < 0.6:
        for _ in range(rng.randint(1, 3)):
            a, p = rng.randrange(n), rng.randint(1, max(1, n // 4))
            for i in range(a, min(n, a + rng.randint(1, n))):
                ws[i] = ws[a + (i - a) % p]
    elif rng.random() < 0.3:
        f = ["a", "ab"]
        while len(f[-1]) < n:
            f.append(f[-1] + f[-2])
        ws = list(f[-1][:n])
    return ws


def test_runs_equal_a_plain_search():
    rng = random.Random(5)
    for _ in range(400):
        texts = [some_words(rng) for _ in range(rng.randint(1, 4))]
        parts = [" ".join(ws) for ws in texts]
        data = np.frombuffer("".join(parts).encode(), np.uint8)
        _, _, owner, hashes = words(data, np.r_[0, np.cumsum([len(p) for p in parts])])
        base = np.searchsorted(owner, np.arange(len(texts)))
        found = list(zip(*(x.tolist() for x in runs_of(hashes, owner))))
        for i, ws in enumerate(texts):
            assert [(s - base[i], n, q) for t, s, n, q in found if t == i] == plain_runs(ws)


@pytest.mark.parametrize("n", [24, 1000, 200_000])
def test_one_word_repeated_is_one_run(n):
    hashes = np.full(n, 7, np.uint64)
    assert [x.tolist() for x in runs_of(hashes, np.zeros(n, np.int64))] == [[0], [0], [n], [1]]


def test_long_periods():
    once = np.random.default_rng(1).integers(0, 1 << 60, 30_000).astype(np.uint64)
    hashes = np.r_[once[:100], np.tile(once, 4)[:100_000]]
    assert [x.tolist() for x in runs_of(hashes, np.zeros(len(hashes), np.int64))] == [[0], [100], [100_000], [30_000]]


def test_unusual_rows(spark):
    rows = [
        (1, None, 5, "x"), (2, "", 5, "x"), (3, " \n\t ", 5, "x"), (4, "ab " * 24, None, None), (4, "ab " * 24, None, None),
        (None, "a b c " * 9 + "d", 1, "y"), (6, "é é " * 30, 2, "z"),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_runs int, __row string")
    got = sorted(map(tuple, collapse_runs(docs).select("doc_id", "n_words", "n_runs", "start", "runs", "collapsed", "__row").collect()), key=str)
    assert got == sorted([
        (1, 0, 0, None, "", "", "x"), (2, 0, 0, None, "", "", "x"), (3, 0, 0, None, "", "", "x"),
        (4, 24, 1, 0, "0,24,1\n", "ab", None), (4, 24, 1, 0, "0,24,1\n", "ab", None),
        (None, 28, 1, 0, "0,27,3\n", "a b c d", "y"), (6, 30, 1, 0, "0,30,1\n", "é é", "z"),
    ], key=str)
    assert collapse_runs(docs.limit(0)).count() == 0


def test_tails_are_repeated_by_the_rule(spark):
    texts = {i: " ".join(f"w{i}_{j}" for j in range(i % 60)) for i in range(300)}
    docs = spark.createDataFrame([*texts.items(), (None, "a b c")], "doc_id long, text string")
    for i, text in looped(docs).collect():
        h = 1 if i is None else zlib.crc32(str(i).encode())
        ws = (texts.get(i, "a b c")).split()
        if h % 10 == 0 and ws:
            g, n = h // 10, len(ws)
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            ws = [ws[a + (j - a) % p] if j >= a else ws[j] for j in range(n)]
        assert text.split() == ws


def test_crc32_in_sql():
    for value in (0, 7, 123456789, -5):
        assert duckdb.sql(f"SELECT {crc32(repr(str(value)))}").fetchall()[0][0] == zlib.crc32(str(value).encode())


def test_query_equals_sql(spark):
    sf = "/root/testdata/sf0.001"
    assert compare(spark, duck(sf), sf, "op13_periodic_runs") is None
    one = op13_periodic_runs(spark, sf).where("n_runs = 0").select("runs_sha256").distinct().collect()
    assert [r[0] for r in one] == [hashlib.sha256(b"").hexdigest()]
