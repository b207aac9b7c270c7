"""The manifest against a plain tree over lists, and its verification."""

import hashlib
import random
import zlib

import pytest

from pyspark.sql import functions as F
from tallyline.llm.merkle_manifest import build_manifest, folded, leaf_digest, op11_merkle_manifest
from tests.check_oracles import compare, duck

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(row):
    return sha("".join("-" if x is None else f"{len(str(x).encode())}:{x}" for x in row))


def tree(digests):
    levels = [digests]
    while len(levels[-1]) > 1:
        levels.append([sha("".join(levels[-1][i : i + 3])) for i in range(0, len(levels[-1]), 3)])
    return levels


def proof(levels, i):
    out = []
    for level in levels[:-1]:
        run = level[i - i % 3 : i - i % 3 + 3]
        out.append((run[: i % 3], run[i % 3 + 1 :]))
        i //= 3
    return out


def plain(rows):
    by = {}
    for row in rows:
        by.setdefault(row[1], []).append(row)
    groups = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    for g in groups:
        by[g].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
    trees = {g: tree([leaf(r) for r in by[g]]) for g in groups}
    top = tree([trees[g][-1][0] for g in groups])
    out = []
    for j, g in enumerate(groups):
        for i, row in enumerate(by[g]):
            steps = proof(trees[g], i) + proof(top, j)
            seen = row
            if row[0] is not None and row[4] is not None and zlib.crc32(str(row[0]).encode()) % 2 == 0:
                seen = (*row[:4], row[4].replace("\n", ""))
            digest = leaf(seen)
            for before, behind in steps:
                digest = sha("".join(before) + digest + "".join(behind))
            siblings = "".join("".join(a + b) for a, b in steps)
            root = top[-1][0]
            out.append((row[0], leaf(row), trees[g][-1][0], root, sha(siblings), digest, digest == root))
    return sorted(out, key=str)


@pytest.mark.parametrize("n, sources", [(0, 1), (1, 1), (900, 1), (1500, 900)])
def test_query_equals_plain_trees(spark, tmp_path, n, sources):
    rng = random.Random(n)
    rows = [
        (rng.choice([None, i // 2]) if rng.random() < 0.05 else i, rng.choice(["s0", f"s{rng.randrange(sources)}", "é" if n > 4 else "s0", None]),
         rng.choice(["en", None]), rng.choice([3, None]), rng.choice([None, "", "a\nb", f"t{i}\n"])) for i in range(n)
    ]
    rows += rows[: n // 10]
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    assert sorted(map(tuple, op11_merkle_manifest(spark, str(tmp_path)).collect()), key=str) == plain(rows)


def test_equal_rows_share_their_records(spark):
    """A table of one row many times: subtrees are equal, and the store holds each once."""
    docs = spark.range(3**8).select(F.lit(1).alias("doc_id"), F.lit("s").alias("source"), F.lit("same").alias("__row"))
    leaves = docs.select("doc_id", "source", leaf_digest(["doc_id", "__row"]).alias("leaf"), "__row")
    manifest = build_manifest(leaves, "source", "doc_id", ["__row"])
    assert manifest.groups.store(0).count() == 1 and manifest.groups.steps[0].count() == 9
    proofs = manifest.proofs()
    assert proofs.count() == 3**8
    assert proofs.where(folded("leaf") != F.col("root")).count() == 0
    assert proofs.where("proof[7].digit = 2").count() == 3**7


def test_any_change_is_seen(spark):
    leaves = spark.range(2000).select("id", (F.col("id") % 3).cast("string").alias("g"), F.sha2(F.col("id").cast("string"), 256).alias("leaf"))
    proofs = build_manifest(leaves, "g", "id").proofs()
    wrong = proofs.select((folded("leaf") == F.col("root")).alias("good"), (folded("sha2(leaf, 256)") == F.col("root")).alias("bad"))
    assert [tuple(r) for r in wrong.distinct().collect()] == [(True, False)]


def test_query_equals_sql(spark):
    sf = "/root/testdata/sf0.001"
    assert compare(spark, duck(sf), sf, "op11_merkle_manifest") is None
