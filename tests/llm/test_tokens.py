import random
import zlib

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tallyline.llm import huffman as H
from tallyline.llm.blocks import text_slices
from tallyline.llm.bpe import BpeEncoder, encoder
from tallyline.llm.token_counts import count_spliced, count_tokens, op7_token_counts
from tallyline.llm.token_files import op5_token_files, read_token_files, write_token_files
from tallyline.session import shared_folder
from tests.llm.brute import SMALL, edge_docs, empty_docs, texts_of

PATH = public_tokenizers.path("byte_bpe_50k.json")
PARTS = ["a", "b", "abc", " the", " ", "  ", "\n", "\t", "\xa0", "　", "<|endoftext|>", "<|endof", "text|>", "é", "漢",
         "\U00013000", "'s", "12", "!", "\x1c", "\x7f", "\u0085", "​", "zzzzzzzz"]


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    own = Tokenizer.from_file(PATH)
    return lambda text: own.encode(text or "", add_special_tokens=False).ids


def test_parts_give_the_ids_of_whole_texts(library):
    rnd, own = random.Random(1), BpeEncoder(PATH)
    texts = ["".join(rnd.choice(PARTS) for _ in range(rnd.randint(0, 60))) for _ in range(1500)] + ["", None, "x" * 5000]
    for first, data, at in text_slices(pa.array(texts), 20_000):
        ids, counts = own.encode(data, at)
        place = np.r_[0, np.cumsum(counts)]
        assert own.counts(data, at).tolist() == counts.tolist()
        for i in range(len(counts)):
            assert ids[place[i] : place[i + 1]].tolist() == library(texts[first + i])


def test_a_full_store_starts_over(library, monkeypatch):
    from tallyline.llm import bpe

    monkeypatch.setattr(bpe, "CACHE_PARTS", 50)
    own = BpeEncoder(PATH)
    for k in range(6):
        text = " ".join(f"word{k}x{j}" for j in range(40))
        data = np.frombuffer(text.encode(), np.uint8)
        assert own.encode(data, np.array([0, len(data)]))[0].tolist() == library(text)


def test_spliced_chunks_count_as_the_whole(library):
    rnd, own = random.Random(3), encoder(PATH).tokenizer
    for _ in range(600):
        text = "".join(rnd.choice(PARTS) for _ in range(rnd.randint(0, 200)))
        assert count_spliced(own, text, rnd.choice([5, 16, 40]), rnd.choice([1, 4, 10])) == len(library(text))
    for text in ("a" * 20_000, " " * 5000, "<|endoftext|>" * 300, "漢" * 3000):
        assert count_spliced(own, text, 64, 8) == len(library(text))


def test_counts_of_documents(spark, library):
    texts = texts_of(spark)
    want = {i: (len(x.encode()), len(library(x)), len(library(x)) > 512) for i, x in texts.items()}
    got = {r.doc_id: (r.n_bytes, r.n_tokens, r.over_limit) for r in op7_token_counts(spark, SMALL).collect()}
    assert got == want
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    small = count_tokens(docs, PATH, chunk_chars=300, overlap=20)
    assert {r.doc_id: (r.n_bytes, r.n_tokens, r.over_limit) for r in small.collect()} == want


def test_count_edges(spark, library):
    docs = edge_docs(spark)
    rows = count_tokens(docs, PATH, chunk_chars=1000).collect()
    assert [r.n_tokens for r in rows] == [len(library(r.text)) for r in rows]
    assert [r.n_bytes for r in rows] == [len((r.text or "").encode()) for r in rows]
    assert count_tokens(empty_docs(spark), PATH).count() == 0


@given(st.lists(st.integers(0, 400), min_size=1, max_size=300), st.integers(9, 20))
@settings(max_examples=150, deadline=None)
def test_codes_are_prefix_free_and_short_enough(counts, longest):
    counts = np.array(counts) ** 3
    lengths = H.code_lengths(counts, longest)
    assert ((lengths > 0) == (counts > 0)).all() and lengths.max(initial=0) <= longest
    assert sum(2.0 ** -int(x) for x in lengths if x) <= 1
    rng = np.random.default_rng(0)
    used = np.flatnonzero(counts)
    ids = rng.choice(used, 1000) if len(used) else np.zeros(0, np.int64)
    bits, checkpoints = H.encode_block(ids, H.canonical_codes(lengths), lengths)
    assert H.decode_block(bits, checkpoints, len(ids), H.decoding_table(lengths)).tolist() == ids.tolist()


def test_unlimited_codes_are_huffman_codes():
    import heapq

    counts = np.random.default_rng(2).zipf(1.5, 500)
    counts = np.minimum(counts, 10_000)
    heap, cost = sorted(counts.tolist()), 0
    while len(heap) > 1:
        pair = heapq.heappop(heap) + heapq.heappop(heap)
        cost += pair
        heapq.heappush(heap, pair)
    assert int((H.code_lengths(counts, 30) * counts).sum()) == cost


def test_too_many_ids_for_the_length():
    with pytest.raises(ValueError):
        H.code_lengths(np.ones(9, np.int64), 3)


def test_files_of_documents(spark, library):
    want, start = [], 0
    for i, x in sorted(texts_of(spark).items()):
        ids = [*library(x), 0]
        want.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    got = op5_token_files(spark, SMALL).select("doc_id", "start", "n_tokens", "ids_crc32").collect()
    assert sorted(map(tuple, got)) == want


def test_file_edges(spark, library):
    docs = edge_docs(spark)
    folder = shared_folder(spark, "files")
    write_token_files(docs, folder, PATH)
    rows = read_token_files(spark, folder).orderBy("start").collect()
    ordered = sorted(((r.doc_id, r.text) for r in docs.collect()), key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or ""))
    assert [r.doc_id for r in rows] == [i for i, _ in ordered]
    assert [r.ids for r in rows] == [[*library(x), 0] for _, x in ordered]
    assert [r.start for r in rows] == [0, *np.cumsum([r.n_tokens for r in rows]).tolist()[:-1]]
    folder = shared_folder(spark, "files")
    write_token_files(empty_docs(spark), folder, PATH)
    assert read_token_files(spark, folder).count() == 0
