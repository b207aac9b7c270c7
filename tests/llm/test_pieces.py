import random

import pyarrow as pa
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from tallyline.llm.blocks import text_slices
from tallyline.llm.pieces import DoubleArray, decode_pieces, encode_pieces, pieces
from tests.llm.brute import edge_docs, empty_docs, texts_of

MODEL = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def library():
    """The library's own Viterbi over the same pieces and scores."""
    import sentencepiece
    from sentencepiece import sentencepiece_model_pb2 as pb

    proto = pb.ModelProto()
    with open(MODEL, "rb") as f:
        proto.ParseFromString(f.read())
    proto.trainer_spec.model_type = 1
    for piece, score in zip(proto.pieces, pieces(MODEL).scores):
        piece.score = float(score)
    return sentencepiece.SentencePieceProcessor(model_proto=proto.SerializeToString())


def encoded(texts):
    own, out = pieces(MODEL), []
    for _, data, at in text_slices(pa.array(texts, pa.string()), 5000):
        ids, counts = own.encode_texts(data, at)
        place = [0, *counts.cumsum().tolist()]
        out += [ids[a:b].tolist() for a, b in zip(place, place[1:])]
    return out


def test_equals_the_library(library):
    rnd = random.Random(11)
    parts = ["a", "the", "ing", " ", "  ", "\n", "é", "漢", "字", "\U00013000", "▁", "17", "<s>", "​", "zq", "xxxxxxx"]
    texts = ["".join(rnd.choice(parts) for _ in range(rnd.randint(0, 200))) for _ in range(400)]
    texts += ["x" * 2000, "漢" * 300, "ab" * 200 + "\U00013000" * 50, "", None]
    assert encoded(texts) == [library.encode(x or "") for x in texts]


def test_equals_the_library_on_documents(spark, library):
    texts = list(texts_of(spark).values())
    assert encoded(texts) == [library.encode(x) for x in texts]


def test_decoding_equals_the_library(library):
    import numpy as np

    rnd, own = random.Random(12), pieces(MODEL)
    lists = [[rnd.randrange(3, 32000) for _ in range(20)] for _ in range(200)]
    lists += [[rnd.randrange(3, 259) for _ in range(12)] for _ in range(400)]  # mostly bytes that are no text
    for ids in lists:
        assert own.decode_ids(np.array(ids), np.array([len(ids)])) == [library.decode(ids)]


def test_double_array_holds_its_keys_and_no_others():
    keys = {b"a": 0, b"ab": 1, b"abc": 2, b"b": 3, b"\xff\x00": 4}
    trie = DoubleArray(keys)

    def find(key):
        node = 0
        for c in key:
            child = trie.base[node] + c + 1
            if trie.check[child] != node:
                return -1
            node = child
        return trie.value[node]

    assert {k: find(k) for k in keys} == keys
    assert [find(k) for k in (b"", b"ac", b"\xff", b"abcd", b"\x00")] == [-1] * 5


def test_edges(spark):
    docs = edge_docs(spark)
    coded = decode_pieces(encode_pieces(docs, MODEL, check=True), MODEL)
    rows = coded.collect()
    assert len(rows) == docs.count() and all(r.round_trip for r in rows)
    assert all(r.decoded == (r.text or "").replace("▁", " ") for r in rows)
    assert all(r.n_pieces == len(r.pieces) for r in rows)
    assert [r.n_pieces for r in rows if not r.text] == [0, 0, 0]
    assert "kept" in coded.columns and coded.columns.count("pieces") == 1
    assert encode_pieces(empty_docs(spark), MODEL, check=True).count() == 0
    none = coded.limit(1).withColumn("pieces", F.lit(None).cast("array<int>"))
    assert [r.decoded for r in decode_pieces(none, MODEL).collect()] == [None]
