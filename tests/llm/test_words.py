import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from tallyline.llm import blocks as B
from tests.llm.brute import words

TEXT = st.lists(st.sampled_from(["a", "B", "zé", "漢", " ", "\n", "\t", " ", "\x1c", "word"]), max_size=30).map("".join)


@given(st.lists(st.none() | TEXT, max_size=8), st.integers(1, 40))
@settings(max_examples=150, deadline=None)
def test_words_and_shingles(texts, limit):
    seen, got, counts = {}, [], []
    for first, data, at in B.text_slices(pa.array(texts, pa.string()), limit):
        starts, ends, owner, hashes = B.words(data, at, B.FOLDED)
        _, of = B.shingle_hashes(hashes, owner, 5)
        for i in range(len(at) - 1):
            mine = owner == i
            got.append([data[a:b].tobytes().decode() for a, b in zip(starts[mine], ends[mine])])
            counts.append(int((of == i).sum()))
            for word, h in zip(got[-1], hashes[mine].tolist()):
                assert seen.setdefault(words(word, lower=True)[0], h) == h
    assert got == [words(x) for x in texts]
    assert counts == [0 if not w else max(1, len(w) - 4) for w in got]
    assert len(set(seen.values())) == len(seen)


def test_shingles_of_equal_words_are_equal_across_slices():
    a, b = ["x y z u v w"], ["q", "x y z u v w"]
    found = []
    for texts in (a, b):
        for _, data, at in B.text_slices(pa.array(texts)):
            _, _, owner, hashes = B.words(data, at, B.FOLDED)
            shingles, of = B.shingle_hashes(hashes, owner, 5)
            found.append(shingles[of == len(at) - 2].tolist())
    assert found[0] == found[1] and len(found[0]) == 2


def test_span_hashes_equal_a_plain_sum_of_powers():
    rng, whole = np.random.default_rng(0), (1 << 64) - 1
    for n in (1, 50, 3 * B.SPAN_BYTES):  # spans beyond a stretch, across its end, empty ones, gaps
        data = rng.integers(0, 256, n).astype(np.uint8)
        cuts = np.sort(rng.integers(0, n + 1, 16))
        starts, ends = np.r_[cuts[::2], n], np.r_[cuts[1::2], n]
        for table in (B.EXACT, B.FOLDED):
            plain = []
            for a, b in zip(starts.tolist(), ends.tolist()):
                total, power = 0, 1
                for byte in data[a:b].tolist():
                    total, power = (total + int(table[byte]) * power) & whole, power * B._BASE & whole
                plain.append(total)
            assert B.span_hashes(data, starts, ends, table).tolist() == B.mix(np.array(plain, np.uint64)).tolist()
