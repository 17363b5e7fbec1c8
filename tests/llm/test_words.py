import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from faremill.llm.words import Words, grams, slices
from tests.llm.conftest import words

TEXTS = st.lists(st.one_of(st.none(), st.text(alphabet="ab é\n\t x.", max_size=30)), max_size=8)


@settings(max_examples=80, deadline=None)
@given(TEXTS)
def test_words_are_those_of_the_pattern(texts):
    found = Words(pa.array(texts, pa.string()))
    expected = [words(x) for x in texts]
    assert found.counts.tolist() == [len(x) for x in expected]
    flat = [w for x in expected for w in x]
    assert [found.word(i).decode() for i in range(len(found))] == flat
    hashes = found.hashes()
    assert len(set(hashes.tolist())) == len(set(flat))


@settings(max_examples=30, deadline=None)
@given(TEXTS.filter(bool), st.integers(1, 20))
def test_slices_keep_all_rows(texts, most):
    batch = pa.RecordBatch.from_arrays([pa.array(texts, pa.string())], names=["text"])
    parts = list(slices([batch], most_bytes=most))
    assert [x for p in parts for x in p.column(0).to_pylist()] == texts


def test_grams_tell_sequences_apart():
    h = Words(pa.array(["a b c a b c a b d"])).hashes()
    for n in (1, 2, 3, 5):
        g = grams(h, n)[: len(h) - n + 1]
        text = "a b c a b c a b d".split()
        spans = [tuple(text[i : i + n]) for i in range(len(g))]
        for i in range(len(g)):
            for j in range(len(g)):
                assert (g[i] == g[j]) == (spans[i] == spans[j])
    assert np.all(h == Words(pa.array(["a b c a b c a b d"])).hashes())
