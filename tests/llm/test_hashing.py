import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from liqspark.llm import hashing as H

WORDS = st.lists(st.text(alphabet="ab \n\té字", max_size=30), min_size=1, max_size=6)


@settings(max_examples=80, deadline=None)
@given(WORDS, st.integers(4, 64))
def test_words_do_not_depend_on_slices(texts, size):
    raw = [t.encode() for t in texts]
    data, begins = H.joined(raw)
    hasher = H.PrefixHasher()
    whole = H.words(data, hasher)
    cut = [np.concatenate(x) for x in zip(*[(s + at, e + at) for at, end in H.slices(data, H.WHITE, size)
                                            for _, s, e in [H.words(data[at:end], hasher)]])]
    assert [data[a:b].tobytes() for a, b in zip(whole[1], whole[2])] == b" ".join(raw).split()
    assert (cut[0] == whole[1]).all() and (cut[1] == whole[2]).all()
    by_word = {}
    for h, a, b in zip(*whole):
        assert by_word.setdefault(data[a:b].tobytes(), h) == h
    assert len(set(by_word.values())) == len(by_word)
    assert list(begins) == [sum(len(r) + 1 for r in raw[:k]) for k in range(len(raw))]


@settings(max_examples=80, deadline=None)
@given(st.lists(st.text(alphabet="abB \n", max_size=40), min_size=1, max_size=5))
def test_shingle_sets_match_python(texts):
    from brute import shingles
    got = H.shingle_sets([t.encode() for t in texts], 5, H.PrefixHasher())
    want = [shingles(t) for t in texts]
    assert [len(s) for s in got] == [len(s) for s in want]
    for i in range(len(texts)):
        for j in range(i):
            assert len(np.intersect1d(got[i], got[j])) == len(want[i] & want[j])


def test_a_word_longer_than_a_slice():
    data = np.frombuffer(b"a" * 5000 + b" b", np.uint8)
    assert [e for _, e in H.slices(data, H.WHITE, 100)][0] == 5000
