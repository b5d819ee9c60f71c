import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from reuselens.llm import kernels as K
from tests.llm.conftest import shingle_set, words

TEXTS = st.lists(st.one_of(st.none(), st.text(alphabet="aAbB é\t\n .", max_size=30)), max_size=12)


@settings(max_examples=60, deadline=None)
@given(TEXTS, st.integers(1, 20), st.integers(1, 4))
def test_words_and_shingles_of_pieces(texts, limit, rows):
    """Equal words and shingles have equal hashes, others differ, in any cut."""
    seen, known = {}, {}
    for at, data, off in K.utf8_pieces(pa.array(texts, pa.string()), limit, rows):
        assert len(off) - 1 <= rows
        h, b = K.word_hashes(data, off)
        s, sb = K.shingle_hashes(h, b)
        for i in range(len(off) - 1):
            own = words(texts[at + i])
            assert len(own) == b[i + 1] - b[i]
            for w, x in zip(own, h[b[i]:b[i + 1]], strict=True):
                assert seen.setdefault(w, int(x)) == int(x)
            got = {int(x) for x in s[sb[i]:sb[i + 1]]}
            expected = shingle_set(texts[at + i])
            assert len(got) == len(expected)
            for w in expected:
                known.setdefault(w, set()).add(frozenset(got))
    assert len(set(seen.values())) == len(seen)


def test_sliced_and_null_columns():
    column = pa.array(["ab cd", None, "", "é f", "g"], pa.string()).slice(1, 3)
    pieces = list(K.utf8_pieces(column))
    assert len(pieces) == 1
    _, data, off = pieces[0]
    assert bytes(data[off[2]:off[3]]) == "é f".encode() and off[1] == 0 and off[2] == 0
