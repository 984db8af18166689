import re

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from stratum.llm import textops as T


def _flat(texts):
    return T.flat(pa.array(texts, pa.string()))


@settings(max_examples=150, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(alphabet="aB1 \t\né😀-.", max_size=30)), max_size=8))
def test_words_equal_regular_expressions(texts):
    data, off = _flat(texts)
    for table, pattern in ((T.NON_SPACE, r"[^\x20\x09-\x0D]+"), (T.ALNUM, r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")):
        words = T.Words(data, off, table)
        lowered = T.LOWER[data]
        got = [[bytes(lowered[s:e]) for s, e, d in zip(words.start, words.end, words.doc) if d == i]
               for i in range(len(texts))]
        want = [[w.encode() for w in re.findall(pattern, re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))]
                for t in texts]
        assert got == want
        assert np.diff(words.first).tolist() == [len(w) for w in want]
        flat_words = [w for x in want for w in x]
        for i, a in enumerate(flat_words):
            for j, b in enumerate(flat_words):
                assert (words.code[i] == words.code[j]) == (a == b)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 50), max_size=60), st.integers(1, 25))
def test_sliding_min(values, w):
    v = np.array(values, dtype=np.uint64)
    got = T.sliding_min(v, w).tolist()
    assert got == [min(values[i:i + w]) for i in range(len(values) - w + 1)]


def test_blocks_cover_all_rows_and_keep_documents_whole():
    off = np.cumsum([0, 5, 0, 100, 3, 3, 0, 50])
    cut = list(T.blocks(off, 10))
    assert cut[0][0] == 0 and cut[-1][1] == len(off) - 1
    assert all(a[1] == b[0] for a, b in zip(cut, cut[1:]))
    assert T.blocks(np.array([0]), 10) and list(T.blocks(np.array([0]), 10)) == []


def test_flat_of_sliced_and_null_columns():
    col = pa.array(["ab", None, "", "cde"]).slice(1)
    data, off = T.flat(col)
    assert bytes(data) == b"cde" and off.tolist() == [0, 0, 0, 3]


def test_run_hash_depends_on_order_and_content():
    codes = T.mix(np.arange(1, 20, dtype=np.uint64))
    h = T.run_hash(np.concatenate([codes, codes]), 5)
    assert (h[:15] == h[19:34]).all()
    assert len(set(h[:15].tolist())) == 15
    assert len(T.run_hash(codes[:3], 5)) == 0
