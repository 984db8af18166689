import hashlib
import random

import numpy as np
import pytest

from stratum.llm import bpe
from tests.llm.conftest import by_id, numbered

PATH, PATTERN = bpe.standard_ranks()


@pytest.fixture(scope="module")
def own():
    with open(PATH, "rb") as f:
        return bpe.Encoder(f.read(), PATTERN)


@pytest.fixture(scope="module")
def library(own):
    import tiktoken

    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=own.ranks, special_tokens={})


def texts(n, seed):
    rng = random.Random(seed)
    pick = [lambda: chr(rng.randrange(0x20, 0x7F)), lambda: chr(rng.randrange(1, 0x3100)),
            lambda: rng.choice(" \n\t\x1c\x85\xa0'"), lambda: chr(rng.randrange(0x10000, 0x11000)),
            lambda: rng.choice(["'s", "'re", "'ll", "'v", "''t", " 'm", "the ", "ing", "   "])]
    return ["".join(rng.choice(pick)() for _ in range(rng.randrange(0, 200))) for _ in range(n)] + [
        "", " ", "\n\n", "a" * 20000, "ab" * 3000, " " * 1000, "x" * 64, "x" * 65, "!" * 1000,
        "the" * 500, "'", "a's", "a'sb", "'re", "'r", "x \n y", "don't we'll", "<|endoftext|>"]


def test_ids_equal_the_library(own, library):
    for batch in (texts(300, 1), texts(50, 2)):
        raw = [t.encode() for t in batch]
        off = np.concatenate([[0], np.cumsum([len(r) for r in raw])])
        ids, first = own.encode_flat(np.frombuffer(b"".join(raw), np.uint8), off)
        for i, t in enumerate(batch):
            x = ids[first[i]:first[i + 1]]
            assert x.tolist() == library.encode_ordinary(t), repr(t)[:100]
            assert own.decode(x).tobytes() == raw[i]
            if len(t) < 3000:
                assert own.encode_plain(t).tolist() == x.tolist()


def test_array_cut_equals_the_pattern(own):
    import regex

    for t in texts(200, 3):
        raw = t.encode()
        start = bpe.cut_pieces(np.frombuffer(raw, np.uint8), np.array([0, len(raw)])).tolist()
        pieces = [raw[a:b].decode() for a, b in zip(start, [*start[1:], len(raw)])]
        if all(ord(c) < 0x3100 for c in t):
            late = [c for c in t if regex.match(r"[\p{L}\p{N}]", c) and bpe.char_classes()[ord(c)] == bpe.OTHER]
            if not late:
                assert pieces == regex.findall(PATTERN, t)


def test_both_forms_of_the_tree_agree(own):
    rng = random.Random(4)
    words = ["".join(rng.choice("abcdething é") for _ in range(rng.randrange(2, 60))).encode()
             for _ in range(300)]
    for size in {(len(w) - 1).bit_length() for w in words}:
        part = [w for w in words if (len(w) - 1).bit_length() == size]
        assert own.encode_pieces(part) == [own.encode_long(w) for w in part]


def test_memory_of_pieces_is_bounded(own, monkeypatch, library):
    monkeypatch.setattr(bpe, "CACHE", 50)
    for t in texts(40, 6):
        assert own.encode(t).tolist() == library.encode_ordinary(t)


def test_operator(frame, library):
    batch = [None, *texts(30, 5), "same text", "same text"]
    got = by_id(bpe.bpe_tokens(frame(numbered(batch)), PATH, PATTERN))
    assert len(got) == len(batch)
    for i, t in enumerate(batch):
        want = np.array(library.encode_ordinary(t or ""), dtype="<u4").tobytes()
        r = got[i]
        assert (r.n_tokens, r.ids_sha256, bytes(r.token_ids)) == (
            len(want) // 4, hashlib.sha256(want).hexdigest(), want)
        assert r.decoded_sha256 == hashlib.sha256((t or "").encode()).hexdigest()
    assert bpe.bpe_tokens(frame([]), PATH, PATTERN).count() == 0
