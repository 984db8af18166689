import random
import re

import numpy as np
import pytest

from stratum.llm import minhash
from stratum.llm.components import connected
from stratum.llm.frames import may_contain, without_keys
from tests.llm.conftest import numbered


def shingles(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not w:
        return frozenset()
    return frozenset(tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4)))


def closure(nodes, links):
    parent = {n: n for n in nodes}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = root(a), root(b)
        if a != b:
            parent[max(a, b)] = min(a, b)
    return {n: root(n) for n in nodes}


def brute(rows, percent=85):
    sets = [(i, shingles(t)) for i, t in rows]
    links = [(a, b) for x, (a, s) in enumerate(sets) for b, r in sets[x + 1:]
             if a is not None and b is not None and s and r and 100 * len(s & r) >= percent * len(s | r)]
    comp = closure({i for i, _ in sets if i is not None}, links)
    return sorted(((i, len(s), comp.get(i)) for i, s in sets), key=str)


def family(rng, size, words, edits):
    base = [f"w{rng.randrange(400)}" for _ in range(words)]
    out = []
    for _ in range(size):
        w = list(base)
        for _ in range(rng.randrange(edits + 1)):
            w[rng.randrange(len(w))] = f"e{rng.randrange(10**6)}"
        out.append(" ".join(w))
    return out


def corpus(seed):
    rng = random.Random(seed)
    texts = [None, "", " \t\n", "one", "One", "a b c d", "A b C d", "a b c d e", "x" * 50000,
             "same words over and over " * 30, "same words over and over " * 40, "é É", "é é"]
    for words, edits in ((60, 4), (120, 6), (40, 2), (200, 14), (30, 3)):
        texts += family(rng, 30, words, edits)
    passage = " ".join(f"p{i}" for i in range(60))
    texts += [" ".join(f"q{rng.randrange(10**6)}" for _ in range(60)) + " " + passage for _ in range(30)]
    texts += ["exact copy of a text that occurs many times here"] * 40
    rng.shuffle(texts)
    return texts


@pytest.mark.parametrize("part", [minhash.PART, 16])
def test_classes_equal_brute_force(frame, monkeypatch, part):
    monkeypatch.setattr(minhash, "PART", part)
    rows = numbered(corpus(1))
    rows += [(None, rows[0][1]), (None, "one"), (5, rows[5][1]), (7, "a second text under one id, quite unlike")]
    rng = random.Random(0)
    rng.shuffle(rows)
    got = minhash.near_duplicates(frame(rows), 85).collect()
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=str) == brute(rows)
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def test_chain_of_links_is_one_component(frame):
    base = [f"w{i}" for i in range(200)]
    rows = []
    for step in range(12):  # each differs from the one before by a few words
        rows.append((step, " ".join([f"n{i}" for i in range(step * 3)] + base[step * 3:])))
    got = {r.doc_id: r.component_id for r in minhash.near_duplicates(frame(rows), 85).collect()}
    assert [(i, got[i]) for i in got] and sorted(got.items()) == sorted((i, c) for i, _, c in brute(rows))


def test_estimate_corrects_for_chance(lspark):
    rng = random.Random(2)
    from stratum.llm.textops import flat
    import pyarrow as pa

    for share in (0.5, 0.85, 0.97):
        a = [f"w{i}" for i in range(2000)]
        errors = []
        for _ in range(12):
            n = int(2000 * (1 - share) / 5 / (1 + share) * 2)
            b = list(a)
            for p in rng.sample(range(2000), n):
                b[p] = f"z{rng.randrange(10**9)}"
            texts = [" ".join(a), " ".join(b)]
            s = minhash.sketch(*minhash.shingle_sets(*flat(pa.array(texts))), 2)["signature"]
            low = np.uint64(sum(1 << (minhash.B * i) for i in range(64 // minhash.B)))
            x = s[0] ^ s[1]
            for k in range(1, minhash.B):
                x = x | (s[0] ^ s[1]) >> np.uint64(k)
            agree = 1 - np.bitwise_count(x & low).sum() / minhash.PERMUTATIONS
            c = 2.0 ** -minhash.B
            A, B_ = shingles(texts[0]), shingles(texts[1])
            errors.append((agree - c) / (1 - c) - len(A & B_) / len(A | B_))
        assert abs(np.mean(errors)) < 0.04 and np.max(np.abs(errors)) < 0.2


def test_components_of_paths_stars_and_random_graphs(lspark):
    rng = random.Random(3)
    links = [(i, i + 1) for i in range(100, 160)] + [(200, i) for i in range(201, 260)]
    links += [(500 - i, 499 - i) for i in range(60)] + [(7, 7), (None, 3), (3, None), (1, 2), (2, 1)]
    links += [(rng.randrange(1000, 1100), rng.randrange(1000, 1100)) for _ in range(70)]
    got = {r.id: r.component for r in connected(
        lspark.createDataFrame(links, "a long, b long"), "test").collect()}
    good = [(a, b) for a, b in links if a is not None and b is not None]
    want = closure({x for p in good for x in p}, good)
    assert all(want[i] == c for i, c in got.items())
    assert {i for i, c in want.items() if c != i} <= set(got)
    assert connected(lspark.createDataFrame([], "a long, b long"), "none").count() == 0


def test_bitmap_keeps_all_wanted_rows(lspark):
    rows = lspark.createDataFrame([(i, i % 7) for i in range(500)] + [(None, 1)], "k long, v long")
    wanted = lspark.createDataFrame([(i,) for i in range(0, 500, 9)], "k long")
    for bits in (64, 1 << 16):
        kept = {r.k for r in may_contain(rows, "k", wanted, bits).collect()}
        assert set(range(0, 500, 9)) <= kept
    left = sorted(r.k for r in without_keys(rows, wanted).collect() if r.k is not None)
    assert left == [i for i in range(500) if i % 9]
    assert without_keys(rows, wanted).filter("k IS NULL").count() == 1
    assert without_keys(rows, wanted.limit(0)).count() == 501


def test_one_document_of_each_class_stays(frame):
    rows = numbered(corpus(4)) + [(3, corpus(4)[3]), (None, "one"), (None, "one")]
    src = frame(rows)
    out = minhash.drop_near_duplicates(src, 85)
    assert out.columns == src.columns
    want = {i for i, _, c in brute(rows) if i is not None and i == c}
    ids = [r.doc_id for r in out.collect()]
    assert sorted(i for i in ids if i is not None) == sorted(want) and ids.count(None) == 2


def test_empty_table(frame):
    assert minhash.near_duplicates(frame([])).count() == 0
