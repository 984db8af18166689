import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from stratum.llm.suffix_dedup import find_anchors, remove_repeats, repeated_starts
from tests.llm.conftest import numbered


def brute(texts, span):
    raw = [(t or "").encode() for t in texts]
    seen = Counter(r[i:i + span] for r in raw for i in range(len(r) - span + 1))
    out = []
    for r in raw:
        gone = np.zeros(len(r), dtype=bool)
        for i in range(len(r) - span + 1):
            if seen[r[i:i + span]] > 1:
                gone[i:i + span] = True
        runs = int(gone[:1].sum() + (gone[1:] & ~gone[:-1]).sum())
        kept = bytes(b for b, g in zip(r, gone) if not g)
        out.append((len(r), int(gone.sum()), runs, hashlib.sha256(kept).hexdigest()))
    return out


def corpus(seed):
    rng = random.Random(seed)
    words = ["ab", "c", "dé", "the", "of ", " ", "xyz", "\n", "q", "😀"]
    texts = [None, "", "a" * 1500, "a" * 399, "a" * 400, "ab" * 500, "b" * 401]
    base = ["".join(rng.choice(words) for _ in range(rng.randrange(50, 500))) for _ in range(8)]
    for _ in range(70):
        t = rng.choice(base)
        for _ in range(rng.randrange(0, 4)):
            i = rng.randrange(len(t))
            t = t[:i] + rng.choice(words) + t[i + rng.randrange(3):]
        if rng.random() < 0.3:
            t = "".join(rng.choice(words) for _ in range(100)) + t[rng.randrange(len(t)):] + rng.choice(base)[:300]
        texts.append(t)
    return texts


@pytest.mark.parametrize("span,k,group", [(400, 100, 4096), (400, 100, 4), (64, 16, 5)])
def test_equals_brute_force(frame, span, k, group):
    texts = corpus(span + group)
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256)
           for r in remove_repeats(frame(numbered(texts)), span, k, group_rows=group).collect()}
    assert [got[i] for i in range(len(texts))] == brute(texts, span)


def test_repeated_rows_null_ids_and_kept_bytes(frame):
    long = "".join(chr(97 + (i * i) % 26) + str(i) for i in range(300))
    rows = [(1, long), (1, long), (None, "solo " + long[:450]), (None, None), (2, "unlike " * 3)]
    got = remove_repeats(frame(rows)).collect()
    want = brute([t for _, t in rows], 400)
    assert sorted((r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got) == sorted(want)
    assert len(got) == len(rows)
    assert "unlike " * 3 in [r.kept_text for r in got]
    for r in got:  # no character was cut here
        assert hashlib.sha256(r.kept_text.encode()).hexdigest() == r.kept_sha256


def test_texts_of_over_16_mib(frame):
    """Longer texts are scanned in halves that overlap by a window."""
    rng = random.Random(9)
    core = "".join(rng.choice("abcdefgh ") for _ in range(900))
    filler = rng.randbytes(9 << 20).hex()  # no window of it repeats
    far = filler[:(1 << 24) - 450] + core + filler[(1 << 24) - 450:] + core[:400] + "|end"
    rows = [(1, far), (2, "x" + core + "y"), (3, "nothing shared " * 5)]
    got = {r.doc_id: r for r in remove_repeats(frame(rows)).collect()}
    assert got[1].n_bytes == len(far) and got[1].n_removed == 900 + 400 and got[1].n_spans == 2
    assert got[1].kept_text == filler + "|end"
    assert (got[2].n_removed, got[2].kept_text) == (900, "xy") and got[3].n_removed == 0


def test_induced_order_equals_sorting_each_start():
    rng = random.Random(1)
    span, k = 24, 8
    for _ in range(20):
        rows = []
        for g in range(4):
            core = "".join(rng.choice("ab") for _ in range(k))
            pool = ["".join(rng.choice("ab") for _ in range(span)) for _ in range(3)]
            for _ in range(rng.randrange(1, 12)):
                hi = rng.randrange(0, span - k + 1)
                lo = rng.randrange(0, hi + 1)
                left, right = rng.choice(pool), rng.choice(pool)
                rows.append((g, lo, hi, (left[span - hi:] + core + right)[:hi - lo + span].encode()))
        group, lo, hi = (np.array([r[i] for r in rows]) for i in range(3))
        off = np.concatenate([[0], np.cumsum([len(r[3]) for r in rows])])
        flags = repeated_starts(group, lo, hi, np.frombuffer(b"".join(r[3] for r in rows), np.uint8), off, span)
        seen = Counter((g, l, b[h - l:h - l + span]) for g, a, h, b in rows for l in range(a, h + 1))
        for i, (g, a, h, b) in enumerate(rows):
            assert [l for l in range(flags.shape[1]) if flags[i, l]] == [
                l for l in range(a, h + 1) if seen[(g, l, b[h - l:h - l + span])] > 1]


def test_every_start_has_one_anchor_that_its_bytes_decide():
    rng = random.Random(2)
    text = bytes(rng.choice(b"abcd") for _ in range(900))
    data = np.frombuffer(b"xx" + text + b"yyy" + text[100:700], np.uint8)
    off = np.array([0, 902, 905 + 600])
    a = find_anchors(data, off, 200, 50)
    at = {}
    for r, p, lo, hi in zip(a["row"], a["at"], a["lo"], a["hi"]):
        for l in range(lo, hi + 1):
            assert (r, p - l) not in at
            at[(r, p - l)] = p
    assert sorted(s for r, s in at if r == 0) == list(range(902 - 199))
    assert all(at[(1, s + 3)] - 3 == at[(0, s + 102)] - 102 for s in range(600 - 199))


def test_empty_table(frame):
    assert remove_repeats(frame([])).count() == 0
