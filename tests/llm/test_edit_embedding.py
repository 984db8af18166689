import hashlib
import random

import numpy as np
import pytest
import xxhash

from stratum.llm import edit_embedding as ee
from tests.llm.conftest import by_id


def slow_embedding(text, walk):
    """The walk one step at a time: the character at every step, and the number of steps."""
    move = np.random.RandomState(ee._SEED + walk).randint(0, 2, (ee.PERIOD, ee.CLASSES), dtype=np.int8)
    i, out = 0, []
    while i < len(text):
        c = ord(text[i])
        out.append(c)
        k = c if c < 256 else ((c * 2654435761) & 0xFFFFFFFF) >> 24
        i += int(move[(len(out) - 1) % ee.PERIOD, k])
    return out


def slow_bits(text, walk):
    from stratum.llm.textops import U, mix

    symbols = slow_embedding(text, walk)
    steps = [t for t in ee.sampled_steps(walk, len(symbols)).tolist() if t < len(symbols)]
    value = np.array([(t * 0x9E3779B97F4A7C15 + symbols[t] + (walk << 40)) & (2 ** 64 - 1) for t in steps], dtype=U)
    return len(symbols), (mix(value) & U(1)).astype(int).tolist()


def brute(rows):
    tie = lambda t: xxhash.xxh64_intdigest((t or "").encode(), 42)
    signed = lambda h: h - (1 << 64) if h >> 63 else h
    order = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, signed(tie(r[1]))))
    out = []
    for (i, t), (_, nxt) in zip(order, order[1:] + order[:1]):
        t, nxt = t or "", nxt or ""
        h = len(t) // 2
        edited = t[:len(t) - h] + nxt[:h]
        a, b, c = (ee.fingerprint(x) for x in (t, edited, nxt))
        out.append((i, len(t), hashlib.sha256(edited.encode()).hexdigest(), str(a), str(b),
                    ee.likeness(a, b), ee.likeness(a, c)))
    return sorted(out, key=str)


def prose(rng, n):
    words = ["walk", "random", "Zeichen", "the", "of", "und", "édit", "日本語", "distance", "share", "to", "a"]
    words += ["".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randrange(2, 9))) for _ in range(200)]
    text = " ".join(rng.choice(words) for _ in range(n // 4 + 1))
    return text[:n]


@pytest.mark.parametrize("n", [0, 1, 2, 3, 50, 255, 256, 257, 5000, 70000])
def test_walks_equal_the_embedding_one_step_at_a_time(n):
    text = prose(random.Random(n), n)
    got = ee.fingerprint(text)
    assert got.chars == len(text)
    for w, (steps, bits) in enumerate(got.walks):
        assert (steps, bits.tolist()) == slow_bits(text, w)
    again = ee.Print.parse(str(got))
    assert str(again) == str(got) and ee.likeness(again, got) == 1.0


def test_edits_of_any_kind_stay_near_and_other_texts_do_not():
    rng = random.Random(8)
    for n in (200, 1000, 4000, 30000):
        for _ in range(5):
            t, other = prose(rng, n), prose(rng, n)
            p = ee.fingerprint(t)
            at = rng.randrange(n)
            assert ee.likeness(p, ee.fingerprint(t + "!")) > 0.9
            assert ee.likeness(p, ee.fingerprint(t[:n // 2] + other[n // 2:])) > 0.35
            assert ee.likeness(p, ee.fingerprint(other)) < 0.35
            assert ee.likeness(p, ee.fingerprint(t[:at] + t[at + 1:])) > ee.likeness(p, ee.fingerprint(other))
    assert ee.likeness(ee.fingerprint(""), ee.fingerprint("")) == 1.0
    assert ee.likeness(ee.fingerprint(""), ee.fingerprint("abc")) == 0.0


@pytest.mark.parametrize("together", [1, 48, 1000])
def test_texts_walked_together_equal_texts_walked_alone(monkeypatch, together):
    monkeypatch.setattr(ee, "TOGETHER", together)
    monkeypatch.setattr(ee, "LONG_TEXT", 4000)
    rng = random.Random(together)
    texts = [ee.codes(prose(rng, rng.choice((0, 1, 2, 30, 300, 3000, 9000)))) for _ in range(120)]
    text = [t.tobytes().decode("utf-32-le") for t in texts]
    assert [str(p) for p in ee.prints_of(texts)] == [str(ee.fingerprint(t)) for t in text]
    for i, (mine, edited) in enumerate(ee.edited_prints(texts)):
        h = len(text[i]) // 2
        assert str(mine) == str(ee.fingerprint(text[i]))
        assert str(edited) == str(ee.fingerprint(text[i][:len(text[i]) - h] + text[i + 1][:h]))


def test_query_columns_equal_brute_force(lspark, frame):
    rng = random.Random(2)
    rows = [(i * 3, prose(rng, rng.choice((0, 1, 7, 40, 900)))) for i in range(80)]
    rows += [(1000, None), (1001, ""), (1002, prose(rng, 150000)), (1003, "😀" * 31), (30, "twice"),
             (None, "no id"), (None, "none either"), (33, rows[11][1])]
    rng.shuffle(rows)
    got = ee.edited_fingerprints(frame(rows))
    cols = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    assert sorted((tuple(r[c] for c in cols) for r in got.collect()), key=str) == brute(rows)


def test_few_documents_and_empty_table(frame):
    for rows in ([(5, "alone here")], [(5, "alone here"), (2, "two")], [(None, "x")], [(None, "x"), (1, "abcd")]):
        got = ee.edited_fingerprints(frame(rows)).collect()
        assert sorted((tuple(r)[:7] for r in got), key=str) == brute(rows)
    assert ee.edited_fingerprints(frame([(1, "a")]).limit(0)).collect() == []


def test_classes_join_edited_texts_and_leave_others_alone(frame):
    rng = random.Random(4)
    base = [prose(rng, 3000) for _ in range(12)]
    rows = [(i, t) for i, t in enumerate(base)]
    rows += [(100 + i, t[:-20] + "another ending here") for i, t in enumerate(base[:6])]
    rows += [(200 + i, base[0]) for i in range(30)] + [(None, base[0]), (300, ""), (301, None)]
    got = by_id(ee.edit_classes(frame(rows)))
    for i in range(6):
        assert got[100 + i]["class_id"] == i and got[i]["n_links"] == 1
    assert all(got[200 + i]["class_id"] == 0 for i in range(30))
    assert all(got[i]["class_id"] == i and got[i]["n_links"] == 0 for i in range(6, 12))
    assert got[301]["class_id"] == 300 and None not in got
