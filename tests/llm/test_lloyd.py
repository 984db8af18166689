import hashlib
import math
import random

import numpy as np
import pytest

from stratum.llm import lloyd


def brute(rows, parts=8, entries=16, rounds=6, scale=4096):
    """rows of (id, vector, label), in plain Python integers."""
    kept = [(i, v, lab) for i, v, lab in rows
            if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    longest = max((len(v) for _, v, _ in kept), default=0)
    dims = -(-longest // parts)
    ints = []
    for i, v, lab in kept:
        w = [math.floor(x * scale) if abs(x) < 2 ** 53 else int(x) * scale for x in v]
        ints.append((i, v, w + [0] * (dims * parts - len(w)), lab))
    start = sorted(ints, key=lambda r: (r[0] is None, r[0] or 0, r[1]))[:entries]
    cut = lambda w, p: w[p * dims:(p + 1) * dims]
    books = [[cut(w, p) for _, _, w, _ in start] for p in range(parts)]
    near = lambda x, book: min((sum((a - b) ** 2 for a, b in zip(x, c)), e)
                               for e, c in enumerate(book))
    for _ in range(rounds):
        for p in range(parts):
            members = {}
            for _, _, w, _ in ints:
                members.setdefault(near(cut(w, p), books[p])[1], []).append(cut(w, p))
            for e, xs in members.items():
                books[p][e] = [sum(col) // len(xs) for col in zip(*xs)]
    out, by_label = [], {}
    for i, _, w, lab in ints:
        found = [near(cut(w, p), books[p]) for p in range(parts)]
        err = sum(d for d, _ in found)
        out.append((i, "".join(f"{e:02x}" for _, e in found), err, lab))
        by_label[lab] = by_label.get(lab, 0) + err
    sha = hashlib.sha256(",".join(str(v) for b in books for c in b for v in c).encode()).hexdigest()
    fits = lambda v: v if v < 1 << 63 else None
    lost = {lab for _, _, err, lab in out if err >= 1 << 63}
    return sorted(((i, code, fits(err), None if lab in lost else fits(by_label[lab]), sha)
                   for i, code, err, lab in out), key=str)


def result(df, **kw):
    return sorted((tuple(r) for r in lloyd.compress(df, **kw).collect()), key=str)


SCHEMA = "vec_id long, embedding array<double>, label int, code string, moved string, salt int, x int"


def make(spark, rows):
    return spark.createDataFrame([(*r, "c", "m", 1, 2) for r in rows], SCHEMA)


def test_equals_brute_force_with_a_common_vector_ties_and_unusable_rows(lspark):
    rng = random.Random(5)
    common = [rng.uniform(-1, 1) for _ in range(16)]
    rows = []
    for i in range(400):
        v = common if rng.random() < 0.35 else [rng.choice((-1.0, 0.0, 0.5, rng.uniform(-1, 1))) for _ in range(16)]
        rows.append((i, v, rng.choice((None, 1, 1, 1, 2, 3))))
    rows += [(500, None, 1), (501, [None] * 16, 1), (502, [float("nan")] * 16, 1),
             (503, [float("-inf")] + [0.0] * 15, 1), (7, rows[7][1], 2), (None, common, None)]
    df = make(lspark, rows)
    assert result(df) == brute(rows)
    assert result(df, owner_parts=4) == brute(rows)  # many owners of every entry


def test_unequal_lengths_few_vectors_and_empty_table(lspark):
    rows = [(3, [0.1, 0.2, 0.3], 1), (1, [], None), (2, [1.0] * 9, 1), (4, [-0.5] * 8, None)]
    df = make(lspark, rows)
    assert result(df) == brute(rows)
    assert result(df, parts=2, entries=2, rounds=3) == brute(rows, 2, 2, 3)
    assert lloyd.compress(df.limit(0)).collect() == []
    blank = [(1, [], 1), (2, [], 1)]
    assert result(make(lspark, blank)) == brute(blank)


def test_components_of_any_finite_size(lspark):
    rng = random.Random(6)
    rows = [(i, [rng.uniform(-1, 1) for _ in range(8)], 1) for i in range(60)]
    rows[3] = (3, [1e9] + [0.0] * 7, 2)          # a starting entry
    rows[40] = (40, [1e305, -1e305] + [0.0] * 6, 3)
    rows[41] = (41, [3e15] * 8, 3)
    rows[50] = (50, [1e9 + 3] + [0.5] * 7, 2)
    df = make(lspark, rows)
    assert result(df) == brute(rows)


def test_only_members_that_change_entry_are_moved(lspark):
    m = np.array([[0, 0], [1, 0], [9, 9], [10, 10]])
    blocks = lspark.createDataFrame(
        [(0, 0, 0, False, 4, lloyd._pack(m), [])], lloyd._BLOCK)
    got = lloyd._move(blocks, [np.array([[0, 0], [10, 10]])], 2).collect()
    held = {(r["entry"], r["moved"]): lloyd._unpack(r["members"], r["n"], 2).tolist() for r in got}
    assert held == {(0, False): [[0, 0], [1, 0]], (1, True): [[9, 9], [10, 10]]}


@pytest.mark.parametrize("size", [100, 1 << 20, 1 << 28, 1 << 40, 1 << 80])
def test_nearest_is_exact_at_every_size(size):
    rng = random.Random(size)
    pick = lambda: rng.choice((0, 1, rng.randrange(-size, size), rng.randrange(-50, 50)))
    m = [[pick() for _ in range(5)] for _ in range(40)]
    c = [[pick() for _ in range(5)] for _ in range(7)]
    kind = np.int64 if size < 1 << 61 else object
    e, d = lloyd.nearest(np.array(m, dtype=kind), np.array(c, dtype=kind))
    want = [min((sum((a - b) ** 2 for a, b in zip(x, y)), j) for j, y in enumerate(c)) for x in m]
    assert [(int(s), int(j)) for s, j in zip(d, e)] == want
