import math
import random

import pytest
from pyspark.sql import functions as F

from stratum.llm.topk import top_k, weights


def brute(rows, is_query, k):
    usable = [(i, [math.floor(64 * x) for x in v]) for i, v in rows
              if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = set()
    for q in {i for i, _ in usable if is_query(i)}:
        w = min(v for i, v in usable if i == q)
        scored = sorted(((-sum(a * b for a, b in zip(w, v)), i) for i, v in usable if i != q))[:k]
        out |= {(q, n + 1, i, -s) for n, (s, i) in enumerate(scored)}
    return out


@pytest.mark.parametrize("sizes", [dict(), dict(range_rows=40, query_rows=5, block_rows=7)])
def test_equals_brute_force_with_ties_and_unusable_rows(lspark, sizes):
    rng = random.Random(4)
    common = [0.5, -0.25, 0.125, 0.0]
    rows = []
    for i in range(260):
        v = [rng.uniform(-1, 1) for _ in range(4)]
        v = common if rng.random() < 0.4 else v  # a very common vector: ties
        rows.append((i, v))
    rows += [(300, None), (320, [1.0, None, 0.0, 0.0]), (340, [float("nan")] * 4),
             (360, [float("inf"), 0.0, 0.0, 0.0]), (380, []), (400, [1.0, 1.0]), (None, common), (20, rows[20][1])]
    df = lspark.createDataFrame([(i, v, 1) for i, v in rows], "vec_id long, embedding array<double>, score int")
    got = top_k(weights(df), F.col("vec_id") % 20 == 0, k=6, **sizes).collect()
    # A repeated row is a candidate of its own; both rows of an id are left out for that id.
    assert len(got) == len({(r.query_id, r.rank) for r in got})
    assert sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in got) == sorted(_with_copies(rows, 6))


def _with_copies(rows, k):
    usable = [(i, [math.floor(64 * x) for x in v]) for i, v in rows
              if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    for q in {i for i, _ in usable if i % 20 == 0}:
        w = min(v for i, v in usable if i == q)
        scored = sorted((-sum(a * b for a, b in zip(w, v)), i) for i, v in usable if i != q)[:k]
        for n, (s, i) in enumerate(scored):
            yield q, n + 1, i, -s


def test_fewer_candidates_than_k_and_empty_table(lspark):
    df = lspark.createDataFrame([(0, [1.0]), (1, [0.5])], "vec_id long, embedding array<float>")
    got = top_k(weights(df), F.col("vec_id") % 20 == 0).collect()
    assert [(r.query_id, r["rank"], r.vec_id, r.score) for r in got] == [(0, 1, 1, 64 * 32)]
    assert top_k(weights(df.limit(0)), F.col("vec_id") % 20 == 0).count() == 0


def test_pruning_skips_blocks_without_changing_results():
    import numpy as np

    from stratum.llm.topk import search_cell

    rng = np.random.RandomState(1)
    blocks = [(np.arange(b * 50, b * 50 + 50), (rng.randint(-5, 6, (50, 8)) + 40 * (b == 3)).astype(np.int32))
              for b in range(30)]
    q = [(np.array([5000, 5001]), rng.randint(1, 9, (2, 8)).astype(np.int32))]
    got = search_cell(q, blocks, 10)
    assert set(got["vec_id"]) <= set(range(150, 200))


def test_components_of_any_finite_size(lspark):
    rng = random.Random(7)
    rows = [(i, [rng.uniform(-1, 1) for _ in range(4)]) for i in range(60)]
    rows[20] = (20, [1e9, 0.25, -1e9, 0.0])
    rows[33] = (33, [3e12, -2e12, 0.5, 1.0])
    rows[40] = (40, [-1e300, 1e300, 0.0, 0.0])
    rows[41] = (41, [0.0, 1e200, 1.0, 1.0])
    hold = lambda v: max(-9.2e18, min(9.2e18, 64 * v))
    w = {i: [math.floor(hold(x)) for x in v] for i, v in rows}
    ends = lambda s: max(-(1 << 63) + 1, min((1 << 63) - 1, s))
    want = []
    for q in range(0, 60, 20):
        scored = sorted((-ends(sum(a * b for a, b in zip(w[q], w[i]))), i) for i in w if i != q)[:5]
        want += [(q, n + 1, i, -s) for n, (s, i) in enumerate(scored)]
    df = lspark.createDataFrame(rows, "vec_id long, embedding array<double>")
    for sizes in ({}, dict(range_rows=20, query_rows=2, block_rows=6)):
        got = top_k(weights(df), F.col("vec_id") % 20 == 0, k=5, **sizes).collect()
        assert sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in got) == want
