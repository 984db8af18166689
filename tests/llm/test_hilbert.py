import itertools
import re
import zlib

from pyspark.sql import functions as F

from stratum.llm.hilbert import curve_tables, hilbert_index, hilbert_shards


def walk(point, bits, dims):
    digit, follow = curve_tables(dims)
    s = h = 0
    for b in reversed(range(bits)):
        o = sum(((point[i] >> b) & 1) << (dims - 1 - i) for i in range(dims))
        h, s = h * (1 << dims) + digit[s * (1 << dims) + o], follow[s * (1 << dims) + o]
    return h


def test_curve_visits_every_cell_and_steps_to_neighbours():
    for dims, bits in ((2, 4), (3, 3)):
        at = {walk(p, bits, dims): p for p in itertools.product(range(1 << bits), repeat=dims)}
        n = 1 << (bits * dims)
        assert sorted(at) == list(range(n))
        assert all(sum(abs(a - b) for a, b in zip(at[i], at[i + 1])) == 1 for i in range(n - 1))


def test_sql_index_equals_the_walk(lspark):
    points = list(itertools.product(range(0, 16, 3), repeat=3))
    df = lspark.createDataFrame(points, "a int, b int, c int")
    got = df.withColumn("h", hilbert_index([F.col("a"), F.col("b"), F.col("c")], 4)).collect()
    assert all(r.h == walk((r.a, r.b, r.c), 4, 3) for r in got)


def check(df, texts, shards=16):
    rows = hilbert_shards(df, shards).collect()
    assert len(rows) == len(texts)
    counts = {s: 0 for s in range(shards)}
    slots = {}
    for r in rows:
        counts[r.shard] += 1
        slots.setdefault(r.shard, []).append(r.slot)
        assert r.law == "rows" and r.grown_shard is None
    assert max(counts.values()) - min(counts.values()) <= 1
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())
    return rows


def test_shards_under_a_hot_cell_nulls_and_repeated_rows(lspark):
    data = [(i, "same text" if i % 3 == 0 else f"text {i} é" * (i % 40), "en" if i % 2 else None,
             "src0" if i % 3 else None, "x") for i in range(1000)]
    data += [(None, None, None, None, "x"), (None, "", "en", "a", "x"), (5, "dup", "en", "a", "x"),
             (5, "dup", "en", "a", "x"), (6, "z" * 100000, "en", "a", "x")]
    df = lspark.createDataFrame(data, "doc_id long, text string, lang string, source string, shard string")
    rows = check(df, data)
    want = sorted((d[0] or -1, len((d[1] or "").encode()) + 1, zlib.crc32((d[1] or "").encode())) for d in data)
    assert sorted((r.doc_id or -1, r.size, r.text_crc32) for r in rows) == want
    # Shards follow the curve: no cell of a later shard is smaller than one of an earlier shard.
    ordered = sorted(rows, key=lambda r: (r.shard, r.slot))
    assert all(a.curve <= b.curve for a, b in zip(ordered, ordered[1:]))


def test_fewer_rows_than_shards_and_empty_table(lspark):
    schema = "doc_id long, text string, lang string, source string"
    check(lspark.createDataFrame([(1, "a", "en", "s"), (2, "b", "en", "s")], schema), [1, 2])
    assert hilbert_shards(lspark.createDataFrame([], schema)).count() == 0


def test_no_python_in_the_plan(lspark):
    df = lspark.createDataFrame([(1, "a", "en", "s")], "doc_id long, text string, lang string, source string")
    out = hilbert_shards(df)
    assert not re.search("Python|Arrow|Pandas", out._jdf.queryExecution().toString())
