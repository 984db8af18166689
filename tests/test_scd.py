"""SCD1 / SCD2 semantics and invariants."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from stratum.operators import scd

KEY = ["k"]
TRACK = ["a"]


def _src(spark, rows):
    return spark.createDataFrame(rows, "k long, a string, b string, seq long")


def _dim(df):
    return sorted((r.k, str(r.a), r.b, str(r.effective_start), str(r.effective_end), r.is_current)
                  for r in df.collect())


def test_latest_per_key_total_order(spark):
    df = _src(spark, [(1, "x", "p", 1), (1, "y", "q", 2), (1, "z", "a", 2), (2, "w", "w", 5)])
    got = sorted((r.k, r.a) for r in scd.latest_per_key(df, KEY, ["seq"]).collect())
    assert got == [(1, "z"), (2, "w")]  # tie on seq=2 broken by the other columns


def test_scd1_latest_wins_and_keeps_absent_keys(spark):
    tgt = scd.scd1_apply(None, _src(spark, [(1, "x", "p", 1), (2, "y", "q", 1)]), KEY, ["seq"])
    src = _src(spark, [(1, "new1", "p", 0), (1, "new2", "p", 3), (3, "n", "n", 1)])
    got = sorted((r.k, r.a) for r in scd.scd1_apply(tgt, src, KEY, ["seq"]).collect())
    assert got == [(1, "new2"), (2, "y"), (3, "n")]
    # compete: an older source row never overwrites a newer target row
    late = _src(spark, [(2, "old", "q", 0)])
    got = {r.k: r.a for r in scd.scd1_apply(tgt, late, KEY, ["seq"], compete=True).collect()}
    assert got[2] == "y"


def test_scd2_classes_and_idempotence(spark):
    base = scd.scd2_initial(_src(spark, [(1, "x", "p", 1), (2, "y", "q", 1), (3, None, "r", 1)]),
                            KEY, "2024-01-01")
    src = _src(spark, [(1, "x", "CHANGED-UNTRACKED", 2), (2, "y2", "q", 2), (3, "v", "r", 2),
                       (4, "n", "n", 2)])
    out = scd.scd2_apply(base, src, KEY, TRACK, "2024-02-01", ["seq"])
    rows = _dim(out)
    assert rows == sorted([
        (1, "x", "p", "2024-01-01", "None", True),             # untracked change: no new version
        (2, "y", "q", "2024-01-01", "2024-02-01", False),      # expired
        (2, "y2", "q", "2024-02-01", "None", True),
        (3, "None", "r", "2024-01-01", "2024-02-01", False),   # null -> value is a change
        (3, "v", "r", "2024-02-01", "None", True),
        (4, "n", "n", "2024-02-01", "None", True),             # new key
    ])
    again = scd.scd2_apply(out, src, KEY, TRACK, "2024-03-01", ["seq"])
    assert _dim(again) == rows  # same source twice: no change
    # at most one current row per key
    cur = again.filter("is_current").groupBy("k").count().filter("count > 1").count()
    assert cur == 0


def test_scd2_null_unsafe_option(spark):
    base = scd.scd2_initial(_src(spark, [(3, None, "r", 1)]), KEY, "2024-01-01")
    src = _src(spark, [(3, "v", "r", 2)])
    out = scd.scd2_apply(base, src, KEY, TRACK, "2024-02-01", ["seq"], null_safe=False)
    assert out.count() == 1


def test_scd2_absent_key_stays_and_expired_key_returns(spark):
    base = scd.scd2_initial(_src(spark, [(1, "x", "p", 1), (2, "y", "q", 1)]), KEY, "2024-01-01")
    step = scd.scd2_apply(base, _src(spark, [(2, "y2", "q", 2)]), KEY, TRACK, "2024-02-01", ["seq"])
    cur = {r.k: r.a for r in step.filter("is_current").collect()}
    assert cur == {1: "x", 2: "y2"}
    # a key whose rows are all expired is inserted as new
    expired_only = step.withColumn("is_current", F.when(F.col("k") == 1, False).otherwise(F.col("is_current")))
    cls = {r.k: r._change for r in scd.scd2_classify(expired_only, _src(spark, [(1, "x", "p", 3)]),
                                                     KEY, TRACK, ["seq"]).collect()}
    assert cls[1] == scd.NEW


def test_scd2_metrics(spark):
    base = scd.scd2_initial(_src(spark, [(1, "x", "p", 1), (2, "y", "q", 1), (3, "z", "z", 1)]),
                            KEY, "2024-01-01")
    src = _src(spark, [(1, "x", "p", 2), (2, "y2", "q", 2), (4, "n", "n", 2)])
    cls = scd.scd2_classify(base, src, KEY, TRACK, ["seq"])
    got = {r._change: r.keys for r in scd.scd2_metrics(cls).collect()}
    assert got == {"unchanged": 1, "changed": 1, "missing": 1, "new": 1}


def test_scd2_history_equals_sequential_apply(spark):
    rows = [
        (1, "a", "1", dt.date(2024, 1, 1)), (1, "a", "2", dt.date(2024, 1, 2)),
        (1, "b", "3", dt.date(2024, 1, 3)), (1, None, "4", dt.date(2024, 1, 5)),
        (2, "x", "5", dt.date(2024, 1, 2)), (2, "y", "6", dt.date(2024, 1, 2)),
        (3, "q", "7", dt.date(2024, 1, 4)), (2, "x", "8", dt.date(2024, 1, 5)),
    ]
    df = spark.createDataFrame(rows, "k long, a string, b string, day date")
    hist = scd.scd2_history(df, KEY, TRACK, "day", ["b"])
    days = sorted({r[3] for r in rows})
    dim = None
    for d in days:
        snap = df.filter(F.col("day") == d).drop("day")
        if dim is None:
            dim = scd.scd2_initial(snap, KEY, d, ["b"])
        else:
            dim = scd.scd2_apply(dim, snap, KEY, TRACK, d, ["b"])
    assert _dim(hist.select(*dim.columns)) == _dim(dim)


def test_scd2_history_requires_null_safe(spark):
    df = spark.createDataFrame([(1, "a", dt.date(2024, 1, 1))], "k long, a string, day date")
    with pytest.raises(ValueError):
        scd.scd2_history(df, KEY, TRACK, "day", null_safe=False)


def test_scd2_table_matches_full_rewrite_and_appends_history(spark, tmp_path):
    from stratum.sinks import scd2_table

    snaps = [
        _src(spark, [(1, "x", "p", 1), (2, "y", "q", 1), (3, "z", "r", 1)]),
        _src(spark, [(1, "x2", "p", 2), (2, "y", "q", 2), (4, "n", "n", 2)]),
        _src(spark, [(1, "x3", "p", 3), (4, "n2", "n", 3)]),
    ]
    days = ["2024-01-01", "2024-01-02", "2024-01-03"]
    path = str(tmp_path / "dim")
    dim = None
    for i, (snap, day) in enumerate(zip(snaps, days), start=1):
        assert scd2_table.apply(spark, path, snap, KEY, TRACK, day, ["seq"]) == i
        dim = scd.scd2_initial(snap, KEY, day, ["seq"]) if dim is None else \
            scd.scd2_apply(dim, snap, KEY, TRACK, day, ["seq"])
        stored = scd2_table.read_dimension(spark, path)
        assert _dim(stored.select(*dim.columns)) == _dim(dim)
    # version 2 is still readable as it was
    v2 = scd2_table.read_dimension(spark, path, 2)
    assert v2.count() == 5 and v2.filter("is_current").count() == 4
    # apply 3 appended only the rows it expired
    h3 = spark.read.parquet(str(tmp_path / "dim" / "history" / "apply=000003"))
    assert sorted(r.k for r in h3.collect()) == [1, 4]
    assert scd2_table.read_current(spark, path).count() == 4


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_scd2_history_equals_sequential_apply_random(spark, seed):
    import random

    rnd = random.Random(seed)
    days = [dt.date(2024, 1, d) for d in range(1, 6)]
    rows = [(rnd.randint(1, 6), rnd.choice(["a", "b", None]), str(i), rnd.choice(days))
            for i in range(40)]
    df = spark.createDataFrame(rows, "k long, a string, b string, day date")
    hist = scd.scd2_history(df, KEY, TRACK, "day", ["b"])
    dim = None
    for d in sorted({r[3] for r in rows}):
        snap = df.filter(F.col("day") == d).drop("day")
        dim = scd.scd2_initial(snap, KEY, d, ["b"]) if dim is None else \
            scd.scd2_apply(dim, snap, KEY, TRACK, d, ["b"])
    assert _dim(hist.select(*dim.columns)) == _dim(dim)


def test_scd2_null_key_is_one_key(spark):
    base = scd.scd2_initial(_src(spark, [(None, "x", "p", 1), (1, "y", "q", 1)]), KEY, "2024-01-01")
    src = _src(spark, [(None, "x", "p", 2), (1, "y", "q", 2)])
    out = scd.scd2_apply(base, src, KEY, TRACK, "2024-02-01", ["seq"])
    out = scd.scd2_apply(out, src, KEY, TRACK, "2024-03-01", ["seq"])
    assert out.count() == 2 and out.filter("k is null and is_current").count() == 1
    changed = scd.scd2_apply(out, _src(spark, [(None, "x2", "p", 3)]), KEY, TRACK, "2024-04-01", ["seq"])
    assert changed.filter("k is null").count() == 2
    assert changed.filter("k is null and is_current").first().a == "x2"


def test_latest_per_key_null_ordering_matches_sql(spark):
    """A null in the ordering column ranks lowest, as ``ORDER BY ts DESC`` does
    in the SQL oracle (nulls last)."""
    import duckdb

    rows = [(1, None, 5), (1, dt.datetime(2024, 1, 2), 1), (2, None, 3), (2, None, 4),
            (3, dt.datetime(2024, 1, 1), 7), (3, dt.datetime(2024, 1, 1), 8)]
    df = spark.createDataFrame(rows, "k long, ts timestamp_ntz, id long")
    got = sorted((r.k, r.id) for r in scd.latest_per_key(df, ["k"], ["ts", "id"]).collect())
    pdf = df.toPandas()  # noqa: F841  (read by duckdb below)
    want = duckdb.sql("""select k, id from (select *, row_number() over (partition by k
                         order by ts desc, id desc) rn from pdf) where rn = 1 order by k""").fetchall()
    assert got == sorted(want) == [(1, 1), (2, 4), (3, 8)]


def test_earliest_per_key(spark):
    df = _src(spark, [(1, "x", "p", 3), (1, "y", "q", 1), (2, "w", "w", 5)])
    got = sorted((r.k, r.a) for r in scd.latest_per_key(df, KEY, ["seq"], latest=False).collect())
    assert got == [(1, "y"), (2, "w")]


def test_scd2_apply_with_a_new_source_column(spark):
    base = scd.scd2_initial(_src(spark, [(1, "x", "p", 1), (2, "y", "q", 1)]), KEY, "2024-01-01")
    src = spark.createDataFrame([(1, "x2", "p", 2, "new"), (2, "y", "q", 2, "n2")],
                                "k long, a string, b string, seq long, extra string")
    out = scd.scd2_apply(base, src, KEY, TRACK, "2024-02-01", ["seq"])
    rows = {(r.k, r.is_current): r.extra for r in out.collect()}
    assert rows == {(1, False): None, (1, True): "new", (2, True): None}


def test_scd2_table_empty_first_snapshot(spark, tmp_path):
    from stratum.sinks import scd2_table

    path = str(tmp_path / "dim")
    empty = _src(spark, [])
    assert scd2_table.apply(spark, path, empty, KEY, TRACK, "2024-01-01", ["seq"]) == 1
    assert scd2_table.read_dimension(spark, path).count() == 0
    scd2_table.apply(spark, path, _src(spark, [(1, "x", "p", 1)]), KEY, TRACK, "2024-01-02", ["seq"])
    dim = scd2_table.read_dimension(spark, path).collect()
    assert [(r.k, r.is_current, str(r.effective_start)) for r in dim] == [(1, True, "2024-01-02")]


def test_scd2_same_day_rerun_never_two_current_rows(spark):
    day = "2024-01-01"
    base = scd.scd2_initial(_src(spark, [(1, "x", "p", 1)]), KEY, day)
    out = scd.scd2_apply(base, _src(spark, [(1, "y", "p", 2)]), KEY, TRACK, day, ["seq"])
    rows = sorted((r.a, str(r.effective_start), str(r.effective_end), r.is_current)
                  for r in out.collect())
    # the first version gets a zero-length interval [day, day); one current row remains
    assert rows == [("x", day, day, False), ("y", day, "None", True)]
