"""Key-bucketed tables: upserts that write what changed, versions, late type-2 rows."""

import datetime as dt
import json
import os
import random

import pytest
from pyspark.sql import functions as F

from stratum.operators.scd import scd1_apply, scd2_history
from stratum.sinks import bucketed, writer
from stratum.sources.evolution import common_type, conform, read_mixed
from stratum.streaming import batches

SCHEMA = "k long, g string, v int, ts int, _bucket_no int"


def rows_of(df, cols=None):
    return sorted((tuple(r) for r in (df.select(*cols) if cols else df).collect()), key=str)


def test_random_merges_equal_the_plain_upsert_and_versions_stay_readable(spark, tmp_dir):
    rng = random.Random(1)
    path, plain, seen = os.path.join(tmp_dir, "t"), None, []
    for n in range(9):
        size = 300 if n == 0 else rng.choice((0, 3, 40, 120))
        src = spark.createDataFrame(
            [(rng.choice((None, *range(400))), rng.choice((None, "a", "b")), rng.randrange(99), rng.randrange(50), n)
             for _ in range(size)], SCHEMA)
        bucketed.upsert(path, src, ["k", "g"], ["ts"], n_buckets=4, compact_at=1.0)
        merged = scd1_apply(plain, src, ["k", "g"], ["ts"])
        plain = spark.createDataFrame(merged.collect(), merged.schema)
        cols = plain.columns
        assert rows_of(bucketed.read(spark, path), cols) == rows_of(plain, cols)
        seen.append((bucketed.versions(spark, path)[-1], rows_of(plain, cols)))
    for version, rows in seen:
        assert rows_of(bucketed.read(spark, path, version), cols) == rows
    kinds = {w["kind"] for v, _ in seen for w in bucketed.manifest(spark, path, v)["writes"]}
    assert kinds == {"base", "delta"}


def test_competing_merges_do_not_depend_on_the_order_of_arrival(spark, tmp_dir):
    rng = random.Random(2)
    rows = [(rng.randrange(40), "a", rng.randrange(99), rng.randrange(30), 0) for _ in range(400)]
    want = rows_of(scd1_apply(None, spark.createDataFrame(rows, SCHEMA), ["k"], ["ts"]))
    for turn in range(2):
        rng.shuffle(rows)
        path = os.path.join(tmp_dir, f"t{turn}")
        for at in range(0, 400, 100):
            bucketed.upsert(path, spark.createDataFrame(rows[at:at + 100], SCHEMA), ["k"], ["ts"],
                            compete=True, n_buckets=4)
        assert rows_of(bucketed.read(spark, path)) == want


def test_a_merge_of_one_percent_of_the_keys_writes_two_percent_of_the_bytes_at_most(spark, tmp_dir):
    path = os.path.join(tmp_dir, "t")
    wide = [F.sha2(F.concat(F.col("id"), F.lit(f"-{i}")), 256).alias(f"c{i}") for i in range(8)]
    base = spark.range(200_000).select("id", *wide)
    bucketed.upsert(path, base, ["id"], n_buckets=8)
    change = spark.range(0, 200_000, 100).select("id", *[F.reverse(c).alias(f"c{i}") for i, c in enumerate(wide)])
    bucketed.upsert(path, change, ["id"])
    assert bucketed.bytes_written(spark, path, 2) <= 0.02 * bucketed.bytes_written(spark, path, 1)
    got = bucketed.read(spark, path)
    assert got.count() == 200_000 and got.join(change, ["id", "c0"]).count() == 2000
    # keys of few buckets only: the others are not even read
    assert bucketed.read_keys(spark, path, spark.createDataFrame([(700,), (123_456,), (-5,)], "id long")).count() == 2


def test_deltas_are_rewritten_when_they_outgrow_their_base(spark, tmp_dir):
    path = os.path.join(tmp_dir, "t")
    make = lambda lo, hi, v: spark.range(lo, hi).select("id", F.lit(v).alias("v"))
    bucketed.upsert(path, make(0, 1000, 0), ["id"], n_buckets=4)
    for n in range(1, 8):
        bucketed.upsert(path, make(0, 90, n), ["id"])
        m = bucketed.manifest(spark, path)
        base = bucketed._bytes_by_bucket(m["writes"], "base")
        delta = bucketed._bytes_by_bucket(m["writes"], "delta")
        assert all(delta.get(b, 0) <= bucketed.COMPACT_AT * base[b] for b in base)
    got = bucketed.read(spark, path)
    assert got.count() == 1000 and got.filter("v = 7").count() == 90
    before = {w["id"] for v in bucketed.versions(spark, path)[:-1] for w in bucketed.manifest(spark, path, v)["writes"]}
    now = {w["id"] for w in m["writes"]}
    gone = set(bucketed.vacuum(spark, path, keep=1))  # deltas rewritten at once were never named
    assert before - now <= gone and not gone & now
    assert bucketed.read(spark, path).count() == 1000 and len(bucketed.versions(spark, path)) == 1


def test_many_small_merges_keep_few_folders(spark, tmp_dir, monkeypatch):
    monkeypatch.setattr(bucketed, "MAX_WRITES", 4)
    path = os.path.join(tmp_dir, "t")
    bucketed.upsert(path, spark.range(2000).select("id", F.lit(-1).alias("v")), ["id"], n_buckets=4)
    for n in range(12):
        bucketed.upsert(path, spark.createDataFrame([(n, n)], "id long, v int"), ["id"])
        assert len(bucketed.manifest(spark, path)["writes"]) <= 6
    got = {r.id: r.v for r in bucketed.read(spark, path).collect()}
    assert len(got) == 2000 and all(got[n] == n for n in range(12)) and got[12] == -1


def test_a_second_writer_of_a_version_is_refused(spark, tmp_dir):
    path = os.path.join(tmp_dir, "t")
    bucketed.upsert(path, spark.createDataFrame([(1, 1)], "id long, v int"), ["id"], n_buckets=2)
    m = bucketed.manifest(spark, path)
    with pytest.raises(bucketed.VersionConflict):
        bucketed._publish(spark, path, m)
    with pytest.raises(ValueError):
        bucketed.upsert(path, spark.createDataFrame([(1, 1)], "id long, v int"), ["v"])
    assert bucketed.versions(spark, path) == [1]
    assert not [n for n in os.listdir(f"{path}/_manifests") if n.endswith(".tmp")]


def test_new_columns_and_wider_types(spark, tmp_dir):
    path = os.path.join(tmp_dir, "t")
    bucketed.upsert(path, spark.createDataFrame([(1, 10), (2, 20)], "id int, v int"), ["id"], n_buckets=2)
    bucketed.upsert(path, spark.createDataFrame([(2, 1 << 40, "x"), (3, 5, "y")], "id long, v long, w string"), ["id"])
    got = bucketed.read(spark, path)
    assert dict(got.dtypes) == {"id": "bigint", "v": "bigint", "w": "string"}
    assert rows_of(got) == [(1, 10, None), (2, 1 << 40, "x"), (3, 5, "y")]
    assert rows_of(bucketed.read(spark, path, 1)) == [(1, 10), (2, 20)]


def test_a_folder_of_versions_becomes_a_bucketed_table(spark, tmp_dir):
    path = os.path.join(tmp_dir, "t")
    writer.write_version(spark.createDataFrame([(1, "a"), (2, "b")], "id long, v string"), path)
    writer.write_table(spark.createDataFrame([(2, "c"), (3, "d")], "id long, v string"), path, "merge", merge_keys=["id"])
    assert rows_of(writer.read_versioned(spark, path)) == [(1, "a"), (2, "c"), (3, "d")]


def test_merge_into_a_catalog_name(spark, samples):
    one, two = samples["customers_day1"], samples["customers_day2"]
    for name, first in (("merge_t.fresh", "merge"), ("merge_t.plain", "overwrite")):
        writer.write_table(one, name, first, merge_keys=["customer_id"])
        rec = writer.write_table(two, name, "merge", merge_keys=["customer_id"])
        assert rec["rows"] == 7
        got = spark.table(name)
        assert got.count() == 13 and got.filter("customer_id = 1002").first().email == "carla.morton@yahoo.com"
        assert "merge_t" in [d.name for d in spark.catalog.listDatabases()]
        with pytest.raises(ValueError):
            writer.write_table(two, name, "append")
        more = two.limit(1).withColumn("note", F.lit("n")).withColumn("customer_id", F.lit(5000).cast("bigint"))
        writer.write_table(more, name, "merge", merge_keys=["customer_id"])
        assert spark.table(name).filter("note = 'n'").count() == 1 and spark.table(name).count() == 14


# ------------------------------------------------------------------ type-2 with late rows
EVENT = "user long, kind string, ts timestamp, n int"


def _events(rng, n):
    day = dt.datetime(2024, 1, 1)
    return [(rng.choice((1, 1, 1, 2, 3, 4, None)), rng.choice("ABC"),
             day + dt.timedelta(days=rng.randrange(12), hours=rng.randrange(24)), i) for i in range(n)]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_any_order_of_arrival_gives_the_replayed_history(spark, tmp_dir, seed):
    rng = random.Random(seed)
    rows = _events(rng, 120)
    daily = spark.createDataFrame(rows, EVENT).withColumn("day", F.to_date("ts"))
    want = scd2_history(daily, ["user"], ["kind"], "day", ["ts", "n"])
    sink = batches.scd2_sink(tmp_dir, ["user"], ["kind"], "day", ["ts", "n"], None, F.to_date("ts"), n_buckets=4)
    rng.shuffle(rows)
    for b in range(4):
        batch = spark.createDataFrame(rows[b * 30:b * 30 + 30], EVENT)
        sink(batch, b)
        if b == 2:
            sink(batch, b)  # replayed after a failure
    assert rows_of(batches.read_scd2(spark, tmp_dir), want.columns) == rows_of(want)


def test_a_late_row_splits_and_rejoins_intervals_of_its_key_alone(spark, tmp_dir):
    sink = batches.scd2_sink(tmp_dir, ["user"], ["kind"], "day", ["ts", "n"], None, F.to_date("ts"), n_buckets=4)
    at = lambda d: dt.datetime(2024, 1, d)
    make = lambda rows: spark.createDataFrame(rows, EVENT)

    def spans(user):
        got = batches.read_scd2(spark, tmp_dir).filter(F.col("user") == user).orderBy("effective_start").collect()
        return [(r.kind, r.effective_start.day, r.effective_end and r.effective_end.day, r.is_current) for r in got]

    sink(make([(1, "A", at(1), 1), (1, "C", at(9), 2), (2, "A", at(1), 3)]), 0)
    assert spans(1) == [("A", 1, 9, False), ("C", 9, None, True)]
    sink(make([(1, "B", at(4), 4)]), 1)  # late: splits the first interval
    assert spans(1) == [("A", 1, 4, False), ("B", 4, 9, False), ("C", 9, None, True)]
    sink(make([(1, "A", at(4).replace(hour=5), 5)]), 2)  # the day's later row: joins it again
    assert spans(1) == [("A", 1, 9, False), ("C", 9, None, True)] and spans(2) == [("A", 1, None, True)]
    dimension = batches.scd2_paths(tmp_dir)[1]
    newest = bucketed.manifest(spark, dimension)["writes"][-1]
    assert spark.read.parquet(f"{dimension}/data/w={newest['id']}").select("user").distinct().count() == 1
    with pytest.raises(RuntimeError):
        sink(make([(1, "A", at(1), 1)]), 0)  # another run of the stream


# ----------------------------------------------------------------------- type evolution
def test_folder_of_files_with_other_types_reads_as_one(spark, tmp_dir):
    path = os.path.join(tmp_dir, "t")
    frames = [spark.createDataFrame([(1, 10, "2024-01-01")], "id int, v int, d string").withColumn("d", F.to_date("d")),
              spark.createDataFrame([(1 << 40, 0.5)], "id long, v double"),
              spark.createDataFrame([(3, 7, "late")], "id int, v long, w string"),
              spark.createDataFrame([(4, "text")], "id int, v string")]
    for df in frames[:3]:
        df.write.mode("append").parquet(path)
    got = read_mixed(spark, path)
    assert {n: t for n, t in got.dtypes} == {"id": "bigint", "v": "double", "d": "date", "w": "string"}
    assert rows_of(got, ["id", "v", "w"]) == [(1, 10.0, None), (1 << 40, 0.5, None), (3, 7.0, "late")]
    frames[3].write.mode("append").parquet(path)
    assert dict(writer.read_evolving(spark, path).dtypes)["v"] == "string"
    assert read_mixed(spark, path).filter("id = 4").first().v == "text"


def test_partitioned_folder_with_other_types(spark, tmp_dir):
    path = os.path.join(tmp_dir, "t")
    spark.createDataFrame([(1, 1)], "p int, v int").write.partitionBy("p").parquet(path)
    spark.createDataFrame([(2, 1 << 40)], "p int, v long").write.mode("append").partitionBy("p").parquet(path)
    assert rows_of(read_mixed(spark, path), ["p", "v"]) == [(1, 1), (2, 1 << 40)]


def test_common_types_hold_both():
    from pyspark.sql import types as T

    parse = lambda s: T.StructType.fromDDL(f"x {s}")[0].dataType
    for a, b, want in [("int", "bigint", "bigint"), ("tinyint", "smallint", "smallint"), ("int", "double", "double"),
                       ("float", "float", "float"), ("int", "decimal(5,2)", "decimal(12,2)"),
                       ("decimal(38,0)", "decimal(38,10)", "string"), ("date", "timestamp", "timestamp"),
                       ("boolean", "int", "string"), ("array<int>", "array<bigint>", "array<bigint>"),
                       ("struct<a:int>", "struct<a:bigint,b:string>", "struct<a:bigint,b:string>")]:
        assert common_type(parse(a), parse(b)).simpleString() == want
        assert common_type(parse(b), parse(a)).simpleString() == want


def test_conform_matches_nested_fields_by_name(spark):
    from pyspark.sql import types as T

    df = spark.createDataFrame([((1,), [(2,)]), (None, None)], "s struct<a:int>, l array<struct<a:int>>")
    want = T.StructType.fromDDL("s struct<b:string,a:bigint>, l array<struct<a:double,c:int>>, z int")
    got = conform(df, want)
    assert got.schema.simpleString() == want.simpleString()
    assert json.loads(got.toJSON().first()) == {"s": {"a": 1}, "l": [{"a": 2.0}]}
    assert got.collect()[1].s is None
