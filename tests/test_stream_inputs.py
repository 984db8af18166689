"""Inferred schemas that are kept, repeated deliveries, quarantine, as-of joins."""

import datetime as dt
import json
import os
import random

import pytest
from pyspark.sql import functions as F

from stratum.operators.asof import asof_join
from stratum.operators.quality import DQFailure, Rule, apply_expectations, counts_of, expect_all
from stratum.operators.scd import scd2_history
from stratum.sinks import quarantine
from stratum.sources.evolution import read_mixed
from stratum.streaming import inferred
from stratum.streaming.dedup import dedup_deliveries, run_deduplicated
from stratum.streaming.ingest import run_available_now, stream_landing


def land(folder, name, lines):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w") as f:
        f.write("".join((x if isinstance(x, str) else json.dumps(x)) + "\n" for x in lines))


def rows_of(df, cols=None):
    return sorted((tuple(r) for r in (df.select(*cols) if cols else df).collect()), key=str)


# --------------------------------------------------------------------- inferred schemas
def test_a_stream_restarts_after_a_column_appears_and_a_type_widens(spark, tmp_dir):
    land_dir, loc, out = (os.path.join(tmp_dir, x) for x in ("in", "schema", "out"))

    def run():
        src = inferred.stream_inferred(spark, land_dir, "json", loc, lineage=True)
        return run_available_now(src, os.path.join(tmp_dir, "ck"), out)

    land(land_dir, "a.json", [{"id": 1, "v": 10}, {"id": 2, "v": None}])
    run()
    assert inferred.schema_versions(spark, loc) == [1]
    run()  # nothing new: same version
    assert inferred.schema_versions(spark, loc) == [1]
    land(land_dir, "b.json", [{"id": 3, "v": 0.5, "w": "new", "s": {"a": 1}}])
    run()
    assert inferred.stored_schema(spark, loc).simpleString() == "struct<id:bigint,v:double,s:struct<a:bigint>,w:string>"
    assert inferred.stored_schema(spark, loc, 1).simpleString() == "struct<id:bigint,v:bigint>"
    got = read_mixed(spark, out)
    assert rows_of(got, ["id", "v", "w", "s.a"]) == [(1, 10.0, None, None), (2, None, None, None), (3, 0.5, "new", 1)]
    assert got.filter("_source_file = 'b.json'").count() == 1 and got.filter(inferred.RESCUED + " is not null").count() == 0
    # the same rows as one batch read with the final schema
    batch = spark.read.schema(inferred.stored_schema(spark, loc)).json(land_dir)
    assert rows_of(got, ["id", "v", "w"]) == rows_of(batch, ["id", "v", "w"])


def test_what_the_schema_does_not_know_is_rescued(spark, tmp_dir):
    land_dir, loc, out = (os.path.join(tmp_dir, x) for x in ("in", "schema", "out"))
    land(land_dir, "a.json", [{"id": 1, "v": 10}])
    src = inferred.stream_inferred(spark, land_dir, "json", loc)
    # these files arrive after the schema was fixed, before the stream reads them
    land(land_dir, "b.json", [{"id": 2, "v": 20, "extra": [1, 2]}, {"id": "x9", "v": 3}, "{broken", {"v": 1}])
    run_available_now(src, os.path.join(tmp_dir, "ck"), out)
    got = {(r.id, r.v, r[inferred.RESCUED]) for r in spark.read.parquet(out).collect()}
    assert got == {(1, 10, None), (2, 20, '{"extra":"[1,2]"}'), (None, 3, '{"id":"x9"}'), (None, None, "{broken"),
                   (None, 1, None)}


def test_csv_columns_may_come_at_the_end_and_nowhere_else(spark, tmp_dir):
    land_dir, loc, out = (os.path.join(tmp_dir, x) for x in ("in", "schema", "out"))

    def run():
        return run_available_now(inferred.stream_inferred(spark, land_dir, "csv", loc), os.path.join(tmp_dir, "ck"), out)

    land(land_dir, "a.csv", ["id,v", "1,10", "2,"])
    run()
    land(land_dir, "b.csv", ["id,v,w", "3,4.5,x"])
    run()
    assert inferred.stored_schema(spark, loc).simpleString() == "struct<id:int,v:double,w:string>"
    assert rows_of(read_mixed(spark, out), ["id", "v", "w"]) == [(1, 10.0, None), (2, None, None), (3, 4.5, "x")]
    land(land_dir, "c.csv", ["v,id", "1,2"])
    with pytest.raises(ValueError):
        run()


def test_nothing_to_infer_from(spark, tmp_dir):
    os.makedirs(os.path.join(tmp_dir, "in"))
    for fmt in ("json", "csv"):
        with pytest.raises(ValueError):
            inferred.stream_inferred(spark, os.path.join(tmp_dir, "in"), fmt, os.path.join(tmp_dir, "s"))
    with pytest.raises(ValueError):
        inferred.stream_inferred(spark, tmp_dir, "xml", tmp_dir)


# ------------------------------------------------------------------- repeated deliveries
def test_a_redelivered_file_adds_nothing_and_late_rows_are_counted(spark, tmp_dir):
    land_dir, out = os.path.join(tmp_dir, "in"), os.path.join(tmp_dir, "out")
    schema = spark.createDataFrame([], "id long, ts timestamp, v string").schema
    row = lambda i, day, v="a": {"id": i, "ts": f"2024-01-{day:02d}T00:00:00.000000Z", "v": v}

    def run():
        stream = stream_landing(spark, land_dir, "json", schema, 1)
        return run_deduplicated(dedup_deliveries(stream, ["id"], "ts", "3 days"), os.path.join(tmp_dir, "ck"), out)

    first = [row(1, 1), row(2, 2), row(2, 2, "copy"), {"id": None, "ts": "2024-01-02T00:00:00.000000Z", "v": "n"},
             {"id": None, "ts": "2024-01-02T00:00:00.000000Z", "v": "n2"}, {"id": 7, "ts": None, "v": "untimed"}]
    land(land_dir, "a.json", first)
    run()
    assert spark.read.parquet(out).count() == 4
    land(land_dir, "a-again.json", first)
    got = run()
    assert got.duplicates == 5 and got.late == 0
    assert spark.read.parquet(out).count() == 5  # the row without a time passes again
    land(land_dir, "b.json", [row(3, 20)])
    run()
    land(land_dir, "c.json", [row(4, 21), row(5, 1, "late")])
    got = run()
    assert got.late == 1 and {r.id for r in spark.read.parquet(out).collect()} == {None, 1, 2, 3, 4, 7}


# ----------------------------------------------------------------------------- quarantine
RULES = [Rule("id_there", "id is not null", "fail"), Rule("pos", "v > 0", "drop"),
         Rule("small", "v < 100", "drop"), Rule("named", "n <> ''", "warn")]
ROWS = [(1, 5, "a"), (2, -5, ""), (3, 500, "c"), (4, None, None), (5, -1, "e"), (6, 7, "")]


@pytest.mark.parametrize("on_null", ["drop", "keep"])
def test_clean_and_rejected_rows_are_the_input_and_agree_with_the_report(spark, tmp_dir, on_null):
    df = spark.createDataFrame(ROWS, "id long, v int, n string")
    path, bad = os.path.join(tmp_dir, "s", "t"), os.path.join(tmp_dir, "s", "t_rejected")
    reports = []
    rec = quarantine.write_quarantined(df, RULES, "t", path, bad, on_null=on_null, run_time="r",
                                       report_sink=lambda r: reports.extend(r.collect()))
    clean, rejected = spark.read.parquet(path), quarantine.read_rejected(spark, bad)
    assert rows_of(clean, df.columns) == rows_of(apply_expectations(df, RULES, on_null))
    assert rows_of(clean.select(*df.columns).unionByName(rejected.select(*df.columns))) == rows_of(df)
    assert (rec["rows"], rec["rejected"], rec["status"]) == (clean.count(), rejected.count(), "WARN")
    want = counts_of(expect_all(df, RULES).first(), RULES)
    assert {r.rule_name: (r.pass_count, r.fail_count, r.null_count) for r in reports} == want
    named = clean.unionByName(rejected.drop("run")).select(F.explode(quarantine.FAILED).alias("rule")).groupBy(
        "rule").count().collect()
    add = 0 if on_null == "keep" else 1
    assert {r.rule: r["count"] for r in named} == {n: f + add * k for n, (_, f, k) in want.items() if f + add * k}
    why = {r.id: r[quarantine.FAILED] for r in rejected.collect()}
    assert why[2] == ["pos", "named"] and why[3] == ["small"]
    assert not [n for n in os.listdir(os.path.join(tmp_dir, "s", "_staging"))]
    # another run appends its rejects
    quarantine.write_quarantined(df, RULES, "t", path, bad, on_null=on_null)
    assert quarantine.read_rejected(spark, bad).count() == 2 * rec["rejected"]


def test_a_fail_rule_publishes_nothing_and_all_rows_may_be_rejected(spark, tmp_dir):
    path, bad = os.path.join(tmp_dir, "s", "t"), os.path.join(tmp_dir, "s", "bad")
    df = spark.createDataFrame([(None, 1, "x")], "id long, v int, n string")
    reports = []
    with pytest.raises(DQFailure):
        quarantine.write_quarantined(df, RULES, "t", path, bad, report_sink=lambda r: reports.extend(r.collect()))
    assert not os.path.exists(path) and quarantine.read_rejected(spark, bad) is None and len(reports) == 1
    df = spark.createDataFrame([(1, -1, "x")], "id long, v int, n string")
    assert quarantine.write_quarantined(df, RULES, "t", path, bad)["rows"] == 0
    assert spark.read.parquet(path).count() == 0 and quarantine.read_rejected(spark, bad).count() == 1
    assert quarantine.write_quarantined(df.limit(0), RULES, "t", path, bad)["rejected"] == 0
    with pytest.raises(ValueError):
        quarantine.failed_mask([Rule(f"r{i}", "true") for i in range(64)])


# ------------------------------------------------------------------------------ as-of join
@pytest.mark.parametrize("bucket_days", [1, 7, 1000])
def test_every_fact_meets_the_version_valid_on_its_date(spark, bucket_days):
    rng = random.Random(bucket_days)
    day = lambda n: dt.date(2024, 1, 1) + dt.timedelta(days=n)
    snaps = [(rng.choice((1, 1, 1, 2, None)), day(rng.randrange(5, 60)), rng.choice("ABC")) for _ in range(60)]
    history = scd2_history(spark.createDataFrame(snaps, "k long, day date, v string"), ["k"], ["v"], "day")
    facts = [(rng.choice((1, 1, 1, 2, 3, None)), rng.choice((None, day(rng.randrange(90)))), i) for i in range(300)]
    versions = [r.asDict() for r in history.collect()]
    want = []
    for k, d, i in facts:
        met = [v["v"] for v in versions if d and v["k"] == k and v["effective_start"] <= d
               and (v["effective_end"] is None or d < v["effective_end"])]
        assert len(met) <= 1
        want.append((k, d, i, met[0] if met else None))
    frame = spark.createDataFrame(facts, "k long, d date, i int")
    got = asof_join(frame, history, ["k"], "d", bucket_days=bucket_days)
    assert got.columns == ["k", "d", "i", "v"] and rows_of(got) == sorted(want, key=str)
    inner = asof_join(frame, history, ["k"], "d", bucket_days=bucket_days, how="inner", prefix="dim_")
    assert rows_of(inner) == sorted((w for w in want if w[3]), key=str)


def test_a_hot_customer_is_spread_over_date_ranges(spark):
    facts = spark.range(3000).select(F.lit(1).alias("k"), F.date_add(F.lit("2024-01-01").cast("date"),
                                                                     (F.col("id") % 300).cast("int")).alias("d"))
    history = spark.createDataFrame([(1, dt.date(2020, 1, 1), None, True, "x")],
                                    "k int, effective_start date, effective_end date, is_current boolean, v string")
    got = asof_join(facts, history, ["k"], "d", bucket_days=10)
    assert got.count() == 3000 and got.filter("v = 'x'").count() == 3000
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "__bucket" in plan and "__in" in plan  # the range is part of the equi-join


def test_as_of_join_without_facts_or_history_and_with_clashing_names(spark):
    history = spark.createDataFrame([(1, dt.date(2020, 1, 1), None, True, "x")],
                                    "k int, effective_start date, effective_end date, is_current boolean, v string")
    facts = spark.createDataFrame([(1, None), (2, dt.date(2021, 1, 1))], "k int, d date")
    assert rows_of(asof_join(facts, history.limit(0), ["k"], "d")) == [(1, None, None), (2, dt.date(2021, 1, 1), None)]
    assert asof_join(facts.limit(0), history, ["k"], "d").count() == 0
    with pytest.raises(ValueError):
        asof_join(facts.withColumn("V", F.lit(1)), history, ["k"], "d")
