"""Landing scans, writers, and availableNow streams."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from stratum.schemas import ADDRESSES_RAW, CUSTOMERS_RAW
from stratum.sinks import writer
from stratum.sources.landing import read_landing, with_lineage, write_landing
from stratum.streaming import batches
from stratum.streaming.ingest import run_available_now, stream_landing


def test_csv_roundtrip_keeps_text_postcodes_and_blanks(spark, samples, tmp_dir):
    path = os.path.join(tmp_dir, "addresses")
    df = samples["addresses_day1"].withColumn(
        "city", F.when(F.col("customer_id") == 1001, F.lit("  ")).otherwise(F.col("city")))
    write_landing(df, path, "csv", files=2)
    back = read_landing(spark, path, "csv", ADDRESSES_RAW)
    got = {r.customer_id: (r.city, r.postcode, r.state) for r in back.collect()}
    assert got[1006] == ("Lake David", "06133", None)
    assert got[1001][0] == "  "
    assert back.count() == 10


def test_json_lineage(spark, samples, tmp_dir):
    path = os.path.join(tmp_dir, "customers")
    write_landing(samples["customers_day1"], path, "json", files=3)
    df = with_lineage(read_landing(spark, path, "json", CUSTOMERS_RAW))
    rows = df.collect()
    assert len(rows) == 10
    assert all(r._source_file and r._source_file.endswith(".json") for r in rows)
    assert len({r._ingested_at for r in rows}) == 1


def test_read_landing_requires_schema_or_infer(spark, tmp_dir):
    with pytest.raises(ValueError):
        read_landing(spark, tmp_dir, "json")


def test_write_modes_and_metrics(spark, samples, tmp_dir):
    path = os.path.join(tmp_dir, "t")
    with pytest.raises(ValueError):
        writer.write_table(samples["customers_day1"], path, "upsert")
    with pytest.raises(ValueError):
        writer.write_table(samples["customers_day1"], path, "merge")
    rec = writer.write_table(samples["customers_day1"], path, "overwrite", layer="bronze")
    assert (rec["status"], rec["rows"]) == ("PASS", 10)
    rec = writer.write_table(samples["customers_day2"], path, "append")
    assert rec["rows"] == 7 and spark.read.parquet(path).count() == 17
    m = writer.metrics_frame(spark, [rec]).first()
    assert m.rows == 7 and m.mode == "append"


def test_merge_mode_is_versioned_upsert(spark, samples, tmp_dir):
    path = os.path.join(tmp_dir, "dim")
    writer.write_table(samples["customers_day1"], path, "merge", merge_keys=["customer_id"])
    writer.write_table(samples["customers_day2"], path, "merge", merge_keys=["customer_id"])
    assert writer.versions(spark, path) == [1, 2]
    dim = writer.read_versioned(spark, path)
    assert dim.count() == 13
    assert writer.read_versioned(spark, path, 1).count() == 10
    assert dim.filter("customer_id = 1002").first().email == "carla.morton@yahoo.com"


def test_schema_evolution_on_append(spark, tmp_dir):
    path = os.path.join(tmp_dir, "evo")
    spark.createDataFrame([(1, "a")], "id long, x string").write.parquet(path)
    spark.createDataFrame([(2, "b", 3.5)], "id long, x string, y double").write.mode("append").parquet(path)
    got = sorted(tuple(r) for r in writer.read_evolving(spark, path).select("id", "x", "y").collect())
    assert got == [(1, "a", None), (2, "b", 3.5)]
    ev = writer.evolve(spark.createDataFrame([(1,)], "id long"),
                       spark.createDataFrame([(2, "z")], "id long, w string"))
    assert sorted(tuple(r) for r in ev.collect()) == [(1, None), (2, "z")]


def test_stream_runs_only_new_files(spark, samples, tmp_dir):
    land = os.path.join(tmp_dir, "landing")
    os.makedirs(land)
    samples["customers_day1"].coalesce(1).write.json(os.path.join(land, "day1"))
    ck, out = os.path.join(tmp_dir, "ck"), os.path.join(tmp_dir, "out")

    def run():
        src = stream_landing(spark, os.path.join(land, "*"), "json", CUSTOMERS_RAW, 1)
        run_available_now(src, ck, out)
        return spark.read.parquet(out).count()

    assert run() == 10
    assert run() == 10  # no new file: nothing added
    samples["customers_day2"].coalesce(1).write.json(os.path.join(land, "day2"))
    assert run() == 17  # only the new file's rows


def test_stream_scd1_matches_batch(spark, samples, tmp_dir):
    from stratum.operators.scd import scd1_apply

    land = os.path.join(tmp_dir, "landing")
    samples["customers_day2"].coalesce(1).write.json(os.path.join(land, "a"))
    samples["customers_day1"].coalesce(1).write.json(os.path.join(land, "b"))
    src = stream_landing(spark, os.path.join(land, "*"), "json", CUSTOMERS_RAW, 1)
    dim = os.path.join(tmp_dir, "dim")
    run_available_now(src, os.path.join(tmp_dir, "ck"),
                      foreach_batch=batches.scd1_sink(dim, ["customer_id"], ["created_date"]))
    streamed = sorted(tuple(r) for r in writer.read_versioned(spark, dim).collect())
    both = samples["customers_day1"].unionByName(samples["customers_day2"])
    batch = sorted(tuple(r) for r in scd1_apply(None, both, ["customer_id"], ["created_date"]).collect())
    assert streamed == batch  # batch order does not matter with compete=True


def test_stream_dq_sink_one_pass_and_fail(spark, tmp_dir):
    from stratum.operators.quality import DQFailure, Rule

    land = os.path.join(tmp_dir, "landing")
    spark.createDataFrame([(1, "a"), (2, None), (3, "c")], "id long, s string") \
        .coalesce(1).write.json(os.path.join(land, "f1"))
    rules = [Rule("s_not_null", F.col("s").isNotNull(), "drop"), Rule("id_pos", "id > 0", "warn")]
    clean, report = os.path.join(tmp_dir, "clean"), os.path.join(tmp_dir, "report")
    src = stream_landing(spark, os.path.join(land, "*"), "json",
                         spark.createDataFrame([], "id long, s string").schema)
    run_available_now(src, os.path.join(tmp_dir, "ck"),
                      foreach_batch=batches.dq_sink(rules, "t", clean, report))
    assert sorted(r.id for r in spark.read.parquet(clean).collect()) == [1, 3]
    rep = {r.rule_name: (r.pass_count, r.fail_count) for r in spark.read.parquet(report).collect()}
    assert rep == {"s_not_null": (2, 1), "id_pos": (3, 0)}

    # a failing "fail" rule publishes nothing and stops the stream
    fail_rules = [Rule("id_small", F.col("id") < 3, "fail")]
    clean2 = os.path.join(tmp_dir, "clean2")
    src = stream_landing(spark, os.path.join(land, "*"), "json",
                         spark.createDataFrame([], "id long, s string").schema)
    with pytest.raises(Exception) as ei:
        run_available_now(src, os.path.join(tmp_dir, "ck2"),
                          foreach_batch=batches.dq_sink(fail_rules, "t", clean2,
                                                        os.path.join(tmp_dir, "report2")))
    assert "id_small" in str(ei.value)
    assert not any(n.startswith("batch_id=") for n in os.listdir(clean2))


def test_catalog_tables(spark, samples):
    from stratum.sources.catalog import list_tables, table_exists

    rec = writer.write_table(samples["customers_day1"], "bronze_t.customers", "overwrite")
    assert rec["rows"] == 10
    assert table_exists(spark, "bronze_t.customers")
    assert "customers" in list_tables(spark, "bronze_t")
    writer.write_table(samples["customers_day2"], "bronze_t.customers", "append")
    assert spark.table("bronze_t.customers").count() == 17
    with pytest.raises(ValueError):
        writer.write_table(samples["customers_day2"], "bronze_t.customers", "merge")


def test_write_checked_one_pass_and_fail(spark, tmp_dir):
    from stratum.operators.quality import DQFailure, Rule

    df = spark.createDataFrame([(1, "a"), (2, None), (3, "c")], "id long, s string")
    reports = []
    path = os.path.join(tmp_dir, "silver", "t")
    rec = writer.write_checked(df, [Rule("s_nn", F.col("s").isNotNull(), "drop"),
                                    Rule("id_pos", "id > 0", "fail")], "t", path,
                               report_sink=lambda r: reports.append(r.collect()))
    assert rec["rows"] == 2 and spark.read.parquet(path).count() == 2
    assert {r.rule_name: r.fail_count for r in reports[0]} == {"s_nn": 1, "id_pos": 0}
    with pytest.raises(DQFailure):
        writer.write_checked(df, [Rule("id_small", F.col("id") < 3, "fail")], "t", path)
    assert spark.read.parquet(path).count() == 2  # the earlier table is untouched


def test_bronze_stream_ingest_day_counts(spark, samples, tmp_dir):
    """The original suite's expectation: 12 / 10 / 10 rows after day 1."""
    from stratum.schemas import ORDERS_RAW
    from stratum.streaming.ingest import ingest_entities

    land = os.path.join(tmp_dir, "landing")
    day1 = samples["orders"].filter("order_id <= 12")
    day2 = samples["orders"].filter("order_id > 12")
    write_landing(day1, f"{land}/orders/day1", "json", files=1)
    write_landing(samples["customers_day1"], f"{land}/customers/day1", "json", files=1)
    write_landing(samples["addresses_day1"], f"{land}/addresses/day1", "csv", files=1)
    sources = {
        "orders_raw": (f"{land}/orders/*", "json", ORDERS_RAW),
        "customers_raw": (f"{land}/customers/*", "json", CUSTOMERS_RAW),
        "addresses_raw": (f"{land}/addresses/*", "csv", ADDRESSES_RAW),
    }
    bronze, ck = os.path.join(tmp_dir, "bronze"), os.path.join(tmp_dir, "ck")

    def counts():
        tables = ingest_entities(spark, sources, bronze, ck)
        return {n: spark.read.parquet(p).count() for n, p in tables.items()}

    assert counts() == {"orders_raw": 12, "customers_raw": 10, "addresses_raw": 10}
    write_landing(day2, f"{land}/orders/day2", "json", files=1)
    write_landing(samples["customers_day2"], f"{land}/customers/day2", "json", files=1)
    write_landing(samples["addresses_day2"], f"{land}/addresses/day2", "csv", files=1)
    assert counts() == {"orders_raw": 16, "customers_raw": 17, "addresses_raw": 16}
    assert counts() == {"orders_raw": 16, "customers_raw": 17, "addresses_raw": 16}
    src = spark.read.parquet(f"{bronze}/addresses_raw").filter("customer_id = 1006").collect()
    assert sorted(r.postcode for r in src) == ["02638", "06133"]  # text postcodes survive


def test_write_checked_reference_null_policy(spark, tmp_dir):
    from stratum.operators.quality import Rule

    df = spark.createDataFrame([(1,), (None,), (5,)], "id long")
    p1, p2 = os.path.join(tmp_dir, "a", "t"), os.path.join(tmp_dir, "b", "t")
    # a true failure exists: NULL-condition rows go too
    writer.write_checked(df, [Rule("small", F.col("id") < 3, "drop")], "t", p1, on_null="reference")
    assert sorted(r.id for r in spark.read.parquet(p1).collect()) == [1]
    # no true failure: nothing is dropped, not even the NULL-condition row
    writer.write_checked(df, [Rule("pos", F.col("id") > 0, "drop")], "t", p2, on_null="reference")
    assert spark.read.parquet(p2).count() == 3


def test_foreach_batch_sinks_are_idempotent_on_replay(spark, samples, tmp_dir):
    """A micro-batch replayed after a failure (same batch_id) leaves the same result."""
    from stratum.operators.quality import Rule

    batch = samples["customers_day1"]
    dim = os.path.join(tmp_dir, "dim")
    sink = batches.scd1_sink(dim, ["customer_id"], ["created_date"])
    sink(batch, 0)
    sink(samples["customers_day2"], 1)
    first = sorted(tuple(r) for r in writer.read_versioned(spark, dim).collect())
    sink(samples["customers_day2"], 1)  # replay of batch 1
    assert sorted(tuple(r) for r in writer.read_versioned(spark, dim).collect()) == first
    assert writer.versions(spark, dim) == [1, 2]

    clean, report = os.path.join(tmp_dir, "clean"), os.path.join(tmp_dir, "report")
    dq = batches.dq_sink([Rule("has_email", F.col("email").isNotNull(), "drop")], "c", clean, report)
    dq(batch, 0)
    dq(batch, 0)  # replay
    assert spark.read.parquet(clean).count() == 7
    assert spark.read.parquet(report).count() == 1


def test_scd2_table_retry_of_an_apply(spark, samples, tmp_dir):
    from stratum.operators.silver import clean_addresses
    from stratum.sinks import scd2_table

    path = os.path.join(tmp_dir, "dim")
    track = ["address_line_1", "city", "state", "postcode"]
    a1, a2 = clean_addresses(samples["addresses_day1"]), clean_addresses(samples["addresses_day2"])
    scd2_table.apply(spark, path, a1, ["customer_id"], track, "2024-10-01")
    scd2_table.apply(spark, path, a2, ["customer_id"], track, "2025-01-14")
    once = sorted(map(str, scd2_table.read_dimension(spark, path).collect()))
    scd2_table.apply(spark, path, a2, ["customer_id"], track, "2025-01-14", version=2)  # retry
    assert sorted(map(str, scd2_table.read_dimension(spark, path).collect())) == once
    assert len(once) == 16


def test_write_checked_empty_input(spark, tmp_dir):
    from stratum.operators.quality import Rule

    df = spark.createDataFrame([], "id long")
    reports = []
    rec = writer.write_checked(df, [Rule("pos", "id > 0", "fail")], "t",
                               os.path.join(tmp_dir, "s", "t"),
                               report_sink=lambda r: reports.append(r.collect()))
    assert rec["rows"] == 0
    r = reports[0][0]
    assert (r.pass_count, r.fail_count, r.pass_rate) == (0, 0, 100.0)


def test_landing_rescues_malformed_records(spark, tmp_dir):
    from stratum.operators.quality import Rule, dq_report

    land = os.path.join(tmp_dir, "landing")
    os.makedirs(land)
    with open(os.path.join(land, "part-0.json"), "w") as f:
        f.write('{"customer_id": 1, "customer_name": "A"}\n{"customer_id": oops\n'
                '{"customer_id": 3, "customer_name": "C"}\n')
    df = read_landing(spark, land, "json", CUSTOMERS_RAW, rescue_col="_rescued")
    rows = sorted(df.collect(), key=lambda r: str(r.customer_id))
    bad = [r for r in rows if r._rescued is not None]
    assert len(rows) == 3 and len(bad) == 1 and "oops" in bad[0]._rescued
    bronze = os.path.join(tmp_dir, "bronze")
    df.write.parquet(bronze)  # rules run on the written bronze table
    rep = dq_report(spark.read.parquet(bronze), [Rule("parsed", "_rescued is null", "warn")],
                    "bronze").first()
    assert (rep.pass_count, rep.fail_count) == (2, 1)


def test_stream_dq_k_batches_equal_one_batch(spark, samples, tmp_dir):
    from stratum.operators.quality import dq_report
    from stratum.operators.silver import clean_orders
    from stratum.plans.rules import order_rules
    from stratum.schemas import ORDERS_RAW

    land = os.path.join(tmp_dir, "landing")
    write_landing(samples["orders"], os.path.join(land, "orders"), "json", files=4)
    outs = {}
    for k in (1, None):  # one file per micro-batch, then everything in one batch
        root = os.path.join(tmp_dir, f"run-{k}")
        src = stream_landing(spark, os.path.join(land, "orders"), "json", ORDERS_RAW, k)
        run_available_now(src, f"{root}/ck", foreach_batch=batches.dq_sink(
            order_rules(), "silver_orders", f"{root}/clean", f"{root}/report",
            transform=clean_orders, run_time="r"))
        clean = sorted((r.order_id, r.item_id) for r in spark.read.parquet(f"{root}/clean").collect())
        rep = spark.read.parquet(f"{root}/report").groupBy("rule_name").agg(
            F.sum("pass_count").alias("p"), F.sum("fail_count").alias("f"))
        outs[k] = (clean, sorted(tuple(r) for r in rep.collect()),
                   spark.read.parquet(f"{root}/report").select("batch_id").distinct().count())
    assert outs[1][0] == outs[None][0] and outs[1][1] == outs[None][1]
    assert outs[1][2] == 4 and outs[None][2] == 1
    batch = {r.rule_name: (r.pass_count, r.fail_count) for r in
             dq_report(clean_orders(samples["orders"]), order_rules(), "t").collect()}
    assert {n: (p, f) for n, p, f in outs[1][1]} == batch


def test_partitioned_plain_write(spark, samples, tmp_dir):
    path = os.path.join(tmp_dir, "by_date")
    rec = writer.write_table(samples["customers_day1"].unionByName(samples["customers_day2"]),
                             path, "overwrite", partition_by=["created_date"])
    assert rec["rows"] == 17
    assert sorted(os.path.basename(p) for p in os.listdir(path) if p.startswith("created_date=")) == \
        ["created_date=2024-10-01", "created_date=2025-01-14"]
    assert spark.read.parquet(path).filter("created_date = '2025-01-14'").count() == 7


def test_scd1_sink_refuses_a_foreign_table_folder(spark, samples, tmp_dir):
    dim = os.path.join(tmp_dir, "dim")
    sink = batches.scd1_sink(dim, ["customer_id"], ["created_date"])
    for b in range(3):
        sink(samples["customers_day1"], b)
    with pytest.raises(RuntimeError):
        sink(samples["customers_day2"], 0)  # a new stream (batch 0) over the old folder


def test_dq_sink_refuses_a_foreign_output_folder(spark, samples, tmp_dir):
    from stratum.operators.quality import Rule

    clean, report = os.path.join(tmp_dir, "clean"), os.path.join(tmp_dir, "report")
    sink = batches.dq_sink([Rule("ok", "true")], "c", clean, report)
    sink(samples["customers_day1"], 0)
    sink(samples["customers_day1"], 1)
    sink(samples["customers_day1"], 1)  # a replay of the last batch is fine
    with pytest.raises(RuntimeError):
        sink(samples["customers_day2"], 0)


def test_multiline_json_and_table_names(spark, tmp_dir):
    from stratum.sources.catalog import is_table_name

    land = os.path.join(tmp_dir, "ml")
    os.makedirs(land)
    with open(os.path.join(land, "a.json"), "w") as f:
        f.write('[{"customer_id": 1,\n  "customer_name": "A"},\n {"customer_id": 2}]\n')
    df = read_landing(spark, land, "json", CUSTOMERS_RAW, multiline=True)
    assert sorted(r.customer_id for r in df.collect()) == [1, 2]
    assert is_table_name("bronze.orders") and is_table_name("orders")
    assert not is_table_name("/wh/bronze/orders") and not is_table_name("s3://b/wh")
