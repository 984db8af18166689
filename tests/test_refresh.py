"""Full refresh over two landing days (the original workflow)."""

from __future__ import annotations

import os

from pyspark.sql import functions as F

from stratum.plans.refresh import Refresh, full_refresh
from stratum.sinks import writer
from stratum.sources.landing import write_landing


def _land(samples, root, day):
    suffix = "day1" if day == 1 else "day2"
    orders = samples["orders"].filter("order_id <= 12" if day == 1 else "order_id > 12")
    write_landing(orders, f"{root}/orders/{suffix}", "json", files=1)
    write_landing(samples[f"customers_{suffix}"], f"{root}/customers/{suffix}", "json", files=1)
    write_landing(samples[f"addresses_{suffix}"], f"{root}/addresses/{suffix}", "csv", files=1)


def test_two_day_refresh(spark, samples, tmp_dir):
    landing, wh = os.path.join(tmp_dir, "landing"), os.path.join(tmp_dir, "wh")
    _land(samples, landing, 1)
    m1 = {r.table_name: r.rows for r in full_refresh(
        spark, Refresh(landing, wh, as_of="2024-10-01", run_time="r1")).collect()}
    assert m1["orders"] == 12 and m1["customers"] == 10 and m1["addresses"] == 10
    assert m1["dim_addresses"] == 10 and m1["dim_customers"] == 10

    _land(samples, landing, 2)
    m2 = {(r.layer, r.table_name): r.rows for r in full_refresh(
        spark, Refresh(landing, wh, as_of="2025-01-14", run_time="r2")).collect()}
    assert m2[("bronze", "orders")] == 16 and m2[("silver", "orders")] == 16
    assert m2[("silver", "dim_customers")] == 17  # source rows merged, as logged
    assert writer.read_versioned(spark, f"{wh}/silver/dim_customers").count() == 13
    from stratum.sinks import scd2_table

    dim = scd2_table.read_dimension(spark, f"{wh}/silver/dim_addresses")
    assert dim.count() == 16 and dim.filter("is_current").count() == 13
    assert sorted(r.customer_id for r in dim.filter("not is_current").collect()) == [1001, 1004, 1006]

    summary = spark.read.parquet(f"{wh}/gold/customer_order_summary")
    assert summary.count() == 11  # one current dimension row per key: no fan-out
    rev = spark.read.parquet(f"{wh}/gold/revenue_by_day")
    assert round(sum(r.total_revenue for r in rev.collect()), 2) == 9869.0
    rep = spark.read.parquet(f"{wh}/gold/dq_report")
    assert {r.run_time for r in rep.collect()} == {"r1", "r2"}
    latest = {(r.table_name, r.rule_name): (r.pass_count, r.fail_count)
              for r in rep.filter("run_time = 'r2'").collect()}
    assert latest[("silver_orders", "valid_order_status")] == (16, 2)
    assert latest[("silver_addresses", "valid_state_format")] == (12, 4)
    assert spark.read.parquet(f"{wh}/_metrics").count() == 2 * len(m2)


def test_refresh_stops_on_fail_rule(spark, samples, tmp_dir):
    import pytest
    from pyspark.sql import functions as F

    from stratum.operators.quality import DQFailure
    from stratum.schemas import ORDERS_RAW

    landing, wh = os.path.join(tmp_dir, "landing"), os.path.join(tmp_dir, "wh")
    _land(samples, landing, 1)
    item = dict(item_id=1, name="x", category="y", price=1.0, quantity=1)
    bad = spark.createDataFrame([(None, 1001, "2024-10-01 00:00:00", "PayPal", [item], "Pending")],
                                ORDERS_RAW)
    write_landing(bad, f"{landing}/orders/bad", "json", files=1)
    with pytest.raises(DQFailure):
        full_refresh(spark, Refresh(landing, wh, as_of="2024-10-01", run_time="r1"))
    m = spark.read.parquet(f"{wh}/_metrics")
    failed = m.filter(F.col("status") == "FAIL").collect()
    assert [(r.layer, r.table_name) for r in failed] == [("silver", "orders")]
    assert not os.path.exists(f"{wh}/silver/orders")  # nothing published
    rep = spark.read.parquet(f"{wh}/gold/dq_report").collect()
    assert [r.rule_name for r in rep] == ["order_id_not_null"]


def test_command_line_entry(spark, samples, tmp_dir, capsys):
    from stratum.plans.refresh import main

    landing, wh = os.path.join(tmp_dir, "landing"), os.path.join(tmp_dir, "wh")
    _land(samples, landing, 1)
    assert main(["--landing", landing, "--warehouse", wh, "--as-of", "2024-10-01"]) == 0
    out = capsys.readouterr().out
    assert "PASS gold" in out and "customer_order_summary" in out
    assert "SUMMARY" in out and "0 failed" in out


def test_incremental_bronze_refresh_matches_full_reload(spark, samples, tmp_dir):
    landing, wh = os.path.join(tmp_dir, "landing"), os.path.join(tmp_dir, "wh")
    _land(samples, landing, 1)
    m1 = {(r.layer, r.table_name): r.rows for r in full_refresh(
        spark, Refresh(landing, wh, as_of="2024-10-01", run_time="r1",
                       incremental_bronze=True)).collect()}
    assert m1[("bronze", "orders")] == 12 and m1[("bronze", "addresses")] == 10
    _land(samples, landing, 2)
    m2 = {(r.layer, r.table_name): r.rows for r in full_refresh(
        spark, Refresh(landing, wh, as_of="2025-01-14", run_time="r2",
                       incremental_bronze=True)).collect()}
    assert m2[("bronze", "orders")] == 4  # only the new day's rows were read
    assert m2[("silver", "orders")] == 16
    from stratum.sinks import scd2_table

    dim = scd2_table.read_dimension(spark, f"{wh}/silver/dim_addresses")
    assert dim.count() == 16 and dim.filter("is_current").count() == 13
    assert spark.read.parquet(f"{wh}/gold/customer_order_summary").count() == 11


def test_incremental_silver_refresh_matches_full_reload(spark, samples, tmp_dir):
    landing, wh = os.path.join(tmp_dir, "landing"), os.path.join(tmp_dir, "wh")
    kw = dict(incremental_bronze=True, incremental_silver=True)
    _land(samples, landing, 1)
    full_refresh(spark, Refresh(landing, wh, as_of="2024-10-01", run_time="r1", **kw))
    _land(samples, landing, 2)
    m2 = {(r.layer, r.table_name): r.rows for r in full_refresh(
        spark, Refresh(landing, wh, as_of="2025-01-14", run_time="r2", **kw)).collect()}
    assert m2[("bronze", "orders")] == 4 and m2[("silver", "orders")] == 4  # new rows only
    lines = spark.read.parquet(f"{wh}/silver/orders")
    assert lines.count() == 16  # 18 lines, 2 dropped by the status rule
    assert spark.read.parquet(f"{wh}/gold/customer_order_summary").count() == 11
    rev = spark.read.parquet(f"{wh}/gold/revenue_by_day")
    assert round(sum(r.total_revenue for r in rev.collect()), 2) == 9869.0
    from stratum.sinks import scd2_table

    dim = scd2_table.read_dimension(spark, f"{wh}/silver/dim_addresses")
    assert dim.count() == 16 and dim.filter("is_current").count() == 13
    rep = spark.read.parquet(f"{wh}/gold/dq_report_batches/orders")
    sums = rep.groupBy("rule_name").agg(F.sum("fail_count").alias("f")).collect()
    assert {r.rule_name: r.f for r in sums}["valid_order_status"] == 2


def test_refresh_marks_tables_with_rule_failures_as_warn(spark, samples, tmp_dir):
    landing, wh = os.path.join(tmp_dir, "landing"), os.path.join(tmp_dir, "wh")
    _land(samples, landing, 1)
    _land(samples, landing, 2)
    m = {(r.layer, r.table_name): (r.status, r.message) for r in full_refresh(
        spark, Refresh(landing, wh, as_of="2025-01-14", run_time="r")).collect()}
    status, msg = m[("silver", "orders")]
    assert status == "WARN" and "valid_order_status" in msg and "known_payment_method" in msg
    assert m[("silver", "addresses")][0] == "WARN"  # two-word and missing states
    assert m[("bronze", "orders")][0] == "PASS"


def test_metrics_summary(spark, samples, tmp_dir):
    import pytest

    from stratum.sinks.writer import metrics_frame, summarize_metrics

    recs = [dict(run_time="r", layer="silver", table_name="a", mode="overwrite", status=s,
                 rows=1, message="") for s in ("PASS", "PASS", "WARN")]
    assert summarize_metrics(metrics_frame(spark, recs)) == {"PASS": 2, "WARN": 1, "FAIL": 0}
    recs.append(dict(recs[0], status="FAIL"))
    with pytest.raises(RuntimeError):
        summarize_metrics(metrics_frame(spark, recs), raise_on_failure=True)
