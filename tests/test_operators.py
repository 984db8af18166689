"""Operator edge cases on hand-typed literals (FIXTURES.md section C)."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from stratum.functions import (
    age_group,
    age_years,
    avg_cents,
    div_half_up,
    email_domain,
    one_line,
    percent_1dp,
    to_cents,
)
from stratum.operators.flatten import explode_items
from stratum.operators.quality import DQFailure, Rule, dq_report, run_quality_checks
from stratum.schemas import ORDERS_RAW


def test_explode_inner_and_outer(spark):
    item = dict(item_id=1, name="a", category="c", price=2.5, quantity=2)
    df = spark.createDataFrame(
        [(1, 10, "2024-01-01 00:00:00", "PayPal", [item, item], "Pending"),
         (2, 10, "2024-01-01 00:00:00", "PayPal", [], "Pending"),
         (3, 10, "2024-01-01 00:00:00", "PayPal", None, "Pending")], ORDERS_RAW)
    inner = explode_items(df).collect()
    assert [r.order_id for r in inner] == [1, 1]
    assert inner[0].item_total == 5.0 and inner[0].item_total_cents == 500
    outer = explode_items(df, outer=True).collect()
    assert sorted(r.order_id for r in outer) == [1, 1, 2, 3]
    assert all(r.item_id is None for r in outer if r.order_id != 1)


def test_email_domain_edges(spark):
    df = spark.createDataFrame([("a@b.com",), ("nobody",), ("x@y@z",), (None,)], "email string")
    got = [r.d for r in df.select(email_domain("email").alias("d")).collect()]
    assert got == ["b.com", None, "y", None]


def test_age_and_band(spark):
    df = spark.createDataFrame([(dt.date(2005, 1, 16),), (dt.date(2000, 1, 15),), (None,)], "dob date")
    rows = df.select(age_years("dob", "2025-01-15").alias("a")).select(
        "a", age_group("a").alias("g")).collect()
    assert [(r.a, r.g) for r in rows] == [(19, "Under 20"), (25, "25-29"), (None, "30+")]


def test_one_line_skips_nulls(spark):
    df = spark.createDataFrame([("1 Road", "Town", None, "0123")], "l string, c string, s string, p string")
    assert df.select(one_line(["l", "c", "s", "p"]).alias("x")).first().x == "1 Road, Town, 0123"


def test_money_half_up(spark):
    df = spark.createDataFrame([(5, 2), (7, 2), (-5, 2), (1, 3), (2, 3), (10, 0)], "n long, d long")
    got = [r.q for r in df.select(div_half_up("n", "d").alias("q")).collect()]
    assert got == [3, 4, -3, 0, 1, None]
    df = spark.createDataFrame([(169701, 3)], "s long, n long")
    assert df.select(avg_cents("s", "n").alias("a")).first().a == 565.67
    df = spark.createDataFrame([(6, 14)], "p long, w long")
    assert df.select(percent_1dp("p", "w").alias("x")).first().x == 42.9
    df = spark.createDataFrame([(0.1 + 0.2,), (900.1,)], "x double")
    assert [r.c for r in df.select(to_cents("x").alias("c")).collect()] == [30, 90010]


def _frame(spark):
    return spark.createDataFrame([(1, "a"), (2, None), (None, "c"), (4, "d")], "id long, s string")


def test_dq_three_valued_counts(spark):
    rules = [Rule("s_is_a", F.col("s") == "a", "warn"), Rule("id_pos", "id > 0", "warn")]
    rep = {r.rule_name: (r.pass_count, r.fail_count, r.null_count, r.pass_rate)
           for r in dq_report(_frame(spark), rules, "t").collect()}
    assert rep["s_is_a"] == (1, 2, 1, 33.3)
    assert rep["id_pos"] == (3, 0, 1, 100.0)


def test_dq_drop_null_policies(spark):
    df = _frame(spark)
    rules = [Rule("id_small", F.col("id") < 3, "drop")]
    assert run_quality_checks(df, rules, "t").clean.count() == 2
    assert run_quality_checks(df, rules, "t", on_null="keep").clean.count() == 3
    # reference policy: rows with a NULL condition are dropped only when a
    # true failure exists
    assert run_quality_checks(df, rules, "t", on_null="reference").clean.count() == 2
    no_fail = [Rule("id_pos", F.col("id") > 0, "drop")]
    assert run_quality_checks(df, no_fail, "t", on_null="reference").clean.count() == 4
    assert run_quality_checks(df, no_fail, "t").clean.count() == 3


def test_dq_rules_are_independent(spark):
    df = _frame(spark)
    rules = [Rule("drop_big", F.col("id") < 2, "drop"), Rule("s_not_null", F.col("s").isNotNull(), "warn")]
    rep = {r.rule_name: (r.pass_count, r.fail_count) for r in dq_report(df, rules, "t").collect()}
    assert rep["s_not_null"] == (3, 1)  # evaluated on all rows, not the dropped frame


def test_dq_fail_raises_with_partial_report(spark):
    df = _frame(spark)
    written = []
    rules = [Rule("warn_one", F.col("s").isNotNull(), "warn"),
             Rule("id_not_null", F.col("id").isNotNull(), "fail"),
             Rule("never_seen", F.col("id") > 0, "warn")]
    with pytest.raises(DQFailure) as ei:
        run_quality_checks(df, rules, "t", report_sink=lambda r: written.append(r.collect()))
    assert ei.value.fail_count == 1
    assert [r.rule_name for r in written[0]] == ["warn_one", "id_not_null"]


def test_dq_empty_frame(spark):
    df = spark.createDataFrame([], "id long")
    rep = dq_report(df, [Rule("x", "id > 0")], "t").first()
    assert (rep.pass_count, rep.fail_count, rep.pass_rate) == (0, 0, 100.0)


def test_rule_rejects_unknown_action():
    with pytest.raises(ValueError):
        Rule("x", "true", "explode")


def test_money_matches_decimal_half_up(spark):
    from decimal import ROUND_HALF_UP, Decimal

    from hypothesis import given, settings
    from hypothesis import strategies as st

    pairs = st.lists(st.tuples(st.integers(-10**15, 10**15), st.integers(1, 10**6)),
                     min_size=1, max_size=200)

    @settings(max_examples=5, deadline=None)
    @given(pairs)
    def check(rows):
        df = spark.createDataFrame(rows, "n long, d long")
        got = [r.q for r in df.select(div_half_up("n", "d").alias("q")).collect()]
        want = [int((Decimal(n) / Decimal(d)).quantize(Decimal(1), rounding=ROUND_HALF_UP))
                for n, d in rows]
        assert got == want

    check()


def test_cluster_conf_sizes_shuffle_partitions():
    from stratum.session import cluster_conf

    assert cluster_conf(2**40)["spark.sql.shuffle.partitions"] == "4096"
    assert cluster_conf(100 * 2**40)["spark.sql.shuffle.partitions"] == "100000"
    assert cluster_conf(10**6)["spark.sql.shuffle.partitions"] == "200"
    assert cluster_conf(2**40)["spark.sql.adaptive.enabled"] == "true"


def test_explode_array_generic_fields_and_casts(spark):
    from stratum.operators.flatten import explode_array

    df = spark.createDataFrame([(1, [{"a": "5", "b": "x"}, {"a": "7", "b": "y"}])],
                               "id long, xs array<struct<a:string,b:string>>")
    out = explode_array(df, "xs", {"a": "x_a", "b": "x_b"}, casts={"x_a": "int"})
    assert out.columns == ["id", "x_a", "x_b"]
    assert dict(out.dtypes)["x_a"] == "int"
    assert sorted((r.x_a, r.x_b) for r in out.collect()) == [(5, "x"), (7, "y")]


def test_no_rules(spark, tmp_path):
    from stratum.sinks import writer

    df = spark.createDataFrame([(1,), (2,)], "id long")
    assert dq_report(df, [], "t").count() == 0
    res = run_quality_checks(df, [], "t")
    assert res.clean.count() == 2 and res.report.count() == 0
    rec = writer.write_checked(df, [], "t", str(tmp_path / "s" / "t"))
    assert rec["rows"] == 2 and rec["status"] == "PASS"
