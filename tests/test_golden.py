"""The whole medallion flow on the two-day samples, checked against values
derived by hand (FIXTURES.md section B)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from stratum.operators import marts, scd
from stratum.operators.quality import dq_report, run_quality_checks
from stratum.operators.silver import clean_addresses, clean_customers, clean_orders
from stratum.plans.rules import address_rules, customer_rules, order_rules

AS_OF = "2025-01-15"


def _report(df):
    return {r.rule_name: (r.pass_count, r.fail_count, r.pass_rate) for r in df.collect()}


def test_order_dq_and_drop(samples):
    lines = clean_orders(samples["orders"])
    assert lines.count() == 18
    rep = _report(dq_report(lines, order_rules(), "silver_orders"))
    assert rep["order_id_not_null"] == (18, 0, 100.0)
    assert rep["customer_id_not_null"] == (18, 0, 100.0)
    assert rep["positive_item_price"] == (18, 0, 100.0)
    assert rep["valid_order_status"] == (16, 2, 88.9)
    assert rep["known_payment_method"] == (16, 2, 88.9)
    res = run_quality_checks(lines, order_rules(), "silver_orders")
    clean = res.clean
    row = clean.agg(F.count(F.lit(1)).alias("n"), F.count_distinct("order_id").alias("o"),
                    F.sum("item_total").alias("rev")).first()
    assert (row.n, row.o, row.rev) == (16, 14, 9869.0)


def test_customer_and_address_dq(samples):
    cust = clean_customers(samples["customers_day1"].unionByName(samples["customers_day2"]), AS_OF)
    rep = _report(dq_report(cust, customer_rules(AS_OF), "silver_customers"))
    assert rep["customer_id_not_null"] == (17, 0, 100.0)
    assert rep["vaild_date_of_birth"] == (17, 0, 100.0)
    assert rep["name_not_empty"] == (16, 1, 94.1)
    assert rep["valid_email_format"] == (14, 0, 100.0)
    assert rep["valid_phone_format"] == (16, 0, 100.0)
    addr = clean_addresses(samples["addresses_day1"].unionByName(samples["addresses_day2"]))
    rep = _report(dq_report(addr, address_rules(), "silver_addresses"))
    assert rep["valid_state_format"] == (12, 4, 75.0)
    for name in ("addresses_has_customer_id", "valid_postcode", "valid_city_name",
                 "address_line_not_empty"):
        assert rep[name] == (16, 0, 100.0)


def _clean_lines(samples):
    return run_quality_checks(clean_orders(samples["orders"]), order_rules(), "silver_orders").clean


def test_revenue_by_day(samples):
    got = {str(r.order_date)[5:]: (r.total_revenue, r.total_orders, r.avg_order_value, r.total_units_sold)
           for r in marts.revenue_by_day(_clean_lines(samples)).collect()}
    assert got == {
        "10-06": (328.0, 1, 164.0, 2), "10-07": (399.0, 1, 399.0, 1), "10-13": (499.0, 1, 499.0, 1),
        "10-15": (398.0, 1, 398.0, 2), "10-20": (1199.0, 1, 1199.0, 1), "10-23": (1497.0, 2, 748.5, 3),
        "10-25": (1697.0, 2, 565.67, 3), "10-28": (799.0, 1, 799.0, 1), "11-16": (998.0, 1, 998.0, 2),
        "11-18": (798.0, 1, 798.0, 2), "11-19": (258.0, 1, 258.0, 2), "11-27": (999.0, 1, 999.0, 1),
    }


def test_product_status_payment(samples):
    lines = _clean_lines(samples)
    prod = marts.product_performance(lines).collect()
    assert [r.item_id for r in prod] == [8, 10, 9, 5, 2, 3, 1, 7]  # revenue descending
    got = {r.item_id: (r.Total_units_sold, r.Total_revenue, r.times_ordered, r.avg_price) for r in prod}
    assert got == {8: (6, 2994.0, 4, 499.0), 10: (2, 1598.0, 2, 799.0), 9: (1, 1199.0, 1, 1199.0),
                   5: (3, 1197.0, 2, 399.0), 2: (1, 999.0, 1, 999.0), 3: (4, 796.0, 3, 199.0),
                   1: (1, 699.0, 1, 699.0), 7: (3, 387.0, 2, 129.0)}
    funnel = {r.order_status: (r.order_count, r.pct_of_total) for r in marts.status_funnel(lines).collect()}
    assert funnel == {"Pending": (6, 42.9), "Shipped": (4, 28.6), "Completed": (2, 14.3),
                      "Cancelled": (2, 14.3)}
    mix = {r.payment_method: (r.order_count, r.total_revenue) for r in marts.payment_mix(lines).collect()}
    assert mix == {"Bank Transfer": (5, 4893.0), "Credit Card": (4, 1854.0), "PayPal": (4, 2794.0),
                   "Unknown": (1, 328.0)}


def test_dimensions_and_customer_summary(samples):
    c1 = clean_customers(samples["customers_day1"], AS_OF)
    c2 = clean_customers(samples["customers_day2"], AS_OF)
    dim_c = scd.scd1_apply(scd.scd1_apply(None, c1, ["customer_id"]), c2, ["customer_id"])
    assert dim_c.count() == 13
    assert dim_c.filter("customer_id = 1008").first().customer_name == "William Carter"

    track = ["address_line_1", "city", "state", "postcode"]
    a1 = clean_addresses(samples["addresses_day1"])
    a2 = clean_addresses(samples["addresses_day2"])
    d1 = scd.scd2_initial(a1, ["customer_id"], "2024-10-01")
    d2 = scd.scd2_apply(d1, a2, ["customer_id"], track, "2025-01-14")
    rows = d2.collect()
    assert len(rows) == 16
    expired = sorted(r.customer_id for r in rows if not r.is_current)
    assert expired == [1001, 1004, 1006]
    assert all(r.effective_end == dt.date(2025, 1, 14) for r in rows if not r.is_current)
    assert sum(r.is_current for r in rows) == 13

    summary = marts.customer_summary(_clean_lines(samples), dim_c, scd.scd2_current(d2), AS_OF)
    got = {r.customer_id: (r.total_orders, r.lifetime_value, r.avg_order_value, r.customer_segment)
           for r in summary.collect()}
    assert got == {
        1001: (2, 1198.0, 599.0, "VIP"), 1003: (1, 1199.0, 1199.0, "VIP"), 1004: (1, 499.0, 499.0, "New"),
        1006: (2, 1198.0, 599.0, "VIP"), 1007: (1, 328.0, 164.0, "New"), 1008: (1, 398.0, 398.0, "New"),
        1009: (1, 998.0, 499.0, "Regular"), 1010: (1, 998.0, 998.0, "Regular"),
        1011: (1, 998.0, 998.0, "Regular"), 1012: (1, 258.0, 258.0, "New"),
        1013: (2, 1797.0, 898.5, "VIP"),
    }
    r1001 = summary.filter("customer_id = 1001").first()
    assert r1001.city == "Shelleyland" and r1001.state == "RHODE ISLAND"
    assert r1001.days_since_last_order == (dt.date(2025, 1, 15) - dt.date(2024, 10, 28)).days


def test_marts_from_order_totals_equal_marts_from_lines(samples):
    lines = _clean_lines(samples)
    orders = marts.order_totals(lines)
    assert orders.count() == 14
    for mart in (marts.revenue_by_day, marts.status_funnel, marts.payment_mix,
                 marts.customer_summary):
        a = sorted(tuple(r) for r in mart(lines).collect())
        b = sorted(tuple(r) for r in mart(orders).collect())
        assert a == b, mart.__name__
