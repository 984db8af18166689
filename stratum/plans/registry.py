"""Registered queries: name -> callable(spark, base) -> DataFrame.

Every query reads whole driver tables (or data Spark derives from them).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratum.operators import scd
from stratum.operators.quality import dq_report
from stratum.plans import layers as L
from stratum.plans.rules import address_rules, customer_rules, order_rules

Query = Callable[[SparkSession, str], DataFrame]

SILVER_LINE_COLS = [
    "order_id", "customer_id", "order_timestamp", "payment_method", "order_status", "item_id",
    "item_name", "item_category", "item_price", "item_quantity", "item_total", "item_total_cents",
    "order_date", "order_hour", "order_month", "order_year",
]


def silver_order_lines(spark, base):
    return L.silver_order_lines(spark, base).select(*SILVER_LINE_COLS)


def silver_calendar(spark, base):
    lines = L.silver_order_lines(spark, base)
    return lines.groupBy("order_year", "order_month", "order_date", "order_hour").agg(
        F.count(F.lit(1)).alias("n_lines"), F.count_distinct("order_id").alias("n_orders"))


def silver_customer(spark, base):
    return L.silver_customers(spark, base)


def silver_address(spark, base):
    return L.silver_addresses(spark, base)


def dq_orders(spark, base):
    return dq_report(L.silver_order_lines(spark, base), order_rules(), "silver_orders", L.RUN_TIME)


def dq_customers(spark, base):
    return dq_report(L.silver_customers(spark, base), customer_rules(L.AS_OF),
                     "silver_customers", L.RUN_TIME)


def dq_addresses(spark, base):
    return dq_report(L.silver_addresses(spark, base), address_rules(), "silver_addresses", L.RUN_TIME)


def dq_all(spark, base):
    """The report of all three silver tables (one aggregate per table)."""
    return dq_orders(spark, base).unionByName(dq_customers(spark, base)).unionByName(
        dq_addresses(spark, base))


def dq_clean(spark, base):
    return L.silver_orders_clean(spark, base).select(*SILVER_LINE_COLS)


def _drop_ts(df: DataFrame) -> DataFrame:
    return df.drop("ts")


def scd1_upsert(spark, base):
    return _drop_ts(L.user_scd1(spark, base))


def scd2_initial(spark, base):
    return _drop_ts(L.user_dim_initial(spark, base))


def scd2_apply(spark, base):
    return _drop_ts(L.user_dim_applied(spark, base))


def scd2_changed_keys(spark, base):
    c = L.user_dim_classified(spark, base)
    return c.filter(F.col(scd.CLASS_COL) == scd.CHANGED).select(*L.USER_KEY)


def scd2_new_keys(spark, base):
    c = L.user_dim_classified(spark, base)
    return c.filter(F.col(scd.CLASS_COL) == scd.NEW).select(*L.USER_KEY)


def scd2_metrics(spark, base):
    return scd.scd2_metrics(L.user_dim_classified(spark, base))


def scd2_current(spark, base):
    return _drop_ts(scd.scd2_current(L.user_dim_applied(spark, base)))


def scd2_history(spark, base):
    return _drop_ts(L.user_dim_history(spark, base))


def queries() -> dict[str, Query]:
    from stratum.plans import io_queries

    q: dict[str, Query] = {
        "silver_order_lines": silver_order_lines,
        "silver_calendar": silver_calendar,
        "silver_customer": silver_customer,
        "silver_address": silver_address,
        "dq_orders": dq_orders,
        "dq_customers": dq_customers,
        "dq_addresses": dq_addresses,
        "dq_report": dq_all,
        "dq_clean": dq_clean,
        "gold_revenue_by_day": L.gold_revenue_by_day,
        "gold_product_performance": L.gold_product_performance,
        "gold_status_funnel": L.gold_status_funnel,
        "gold_payment_mix": L.gold_payment_mix,
        "gold_customer_summary": L.gold_customer_summary,
        "scd1_upsert": scd1_upsert,
        "scd2_initial": scd2_initial,
        "scd2_apply": scd2_apply,
        "scd2_changed_keys": scd2_changed_keys,
        "scd2_new_keys": scd2_new_keys,
        "scd2_metrics": scd2_metrics,
        "scd2_current": scd2_current,
        "scd2_history": scd2_history,
    }
    q.update(io_queries.queries())
    return q


def oracle_sql() -> dict[str, str]:
    from stratum.plans import io_queries
    from stratum.plans.oracle import oracle_sql as core

    q = core()
    q.update(io_queries.oracle_sql())
    return q
