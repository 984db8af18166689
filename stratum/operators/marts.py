"""Gold KPI marts over silver order lines.

Money is summed in integer cents (exact); two-decimal averages and
percentages are integer half-up divisions (see ``functions.money``).

Aggregations with one exact ``count_distinct`` next to plain aggregates are
planned by Spark as a two-level aggregate: the first shuffle is on
(group key, order_id), so a hot group is spread over many tasks; the second
shuffle carries one partial row per task and group.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratum.functions.dates import days_since
from stratum.functions.money import avg_cents, cents_to_amount, percent_1dp, to_cents

# Customer segments by lifetime value (in currency units).
SEGMENTS = [(1000, "VIP"), (500, "Regular")]
SEGMENT_OTHER = "New"


def _with_cents(lines: DataFrame) -> DataFrame:
    if "item_total_cents" in lines.columns or "n_priced" in lines.columns:
        return lines
    return lines.withColumn("item_total_cents", to_cents("item_price") * F.col("item_quantity"))


# Per-order columns every order-level mart needs (see ``order_totals``).
ORDER_COLS = ["order_id", "customer_id", "order_date", "order_month", "order_year",
              "order_status", "payment_method"]


def order_totals(lines: DataFrame) -> DataFrame:
    """One row per order: cents, priced lines and units (a partial aggregate).

    The marts below accept this frame in place of the lines and give the same
    result: their measures are sums of per-row values, and ``order_id`` is
    still counted distinct.  Building it once and letting four marts read it
    scans and shuffles the lines once instead of four times.
    """
    lines = _with_cents(lines)
    return lines.groupBy(*ORDER_COLS).agg(
        F.sum("item_total_cents").alias("sum_cents"),
        F.count("item_total_cents").alias("n_priced"),
        F.sum("item_quantity").cast("bigint").alias("units"),
    )


def _measures(df: DataFrame) -> tuple[F.Column, F.Column, F.Column]:
    """(cents, priced-line count, units) per row of lines or of order totals."""
    if "n_priced" in df.columns:
        return F.col("sum_cents"), F.col("n_priced"), F.col("units")
    cents = F.col("item_total_cents")
    return cents, F.when(cents.isNotNull(), F.lit(1)).otherwise(F.lit(0)), F.col("item_quantity")


def revenue_by_day(lines: DataFrame, sort: bool = True) -> DataFrame:
    lines = _with_cents(lines)
    cents, priced, units = _measures(lines)
    out = (
        lines.groupBy("order_date", "order_month", "order_year")
        .agg(
            F.sum(cents).alias("_sum"),
            F.sum(priced).cast("bigint").alias("_n"),
            F.count_distinct("order_id").alias("total_orders"),
            F.sum(units).cast("bigint").alias("total_units_sold"),
        )
        .select(
            "order_date", "order_month", "order_year",
            cents_to_amount("_sum").alias("total_revenue"),
            "total_orders",
            avg_cents("_sum", "_n").alias("avg_order_value"),
            "total_units_sold",
            avg_cents("_sum", "total_orders").alias("avg_basket_value"),
        )
    )
    return out.orderBy("order_date") if sort else out


def product_performance(lines: DataFrame, sort: bool = True) -> DataFrame:
    lines = _with_cents(lines)
    price_cents = to_cents("item_price")
    out = (
        lines.groupBy("item_id", "item_name", "item_category")
        .agg(
            F.sum("item_quantity").cast("bigint").alias("Total_units_sold"),
            F.sum("item_total_cents").alias("_sum"),
            F.count_distinct("order_id").alias("times_ordered"),
            F.sum(price_cents).alias("_psum"),
            F.count(price_cents).alias("_pn"),
        )
        .select(
            "item_id", "item_name", "item_category", "Total_units_sold",
            cents_to_amount("_sum").alias("Total_revenue"),
            "times_ordered",
            avg_cents("_psum", "_pn").alias("avg_price"),
            F.col("_sum").alias("_order"),
        )
    )
    if sort:
        out = out.orderBy(F.desc("_order"), "item_id")
    return out.drop("_order")


def status_funnel(lines: DataFrame) -> DataFrame:
    """Orders per status and their share of all orders (1 decimal).

    The total is a scalar subquery over the grouped frame: no single-partition
    window, no join.
    """
    grouped = lines.groupBy("order_status").agg(F.count_distinct("order_id").alias("order_count"))
    total = grouped.select(F.sum("order_count")).scalar()
    # bind the scalar once; the percentage expression refers to it repeatedly
    return grouped.withColumn("_total", total).select(
        "order_status", "order_count",
        percent_1dp(F.col("order_count"), F.col("_total")).alias("pct_of_total"),
    )


def payment_mix(lines: DataFrame) -> DataFrame:
    lines = _with_cents(lines)
    cents, _, _ = _measures(lines)
    return (
        lines.groupBy("payment_method")
        .agg(F.count_distinct("order_id").alias("order_count"),
             F.sum(cents).alias("_sum"))
        .select("payment_method", "order_count", cents_to_amount("_sum").alias("total_revenue"))
    )


def segment(lifetime_cents) -> F.Column:
    expr = None
    for lower, label in SEGMENTS:
        cond = lifetime_cents >= lower * 100
        expr = F.when(cond, label) if expr is None else expr.when(cond, label)
    return expr.otherwise(SEGMENT_OTHER)


CUSTOMER_COLS = ["customer_id", "customer_name", "age", "age_group", "email_domain",
                 "contact_completeness"]
ADDRESS_COLS = ["customer_id", "city", "state", "full_address"]
SUMMARY_COLS = ["customer_id", "total_orders", "lifetime_value", "avg_order_value",
                "last_order_date", "first_order_date", "days_since_last_order",
                "customer_segment"] + CUSTOMER_COLS[1:] + ADDRESS_COLS[1:]


def customer_summary(lines: DataFrame, customers: DataFrame | None = None,
                     addresses: DataFrame | None = None, as_of=None) -> DataFrame:
    """Per-customer order KPIs, segment, and the customer / address dims.

    ``customers`` must hold one row per customer (SCD1 output) and
    ``addresses`` one current row per customer (SCD2 current rows), so the
    left joins never fan out.  Both sides of each join are unique per key:
    the sort-merge join has no hot key, and AQE turns it into a broadcast
    join when a side is measured small.
    """
    lines = _with_cents(lines)
    cents, priced, _ = _measures(lines)
    agg = (
        lines.groupBy("customer_id")
        .agg(
            F.count_distinct("order_id").alias("total_orders"),
            F.sum(cents).alias("_sum"),
            F.sum(priced).cast("bigint").alias("_n"),
            F.max("order_date").alias("last_order_date"),
            F.min("order_date").alias("first_order_date"),
        )
        .select(
            "customer_id", "total_orders",
            cents_to_amount("_sum").alias("lifetime_value"),
            avg_cents("_sum", "_n").alias("avg_order_value"),
            "last_order_date", "first_order_date",
            days_since("last_order_date", as_of).alias("days_since_last_order"),
            segment(F.col("_sum")).alias("customer_segment"),
        )
    )
    if customers is not None:
        agg = agg.join(customers.select(*CUSTOMER_COLS), "customer_id", "left")
    if addresses is not None:
        agg = agg.join(addresses.select(*ADDRESS_COLS), "customer_id", "left")
    return agg
