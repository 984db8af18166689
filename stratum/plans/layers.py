"""Layer plans: landing -> bronze -> silver -> dimensions -> gold.

Each function returns a lazy DataFrame over the driver tables in ``base``;
nothing here runs a job.  The fixed clock values make every plan
reproducible (the original pipeline read the wall clock inside its logic).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratum.operators import marts, scd
from stratum.operators.quality import apply_expectations
from stratum.operators.silver import clean_addresses, clean_customers, clean_orders
from stratum.plans.rules import order_rules
from stratum.sources import derive

# Clock of the reproducible plans.
AS_OF = "2025-01-15"
RUN_TIME = "2025-01-15 00:00:00"
# Effective dates of the two event snapshots (first half, second half).
EFFECTIVE_FIRST = "2024-01-02"
EFFECTIVE_SECOND = "2024-01-31"

CUSTOMER_KEY = ["customer_id"]
ADDRESS_TRACK = ["address_line_1", "city", "state", "postcode"]
USER_KEY = ["user_id"]
USER_TRACK = ["event_type"]
EVENT_ORDER = ["ts", "event_id"]
PROFILE_COLS = ["user_id", "event_id", "ts", "event_type", "value"]


# ----------------------------------------------------------------- silver
def silver_order_lines(spark: SparkSession, base: str) -> DataFrame:
    return clean_orders(derive.bronze_orders_table(spark, base))


def silver_orders_clean(spark: SparkSession, base: str) -> DataFrame:
    """Order lines left after the ``drop`` rules."""
    return apply_expectations(silver_order_lines(spark, base), order_rules())


def silver_customers(spark: SparkSession, base: str, as_of: str = AS_OF) -> DataFrame:
    return clean_customers(derive.bronze_customers(spark, base), as_of)


def silver_addresses(spark: SparkSession, base: str) -> DataFrame:
    return clean_addresses(derive.bronze_addresses(spark, base))


# ------------------------------------------------------------- dimensions
def dim_customers(spark: SparkSession, base: str, as_of: str = AS_OF) -> DataFrame:
    """SCD1 initial load: one row per customer (latest ``created_date``)."""
    return scd.scd1_apply(None, silver_customers(spark, base, as_of), CUSTOMER_KEY,
                          order_by=["created_date"])


def dim_addresses(spark: SparkSession, base: str, as_of: str = AS_OF) -> DataFrame:
    """SCD2 initial load of the addresses."""
    return scd.scd2_initial(silver_addresses(spark, base), CUSTOMER_KEY, as_of,
                            order_by=["created_date"])


def user_profiles(spark: SparkSession, base: str) -> tuple[DataFrame, DataFrame]:
    """The event table cut in two halves, reduced to profile columns."""
    first, second = derive.event_halves(spark, base)
    return first.select(*PROFILE_COLS), second.select(*PROFILE_COLS)


def user_dim_initial(spark: SparkSession, base: str) -> DataFrame:
    first, _ = user_profiles(spark, base)
    return scd.scd2_initial(first, USER_KEY, EFFECTIVE_FIRST, order_by=EVENT_ORDER)


def user_dim_classified(spark: SparkSession, base: str) -> DataFrame:
    first, second = user_profiles(spark, base)
    target = scd.scd2_initial(first, USER_KEY, EFFECTIVE_FIRST, order_by=EVENT_ORDER)
    return scd.scd2_classify(target, second, USER_KEY, USER_TRACK, order_by=EVENT_ORDER)


def user_dim_applied(spark: SparkSession, base: str) -> DataFrame:
    first, second = user_profiles(spark, base)
    target = scd.scd2_initial(first, USER_KEY, EFFECTIVE_FIRST, order_by=EVENT_ORDER)
    return scd.scd2_apply(target, second, USER_KEY, USER_TRACK, EFFECTIVE_SECOND,
                          order_by=EVENT_ORDER)


def user_dim_history(spark: SparkSession, base: str) -> DataFrame:
    """Daily snapshots of every user replayed into one SCD2 history."""
    ev = derive.events(spark, base).select(*PROFILE_COLS)
    daily = ev.withColumn("snapshot_date", F.to_date("ts"))
    return scd.scd2_history(daily, USER_KEY, USER_TRACK, "snapshot_date", order_by=EVENT_ORDER)


def user_scd1(spark: SparkSession, base: str) -> DataFrame:
    first, second = user_profiles(spark, base)
    target = scd.scd1_apply(None, first, USER_KEY, order_by=EVENT_ORDER)
    return scd.scd1_apply(target, second, USER_KEY, order_by=EVENT_ORDER)


# ------------------------------------------------------------------- gold
def gold_revenue_by_day(spark, base):
    return marts.revenue_by_day(silver_orders_clean(spark, base))


def gold_product_performance(spark, base):
    return marts.product_performance(silver_orders_clean(spark, base))


def gold_status_funnel(spark, base):
    return marts.status_funnel(silver_orders_clean(spark, base))


def gold_payment_mix(spark, base):
    return marts.payment_mix(silver_orders_clean(spark, base))


def gold_customer_summary(spark, base, as_of: str = AS_OF):
    lines = silver_orders_clean(spark, base)
    customers = dim_customers(spark, base, as_of)
    addresses = scd.scd2_current(dim_addresses(spark, base, as_of))
    return marts.customer_summary(lines, customers, addresses, as_of)
