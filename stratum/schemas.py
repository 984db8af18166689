"""Declared schemas of the landing entities and of the report tables.

Declaring the schema avoids an inference pass over the landing folder (a full
extra scan at scale) and keeps types stable: a postcode such as ``06133`` stays
text instead of becoming the integer 6133.
"""

from __future__ import annotations

from pyspark.sql import types as T

ORDER_ITEM = T.StructType([
    T.StructField("item_id", T.LongType()),
    T.StructField("name", T.StringType()),
    T.StructField("category", T.StringType()),
    T.StructField("price", T.DoubleType()),
    T.StructField("quantity", T.IntegerType()),
])

ORDERS_RAW = T.StructType([
    T.StructField("order_id", T.LongType()),
    T.StructField("customer_id", T.LongType()),
    T.StructField("order_timestamp", T.StringType()),
    T.StructField("payment_method", T.StringType()),
    T.StructField("items", T.ArrayType(ORDER_ITEM)),
    T.StructField("order_status", T.StringType()),
])

CUSTOMERS_RAW = T.StructType([
    T.StructField("customer_id", T.LongType()),
    T.StructField("customer_name", T.StringType()),
    T.StructField("date_of_birth", T.StringType()),
    T.StructField("telephone", T.StringType()),
    T.StructField("email", T.StringType()),
    T.StructField("created_date", T.StringType()),
])

ADDRESSES_RAW = T.StructType([
    T.StructField("customer_id", T.LongType()),
    T.StructField("address_line_1", T.StringType()),
    T.StructField("city", T.StringType()),
    T.StructField("state", T.StringType()),
    T.StructField("postcode", T.StringType()),
    T.StructField("created_date", T.StringType()),
])

EVENTS = T.StructType([
    T.StructField("event_id", T.LongType()),
    T.StructField("ts", T.TimestampNTZType()),
    T.StructField("user_id", T.LongType()),
    T.StructField("event_type", T.StringType()),
    T.StructField("value", T.DoubleType()),
    T.StructField("props", T.StringType()),
])

DQ_REPORT = T.StructType([
    T.StructField("run_time", T.StringType()),
    T.StructField("table_name", T.StringType()),
    T.StructField("rule_name", T.StringType()),
    T.StructField("action", T.StringType()),
    T.StructField("pass_count", T.LongType()),
    T.StructField("fail_count", T.LongType()),
    T.StructField("null_count", T.LongType()),
    T.StructField("pass_rate", T.DoubleType()),
])

WRITE_METRICS = T.StructType([
    T.StructField("run_time", T.StringType()),
    T.StructField("layer", T.StringType()),
    T.StructField("table_name", T.StringType()),
    T.StructField("mode", T.StringType()),
    T.StructField("status", T.StringType()),
    T.StructField("rows", T.LongType()),
    T.StructField("elapsed_s", T.DoubleType()),
    T.StructField("message", T.StringType()),
])

# SCD2 bookkeeping columns.
SCD2_START, SCD2_END, SCD2_CURRENT = "effective_start", "effective_end", "is_current"
