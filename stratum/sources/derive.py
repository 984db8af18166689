"""Landing-shaped entities derived from the driver's star-schema tables.

The pipeline consumes three landing entities (nested orders, customers,
addresses) and, for the dimension operators, snapshots of a changing entity.
The driver provides TPC-H-style tables instead, so each entity is derived
here by fixed, deterministic column expressions; the oracle SQL in
``stratum.plans.oracle`` repeats the very same expressions.

Every function reads whole tables: the derived data grows with the input.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratum.schemas import ORDER_ITEM
from stratum.sources.tables import read_table

# ---------------------------------------------------------------------------
# Fixed values of the derivation (repeated verbatim in the oracle SQL).
# ---------------------------------------------------------------------------
PAYMENT_BY_PRIORITY = {
    "1-URGENT": "Credit Card",
    "2-HIGH": "PayPal",
    "3-MEDIUM": "Bank Transfer",
    "4-NOT SPECIFIED": "Unknown",
    "5-LOW": "Credit Card",
}
STATUS_BY_ORDERSTATUS = {"O": "Pending", "P": "Shipped", "F": "Completed"}
# (o_orderstatus, o_orderpriority) pairs that override the status above.
STATUS_OVERRIDES = {("F", "5-LOW"): "Cancelled", ("P", "4-NOT SPECIFIED"): "Unknown"}
# Expected number of items per nested order record (see ``bronze_orders``).
ITEMS_PER_RECORD = 16
# Up to so many records an order, all its lines may meet in one task (``bronze_orders_together``).
RECORDS_TOGETHER = 64
CUSTOMER_CREATED = "2024-10-01"
BIRTH_BASE = "1959-01-01"
BIRTH_SPAN_DAYS = 18000
# Split of the event stream into the first snapshot and the later changes.
EVENT_SPLIT = "2024-01-02 00:00:00"


def _mapping(col: Column, mapping: dict, default=None) -> Column:
    expr = None
    for k, v in mapping.items():
        expr = F.when(col == k, v) if expr is None else expr.when(col == k, v)
    return expr.otherwise(default)


def order_status_expr(status: Column, priority: Column) -> Column:
    expr = None
    for (s, p), v in STATUS_OVERRIDES.items():
        cond = (status == s) & (priority == p)
        expr = F.when(cond, v) if expr is None else expr.when(cond, v)
    for s, v in STATUS_BY_ORDERSTATUS.items():
        expr = expr.when(status == s, v)
    return expr.otherwise(F.lit(None).cast("string"))


def order_header(spark: SparkSession, base: str) -> DataFrame:
    """One row per order with the landing columns (no items)."""
    o = read_table(spark, base, "orders",
                   ["o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate", "o_orderpriority"])
    seconds = ((F.col("o_orderkey") * 7919) % 86400).cast("int")
    ts = F.col("o_orderdate") + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), seconds)
    return o.select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        F.date_format(ts, "yyyy-MM-dd HH:mm:ss").alias("order_timestamp"),
        _mapping(F.col("o_orderpriority"), PAYMENT_BY_PRIORITY).alias("payment_method"),
        order_status_expr(F.col("o_orderstatus"), F.col("o_orderpriority")).alias("order_status"),
    )


def order_item_lines(spark: SparkSession, base: str) -> DataFrame:
    """One row per line: ``l_orderkey`` plus the item struct fields."""
    li = read_table(spark, base, "lineitem",
                    ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
                     "l_extendedprice"])
    part = read_table(spark, base, "part", ["p_partkey", "p_name", "p_type", "p_retailprice"])
    return li.join(part, li.l_partkey == part.p_partkey, "left")


def _item() -> Column:
    return F.struct(
        F.col("l_partkey").alias("item_id"),
        F.col("p_name").alias("name"),
        F.col("p_type").alias("category"),
        F.col("p_retailprice").cast("double").alias("price"),
        F.col("l_quantity").cast("int").alias("quantity"),
    )


def bronze_orders(spark: SparkSession, base: str,
                  items_per_record: int = ITEMS_PER_RECORD) -> DataFrame:
    """Nested orders: order columns + ``items`` array<struct>.

    Arrays are bounded: every order is cut into ``c = ceil(m / items_per_record)``
    records by a hash of the line, where ``m`` is the largest number of lines of
    any order (a scalar subquery over a map-side partial count).  The grouping
    shuffles on (order, chunk), so even an order holding a third of all lines
    is spread over many tasks in records of about ``items_per_record`` items;
    with ordinary data ``c`` is 1 and each order is one record.  Orders without
    lines get an empty ``items`` array, which the inner explode of the silver
    layer removes.
    """
    lines = order_item_lines(spark, base)
    # counted on lineitem itself: the (left) part join cannot change the count
    per_order = (read_table(spark, base, "lineitem", ["l_orderkey"])
                 .groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("n_lines")))
    max_lines = per_order.select(F.max("n_lines")).scalar()
    n_chunks = F.greatest(F.lit(1).cast("bigint"),
                          F.ceil(max_lines / F.lit(items_per_record)).cast("bigint"))
    chunk = F.pmod(
        F.xxhash64("l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice"),
        n_chunks,
    )
    items = (
        lines.groupBy("l_orderkey", chunk.alias("chunk"))
        .agg(F.collect_list(_item()).alias("items"))
    )
    header = order_header(spark, base)
    cols = ["order_id", "customer_id", "order_timestamp", "payment_method", "items", "order_status"]
    with_items = header.join(items, header.order_id == items.l_orderkey, "inner").select(*cols)
    line_keys = per_order.select("l_orderkey")
    empty = F.array().cast(T.ArrayType(ORDER_ITEM))
    without = (
        header.join(line_keys, header.order_id == line_keys.l_orderkey, "left_anti")
        .withColumn("items", empty)
        .select(*cols)
    )
    return with_items.unionByName(without)


def _most_lines(spark: SparkSession, base: str) -> int:
    """The largest number of lines of any order: one aggregate over lineitem's keys."""
    per_order = (read_table(spark, base, "lineitem", ["l_orderkey"])
                 .groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("n_lines")))
    return per_order.agg(F.max("n_lines")).first()[0] or 0


def bronze_orders_together(spark: SparkSession, base: str, records: int) -> DataFrame:
    """The rows of ``bronze_orders`` where no order has more than ``records`` records.

    The lines of such an order are few, so they are shuffled by order alone, which is also
    what the join with the headers needs: lines and headers move once.  The lines of an order
    are cut into its records within the row.  Orders without lines keep an empty array.
    """
    chunk = F.pmod(
        F.xxhash64("l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice"),
        F.lit(records).cast("bigint"),
    )
    # Grouped after the shuffle: before it, a task would sort a whole file split of lines.
    lines = (order_item_lines(spark, base)
             .select("l_orderkey", F.struct(chunk.alias("chunk"), _item().alias("item")).alias("line"))
             .repartition("l_orderkey").groupBy("l_orderkey").agg(F.collect_list("line").alias("lines")))
    header = order_header(spark, base)
    orders = header.join(lines, header.order_id == lines.l_orderkey, "left").withColumn(
        "chunk", F.explode_outer(F.array_distinct(F.col("lines.chunk"))))
    mine = F.transform(F.filter("lines", lambda x: x["chunk"] == F.col("chunk")), lambda x: x["item"])
    return orders.select("order_id", "customer_id", "order_timestamp", "payment_method",
                         F.coalesce(mine, F.array().cast(T.ArrayType(ORDER_ITEM))).alias("items"),
                         "order_status")


def stored_orders(spark: SparkSession, base: str) -> DataFrame:
    """The rows of ``bronze_orders``, by the plan that fits the largest order."""
    records = max(1, -(-_most_lines(spark, base) // ITEMS_PER_RECORD))
    if records <= RECORDS_TOGETHER:
        return bronze_orders_together(spark, base, records)
    return bronze_orders(spark, base)


def bronze_orders_table(spark: SparkSession, base: str) -> DataFrame:
    """The nested orders stored once per input as a bronze parquet table.

    Layers exchange data through stored tables: every order query scans this
    table (nested column pruning reaches the scan) instead of re-nesting the
    driver tables.
    """
    from stratum.schemas import ORDERS_RAW
    from stratum.sources.landing import landing_copy

    path = landing_copy(spark, base, "bronze_orders", lambda: stored_orders(spark, base), "parquet")
    return spark.read.schema(ORDERS_RAW).parquet(path)


def bronze_customers(spark: SparkSession, base: str) -> DataFrame:
    """Customer landing rows (all strings, like JSON text)."""
    c = read_table(spark, base, "customer",
                   ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"])
    key, bal, seg = F.col("c_custkey"), F.col("c_acctbal"), F.col("c_mktsegment")
    dob = F.date_add(F.lit(BIRTH_BASE).cast("date"), ((key * 37) % BIRTH_SPAN_DAYS).cast("int"))
    local = F.lower(F.replace(F.col("c_name"), F.lit("#"), F.lit(".")))
    return c.select(
        key.alias("customer_id"),
        F.when(bal < 0, F.lit(None).cast("string")).otherwise(F.col("c_name")).alias("customer_name"),
        F.when((seg == "AUTOMOBILE") & (bal > 9000), F.lit(None).cast("string"))
        .otherwise(F.date_format(dob, "yyyy-MM-dd")).alias("date_of_birth"),
        F.when(F.col("c_nationkey") == 3, F.lit(None).cast("string"))
        .otherwise(F.concat(F.lit("+1 "), F.lpad(((key * 7919) % 10000000000).cast("string"), 10, "0")))
        .alias("telephone"),
        F.when((seg == "BUILDING") & (bal < 1000), F.lit(None).cast("string"))
        .when((seg == "MACHINERY") & (bal >= 5000) & (bal < 6000),
              F.concat(local, F.lit(".example.com")))
        .otherwise(F.concat(local, F.lit("@"), F.lower(seg), F.lit(".com"))).alias("email"),
        F.lit(CUSTOMER_CREATED).alias("created_date"),
    )


def bronze_addresses(spark: SparkSession, base: str) -> DataFrame:
    """Address landing rows: customer + nation + region names."""
    c = read_table(spark, base, "customer",
                   ["c_custkey", "c_nationkey", "c_acctbal", "c_mktsegment"])
    n = read_table(spark, base, "nation", ["n_nationkey", "n_name", "n_regionkey"])
    r = read_table(spark, base, "region", ["r_regionkey", "r_name"])
    j = c.join(n, c.c_nationkey == n.n_nationkey, "left").join(r, F.col("n_regionkey") == r.r_regionkey, "left")
    key, bal = F.col("c_custkey"), F.col("c_acctbal")
    return j.select(
        key.alias("customer_id"),
        F.when(bal > 9900, F.lit("  "))
        .otherwise(F.concat(((key * 7) % 9999 + 1).cast("string"), F.lit(" "),
                            F.initcap(F.lower(F.col("c_mktsegment"))), F.lit(" Street")))
        .alias("address_line_1"),
        F.when(F.col("n_nationkey") == 24, F.lit(" 24 "))
        .otherwise(F.concat(F.lit("  "), F.lower(F.col("n_name")), F.lit(" "))).alias("city"),
        F.when(bal < -900, F.lit(None).cast("string")).otherwise(F.lower(F.col("r_name"))).alias("state"),
        F.when((bal >= 9800) & (bal < 9900), F.lit("N/A"))
        .otherwise(F.lpad(((key * 389) % 100000).cast("string"), 5, "0")).alias("postcode"),
        F.lit(CUSTOMER_CREATED).alias("created_date"),
    )


def events(spark: SparkSession, base: str) -> DataFrame:
    return read_table(spark, base, "events",
                      ["event_id", "ts", "user_id", "event_type", "value", "props"])


def event_halves(spark: SparkSession, base: str, split: str = EVENT_SPLIT) -> tuple[DataFrame, DataFrame]:
    """The whole event table cut at ``split``: (before, at-or-after)."""
    e = events(spark, base)
    cut = F.lit(split).cast("timestamp_ntz")
    return e.filter(F.col("ts") < cut), e.filter(F.col("ts") >= cut)
