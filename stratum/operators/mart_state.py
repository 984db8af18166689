"""Gold marts kept as mergeable states: a new batch of lines updates what it touches.

Marts of few groups (``spread``) keep two key-bucketed tables (``sinks.bucketed``) below a
state folder:

``measures``  one row per group: sums in cents, counts, units, first and last date, and
              the exact number of distinct orders;
``orders``    the distinct order ids of a group, cut into chunks of 32,768 consecutive
              ids.  A chunk is a 4 KB bitmap (``bitmap_construct_agg``) where groups are
              few and dense in ids, or a sorted list of bit positions where groups are many
              and hold few of the orders each (a day has a dozen orders in a chunk: 4 KB
              would be a hundred times the list); a list has 32,768 entries at most.

Sums, minima and maxima of a batch add to the stored ones.  Distinct counts do not add,
sets of ids do: chunks are united (``bitmap_or_agg`` or a distinct of the lists), and the
count is the sum over a group's chunks.  The ids of a group that holds a third of all
orders are spread over its chunks, in the aggregate as in the buckets, so no task holds
a group.

Marts of many groups with few orders each keep one table, ``groups``: a row holds a group's
measures and the list of its order ids, so that lines and stored rows move once a batch.  A
group of more than WHOLE ids is split: its ids go to rows by chunk (a row holds the measures of
the lines it stands for), and its row without chunk keeps what has no id.  A split group stays
split.  A state that was made as two tables stays two tables.

A batch reads its own lines, the stored rows of the groups it touches and, for their
counts, the number column of their chunks; it writes these rows, or with a large batch the
buckets they are in.  Every table keeps
the tag of the last batch: uniting chunks twice changes nothing, and measures of a batch
that is repeated after a failure are not added again.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratum.functions.dates import days_since
from stratum.functions.money import avg_cents, cents_to_amount, percent_1dp, to_cents
from stratum.operators.marts import ADDRESS_COLS, CUSTOMER_COLS, _with_cents, segment
from stratum.sinks import bucketed
from stratum.sinks.bucketed import staged


@dataclass(frozen=True)
class Mart:
    name: str
    keys: tuple[str, ...]
    dense: bool   # groups hold a large part of the orders each: bitmaps; else lists of positions
    spread: bool  # few groups: their chunks are spread over all buckets


REVENUE = Mart("revenue_by_day", ("order_date", "order_month", "order_year"), False, True)
PRODUCTS = Mart("product_performance", ("item_id", "item_name", "item_category"), False, False)
STATUS = Mart("order_status_funnel", ("order_status",), True, True)
PAYMENT = Mart("payment_mix", ("payment_method",), True, True)
CUSTOMERS = Mart("customer_order_summary", ("customer_id",), False, False)
MARTS = (REVENUE, PRODUCTS, STATUS, PAYMENT, CUSTOMERS)

_SUMS = ("sum_cents", "n_priced", "units", "price_cents", "n_prices")
CHUNK = "chunk"
WHOLE = 32_768  # ids a group, in a batch or stored, up to which they stay in one row


# --------------------------------------------------------------- exact distinct counts
def distinct_chunks(rows: DataFrame, keys, id_col: str, dense: bool) -> DataFrame:
    """(keys, chunk, ids, n): the distinct non-null ids of every group, by chunk."""
    pos = F.bitmap_bit_position(id_col)
    ids = F.bitmap_construct_agg(pos) if dense else F.array_sort(F.collect_set(pos))
    out = rows.filter(F.col(id_col).isNotNull()).groupBy(
        *keys, F.bitmap_bucket_number(id_col).alias(CHUNK)).agg(ids.alias("ids"))
    return _counted(out, dense)


def _counted(chunks: DataFrame, dense: bool) -> DataFrame:
    n = F.bitmap_count("ids") if dense else F.size("ids").cast("long")
    return chunks.withColumn("n", n)


def unite_chunks(chunks: DataFrame, keys, dense: bool) -> DataFrame:
    """Chunks of the same (keys, chunk) united; the order and the repetition of rows do not count."""
    ids = F.bitmap_or_agg("ids") if dense else F.array_sort(F.array_distinct(F.flatten(F.collect_list("ids"))))
    return _counted(chunks.groupBy(*keys, CHUNK).agg(ids.alias("ids")), dense)


def count_chunks(chunks: DataFrame, keys) -> DataFrame:
    """(keys, n): the exact distinct count of every group."""
    return chunks.groupBy(*keys).agg(F.sum("n").cast("long").alias("n"))


# ------------------------------------------------------------------------------- states
def batch_measures(lines: DataFrame, keys, *more) -> DataFrame:
    lines = _with_cents(lines)
    price = to_cents("item_price")
    return lines.groupBy(*keys).agg(
        F.sum("item_total_cents").alias("sum_cents"), F.count("item_total_cents").alias("n_priced"),
        F.sum("item_quantity").cast("long").alias("units"),
        F.sum(price).alias("price_cents"), F.count(price).alias("n_prices"),
        F.min("order_date").alias("first_order_date"), F.max("order_date").alias("last_order_date"), *more)


def _paths(root: str, mart: Mart) -> tuple[str, str]:
    base = f"{root.rstrip('/')}/{mart.name}"
    return f"{base}/measures", f"{base}/orders"


def _groups(spark: SparkSession, root: str, mart: Mart) -> str | None:
    """The folder of the mart's one table; None where it keeps two."""
    base = f"{root.rstrip('/')}/{mart.name}"
    two = mart.spread or any(bucketed.is_bucketed(spark, p) for p in _paths(root, mart))
    return None if two else f"{base}/groups"


def last_batch(spark: SparkSession, root: str, mart: Mart) -> int | None:
    """The tag of the last batch in the mart's measures; None before the first."""
    m = bucketed.manifest(spark, _groups(spark, root, mart) or _paths(root, mart)[0])
    return None if m is None else m["tag"]


def _measures() -> list:
    return [*[F.sum(c).alias(c) for c in _SUMS], F.min("first_order_date").alias("first_order_date"),
            F.max("last_order_date").alias("last_order_date")]


def _large_groups(path: str, keys, lines: DataFrame, whole: int) -> DataFrame | None:
    """(kh): hashes of the groups whose ids are, or from now on are to be, kept by chunk.

    At most one of ``whole`` lines, stored or of the batch, so they can be broadcast.
    """
    spark, kh = lines.sparkSession, bucketed.key_hash(keys).alias("kh")
    large = lines.filter(F.col("order_id").isNotNull()).groupBy(kh).agg(
        F.count(F.lit(1)).alias("n")).filter(F.col("n") > whole).select("kh")
    stored = bucketed.live_rows(spark, path)
    if stored is not None:  # lists only grow and a split is kept: older rows tell it as well
        large = large.unionByName(stored.filter(F.col("split") | (F.col("n") > whole)).select(kh))
    large = staged(large.distinct(), "large-groups")
    return None if large.isEmpty() else large


def _flag_large(rows: DataFrame, keys, large: DataFrame | None) -> DataFrame:
    if large is None:
        return rows.withColumn("large", F.lit(False))
    return rows.withColumn("kh", bucketed.key_hash(keys)).join(
        F.broadcast(large.withColumn("large", F.lit(True))), "kh", "left").drop("kh").withColumn(
        "large", F.coalesce("large", F.lit(False)))


def unite_groups(rows: DataFrame, keys, large: DataFrame | None) -> DataFrame:
    """One row per (keys, chunk); the list of a group that has become large goes to its chunks."""
    if large is not None:
        rows = _flag_large(rows, keys, large).withColumn("split", F.col("split") | F.col("large"))
        listed = F.col("large") & F.col(CHUNK).isNull() & (F.size("ids") > 0)
        moved = rows.filter(listed).select(*keys, F.explode("ids").alias("id")).select(
            *keys, F.bitmap_bucket_number("id").alias(CHUNK), F.array("id").alias("ids"), F.lit(True).alias("split"))
        rows = rows.withColumn("ids", F.when(listed, F.array().cast("array<bigint>")).otherwise(F.col("ids")))
        rows = rows.drop("large").unionByName(moved, allowMissingColumns=True)
    ids = F.array_sort(F.array_distinct(F.flatten(F.collect_list("ids"))))
    return rows.groupBy(*keys, CHUNK).agg(*_measures(), F.max("split").alias("split"), ids.alias("ids")).withColumn(
        "n", F.size("ids").cast("long"))


def _add_groups(path: str, keys, lines: DataFrame, tag: int, n_buckets: int, whole: int) -> None:
    large = _large_groups(path, keys, lines, whole)
    lines = _flag_large(_with_cents(lines), keys, large).withColumn(
        CHUNK, F.when(F.col("large"), F.bitmap_bucket_number("order_id")))
    ids = F.array_sort(F.collect_set(F.col("order_id").cast("long")))
    fresh = batch_measures(lines, [*keys, CHUNK], F.max("large").alias("split"), ids.alias("ids"))
    fresh = fresh.withColumn("n", F.size("ids").cast("long"))
    if large is not None:
        # The stored row without chunk of a large group may hold a list: it takes part in the batch.
        fresh = staged(fresh, "groups")
        plain = fresh.filter("split").select(*keys).distinct().select(
            "*", F.lit(True).alias("split"), F.array().cast("array<bigint>").alias("ids"), F.lit(0).cast("long").alias("n"))
        fresh = fresh.filter("NOT split").unionByName(
            unite_groups(fresh.filter("split").unionByName(plain, allowMissingColumns=True), keys, None))
    bucketed.merge(path, fresh, [*keys, CHUNK], lambda rows: unite_groups(rows, keys, large),
                   bucket_by=keys, tag=tag, n_buckets=n_buckets)


def add_batch(root: str, mart: Mart, lines: DataFrame, tag: int,
              n_buckets: int = bucketed.BUCKETS, whole: int = WHOLE) -> bool:
    """Merge a batch of order lines into the state of a mart.

    ``tag`` numbers the batches; one that the measures already hold is left out (False).
    """
    spark, keys = lines.sparkSession, list(mart.keys)
    measures, orders = _paths(root, mart)
    done = last_batch(spark, root, mart)
    if done is not None and done >= tag:
        return False
    groups = _groups(spark, root, mart)
    if groups is not None:
        _add_groups(groups, keys, lines, tag, n_buckets, whole)
        return True
    stored = bucketed.read(spark, orders)  # a table keeps the form it was made in
    dense = mart.dense if stored is None else dict(stored.dtypes)["ids"] == "binary"
    fresh = staged(distinct_chunks(lines, keys, "order_id", dense), f"chunks-{mart.name}")
    held = bucketed.read_keys(spark, orders, fresh.select(*keys, CHUNK))
    # The chunks of few groups are spread over all buckets.  Those of many groups stay
    # together by group, so that a batch reads the buckets of its groups only.
    by = [*keys, CHUNK] if mart.spread else keys
    bucketed.replace(orders, fresh if held is None else unite_chunks(fresh.unionByName(held), keys, dense),
                     [*keys, CHUNK], bucket_by=by, tag=tag, n_buckets=n_buckets)

    new = staged(batch_measures(lines, keys), f"measures-{mart.name}")
    touched = new.select(*keys)
    parts = new.withColumn("n_orders", F.lit(None).cast("long"))
    old = bucketed.read_keys(spark, measures, touched)
    if old is not None:
        parts = parts.unionByName(old.withColumn("n_orders", F.lit(None).cast("long")))
    if mart.spread:
        stored = bucketed.read(spark, orders)
    else:
        stored = bucketed.read_keys(spark, orders, touched)
    if stored is not None:
        counts = count_chunks(stored.select(*keys, CHUNK, "n"), keys)
        parts = parts.unionByName(counts.withColumnRenamed("n", "n_orders"), allowMissingColumns=True)
    merged = parts.groupBy(*keys).agg(*_measures(), F.coalesce(F.max("n_orders"), F.lit(0)).alias("n_orders"))
    if mart.spread:  # counts of groups outside the batch came along: they are stored already
        merged = merged.filter(F.col("n_priced").isNotNull())
    bucketed.replace(measures, merged, keys, tag=tag, n_buckets=n_buckets)
    return True


def read_state(spark: SparkSession, root: str, mart: Mart) -> DataFrame | None:
    groups = _groups(spark, root, mart)
    if groups is None:
        return bucketed.read(spark, _paths(root, mart)[0])
    rows = bucketed.read(spark, groups)
    if rows is None:
        return None
    # A group that is not split is one row; only the rows of the others move.
    names = [*mart.keys, *_SUMS, "first_order_date", "last_order_date", "n_orders"]
    split = rows.filter("split").groupBy(*mart.keys).agg(*_measures(), F.sum("n").cast("long").alias("n_orders"))
    return rows.filter("NOT split").withColumnRenamed("n", "n_orders").select(*names).unionByName(split.select(*names))


# -------------------------------------------------------------------- marts from states
def revenue_by_day(state: DataFrame) -> DataFrame:
    return state.select(
        *REVENUE.keys, cents_to_amount("sum_cents").alias("total_revenue"), F.col("n_orders").alias("total_orders"),
        avg_cents("sum_cents", "n_priced").alias("avg_order_value"), F.col("units").alias("total_units_sold"),
        avg_cents("sum_cents", "n_orders").alias("avg_basket_value"))


def product_performance(state: DataFrame) -> DataFrame:
    return state.select(
        *PRODUCTS.keys, F.col("units").alias("Total_units_sold"), cents_to_amount("sum_cents").alias("Total_revenue"),
        F.col("n_orders").alias("times_ordered"), avg_cents("price_cents", "n_prices").alias("avg_price"))


def status_funnel(state: DataFrame) -> DataFrame:
    total = state.select(F.sum("n_orders")).scalar()
    return state.withColumn("_total", total).select(
        "order_status", F.col("n_orders").alias("order_count"),
        percent_1dp(F.col("n_orders"), F.col("_total")).alias("pct_of_total"))


def payment_mix(state: DataFrame) -> DataFrame:
    return state.select("payment_method", F.col("n_orders").alias("order_count"),
                        cents_to_amount("sum_cents").alias("total_revenue"))


def customer_summary(state: DataFrame, customers: DataFrame | None = None,
                     addresses: DataFrame | None = None, as_of=None) -> DataFrame:
    out = state.select(
        "customer_id", F.col("n_orders").alias("total_orders"), cents_to_amount("sum_cents").alias("lifetime_value"),
        avg_cents("sum_cents", "n_priced").alias("avg_order_value"), "last_order_date", "first_order_date",
        days_since("last_order_date", as_of).alias("days_since_last_order"),
        segment(F.col("sum_cents")).alias("customer_segment"))
    if customers is not None:
        out = out.join(customers.select(*CUSTOMER_COLS), "customer_id", "left")
    if addresses is not None:
        out = out.join(addresses.select(*ADDRESS_COLS), "customer_id", "left")
    return out
