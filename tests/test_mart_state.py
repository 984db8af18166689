"""Marts as mergeable states: equal to the marts over all lines, whatever the batches."""

import os
import random

import pytest
from pyspark.sql import functions as F

from stratum.operators import mart_state, marts
from stratum.plans.refresh import Refresh, full_refresh, silver_after
from stratum.sinks import bucketed
from tests.test_refresh import _land

LINE = ("order_id long, customer_id long, order_date date, order_month int, order_year int, order_status string, "
        "payment_method string, item_id long, item_name string, item_category string, item_price double, "
        "item_quantity int")
FULL = [(mart_state.REVENUE, mart_state.revenue_by_day, lambda x: marts.revenue_by_day(x, sort=False)),
        (mart_state.PRODUCTS, mart_state.product_performance, lambda x: marts.product_performance(x, sort=False)),
        (mart_state.STATUS, mart_state.status_funnel, marts.status_funnel),
        (mart_state.PAYMENT, mart_state.payment_mix, marts.payment_mix),
        (mart_state.CUSTOMERS, lambda s: mart_state.customer_summary(s, as_of="2025-01-15"),
         lambda x: marts.customer_summary(x, as_of="2025-01-15"))]


def _lines(rng, n):
    import datetime as dt

    out = []
    for _ in range(n):
        o = rng.choice((None, -7, 1 << 45, *range(60), *range(32760, 32790), 10_000_000))
        day = dt.date(2024, 1, 1) + dt.timedelta(days=rng.randrange(40))
        item = rng.choice((None, 1, 2, 3))
        out.append((o, rng.choice((None, 1, 1, 1, 2, 3, 4)), rng.choice((None, day)), day.month, day.year,
                    rng.choice(("Completed", "Completed", "Pending", None)), rng.choice(("PayPal", None)), item,
                    f"i{item}", rng.choice(("c", "d")), rng.choice((None, 1.25, 19.99)), rng.randrange(1, 4)))
    return out


def rows_of(df, cols=None):
    return sorted((tuple(r) for r in (df.select(*cols) if cols else df).collect()), key=str)


@pytest.mark.parametrize("mart,finish,full", FULL, ids=[m.name for m, _, _ in FULL])
def test_batches_equal_the_mart_over_all_lines(spark, tmp_dir, mart, finish, full):
    rng = random.Random(len(mart.name))
    lines, at = _lines(rng, 400), 0
    for tag, size in enumerate((150, 0, 10, 240)):
        batch = spark.createDataFrame(lines[at:at + size], LINE)
        at += size
        assert mart_state.add_batch(tmp_dir, mart, batch, tag, n_buckets=4)
        assert not mart_state.add_batch(tmp_dir, mart, batch, tag, n_buckets=4)  # repeated
    want = full(spark.createDataFrame(lines, LINE))
    assert rows_of(finish(mart_state.read_state(spark, tmp_dir, mart)), want.columns) == rows_of(want)


def test_a_batch_repeated_after_its_chunks_were_stored_counts_once(spark, tmp_dir, monkeypatch):
    mart = mart_state.STATUS
    first, second = (spark.createDataFrame(_lines(random.Random(s), 80), LINE) for s in (1, 2))
    mart_state.add_batch(tmp_dir, mart, first, 0, n_buckets=2)
    with monkeypatch.context() as m:
        m.setattr(mart_state, "batch_measures", lambda *a: 1 / 0)  # dies between the two tables
        with pytest.raises(ZeroDivisionError):
            mart_state.add_batch(tmp_dir, mart, second, 1, n_buckets=2)
    mart_state.add_batch(tmp_dir, mart, second, 1, n_buckets=2)
    want = marts.status_funnel(first.unionByName(second))
    assert rows_of(mart_state.status_funnel(mart_state.read_state(spark, tmp_dir, mart)), want.columns) == rows_of(want)


@pytest.mark.parametrize("dense", [True, False])
def test_chunks_count_exactly_with_a_hot_group_and_any_union(spark, dense):
    rows = spark.range(200_000).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("g"), F.col("id") % 50)).alias("g"),
        F.when(F.col("id") % 11 == 0, None).otherwise(F.col("id") * 7 % 90_000).alias("o"))
    want = rows_of(rows.groupBy("g").agg(F.count_distinct("o").alias("n")))
    a = mart_state.distinct_chunks(rows.filter("o < 50000 or o is null"), ["g"], "o", dense)
    b = mart_state.distinct_chunks(rows.filter("o > 30000"), ["g"], "o", dense)
    united = mart_state.unite_chunks(a.unionByName(b).unionByName(a), ["g"], dense)
    assert rows_of(mart_state.count_chunks(united, ["g"])) == want
    # the hot group's ids are in several rows, each of bounded size
    assert united.filter("g = 'hot'").count() == 4  # chunks 0 (the id 0) to 3


def test_two_day_refresh_equals_the_full_one_and_reads_day_two_only(spark, samples, tmp_dir):
    landing = os.path.join(tmp_dir, "landing")
    full, inc = os.path.join(tmp_dir, "full"), os.path.join(tmp_dir, "inc")
    steps = dict(incremental_bronze=True, incremental_silver=True, incremental_gold=True, buckets=4)
    for day, as_of in ((1, "2024-10-01"), (2, "2025-01-14")):
        _land(samples, landing, day)
        full_refresh(spark, Refresh(landing, full, as_of=as_of, run_time=f"r{day}"))
        cfg = Refresh(landing, inc, as_of=as_of, run_time=f"r{day}", **steps)
        if day == 2:
            before = set(os.listdir(f"{inc}/silver/orders"))
        full_refresh(spark, cfg)
    names = ["revenue_by_day", "product_performance", "order_status_funnel", "payment_mix", "customer_order_summary"]
    for name in names:
        want = spark.read.parquet(f"{full}/gold/{name}")
        assert rows_of(spark.read.parquet(f"{inc}/gold/{name}"), want.columns) == rows_of(want), name
    # the rows handed to the marts on day 2 come from the folders of day 2 alone
    new, newest = silver_after(spark, cfg, "orders", max(int(n.split("=")[1]) for n in before if "=" in n))
    assert new.inputFiles() and all(f"batch_id={newest}" in f for f in new.inputFiles())
    assert mart_state.last_batch(spark, f"{inc}/gold/_state", mart_state.CUSTOMERS) == newest
    dim = bucketed.read(spark, f"{inc}/silver/dim_addresses")
    assert dim.count() == 16 and sorted(r.customer_id for r in dim.filter("not is_current").collect()) == [1001, 1004, 1006]
    # nothing new: no table changes
    seen = bucketed.versions(spark, f"{inc}/silver/dim_customers")
    full_refresh(spark, Refresh(landing, inc, as_of="2025-01-14", run_time="r3", **steps))
    assert bucketed.versions(spark, f"{inc}/silver/dim_customers") == seen


def test_products_keep_one_row_a_group_and_split_large_ones(spark, tmp_dir):
    lines = spark.createDataFrame(_lines(random.Random(5), 900), LINE).withColumn(
        "item_id", F.coalesce(F.when(F.col("item_quantity") > 1, F.col("item_id")), F.xxhash64("item_price", "order_date")))
    part, done = F.pmod(F.xxhash64(*lines.columns), F.lit(10)), None
    for tag, batch in enumerate(((part < 3), (part >= 3) & (part < 5), (part >= 5) & (part < 9), part == 9)):
        batch = lines.filter(batch)
        assert mart_state.add_batch(tmp_dir, mart_state.PRODUCTS, batch, tag, n_buckets=4, whole=20)
        assert not mart_state.add_batch(tmp_dir, mart_state.PRODUCTS, batch, tag, n_buckets=4, whole=20)
        done = batch if done is None else done.unionByName(batch)
        want = marts.product_performance(done, sort=False)
        state = mart_state.read_state(spark, tmp_dir, mart_state.PRODUCTS)
        assert rows_of(mart_state.product_performance(state), want.columns) == rows_of(want)
    rows = bucketed.read(spark, f"{tmp_dir}/{mart_state.PRODUCTS.name}/groups")
    keys = list(mart_state.PRODUCTS.keys)
    assert rows.filter("not split").groupBy(*keys).count().filter("count > 1").isEmpty()
    assert rows.filter("split and chunk is null and size(ids) > 0").isEmpty()
    assert rows.filter("not split and n > 40").isEmpty()
    assert rows.filter("split").select("chunk").distinct().count() > 3


def test_a_product_state_of_two_tables_stays_so(spark, tmp_dir, monkeypatch):
    first, second = (spark.createDataFrame(_lines(random.Random(s), 80), LINE) for s in (1, 2))
    with monkeypatch.context() as m:
        m.setattr(mart_state, "_groups", lambda *a: None)  # as states were made before
        mart_state.add_batch(tmp_dir, mart_state.PRODUCTS, first, 0, n_buckets=2)
    assert mart_state.last_batch(spark, tmp_dir, mart_state.PRODUCTS) == 0
    mart_state.add_batch(tmp_dir, mart_state.PRODUCTS, second, 1, n_buckets=2)
    want = marts.product_performance(first.unionByName(second), sort=False)
    assert rows_of(mart_state.product_performance(mart_state.read_state(spark, tmp_dir, mart_state.PRODUCTS)),
                   want.columns) == rows_of(want)


def test_products_move_once_a_batch(spark, tmp_dir):
    """A group's ids are one row, however far apart the ids; a large batch leaves no deltas."""
    lines = spark.range(6000).select(
        (F.col("id") * 40_000).alias("order_id"), F.lit(1).alias("customer_id"), F.lit("2024-01-01").cast("date").alias("order_date"),
        F.lit(1).alias("order_month"), F.lit(2024).alias("order_year"), F.lit("s").alias("order_status"),
        F.lit("p").alias("payment_method"), (F.col("id") % 300).alias("item_id"), F.lit("n").alias("item_name"),
        F.lit("c").alias("item_category"), F.lit(1.0).alias("item_price"), F.lit(1).alias("item_quantity"))
    for tag in range(2):
        mart_state.add_batch(tmp_dir, mart_state.PRODUCTS, lines.filter(f"id % 2 = {tag}".replace("id", "order_id div 40000")),
                             tag, n_buckets=4)
    path = f"{tmp_dir}/{mart_state.PRODUCTS.name}/groups"
    assert bucketed.read(spark, path).count() == 300
    assert {w["kind"] for w in bucketed.manifest(spark, path)["writes"]} == {"base"}
    assert mart_state.read_state(spark, tmp_dir, mart_state.PRODUCTS).agg(F.sum("n_orders")).first()[0] == 6000


def test_incremental_gold_needs_incremental_silver(spark, tmp_dir):
    from stratum.plans.refresh import run_dimensions

    with pytest.raises(ValueError):
        run_dimensions(spark, Refresh(tmp_dir, tmp_dir, incremental_gold=True))
