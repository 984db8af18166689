"""Registered queries that go through files: landing scans, writers, streams.

Landing copies of the derived entities are written once per input folder
below the shared checkpoint folder and reused; outputs of writes and streams
go to fresh folders (one per call) so that no run depends on, or deletes,
another run's files.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratum.operators import mart_state
from stratum.operators.asof import asof_join
from stratum.operators.silver import clean_orders
from stratum.plans import layers as L
from stratum.plans import oracle as O
from stratum.plans.registry import SILVER_LINE_COLS
from stratum.plans.rules import order_rules
from stratum.schemas import ADDRESSES_RAW, CUSTOMERS_RAW, EVENTS, ORDERS_RAW
from stratum.session import work_path
from stratum.sinks import quarantine, writer
from stratum.sources import derive
from stratum.sources.evolution import read_mixed
from stratum.sources.landing import (
    landing_copy, read_landing, with_lineage, write_landing, write_landing_split)
from stratum.streaming import batches, dedup, inferred
from stratum.streaming.ingest import ingest_entities, run_available_now, stream_landing

LANDING_FILES = 8
# Landing files of the order stream, and files per micro-batch: a batch
# should hold at least as many files as there are cores to fill.
ORDER_STREAM_FILES = 32
ORDER_FILES_PER_BATCH = 16
EVENT_FILES = 32
EVENT_FILES_PER_BATCH = 8
# Buckets of the streamed dimensions: a bucket should hold some hundred MB of them.
STREAM_BUCKETS = 4


def _customers_json(spark, base) -> str:
    return landing_copy(spark, base, "customers", derive.bronze_customers(spark, base), "json",
                        LANDING_FILES)


def _addresses_csv(spark, base) -> str:
    return landing_copy(spark, base, "addresses", derive.bronze_addresses(spark, base), "csv",
                        LANDING_FILES)


def _orders_json(spark, base) -> str:
    return landing_copy(spark, base, "orders", derive.bronze_orders_table(spark, base), "json",
                        ORDER_STREAM_FILES, write_landing_split)


def _events_json(spark, base) -> str:
    ev = derive.events(spark, base)
    # Files cut by time range (sampled bounds): balanced even when one day
    # holds most events, and in time order, so the stream sees time slices.
    files = ev.repartitionByRange(EVENT_FILES, "ts", "event_id")
    return landing_copy(spark, base, "events", files, "json")


# ------------------------------------------------------------- batch scans
def bronze_json(spark: SparkSession, base: str) -> DataFrame:
    return read_landing(spark, _customers_json(spark, base), "json", CUSTOMERS_RAW)


def bronze_json_inferred(spark: SparkSession, base: str) -> DataFrame:
    """The original notebooks' form: JSON read with an inferred schema (an
    extra pass over the files).  JSON numbers infer as bigint, text stays text."""
    raw = read_landing(spark, _customers_json(spark, base), "json", infer=True)
    return raw.select(*CUSTOMERS_RAW.fieldNames())


def bronze_csv(spark: SparkSession, base: str) -> DataFrame:
    return read_landing(spark, _addresses_csv(spark, base), "csv", ADDRESSES_RAW)


def bronze_orders_json(spark: SparkSession, base: str) -> DataFrame:
    """Nested JSON orders read back and flattened into silver lines."""
    raw = read_landing(spark, _orders_json(spark, base), "json", ORDERS_RAW)
    return clean_orders(raw).select(*SILVER_LINE_COLS)


def bronze_lineage(spark: SparkSession, base: str) -> DataFrame:
    raw = with_lineage(read_landing(spark, _customers_json(spark, base), "json", CUSTOMERS_RAW))
    return raw.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count("_source_file").alias("n_tagged"),
        F.count("_ingested_at").alias("n_stamped"),
        F.count_if(F.col("_source_file").startswith("part-")).alias("n_part_files"),
    )


# ------------------------------------------------------------------ writes
def write_evolve(spark: SparkSession, base: str) -> DataFrame:
    """Append a batch that has one more column; read both back by name."""
    first, second = derive.event_halves(spark, base)
    path = work_path(spark, "evolve", unique=True)
    first.drop("props").write.mode("append").parquet(path)
    second.write.mode("append").parquet(path)
    return writer.read_evolving(spark, path).select(*EVENTS.fieldNames())


def write_metrics(spark: SparkSession, base: str) -> DataFrame:
    """Row counts observed on the writes themselves (no extra count job)."""
    root = work_path(spark, "silver", unique=True)
    records = [
        writer.write_table(L.silver_customers(spark, base), f"{root}/customers", "overwrite",
                           layer="silver", table_name="silver_customers", run_time=L.RUN_TIME),
        writer.write_table(L.silver_addresses(spark, base), f"{root}/addresses", "overwrite",
                           layer="silver", table_name="silver_addresses", run_time=L.RUN_TIME),
    ]
    return writer.metrics_frame(spark, records).select("table_name", "mode", "status", "rows")


def write_merge(spark: SparkSession, base: str) -> DataFrame:
    """Two merges into a versioned type-1 table (first half, then second)."""
    first, second = L.user_profiles(spark, base)
    path = work_path(spark, "dim_users_scd1", unique=True)
    writer.write_table(first, path, "merge", merge_keys=L.USER_KEY, order_by=L.EVENT_ORDER)
    writer.write_table(second, path, "merge", merge_keys=L.USER_KEY, order_by=L.EVENT_ORDER)
    return writer.read_versioned(spark, path).drop("ts")


# ----------------------------------------------------------------- streams
def stream_ingest(spark: SparkSession, base: str) -> DataFrame:
    """Events landing files -> availableNow stream -> parquet sink."""
    src = stream_landing(spark, _events_json(spark, base), "json", EVENTS,
                         max_files_per_trigger=EVENT_FILES_PER_BATCH)
    root = work_path(spark, "stream_ingest", unique=True)
    run_available_now(with_lineage(src), f"{root}/_checkpoint", f"{root}/data")
    return spark.read.parquet(f"{root}/data").select(*EVENTS.fieldNames())


def stream_bronze_counts(spark: SparkSession, base: str) -> DataFrame:
    """The three landing entities streamed into bronze tables; entities per table."""
    root = work_path(spark, "stream_bronze", unique=True)
    tables = ingest_entities(spark, {
        "orders_raw": (_orders_json(spark, base), "json", ORDERS_RAW),
        "customers_raw": (_customers_json(spark, base), "json", CUSTOMERS_RAW),
        "addresses_raw": (_addresses_csv(spark, base), "csv", ADDRESSES_RAW),
    }, f"{root}/bronze", f"{root}/_checkpoints", max_files_per_trigger=ORDER_FILES_PER_BATCH)
    # Entities ingested (an order may arrive as several nested records) and
    # rows that lack the source-file lineage column (expected: none).
    keys = {"orders_raw": "order_id", "customers_raw": "customer_id",
            "addresses_raw": "customer_id"}
    counts = [spark.read.parquet(p).agg(F.count_distinct(keys[name]).alias("n_keys"),
                                        F.count_if(F.col("_source_file").isNull())
                                        .alias("n_untagged"))
              .select(F.lit(name).alias("table_name"), "n_keys", "n_untagged")
              for name, p in tables.items()]
    out = counts[0]
    for c in counts[1:]:
        out = out.unionByName(c)
    return out


def _orders_dq_stream(spark: SparkSession, base: str) -> str:
    src = stream_landing(spark, _orders_json(spark, base), "json", ORDERS_RAW,
                         max_files_per_trigger=ORDER_FILES_PER_BATCH)
    root = work_path(spark, "stream_dq", unique=True)
    sink = batches.dq_sink(order_rules(), "silver_orders", f"{root}/clean", f"{root}/report",
                           transform=clean_orders, run_time=L.RUN_TIME)
    run_available_now(src, f"{root}/_checkpoint", foreach_batch=sink)
    return root


def stream_dq(spark: SparkSession, base: str) -> DataFrame:
    """Nested orders stream -> silver lines -> drop rules, per micro-batch."""
    root = _orders_dq_stream(spark, base)
    return batches.read_batches(spark, f"{root}/clean").select(*SILVER_LINE_COLS)


def stream_dq_report(spark: SparkSession, base: str) -> DataFrame:
    """Per-batch reports summed per rule (counts are additive over batches)."""
    root = _orders_dq_stream(spark, base)
    return batches.sum_batch_reports(batches.read_batches(spark, f"{root}/report"))


def stream_scd1(spark: SparkSession, base: str) -> DataFrame:
    src = stream_landing(spark, _events_json(spark, base), "json", EVENTS,
                         max_files_per_trigger=EVENT_FILES_PER_BATCH)
    root = work_path(spark, "stream_scd1", unique=True)
    sink = batches.scd1_sink(f"{root}/dim", L.USER_KEY, L.EVENT_ORDER, L.PROFILE_COLS,
                             n_buckets=STREAM_BUCKETS)
    run_available_now(src, f"{root}/_checkpoint", foreach_batch=sink)
    return writer.read_versioned(spark, f"{root}/dim").drop("ts")


def stream_scd2(spark: SparkSession, base: str) -> DataFrame:
    src = stream_landing(spark, _events_json(spark, base), "json", EVENTS,
                         max_files_per_trigger=EVENT_FILES_PER_BATCH)
    root = work_path(spark, "stream_scd2", unique=True)
    sink = batches.scd2_sink(f"{root}/dim", L.USER_KEY, L.USER_TRACK, "snapshot_date", L.EVENT_ORDER,
                             L.PROFILE_COLS, F.to_date("ts"), n_buckets=STREAM_BUCKETS)
    run_available_now(src, f"{root}/_checkpoint", foreach_batch=sink)
    return batches.read_scd2(spark, f"{root}/dim").drop("ts")


def stream_scd2_late(spark: SparkSession, base: str) -> DataFrame:
    """The same dimension from events that arrive in an arbitrary order: batches mix
    old and new days, so later batches split and re-close stored intervals."""
    ev = derive.events(spark, base)
    mixed = landing_copy(spark, base, "events_mixed",
                         ev.repartition(EVENT_FILES, F.xxhash64("event_id")), "json")
    src = stream_landing(spark, mixed, "json", EVENTS, max_files_per_trigger=EVENT_FILES_PER_BATCH)
    root = work_path(spark, "stream_scd2_late", unique=True)
    sink = batches.scd2_sink(f"{root}/dim", L.USER_KEY, L.USER_TRACK, "snapshot_date", L.EVENT_ORDER,
                             L.PROFILE_COLS, F.to_date("ts"), n_buckets=STREAM_BUCKETS)
    run_available_now(src, f"{root}/_checkpoint", foreach_batch=sink)
    return batches.read_scd2(spark, f"{root}/dim").drop("ts")


def write_merge_named(spark: SparkSession, base: str) -> DataFrame:
    """Two merges into a catalog name; the name is read back as a table."""
    first, second = L.user_profiles(spark, base)
    name = f"stratum_merge.users_{uuid.uuid4().hex[:8]}"
    for half in (first, second):
        writer.write_table(half, name, "merge", merge_keys=L.USER_KEY, order_by=L.EVENT_ORDER)
    return spark.table(name).drop("ts")


def write_widen(spark: SparkSession, base: str) -> DataFrame:
    """Appends whose columns have other types (int, then bigint and double): read as one."""
    first, second = derive.event_halves(spark, base)
    path = work_path(spark, "widen", unique=True)
    first.select("event_id", F.col("user_id").cast("int").alias("user_id"),
                 F.floor("value").cast("int").alias("value")).write.mode("append").parquet(path)
    second.select("event_id", "user_id", "value", "event_type").write.mode("append").parquet(path)
    return writer.read_evolving(spark, path).select("event_id", "user_id", "value", "event_type")


# ------------------------------------------------------------ full refresh
def refresh_customer_summary(spark: SparkSession, base: str) -> DataFrame:
    """Full refresh (landing -> bronze -> silver -> dims -> gold) over the
    derived landing files; returns the stored gold customer summary."""
    from stratum.operators.marts import SUMMARY_COLS
    from stratum.plans.refresh import Refresh, full_refresh

    cfg = Refresh(landing="", warehouse=work_path(spark, "warehouse", unique=True),
                  as_of=L.AS_OF, run_time=L.RUN_TIME,
                  sources={"orders": _orders_json(spark, base),
                           "customers": _customers_json(spark, base),
                           "addresses": _addresses_csv(spark, base)})
    full_refresh(spark, cfg)
    return spark.read.parquet(cfg.table("gold", "customer_order_summary")).select(*SUMMARY_COLS)


def refresh_incremental_summary(spark: SparkSession, base: str) -> DataFrame:
    """The same refresh with bronze and silver as availableNow streams."""
    from stratum.operators.marts import SUMMARY_COLS
    from stratum.plans.refresh import Refresh, full_refresh

    cfg = Refresh(landing="", warehouse=work_path(spark, "warehouse", unique=True),
                  as_of=L.AS_OF, run_time=L.RUN_TIME,
                  incremental_bronze=True, incremental_silver=True,
                  sources={"orders": _orders_json(spark, base),
                           "customers": _customers_json(spark, base),
                           "addresses": _addresses_csv(spark, base)})
    full_refresh(spark, cfg)
    return spark.read.parquet(cfg.table("gold", "customer_order_summary")).select(*SUMMARY_COLS)


# --------------------------------------------- quarantine, copies, schemas, versions
def dq_quarantine(spark: SparkSession, base: str) -> DataFrame:
    """Order lines split by one write: clean and rejected rows counted by failed rules."""
    root = work_path(spark, "quarantine", unique=True)
    quarantine.write_quarantined(L.silver_order_lines(spark, base), order_rules(), "silver_orders",
                                 f"{root}/clean", f"{root}/rejected", run_time=L.RUN_TIME)
    clean = spark.read.parquet(f"{root}/clean").withColumn("rejected", F.lit(0))
    bad = quarantine.read_rejected(spark, f"{root}/rejected")
    both = clean if bad is None else clean.unionByName(bad.drop("run").withColumn("rejected", F.lit(1)))
    return both.groupBy("rejected", F.array_join(quarantine.FAILED, ",").alias("failed_rules")).agg(
        F.count(F.lit(1)).alias("n_lines"), F.sum("item_total_cents").cast("long").alias("cents"))


def stream_dedup(spark: SparkSession, base: str) -> DataFrame:
    """Every event file delivered twice; each event is stored once."""
    files = _events_json(spark, base)
    root = work_path(spark, "stream_dedup", unique=True)
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    for n in range(2):
        src, dst = jvm.org.apache.hadoop.fs.Path(files), jvm.org.apache.hadoop.fs.Path(f"{root}/landing/d{n}")
        jvm.org.apache.hadoop.fs.FileUtil.copy(src.getFileSystem(conf), src, dst.getFileSystem(conf), dst, False, conf)
    stream = stream_landing(spark, f"{root}/landing", "json", EVENTS, max_files_per_trigger=EVENT_FILES_PER_BATCH)
    dedup.run_deduplicated(dedup.dedup_deliveries(stream, ["event_id"], "ts", "60 days"), f"{root}/_checkpoint",
                           f"{root}/data")
    return spark.read.parquet(f"{root}/data").select(*EVENTS.fieldNames())


def stream_inferred(spark: SparkSession, base: str) -> DataFrame:
    """Two deliveries without a declared schema; the second has another column and a wider type."""
    first, second = derive.event_halves(spark, base)
    root = work_path(spark, "stream_inferred", unique=True)
    whole = first.select("event_id", "user_id", F.floor("value").cast("long").alias("value"))
    wider = second.select("event_id", "user_id", "value", "event_type")
    for n, rows in enumerate((whole, wider)):
        write_landing(rows, f"{root}/landing/d{n}", "json", EVENT_FILES_PER_BATCH)
        src = inferred.stream_inferred(spark, f"{root}/landing", "json", f"{root}/_schema")
        run_available_now(src, f"{root}/_checkpoint", f"{root}/data")
    return read_mixed(spark, f"{root}/data").select("event_id", "user_id", "value", "event_type")


def dim_as_of(spark: SparkSession, base: str) -> DataFrame:
    """Every event with the user's profile version that was valid on the day before."""
    ev = derive.events(spark, base).select("event_id", "user_id", "ts")
    return asof_join(ev, L.user_dim_history(spark, base), L.USER_KEY, F.date_sub(F.to_date("ts"), 1),
                     columns=["event_type", "effective_start"], prefix="dim_", bucket_days=7).drop("ts")


# ------------------------------------------------- marts kept as mergeable states
def _mart_from_batches(mart, finish):
    """The silver lines in three batches (an order may be in several), merged into a state."""
    def query(spark: SparkSession, base: str) -> DataFrame:
        root = work_path(spark, "mart_state", unique=True)
        lines = L.silver_orders_clean(spark, base)
        part = F.pmod(F.xxhash64("order_id", "item_id", "item_price"), F.lit(3))
        for n in range(3):
            mart_state.add_batch(root, mart, lines.filter(part == n), n, n_buckets=STREAM_BUCKETS)
        return finish(mart_state.read_state(spark, root, mart))

    return query


def refresh_marts_summary(spark: SparkSession, base: str) -> DataFrame:
    """Two deliveries, a refresh after each: dimensions and marts take the second one only."""
    from stratum.operators.marts import SUMMARY_COLS
    from stratum.plans.refresh import Refresh, full_refresh

    root = work_path(spark, "deliveries", unique=True)
    orders = derive.bronze_orders_table(spark, base)
    second = F.pmod(F.xxhash64("order_id", F.size("items")), F.lit(4)) == 0
    late = F.col("customer_id") % 3 == 0
    deliveries = [(~second, ~late), (second, late)]
    wh = work_path(spark, "warehouse", unique=True)
    for day, (of_orders, of_customers) in enumerate(deliveries):
        write_landing_split(orders.filter(of_orders), f"{root}/orders/day{day}", "json", ORDER_FILES_PER_BATCH)
        write_landing(derive.bronze_customers(spark, base).filter(of_customers),
                      f"{root}/customers/day{day}", "json", LANDING_FILES)
        write_landing(derive.bronze_addresses(spark, base).filter(of_customers),
                      f"{root}/addresses/day{day}", "csv", LANDING_FILES)
        cfg = Refresh(landing=root, warehouse=wh, as_of=L.AS_OF, run_time=L.RUN_TIME,
                      incremental_bronze=True, incremental_silver=True, incremental_gold=True,
                      buckets=STREAM_BUCKETS)
        full_refresh(spark, cfg)
    return spark.read.parquet(cfg.table("gold", "customer_order_summary")).select(*SUMMARY_COLS)


MART_QUERIES = {
    "mart_revenue_by_day": _mart_from_batches(mart_state.REVENUE, mart_state.revenue_by_day),
    "mart_product_performance": _mart_from_batches(mart_state.PRODUCTS, mart_state.product_performance),
    "mart_status_funnel": _mart_from_batches(mart_state.STATUS, mart_state.status_funnel),
    "mart_payment_mix": _mart_from_batches(mart_state.PAYMENT, mart_state.payment_mix),
}


def queries() -> dict:
    return {
        "bronze_json": bronze_json,
        "bronze_json_inferred": bronze_json_inferred,
        "bronze_csv": bronze_csv,
        "bronze_orders_json": bronze_orders_json,
        "bronze_lineage": bronze_lineage,
        "write_evolve": write_evolve,
        "write_metrics": write_metrics,
        "write_merge": write_merge,
        "write_merge_named": write_merge_named,
        "write_widen": write_widen,
        "stream_ingest": stream_ingest,
        "stream_bronze_counts": stream_bronze_counts,
        "stream_dq": stream_dq,
        "stream_dq_report": stream_dq_report,
        "stream_scd1": stream_scd1,
        "stream_scd2": stream_scd2,
        "stream_scd2_late": stream_scd2_late,
        "refresh_customer_summary": refresh_customer_summary,
        "refresh_incremental_summary": refresh_incremental_summary,
        "dq_quarantine": dq_quarantine,
        "stream_dedup": stream_dedup,
        "stream_inferred": stream_inferred,
        "dim_as_of": dim_as_of,
        **MART_QUERIES,
        "refresh_marts_summary": refresh_marts_summary,
    }


def oracle_sql() -> dict:
    core = O.oracle_sql()
    split = derive.EVENT_SPLIT
    return {
        "bronze_json": f"with {O.CUSTOMERS}\nselect * from bronze_customers",
        "bronze_json_inferred": f"with {O.CUSTOMERS}\nselect * from bronze_customers",
        "bronze_csv": f"with {O.ADDRESSES}\nselect * from bronze_addresses",
        "bronze_orders_json": core["silver_order_lines"],
        "bronze_lineage": """select count(*) as n_rows, count(*) as n_tagged, count(*) as n_stamped,
  count(*) as n_part_files from customer""",
        "write_evolve": f"""select event_id, ts, user_id, event_type, value,
  case when ts >= timestamp '{split}' then props end as props from events""",
        "write_metrics": """select 'silver_customers' as table_name, 'overwrite' as mode, 'PASS' as status,
  count(*) as rows from customer
union all
select 'silver_addresses', 'overwrite', 'PASS', count(*) from customer""",
        "write_merge": core["scd1_upsert"],
        "write_merge_named": core["scd1_upsert"],
        "write_widen": f"""select event_id, user_id, floor(value) as value, null as event_type
  from events where ts < timestamp '{split}'
union all by name
select event_id, user_id, value, event_type from events where ts >= timestamp '{split}'""",
        "stream_ingest": "select event_id, ts, user_id, event_type, value, props from events",
        "stream_bronze_counts": """select 'orders_raw' as table_name, count(*) as n_keys,
  cast(0 as bigint) as n_untagged from orders
union all select 'customers_raw', count(*), cast(0 as bigint) from customer
union all select 'addresses_raw', count(*), cast(0 as bigint) from customer""",
        "stream_dq": core["dq_clean"],
        "stream_dq_report": O.dq_orders_totals_sql(),
        "stream_scd1": """select user_id, event_id, event_type, value from (
  select *, row_number() over (partition by user_id order by ts desc, event_id desc) as rn
  from events) where rn = 1""",
        "stream_scd2": core["scd2_history"],
        "stream_scd2_late": core["scd2_history"],
        "refresh_customer_summary": core["gold_customer_summary"],
        "refresh_incremental_summary": core["gold_customer_summary"],
        "dq_quarantine": O.dq_quarantine_sql(),
        "stream_dedup": "select event_id, ts, user_id, event_type, value, props from events",
        "stream_inferred": f"""select event_id, user_id, floor(value) as value, null as event_type
  from events where ts < timestamp '{split}'
union all by name
select event_id, user_id, value, event_type from events where ts >= timestamp '{split}'""",
        "dim_as_of": f"""select e.event_id, e.user_id, h.event_type as dim_event_type,
  h.effective_start as dim_effective_start
from (select *, cast(ts as date) - 1 as day from events) e
asof left join (select user_id, event_type, effective_start from ({core["scd2_history"]})) h
  on e.user_id = h.user_id and e.day >= h.effective_start""",
        "mart_revenue_by_day": core["gold_revenue_by_day"],
        "mart_product_performance": core["gold_product_performance"],
        "mart_status_funnel": core["gold_status_funnel"],
        "mart_payment_mix": core["gold_payment_mix"],
        "refresh_marts_summary": core["gold_customer_summary"],
    }
