"""Full refresh of the layered tables from a landing folder.

landing (JSON orders / customers, CSV addresses)
  -> bronze (all landing files + lineage columns, overwrite; or, with
     ``incremental_bronze``, only new files appended by availableNow streams)
  -> silver (cleaned; the rules and the write share one pass, published only
     if no ``fail`` rule fired; report appended; or, with
     ``incremental_silver``, only new bronze rows, one folder per micro-batch)
  -> dimensions (type-1 customers merged into a versioned table; type-2
     addresses applied to current rows + append-only history)
  -> gold (order totals once, then five marts, overwrite)

With ``incremental_gold`` the dimensions and marts read new silver batches only: type-1
customers and type-2 addresses are key-bucketed tables updated for the keys of the
batches, the marts are mergeable states (``operators.mart_state``).

Every step is a Spark job over whole tables; the functions only call each
other in order (there is no scheduler).  Each write returns a metrics record
observed on the write itself; the records are appended to ``_metrics``.
"""

from __future__ import annotations

import datetime as _dt
import time as _time
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from stratum.functions.dates import age_group, age_years
from stratum.operators import mart_state, marts, scd
from stratum.operators.quality import DQFailure
from stratum.operators.silver import (
    clean_addresses,
    clean_customers,
    clean_orders,
    stamp_processed,
)
from stratum.plans.rules import address_rules, customer_rules, order_rules
from stratum.schemas import ADDRESSES_RAW, CUSTOMERS_RAW, ORDERS_RAW
from stratum.sinks import bucketed, scd2_table, writer
from stratum.sources.landing import read_landing, with_lineage
from stratum.streaming import batches
from stratum.streaming.ingest import ingest_entities, run_available_now

CUSTOMER_KEY = ["customer_id"]
ADDRESS_TRACK = ["address_line_1", "city", "state", "postcode"]
# Landing entities: folder name, format, declared schema.
ENTITIES = {
    "orders": ("json", ORDERS_RAW),
    "customers": ("json", CUSTOMERS_RAW),
    "addresses": ("csv", ADDRESSES_RAW),
}


@dataclass
class Refresh:
    """Paths and clock of one run."""

    landing: str
    warehouse: str
    as_of: str | None = None          # effective date; default: today
    run_time: str | None = None       # stamp of report / metrics rows
    on_null: str = "drop"             # DQ drop policy for NULL conditions
    sources: dict[str, str] = field(default_factory=dict)  # entity -> landing folder
    # Bronze by availableNow streams: each run appends only files that arrived
    # since the previous run (instead of re-reading every landing file).
    incremental_bronze: bool = False
    # Silver by availableNow streams over the bronze tables (needs
    # incremental_bronze): only new bronze rows are cleaned and checked; each
    # micro-batch is written (or rejected by a ``fail`` rule) on its own.
    incremental_silver: bool = False
    # Dimensions and marts from new silver batches only (needs incremental_silver).
    incremental_gold: bool = False
    buckets: int = bucketed.BUCKETS   # of the incremental dimensions and states
    metrics: list[dict] = field(default_factory=list)

    def __post_init__(self):
        now = _dt.datetime.now()
        self.as_of = self.as_of or now.date().isoformat()
        self.run_time = self.run_time or now.strftime("%Y-%m-%d %H:%M:%S")

    def table(self, layer: str, name: str) -> str:
        return f"{self.warehouse.rstrip('/')}/{layer}/{name}"


def _write(cfg: Refresh, df: DataFrame, layer: str, name: str, mode: str = "overwrite",
           **kw) -> None:
    try:
        cfg.metrics.append(writer.write_table(df, cfg.table(layer, name), mode, layer=layer,
                                              table_name=name, run_time=cfg.run_time, **kw))
    except writer.WriteFailed as e:
        cfg.metrics.append(e.record)
        raise


def _failed(cfg: Refresh, layer: str, name: str, err: Exception) -> None:
    cfg.metrics.append(dict(run_time=cfg.run_time, layer=layer, table_name=name, mode="overwrite",
                            status="FAIL", rows=0, message=str(err)[:500]))


def run_bronze(spark: SparkSession, cfg: Refresh) -> None:
    folders = {name: cfg.sources.get(name, f"{cfg.landing.rstrip('/')}/{name}")
               for name in ENTITIES}
    if cfg.incremental_bronze:
        rows: dict[str, int] = {}
        t0 = _time.perf_counter()
        ingest_entities(
            spark, {name: (folders[name], fmt, schema)
                    for name, (fmt, schema) in ENTITIES.items()},
            cfg.table("bronze", ""), f"{cfg.warehouse.rstrip('/')}/_checkpoints/bronze",
            rows_out=rows)
        for name, n in rows.items():
            cfg.metrics.append(dict(
                run_time=cfg.run_time, layer="bronze", table_name=name, mode="append",
                status="PASS", rows=n, elapsed_s=round(_time.perf_counter() - t0, 3),
                message=f"Appended {n} new rows -> {cfg.table('bronze', name)} (stream)"))
        return
    for name, (fmt, schema) in ENTITIES.items():
        raw = read_landing(spark, folders[name], fmt, schema)
        _write(cfg, with_lineage(raw), "bronze", name)


def _report_sink(cfg: Refresh):
    def sink(report: DataFrame) -> None:
        report.write.mode("append").parquet(cfg.table("gold", "dq_report"))
    return sink


def _silver_transforms(cfg: Refresh):
    return {
        "orders": (lambda df: stamp_processed(clean_orders(df)), order_rules(), "silver_orders"),
        "customers": (lambda df: stamp_processed(clean_customers(df, cfg.as_of)),
                      customer_rules(cfg.as_of), "silver_customers"),
        "addresses": (lambda df: stamp_processed(clean_addresses(df)), address_rules(),
                      "silver_addresses"),
    }


def run_silver_incremental(spark: SparkSession, cfg: Refresh) -> None:
    """Silver as availableNow streams over the bronze tables.

    Each table gets one folder per micro-batch (``batch_id=n``); the per-batch
    DQ reports go to ``gold/dq_report_batches/<table>/``.  A replayed batch
    rewrites only its own folders.
    """
    if not cfg.incremental_bronze:
        raise ValueError("incremental_silver needs incremental_bronze")
    for name, (transform, rules, label) in _silver_transforms(cfg).items():
        bronze = cfg.table("bronze", name)
        src = spark.readStream.schema(spark.read.parquet(bronze).schema).parquet(bronze)
        sink = batches.dq_sink(rules, label, cfg.table("silver", name),
                               cfg.table("gold", f"dq_report_batches/{name}"),
                               transform=transform, run_time=cfg.run_time, on_null=cfg.on_null)
        t0 = _time.perf_counter()
        try:
            n = run_available_now(src, f"{cfg.warehouse.rstrip('/')}/_checkpoints/silver/{name}",
                                  foreach_batch=sink)
        except Exception as e:
            _failed(cfg, "silver", name, e)
            raise
        cfg.metrics.append(dict(
            run_time=cfg.run_time, layer="silver", table_name=name, mode="append",
            status="PASS", rows=n, elapsed_s=round(_time.perf_counter() - t0, 3),
            message=f"Checked and appended {n} new bronze rows -> {cfg.table('silver', name)}"))


def read_silver(spark: SparkSession, cfg: Refresh, name: str) -> DataFrame:
    """A silver table, whole (batch folders of the incremental mode included)."""
    df = spark.read.parquet(cfg.table("silver", name))
    return df.drop("batch_id") if "batch_id" in df.columns else df


def run_silver(spark: SparkSession, cfg: Refresh) -> None:
    if cfg.incremental_silver:
        run_silver_incremental(spark, cfg)
        return
    for name, (transform, rules, label) in _silver_transforms(cfg).items():
        df = transform(spark.read.parquet(cfg.table("bronze", name)))
        # one pass: rule counts observed on the write, published only if no
        # ``fail`` rule fired
        try:
            cfg.metrics.append(writer.write_checked(
                df, rules, label, cfg.table("silver", name), run_time=cfg.run_time,
                on_null=cfg.on_null, report_sink=_report_sink(cfg), layer="silver"))
        except DQFailure as e:
            _failed(cfg, "silver", name, e)
            raise


def silver_after(spark: SparkSession, cfg: Refresh, name: str,
                 done: int | None) -> tuple[DataFrame | None, int]:
    """(rows of the silver batches after ``done``, the newest batch); None without new ones.

    Only the folders of the new batches are read.
    """
    path = cfg.table("silver", name)
    fs, p = writer._fs(spark, path)
    found = [st.getPath().getName() for st in fs.listStatus(p)] if fs.exists(p) else []
    ids = sorted(int(n.split("=", 1)[1]) for n in found if n.startswith("batch_id="))
    new = [i for i in ids if done is None or i > done]
    if not new:
        return None, ids[-1] if ids else -1
    rows = spark.read.option("basePath", path).parquet(*[batches.batch_folder(path, i) for i in new])
    return rows.drop("batch_id"), ids[-1]


def _tag(spark: SparkSession, path: str) -> int | None:
    m = bucketed.manifest(spark, path)
    return None if m is None else m["tag"]


def run_dimensions_incremental(spark: SparkSession, cfg: Refresh) -> None:
    """Dimensions from the silver batches they have not seen.

    The latest address row per key is kept beside the type-2 dimension, so a row that is
    older than the known one changes nothing; intervals are derived for the keys of the
    new batches alone.
    """
    if not cfg.incremental_silver:
        raise ValueError("incremental_gold needs incremental_silver")
    order = ["created_date", "_ingested_at"]

    def record(name: str, mode: str, rows: int, t0: float, note: str) -> None:
        cfg.metrics.append(dict(run_time=cfg.run_time, layer="silver", table_name=name, mode=mode,
                                status="PASS", rows=rows, elapsed_s=round(_time.perf_counter() - t0, 3),
                                message=note))

    t0, path = _time.perf_counter(), cfg.table("silver", "dim_customers")
    new, newest = silver_after(spark, cfg, "customers", _tag(spark, path))
    rows = 0
    if new is not None:
        obs = Observation(f"dim_{_dt.datetime.now().timestamp()}")
        bucketed.upsert(path, new.observe(obs, F.count(F.lit(1)).alias("rows")), CUSTOMER_KEY, order,
                        compete=True, tag=newest, n_buckets=cfg.buckets)
        rows = int(obs.get.get("rows", 0))
    record("dim_customers", "merge", rows, t0, f"Merged {rows} new rows -> {path}")

    t0, path = _time.perf_counter(), cfg.table("silver", "dim_addresses")
    latest = cfg.table("silver", "latest_addresses")
    new, newest = silver_after(spark, cfg, "addresses", _tag(spark, path))
    rows = 0
    if new is not None:
        bucketed.upsert(latest, new, CUSTOMER_KEY, order, compete=True, tag=newest, n_buckets=cfg.buckets)
        keys = new.select(*CUSTOMER_KEY)
        now = bucketed.read_keys(spark, latest, keys)
        held = bucketed.read_keys(spark, path, keys)
        out = (scd.scd2_initial(now, CUSTOMER_KEY, cfg.as_of, order) if held is None else
               scd.scd2_apply(held, now, CUSTOMER_KEY, ADDRESS_TRACK, cfg.as_of, order))
        out = bucketed.staged(out, "dim-addresses")
        rows = out.count()
        bucketed.replace(path, out, CUSTOMER_KEY, tag=newest, n_buckets=cfg.buckets)
    record("dim_addresses", "scd2", rows, t0, f"Replaced {rows} rows of the keys met -> {path}")


def run_gold_incremental(spark: SparkSession, cfg: Refresh) -> None:
    """Every mart's state takes the silver batches it has not seen; gold is read off the states."""
    root = cfg.table("gold", "_state")
    for mart in mart_state.MARTS:
        new, newest = silver_after(spark, cfg, "orders", mart_state.last_batch(spark, root, mart))
        if new is not None:
            mart_state.add_batch(root, mart, new, newest, cfg.buckets)
    state = lambda mart: mart_state.read_state(spark, root, mart)
    # A stored age is that of the day its row was loaded; gold shows the age on ``as_of``.
    customers = bucketed.read(spark, cfg.table("silver", "dim_customers")).withColumn(
        "age", age_years("date_of_birth", cfg.as_of)).withColumn("age_group", age_group("age"))
    addresses = scd.scd2_current(bucketed.read(spark, cfg.table("silver", "dim_addresses")))
    for mart, out in (
            (mart_state.REVENUE, mart_state.revenue_by_day), (mart_state.PRODUCTS, mart_state.product_performance),
            (mart_state.STATUS, mart_state.status_funnel), (mart_state.PAYMENT, mart_state.payment_mix),
            (mart_state.CUSTOMERS, lambda s: mart_state.customer_summary(s, customers, addresses, cfg.as_of))):
        if state(mart) is not None:
            _write(cfg, out(state(mart)), "gold", mart.name)


def run_dimensions(spark: SparkSession, cfg: Refresh) -> None:
    if cfg.incremental_gold:
        run_dimensions_incremental(spark, cfg)
        return
    customers = read_silver(spark, cfg, "customers")
    _write(cfg, customers, "silver", "dim_customers", "merge", merge_keys=CUSTOMER_KEY,
           order_by=["created_date", "_ingested_at"])

    addresses = read_silver(spark, cfg, "addresses")
    path = cfg.table("silver", "dim_addresses")
    obs = Observation(f"scd2_{_dt.datetime.now().timestamp()}")
    t0 = _time.perf_counter()
    n = scd2_table.apply(spark, path, addresses, CUSTOMER_KEY, ADDRESS_TRACK, cfg.as_of,
                         order_by=["created_date", "_ingested_at"], observation=obs)
    rows = int(obs.get.get("rows", 0))
    cfg.metrics.append(dict(run_time=cfg.run_time, layer="silver", table_name="dim_addresses",
                            mode="scd2", status="PASS", rows=rows,
                            elapsed_s=round(_time.perf_counter() - t0, 3),
                            message=f"Written {rows} rows -> {path} version {n}"))


def run_gold(spark: SparkSession, cfg: Refresh) -> None:
    if cfg.incremental_gold:
        run_gold_incremental(spark, cfg)
        return
    lines = read_silver(spark, cfg, "orders")
    customers = writer.read_versioned(spark, cfg.table("silver", "dim_customers"))
    addresses = scd2_table.read_current(spark, cfg.table("silver", "dim_addresses"))
    # Order-level totals: the lines are scanned and shuffled once for the four
    # order-level marts (written, so the marts read a stored table).
    _write(cfg, marts.order_totals(lines), "silver", "order_totals")
    orders = spark.read.parquet(cfg.table("silver", "order_totals"))
    _write(cfg, marts.revenue_by_day(orders), "gold", "revenue_by_day")
    _write(cfg, marts.product_performance(lines), "gold", "product_performance")
    _write(cfg, marts.status_funnel(orders), "gold", "order_status_funnel")
    _write(cfg, marts.payment_mix(orders), "gold", "payment_mix")
    _write(cfg, marts.customer_summary(orders, customers, addresses, cfg.as_of), "gold",
           "customer_order_summary")


LAYERS = (run_bronze, run_silver, run_dimensions, run_gold)


def full_refresh(spark: SparkSession, cfg: Refresh) -> DataFrame:
    """Run every layer in order; stop at the first failure.  Returns the
    metrics of this run (also appended to ``<warehouse>/_metrics``)."""
    try:
        for layer in LAYERS:
            layer(spark, cfg)
    finally:
        writer.append_metrics(spark, cfg.metrics, f"{cfg.warehouse.rstrip('/')}/_metrics")
    return writer.metrics_frame(spark, cfg.metrics)


def main(argv: list[str] | None = None) -> int:
    """``spark-submit stratum/plans/refresh.py --landing L --warehouse W [...]``.

    The session comes from the submitting environment (cluster master,
    ``spark.checkpoint.dir``, ...); nothing is configured here.
    """
    import argparse

    ap = argparse.ArgumentParser(description="Full refresh: landing -> bronze -> silver -> gold")
    ap.add_argument("--landing", required=True)
    ap.add_argument("--warehouse", required=True)
    ap.add_argument("--as-of", default=None, help="effective date (default: today)")
    ap.add_argument("--on-null", default="drop", choices=["drop", "keep", "reference"])
    ap.add_argument("--incremental-bronze", action="store_true",
                    help="append only new landing files to bronze (availableNow streams)")
    ap.add_argument("--incremental-silver", action="store_true",
                    help="clean and check only new bronze rows (needs --incremental-bronze)")
    ap.add_argument("--incremental-gold", action="store_true",
                    help="update dimensions and marts from new silver batches only "
                         "(needs --incremental-silver)")
    args = ap.parse_args(argv)
    spark = SparkSession.builder.appName("stratum-refresh").getOrCreate()
    cfg = Refresh(args.landing, args.warehouse, as_of=args.as_of, on_null=args.on_null,
                  incremental_bronze=args.incremental_bronze,
                  incremental_silver=args.incremental_silver,
                  incremental_gold=args.incremental_gold)
    try:
        metrics = full_refresh(spark, cfg)
    finally:
        for m in cfg.metrics:
            print(f"{m['status']:4s} {m['layer']:6s} {m['table_name']:28s} {m['rows']:>12} rows "
                  f"{m.get('elapsed_s') or 0:>8.1f} s")
        n = {st: sum(m["status"] == st for m in cfg.metrics) for st in writer.STATUSES}
        print(f"SUMMARY {n['PASS']} passed, {n['WARN']} warned, {n['FAIL']} failed")
    return 0 if all(r.status != "FAIL" for r in metrics.collect()) else 1


if __name__ == "__main__":
    import sys

    sys.exit(main())
