"""Table writers: append / overwrite / merge, versions, schema evolution and
per-write metrics.

Tables are parquet folders.  Without a transactional table format there is no
in-place MERGE: a merged table is a key-bucketed table (``sinks.bucketed``) whose
manifests name the writes of each version, so a merge writes what changed.  A
table that is rewritten whole is stored as numbered versions ``v000001, ...``;
readers pin the newest complete one (``_SUCCESS`` present).

Row counts come from an ``Observation`` attached to the write itself: no
second job counts the rows.
"""

from __future__ import annotations

import datetime as _dt
import re
import time
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from stratum.schemas import SCD2_CURRENT, WRITE_METRICS
from stratum.sinks import bucketed
from stratum.sources.catalog import ensure_namespaces, is_table_name
from stratum.sources.evolution import common_schema, conform, read_mixed

MODES = ("append", "overwrite", "merge")
_VERSION = re.compile(r"^v(\d{6})$")


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def versions(spark: SparkSession, path: str) -> list[int]:
    """Complete versions of a versioned or bucketed table, ascending."""
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return []
    if bucketed.is_bucketed(spark, path):
        return bucketed.versions(spark, path)
    out = []
    for st in fs.listStatus(p):
        m = _VERSION.match(st.getPath().getName())
        if m and fs.exists(st.getPath().suffix("/_SUCCESS")):
            out.append(int(m.group(1)))
    return sorted(out)


def publish(spark: SparkSession, staged: str, final: str) -> None:
    """Move a fully written folder into place (replacing an earlier attempt).

    Staging folders start with ``_`` so readers of the parent never list
    them; the move is a rename (atomic on HDFS-like file systems).
    """
    fs, src = _fs(spark, staged)
    _, dst = _fs(spark, final)
    if fs.exists(dst):
        fs.delete(dst, True)
    fs.mkdirs(dst.getParent())
    if not fs.rename(src, dst):
        raise OSError(f"could not publish {staged} -> {final}")


def version_path(path: str, n: int) -> str:
    return f"{path.rstrip('/')}/v{n:06d}"


def read_versioned(spark: SparkSession, path: str, version: int | None = None) -> DataFrame | None:
    if bucketed.is_bucketed(spark, path):
        return bucketed.read(spark, path, version)
    vs = versions(spark, path)
    if not vs:
        return None
    n = vs[-1] if version is None else version
    df = spark.read.parquet(version_path(path, n))
    # Partition discovery types a boolean partition value as text; restore it
    # (a filter on the cast column still prunes partitions).
    if SCD2_CURRENT in df.columns and dict(df.dtypes)[SCD2_CURRENT] == "string":
        df = df.withColumn(SCD2_CURRENT, F.col(SCD2_CURRENT).cast("boolean"))
    return df


def write_version(df: DataFrame, path: str, n: int | None = None,
                  partition_by: Sequence[str] = ()) -> int:
    """Write ``df`` as version ``n`` (default: next).  Rewriting the same ``n``
    replaces only that version (idempotent retries)."""
    spark = df.sparkSession
    if n is None:
        vs = versions(spark, path)
        n = (vs[-1] + 1) if vs else 1
    # A version folder is always written whole: static overwrite, which also
    # leaves the ``_SUCCESS`` marker that readers wait for.
    w = df.write.mode("overwrite").option("partitionOverwriteMode", "static")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(version_path(path, n))
    return n


def evolve(old: DataFrame, new: DataFrame) -> DataFrame:
    """Union by name; a column missing on one side is null there, a column of two types
    has their common type (``sources.evolution``)."""
    schema = common_schema(old.schema, new.schema)
    return conform(old, schema).unionByName(conform(new, schema))


def read_evolving(spark: SparkSession, path: str) -> DataFrame:
    """Parquet folder whose files may have different column sets and column types."""
    return read_mixed(spark, path)


def write_table(df: DataFrame, path: str, mode: str = "append",
                merge_keys: Sequence[str] | None = None, order_by: Sequence[str] = (),
                partition_by: Sequence[str] = (), layer: str = "",
                table_name: str | None = None, run_time: str | None = None) -> dict:
    """Write with a mode and return one metrics record.

    * ``append`` / ``overwrite``: plain parquet writes; appended files may add
      columns (read back with ``read_evolving``).
    * ``merge``: type-1 upsert on ``merge_keys`` into a key-bucketed table
      (``sinks.bucketed``); a missing table is created, a folder of numbered
      versions becomes the first version of one.
    ``path`` may also be a catalog name ``schema.table``: append / overwrite store
    a parquet table, merge a view over a bucketed store (``merge_named``); the
    schema is created when missing.
    Unknown modes, ``merge`` without keys, and ``merge`` with ``partition_by``
    (a merged table is laid out by its keys) raise ``ValueError``.
    """
    if mode not in MODES:
        raise ValueError(f"unknown write mode {mode!r}; use one of {MODES}")
    if mode == "merge" and not merge_keys:
        raise ValueError("merge needs merge_keys")
    if mode == "merge" and partition_by:
        raise ValueError("a merged table is laid out by its keys; partition_by does not apply")
    spark = df.sparkSession
    name = table_name or path.rstrip("/").split("/")[-1]
    obs = Observation(f"write_{uuid.uuid4().hex[:12]}")
    run_time = run_time or _dt.datetime.now().strftime("%Y-%m-%d %H:%M:%S")
    t0 = time.perf_counter()
    try:
        if is_table_name(path):
            if "." in path:
                ensure_namespaces(spark, [path.rsplit(".", 1)[0]])
            counted = df.observe(obs, F.count(F.lit(1)).alias("rows"))
            if mode == "merge":
                merge_named(counted, path, merge_keys, order_by)
            else:
                if merged_store(spark, path):
                    raise ValueError(f"{path} is a merged table; use mode 'merge'")
                (counted.write.mode(mode).format("parquet").partitionBy(*partition_by)
                 .saveAsTable(path))
        elif mode == "merge":
            if not bucketed.is_bucketed(spark, path) and versions(spark, path):
                bucketed.replace(path, read_versioned(spark, path), merge_keys)
            bucketed.upsert(path, df.observe(obs, F.count(F.lit(1)).alias("rows")), merge_keys,
                            order_by)
        else:
            w = df.observe(obs, F.count(F.lit(1)).alias("rows")).write.mode(mode)
            if partition_by:
                w = w.partitionBy(*partition_by)
            w.parquet(path)
        rows = int(obs.get.get("rows", 0))
        return dict(run_time=run_time, layer=layer, table_name=name, mode=mode,
                    status="PASS", rows=rows, elapsed_s=round(time.perf_counter() - t0, 3),
                    message=f"Written {rows} rows -> {path} (mode={mode})")
    except ValueError:
        raise
    except Exception as e:  # record, then re-raise
        record = dict(run_time=run_time, layer=layer, table_name=name, mode=mode,
                      status="FAIL", rows=0, elapsed_s=round(time.perf_counter() - t0, 3),
                      message=str(e)[:500])
        raise WriteFailed(record) from e


STORE_PROPERTY = "stratum.store"


def merged_store(spark: SparkSession, name: str) -> str | None:
    """The bucketed store behind a merged catalog name; None for any other name."""
    if not spark.catalog.tableExists(name) or spark.catalog.getTable(name).tableType != "VIEW":
        return None
    rows = spark.sql(f"SHOW TBLPROPERTIES {name}").filter(F.col("key") == STORE_PROPERTY).collect()
    return rows[0]["value"] if rows else None


def merge_named(source: DataFrame, name: str, keys: Sequence[str],
                order_by: Sequence[str | Column] = ()) -> int:
    """Type-1 merge into a catalog name; returns the version of its store.

    The rows live in a bucketed store below the schema's location; the name is a view
    over the newest version's files, replaced by one catalog statement per merge, so
    readers of the name see one whole version.  Touched buckets are rewritten
    (``compact_at=0``): the view is a plain union of scans.  A parquet table of that
    name becomes the first version and is dropped once the store holds its rows.
    """
    spark = source.sparkSession
    store = merged_store(spark, name)
    plain = store is None and spark.catalog.tableExists(name)
    if store is None:
        schema, _, table = name.rpartition(".")
        root = spark.catalog.getDatabase(schema or spark.catalog.currentDatabase()).locationUri
        store = f"{root.rstrip('/')}/_merged/{table}-{uuid.uuid4().hex[:8]}"
    if plain:
        bucketed.replace(store, spark.table(name), keys)
    version = bucketed.upsert(store, source, keys, order_by, compact_at=0.0)
    if plain:
        spark.sql(f"DROP TABLE {name}")
    text = bucketed.select_text(store, bucketed.manifest(spark, store))
    spark.sql(f"CREATE OR REPLACE VIEW {name} TBLPROPERTIES ('{STORE_PROPERTY}' = '{store}') AS {text}")
    return version


def write_checked(df: DataFrame, rules, table_name: str, path: str, *,
                  run_time: str | None = None, on_null: str = "drop", report_sink=None,
                  partition_by: Sequence[str] = (), layer: str = "") -> dict:
    """Evaluate DQ rules and overwrite ``path`` with the clean rows in ONE pass.

    The rule counts are an ``Observation`` on the write (placed before the
    drop filter, so every rule sees all rows); the rows go to a hidden staging
    folder next to the table and are published (renamed into place) only when
    no ``fail`` rule fired.  On a failure the report rows up to that rule are
    handed to ``report_sink``, the staging folder is removed and
    ``DQFailure`` is raised: readers never see the rejected data.
    """
    from stratum.operators.quality import (
        DQFailure, apply_expectations, counts_of, expect_all, first_failure, report_rows,
        rows_frame, rule_aggregates)

    spark = df.sparkSession
    run_time = run_time or _dt.datetime.now().strftime("%Y-%m-%d %H:%M:%S")
    tag = uuid.uuid4().hex[:12]
    t0 = time.perf_counter()
    checks, written = Observation(f"dq_{tag}"), Observation(f"rows_{tag}")
    if on_null == "reference":
        # This policy filters a rule only when it has true failures, so the
        # counts must be known before the filter: one aggregate job first.
        known = counts_of(expect_all(df, rules).first(), rules)
        failing = {name for name, (_, f, _) in known.items() if f > 0}
        clean = apply_expectations(df, rules, on_null, failing=failing)
    elif not rules:
        known, clean = {}, df
    else:
        known = None
        clean = apply_expectations(df.observe(checks, *rule_aggregates(rules)), rules, on_null)
    clean = clean.observe(written, F.count(F.lit(1)).alias("rows"))
    parent, name = path.rstrip("/").rsplit("/", 1)
    staged = f"{parent}/_staging/{name}-{tag}"
    w = clean.write.mode("overwrite").option("partitionOverwriteMode", "static")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(staged)
    counts = known if known is not None else counts_of(checks.get, rules)
    rows = report_rows(rules, counts, table_name, run_time)
    bad = first_failure(rules, counts)
    if bad is not None:
        rows = rows[: bad + 1]
    if report_sink is not None:
        report_sink(rows_frame(spark, rows))
    if bad is not None:
        fs, p = _fs(spark, staged)
        fs.delete(p, True)
        raise DQFailure(table_name, rules[bad], counts[rules[bad].name][1], rows)
    publish(spark, staged, path)
    n = int(written.get.get("rows", 0))
    # WARN when a warn / drop rule found failing rows (as the original run log did)
    flagged = [r.name for r in rules if r.action != "fail" and counts[r.name][1] > 0]
    note = f"; rules with failures: {', '.join(flagged)}" if flagged else ""
    return dict(run_time=run_time, layer=layer, table_name=name, mode="overwrite",
                status="WARN" if flagged else "PASS", rows=n,
                elapsed_s=round(time.perf_counter() - t0, 3),
                message=f"Written {n} rows -> {path} (checked{note})")


class WriteFailed(Exception):
    def __init__(self, record: dict):
        super().__init__(record["message"])
        self.record = record


def metrics_frame(spark: SparkSession, records: list[dict]) -> DataFrame:
    """Write-metrics records (one per table write) as a DataFrame."""
    rows = [tuple(r.get(f.name) for f in WRITE_METRICS.fields) for r in records]
    return spark.createDataFrame(rows, WRITE_METRICS)


STATUSES = ("PASS", "WARN", "FAIL")


def summarize_metrics(metrics: DataFrame, raise_on_failure: bool = False) -> dict[str, int]:
    """Tables per status (PASS / WARN / FAIL) of a metrics frame or table.

    An aggregate: at most one row per status reaches the driver.  With
    ``raise_on_failure`` a run with any FAIL raises, as the original run log's
    summary did.
    """
    rows = metrics.groupBy("status").agg(F.count(F.lit(1)).alias("n")).collect()
    counts = {s: 0 for s in STATUSES} | {r.status: int(r.n) for r in rows}
    if raise_on_failure and counts.get("FAIL", 0):
        raise RuntimeError(f"{counts['FAIL']} table write(s) failed: {counts}")
    return counts


def append_metrics(spark: SparkSession, records: list[dict], path: str) -> None:
    if records:
        metrics_frame(spark, records).write.mode("append").parquet(path)
