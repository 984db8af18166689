"""``foreachBatch`` sinks: data quality and dimensions on a stream.

Every sink is idempotent per ``batch_id``: the output of batch ``b`` goes to a
folder (or table version) named by ``b`` and is overwritten on a retry, and it
is computed only from inputs that precede ``b``.  A batch replayed after a
failure therefore produces the same result exactly once.
"""

from __future__ import annotations

import datetime as _dt
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from stratum.operators.quality import (
    DQFailure,
    Rule,
    apply_expectations,
    counts_of,
    expect_all,
    first_failure,
    pass_rate_expr,
    report_rows,
    rows_frame,
    rule_aggregates,
)
from stratum.operators.scd import latest_per_key, scd2_history
from stratum.sinks import bucketed
from stratum.sinks.writer import _fs, publish

BatchFn = Callable[[DataFrame, int], None]


def batch_folder(path: str, batch_id: int) -> str:
    return f"{path.rstrip('/')}/batch_id={batch_id}"


def dq_sink(rules: Sequence[Rule], table_name: str, clean_path: str, report_path: str,
            transform: Callable[[DataFrame], DataFrame] | None = None,
            run_time: str | None = None, on_null: str = "drop") -> BatchFn:
    """Per micro-batch: transform, evaluate rules, write clean rows + report.

    One pass over the batch: the rule counts are an ``Observation`` on the
    clean write itself (placed before the drop filter, so every rule sees all
    rows).  The clean rows are written to a hidden staging folder and
    published only when no ``fail`` rule fired; on a failure the report rows
    up to that rule are written and ``DQFailure`` stops the stream.
    """

    def run(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        _check_no_later_batches(spark, clean_path, batch_id)
        df = transform(batch) if transform else batch
        obs = Observation(f"dq_{table_name}_{batch_id}_{uuid.uuid4().hex[:8]}")
        staged = f"{clean_path.rstrip('/')}/_staging/batch_id={batch_id}"
        if not rules:
            df.write.mode("overwrite").parquet(staged)
            counts = {}
        elif on_null == "reference":
            # filters depend on the counts: one aggregate job first
            counts = counts_of(expect_all(df, rules).first(), rules)
            failing = {n for n, (_, f, _) in counts.items() if f > 0}
            apply_expectations(df, rules, on_null, failing=failing) \
                .write.mode("overwrite").parquet(staged)
        else:
            observed = df.observe(obs, *rule_aggregates(rules))
            apply_expectations(observed, rules, on_null).write.mode("overwrite").parquet(staged)
            counts = counts_of(obs.get, rules)
        stamp = run_time or _dt.datetime.now().strftime("%Y-%m-%d %H:%M:%S")
        rows = report_rows(rules, counts, table_name, stamp)
        bad = first_failure(rules, counts)
        if bad is not None:
            rows = rows[: bad + 1]
        report = rows_frame(spark, rows).withColumn("batch_id", F.lit(batch_id))
        report.write.mode("overwrite").parquet(batch_folder(report_path, batch_id))
        if bad is not None:
            raise DQFailure(table_name, rules[bad], counts[rules[bad].name][1], rows)
        publish(spark, staged, batch_folder(clean_path, batch_id))

    return run


def _check_no_later_batches(spark, path: str, batch_id: int) -> None:
    """Folders of later batches mean the output belongs to another run of the
    stream (a new checkpoint over an old folder): refuse to mix them."""
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return
    for st in fs.listStatus(p):
        name = st.getPath().getName()
        if name.startswith("batch_id=") and int(name.split("=", 1)[1]) > batch_id:
            raise RuntimeError(
                f"{path} holds output of batch {name.split('=', 1)[1]} > {batch_id}; a restarted "
                "stream with a new checkpoint needs a new output folder")


def sum_batch_reports(reports: DataFrame) -> DataFrame:
    """Per-batch DQ reports summed per rule: counts add up over batches, so
    the result equals the report of one pass over all the rows."""
    agg = reports.groupBy("table_name", "rule_name", "action").agg(
        F.sum("pass_count").alias("pass_count"), F.sum("fail_count").alias("fail_count"),
        F.sum("null_count").alias("null_count"))
    return agg.withColumn("pass_rate", pass_rate_expr(F.col("pass_count"), F.col("fail_count")))


def read_batches(spark, path: str) -> DataFrame:
    """All batch folders of a ``dq_sink`` output (``batch_id`` column added)."""
    return spark.read.parquet(path)


def _no_later_version(spark, path: str, batch_id: int) -> None:
    """A version made by a later batch belongs to another run of the stream (a new
    checkpoint over an old table): refuse rather than mix them."""
    m = bucketed.manifest(spark, path)
    if m is not None and m["tag"] is not None and m["tag"] > batch_id:
        raise RuntimeError(
            f"{path} holds output of batch {m['tag']} > {batch_id}; a restarted stream with a new "
            "checkpoint needs a new table folder")


def scd1_sink(path: str, keys: Sequence[str], order_by: Sequence[str | Column],
              columns: Sequence[str] | None = None, n_buckets: int = bucketed.BUCKETS) -> BatchFn:
    """Type-1 dimension in a key-bucketed table, upserted once per batch.

    A batch writes its own winning rows only.  Stored rows compete on ``order_by``, so the
    result does not depend on the order of arrival, and a batch that is replayed finds
    its rows stored and changes nothing.
    """

    def run(batch: DataFrame, batch_id: int) -> None:
        src = batch.select(*columns) if columns else batch
        _no_later_version(batch.sparkSession, path, batch_id)
        bucketed.upsert(path, src, keys, order_by=order_by, compete=True, tag=batch_id,
                        n_buckets=n_buckets)

    return run


def scd2_paths(path: str) -> tuple[str, str]:
    """(snapshots, dimension) below the folder of an ``scd2_sink``."""
    return f"{path.rstrip('/')}/snapshots", f"{path.rstrip('/')}/dimension"


def scd2_sink(path: str, keys: Sequence[str], track: Sequence[str], snapshot_col: str,
              order_by: Sequence[str | Column], columns: Sequence[str] | None = None,
              snapshot_expr: Column | None = None, n_buckets: int = bucketed.BUCKETS) -> BatchFn:
    """Type-2 dimension on a stream, late rows included.

    Two key-bucketed tables: the latest row per (key, snapshot), and the intervals.  A batch

    1. merges its rows into the snapshots (stored rows compete on ``order_by``),
    2. reads the snapshots of the keys it holds (their buckets only),
    3. derives these keys' intervals anew and replaces them.

    A late row thereby splits the interval it falls into, re-closes the one before, or
    joins two that it shows to be one; keys outside the batch are neither derived nor
    written.  Any order of arrival ends in the intervals of ``scd2_history`` over all rows.
    Both steps can be repeated: a replayed batch changes nothing.
    """
    snapshots, dimension = scd2_paths(path)

    def run(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        src = batch.select(*columns) if columns else batch
        if snapshot_expr is not None:
            src = src.withColumn(snapshot_col, snapshot_expr)
        _no_later_version(spark, dimension, batch_id)
        # One row per (key, snapshot), read for the merge and for its keys.
        src = bucketed.staged(latest_per_key(src, [*keys, snapshot_col], order_by), "scd2-batch")
        bucketed.upsert(snapshots, src, [*keys, snapshot_col], order_by=order_by, compete=True,
                        bucket_by=list(keys), tag=batch_id, n_buckets=n_buckets)
        mine = bucketed.read_keys(spark, snapshots, src.select(*keys))
        if mine is not None:
            bucketed.replace(dimension, scd2_history(mine, keys, track, snapshot_col, order_by),
                             keys, tag=batch_id, n_buckets=n_buckets)

    return run


def read_scd2(spark, path: str) -> DataFrame | None:
    """The dimension (all intervals) that an ``scd2_sink`` keeps."""
    return bucketed.read(spark, scd2_paths(path)[1])
