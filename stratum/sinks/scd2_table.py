"""A type-2 dimension stored as current rows + append-only history.

Layout below ``path``::

    current/v000001/ ...    current rows after apply 1, 2, ... (versioned)
    history/apply=000002/   rows expired by apply 2 (written once, never rewritten)

Apply ``n`` reads only ``current/v(n-1)`` (the full-outer join of SCD2 needs
nothing else), writes the new current rows and the rows it expires in ONE job
(partitioned by ``is_current`` into a hidden staging folder), then moves the
two parts into place.  The cost of an apply is bounded by the current rows
and the changes, not by the length of the history; gold queries that need only
current rows read ``current/`` alone.

A reader pins a version ``n``: ``current/v(n)`` plus the history folders of
applies up to ``n``.  Retrying apply ``n`` rewrites exactly its own folders.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratum.operators import scd
from stratum.schemas import SCD2_CURRENT
from stratum.sinks.writer import _fs, publish, versions, version_path


def _current_root(path: str) -> str:
    return f"{path.rstrip('/')}/current"


def _history_root(path: str) -> str:
    return f"{path.rstrip('/')}/history"


def latest_version(spark: SparkSession, path: str) -> int | None:
    vs = versions(spark, _current_root(path))
    return vs[-1] if vs else None


def read_current(spark: SparkSession, path: str, version: int | None = None) -> DataFrame | None:
    n = version or latest_version(spark, path)
    if n is None:
        return None
    return spark.read.parquet(version_path(_current_root(path), n)).withColumn(
        SCD2_CURRENT, F.lit(True))


def read_dimension(spark: SparkSession, path: str, version: int | None = None) -> DataFrame | None:
    """Current rows of version ``n`` plus every row expired up to ``n``."""
    n = version or latest_version(spark, path)
    if n is None:
        return None
    cur = read_current(spark, path, n)
    fs, hist = _fs(spark, _history_root(path))
    if not fs.exists(hist) or not any(
            st.getPath().getName().startswith("apply=") for st in fs.listStatus(hist)):
        return cur
    history = (spark.read.schema(_history_schema(cur)).parquet(_history_root(path))
               .filter(F.col("apply") <= n).drop("apply")
               .withColumn(SCD2_CURRENT, F.lit(False)))
    return cur.unionByName(history, allowMissingColumns=True)


def _history_schema(cur: DataFrame):
    from pyspark.sql import types as T

    fields = [f for f in cur.schema.fields if f.name != SCD2_CURRENT]
    return T.StructType(fields + [T.StructField("apply", T.IntegerType())])


def apply(spark: SparkSession, path: str, source: DataFrame, keys: Sequence[str],
          track: Sequence[str], effective_date, order_by: Sequence[str | Column] = (),
          null_safe: bool = True, version: int | None = None,
          observation=None) -> int:
    """Apply one source snapshot; returns the new version number.

    ``observation`` (an ``Observation``) receives ``rows`` = rows written
    (new current rows + rows expired now)."""
    prev = latest_version(spark, path) if version is None else version - 1
    n = (prev or 0) + 1
    if not prev:
        out = scd.scd2_initial(source, keys, effective_date, order_by)
    else:
        current = read_current(spark, path, prev)
        classified = scd.scd2_classify(current, source, keys, track, order_by, null_safe)
        # ``current`` has no history rows, so this is exactly the new current
        # rows plus the rows expired now.
        out = scd.emit_changes(current, classified, list(keys), effective_date)
    if observation is not None:
        out = out.observe(observation, F.count(F.lit(1)).alias("rows"))
    staged = f"{path.rstrip('/')}/_staging/apply-{n:06d}"
    (out.write.mode("overwrite").option("partitionOverwriteMode", "static")
     .partitionBy(SCD2_CURRENT).parquet(staged))
    fs, _ = _fs(spark, staged)
    jvm = spark.sparkContext._jvm
    part = lambda v: jvm.org.apache.hadoop.fs.Path(f"{staged}/{SCD2_CURRENT}={v}")
    if fs.exists(part("false")):
        publish(spark, f"{staged}/{SCD2_CURRENT}=false", f"{_history_root(path)}/apply={n:06d}")
    cur_dst = version_path(_current_root(path), n)
    if fs.exists(part("true")):
        publish(spark, f"{staged}/{SCD2_CURRENT}=true", cur_dst)
    else:  # every key expired: an empty current version
        out.filter(F.lit(False)).drop(SCD2_CURRENT).write.mode("overwrite").parquet(cur_dst)
    _mark_complete(spark, cur_dst)
    return n


def _mark_complete(spark: SparkSession, folder: str) -> None:
    fs, p = _fs(spark, f"{folder}/_SUCCESS")
    if not fs.exists(p):
        fs.create(p, True).close()
