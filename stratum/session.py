"""Session construction and the shared working folder.

Library code never builds its own session: every operator takes DataFrames
(or a ``SparkSession`` handed in by the caller).  ``local_session`` exists for
tests, ``bench.py`` and scripts only.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings that matter at scale.  They are applied by ``local_session`` and
# recommended for cluster jobs (see README "Running on a cluster").
RECOMMENDED_CONF: dict[str, str] = {
    # Adaptive execution: runtime join re-planning (sort-merge -> broadcast when
    # a side is measured small), skew splitting and partition coalescing.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # A side is broadcast only when its size is below these bounds; beyond
    # them the join stays a shuffle join.  The static bound applies to the
    # planner's file-size estimate, the adaptive one to the bytes a finished
    # shuffle stage actually measured.
    "spark.sql.autoBroadcastJoinThreshold": str(10 * 1024 * 1024),
    "spark.sql.adaptive.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.files.maxPartitionBytes": str(128 * 1024 * 1024),
    # AQE coalesces shuffle partitions towards this size.
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(128 * 1024 * 1024),
}


def cluster_conf(input_bytes: int, bytes_per_partition: int = 256 * 1024 * 1024,
                 min_partitions: int = 200, max_partitions: int = 100_000) -> dict[str, str]:
    """Settings for a cluster job reading about ``input_bytes`` of parquet.

    The initial shuffle partition count gives every reducer roughly
    ``bytes_per_partition`` of (compressed) input, so a partition fits in
    executor memory with room for decompression and sort buffers; AQE then
    coalesces small partitions and splits skewed ones.  Example: 100 TB ->
    100,000 partitions (the cap); 1 TB -> 4,096.
    """
    parts = max(min_partitions, min(max_partitions, -(-input_bytes // bytes_per_partition)))
    return {**RECOMMENDED_CONF, "spark.sql.shuffle.partitions": str(parts)}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "stratum", extra: dict[str, str] | None = None) -> SparkSession:
    """A local-mode session for tests and benchmarks (UI off, no server)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", os.environ.get("STRATUM_DRIVER_MEMORY", "16g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for k, v in {**RECOMMENDED_CONF, **(extra or {})}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared folder named by ``spark.checkpoint.dir``.

    On a cluster this setting names a shared, durable folder and is only read.
    When it is unset (a bare local test session) a private folder is made and
    registered with ``setCheckpointDir`` (the setting itself cannot change at
    runtime).
    """
    sc = spark.sparkContext
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base:
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(base)
        return base.rstrip("/")
    current = sc.getCheckpointDir()
    if current:
        return current.rstrip("/")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="stratum-ckpt-"))
    return sc.getCheckpointDir().rstrip("/")


def work_path(spark: SparkSession, *parts: str, unique: bool = False) -> str:
    """A path below the shared checkpoint folder.

    ``unique=True`` appends a fresh id so that concurrent or repeated runs
    never share (and never have to delete) a folder.
    """
    segs = [ensure_checkpoint_dir(spark), "stratum", *parts]
    if unique:
        segs.append(uuid.uuid4().hex[:12])
    return "/".join(s.strip("/") if i else s for i, s in enumerate(segs))
