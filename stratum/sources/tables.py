"""Scans of stored tables.

A table is a parquet folder (or file).  ``read_table`` names the columns it
needs so the scan's ``ReadSchema`` is pruned even before Catalyst looks at the
rest of the plan.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

DRIVER_TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def table_path(base: str, name: str) -> str:
    return f"{base.rstrip('/')}/{name}.parquet"


def read_table(spark: SparkSession, base: str, name: str,
               columns: Sequence[str] | None = None) -> DataFrame:
    df = spark.read.parquet(table_path(base, name))
    return df.select(*columns) if columns else df


def table_exists(spark: SparkSession, path: str) -> bool:
    """True when ``path`` holds a readable table (parquet folder or file)."""
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.exists(hpath))
