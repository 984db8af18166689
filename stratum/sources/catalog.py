"""Catalog tables: namespaces, listing and existence (as used by the
original notebooks through ``schema.table`` names).

Path-based parquet folders are the default storage of this library; catalog
names work wherever a table name is accepted for append / overwrite writes.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import SparkSession


def is_table_name(target: str) -> bool:
    """``schema.table`` (or ``table``) rather than a file-system path."""
    return "/" not in target and ":" not in target


def ensure_namespaces(spark: SparkSession, names: Iterable[str]) -> None:
    for n in names:
        spark.sql(f"CREATE SCHEMA IF NOT EXISTS {n}")


def list_tables(spark: SparkSession, namespace: str) -> list[str]:
    return sorted(t.name for t in spark.catalog.listTables(namespace))


def table_exists(spark: SparkSession, name: str) -> bool:
    return spark.catalog.tableExists(name)
