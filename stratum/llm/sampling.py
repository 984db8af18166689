"""Bounded training samples and the folds of the classifiers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def fold(id_col: str | Column, modulus: int) -> Column:
    """crc32 of the id written as text, modulo ``modulus``; null for a null id."""
    c = F.col(id_col) if isinstance(id_col, str) else id_col
    return F.crc32(c.cast("string").cast("binary")) % F.lit(modulus)


def held_out(id_col: str | Column, modulus: int, remainder: int) -> Column:
    """True for the fold that is never learnt from; a null id counts as held out."""
    return F.coalesce(fold(id_col, modulus) == remainder, F.lit(True))


def sample_rows(rows: DataFrame, id_col: str, n: int) -> DataFrame:
    """At most ``n`` rows, those of least id hash: the same choice on every run."""
    return rows.orderBy(F.xxhash64(id_col), id_col).limit(n)


def labelled(labels: DataFrame, label_col: str, id_col: str, modulus: int,
             remainder: int) -> DataFrame:
    """(id, y): one row per labelled id outside the held-out fold.

    Null ids and null labels are left out; of contradicting labels the larger counts.
    """
    rows = labels.select(F.col(id_col), F.col(label_col).cast("int").alias("y"))
    rows = rows.filter(F.col("y").isNotNull() & ~held_out(id_col, modulus, remainder))
    return rows.groupBy(id_col).agg(F.max("y").alias("y"))


def texts_of(docs: DataFrame, chosen: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The chosen rows with their texts; one row per id, also where ids repeat.

    ``chosen`` has a bounded number of rows (a sample), so it is broadcast and the
    texts that are not chosen never leave their scan.
    """
    found = docs.select(F.col(id_col), F.col(text_col).alias("text")).join(
        F.broadcast(chosen), id_col)
    keys = [c for c in chosen.columns if c != id_col]
    return found.groupBy(id_col).agg(*[F.first(c).alias(c) for c in keys],
                                     F.min(F.coalesce("text", F.lit(""))).alias("text"))
