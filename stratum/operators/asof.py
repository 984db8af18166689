"""Join facts to the version of a dimension that was valid on their date.

A type-2 history holds half-open intervals per key.  The join is an equi-join on
(key, range of dates): every fact falls into one range of ``bucket_days`` days, an
interval stands in each range it meets, clipped to the range of the facts, so open
intervals stay finite.  The residual condition picks the interval.  A customer with
very many facts is thereby spread over as many tasks as there are ranges, where a join
on the key alone would bring all of that key's facts and versions to one task; adaptive
execution still splits a range that dominates, and broadcasts the history where its
size allows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratum.schemas import SCD2_CURRENT, SCD2_END, SCD2_START


def asof_join(facts: DataFrame, history: DataFrame, keys: Sequence[str], date_col: str | Column,
              columns: Sequence[str] | None = None, prefix: str = "", bucket_days: int = 30,
              how: str = "left") -> DataFrame:
    """All columns of ``facts`` and the dimension ``columns`` (prefixed) valid on the date.

    ``how`` is ``left`` (a fact without a valid version keeps nulls) or ``inner``.  Keys are
    compared null-safe, as the dimension operators do; a null date meets no version.
    Intervals of a key must not overlap (zero-length ones never match).
    """
    if how not in ("left", "inner"):
        raise ValueError("how must be 'left' or 'inner'")
    if bucket_days < 1:
        raise ValueError("bucket_days must be positive")
    keys = list(keys)
    if columns is None:
        columns = [c for c in history.columns if c not in (*keys, SCD2_START, SCD2_END, SCD2_CURRENT)]
    clash = {f"{prefix}{c}".lower() for c in columns} & {c.lower() for c in facts.columns}
    if clash:
        raise ValueError(f"columns of both sides: {sorted(clash)}; give a prefix")
    day = (F.col(date_col) if isinstance(date_col, str) else date_col).cast("date")
    bucket = lambda d: F.floor(F.unix_date(d) / F.lit(bucket_days)).cast("int")
    left = facts.withColumn("__day", day).withColumn("__bucket", bucket(F.col("__day")))
    ends = left.agg(F.min("__day").alias("lo"), F.max("__day").alias("hi")).first()
    if ends["lo"] is None:  # no dated fact
        lo = hi = F.lit(None).cast("date")
    else:
        lo, hi = F.lit(ends["lo"]), F.lit(ends["hi"])
    first = F.greatest(F.col(SCD2_START), lo)
    last = F.least(F.coalesce(F.date_sub(SCD2_END, 1), hi), hi)
    right = history.filter(F.col(SCD2_START).isNotNull() & (first <= last)).select(
        *[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)],
        F.col(SCD2_START).alias("__start"), F.col(SCD2_END).alias("__end"),
        *[F.col(c).alias(f"{prefix}{c}") for c in columns],
        F.explode(F.sequence(bucket(first), bucket(last))).alias("__in"))
    cond = (F.col("__bucket") == F.col("__in")) & (F.col("__start") <= F.col("__day")) & (
        F.col("__end").isNull() | (F.col("__day") < F.col("__end")))
    for i, k in enumerate(keys):
        cond = cond & left[k].eqNullSafe(F.col(f"__k{i}"))
    return left.join(right, cond, how).drop(
        "__day", "__bucket", "__in", "__start", "__end", *[f"__k{i}" for i in range(len(keys))])
