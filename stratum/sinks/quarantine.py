"""Quality rules with a quarantine: rejected rows are kept, with the rules they failed.

One pass and one write: the rule counts are an ``Observation`` on the write, every row
gets a bit mask of the rules it did not pass, and the writer splits the rows by the
mask's drop rules.  Both parts are published only when no ``fail`` rule fired.

``_failed_rules`` names a row's failed rules: for rejected rows the drop and warn rules,
for clean rows the warn rules (empty for most).  Rejected rows are appended, a folder per
run, so a later run can repair and check them again.
"""

from __future__ import annotations

import datetime as _dt
import time
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from stratum.operators.quality import (
    DQFailure, Rule, counts_of, first_failure, keep_condition, report_rows, rows_frame, rule_aggregates)
from stratum.sinks.bucketed import unsorted_writes
from stratum.sinks.writer import _fs, publish

FAILED = "_failed_rules"
REJECTED = "_rejected"
MAX_RULES = 63  # bits of the mask


def failed_mask(rules: Sequence[Rule], on_null: str = "drop") -> Column:
    """Bit i is set where the row did not pass rule i.

    A NULL condition counts as not passed (``on_null="drop"``) or as passed
    (``"keep"``), as in ``apply_expectations``.
    """
    if len(rules) > MAX_RULES:
        raise ValueError(f"at most {MAX_RULES} rules fit the mask")
    mask = F.lit(0).cast("long")
    for i, r in enumerate(rules):
        mask = mask.bitwiseOR(F.when(keep_condition(r, on_null), F.lit(0)).otherwise(F.lit(1 << i)).cast("long"))
    return mask


def rule_names(mask: Column, rules: Sequence[Rule]) -> Column:
    """The names of the rules whose bits are set, in rule order."""
    named = [F.when(mask.bitwiseAND(F.lit(1 << i)) != 0, F.lit(r.name)) for i, r in enumerate(rules)]
    return F.filter(F.array(*named), lambda x: x.isNotNull()) if named else F.array().cast("array<string>")


def split_rows(df: DataFrame, rules: Sequence[Rule], on_null: str = "drop") -> DataFrame:
    """``df`` with ``_failed_rules`` and ``_rejected`` (true where a drop rule was not passed)."""
    if on_null not in ("drop", "keep"):
        raise ValueError("a quarantine needs on_null 'drop' or 'keep'")
    drops = sum(1 << i for i, r in enumerate(rules) if r.action == "drop")
    marked = df.withColumn("__mask", failed_mask(rules, on_null))
    return marked.withColumn(FAILED, rule_names(F.col("__mask"), rules)).withColumn(
        REJECTED, F.col("__mask").bitwiseAND(F.lit(drops)) != 0).drop("__mask")


def write_quarantined(df: DataFrame, rules: Sequence[Rule], table_name: str, path: str, rejected_path: str, *,
                      run_time: str | None = None, on_null: str = "drop",
                      report_sink: Callable[[DataFrame], None] | None = None, layer: str = "") -> dict:
    """Overwrite ``path`` with the clean rows, append the rejected ones to ``rejected_path``.

    Returns a metrics record with ``rows`` and ``rejected``.  A ``fail`` rule with failing
    rows raises ``DQFailure``: the report so far is handed on, no rows are published.
    """
    spark = df.sparkSession
    run_time = run_time or _dt.datetime.now().strftime("%Y-%m-%d %H:%M:%S")
    tag, t0 = uuid.uuid4().hex[:12], time.perf_counter()
    checks, written = Observation(f"dq_{tag}"), Observation(f"rows_{tag}")
    observed = df.observe(checks, *rule_aggregates(rules)) if rules else df
    rows = split_rows(observed, rules, on_null).observe(
        written, F.count(F.lit(1)).alias("rows"), F.count_if(REJECTED).alias("rejected"))
    parent, name = path.rstrip("/").rsplit("/", 1)
    staged = f"{parent}/_staging/{name}-{tag}"
    with unsorted_writes(spark, 2):  # clean and rejected files are open side by side
        rows.write.option("partitionOverwriteMode", "static").partitionBy(REJECTED).parquet(staged)
    counts = counts_of(checks.get, rules) if rules else {}
    report = report_rows(rules, counts, table_name, run_time)
    bad = first_failure(rules, counts)
    if bad is not None:
        report = report[: bad + 1]
    if report_sink is not None:
        report_sink(rows_frame(spark, report))
    fs, top = _fs(spark, staged)
    if bad is not None:
        fs.delete(top, True)
        raise DQFailure(table_name, rules[bad], counts[rules[bad].name][1], report)
    rejected = int(written.get.get("rejected", 0))
    clean = int(written.get.get("rows", 0)) - rejected
    if rejected:
        publish(spark, f"{staged}/{REJECTED}=true", f"{rejected_path.rstrip('/')}/run={tag}")
    if clean:
        publish(spark, f"{staged}/{REJECTED}=false", path)
    else:
        spark.createDataFrame([], rows.drop(REJECTED).schema).write.mode("overwrite").parquet(path)
    fs.delete(top, True)
    return dict(run_time=run_time, layer=layer, table_name=name, mode="overwrite",
                status="WARN" if rejected else "PASS", rows=clean, rejected=rejected,
                elapsed_s=round(time.perf_counter() - t0, 3),
                message=f"Written {clean} rows -> {path}, {rejected} rejected -> {rejected_path}")


def read_rejected(spark: SparkSession, rejected_path: str) -> DataFrame | None:
    """All rejected rows with their run; None where nothing was ever rejected."""
    fs, p = _fs(spark, rejected_path)
    return spark.read.parquet(rejected_path) if fs.exists(p) else None
