"""Data-quality expectations: warn / drop / fail rules and a report table.

All rules of a table are evaluated by ONE aggregate over the input
(``count_if`` per rule: map-side partial counts, a single tiny final row), not
by two count jobs per rule.  Every rule sees the original rows, independent of
what earlier drop rules remove.

Counting is three-valued: a row whose condition is NULL is neither a pass nor
a fail; it is reported in ``null_count``.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratum.functions.money import percent_1dp
from stratum.schemas import DQ_REPORT

ACTIONS = ("warn", "drop", "fail")
ON_NULL = ("drop", "keep", "reference")


@dataclass(frozen=True)
class Rule:
    """A named condition; ``condition`` is a Column or SQL text."""

    name: str
    condition: Column | str
    action: str = "warn"

    def __post_init__(self):
        if self.action not in ACTIONS:
            raise ValueError(f"rule {self.name!r}: action must be one of {ACTIONS}")

    def column(self) -> Column:
        c = self.condition
        return F.expr(c) if isinstance(c, str) else c


class DQFailure(Exception):
    """Raised by a ``fail`` rule with at least one failing row."""

    def __init__(self, table_name: str, rule: Rule, fail_count: int, report_rows: list[dict]):
        super().__init__(
            f"rule {rule.name!r} stops the load of {table_name}: {fail_count} failing rows"
        )
        self.table_name = table_name
        self.rule = rule
        self.fail_count = fail_count
        self.report_rows = report_rows


@dataclass
class DQResult:
    report: DataFrame
    clean: DataFrame
    counts: dict[str, tuple[int, int, int]] | None = None


def _now() -> str:
    return _dt.datetime.now().strftime("%Y-%m-%d %H:%M:%S")


def rule_aggregates(rules: Sequence[Rule]) -> list[Column]:
    """``r{i}_pass``, ``r{i}_fail``, ``r{i}_null`` count columns of every rule."""
    aggs = []
    for i, r in enumerate(rules):
        c = r.column()
        aggs += [
            F.count_if(c).alias(f"r{i}_pass"),
            F.count_if(~c).alias(f"r{i}_fail"),
            F.count_if(c.isNull()).alias(f"r{i}_null"),
        ]
    return aggs


def expect_all(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """One row holding the counts of every rule (one aggregate job)."""
    return df.agg(*rule_aggregates(rules))


def counts_of(row, rules: Sequence[Rule]) -> dict[str, tuple[int, int, int]]:
    """Rule name -> (pass, fail, null) from an ``expect_all`` row or the
    metrics of an ``Observation`` over ``rule_aggregates``."""
    get = row.__getitem__
    return {r.name: (int(get(f"r{i}_pass")), int(get(f"r{i}_fail")), int(get(f"r{i}_null")))
            for i, r in enumerate(rules)}


def first_failure(rules: Sequence[Rule], counts: dict) -> int | None:
    """Index of the first ``fail`` rule with failing rows, else None."""
    for i, r in enumerate(rules):
        if r.action == "fail" and counts[r.name][1] > 0:
            return i
    return None


def pass_rate_expr(p: Column, f: Column) -> Column:
    """``round(pass / (pass + fail) * 100, 1)`` half-up; 100.0 when both are 0."""
    return F.when((p + f) == 0, F.lit(100.0)).otherwise(percent_1dp(p, p + f))


def dq_report(df: DataFrame, rules: Sequence[Rule], table_name: str,
              run_time: str | None = None) -> DataFrame:
    """The report as a lazy DataFrame: one row per rule, in rule order."""
    run_time = run_time or _now()
    if not rules:
        return df.sparkSession.createDataFrame([], DQ_REPORT)
    counts = expect_all(df, rules)
    rows = []
    for i, r in enumerate(rules):
        p, f, n = F.col(f"r{i}_pass"), F.col(f"r{i}_fail"), F.col(f"r{i}_null")
        rows.append(F.struct(
            F.lit(run_time).alias("run_time"),
            F.lit(table_name).alias("table_name"),
            F.lit(r.name).alias("rule_name"),
            F.lit(r.action).alias("action"),
            p.cast("bigint").alias("pass_count"),
            f.cast("bigint").alias("fail_count"),
            n.cast("bigint").alias("null_count"),
            pass_rate_expr(p, f).alias("pass_rate"),
        ))
    return counts.select(F.inline(F.array(*rows)))


def keep_condition(rule: Rule, on_null: str = "drop") -> Column:
    c = rule.column()
    return F.coalesce(c, F.lit(True)) if on_null == "keep" else F.coalesce(c, F.lit(False))


def apply_expectations(df: DataFrame, rules: Sequence[Rule], on_null: str = "drop",
                       failing: set[str] | None = None) -> DataFrame:
    """Rows left after every ``drop`` rule (one combined, pushed-down filter).

    ``on_null="drop"`` keeps only rows whose condition is TRUE;
    ``on_null="keep"`` also keeps rows whose condition is NULL;
    ``on_null="reference"`` filters a rule only when it has true failures
    (``failing`` names those rules), as the original pipeline did.
    """
    if on_null not in ON_NULL:
        raise ValueError(f"on_null must be one of {ON_NULL}")
    cond = None
    for r in rules:
        if r.action != "drop":
            continue
        if on_null == "reference":
            if failing is None or r.name not in failing:
                continue
            k = keep_condition(r, "drop")
        else:
            k = keep_condition(r, on_null)
        cond = k if cond is None else cond & k
    return df if cond is None else df.filter(cond)


def report_rows(rules: Sequence[Rule], counts: dict, table_name: str, run_time: str) -> list[dict]:
    out = []
    for r in rules:
        p, f, n = counts[r.name]
        rate = 100.0 if p + f == 0 else (2000 * p + (p + f)) // (2 * (p + f)) / 10.0
        out.append(dict(run_time=run_time, table_name=table_name, rule_name=r.name,
                        action=r.action, pass_count=p, fail_count=f, null_count=n,
                        pass_rate=rate))
    return out


def run_quality_checks(df: DataFrame, rules: Sequence[Rule], table_name: str,
                       run_time: str | None = None, on_null: str = "drop",
                       report_sink: Callable[[DataFrame], None] | None = None) -> DQResult:
    """Evaluate all rules; return the report and the cleaned frame.

    When a ``fail`` rule is present (or ``on_null="reference"``) the counts are
    needed on the driver: ONE aggregate job computes all of them (a single
    row comes back).  A failing ``fail`` rule writes the report rows up to and
    including it through ``report_sink`` and raises ``DQFailure``; nothing is
    published for the data.  Otherwise everything stays lazy.
    """
    run_time = run_time or _now()
    report = dq_report(df, rules, table_name, run_time)
    need_counts = on_null == "reference" or any(r.action == "fail" for r in rules)
    if not need_counts:
        if report_sink is not None:
            report_sink(report)
        return DQResult(report=report, clean=apply_expectations(df, rules, on_null))

    counts = counts_of(expect_all(df, rules).first(), rules)
    rows = report_rows(rules, counts, table_name, run_time)
    spark = df.sparkSession
    bad = first_failure(rules, counts)
    if bad is not None:
        partial = rows[: bad + 1]
        if report_sink is not None:
            report_sink(rows_frame(spark, partial))
        raise DQFailure(table_name, rules[bad], counts[rules[bad].name][1], partial)
    report_df = rows_frame(spark, rows)
    if report_sink is not None:
        report_sink(report_df)
    failing = {name for name, (_, f, _) in counts.items() if f > 0}
    clean = apply_expectations(df, rules, on_null, failing=failing)
    return DQResult(report=report_df, clean=clean, counts=counts)


def rows_frame(spark, rows: list[dict]) -> DataFrame:
    """Report rows (one per rule, a handful) as a DataFrame."""
    ordered = [tuple(r[f.name] for f in DQ_REPORT.fields) for r in rows]
    return spark.createDataFrame(ordered, DQ_REPORT)
