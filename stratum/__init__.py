"""stratum: layered (bronze / silver / gold) data operators on Spark DataFrames.

The public operators, re-exported for convenience::

    from stratum import clean_orders, Rule, run_quality_checks, scd2_apply, revenue_by_day
"""

from stratum.operators.flatten import explode_array, explode_items
from stratum.operators.marts import (
    customer_summary,
    order_totals,
    payment_mix,
    product_performance,
    revenue_by_day,
    status_funnel,
)
from stratum.operators.quality import (
    DQFailure,
    DQResult,
    Rule,
    apply_expectations,
    dq_report,
    expect_all,
    run_quality_checks,
)
from stratum.operators.scd import (
    latest_per_key,
    scd1_apply,
    scd2_apply,
    scd2_classify,
    scd2_current,
    scd2_history,
    scd2_initial,
    scd2_metrics,
)
from stratum.operators.silver import clean_addresses, clean_customers, clean_orders
from stratum.plans.refresh import Refresh, full_refresh
from stratum.sinks import scd2_table
from stratum.sinks.writer import read_versioned, summarize_metrics, write_checked, write_table
from stratum.sources.landing import read_landing, with_lineage

__version__ = "0.1.0"

__all__ = [
    "DQFailure", "DQResult", "Refresh", "Rule", "apply_expectations", "clean_addresses",
    "clean_customers", "clean_orders", "customer_summary", "dq_report", "expect_all",
    "explode_array", "explode_items", "latest_per_key", "order_totals", "payment_mix",
    "product_performance", "read_landing", "read_versioned", "revenue_by_day",
    "run_quality_checks", "scd1_apply", "scd2_apply", "scd2_classify", "scd2_current",
    "scd2_history", "scd2_initial", "scd2_metrics", "status_funnel", "with_lineage",
    "write_checked", "write_table", "full_refresh", "scd2_table", "summarize_metrics",
]
