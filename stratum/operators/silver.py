"""Silver-layer cleaning of the three landing entities.

Each function is a single projection over its input (``withColumns``), so the
whole layer stays inside one whole-stage-codegen span after the scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratum.functions.dates import (
    age_group,
    age_years,
    calendar_parts,
    parse_date,
    parse_timestamp,
)
from stratum.functions.text import (
    completeness,
    email_domain,
    normalize_city,
    normalize_state,
    one_line,
)
from stratum.operators.flatten import explode_items


def stamp_processed(df: DataFrame, col: str = "_processed_at") -> DataFrame:
    """Processing-time column (one value per query)."""
    return df.withColumn(col, F.current_timestamp())


def clean_orders(bronze_orders: DataFrame, outer: bool = False) -> DataFrame:
    """Nested orders -> one row per order line with calendar columns."""
    lines = explode_items(bronze_orders, outer=outer)
    ts = parse_timestamp("order_timestamp").cast("timestamp_ntz")
    lines = lines.withColumn("order_timestamp", ts)
    return lines.withColumns(calendar_parts("order_timestamp", "order"))


def clean_customers(bronze_customers: DataFrame, as_of=None) -> DataFrame:
    """Typed dates, age, age band, email domain and contact completeness."""
    df = bronze_customers.withColumns({
        "date_of_birth": parse_date("date_of_birth"),
        "created_date": parse_date("created_date"),
    })
    df = df.withColumn("age", age_years("date_of_birth", as_of))
    return df.withColumns({
        "age_group": age_group("age"),
        "email_domain": email_domain("email"),
        "contact_completeness": completeness(["email", "telephone", "customer_name"]),
    })


def clean_addresses(bronze_addresses: DataFrame) -> DataFrame:
    """Normalised state / city, text postcode, one-line address."""
    df = bronze_addresses.withColumns({
        "postcode": F.col("postcode").cast("string"),
        "created_date": parse_date(F.col("created_date").cast("string")),
        "state": normalize_state("state"),
        "city": normalize_city("city"),
    })
    return df.withColumn("full_address", one_line(["address_line_1", "city", "state", "postcode"]))
