"""The rule sets of the three silver tables.

Fixed values: rule names, actions, status and payment vocabularies and the
patterns are those the pipeline must report under (names kept verbatim,
including the spelling of ``vaild_date_of_birth``).
"""

from __future__ import annotations

from pyspark.sql import functions as F

from stratum.operators.quality import Rule

VALID_ORDER_STATUSES = ["Pending", "Shipped", "Completed", "Cancelled"]
UNKNOWN_PAYMENT = "Unknown"
STATE_PATTERN = "^[A-Z]+$"
DIGITS_PATTERN = "^[0-9]+$"
EMAIL_LIKE = "%@%.%"
PHONE_LIKE = "+%"


def order_rules() -> list[Rule]:
    return [
        Rule("order_id_not_null", F.col("order_id").isNotNull(), "fail"),
        Rule("customer_id_not_null", F.col("customer_id").isNotNull(), "fail"),
        Rule("valid_order_status", F.col("order_status").isin(VALID_ORDER_STATUSES), "drop"),
        Rule("known_payment_method", F.col("payment_method") != UNKNOWN_PAYMENT, "warn"),
        Rule("positive_item_price", F.col("item_price") > 0, "warn"),
    ]


def customer_rules(as_of=None, strict: bool = False) -> list[Rule]:
    """SQL-text rules.  The email / phone rules are written with ``or`` as in
    the original pipeline (a non-null value always passes); ``strict=True``
    adds the ``and`` forms as ``*_strict`` rules."""
    today = "current_date()" if as_of is None else f"date '{as_of}'"
    rules = [
        Rule("customer_id_not_null", "customer_id is not null", "fail"),
        Rule("vaild_date_of_birth", f"date_of_birth < {today}", "warn"),
        Rule("name_not_empty", "customer_name is not null and length(trim(customer_name)) > 0", "warn"),
        Rule("valid_email_format", f"email is not null or email like '{EMAIL_LIKE}'", "warn"),
        Rule("valid_phone_format", f"telephone is not null or telephone like '{PHONE_LIKE}'", "warn"),
    ]
    if strict:
        rules += [
            Rule("valid_email_format_strict", f"email is not null and email like '{EMAIL_LIKE}'", "warn"),
            Rule("valid_phone_format_strict", f"telephone is not null and telephone like '{PHONE_LIKE}'", "warn"),
        ]
    return rules


def address_rules() -> list[Rule]:
    postcode, state, city, line = (F.col(c) for c in ("postcode", "state", "city", "address_line_1"))
    return [
        Rule("addresses_has_customer_id", F.col("customer_id").isNotNull(), "fail"),
        Rule("valid_postcode",
             postcode.try_cast("int").isNotNull() & (F.length(postcode) >= 4) & (F.length(postcode) <= 6),
             "warn"),
        Rule("valid_state_format", state.isNotNull() & state.rlike(STATE_PATTERN), "warn"),
        Rule("valid_city_name", city.isNotNull() & ~city.rlike(DIGITS_PATTERN), "warn"),
        Rule("address_line_not_empty", line.isNotNull() & (F.length(F.trim(line)) > 0), "warn"),
    ]
