"""Text standardisation helpers (all JVM-side built-ins, no UDF)."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: separator of the one-line address.
ADDRESS_SEPARATOR = ", "


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def email_domain(email: Column | str) -> Column:
    """Text after the first ``@``; null when there is none or email is null."""
    e = _c(email)
    return F.when(e.isNotNull(), F.get(F.split(e, "@"), 1))


def normalize_state(state: Column | str) -> Column:
    return F.upper(F.trim(_c(state)))


def normalize_city(city: Column | str) -> Column:
    return F.initcap(F.trim(_c(city)))


def one_line(parts: Iterable[Column | str], sep: str = ADDRESS_SEPARATOR) -> Column:
    """Null-skipping concatenation (a null part leaves no empty slot)."""
    return F.concat_ws(sep, *[_c(p) for p in parts])


def completeness(cols: Iterable[Column | str]) -> Column:
    """Number of non-null values among ``cols`` (int)."""
    total = None
    for c in cols:
        flag = _c(c).isNotNull().cast("int")
        total = flag if total is None else total + flag
    return total


def is_blank(c: Column | str) -> Column:
    return F.length(F.trim(_c(c))) == 0
