"""Date and time helpers.

All parsers are the ``try_`` variants: under ANSI mode a malformed value
becomes null instead of failing the whole job (one bad row in 100 TB must not
abort the run).  The clock is never read inside logic: ``as_of`` is a
parameter so that reruns are reproducible.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# Formats of the landing files and the age bands.
TIMESTAMP_FORMAT = "yyyy-MM-dd HH:mm:ss"
DATE_FORMAT = "yyyy-MM-dd"
AGE_BANDS = [(20, "Under 20"), (25, "20-24"), (30, "25-29")]
AGE_BAND_OTHER = "30+"
DAYS_PER_YEAR = 365.25


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def as_of_date(as_of: str | _dt.date | None) -> Column:
    """A date literal, or ``current_date()`` when ``as_of`` is None."""
    if as_of is None:
        return F.current_date()
    return F.lit(str(as_of)).cast("date")


def parse_timestamp(text: Column | str, fmt: str = TIMESTAMP_FORMAT) -> Column:
    return F.try_to_timestamp(_c(text), F.lit(fmt))


def parse_date(text: Column | str, fmt: str = DATE_FORMAT) -> Column:
    """Text -> date; malformed text -> null."""
    return F.to_date(F.try_to_timestamp(_c(text), F.lit(fmt)))


def calendar_parts(ts: Column | str, prefix: str) -> dict[str, Column]:
    """``{prefix}_date/_hour/_month/_year`` columns of a timestamp."""
    t = _c(ts)
    return {
        f"{prefix}_date": F.to_date(t),
        f"{prefix}_hour": F.hour(t),
        f"{prefix}_month": F.month(t),
        f"{prefix}_year": F.year(t),
    }


def age_years(birth_date: Column | str, as_of=None) -> Column:
    """``floor(days / 365.25)``: approximate age in whole years (bigint)."""
    return F.floor(F.datediff(as_of_date(as_of), _c(birth_date)) / F.lit(DAYS_PER_YEAR))


def age_group(age: Column | str) -> Column:
    """Band an age; a null age falls into the last band."""
    a = _c(age)
    expr = None
    for upper, label in AGE_BANDS:
        expr = F.when(a < upper, label) if expr is None else expr.when(a < upper, label)
    return expr.otherwise(AGE_BAND_OTHER)


def days_since(d: Column | str, as_of=None) -> Column:
    return F.datediff(as_of_date(as_of), _c(d))
