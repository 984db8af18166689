"""Exact money arithmetic on integer cents.

Summing and averaging doubles gives results that depend on the order of the
additions, so two engines (or two partitionings of one engine) can round a
total differently.  Amounts are therefore carried as ``bigint`` cents: sums
are exact, and a two-decimal average or a percentage is an integer half-up
division.  Values turn back into doubles only at the end (``cents / 100`` is
correctly rounded in every IEEE engine).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def to_cents(amount: Column | str) -> Column:
    """Amount (double, two decimals) -> bigint cents, rounded half-up."""
    return F.round(_c(amount) * 100).cast("bigint")


def cents_to_amount(cents: Column | str) -> Column:
    """bigint cents -> double amount."""
    return (_c(cents).cast("double") / F.lit(100.0))


def _floor_div(a: Column, b: Column) -> Column:
    """Exact floor division of non-negative bigint ``a`` by positive ``b``."""
    exact = (a - F.pmod(a, b)).cast("decimal(38,0)") / b.cast("decimal(38,0)")
    return exact.cast("bigint")


def div_half_up(num: Column | str, den: Column | str) -> Column:
    """``round(num / den)`` half away from zero, for integer columns, exactly.

    Null when ``den`` is 0 or null.
    """
    n, d = _c(num).cast("bigint"), _c(den).cast("bigint")
    mag = _floor_div(F.abs(n) * 2 + d, d * 2)
    return F.when(d == 0, F.lit(None).cast("bigint")).when(n < 0, -mag).otherwise(mag)


def avg_cents(sum_cents: Column | str, n: Column | str) -> Column:
    """Mean amount rounded half-up to the cent, as a double amount."""
    return cents_to_amount(div_half_up(sum_cents, n))


def percent_1dp(part: Column | str, whole: Column | str) -> Column:
    """``round(part / whole * 100, 1)`` half-up, exact for integer inputs."""
    return div_half_up(_c(part).cast("bigint") * 1000, whole).cast("double") / F.lit(10.0)
