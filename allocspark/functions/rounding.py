"""Rounding and averaging that give the same bits whatever the partition order.

Sums run over exact decimals, the one division runs in double, and ties round away
from zero on a decimal with 12 places, so a double's last-bit noise cannot flip them.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def exact(value: Column) -> Column:
    """A decimal with 12 places: enough to absorb double noise before comparing or summing."""
    return value.cast("decimal(38,12)")


def rounded(value: Column, places: int) -> Column:
    """Round half away from zero, kept as a decimal."""
    return F.round(exact(value), places)


def as_double(value: Column, places: int) -> Column:
    """Round half away from zero, delivered as a double for reports."""
    return rounded(value, places).cast("double")


def half_even(value: Column, places: int) -> Column:
    """Round an exact decimal half to even."""
    return F.bround(value, places)


def ratio(numerator: Column, denominator: Column) -> Column:
    """Double quotient, NULL for a zero denominator."""
    return numerator.cast("double") / F.nullif(denominator.cast("double"), F.lit(0.0))


def mean(value: Column) -> Column:
    """Aggregate mean of a decimal column: exact sum over the count of its non-null values."""
    return ratio(F.sum(value), F.count(value))


def weighted_mean(value: str, weight: str) -> Column:
    """Aggregate mean of a double column over ``weight`` equal rows each, summed exactly; nulls are left out.

    The narrower types keep all 12 places through the decimal product.
    """
    product = F.col(value).cast("decimal(20,12)") * F.col(weight).cast("decimal(12,0)")
    return ratio(F.sum(product), F.sum(F.when(F.col(value).isNotNull(), F.col(weight))))
