"""Decimal helpers: defaults, tariff amounts, exact averages."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def zero_if_null(column: Column | str) -> Column:
    """NULL becomes 0 of the same type."""
    return F.coalesce(column, F.lit(0))


def percent_of(price: Column, rate_pct: Column) -> Column:
    """``rate_pct`` percent of ``price`` in full cents, half away from zero."""
    return F.round(price * rate_pct / 100, 2)


def landed_cost(price: Column, *rates_pct: Column) -> Column:
    """Price plus all percentage charges, rounded once at the end."""
    factor = F.lit(1)
    for rate in rates_pct:
        factor = factor + rate / 100
    return F.round(price * factor, 2)


def percent_share(part: Column, whole: Column) -> Column:
    """``part`` in percent of ``whole``; 0 when there is nothing to divide by."""
    return F.when(whole > 0, part / whole * 100).otherwise(F.lit(0.0))
