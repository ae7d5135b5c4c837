"""Cleaning and feature expressions: ``Column -> Column``, all JVM-side."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lateline.schema import DISCOUNT_BOUNDS, LEVELS, NO_DISCOUNT, TIMESTAMP_PATTERN, UNKNOWN


def clean_text(value: Column) -> Column:
    """Trimmed text; null and blank become ``Unknown``."""
    return F.coalesce(F.nullif(F.trim(value.cast("string")), F.lit("")), F.lit(UNKNOWN))


def clean_number(value: Column) -> Column:
    """Double from text such as ``$1,200.50``; null when no number remains.

    Only digits, dots and minus signs are kept, so an exponent loses its ``E``.
    """
    kept = F.regexp_replace(F.trim(value), r"[^0-9.\-]", "")
    return kept.try_cast("double")


def parse_time(value: Column) -> Column:
    """Timestamp from ``M/d/yyyy H:mm`` text; null when it does not match."""
    return F.try_to_timestamp(value, F.lit(TIMESTAMP_PATTERN))


def band(value: Column, bounds: list[Column], labels: list[str]) -> Column:
    """Label of the first inclusive upper bound that holds ``value``, else the last label."""
    result = F.when(value.isNull(), F.lit(UNKNOWN))
    for bound, label in zip(bounds, labels):
        result = result.when(value <= bound, F.lit(label))
    return result.otherwise(F.lit(labels[-1]))


def discount_level(rate: Column) -> Column:
    banded = band(rate, [F.lit(bound) for bound in DISCOUNT_BOUNDS], LEVELS)
    return F.when(rate == 0, F.lit(NO_DISCOUNT)).otherwise(banded)


def sales_level(sales: Column, low: float | None, high: float | None) -> Column:
    """Sales band; without thresholds (no sales at all) every row is ``Unknown``."""
    if low is None or high is None:
        return F.lit(UNKNOWN)
    return band(sales, [F.lit(low), F.lit(high)], LEVELS)


def profit_margin(profit: Column, sales: Column) -> Column:
    return F.when(sales != 0, profit / sales)


def loss_flag(profit: Column) -> Column:
    return F.when(profit < 0, F.lit(1)).otherwise(F.lit(0))


def percentage(part: Column, whole: Column) -> Column:
    """``part / whole * 100``; 0.0 when the whole is zero, negative or null."""
    return F.when(whole > 0, part / whole * F.lit(100)).otherwise(F.lit(0.0))
