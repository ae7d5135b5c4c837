"""Texts shown to a reader: humanised numbers, risk tiers and advice."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Tier bounds and texts.
# ---------------------------------------------------------------------------

HIGH_RISK_RATE = 70
MEDIUM_RISK_RATE = 50

HIGH_RISK_ADVICE = (
    "This shipping mode has very high late delivery risk. It should be reviewed immediately "
    "and avoided for sensitive orders unless the process is improved."
)
MEDIUM_RISK_ADVICE = (
    "This shipping mode has medium-to-high delivery risk. It should be monitored carefully "
    "and compared with safer alternatives."
)
LOW_RISK_ADVICE = (
    "This shipping mode has relatively lower delivery risk and can be used under regular monitoring."
)
MARKET_ADVICE = (
    "Recommended decision: review logistics planning, supplier coordination, and shipping performance "
    "in this market, especially if it also has high order volume."
)
LATE_TITLE = "High Late Delivery Risk"
LATE_ADVICE = (
    "Recommended decision: prioritize this order, monitor it closely, or consider switching to a safer "
    "and faster shipping mode."
)
ON_TIME_TITLE = "Low Late Delivery Risk"
ON_TIME_ADVICE = (
    "Recommended decision: continue with the regular order workflow while maintaining standard "
    "operational monitoring."
)

MILLION = 1_000_000
THOUSAND = 1_000

# ---------------------------------------------------------------------------


def human_number(value: Column) -> Column:
    """``1.23M``, ``4.56K``, ``789`` or ``0.12``; null shows as ``0``."""
    number = value.cast("double")
    size = F.abs(number)
    return (
        F.when(number.isNull(), F.lit("0"))
        .when(size >= MILLION, F.format_string("%.2fM", number / F.lit(MILLION)))
        .when(size >= THOUSAND, F.format_string("%.2fK", number / F.lit(THOUSAND)))
        .when(number == F.floor(number), number.cast("bigint").cast("string"))
        .otherwise(F.format_string("%.2f", number))
    )


def two_decimals(value: Column) -> Column:
    return F.format_string("%.2f", value)


def percent_text(value: Column) -> Column:
    return F.format_string("%.2f%%", value)


def _by_rate(rate: Column, high: str, medium: str, low: str) -> Column:
    return (
        F.when(rate >= HIGH_RISK_RATE, F.lit(high))
        .when(rate >= MEDIUM_RISK_RATE, F.lit(medium))
        .otherwise(F.lit(low))
    )


def risk_tier(rate: Column) -> Column:
    return _by_rate(rate, "danger", "warning", "success")


def shipping_advice(rate: Column) -> Column:
    return _by_rate(rate, HIGH_RISK_ADVICE, MEDIUM_RISK_ADVICE, LOW_RISK_ADVICE)


def risk_title(prediction: Column) -> Column:
    return F.when(prediction == 1, F.lit(LATE_TITLE)).otherwise(F.lit(ON_TIME_TITLE))


def risk_advice(prediction: Column) -> Column:
    return F.when(prediction == 1, F.lit(LATE_ADVICE)).otherwise(F.lit(ON_TIME_ADVICE))


def probability_text(probability: Column) -> Column:
    return F.format_string("Predicted late-risk probability: %.2f%%", probability * 100)
