"""Derived columns of the clean table; each is added only where its inputs exist."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lateline.functions import columns as C


def add_line_features(lines: DataFrame) -> DataFrame:
    """Shipping delay, profit margin, loss flag and discount band."""
    present = set(lines.columns)
    real, planned = F.col("days_for_shipping_real"), F.col("days_for_shipment_scheduled")
    profit, sales, rate = F.col("order_profit_per_order"), F.col("sales"), F.col("order_item_discount_rate")
    rules = {
        "shipping_delay_days": (
            {"days_for_shipping_real", "days_for_shipment_scheduled"},
            lambda: real - planned,
        ),
        "profit_margin": ({"order_profit_per_order", "sales"}, lambda: C.profit_margin(profit, sales)),
        "is_loss_order": ({"order_profit_per_order"}, lambda: C.loss_flag(profit)),
        "discount_level": ({"order_item_discount_rate"}, lambda: C.discount_level(rate)),
    }
    return lines.withColumns({name: make() for name, (needs, make) in rules.items() if needs <= present})


def add_date_parts(lines: DataFrame) -> DataFrame:
    """Year, month and day of week (1 = Sunday) of the order date."""
    if "order_date" not in lines.columns:
        return lines
    day = F.col("order_date")
    return lines.withColumns(
        {"order_year": F.year(day), "order_month": F.month(day), "order_day_of_week": F.dayofweek(day)}
    )


def add_sales_level(lines: DataFrame, low: float | None, high: float | None) -> DataFrame:
    """Sales band between two thresholds."""
    if "sales" not in lines.columns:
        return lines
    return lines.withColumn("sales_level", C.sales_level(F.col("sales"), low, high))
