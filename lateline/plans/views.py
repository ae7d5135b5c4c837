"""What a reader of the gold tables sees: top lists, shares, tiers, advice and options.

Each takes a gold table and sorts explicitly; a stored row order is never relied on.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lateline.functions import display as D

# ---------------------------------------------------------------------------
# List lengths and the options that do not come from the data.
# ---------------------------------------------------------------------------

OVERVIEW_CATEGORIES = 10
TOP_ROWS = 12

FIXED_OPTIONS = {
    "type": ["DEBIT", "TRANSFER", "CASH", "PAYMENT"],
    "customer_segment": ["Consumer", "Corporate", "Home Office"],
    "department_name": ["Fitness", "Fan Shop", "Apparel", "Golf", "Footwear", "Outdoors", "Technology"],
    "order_country": [
        "United States",
        "India",
        "Australia",
        "Indonesia",
        "Mexico",
        "France",
        "Germany",
        "Brazil",
    ],
    "order_state": [
        "California",
        "New York",
        "Texas",
        "Queensland",
        "Java Occidental",
        "Rajastán",
        "England",
        "Ile-de-France",
    ],
}
GOLD_OPTIONS = {
    "shipping_mode": "late_by_shipping_mode",
    "market": "late_by_market",
    "order_region": "late_by_region",
    "category_name": "late_by_category",
}

# ---------------------------------------------------------------------------


def top(table: DataFrame, figure: str, keys: list[str], rows: int = TOP_ROWS) -> DataFrame:
    """The ``rows`` largest by one figure; equal figures go by key."""
    return table.orderBy(F.col(figure).desc(), *keys).limit(rows)


def most_risky_mode(late_by_shipping_mode: DataFrame) -> DataFrame:
    return top(late_by_shipping_mode, "late_delivery_rate", ["shipping_mode"], 1).select("shipping_mode")


def top_categories_by_sales(late_by_category: DataFrame, rows: int = OVERVIEW_CATEGORIES) -> DataFrame:
    return top(late_by_category, "total_sales", ["category_name"], rows)


def top_late(late_table: DataFrame, key: str, rows: int = TOP_ROWS) -> DataFrame:
    """The riskiest regions, countries or categories."""
    return top(late_table, "late_delivery_rate", [key], rows)


def top_products_by_sales(products: DataFrame, rows: int = TOP_ROWS) -> DataFrame:
    return top(products, "total_sales", ["product_name", "category_name"], rows)


def top_risky_products(products: DataFrame, rows: int = TOP_ROWS) -> DataFrame:
    """Riskiest first; of equal risk the higher sales first."""
    by = [F.col("late_delivery_rate").desc(), F.col("total_sales").desc(), "product_name", "category_name"]
    return products.orderBy(*by).limit(rows)


def market_order_share(late_by_market: DataFrame) -> DataFrame:
    """Orders per market and their percentage of the sum over markets."""
    orders = F.col("total_orders")
    whole = F.sum(orders).over(Window.partitionBy())  # over the few market rows
    return late_by_market.select("market", "total_orders", (orders / whole * 100).alias("order_share"))


def shipping_mode_decisions(late_by_shipping_mode: DataFrame) -> DataFrame:
    rate = F.col("late_delivery_rate")
    return late_by_shipping_mode.select(
        "shipping_mode",
        "late_delivery_rate",
        "total_orders",
        "late_orders",
        D.percent_text(rate).alias("rate_text"),
        D.risk_tier(rate).alias("level"),
        D.shipping_advice(rate).alias("decision"),
    )


def market_decisions(late_by_market: DataFrame) -> DataFrame:
    return late_by_market.select(
        "market",
        "late_delivery_rate",
        "total_orders",
        "late_orders",
        D.percent_text(F.col("late_delivery_rate")).alias("rate_text"),
        F.lit("info").alias("level"),
        F.lit(D.MARKET_ADVICE).alias("decision"),
    )


def kpi_display(executive_kpis: DataFrame) -> DataFrame:
    """The one-row KPI table as ``(metric, display_value)`` texts."""
    shown = {
        "Total Orders": D.human_number(F.col("total_orders")),
        "Total Sales": D.human_number(F.col("total_sales")),
        "Total Profit": D.human_number(F.col("total_profit")),
        "Late Delivery Rate": D.percent_text(F.col("late_delivery_rate")),
        "Avg Shipping Days": D.two_decimals(F.col("average_shipping_days")),
    }
    rows = [F.struct(F.lit(name).alias("metric"), text.alias("display_value")) for name, text in shown.items()]
    return executive_kpis.select(F.inline(F.array(*rows)))


def column_options(table: DataFrame, columns: list[str]) -> DataFrame:
    """Distinct non-null texts of some columns as ``(field, option_value)``, in one pass; not sorted."""
    pairs = [F.struct(F.lit(name).alias("field"), F.col(name).cast("string").alias("option_value")) for name in columns]
    return table.select(F.inline(F.array(*pairs))).where(F.col("option_value").isNotNull()).distinct()


def gold_options(gold: dict[str, DataFrame]) -> DataFrame:
    """Options that come from the data, read from the keys of four gold tables."""
    read = [column_options(gold[table], [name]) for name, table in GOLD_OPTIONS.items()]
    return reduce(DataFrame.unionByName, read)


def prediction_options(from_data: DataFrame, fixed: dict[str, list[str]] = FIXED_OPTIONS) -> DataFrame:
    """Options of every scoring field: those from the data, and the fixed ones."""
    given = from_data.sparkSession.createDataFrame(
        [(name, value) for name, values in fixed.items() for value in sorted(set(values))],
        "field string, option_value string",
    )
    return from_data.unionByName(given).orderBy("field", "option_value")
