"""Column lists, thresholds and table schemas shared by the jobs."""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Names, lists and thresholds that results depend on.
# ---------------------------------------------------------------------------

RAW_ENCODING = "ISO-8859-1"
TIMESTAMP_PATTERN = "M/d/yyyy H:mm"
UNKNOWN = "Unknown"

PERSONAL_COLUMNS = [
    "Customer Email",
    "Customer Password",
    "Customer Fname",
    "Customer Lname",
    "Customer Street",
    "Customer Zipcode",
    "Product Image",
    "Product Description",
]

SPECIAL_NAMES = {
    "order date (dateorders)": "order_date",
    "shipping date (dateorders)": "shipping_date",
    "days for shipping (real)": "days_for_shipping_real",
    "days for shipment (scheduled)": "days_for_shipment_scheduled",
    "late_delivery_risk": "late_delivery_risk",
}

NUMBER_COLUMNS = [
    "days_for_shipping_real",
    "days_for_shipment_scheduled",
    "benefit_per_order",
    "sales_per_customer",
    "late_delivery_risk",
    "category_id",
    "customer_id",
    "department_id",
    "latitude",
    "longitude",
    "order_customer_id",
    "order_id",
    "order_item_cardprod_id",
    "order_item_discount",
    "order_item_discount_rate",
    "order_item_id",
    "order_item_product_price",
    "order_item_profit_ratio",
    "order_item_quantity",
    "sales",
    "order_item_total",
    "order_profit_per_order",
    "order_zipcode",
    "product_card_id",
    "product_category_id",
    "product_price",
    "product_status",
]

TEXT_COLUMNS = [
    "type",
    "delivery_status",
    "category_name",
    "customer_city",
    "customer_country",
    "customer_segment",
    "customer_state",
    "department_name",
    "market",
    "order_city",
    "order_country",
    "order_region",
    "order_state",
    "order_status",
    "product_name",
    "shipping_mode",
]

TIME_COLUMNS = ["order_date", "shipping_date"]

ID_COLUMNS = [
    "category_id",
    "customer_id",
    "department_id",
    "order_customer_id",
    "order_id",
    "order_item_cardprod_id",
    "order_item_id",
    "product_card_id",
    "product_category_id",
]

FEATURE_COLUMNS = [
    "shipping_delay_days",
    "profit_margin",
    "is_loss_order",
    "discount_level",
    "sales_level",
    "order_year",
    "order_month",
    "order_day_of_week",
]

NULL_CHECKED_COLUMNS = [
    "order_date",
    "shipping_date",
    "sales",
    "order_profit_per_order",
    "late_delivery_risk",
    "shipping_mode",
    "market",
    "order_region",
    "category_name",
]

# Upper bounds are inclusive; a value above the last bound takes the last label.
DISCOUNT_BOUNDS = [0.05, 0.15]
SALES_QUANTILES = [0.33, 0.66]
SALES_QUANTILE_ERROR = 0.01
LEVELS = ["Low", "Medium", "High"]
NO_DISCOUNT = "No Discount"

MIN_PRODUCT_ORDERS = 20
PRODUCT_ROWS = 25
COUNTRY_ROWS = 20
CATEGORY_ROWS = 20

# Model input.
TARGET = "late_delivery_risk"
CATEGORICAL_FEATURES = [
    "type",
    "category_name",
    "customer_segment",
    "department_name",
    "market",
    "order_region",
    "order_country",
    "order_state",
    "shipping_mode",
]
NUMERIC_FEATURES = [
    "days_for_shipment_scheduled",
    "order_item_quantity",
    "order_item_discount",
    "order_item_discount_rate",
    "order_item_product_price",
    "product_price",
    "sales",
]
LEAKAGE_COLUMNS = [
    "days_for_shipping_real",
    "delivery_status",
    "shipping_date",
    "shipping_delay_days",
]

# ---------------------------------------------------------------------------
# Gold schemas and keys.
# ---------------------------------------------------------------------------

_COUNTS = {"total_orders", "late_orders", "loss_orders"}


def table_schema(keys: list[str], measures: list[str]) -> T.StructType:
    """Typed schema of a gold table: text keys, bigint counts, double measures."""
    fields = [T.StructField(key, T.StringType()) for key in keys]
    for name in measures:
        kind = T.LongType() if name in _COUNTS else T.DoubleType()
        fields.append(T.StructField(name, kind))
    return T.StructType(fields)
