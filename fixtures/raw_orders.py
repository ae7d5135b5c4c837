"""The order lines as a raw file would hold them: raw names, personal columns, texts with flaws.

The flaws follow values of the data (a segment, a status, a line number); all rows are kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fixtures.orders_wide import order_lines, read


def raw_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = order_lines(spark, sf_dir)
    text = {name: F.col(name).cast("string") for name in lines.columns}
    money = {
        name: F.col(name).cast("decimal(18,4)").cast("string")
        for name in ["sales", "order_item_discount", "order_profit_per_order", "product_price"]
    }
    rate = F.col("order_item_discount_rate").cast("decimal(5,2)").cast("string")
    day = F.date_format("order_date", "M/d/yyyy H:mm")
    return lines.select(
        text["type"].alias("Type"),
        text["days_for_shipping_real"].alias("Days for shipping (real)"),
        text["days_for_shipment_scheduled"].alias("Days for shipment (scheduled)"),
        text["delivery_status"].alias("Delivery Status"),
        text["late_delivery_risk"].alias("Late_delivery_risk"),
        F.concat(F.lit("  "), "category_name", F.lit(" ")).alias("Category Name"),
        F.concat("customer_segment", F.lit("@example.com")).alias("Customer Email"),
        F.lit("again@example.com").alias("CUSTOMER EMAIL "),
        F.col("order_country").alias("Customer Fname"),
        F.col("order_state").alias("Customer Lname"),
        F.lit("XXXXXXXXX").alias("Customer Password"),
        F.when(F.col("customer_segment") == "MACHINERY", "   ")
        .when(F.col("customer_segment") != "HOUSEHOLD", F.concat("customer_segment", F.lit("  ")))
        .alias("Customer Segment"),
        F.lit("1 Main Street").alias("Customer Street"),
        F.lit("00725").alias("Customer Zipcode"),
        F.col("department_name").alias("Department Name"),
        F.concat(F.col("market"), F.lit(" ")).alias("Market"),
        F.col("order_country").alias("Order Country"),
        F.when(F.col("type") == "N", F.date_format("order_date", "yyyy-MM-dd"))
        .otherwise(day)
        .alias("order date (DateOrders)"),
        text["order_id"].alias("Order Id"),
        F.concat(F.lit("$"), money["order_item_discount"]).alias("Order Item Discount"),
        F.when(F.col("order_item_quantity") == 7, "n/a").otherwise(rate).alias("Order Item Discount Rate"),
        text["order_item_quantity"].alias("Order Item Quantity"),
        F.concat(F.lit(" $"), F.format_number("sales", 2)).alias("Sales"),
        money["order_profit_per_order"].alias("Order Profit Per Order"),
        F.col("order_region").alias("Order Region"),
        F.col("order_state").alias("Order State"),
        F.lit("a description").alias("Product Description"),
        F.lit("image.jpg").alias("Product Image"),
        F.col("product_name").alias("Product Name"),
        F.when(F.col("order_item_quantity") == 11, "-").otherwise(money["product_price"]).alias("Product Price"),
        F.date_format("shipping_date", "M/d/yyyy H:mm").alias("shipping date (DateOrders)"),
        F.col("shipping_mode").alias("Shipping Mode"),
    )


def _returned_twice(table: DataFrame, flag: str) -> DataFrame:
    """All rows, and the returned ones a second time: known duplicates from one scan."""
    copies = F.when(F.col(flag) == "R", F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return table.select("*", F.explode(copies).alias("__copy")).drop("__copy")


def twice_delivered(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _returned_twice(read(spark, sf_dir, "lineitem"), "l_returnflag")


def raw_orders_twice(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _returned_twice(raw_orders(spark, sf_dir), "Type")
