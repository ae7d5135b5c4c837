"""The given tables joined to the shape of the clean order-line table.

Each side is joined where it is smallest, and lines meet orders last: the result is then
already partitioned by order, and the first level of every roll-up adds no exchange. No side is
forced to be broadcast; Spark does so only below its own size threshold.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lateline.operators.features import add_date_parts, add_line_features


# Given, so that no job has to read file footers before a query is planned.
SCHEMAS = {
    "lineitem": (
        "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
        "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
        "l_shipdate timestamp_ntz"
    ),
    "orders": (
        "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, "
        "o_orderpriority string"
    ),
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "region": "r_regionkey int, r_name string",
}


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[table]).parquet(f"{sf_dir}/{table}.parquet")


def order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per order line, before derived columns."""
    buyers = (
        read(spark, sf_dir, "customer")
        .join(read(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .join(read(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    )
    orders = read(spark, sf_dir, "orders").join(buyers, F.col("o_custkey") == F.col("c_custkey"))
    items = read(spark, sf_dir, "lineitem").join(
        read(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey")
    )
    lines = items.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))

    days_between = F.datediff("l_shipdate", "o_orderdate")
    real = F.pmod(days_between, F.lit(10))
    planned = (
        F.when(F.col("o_orderpriority") == "1-URGENT", 2)
        .when(F.col("o_orderpriority") == "2-HIGH", 4)
        .when(F.col("o_orderpriority") == "3-MEDIUM", 6)
        .when(F.col("o_orderpriority") == "4-NOT SPECIFIED", 7)
        .otherwise(8)
    )
    price, discount = F.col("l_extendedprice"), F.col("l_discount")
    return lines.select(
        F.col("l_orderkey").alias("order_id"),
        F.col("o_orderpriority").alias("shipping_mode"),
        F.col("l_returnflag").alias("type"),
        F.col("p_name").alias("product_name"),
        F.col("p_brand").alias("category_name"),
        F.col("p_type").alias("department_name"),
        F.col("c_mktsegment").alias("customer_segment"),
        F.col("r_name").alias("market"),
        F.concat_ws("-", "r_name", F.expr("cast((n_nationkey div 5) % 3 as string)")).alias("order_region"),
        F.col("n_name").alias("order_country"),
        F.concat(F.lit("S"), F.expr("cast(c_custkey % 50 as string)")).alias("order_state"),
        F.col("o_orderdate").alias("order_date"),
        F.col("l_shipdate").alias("shipping_date"),
        real.alias("days_for_shipping_real"),
        planned.alias("days_for_shipment_scheduled"),
        F.col("l_quantity").alias("order_item_quantity"),
        price.alias("sales"),
        (2 * discount).alias("order_item_discount_rate"),
        (price * 2 * discount).alias("order_item_discount"),
        F.col("p_retailprice").alias("order_item_product_price"),
        F.col("p_retailprice").alias("product_price"),
        (price * (1 - 2 * discount) - F.lit(0.8) * F.col("l_quantity") * F.col("p_retailprice")).alias(
            "order_profit_per_order"
        ),
        F.when(real > planned, 1).otherwise(0).alias("late_delivery_risk"),
        F.when(real > planned, "Late delivery")
        .when(real == planned, "Shipping on time")
        .otherwise("Advance shipping")
        .alias("delivery_status"),
    )


def clean_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines with the derived columns the gold tables read."""
    return add_date_parts(add_line_features(order_lines(spark, sf_dir)))
