"""The gold tables, declared: key, figures in output order, sort, support floor, row limit."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lateline.operators.rollup import MEASURES, roll_up, roll_up_sets
from lateline.schema import (
    CATEGORY_ROWS,
    COUNTRY_ROWS,
    MIN_PRODUCT_ORDERS,
    PRODUCT_ROWS,
    table_schema,
)

LATE_FIGURES = [
    "total_orders",
    "late_orders",
    "late_delivery_rate",
    "average_shipping_days",
    "total_sales",
    "total_profit",
]
PRODUCT = ["product_name", "category_name"]
PRODUCT_FIGURES = ["total_orders", "total_sales", "total_profit", "late_orders", "late_delivery_rate"]


@dataclass(frozen=True)
class GoldTable:
    name: str
    keys: list[str]
    figures: list[str]
    descending: list[str] = field(default_factory=list)
    min_orders: int | None = None
    limit: int | None = None

    @property
    def schema(self) -> T.StructType:
        return table_schema(self.keys, self.figures)

    def arrange(self, groups: DataFrame) -> DataFrame:
        """Floor, column order, sort and limit over rolled-up groups.

        The keys close the sort, so equal figures have one order and a limit one result.
        """
        if self.min_orders is not None:
            groups = groups.where(F.col("total_orders") >= self.min_orders)
        table = groups.select(*self.keys, *self.figures)
        if self.descending:
            table = table.orderBy(*[F.col(name).desc() for name in self.descending], *self.keys)
        return table if self.limit is None else table.limit(self.limit)


def late_table(name: str, key: str, limit: int | None = None) -> GoldTable:
    """The late-delivery table of any one key."""
    return GoldTable(name, [key], LATE_FIGURES, ["late_delivery_rate"], limit=limit)


EXECUTIVE = GoldTable(
    "executive_kpis",
    [],
    [
        "total_orders",
        "total_sales",
        "total_profit",
        "late_delivery_rate",
        "average_shipping_days",
        "average_profit_margin",
    ],
)

TABLES = {
    table.name: table
    for table in [
        EXECUTIVE,
        late_table("late_by_shipping_mode", "shipping_mode"),
        late_table("late_by_market", "market"),
        late_table("late_by_region", "order_region"),
        late_table("late_by_category", "category_name"),
        late_table("late_by_country", "order_country", limit=COUNTRY_ROWS),
        GoldTable(
            "profit_impact",
            ["delivery_status"],
            [
                "total_orders",
                "total_sales",
                "total_profit",
                "average_profit_per_order",
                "average_profit_margin",
                "loss_orders",
                "loss_rate",
            ],
            ["loss_rate"],
        ),
        GoldTable(
            "risky_products",
            PRODUCT,
            PRODUCT_FIGURES,
            ["late_delivery_rate", "total_sales"],
            min_orders=MIN_PRODUCT_ORDERS,
            limit=PRODUCT_ROWS,
        ),
        GoldTable(
            "discount_profit_summary",
            ["discount_level"],
            [
                "total_orders",
                "average_discount_rate",
                "total_sales",
                "total_profit",
                "average_profit_margin",
                "loss_orders",
                "loss_rate",
            ],
            ["loss_rate"],
        ),
        GoldTable("top_products_by_sales", PRODUCT, PRODUCT_FIGURES, ["total_sales"], limit=PRODUCT_ROWS),
        GoldTable(
            "loss_by_market",
            ["market"],
            ["total_orders", "loss_orders", "loss_rate", "total_sales", "total_profit"],
            ["loss_rate"],
        ),
        GoldTable(
            "profit_margin_by_category",
            ["category_name"],
            ["total_orders", "total_sales", "total_profit", "average_profit_margin"],
            ["average_profit_margin"],
            limit=CATEGORY_ROWS,
        ),
    ]
}


def gold_table(lines: DataFrame, name: str, sum_type: str = "double") -> DataFrame:
    """One gold table straight from the clean order lines."""
    table = TABLES[name]
    return table.arrange(roll_up(lines, table.keys, table.figures, sum_type))


def late_by(lines: DataFrame, key: str, sum_type: str = "double") -> DataFrame:
    """The late-delivery figures by any column of the clean table."""
    table = late_table(f"late_by_{key}", key)
    return table.arrange(roll_up(lines, table.keys, table.figures, sum_type))


def _set_name(keys: list[str]) -> str:
    return "+".join(keys) or "all"


KEY_SETS = {_set_name(table.keys): table.keys for table in TABLES.values()}


def gold_groups(lines: DataFrame, sum_type: str = "double", partitions: int | None = None) -> DataFrame:
    """Every group of every gold key with all figures; ``partitions`` as in ``roll_up_sets``."""
    return roll_up_sets(lines, KEY_SETS, MEASURES, sum_type, partitions)


def gold_table_from_groups(groups: DataFrame, name: str) -> DataFrame:
    """One gold table from a written ``gold_groups`` table."""
    table = TABLES[name]
    rows = groups.where(F.col("key_set") == _set_name(table.keys))
    if not table.keys:
        # One row also when there were no lines.
        rows = rows.agg(*[F.max(figure).alias(figure) for figure in table.figures]).fillna(
            {"total_orders": 0, "late_delivery_rate": 0.0}
        )
    return table.arrange(rows)
