"""Relational tables over JDBC, written and read by Spark's own connector.

Gold tables are small, so one connection writes a table. Its rows come from the written parquet
table and never pass through the driver program.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

Options = dict[str, str]

# Tables without a definition of their own: they are created anew instead of refilled.
UNDEFINED_TABLES = ["late_by_country", "top_products_by_sales", "loss_by_market", "profit_margin_by_category"]


def _small(table: DataFrame):
    return table.coalesce(1).write.mode("overwrite")


def replace_rows(table: DataFrame, url: str, name: str, properties: Options) -> None:
    """Truncate the table and insert the rows; definition and keys stay."""
    _small(table).option("truncate", "true").jdbc(url, name, properties=properties)


def replace_table(table: DataFrame, url: str, name: str, properties: Options) -> None:
    """Drop, create and fill the table."""
    _small(table).option("truncate", "false").jdbc(url, name, properties=properties)


@dataclass(frozen=True)
class KeyRanges:
    """A numeric or time key cut into equal ranges; null keys and those outside the bounds are read too."""

    key: str
    lowest: int | str
    highest: int | str
    parts: int


def read_relational(
    spark: SparkSession, url: str, name: str, properties: Options, ranges: KeyRanges | list[str] | None = None
) -> DataFrame:
    """A table of a database: in one query, in one for each range of a key, or one for each condition.

    Conditions must take every row once.
    """
    if ranges is None:
        return spark.read.jdbc(url, name, properties=properties)
    if isinstance(ranges, KeyRanges):
        bounds = {"lowerBound": ranges.lowest, "upperBound": ranges.highest, "numPartitions": ranges.parts}
        return spark.read.jdbc(url, name, column=ranges.key, properties=properties, **bounds)
    return spark.read.jdbc(url, name, predicates=ranges, properties=properties)


def publisher(url: str, schema: str, properties: Options) -> Callable[[DataFrame, str], None]:
    """A ``publish`` function for the gold job that writes into one database schema."""

    def publish(table: DataFrame, name: str) -> None:
        write = replace_table if name in UNDEFINED_TABLES else replace_rows
        write(table, url, f"{schema}.{name}", properties)

    return publish
