"""The gold tables of a database, by name."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lateline.plans.gold import TABLES


def list_tables(spark: SparkSession, database: str) -> list[str]:
    """Names of the tables of a database, sorted."""
    return sorted(table.name for table in spark.catalog.listTables(database) if not table.isTemporary)


def check_schema(table: DataFrame, name: str) -> None:
    """An error unless the columns and types are those of the gold table."""
    expected = [(f.name, f.dataType) for f in TABLES[name].schema.fields]
    actual = [(f.name, f.dataType) for f in table.schema.fields]
    if actual != expected:
        raise ValueError(f"{name}: columns {actual}, expected {expected}")


def save_gold(table: DataFrame, database: str, name: str) -> None:
    """Overwrite one gold table of a database, as a single file."""
    check_schema(table, name)
    table.coalesce(1).write.mode("overwrite").saveAsTable(f"{database}.{name}")
