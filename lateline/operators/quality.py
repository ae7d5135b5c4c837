"""Row counts, null counts, duplicates and key checks, each as one aggregate."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lateline.schema import NULL_CHECKED_COLUMNS


def null_counts(table: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """``(column_name, null_count)`` for those of ``columns`` that exist, from one pass."""
    names = [name for name in columns or NULL_CHECKED_COLUMNS if name in table.columns]
    if not names:
        return table.sparkSession.createDataFrame([], "column_name string, null_count bigint")
    counted = table.agg(*[F.count_if(F.col(name).isNull()).alias(name) for name in names])
    return counted.unpivot([], names, "column_name", "null_count")


def duplicate_report(table: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Rows before and after whole-row deduplication, rows removed and nulls kept: one row.

    Grouping by all columns with a count needs the same single shuffle as the deduplication
    itself, and gives both row counts without running it twice.
    """
    names = [name for name in columns or NULL_CHECKED_COLUMNS if name in table.columns]
    copies = table.groupBy(*table.columns).agg(F.count(F.lit(1)).alias("__copies"))
    before = F.coalesce(F.sum("__copies"), F.lit(0).cast("bigint"))
    after = F.count(F.lit(1))
    return copies.agg(
        before.alias("rows_before"),
        after.alias("rows_after"),
        (before - after).alias("duplicates_removed"),
        *[F.count_if(F.col(name).isNull()).alias(f"{name}_nulls") for name in names],
    )


def key_report(table: DataFrame, name: str, keys: list[str]) -> DataFrame:
    """``(table_name, row_count, repeated_keys, null_keys)`` of one table; a good key has 0 and 0."""
    groups = table.groupBy(*(keys or [F.lit(1).alias("one_row")])).agg(F.count(F.lit(1)).alias("__rows"))
    any_null = reduce(lambda left, key: left | F.col(key).isNull(), keys, F.lit(False))
    return groups.agg(
        F.lit(name).alias("table_name"),
        F.coalesce(F.sum("__rows"), F.lit(0).cast("bigint")).alias("row_count"),
        F.count_if(F.col("__rows") > 1).alias("repeated_keys"),
        F.count_if(any_null).alias("null_keys"),
    )


def content_sum(columns: list[str]) -> Column:
    """An aggregate: the sum of the first 60 bits of each row's MD5, as text; the order of rows does not matter.

    A row is its values as text, each with its length before it, and ``-`` for null: values that only meet
    otherwise, and null and empty ones, differ. A changed, lost or added row changes the sum but for one case in 2**60.
    A repeated row counts each time. Null for no rows.
    """
    texts = [F.col(f"`{name}`").cast("string") for name in columns]
    sizes = [F.coalesce(F.length(text).cast("string"), F.lit("")) for text in texts]
    marks = [F.when(text.isNull(), F.lit("-")).otherwise(F.lit(":")) for text in texts]
    values = [F.coalesce(text, F.lit("")) for text in texts]
    row = F.concat(F.lit(""), *[part for column in zip(sizes, marks, values) for part in column])
    bits = F.conv(F.substring(F.md5(row), 1, 15), 16, 10).cast("bigint")
    # Each 20 bits have a sum of their own in whole numbers, faster than decimals, which holds 2**43 rows.
    parts = {place: F.shiftright(bits, place).bitwiseAND(F.lit((1 << 20) - 1)) for place in (0, 20, 40)}
    sums = [F.sum(part).cast("decimal(38,0)") * F.lit(1 << place) for place, part in parts.items()]
    return reduce(Column.__add__, sums).cast("decimal(38,0)").cast("string")


def content_digest(table: DataFrame) -> DataFrame:
    """``(row_count, content)`` of a table, one row; two copies of a table have the same."""
    return table.agg(F.count(F.lit(1)).alias("row_count"), content_sum(table.columns).alias("content"))


def profile(table: DataFrame, name: str) -> DataFrame:
    """Row count, column count and column names of a table, one row; reads no column values."""
    return table.agg(
        F.lit(name).alias("table_name"),
        F.count(F.lit(1)).alias("row_count"),
        F.lit(len(table.columns)).alias("column_count"),
        F.lit(",".join(table.columns)).alias("column_names"),
    )
