"""From raw order lines to clean ones: privacy, names, texts, numbers, times, duplicates.

Every step takes a table that may lack optional columns and leaves out what it needs them for.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lateline.functions import columns as C
from lateline.functions.names import snake_name, unique_names
from lateline.schema import ID_COLUMNS, NUMBER_COLUMNS, PERSONAL_COLUMNS, TEXT_COLUMNS, TIME_COLUMNS
from lateline.sources.staging import stage


@dataclass(frozen=True)
class PrivacyResult:
    table: DataFrame
    dropped: list[str]
    missing: list[str]


def drop_personal(raw: DataFrame) -> PrivacyResult:
    """Remove the personal columns; names are compared without case and outer blanks.

    All columns of such a name go, also if several differ only in case and blanks.
    """
    personal = {name.lower() for name in PERSONAL_COLUMNS}
    dropped = [name for name in raw.columns if name.strip().lower() in personal]
    present = {name.strip().lower() for name in dropped}
    missing = [name for name in PERSONAL_COLUMNS if name.lower() not in present]
    left = [i for i, name in enumerate(raw.columns) if name not in set(dropped)]
    # By place, as names that differ only in case are ambiguous.
    placed = raw.toDF(*[f"c{i}" for i in range(len(raw.columns))])
    table = placed.select(*[F.col(f"c{i}").alias(raw.columns[i]) for i in left])
    return PrivacyResult(table, dropped, missing)


def rename(raw: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """Unique snake_case names for all columns, and the mapping from the old ones."""
    names = unique_names([snake_name(name) for name in raw.columns])
    return raw.toDF(*names), dict(zip(raw.columns, names))


def _types(table: DataFrame) -> dict[str, T.DataType]:
    return {column.name: column.dataType for column in table.schema.fields}


def clean_texts(table: DataFrame) -> DataFrame:
    return table.withColumns({name: C.clean_text(F.col(name)) for name in TEXT_COLUMNS if name in table.columns})


def clean_numbers(table: DataFrame, integer_ids: bool = False) -> DataFrame:
    """Doubles for all number columns; text is stripped first, numbers are only cast.

    With ``integer_ids`` identifiers become bigint, exact beyond 2**53.
    """
    types = _types(table)

    def cleaned(name: str):
        value = F.col(name)
        is_text = isinstance(types[name], T.StringType)
        if integer_ids and name in ID_COLUMNS:
            digits = F.regexp_replace(F.trim(value), r"[^0-9.\-]", "") if is_text else value
            return digits.try_cast("decimal(38,4)").try_cast("bigint")
        return C.clean_number(value) if is_text else value.cast("double")

    return table.withColumns({name: cleaned(name) for name in NUMBER_COLUMNS if name in types})


def parse_times(table: DataFrame) -> DataFrame:
    """Timestamps from text; columns that already are timestamps stay as they are."""
    types = _types(table)
    return table.withColumns(
        {
            name: C.parse_time(F.col(name))
            for name in TIME_COLUMNS
            if isinstance(types.get(name), T.StringType)
        }
    )


def standardise(raw: DataFrame, integer_ids: bool = False) -> tuple[DataFrame, dict[str, str]]:
    """Rename, then clean texts, numbers and times in one projection; nothing is shuffled."""
    renamed, mapping = rename(raw)
    return parse_times(clean_numbers(clean_texts(renamed), integer_ids)), mapping


def drop_duplicate_rows(table: DataFrame) -> DataFrame:
    """One copy of every whole row; copies of a row meet map-side before the shuffle."""
    return table.dropDuplicates()


def drop_rare_duplicates(table: DataFrame, row_hash: Callable[..., Column] = F.xxhash64) -> DataFrame:
    """The rows of ``drop_duplicate_rows``, for a stored table in which few rows have a copy.

    The first pass shuffles eight bytes a row, a hash of its content, and stages the hashes of more than one row.
    Rows of these are compared by their whole content, so rows that only share a hash both stay; all others are
    left where they are. Spark joins the staged hashes by broadcast while they are below its threshold; then no
    other row is shuffled, however wide. Above it whole rows are, as in ``drop_duplicate_rows``, and this one is slower.

    Each row is read three times, so the table should be a stored one, and give the same rows every time. A table
    without columns, or with columns that cannot be compared, is treated like there.
    """
    if not table.columns:
        return drop_duplicate_rows(table)
    # By place, as names may clash with the hash or with each other.
    names = [f"c{i}" for i in range(len(table.columns))]
    placed = table.toDF(*names).withColumn("row_hash", F.coalesce(row_hash(*names), F.lit(0)))
    counted = placed.groupBy("row_hash").agg(F.count(F.lit(1)).alias("copies"))
    repeated = stage(counted.where("copies > 1").select("row_hash"), "repeated-rows")
    single = placed.join(repeated, "row_hash", "left_anti").select(*names)
    copied = placed.join(repeated, "row_hash", "left_semi").select(*names)
    return single.union(drop_duplicate_rows(copied)).toDF(*table.columns)
