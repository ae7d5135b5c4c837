"""Exact values at given ranks of numeric columns, without sorting or gathering them.

``percentile`` and ``median`` hold every distinct value of a column in one task. Here each pass
counts values in equal-width buckets (combined map-side, at most ``BUCKETS`` groups per rank,
once for all ranks that are still in the same values), keeps the bucket each rank falls in, and looks again
inside its smallest and largest value until these are the same. Each pass reads only the wanted columns; two to
four passes are usual.
"""

from __future__ import annotations

import sys
from dataclasses import dataclass
from fractions import Fraction
from math import ceil, floor

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

BUCKETS = 4096


@dataclass
class _Search:
    column: str
    rank: int  # 0-based, among the values still between low and high
    low: float
    high: float


def _extent(table: DataFrame, columns: list[str]) -> dict[str, tuple[int, float, float]]:
    """Count, minimum and maximum of each column."""
    row = table.agg(
        *[
            make(name).alias(f"{what}_{i}")
            for i, name in enumerate(columns)
            for what, make in (("n", F.count), ("low", F.min), ("high", F.max))
        ]
    ).first()
    return {name: (row[f"n_{i}"], row[f"low_{i}"], row[f"high_{i}"]) for i, name in enumerate(columns)}


def _ranges(searches: list[_Search]) -> dict[tuple[str, float, float], list[int]]:
    """The numbers of the searches that look in the same values of a column: these are counted once for all of them."""
    found: dict[tuple[str, float, float], list[int]] = {}
    for number, search in enumerate(searches):
        found.setdefault((search.column, search.low, search.high), []).append(number)
    return found


def _narrow(table: DataFrame, searches: list[_Search]) -> None:
    """One pass: move every search into the bucket that holds its rank."""
    ranges = _ranges(searches)

    def located(number: int, column: str, low: float, high: float):
        value = F.col(column)
        # Halves of finite ends keep the width finite for any two doubles.
        start = max(low, -sys.float_info.max) / 2
        width = min(high, sys.float_info.max) / 2 - start
        bucket = F.floor((value / 2 - start) / width * BUCKETS)
        bucket = F.greatest(F.lit(0), F.least(bucket, F.lit(BUCKETS - 1)))
        return F.when(
            value.between(low, high),
            F.struct(F.lit(number).alias("range"), bucket.alias("bucket"), value.alias("value")),
        )

    tagged = F.array_compact(F.array(*[located(i, *place) for i, place in enumerate(ranges)]))
    buckets = (
        table.select(F.inline(tagged))
        .groupBy("range", "bucket")
        .agg(F.count(F.lit(1)).alias("n"), F.min("value").alias("low"), F.max("value").alias("high"))
    )
    # At most BUCKETS rows per range.
    running = Window.partitionBy("range").orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)
    wanted = [(i, number, searches[number].rank) for i, numbers in enumerate(ranges.values()) for number in numbers]
    wanted = table.sparkSession.createDataFrame(wanted, "range int, search int, wanted bigint")
    hits = (
        buckets.withColumn("upto", F.sum("n").over(running))
        .join(F.broadcast(wanted), "range")  # one row per search
        .where((F.col("upto") > F.col("wanted")) & (F.col("upto") - F.col("n") <= F.col("wanted")))
        .select("search", "low", "high", (F.col("upto") - F.col("n")).alias("before"))
    )
    for hit in hits.collect():  # one row per search
        search = searches[hit["search"]]
        search.rank -= hit["before"]
        search.low, search.high = hit["low"], hit["high"]


def values_at_ranks(table: DataFrame, ranks) -> dict[str, list[float]]:
    """Values at 0-based ranks. ``ranks`` maps ``column -> (count -> list of ranks)``.

    Nulls and NaN are left out. A column without values gives an empty list.
    """
    names = list(ranks)
    plain = table.select(
        *[F.when(~F.isnan(F.col(name).cast("double")), F.col(name).cast("double")).alias(name) for name in names]
    )
    searches: list[_Search] = []
    found: dict[str, list[_Search]] = {}
    for name, (count, low, high) in _extent(plain, names).items():
        found[name] = [_Search(name, rank, low, high) for rank in (ranks[name](count) if count else [])]
        searches += found[name]
    while open_searches := [search for search in searches if search.low != search.high]:
        _narrow(plain, open_searches)
    return {name: [search.low for search in column] for name, column in found.items()}


def exact_quantiles(table: DataFrame, column: str, probabilities: list[float]) -> list[float]:
    """Smallest values with at least the given shares of the column at or below them."""

    def ranks(count: int) -> list[int]:
        return [max(ceil(Fraction(str(p)) * count) - 1, 0) for p in probabilities]

    return values_at_ranks(table, {column: ranks})[column]


def exact_medians(table: DataFrame, columns: list[str]) -> dict[str, float | None]:
    """Medians of several columns; the mean of the two middle values for even counts."""

    def middle(count: int) -> list[int]:
        return sorted({floor((count - 1) / 2), ceil((count - 1) / 2)})

    values = values_at_ranks(table, {name: middle for name in columns})
    return {name: sum(found) / len(found) if found else None for name, found in values.items()}


def approximate_quantiles(
    table: DataFrame, column: str, probabilities: list[float], relative_error: float
) -> list[float | None]:
    """Spark's approximate quantiles; nulls in place of the empty answer for no values."""
    found = table.approxQuantile(column, probabilities, relative_error)
    return found if found else [None] * len(probabilities)
