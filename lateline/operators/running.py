"""Running totals along an ordered column, spread over tasks.

A window without partitions would sort everything in one task. Rows are cut into ranges at
approximate quantiles, totals of the (few) ranges are accumulated first, and each range then
only adds its own running sums to what came before it.
"""

from __future__ import annotations

from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

RANGES = 1000


def running_totals(groups: DataFrame, order: str, sums: list[str], ranges: int = RANGES) -> DataFrame:
    """Add ``<sum>_before``: the total of ``sum`` over all rows with a larger ``order``.

    ``groups`` has one row per value of ``order`` (a non-null double), so a value shared by many
    input rows is one row here. It is read three times: give it from a written or cheap table.
    """
    ranges = max(ranges, 2)
    cuts = groups.approxQuantile(order, [i / ranges for i in range(1, ranges)], 0.1 / ranges) or [0.0]
    splits = [float("-inf"), *sorted(set(cuts)), float("inf")]
    ranged = Bucketizer(splits=splits, inputCol=order, outputCol="__range").transform(groups)

    def before(column: str, window):
        return F.coalesce(F.sum(column).over(window), F.lit(0))

    # One row per range: at most ``ranges`` rows, for the window and the broadcast alike.
    over_ranges = Window.orderBy(F.desc("__range")).rowsBetween(Window.unboundedPreceding, -1)
    totals = ranged.groupBy("__range").agg(*[F.sum(name).alias(name) for name in sums])
    offsets = totals.select("__range", *[before(name, over_ranges).alias(f"__{name}_offset") for name in sums])

    within = (
        Window.partitionBy("__range").orderBy(F.desc(order)).rowsBetween(Window.unboundedPreceding, -1)
    )
    return (
        ranged.withColumns({f"{name}_before": before(name, within) for name in sums})
        .join(F.broadcast(offsets), "__range")
        .select(
            *groups.columns,
            *[(F.col(f"{name}_before") + F.col(f"__{name}_offset")).alias(f"{name}_before") for name in sums],
        )
    )
