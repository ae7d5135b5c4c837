"""The clean order-line table, end to end."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

from lateline.operators.cleaning import drop_duplicate_rows, drop_personal, drop_rare_duplicates, standardise
from lateline.operators.features import add_date_parts, add_line_features, add_sales_level
from lateline.operators.ranks import approximate_quantiles, exact_quantiles
from lateline.schema import SALES_QUANTILE_ERROR, SALES_QUANTILES
from lateline.sources.staging import stage


@dataclass(frozen=True)
class CleanOrders:
    table: DataFrame
    mapping: dict[str, str]
    low_sales: float | None
    high_sales: float | None


def sales_thresholds(lines: DataFrame, relative_error: float = SALES_QUANTILE_ERROR) -> list[float | None]:
    """Lower and upper sales threshold; exact for a relative error of 0, nulls without sales."""
    if relative_error > 0:
        return approximate_quantiles(lines, "sales", SALES_QUANTILES, relative_error)
    return exact_quantiles(lines, "sales", SALES_QUANTILES) or [None, None]


def clean_orders(
    raw: DataFrame,
    relative_error: float = SALES_QUANTILE_ERROR,
    integer_ids: bool = False,
    rare_duplicates: bool = False,
) -> CleanOrders:
    """Clean, deduplicate and extend raw order lines.

    The sales bands need a quantile of the deduplicated lines. These are staged once, so that
    the wide deduplication shuffle runs once, and the quantile reads a single column. With
    ``rare_duplicates`` the lines are staged before that too, and only rows whose hash repeats are shuffled.
    """
    lines, mapping = standardise(drop_personal(raw).table, integer_ids)
    single = drop_rare_duplicates(stage(lines, "standard-lines")) if rare_duplicates else drop_duplicate_rows(lines)
    lines = add_date_parts(add_line_features(single))
    low = high = None
    if "sales" in lines.columns:
        lines = stage(lines, "clean-lines")
        low, high = sales_thresholds(lines, relative_error)
        lines = add_sales_level(lines, low, high)
    return CleanOrders(lines, mapping, low, high)
