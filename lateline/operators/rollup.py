"""Order-aware roll-up: counts over distinct orders beside sums and means over lines.

``countDistinct(order_id)`` next to sums makes Spark expand every line once per distinct
count. Grouping first by ``(keys, order_id)`` and then by ``keys`` gives the same figures from
two plain hash aggregates: the first spreads over all orders, so a key (or an order) holding a
large share of the lines is combined map-side, and the second only sees one row per order.
An order is late, or at a loss, in a group when any of its lines in that group is. Lines
without an order id add to sums and means but are not counted as orders.

The second aggregate gives *totals*, which can be added up over tables that share no order.
Figures are then plain expressions of the totals.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lateline.functions.columns import percentage
from lateline.sources.staging import stage

ORDER = "order_id"
HOME = "__home"
#: Lines of an order from which they are added up by combination of keys before they meet.
FREQUENT_LINES = 10_000

# Which totals, beside the number of orders, each figure is made of.
TOTALS = {
    "total_orders": [],
    "late_orders": ["late"],
    "loss_orders": ["loss"],
    "late_delivery_rate": ["late"],
    "loss_rate": ["loss"],
    "total_sales": ["sales"],
    "total_profit": ["profit"],
    "average_profit_per_order": ["profit", "profit_lines"],
    "average_shipping_days": ["days", "days_lines"],
    "average_profit_margin": ["margin", "margin_lines"],
    "average_discount_rate": ["discount", "discount_lines"],
}
MEASURES = list(TOTALS)
SOURCES = {
    "late": "late_delivery_risk",
    "loss": "is_loss_order",
    "sales": "sales",
    "profit": "order_profit_per_order",
    "days": "days_for_shipping_real",
    "margin": "profit_margin",
    "discount": "order_item_discount_rate",
}
FLAGS = ["late", "loss"]
EXACT = ["sales", "profit", "discount"]  # summed in the chosen type


def _needed(measures: list[str]) -> list[str]:
    return list(dict.fromkeys(total for measure in measures for total in TOTALS[measure]))


def _total(name: str) -> Column:
    return F.col(f"__{name}")


def _of_order(name: str, sum_type: str) -> Column:
    """One total over the lines of an order in a group."""
    source, _, counted = name.partition("_")
    value = F.col(SOURCES[source])
    if source in FLAGS:
        result = F.max(F.when(value == 1, 1).otherwise(0))
    elif counted:
        result = F.count(value)
    else:
        result = F.sum(value.cast(sum_type) if source in EXACT else value)
    return result.alias(f"__{name}")


def _of_group(name: str) -> Column:
    """One total over the orders of a group."""
    if name == "orders":
        result = F.count(ORDER)
    elif name in FLAGS:
        flagged = F.sum(F.when(F.col(ORDER).isNotNull(), _total(name)))
        result = F.coalesce(flagged, F.lit(0).cast("bigint"))
    else:
        result = F.sum(_total(name))
    return result.alias(f"__{name}")


def _figure(name: str) -> Column:
    """One figure as an expression of the totals of a group."""

    def mean(of: str) -> Column:
        return F.try_divide(_total(of).cast("double"), _total(f"{of}_lines"))

    orders = _total("orders")
    column = {
        "total_orders": lambda: orders,
        "late_orders": lambda: _total("late"),
        "loss_orders": lambda: _total("loss"),
        "late_delivery_rate": lambda: percentage(_total("late"), orders),
        "loss_rate": lambda: percentage(_total("loss"), orders),
        "total_sales": lambda: _total("sales").cast("double"),
        "total_profit": lambda: _total("profit").cast("double"),
        "average_profit_per_order": lambda: mean("profit"),
        "average_shipping_days": lambda: mean("days"),
        "average_profit_margin": lambda: mean("margin") * 100,
        "average_discount_rate": lambda: mean("discount") * 100,
    }[name]()
    return column.alias(name)


def _figures(totals: DataFrame, keys: list[str], measures: list[str]) -> DataFrame:
    return totals.select(*keys, *[_figure(name) for name in measures])


def _order_columns(measures: list[str], sum_type: str) -> list[Column]:
    # An aggregate needs a column even where only orders are counted.
    return [_of_order(name, sum_type) for name in _needed(measures)] or [F.count(F.lit(1)).alias("__lines")]


def _group_columns(measures: list[str]) -> list[Column]:
    return [_of_group(name) for name in ["orders", *_needed(measures)]]


def group_totals(lines: DataFrame, keys: list[str], measures: list[str], sum_type: str) -> DataFrame:
    """Totals per group of ``keys``; without keys one row, also for empty input."""
    orders = lines.groupBy(*keys, ORDER).agg(*_order_columns(measures, sum_type))
    groups = orders.groupBy(*keys) if keys else orders
    return groups.agg(*_group_columns(measures))


def roll_up(lines: DataFrame, keys: list[str], measures: list[str], sum_type: str = "double") -> DataFrame:
    """Figures per group of ``keys``; without keys one row, also for empty input.

    ``sum_type`` is the type in which sales, profit and discount rates are summed. Sums of doubles
    depend on the order of addition in their last digits; for values of at most four decimals,
    ``decimal(18,4)`` gives the same exact sums on every run.
    """
    return _figures(group_totals(lines, keys, measures, sum_type), keys, measures)


# --- several key sets at once --------------------------------------------------------------

KeySets = dict[str, list[str]]


def all_keys(key_sets: KeySets) -> list[str]:
    return list(dict.fromkeys(key for names in key_sets.values() for key in names))


def _of_line(name: str, sum_type: str) -> Column:
    """One total of a single line."""
    source, _, counted = name.partition("_")
    value = F.col(SOURCES[source])
    if source in FLAGS:
        return F.when(value == 1, 1).otherwise(0)
    if counted:
        return value.isNotNull().cast("bigint")
    return value.cast(sum_type) if source in EXACT else value


def _orders(lines: DataFrame, keys: list[str], measures: list[str], sum_type: str, partitions: int | None) -> DataFrame:
    """Totals per line, or per frequent order and combination of all keys, with all rows of an order in one partition.

    Lines are shuffled once, by order. Only those of an order with ``FREQUENT_LINES`` or more, or without an order id, are added
    up per order and combination before it: so an order with a large share of all lines leaves only its combinations.
    Rows without an order id count as no order and need not meet: they are spread by their keys.
    """
    counted = lines.groupBy(ORDER).agg(F.count(F.lit(1)).alias("__lines"))
    frequent = counted.where((F.col("__lines") >= FREQUENT_LINES) | F.col(ORDER).isNull())
    frequent = stage(frequent.select(F.col(ORDER).alias("__frequent")), "frequent-orders")
    same = F.col(ORDER).eqNullSafe(F.col("__frequent"))
    added = lines.join(frequent, same, "left_semi").groupBy(ORDER, *keys).agg(*_order_columns(measures, sum_type))
    of_line = {f"__{name}": _of_line(name, sum_type) for name in _needed(measures)} or {"__lines": F.lit(1)}
    single = [value.cast(added.schema[name].dataType).alias(name) for name, value in of_line.items()]
    orders = lines.join(frequent, same, "left_anti").select(ORDER, *keys, *single).unionByName(added)
    home = F.when(F.col(ORDER).isNotNull(), F.xxhash64(ORDER)).otherwise(F.xxhash64(*keys))
    placed = orders.withColumn(HOME, home)
    return placed.repartition(partitions, HOME) if partitions else placed.repartition(HOME)


class _Seen:
    """Marks the first row of each order in each group of each key set, as rows go by; rows of an order follow each other.

    Of an order that goes on in the next batch, the groups met so far are held.
    """

    def __init__(self, key_sets: list[list[str]]) -> None:
        self.key_sets = key_sets
        self.held: list[set] = [set() for _ in key_sets]

    def marks(self, batch: pa.RecordBatch, order: np.ndarray, wanted: np.ndarray, goes_on: bool) -> np.ndarray:
        """A bit for each key set, from the number of each row's order in the batch; only of ``wanted`` rows."""
        marks, rows = np.zeros(batch.num_rows, np.int64), np.flatnonzero(wanted)
        last = order[-1]
        for i, keys in enumerate(self.key_sets):
            group = order
            for key in keys:
                group = group * (len(batch[key]) + 2) + _codes(batch[key]) + 1
                group = np.unique(group, return_inverse=True)[1] if len(keys) > 1 else group
            first = rows[np.unique(group[rows], return_index=True)[1]]
            values = lambda row: tuple(batch[key][row].as_py() for key in keys)  # noqa: E731, B023
            if goes_on:
                met = [row for row in first[order[first] == 0].tolist() if values(row) in self.held[i]]
                first = np.setdiff1d(first, met)
            if last or not goes_on:
                self.held[i] = set()
            self.held[i].update(map(values, first[order[first] == last].tolist()))
            marks[first] |= 1 << i
        return marks


def _codes(column: pa.Array) -> np.ndarray:
    """A number for each different value, -1 for null."""
    indices = column.dictionary_encode().indices
    return pc.fill_null(indices, -1).to_numpy(zero_copy_only=False).astype(np.int64)


def _marked(orders: DataFrame, key_sets: list[list[str]], flags: list[str]) -> DataFrame:
    """``__in_orders`` and one such column for each flag: in which key sets a row is its order's first (flagged) one of a group.

    A group's sum of these bits is its number of (flagged) orders, so no table of groups and orders is ever built: rows are
    sorted by order once, and a task holds one order's groups at most. Rows without an order id have no bits.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds, previous = {name: _Seen(key_sets) for name in ["orders", *flags]}, None
        for batch in batches:
            if not batch.num_rows:
                continue
            known = _codes(batch[ORDER])
            order = np.concatenate([[0], np.cumsum(known[1:] != known[:-1])])
            goes_on = repr(batch[ORDER][0].as_py()) == previous
            marks = []
            for name, seen in kinds.items():
                wanted = known >= 0
                if name != "orders":
                    wanted = wanted & (batch[f"__{name}"].to_numpy(zero_copy_only=False) > 0)
                marks.append(pa.array(seen.marks(batch, order, wanted, goes_on)))
            previous = repr(batch[ORDER][-1].as_py())
            yield pa.RecordBatch.from_arrays([*batch.columns, *marks], names=[*batch.schema.names, *[f"__in_{name}" for name in kinds]])

    schema = T.StructType([*orders.schema.fields, *[T.StructField(f"__in_{name}", T.LongType()) for name in ["orders", *flags]]])
    return orders.sortWithinPartitions(HOME, ORDER).mapInArrow(run, schema)


def roll_up_sets(
    lines: DataFrame,
    key_sets: KeySets,
    measures: list[str],
    sum_type: str = "double",
    partitions: int | None = None,
) -> DataFrame:
    """Figures for several key sets (at most 63), in a column ``key_set`` beside all keys; no row at all for empty input.

    Totals of lines are shuffled by order, into ``partitions`` if given, and sorted by it. There each
    row learns in which key sets it is its order's first one of a group, and a generator counts it for all of them. Only groups
    are aggregated and shuffled after it. The order ids are read before, as those of many lines are told and staged first.
    """
    keys, needed = all_keys(key_sets), _needed(measures)
    orders = _orders(lines, keys, measures, sum_type, partitions)
    flags = [name for name in needed if name in FLAGS]
    sums = [name for name in needed if name not in FLAGS]
    marked = _marked(orders, list(key_sets.values()), flags)

    def of_set(i: int, name: str, names: list[str]) -> Column:
        own = [F.col(key) if key in names else F.lit(None).cast(orders.schema[key].dataType) for key in keys]
        bits = [F.shiftright(f"__in_{kind}", i).bitwiseAND(F.lit(1)).alias(f"__{kind}") for kind in ["orders", *flags]]
        return F.struct(F.lit(name).alias("key_set"), *[value.alias(key) for value, key in zip(own, keys)], *bits)

    sets = F.inline(F.array(*[of_set(i, name, names) for i, (name, names) in enumerate(key_sets.items())]))
    of_groups = marked.select(*[f"__{name}" for name in sums], sets).groupBy("key_set", *keys)
    groups = of_groups.agg(*[F.sum(_total(name)).alias(f"__{name}") for name in ["orders", *needed]])
    return _figures(groups, ["key_set", *keys], measures)
