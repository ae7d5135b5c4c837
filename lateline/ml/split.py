"""Model input and its stratified, repeatable train/test split."""

from __future__ import annotations

from fractions import Fraction
from math import ceil

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lateline.operators.ranks import values_at_ranks
from lateline.schema import CATEGORICAL_FEATURES, LEAKAGE_COLUMNS, NUMERIC_FEATURES, TARGET

FEATURES = CATEGORICAL_FEATURES + NUMERIC_FEATURES
TEST_SHARE = 0.2
SEED = 42
SPLIT_HASH = "split_hash"


def check_features(features: list[str]) -> None:
    """An error if a column that is only known after delivery is among the features."""
    leaking = [name for name in features if name in LEAKAGE_COLUMNS]
    if leaking:
        raise ValueError(f"not known when an order is placed: {', '.join(leaking)}")


def row_hash(columns: list[str], seed: int = SEED) -> Column:
    """52 hash bits of some columns: the same on every run, and exact as a double."""
    return F.shiftrightunsigned(F.xxhash64(F.lit(seed), *columns), 12)


def labelled(lines: DataFrame, keep: list[str] | None = None, seed: int = SEED) -> DataFrame:
    """Features, integer label and split hash of the lines that have a label, beside columns to ``keep``.

    The hash covers all columns of ``lines``, so that later passes need only this narrow table.
    """
    check_features(FEATURES)
    extra = [name for name in keep or [] if name not in [*FEATURES, TARGET]]
    return lines.where(F.col(TARGET).isNotNull()).select(
        *extra, *FEATURES, F.col(TARGET).cast("int").alias(TARGET), row_hash(lines.columns, seed).alias(SPLIT_HASH)
    )


def class_distribution(data: DataFrame) -> DataFrame:
    return data.groupBy(TARGET).agg(F.count(F.lit(1)).alias("rows")).orderBy(TARGET)


def hash_split(data: DataFrame, share: float = TEST_SHARE) -> tuple[DataFrame, DataFrame]:
    """Train and test by a hash threshold: no pass over the data, shares right on average."""
    in_test = F.col(SPLIT_HASH) < F.lit(int(share * 2**52))
    return data.where(~in_test), data.where(in_test)


def held_out_counts(counts: dict[int, int], share: float = TEST_SHARE) -> dict[int, int]:
    """Test rows per class: the rounded-up share of all rows, by largest remainder."""
    rows = sum(counts.values())
    if not rows:
        return dict.fromkeys(counts, 0)
    wanted = ceil(Fraction(str(share)) * rows)
    exact = {label: Fraction(wanted * count, rows) for label, count in counts.items()}
    result = {label: int(value) for label, value in exact.items()}
    by_remainder = sorted(counts, key=lambda label: (result[label] - exact[label], label))
    for label in by_remainder[: wanted - sum(result.values())]:
        result[label] += 1
    return result


def exact_split(data: DataFrame, share: float = TEST_SHARE) -> tuple[DataFrame, DataFrame]:
    """Train and test with the exact number of test rows in every class.

    The test rows of a class are those with its smallest hashes; the largest hash among them is
    found by counting (see ``ranks``), so no class is ever sorted or numbered in one task. Rows
    equal in all hashed columns stay on one side. ``data`` is read a few times, two columns only.
    """
    counts = {row[TARGET]: row["rows"] for row in class_distribution(data).collect()}  # one row per class
    wanted = {label: rows for label, rows in held_out_counts(counts, share).items() if rows}
    by_class = data.select(*[F.when(F.col(TARGET) == label, F.col(SPLIT_HASH)).alias(str(label)) for label in wanted])
    last = {str(label): (lambda _, rank=rows - 1: [rank]) for label, rows in wanted.items()}
    cutoffs = values_at_ranks(by_class, last) if wanted else {}
    in_test = F.lit(False)
    for label in wanted:
        cutoff = int(cutoffs[str(label)][0])
        in_test = in_test | ((F.col(TARGET) == label) & (F.col(SPLIT_HASH) <= F.lit(cutoff)))
    return data.where(~in_test), data.where(in_test)
