import math
import random

import pytest
from pyspark.sql import functions as F

from lateline.operators import ranks
from lateline.operators.running import running_totals


def table_of(spark, values, column="v"):
    return spark.createDataFrame([(v,) for v in values], f"{column} double")


@pytest.mark.parametrize(
    "values",
    [
        [1.0, 2.0, 3.0, 10.0],
        [5.0] * 50 + [1.0] + [9.0] * 3,
        [1e308, -1e308, 0.0, 1.0, 2.0],
        [0.1 * i * (-1) ** i for i in range(101)],
        [2.0],
        [math.inf, -math.inf, 1.0, 2.0, 3.0],
        [1e-300, 2e-300, 1.0, 1e300],
    ],
)
@pytest.mark.parametrize("buckets", [2, 7, 4096])
def test_median_and_quantiles(spark, monkeypatch, values, buckets):
    monkeypatch.setattr(ranks, "BUCKETS", buckets)
    if buckets == 2 and max(map(abs, values)) > 1e100:
        pytest.skip("halving a range of all doubles takes hundreds of passes")
    shuffled = random.Random(1).sample(values, len(values)) + [None, math.nan]
    table = table_of(spark, shuffled)
    ordered = sorted(values)
    middle = (ordered[(len(values) - 1) // 2] + ordered[len(values) // 2]) / 2
    assert ranks.exact_medians(table, ["v"]) == {"v": middle}
    wanted = [ordered[max(math.ceil(p * len(values)) - 1, 0)] for p in (0.0, 0.25, 0.5, 1.0)]
    assert ranks.exact_quantiles(table, "v", [0.0, 0.25, 0.5, 1.0]) == wanted


def test_no_values(spark):
    table = table_of(spark, [None, None])
    assert ranks.exact_medians(table, ["v"]) == {"v": None}
    assert ranks.exact_quantiles(table, "v", [0.5]) == []
    assert ranks.approximate_quantiles(table, "v", [0.3, 0.6], 0.01) == [None, None]


def test_several_columns_of_a_larger_table(spark):
    table = spark.range(20_001).select(
        (F.col("id") * 1.0).alias("a"), (F.pmod(F.col("id"), F.lit(3)) * 1.0).alias("b"), F.exp(F.rand(1) * 50).alias("c")
    ).cache()
    found = ranks.exact_medians(table, ["a", "b", "c"])
    assert found == {name: table.select(F.median(name)).first()[0] for name in "abc"}


@pytest.mark.parametrize("ranges", [1, 2, 3, 50])
def test_running_totals(spark, ranges):
    generator = random.Random(7)
    rows = [(float(i), generator.randint(0, 5), generator.randint(0, 5)) for i in range(200)]
    table = spark.createDataFrame(generator.sample(rows, 200), "s double, a bigint, b bigint")
    got = {row["s"]: (row["a_before"], row["b_before"]) for row in running_totals(table, "s", ["a", "b"], ranges).collect()}
    assert got == {s: (sum(r[1] for r in rows if r[0] > s), sum(r[2] for r in rows if r[0] > s)) for s, _, _ in rows}


def test_ranks_among_the_same_values_are_counted_once(spark, monkeypatch):
    """The first pass over a column makes one entry a row, however many ranks are wanted."""
    passes, ranges = [], ranks._ranges
    monkeypatch.setattr(ranks, "_ranges", lambda searches: passes.append((len(searches), len(ranges(searches)))) or ranges(searches))
    table = spark.range(9000).selectExpr("cast(id * id % 7919 as double) as x")
    values = sorted(i * i % 7919 for i in range(9000))
    shares = [k / 8 for k in range(1, 8)]
    assert ranks.exact_quantiles(table, "x", shares) == [values[9000 * k // 8 - 1] for k in range(1, 8)]
    assert passes[0] == (7, 1)
