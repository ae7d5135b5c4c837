"""Mixing sources to target weights by entropy balancing.

Each document gets a rate w between 0 and ``MOST_COPIES``: of all rates whose words meet the target
of every source, those with the least relative entropy to one copy of each document. The dual of this
problem is convex with one multiplier for each source, and its solution tilts the rates
exponentially: w = min(MOST_COPIES, exp(multiplier * size / scale)), where scale is the mean size.
Newton's method finds the multipliers; each iteration is one aggregation over a staged table of
(source, size, documents), which is all that the dual depends on. Rates are then rounded into copies
by carrying the words that rounding left over from document to document, larger ones first, in
blocks dealt out by a hash of id and text: a source with a third of all rows has many blocks, also if
all its rows have one id or none.
"""

from __future__ import annotations

import math
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lateline.llm.common import WORD, fresh, parameters
from lateline.sources.staging import stage

MOST_COPIES = 3
WEIGHTS = (1, 2, 3)
#: Documents that are rounded together.
BLOCK_ROWS = 4_000
NEWTON_STEPS = 60


def with_sizes(docs: DataFrame, *more: str) -> DataFrame:
    """doc_id, source, the number of words (null: 0) and a hash of the text of every row, and ``more`` columns as they are."""
    words = F.regexp_count(F.col("text").cast("string"), F.lit(WORD))
    size = F.coalesce(words, F.lit(0)).cast("long").alias("size")
    return docs.select("doc_id", F.col("source").cast("string").alias("source"), size, F.xxhash64(F.col("text").cast("string")).alias("text_hash"), *more)


def targets(sizes: list[int], weights: list[int], most: int = MOST_COPIES) -> list[float]:
    """Shares of the sum of sizes by weight; none above ``most`` times its size, the excess reshared."""
    result, open_, left = [0.0] * len(sizes), set(range(len(sizes))), float(sum(sizes))
    while open_:
        unit = left / sum(weights[i] for i in open_)
        over = [i for i in sorted(open_) if unit * weights[i] >= most * sizes[i]]
        if not over:
            for i in open_:
                result[i] = unit * weights[i]
            break
        for i in over:
            result[i] = float(most * sizes[i])
            left -= result[i]
            open_.discard(i)
    return result


def _multipliers(histogram: DataFrame, sources: list[tuple], most: int) -> list[float]:
    """Newton iterations on the dual, all sources at once; steps are halved into the bracket when they leave it.

    ``sources``: (number, size, target, scale). Words taken rise with the multiplier, so every value
    computed narrows the bracket of the root.
    """
    spark, limit = histogram.sparkSession, 700.0
    at = [0.0] * len(sources)
    low, high = [-limit] * len(sources), [limit] * len(sources)
    active = {i for i, (_, size, goal, _) in enumerate(sources) if 0 < goal < most * size and goal != size}
    for i, (_, size, goal, _) in enumerate(sources):
        if size and goal >= most * size:
            at[i] = math.inf
    for _ in range(NEWTON_STEPS):
        if not active:
            break
        state = spark.createDataFrame([(sources[i][0], at[i], sources[i][3]) for i in sorted(active)], "number int, multiplier double, scale double")
        x = F.col("size") / F.col("scale")
        tilt = F.least(F.col("multiplier") * x, F.lit(math.log(most)))
        words, free = F.col("documents") * F.col("size") * F.exp(tilt), F.col("multiplier") * x < math.log(most)
        sums = histogram.join(parameters(state, len(active)), "number").groupBy("number").agg(F.sum(words).alias("taken"), F.sum(F.when(free, words * x).otherwise(0.0)).alias("slope"))
        for row in sums.collect():  # one row for each source
            i = row["number"]
            goal = sources[i][2]
            excess = row["taken"] - goal
            if abs(excess) <= 1e-9 * goal:
                active.discard(i)
                continue
            if excess > 0:
                high[i] = at[i]
            else:
                low[i] = at[i]
            step = at[i] - excess / row["slope"] if row["slope"] > 0 else math.inf
            at[i] = step if low[i] < step < high[i] else max(low[i], min(high[i], (low[i] + high[i]) / 2))
            if high[i] - low[i] < 1e-12:
                active.discard(i)
    # rounded: sums of doubles differ in their last digits between runs
    return [x if math.isinf(x) else round(x, 9) for x in at]


def _rounded(most: int):
    def run(key: tuple, table: pa.Table) -> pa.Table:
        size, rate = table["size"].to_numpy(), table["rate"].to_numpy()
        ids = table["doc_id"].to_pandas()
        order = np.lexsort((ids.fillna(-1).to_numpy(), ids.isna().to_numpy(), -size))
        copies, carry = np.zeros(len(size), np.int64), 0.0
        for i in order:
            if size[i]:
                want = rate[i] + carry / size[i]
                copies[i] = min(most, max(0, math.floor(want + 0.5)))
                carry += (rate[i] - copies[i]) * size[i]
            else:
                copies[i] = 1
        return table.drop_columns(["number", "block"]).append_column("copies", pa.array(copies))

    return run


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_COPIES, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """A row for each row of ``docs``: doc_id, source, size, source_size, target, rate, copies, taken.

    Sources by code point, null last, have the weights repeating, and share all words by them. A source
    is a domain of its own when null. Documents without words have rate and copies 1: they cost
    nothing. Equal rows are rounded one by one. The same input gives the same copies, but that rows
    with one doc_id, source and size may change places. An empty table gives an empty result.

    One row for each source is held by the driver, as the mix itself is a list of sources; so are
    its multipliers.
    """
    return _mix(docs, weights, most, block_rows)


def _mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_COPIES, block_rows: int = BLOCK_ROWS, key: str | None = None) -> DataFrame:
    """The mix, with the long column ``key`` of each row if one is named."""
    more = [key] if key else []
    sized = stage(with_sizes(docs, *more), "mix-sizes")
    histogram = sized.groupBy("source", "size").agg(F.count(F.lit(1)).alias("documents"))
    totals = histogram.groupBy("source").agg(F.sum(F.col("size") * F.col("documents")).alias("words"), F.sum("documents").alias("documents"))
    found = sorted(totals.collect(), key=lambda r: (r["source"] is None, r["source"] or ""))
    goals = targets([r["words"] for r in found], [weights[i % len(weights)] for i in range(len(found))], most)
    scales = [max(r["words"] / r["documents"], 1.0) for r in found]
    rows = [(i, r["source"], r["words"], g, s, max(1, math.ceil(r["documents"] / block_rows))) for i, (r, g, s) in enumerate(zip(found, goals, scales))]
    spark = docs.sparkSession
    names = spark.createDataFrame(rows, "number int, source string, source_size long, target double, scale double, blocks long")
    numbers = parameters(names.select("number", F.col("source").alias("name")), len(rows))
    counted = histogram.join(numbers, F.col("source").eqNullSafe(F.col("name"))).select("number", "size", "documents")
    counted = stage(counted, "mix-histogram")
    at = _multipliers(counted, [(i, words, goal, scale) for i, _, words, goal, scale, _ in rows], most)
    params = spark.createDataFrame([(*r, m) for r, m in zip(rows, at)], names.schema.add("multiplier", "double"))
    params = parameters(params.withColumnRenamed("source", "name"), len(rows))
    joined = sized.join(params, F.col("source").eqNullSafe(F.col("name")))
    # Without words a rate has no meaning; at the bound the multiplier is infinite.
    rate = F.when(F.col("size") == 0, 1.0).when(F.col("target") <= 0, 0.0).otherwise(F.least(F.lit(float(most)), F.exp(F.col("multiplier") * F.col("size") / F.col("scale"))))
    dealt = joined.withColumns({"rate": rate, "block": F.pmod(F.xxhash64("doc_id", "text_hash", F.lit(7)), F.col("blocks"))})
    kept = "".join(f"`{name}` long, " for name in more)
    schema = f"doc_id long, source string, size long, {kept}source_size long, target double, rate double, copies long"
    columns = [F.col("doc_id").cast("long").alias("doc_id"), "source", "size", *more, "source_size", "target", "rate", "number", "block"]
    rounded = dealt.select(*columns).groupBy("number", "block").applyInArrow(_rounded(most), schema)
    return rounded.withColumn("taken", F.col("copies") * F.col("size"))


def mixed_rows(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` as often as the mix takes them, with all their columns; each row its own copies."""
    key, copies, again = (fresh(docs, n) for n in ("mix_key", "mix_copies", "mix_again"))
    rows = stage(docs.withColumn(key, F.monotonically_increasing_id()), "mix-rows")
    taken = _mix(rows, **options, key=key).where("copies > 0").select(key, F.col("copies").cast("int").alias(copies))
    rows = rows.join(taken, key)
    return rows.withColumn(again, F.explode(F.sequence(F.lit(1), copies))).select(docs.columns)
