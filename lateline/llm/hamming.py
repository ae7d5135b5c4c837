"""Links between fingerprints that differ in few bits, by Gray-order hierarchical indexes.

A fingerprint is one or more words of 64 bits. It is cut into ranges of bits and sent to the bucket of
each range; fingerprints that differ in fewer bits than there are ranges always meet, others do with
some probability. Within a bucket they are sorted by Gray rank, which puts those with
few differing bits next to each other. Runs of them are the lowest nodes of an index, runs of nodes the
next ones, and each node keeps the bits that all below it share. Two nodes whose shared bits differ
more than d times hold no link, and the whole pair is pruned; the others are opened.

A bucket of more than ``SPLIT`` fingerprints is split by the same factoring one level up: its most
even bits are a pattern for each of its parts, and only parts whose patterns differ at most d times
meet, each pair of parts in a bucket of its own. What a bucket gives out is a star for each of its
components, not all its pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lateline.llm.common import parameters, tasks
from lateline.sources.staging import stage

FAN = 8
#: Fingerprints of a bucket that is not split, and the most bits it is split by.
SPLIT, SPLIT_BITS = 4_096, 16
#: Pairs of nodes opened at once.
OPENED = 200_000


def differing(bits: np.ndarray) -> np.ndarray:
    """Bits set in each row of words."""
    return np.bitwise_count(bits).sum(axis=1, dtype=np.int64)


def gray_rank(values: np.ndarray) -> np.ndarray:
    """Place of each value in the reflected Gray code."""
    rank = values.copy()
    for shift in (1, 2, 4, 8, 16, 32):
        rank ^= rank >> np.uint64(shift)
    return rank


class Forest:
    """Sets of numbered things, each known by its least member."""

    def __init__(self, size: int) -> None:
        self.least = np.arange(size)

    def link(self, a: np.ndarray, b: np.ndarray) -> None:
        while True:
            x, y = self.least[a], self.least[b]
            apart = x != y
            if not apart.any():
                return
            a, b, x, y = a[apart], b[apart], x[apart], y[apart]
            np.minimum.at(self.least, np.maximum(x, y), np.minimum(x, y))
            while not np.array_equal(above := self.least[self.least], self.least):
                self.least = above


class Index:
    """Levels of nodes over sorted fingerprints (rows of words); nodes never cross from bucket to bucket."""

    def __init__(self, bucket: np.ndarray, prints: np.ndarray) -> None:
        self.all, self.any = [prints], [prints]  # bits set in all, and in any, below a node
        self.first = [np.arange(len(prints))]  # first child of each node
        self.leaf = [np.arange(len(prints) + 1)]  # first fingerprint of each node, and the end
        while True:
            starts = np.flatnonzero(np.diff(bucket, prepend=~bucket[:1]))
            sizes = np.diff(np.append(starts, len(bucket)))
            if sizes.max(initial=0) <= 1:
                break
            within = np.arange(len(bucket)) - np.repeat(starts, sizes)
            heads = np.flatnonzero(within % FAN == 0)
            self.all.append(np.bitwise_and.reduceat(self.all[-1], heads))
            self.any.append(np.bitwise_or.reduceat(self.any[-1], heads))
            self.first.append(np.append(heads, len(bucket)))
            self.leaf.append(np.append(self.leaf[-1][heads], len(prints)))
            bucket = bucket[heads]
        self.roots = len(self.all[-1])

    def links(self, distance: int, forest: Forest) -> None:
        """Link fingerprints that differ at most so much. Nodes that are in one set already stay closed."""
        top = len(self.all) - 1
        roots = np.arange(self.roots)
        waiting = [(top, roots, roots)]
        while waiting:
            level, a, b = waiting.pop()
            if not level or not len(a):
                continue
            if len(a) > OPENED // FAN**2:
                cut = OPENED // FAN**2
                waiting.append((level, a[cut:], b[cut:]))
                a, b = a[:cut], b[:cut]
            begin = self.leaf[level][:-1]
            lowest, highest = np.minimum.reduceat(forest.least, begin), np.maximum.reduceat(forest.least, begin)
            joined = (lowest[a] == highest[a]) & (lowest[b] == highest[b]) & (lowest[a] == lowest[b])
            a, b = a[~joined], b[~joined]
            first = self.first[level]
            wide, high = first[b + 1] - first[b], first[a + 1] - first[a]
            own = np.repeat(np.arange(len(a)), wide * high)
            step = np.arange(len(own)) - np.repeat(np.cumsum(wide * high) - wide * high, wide * high)
            x, y = first[a][own] + step // wide[own], first[b][own] + step % wide[own]
            level -= 1
            fresh = (x < y) if not level else (x <= y)
            x, y = x[fresh | (a != b)[own]], y[fresh | (a != b)[own]]
            all_, any_ = self.all[level], self.any[level]
            possible = differing((all_[x] & ~any_[y]) | (all_[y] & ~any_[x])) <= distance
            x, y = x[possible], y[possible]
            if not level:
                forest.link(x, y)
                continue
            # All below two nodes are linked if all their varying bits together are few enough.
            near = differing((any_[x] | any_[y]) & ~(all_[x] & all_[y])) <= distance
            for node in (x[near], y[near]):
                begin, end = self.leaf[level][node], self.leaf[level][node + 1]
                if len(node):
                    count = end - begin
                    step = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
                    forest.link(np.repeat(self.leaf[level][x[near]], count), np.repeat(begin, count) + step)
            waiting.append((level, x[~near], y[~near]))


def stars(bucket: np.ndarray, prints: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Of each bucket's components of links, the places of each member but one, and that of the one."""
    order = np.lexsort((*(gray_rank(prints[:, i]) for i in reversed(range(prints.shape[1]))), bucket))
    again = bucket[order][1:] == bucket[order][:-1]
    order = order[np.append(again, False) | np.append(False, again)] if len(order) > 1 else order[:0]
    forest = Forest(len(order))
    if len(order):
        Index(bucket[order], prints[order]).links(distance, forest)
    member = np.flatnonzero(forest.least != np.arange(len(order)))
    return order[member], order[forest.least[member]]


def _range(value: Column, shift: int, width: int) -> Column:
    return F.shiftrightunsigned(value, shift).bitwiseAND(F.lit((1 << width) - 1))


def _bit(i: int) -> Column:
    return _range(F.col("print")[i // 64], i % 64, 1)


def _split(hot: DataFrame, words: int, distance: int, split: int) -> DataFrame:
    """Rows of large buckets, each in the pairs of parts that it can have links in."""
    spark = hot.sparkSession
    ones = [F.sum(_bit(i)).alias(f"bit{i}") for i in range(64 * words)]
    counted = hot.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"), *ones)
    uneven = F.array(*[F.struct(F.abs(2 * F.col(f"bit{i}") - F.col("n")).alias("by"), F.lit(i).alias("bit")) for i in range(64 * words)])
    most = F.least(F.lit(SPLIT_BITS), F.ceil(F.log2(F.col("n") / split)) + 1).cast("int")
    bits = F.transform(F.slice(F.array_sort(uneven), 1, most), lambda x: x["bit"])
    parts = counted.select("bucket", bits.alias("bits"), most.alias("most"))
    masks = [[sum(1 << i for i in chosen) for n in range(min(p, distance) + 1) for chosen in combinations(range(p), n)] for p in range(1, SPLIT_BITS + 1)]
    flips = spark.createDataFrame(list(enumerate(masks, 1)), "most int, flips array<long>")
    joined = hot.join(parts.join(F.broadcast(flips), "most"), "bucket")  # flips has SPLIT_BITS rows
    bit = lambda i: F.call_function("shiftrightunsigned", F.element_at("print", F.floor(i / 64).cast("int") + 1), i % 64)
    pattern = F.aggregate("bits", F.lit(0).cast("long"), lambda sum_, i: F.shiftleft(sum_, 1).bitwiseOR(bit(i).bitwiseAND(F.lit(1))))
    placed = joined.select("node", "print", "bucket", pattern.alias("part"), F.explode("flips").alias("flip"))
    other = F.col("part").bitwiseXOR(F.col("flip"))
    pair = F.xxhash64("bucket", F.least("part", other), F.greatest("part", other))
    return placed.select("node", "print", pair.alias("bucket"))


def links(prints: DataFrame, words: int, distance: int, ranges: int, split: int = SPLIT) -> DataFrame:
    """Links (a, b) of nodes that connect the fingerprints differing in at most ``distance`` bits.

    ``prints``: node (long, one for each fingerprint) and print (array of ``words`` longs). With more
    ranges than ``distance`` no link is missed.
    """
    ends = [64 * words * i // ranges for i in range(ranges + 1)]
    # A range that ends in the next word is cut there. Buckets that meet by a collision of the hash
    # only cost time: every link is tested on all bits.
    buckets = []
    for i, (a, b) in enumerate(zip(ends, ends[1:])):
        cuts = [a, *(c for c in range(64, 64 * words, 64) if a < c < b), b]
        buckets.append(F.xxhash64(F.lit(i), *(_range(F.col("print")[x // 64], x % 64, y - x) for x, y in zip(cuts, cuts[1:]))))
    keyed = prints.select("node", "print", F.explode(F.array(*buckets)).alias("bucket"))
    sizes = keyed.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"))
    large = stage(sizes.where(F.col("n") > split).select("bucket"), "large-buckets")
    if count := large.count():
        large = parameters(large, count)
        hot = _split(keyed.join(large, "bucket", "left_semi").select("node", "print", "bucket"), words, distance, split)
        keyed = keyed.join(large, "bucket", "left_anti").select("node", "print", "bucket").unionByName(hot)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [(b.column("bucket").to_numpy(), b.column("node").to_numpy(), b.column("print").flatten().to_numpy()) for b in batches]
        if held:
            bucket, node, values = (np.concatenate(x) for x in zip(*held))
            members, roots = stars(bucket, values.view(np.uint64).reshape(-1, words), distance)
            for start in range(0, len(members), 50_000):
                yield pa.RecordBatch.from_arrays([pa.array(node[x[start : start + 50_000]]) for x in (members, roots)], names=["a", "b"])

    return keyed.repartition(tasks(prints.sparkSession), "bucket").mapInArrow(run, "a long, b long")
