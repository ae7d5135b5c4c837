"""A random forest whose passes over the data do not grow with its nodes, kept as a table of nodes.

1. Rows are stored once as small codes: numbers as bins between quantiles, texts as levels. A level is a slot of its own, as
   in the one-hot vector: a row has it or not.
2. Nodes with many rows are split level by level. Each task adds up class counts per bin for its rows, Spark sums them by
   node, and the best split of each goes back to the driver: a few numbers for each node with more than ``large_rows`` rows.
3. The rows of all smaller nodes are dealt out by node in one shuffle, packed, and each node's subtree is grown where its
   rows are. Such a group is bounded by ``large_rows``; its depth costs no further pass.

How often a tree takes a row comes from a hash of tree and row, Poisson with mean 1; the slots that a node looks at come from a hash of tree
and node. So a task that runs again gives the same. A node that finds all of its slots constant looks at the next ones.

The model is a table ``(tree, node, slot, cut, weight_0, weight_1, gain)``: the root is 1, the children of ``n`` are ``2n`` and
``2n + 1``, a leaf has slot -1; a row goes to ``2n + 1`` if its code in the slot is greater than ``cut``. No plan
ever holds a tree: scoring sends arrays of nodes to the tasks, a bounded number of trees at a time.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator
from dataclasses import asdict, dataclass
from functools import cached_property
from math import exp, factorial, isqrt

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lateline.ml.prepare import feature_names, level_lists
from lateline.operators.ranks import exact_quantiles
from lateline.schema import TARGET
from lateline.sources.staging import discard, noted, stage

NODES = "tree int, node int, slot int, cut int, weight_0 double, weight_1 double, gain double"
BLOCK_ROWS = 20_000
#: Rows of blocks that a task opens together: the same few steps for each node serve more rows.
OPEN_ROWS = 200_000
#: Counts, and rows, that are made at a time when the levels of all texts are counted.
COUNTED_CELLS = 400_000
COUNTED_ROWS = 4_096
#: Bytes of node arrays that are sent to the tasks at a time.
SEND_BYTES = 256_000_000
#: More than any code.
NEVER = 2**31


@dataclass(frozen=True)
class ForestSettings:
    """``slots`` is how many slots a node looks at: by default the root of their number. Nodes of ``large_rows``
    rows, counted as often as a tree takes them, are the largest that one task grows."""

    trees: int = 120
    depth: int = 18
    slots: int | None = None
    bins: int = 128
    bootstrap: bool = True
    seed: int = 42
    large_rows: int = 1_000_000
    quantile_error: float = 0.001  # 0 looks for the exact ones, in more passes


@dataclass(frozen=True)
class Layout:
    """The codes of a row: first the numbers, by their edges, then the texts, by their number of levels."""

    edges: list[list[float]]
    levels: list[int]

    @cached_property
    def kind(self) -> type:
        most = max([len(e) for e in self.edges] + self.levels + [1])
        return np.uint8 if most < 2**8 else np.uint16 if most < 2**16 else np.uint32

    @cached_property
    def features(self) -> int:
        return len(self.edges) + len(self.levels)

    @cached_property
    def feature(self) -> np.ndarray:
        """The feature of each slot."""
        counts = [1] * len(self.edges) + self.levels
        return np.repeat(np.arange(self.features), counts).astype(np.int32)

    @cached_property
    def level(self) -> np.ndarray:
        """The level that a slot stands for, -1 for numbers."""
        parts = [np.full(len(self.edges), -1), *[np.arange(n) for n in self.levels]]
        return np.concatenate(parts).astype(np.int32)

    @cached_property
    def width(self) -> np.ndarray:
        """How many codes a slot has."""
        return np.where(self.level < 0, 0, 2) + np.concatenate(
            [[len(e) + 1 for e in self.edges], np.zeros(sum(self.levels), int)]
        ).astype(np.int64)

    @cached_property
    def places(self) -> int:
        """How many codes all texts have together; each has one more than levels, for those unseen in training."""
        return sum(self.levels) + len(self.levels)

    @cached_property
    def packed_kind(self) -> type:
        most = 2 * max(self.places, *[len(e) + 1 for e in self.edges], 1)
        return np.uint16 if most < 2**16 else np.uint32

    @cached_property
    def offset(self) -> np.ndarray:
        """For each feature the codes of the texts before it; none for numbers."""
        before = np.cumsum([0] + [n + 1 for n in self.levels])[: len(self.levels)]
        return np.concatenate([np.zeros(len(self.edges), int), before]).astype(self.packed_kind)

    @cached_property
    def place(self) -> np.ndarray:
        """The code of each slot among those of all texts, 0 for numbers."""
        return np.where(self.level < 0, 0, self.offset[self.feature].astype(np.int64) + self.level)

    def encode(self, columns: list[np.ndarray]) -> np.ndarray:
        """Rows of codes, from the columns of numbers and of level numbers."""
        codes = np.empty((len(columns[0]), self.features), self.kind)
        for i, column in enumerate(columns):
            codes[:, i] = np.searchsorted(self.edges[i], column, side="left") if i < len(self.edges) else column
        return codes


# --- hashes ----------------------------------------------------------------------------------------


def _hashed(values: np.ndarray) -> np.ndarray:
    """A well mixed 64-bit hash of 64-bit numbers."""
    with np.errstate(over="ignore"):
        z = values.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15)
        z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return z ^ (z >> np.uint64(31))


_POISSON = np.cumsum([exp(-1) / factorial(k) for k in range(12)])
#: How often a row is taken by the first 16 bits of its hash; 255 where these leave it open.
_SURE = np.searchsorted(_POISSON, np.arange(2**16) / 2.0**16, side="right")
_SURE = np.where(_SURE == np.searchsorted(_POISSON, (np.arange(2**16) + 1) / 2.0**16, side="left"), _SURE, 255).astype(np.uint8)


def _times(rows: np.ndarray, tree: int, settings: ForestSettings) -> np.ndarray:
    """How often a tree takes each row."""
    if not settings.bootstrap:
        return np.ones(len(rows), np.uint8)
    salt = _hashed(np.array([settings.seed * 1_000_003 + tree]))[0]
    hashed = _hashed(rows ^ salt)
    result = _SURE[(hashed >> np.uint64(48)).astype(np.intp)]
    unsure = np.flatnonzero(result == 255)
    result[unsure] = np.searchsorted(_POISSON, (hashed[unsure] >> np.uint64(11)) / 2.0**53, side="right")
    return result


def _drawn(tree: int, nodes: np.ndarray, turn: int, layout: Layout, settings: ForestSettings) -> np.ndarray:
    """The slots that each node looks at in its first, second, … turn, ascending."""
    all_slots = len(layout.feature)
    number = settings.slots or max(isqrt(all_slots), 1)
    if number >= all_slots:
        return np.tile(np.arange(all_slots), (len(nodes), 1))
    salt = _hashed(np.array([settings.seed * 1_000_003 + tree + 2**40]))[0]
    keys = _hashed((_hashed(nodes.astype(np.uint64) ^ salt)[:, None] + np.arange(all_slots, dtype=np.uint64)[None, :]))
    if turn == 0:
        chosen = np.argpartition(keys, number, axis=1)[:, :number]
    else:
        chosen = np.argsort(keys, axis=1)[:, turn * number : (turn + 1) * number]
    return np.sort(chosen, axis=1)


def _turns(layout: Layout, settings: ForestSettings) -> int:
    number = settings.slots or max(isqrt(len(layout.feature)), 1)
    return -(-len(layout.feature) // number)


# --- splits ----------------------------------------------------------------------------------------


def _slot_code(codes: np.ndarray, starts: np.ndarray, node: np.ndarray, slot: np.ndarray, layout: Layout) -> np.ndarray:
    """The code of each row in the slot of its node."""
    value, level = codes[starts + layout.feature[slot][node]], layout.level[slot]
    if (level < 0).all():
        return value
    has = value == level[node]
    return np.where((level < 0)[node], value, has) if (level < 0).any() else has


def _rules(slot: np.ndarray, cut: np.ndarray, layout: Layout) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Each node's split as a feature, a code and a span: a row goes right if its code less this one, without sign, is in the span.

    Numbers above the cut, or rows that have the level, go right; of a leaf (slot -1) none does.
    """
    level, leaf = layout.level[slot], slot < 0
    number = level < 0
    first = np.where(leaf, NEVER, np.where(number, cut + 1, level)).astype(np.uint32)
    span = np.where(number & ~leaf, NEVER, 0).astype(np.uint32)
    return np.where(leaf, 0, layout.feature[slot]).astype(np.int32), first, span


def _over(codes: np.ndarray, starts: np.ndarray, node: np.ndarray, rules: tuple[np.ndarray, np.ndarray, np.ndarray]) -> np.ndarray:
    """Whether each row goes right in its node."""
    feature, first, span = rules
    return codes[starts + feature[node]] - first[node] <= span[node]


def _walk(codes: np.ndarray, starts: np.ndarray, rules: tuple[np.ndarray, np.ndarray, np.ndarray], left: np.ndarray) -> np.ndarray:
    """The leaf of each row; the right child follows the left one, and a leaf leads to itself."""
    at = np.zeros(len(starts), np.intp)
    while True:
        following = np.add(left[at], _over(codes, starts, at, rules), dtype=np.intp)
        if np.array_equal(following, at):
            return at
        at = following


def _spans(begin: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The numbers of several runs, one after the other."""
    return np.repeat(begin - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum())


def _counts(codes, starts, node, label, times, slot_of_node, layout) -> tuple[np.ndarray, np.ndarray]:
    """Class counts per node and code in the node's slot, one after the other, and where each node begins."""
    width = layout.width[slot_of_node]
    begin = np.concatenate([[0], np.cumsum(width)])
    place = begin[node] + _slot_code(codes, starts, node, slot_of_node, layout)
    counts = np.bincount(2 * place + label, weights=times, minlength=2 * begin[-1])
    return counts.reshape(-1, 2), begin


def _scores(left: np.ndarray, right: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """The purity of both sides of each split, -1 if one is empty."""
    valid = (left[:, 0] + left[:, 1] > 0) & (right[:, 0] + right[:, 1] > 0)
    a, b = left * weight, right * weight
    with np.errstate(invalid="ignore", divide="ignore"):
        score = (a[:, 0] * a[:, 0] + a[:, 1] * a[:, 1]) / (a[:, 0] + a[:, 1])
        score = score + (b[:, 0] * b[:, 0] + b[:, 1] * b[:, 1]) / (b[:, 0] + b[:, 1])
    return np.where(valid, score, -1.0)


def _best(counts: np.ndarray, begin: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each node the best score (-1: no split), its cut, and the counts that go left.

    The score is the purity of both sides: the sum over sides of the squared weights of the classes over their sum.
    """
    first = begin[:-1]
    running = np.cumsum(counts, axis=0)
    before = np.where(first[:, None] > 0, running[first - 1], 0)
    sizes = np.diff(begin)
    left = running - np.repeat(before, sizes, axis=0)
    right = np.repeat(left[begin[1:] - 1], sizes, axis=0) - left
    score = _scores(left, right, weight)
    most = np.maximum.reduceat(score, first)
    hits = np.flatnonzero(score == np.repeat(most, sizes))
    at = hits[np.searchsorted(hits, first)]  # the first of equal ones
    return most, at - first, left[at]


def _best_of_slots(codes, starts, of, sizes, label, times, whole, slot, layout, weight) -> tuple[np.ndarray, np.ndarray]:
    """The best score and cut of each node in one slot of its own; rows of a node lie together, and ``whole`` are its counts.

    Few rows have a level: only these are counted, and the others are what is left of the node.
    """
    level = layout.level[slot]
    has_level = codes[starts + np.repeat(layout.feature[slot], sizes)] == np.repeat(level.astype(codes.dtype), sizes)
    hits = np.flatnonzero(has_level)
    has = np.bincount(2 * of[hits] + label[hits], weights=times[hits], minlength=2 * len(slot)).reshape(-1, 2)
    most, cut = _scores(whole - has, has, weight), np.zeros(len(slot), np.int64)
    number = np.flatnonzero(level < 0)
    if len(number):
        here = _spans((np.cumsum(sizes) - sizes)[number], sizes[number])
        own = np.repeat(np.arange(len(number)), sizes[number])
        most[number], cut[number], _ = _best(*_counts(codes, starts[here], own, label[here], times[here], slot[number], layout), weight)
    return most, cut


def _slot_counts(code_of: Callable, label: np.ndarray, times: np.ndarray, drawn: np.ndarray, layout: Layout) -> tuple[np.ndarray, np.ndarray]:
    """Class counts of one node's rows per code of the drawn slots, one after the other, and where each slot begins.

    Each feature is counted once: its levels are slots, and the rows without a level are all others.
    """
    whole, begin = np.bincount(label, weights=times, minlength=2), np.concatenate([[0], np.cumsum(layout.width[drawn])])
    result, of, level = np.empty((begin[-1], 2)), layout.feature[drawn], layout.level[drawn]
    for feature in sorted(set(of.tolist())):
        number = feature < len(layout.edges)
        codes = len(layout.edges[feature]) + 1 if number else layout.levels[feature - len(layout.edges)] + 1
        place = code_of(feature).astype(np.int64)
        place += place
        place += label
        counted = np.bincount(place, weights=times, minlength=2 * codes).reshape(-1, 2)
        at = np.flatnonzero(of == feature)
        if number:
            result[begin[at[0]] : begin[at[0] + 1]] = counted
        else:
            has = counted[level[at]]
            result[begin[at]], result[begin[at] + 1] = whole - has, has
    return result, begin


def _purity(counts: np.ndarray, weight: np.ndarray) -> np.ndarray:
    w = counts * weight
    return (w[:, 0] * w[:, 0] + w[:, 1] * w[:, 1]) / (w[:, 0] + w[:, 1])


def _node_rows(tree: int, nodes, slot, cut, counts, gain, weight) -> dict[str, np.ndarray]:
    return {
        "tree": np.full(len(nodes), tree),
        "node": nodes,
        "slot": slot,
        "cut": cut,
        "weight_0": counts[:, 0] * weight[0],
        "weight_1": counts[:, 1] * weight[1],
        "gain": gain,
    }


def _best_by_feature(packed, times, begin, sizes, whole, drawn, layout, weight) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The best score (-1: none), slot and cut of each node in its drawn slots, its rows from ``begin`` on; ``whole`` are its counts.

    The levels of all texts are counted at once, for many nodes together: the rows are read once and not for each slot.
    """
    texts, cells, nodes = len(layout.edges), 2 * layout.places, len(sizes)
    number = layout.level[drawn] < 0
    score, cut = np.full(drawn.shape, -1.0), np.zeros(drawn.shape, np.int64)
    part = np.cumsum(sizes * max(len(layout.levels), 1) + cells) // COUNTED_CELLS
    for some in np.split(np.arange(nodes), np.flatnonzero(np.diff(part)) + 1):
        first, rows = some[0], slice(begin[some[0]], begin[some[-1]] + sizes[some[-1]])
        if rows.stop - rows.start > sizes[some].sum():
            rows = _spans(begin[some], sizes[some])
        of_texts, taken = packed[rows, texts:], times[rows]
        if of_texts.shape[1]:
            starts, counted = np.repeat(np.arange(len(some)) * cells, sizes[some]), np.zeros(len(some) * cells)
            for at in range(0, len(taken), COUNTED_ROWS):
                here = slice(at, at + COUNTED_ROWS)
                place = starts[here, None] + of_texts[here]
                counted += np.bincount(place.reshape(-1), np.repeat(taken[here], place.shape[1]), len(counted))
            at = np.arange(len(some))[:, None] * layout.places + layout.place[drawn[some]]
            has = counted.reshape(-1, 2).take(at.reshape(-1), axis=0)
            rest = np.repeat(whole[some], drawn.shape[1], axis=0) - has
            score[some] = _scores(rest, has, weight).reshape(len(some), -1)
        node, turn = np.nonzero(number[some])
        if len(node):
            node, slot = node + first, drawn[some][node, turn]
            width = np.concatenate([[0], np.cumsum(layout.width[slot])])
            row = _spans(begin[node], sizes[node])
            place = packed.reshape(-1)[row * layout.features + np.repeat(layout.feature[slot], sizes[node])]
            place = place + np.repeat(2 * width[:-1], sizes[node])
            counts = np.bincount(place, weights=times[row], minlength=2 * width[-1]).reshape(-1, 2)
            score[node, turn], cut[node, turn], _ = _best(counts, width, weight)
    best, all_nodes = np.argmax(score, axis=1), np.arange(nodes)  # the first of equal ones
    most = score[all_nodes, best]
    return most, np.where(most >= 0, drawn[all_nodes, best], -1), cut[all_nodes, best]


def _grow(codes, label, times, tree: int, root: int, layout: Layout, settings: ForestSettings, weight, wide_rows: int | None = None) -> pa.Table:
    """All nodes of the subtree of some rows. Nodes of ``wide_rows`` rows are counted by feature, smaller ones slot by slot."""
    wide_rows = layout.places // 8 if wide_rows is None else wide_rows
    # A code, twice, its text's place among all texts, and the label as the last bit: one number to count by.
    packed = ((codes.astype(layout.packed_kind) + layout.offset) << 1) + label[:, None].astype(layout.packed_kind)
    sizes, nodes = np.array([len(codes)]), np.array([root], np.int64)
    depth, found, times = root.bit_length() - 1, [], times.astype(np.float64)
    while len(nodes):
        # Rows of a node lie together, with all their codes: so they are read in turn.
        begin = np.cumsum(sizes) - sizes
        ones = np.add.reduceat(times * (packed[:, 0] & 1), begin)
        counts = np.stack([np.add.reduceat(times, begin) - ones, ones], axis=1)
        slot, cut = np.full(len(nodes), -1), np.zeros(len(nodes), np.int64)
        score = np.full(len(nodes), -1.0)
        undecided = np.flatnonzero((counts > 0).all(axis=1)) if depth < settings.depth else np.empty(0, np.int64)
        wide = undecided[sizes[undecided] >= wide_rows]
        narrow = undecided[sizes[undecided] < wide_rows]
        for turn in range(_turns(layout, settings)):
            if len(wide):
                drawn = _drawn(tree, nodes[wide], turn, layout, settings)
                score[wide], slot[wide], cut[wide] = _best_by_feature(packed, times, begin[wide], sizes[wide], counts[wide], drawn, layout, weight)
                wide = wide[slot[wide] < 0]
            if len(narrow):
                drawn = _drawn(tree, nodes[narrow], turn, layout, settings)
                row = _spans(begin[narrow], sizes[narrow])
                flat, start = (packed[row] >> 1) - layout.offset, np.arange(len(row)) * layout.features
                of, y, w = np.repeat(np.arange(len(narrow)), sizes[narrow]), (packed[row, 0] & 1).astype(np.int64), times[row]
                for chosen in drawn.T:
                    most, best_cut = _best_of_slots(flat.reshape(-1), start, of, sizes[narrow], y, w, counts[narrow], chosen, layout, weight)
                    better = most > score[narrow]
                    score[narrow[better]], slot[narrow[better]] = most[better], chosen[better]
                    cut[narrow[better]] = best_cut[better]
                narrow = narrow[slot[narrow] < 0]
        split = slot >= 0
        gain = np.where(split, score - _purity(counts, weight), 0.0)
        found.append(_node_rows(tree, nodes, slot, cut, counts, gain, weight))
        nodes = np.stack([2 * nodes[split], 2 * nodes[split] + 1], axis=1).reshape(-1)
        depth += 1
        if len(nodes):
            packed, times, sizes = _parted(packed, times, sizes, slot, cut, layout)
    return _as_table({name: np.concatenate([part[name] for part in found]) for name in found[0]})


def _parted(packed, times, sizes, slot, cut, layout: Layout) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The rows of the children of the nodes that split, left and right one in turn, and the sizes of these."""
    split = slot >= 0
    stays, slot, cut, sizes = np.flatnonzero(np.repeat(split, sizes)), slot[split], cut[split], sizes[split]
    number, feature = layout.level[slot] < 0, layout.feature[slot]
    first = 2 * np.where(number, cut + 1, layout.place[slot]).astype(np.uint32)
    span = np.where(number, NEVER, 1).astype(np.uint32)
    value = packed.reshape(-1)[stays * layout.features + np.repeat(feature, sizes)]
    right = value - np.repeat(first, sizes) <= np.repeat(span, sizes)
    to_right = np.add.reduceat(right, np.cumsum(sizes) - sizes, dtype=np.int64)
    children = np.stack([sizes - to_right, to_right], axis=1).reshape(-1)
    begin, order = np.cumsum(children) - children, np.empty(len(stays), np.int64)
    order[_spans(begin[::2], children[::2])] = stays[~right]
    order[_spans(begin[1::2], children[1::2])] = stays[right]
    return packed.take(order, axis=0), times[order], children


def _as_table(columns: dict[str, np.ndarray]) -> pa.Table:
    kinds = {"tree": pa.int32(), "node": pa.int32(), "slot": pa.int32(), "cut": pa.int32()}
    return pa.table({name: pa.array(values).cast(kinds.get(name, pa.float64())) for name, values in columns.items()})


# --- rows ------------------------------------------------------------------------------------------


def _inputs(preparation: PipelineModel) -> tuple[list[str], list[str]]:
    numbers = [name for name in preparation.stages[3].getInputCols() if name.startswith("num__")]
    return numbers, list(preparation.stages[1].getOutputCols())


def coded(preparation: PipelineModel, rows: DataFrame) -> DataFrame:
    """The rows with their standardised numbers and level numbers, which the codes are made of."""
    return PipelineModel(preparation.stages[:2]).transform(rows)


def find_layout(preparation: PipelineModel, rows: DataFrame, settings: ForestSettings) -> Layout:
    """Edges at quantiles of the training rows; the greatest value is none."""
    numbers, _ = _inputs(preparation)
    shares = [k / settings.bins for k in range(1, settings.bins)]
    if settings.quantile_error:
        found = rows.approxQuantile(numbers, shares, settings.quantile_error)
    else:
        found = [exact_quantiles(rows, name, shares) for name in numbers]
    top = rows.agg(*[F.max(name).alias(name) for name in numbers]).first()
    edges = [sorted({v for v in values if v < top[name]}) for name, values in zip(numbers, found)]
    return Layout(edges, [len(levels) for levels in level_lists(preparation).values()])


def _blocks(rows: DataFrame, columns: list[str], layout: Layout) -> DataFrame:
    """``(block, codes, labels)``: packed rows. A block has a number that its rows are hashed with."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = TaskContext.get().partitionId() << 24
        for batch in batches:
            for start in range(0, batch.num_rows, BLOCK_ROWS):
                part = batch.slice(start, BLOCK_ROWS)
                codes = layout.encode([part[name].to_numpy(zero_copy_only=False) for name in columns])
                labels = part[TARGET].to_numpy(zero_copy_only=False).astype(np.uint8)
                yield pa.RecordBatch.from_pylist([{"block": block, "codes": codes.tobytes(), "labels": labels.tobytes()}])
                block += 1

    return rows.select(*columns, TARGET).mapInArrow(pack, "block long, codes binary, labels binary")


def _opened(batch: pa.RecordBatch, layout: Layout) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Row numbers, codes and labels of each block."""
    for one in batch.to_pylist():
        labels = np.frombuffer(one["labels"], np.uint8).astype(np.int64)
        codes = np.frombuffer(one["codes"], layout.kind).reshape(len(labels), layout.features)
        yield (np.uint64(one["block"]) << np.uint64(24)) + np.arange(len(labels), dtype=np.uint64), codes, labels


def _together(batches: Iterator[pa.RecordBatch], layout: Layout) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """The same of several blocks, up to about ``OPEN_ROWS`` rows."""
    held, size = [], 0
    for batch in batches:
        for block in _opened(batch, layout):
            held.append(block)
            size += len(block[0])
            if size >= OPEN_ROWS:
                yield tuple(np.concatenate(x) for x in zip(*held))
                held, size = [], 0
    if held:
        yield tuple(np.concatenate(x) for x in zip(*held))


def _dealt(rows: np.ndarray, columns: np.ndarray, tree: int, top: _Top, wanted: list[int], layout: Layout, settings: ForestSettings):
    """Of each wanted node that a tree has rows in, the node, the places of its rows, and how often each is taken."""
    times = _times(rows, tree, settings)
    wanted, above = set(wanted), {node >> up for node in wanted for up in range(node.bit_length())}
    held = [(1, np.flatnonzero(times))]
    while held:  # only rows on the way to a wanted node are followed
        node, here = held.pop()
        if node in wanted and len(here):
            yield node, here, times[here]
        elif node not in wanted:
            slot, cut = top.splits[node]
            value, level = columns[layout.feature[slot]][here], layout.level[slot]
            right = value > cut if level < 0 else value == level
            held += [(child, here[side]) for child, side in ((2 * node, ~right), (2 * node + 1, right)) if child in above]


class _Top:
    """The splits of one tree that the driver knows, for finding the node of a row among them."""

    def __init__(self) -> None:
        self.splits: dict[int, tuple[int, int]] = {}

    def place(self, codes: np.ndarray, layout: Layout, rows: np.ndarray) -> np.ndarray:
        """The node of each of some rows."""
        if not self.splits:
            return np.ones(len(rows), np.int64)
        inner = np.array(sorted(self.splits))
        names = np.unique(np.concatenate([[1], 2 * inner, 2 * inner + 1]))
        slot, cut = np.array([self.splits.get(name, (-1, 0)) for name in names.tolist()]).T
        left = np.where(slot < 0, np.arange(len(names)), np.searchsorted(names, 2 * names))
        return names[_walk(codes.reshape(-1), rows * layout.features, _rules(slot, cut, layout), left)]


def _sums(tops, open_nodes, layout, settings) -> Callable:
    """``(tree, node, counts)``: a task's class counts for each open node, of all its slots one after the other."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[int, int], np.ndarray] = {}
        for rows, codes, labels in _together(batches, layout):
            columns = np.ascontiguousarray(codes.T)
            for tree, wanted in open_nodes.items():
                for node, here, times in _dealt(rows, columns, tree, tops[tree], list(wanted), layout, settings):
                    drawn = _drawn(tree, np.array([node]), wanted[node], layout, settings)[0]
                    counts, _ = _slot_counts(lambda f: columns[f][here], labels[here], times.astype(np.float64), drawn, layout)  # noqa: B023
                    held[tree, node] = held[tree, node] + counts if (tree, node) in held else counts
        for (tree, node), counts in held.items():
            yield pa.RecordBatch.from_pylist([{"tree": tree, "node": node, "counts": counts.tobytes()}])

    return run


def _choose(open_nodes, layout, settings, weight) -> Callable[[pa.Table], pa.Table]:
    """The best split of one open node from the counts of all tasks."""

    def run(parts: pa.Table) -> pa.Table:
        tree, node = parts["tree"][0].as_py(), parts["node"][0].as_py()
        counts = np.sum([np.frombuffer(x, np.float64) for x in parts["counts"].to_pylist()], axis=0).reshape(-1, 2)
        drawn = _drawn(tree, np.array([node]), open_nodes[tree][node], layout, settings)[0]
        ends = np.concatenate([[0], np.cumsum(layout.width[drawn])])
        whole = counts[: ends[1]].sum(axis=0)
        best = (-1.0, -1, 0, np.zeros(2))
        for i, slot in enumerate(drawn):
            part = counts[ends[i] : ends[i + 1]]
            most, cut, left = _best(part, np.array([0, len(part)]), weight)
            if most[0] > best[0]:
                best = (most[0], slot, cut[0], left[0])
        score, slot, cut, left = best
        row = {"tree": tree, "node": node, "slot": int(slot), "cut": int(cut), "score": float(score)}
        sides = {"left_0": left[0], "left_1": left[1], "all_0": whole[0], "all_1": whole[1]}
        return pa.Table.from_pylist([row | {name: float(value) for name, value in sides.items()}])

    return run


CHOICE = "tree long, node long, slot long, cut long, score double, left_0 double, left_1 double, all_0 double, all_1 double"


def _split_large(blocks, rows, layout, settings, weight):
    """Split the large nodes. Gives the splits of each tree, the nodes left to single tasks, and the rows of finished nodes."""
    tops = {tree: _Top() for tree in range(settings.trees)}
    left_over: dict[int, list[int]] = {tree: [] for tree in tops}
    done: list[tuple] = []
    open_nodes = {tree: {1: 0} for tree in tops} if rows > settings.large_rows else {}
    if not open_nodes:
        left_over = {tree: [1] for tree in tops}
    while open_nodes:
        sums = blocks.mapInArrow(_sums(tops, open_nodes, layout, settings), "tree long, node long, counts binary")
        chosen = sums.groupBy("tree", "node").applyInArrow(_choose(open_nodes, layout, settings, weight), CHOICE)
        following: dict[int, dict[int, int]] = {}
        for r in chosen.collect():  # a row for each node with more than large_rows rows
            whole, left = np.array([r["all_0"], r["all_1"]]), np.array([r["left_0"], r["left_1"]])
            turn = open_nodes[r["tree"]][r["node"]] + 1
            if r["slot"] < 0 and turn < _turns(layout, settings) and (whole > 0).all():
                following.setdefault(r["tree"], {})[r["node"]] = turn
                continue
            split = r["slot"] >= 0 and (whole > 0).all()
            gain = float(r["score"] - _purity(whole[None, :], weight)[0]) if split else 0.0
            weights = [float(x) for x in whole * weight]
            done.append((r["tree"], r["node"], r["slot"] if split else -1, r["cut"] if split else 0, *weights, gain))
            if not split:
                continue
            tops[r["tree"]].splits[r["node"]] = (r["slot"], r["cut"])
            for child, counts in ((2 * r["node"], left), (2 * r["node"] + 1, whole - left)):
                if counts.sum() > settings.large_rows and (counts > 0).all() and child.bit_length() - 1 < settings.depth:
                    following.setdefault(r["tree"], {})[child] = 0
                elif counts.sum() > settings.large_rows:  # a leaf, however large
                    done.append((r["tree"], child, -1, 0, *[float(x) for x in counts * weight], 0.0))
                else:
                    left_over[r["tree"]].append(child)
        open_nodes = following
    return tops, left_over, done


def _deal(tops, left_over, layout, settings) -> Callable:
    """``(tree, root, codes, labels, times)``: the rows of each small node, packed by what is opened together."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, codes, labels in _together(batches, layout):
            small, columns = labels.astype(np.uint8), np.ascontiguousarray(codes.T)
            for tree, roots in left_over.items():
                for root, here, times in _dealt(rows, columns, tree, tops[tree], roots, layout, settings) if roots else ():
                    packed = {"codes": codes.take(here, axis=0).tobytes(), "labels": small[here].tobytes(), "times": times.tobytes()}
                    yield pa.RecordBatch.from_pylist([{"tree": tree, "root": root, **packed}])

    return run


def _grown(layout, settings, weight) -> Callable[[pa.Table], pa.Table]:
    def run(parts: pa.Table) -> pa.Table:
        join = lambda name, kind: np.frombuffer(b"".join(parts[name].to_pylist()), kind)
        labels, times = join("labels", np.uint8).astype(np.int64), join("times", np.uint8).astype(np.int64)
        codes = join("codes", layout.kind).reshape(len(labels), layout.features)
        tree, root = parts["tree"][0].as_py(), parts["root"][0].as_py()
        return _grow(codes, labels, times, tree, root, layout, settings, weight)

    return run


# --- model -----------------------------------------------------------------------------------------


@dataclass(frozen=True)
class ForestModel:
    preparation: PipelineModel
    layout: Layout
    trees: int
    nodes: DataFrame

    def save(self, path: str) -> None:
        self.preparation.write().overwrite().save(f"{path}/preparation")
        self.nodes.write.mode("overwrite").parquet(f"{path}/nodes")
        described = json.dumps({"trees": self.trees, **asdict(self.layout)})
        self.nodes.sparkSession.createDataFrame([(described,)], "layout string").write.mode("overwrite").text(f"{path}/layout")

    @staticmethod
    def load(spark: SparkSession, path: str) -> ForestModel:
        described = json.loads(spark.read.text(f"{path}/layout").first()[0])
        layout = Layout(described["edges"], described["levels"])
        nodes = spark.read.schema(NODES).parquet(f"{path}/nodes")
        return ForestModel(PipelineModel.load(f"{path}/preparation"), layout, described["trees"], nodes)

    @cached_property
    def slot_names(self) -> list[str]:
        return feature_names(self.preparation)


def fit_forest(
    train: DataFrame, preparation: PipelineModel, weights: dict[int, float], settings: ForestSettings = ForestSettings()
) -> ForestModel:
    """Fit to rows of features and label; ``weights`` are those of the classes 0 and 1."""
    spark = train.sparkSession
    weight = np.array([weights.get(0, 1.0), weights.get(1, 1.0)])
    numbers, texts = _inputs(preparation)
    with noted() as staged:
        rows = stage(coded(preparation, train).select(*numbers, *texts, TARGET), "forest-rows")
        layout = find_layout(preparation, rows, settings)
        parallel = max(3 * spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
        blocks = stage(_blocks(rows, [*numbers, *texts], layout).repartition(parallel), "forest-blocks")
    tops, left_over, done = _split_large(blocks, rows.count(), layout, settings, weight)
    dealt = blocks.mapInArrow(
        _deal(tops, left_over, layout, settings), "tree long, root long, codes binary, labels binary, times binary"
    )
    # Few bytes, much work: the number of tasks follows the nodes, not the bytes.
    groups = max(parallel, min(sum(len(roots) for roots in left_over.values()), 10_000))
    grown = dealt.repartition(groups, "tree", "root").groupBy("tree", "root").applyInArrow(_grown(layout, settings, weight), NODES)
    nodes = grown.unionByName(spark.createDataFrame(done, NODES))
    nodes = stage(nodes, "forest-nodes")
    discard(spark, staged)
    return ForestModel(preparation, layout, settings.trees, nodes)


def _node_arrays(nodes: DataFrame, layout: Layout) -> list[tuple[np.ndarray, ...]]:
    """Rules, left child and share of class 1 of each tree's nodes; the right child follows the left, a leaf leads to itself."""
    table = nodes.select("tree", "node", "slot", "cut", "weight_0", "weight_1").toArrow().to_pandas()
    table, result = table.sort_values(["tree", "node"]), []
    for _, tree in table.groupby("tree", sort=True):
        node, slot = tree["node"].to_numpy().astype(np.int64), tree["slot"].to_numpy()
        left = np.where(slot < 0, np.arange(len(node)), np.searchsorted(node, 2 * node)).astype(np.int32)
        share = (tree["weight_1"] / (tree["weight_0"] + tree["weight_1"])).to_numpy()
        result.append((_rules(slot, tree["cut"].to_numpy(), layout), left, share))
    return result


def _votes(sent, layout: Layout) -> Callable[..., Column]:
    """The sum of the shares of class 1 over the trees of a broadcast, for columns of numbers and levels."""

    @F.pandas_udf("double")
    def votes(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
        trees = sent.value
        for columns in batches:
            codes = layout.encode([column.to_numpy() for column in columns]).reshape(-1)
            start = np.arange(len(columns[0]), dtype=np.int64) * layout.features
            total = np.zeros(len(start))
            for rules, left, share in trees:
                total += share[_walk(codes, start, rules, left)]
            yield pd.Series(total)

    return votes


def probabilities(model: ForestModel, orders: DataFrame, column: str) -> DataFrame:
    """The orders with the mean share of class 1 over all trees.

    The node arrays go to the tasks in one piece up to ``SEND_BYTES``. A larger forest goes tree by tree in several pieces, and the
    sums so far are stored between them.
    """
    spark, names = orders.sparkSession, orders.columns
    numbers, texts = _inputs(model.preparation)
    per_tree = {r["tree"]: r["n"] * 28 for r in model.nodes.groupBy("tree").agg(F.count(F.lit(1)).alias("n")).collect()}
    pieces, size = [[]], 0
    for tree, taken in sorted(per_tree.items()):
        if size + taken > SEND_BYTES and pieces[-1]:
            pieces, size = [*pieces, []], 0
        pieces[-1].append(tree)
        size += taken
    inputs = [*numbers, *texts]
    result = coded(model.preparation, orders).select(*names, *inputs, F.lit(0.0).alias(column))
    for i, piece in enumerate(pieces):
        arrays = _node_arrays(model.nodes.where(F.col("tree").between(piece[0], piece[-1])), model.layout) if piece else []
        votes = _votes(spark.sparkContext.broadcast(arrays), model.layout)
        result = result.withColumn(column, F.col(column) + votes(*inputs))
        if i + 1 < len(pieces):
            result = stage(result, "forest-votes")
    grown = max(len(per_tree), 1)  # a tree that took no row at all has no nodes
    return result.select(*names, (F.col(column) / grown).alias(column))


def importances(model: ForestModel) -> DataFrame:
    """``(slot, importance)``: each tree's decreases of impurity as shares of their sum, averaged over the trees that split."""
    splits = model.nodes.where("slot >= 0").groupBy("tree", "slot").agg(F.sum("gain").alias("gain"))
    totals = splits.groupBy("tree").agg(F.sum("gain").alias("all_gain")).where("all_gain > 0")
    trees = totals.agg(F.count(F.lit(1)).alias("trees"))
    of_trees = splits.join(totals, "tree").join(F.broadcast(trees))  # one row
    return of_trees.groupBy("slot").agg((F.sum(F.col("gain") / F.col("all_gain")) / F.max("trees")).alias("importance"))
