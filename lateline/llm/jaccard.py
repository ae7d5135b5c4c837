"""Rows whose texts are near copies: sets of five-word shingles with a Jaccard similarity of 0.8 or more.

SimHash fingerprints and their Gray-order index (``simhash``, ``hamming``) link most copies first, each link
confirmed by the similarity itself. Fingerprints of similar texts may differ in more bits, so the rest is found exactly:
prefix filtering finds every such pair. Shingles have one order, and a set of n needs only the first
n - ceil(0.8 n) + 1 of its own: two sets that are similar enough share one of these, and at the first that
they share enough shingles of both must be left. Any order gives the same pairs; this one puts shingles
that a sample has often last, so that few rows meet. Each pair that meets is then decided by comparing
all shingles of both texts.

Rows that a shingle brings together are first compared with the next one in size only, and linked. Where many components
still meet, each row is compared with one of another, in turns that each begin with fewer components. Then
rows of different components are paired, so a large group of copies costs few pairs. Rows at the edge of such a group share
its shingles with all of it: of their pairs only those are made whose sketches, which bound the shingles that two rows
differ in from below, leave the similarity possible. No similar pair is lost by this.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lateline.llm import simhash
from lateline.llm.common import as_bytes, fresh, slices, tasks, texts
from lateline.llm.components import components
from lateline.sources.staging import stage, stage_buckets

#: Words of a shingle, and the least similarity as a fraction of integers.
SHINGLE_WORDS, SIMILARITY = 5, (4, 5)
SEED = 42
#: Counters of shingles, their parts in a shuffle, and one in so many rows that are counted.
COUNTERS, PARTS, SAMPLED = 1 << 18, 16, 8
#: Components of a shingle that are paired at once; more go in turns, as long as one in so many comparisons links.
MEETING, TURNS, LEAST_LINKED = 8, 24, 20
#: Bits of a row's sketch; those of a thousand shingles or fewer tell apart most rows that are not similar.
SKETCH_BITS = 1_024


def shingles(text: bytes, size: int = SHINGLE_WORDS) -> set[bytes]:
    """The runs of ``size`` words; of fewer words the whole sequence. A-Z count as lower case."""
    words = text.lower().split()
    if len(words) < size:
        return {b" ".join(words)}
    return set(map(b" ".join, zip(*(words[i:] for i in range(size)))))


def similar(a: bytes, b: bytes) -> bool:
    """Whether the Jaccard similarity of the shingles is enough. Texts without words are equal."""
    a, b = shingles(a), shingles(b)
    both = len(a & b)
    return SIMILARITY[1] * both >= SIMILARITY[0] * (len(a) + len(b) - both)


def hashes(text: bytes) -> np.ndarray:
    """Different hashes of the shingles."""
    found = shingles(text)
    return np.unique(np.fromiter((xxhash.xxh64_intdigest(s, SEED) for s in found), np.uint64, len(found)))


def _counters(rows: DataFrame) -> np.ndarray:
    """How many rows of a sample have a shingle of each counter."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(COUNTERS, np.int64)
        for batch in slices(batches, "text"):
            for text in as_bytes(batch.column("text")):
                np.add.at(counts, (hashes(text) % COUNTERS).astype(np.int64), 1)
        parts = [x.astype(np.uint32).tobytes() for x in np.split(counts, PARTS)]
        yield pa.RecordBatch.from_arrays([pa.array(range(PARTS), pa.int32()), pa.array(parts, pa.binary())], names=["part", "counts"])

    def total(key: tuple, table: pa.Table) -> pa.Table:
        counts = sum(np.frombuffer(x, np.uint32).astype(np.int64) for x in table["counts"].to_pylist())
        return pa.table({"part": table["part"][:1], "counts": pa.array([counts.tobytes()], pa.binary())})

    sample = rows.where(F.pmod(F.xxhash64("text"), F.lit(SAMPLED)) == 0)
    found = sample.mapInArrow(count, "part int, counts binary").groupBy("part").applyInArrow(total, "part int, counts binary")
    result = np.zeros((PARTS, COUNTERS // PARTS), np.int64)
    for row in found.collect():  # PARTS rows
        result[row["part"]] = np.frombuffer(row["counts"], np.int64)
    return result.reshape(-1)


def _shared(rows: DataFrame) -> DataFrame:
    """shingle, row, size and left of the first shingles of each row that others have among theirs.

    size is the number of shingles of the row, left the number from this one on.
    """
    counters = _counters(rows)

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            found, owners, sizes, lefts = [], [], [], []
            for row, text in zip(batch.column("doc_id").to_pylist(), as_bytes(batch.column("text"))):
                values = hashes(text)
                n = len(values)
                most = n - -(-SIMILARITY[0] * n // SIMILARITY[1]) + 1
                found.append(values[np.lexsort((values, counters[(values % COUNTERS).astype(np.int64)]))[:most]])
                owners.append(np.full(most, row, np.int64))
                sizes.append(np.full(most, n, np.int32))
                lefts.append(np.arange(n, n - most, -1, np.int32))
            columns = [np.concatenate(found).view(np.int64), *(np.concatenate(x) for x in (owners, sizes, lefts))]
            for start in range(0, len(columns[0]), 50_000):
                yield pa.RecordBatch.from_arrays([pa.array(c[start : start + 50_000]) for c in columns], names=["shingle", "row", "size", "left"])

    def repeated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # ascending shingles: a row stays if the one before or the one after has the same
        held, marked = None, False
        for batch in batches:
            if not batch.num_rows:
                continue
            table = pa.Table.from_batches([batch] if held is None else [held, batch]).combine_chunks()
            values = table["shingle"].to_numpy()
            same = values[1:] == values[:-1]
            stays = np.append(False, same) | np.append(same, False)
            # The last row waits for the next batch; one that is known to stay waits with a mark.
            stays[0] |= marked
            marked = bool(stays[-1])
            held = table.slice(len(values) - 1).to_batches()[0]
            yield from table.slice(0, len(values) - 1).filter(pa.array(stays[:-1])).to_batches()
        if marked:
            yield held

    schema = "shingle long, row long, size int, left int"
    dealt = rows.mapInArrow(first, schema).repartition(tasks(rows.sparkSession), "shingle").sortWithinPartitions("shingle")
    return stage(dealt.mapInArrow(repeated, schema), "shared-shingles")


def _possible(a_size: Column, a_left: Column, b_size: Column, b_left: Column) -> Column:
    """Whether enough shingles are left for the similarity, if no earlier one is shared."""
    low, high = SIMILARITY
    return F.least(a_left, b_left).cast("long") * (low + high) >= (a_size.cast("long") + b_size) * low


def _checked(pairs: DataFrame, rows: DataFrame) -> DataFrame:
    """The pairs (a, b) whose texts are similar."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text_a"):
            near = [similar(a, b) for a, b in zip(as_bytes(batch.column("text_a")), as_bytes(batch.column("text_b")))]
            yield batch.select(["a", "b"]).filter(pa.array(near, pa.bool_()))

    met = stage(pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "met")
    # Only texts of pairs are shuffled: rows in buckets are found where they are.
    met_rows = rows.join(met.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct(), "doc_id", "left_semi")
    a, b = (met_rows.select(F.col("doc_id").alias(n), F.col("text").alias(f"text_{n}")) for n in "ab")
    return stage(met.join(a, "a").join(b, "b").select("a", "b", "text_a", "text_b").mapInArrow(run, "a long, b long"), "near-pairs")


def _merged(labels: DataFrame, links: DataFrame) -> DataFrame:
    """row and component of the rows that labels or further links connect.

    Links are drawn between components first, so however many there are between two of them count once.
    """
    of_a, of_b = (labels.select(F.col("row").alias(n), F.col("component").alias(f"component_{n}")) for n in "ab")
    drawn = links.join(of_a, "a", "left").join(of_b, "b", "left")
    drawn = drawn.select(F.coalesce("component_a", "a").alias("a"), F.coalesce("component_b", "b").alias("b"))
    step = components(drawn).select("node", F.col("component").alias("to"))
    known = labels.join(step.withColumnRenamed("node", "component"), "component", "left").select("row", F.coalesce("to", "component").alias("component"))
    added = step.join(labels.select(F.col("row").alias("node")), "node", "left_anti").select(F.col("node").alias("row"), F.col("to").alias("component"))
    return stage(known.unionAll(added), "near-components")


def _next_ones(entries: DataFrame, order: list[Column]) -> DataFrame:
    """The pairs (a, b) of entries of different components that follow each other in a shingle and may be similar."""
    following = Window.partitionBy("shingle").orderBy(*order)
    ahead = [F.lead(n).over(following).alias(f"next_{n}") for n in ("row", "size", "left", "component")]
    chain = entries.select("*", *ahead).where(_possible(*(F.col(n) for n in ("size", "left", "next_size", "next_left"))))
    return chain.where("component <> next_component").select(F.col("row").alias("a"), F.col("next_row").alias("b"))


def _placed(shared: DataFrame, labels: DataFrame) -> DataFrame:
    return stage(shared.join(labels, "row", "left").withColumn("component", F.coalesce("component", "row")), "placed-shingles")


def _crowded(placed: DataFrame) -> DataFrame:
    """The rows of shingles that more than ``MEETING`` components have."""
    each = placed.select("shingle", "component").distinct()
    crowds = each.groupBy("shingle").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > MEETING).select("shingle")
    return placed.join(crowds, "shingle", "left_semi")


def _sketches(rows: DataFrame) -> DataFrame:
    """row and sketch: of each bit, whether an odd number of the row's shingles have it.

    A shingle that only one of two rows has changes one bit, so two rows differ in at least as many shingles as their
    sketches in bits.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            bits = [np.bincount((hashes(t) % SKETCH_BITS).astype(np.int64), minlength=SKETCH_BITS) & 1 for t in as_bytes(batch.column("text"))]
            words = np.packbits(np.array(bits, np.uint8), axis=1).view(np.int64)
            lists = pa.ListArray.from_arrays(np.arange(0, words.size + 1, words.shape[1], np.int32), pa.array(words.reshape(-1)))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), lists], names=["row", "sketch"])

    return rows.mapInArrow(run, "row long, sketch array<long>")


def _near(a_size: Column, a_sketch: Column, b_size: Column, b_sketch: Column) -> Column:
    """Whether two rows may differ in few enough shingles for the similarity; null if a sketch is."""
    low, high = SIMILARITY
    differing = sum(F.bit_count(a_sketch[i].bitwiseXOR(b_sketch[i])) for i in range(SKETCH_BITS // 64))
    return differing * (low + high) <= (a_size.cast("long") + b_size) * (high - low)


def _left_pairs(placed: DataFrame, rows: DataFrame) -> DataFrame:
    """The pairs (a, b) of rows of different components that share a shingle and that sizes and sketches leave possible.

    Pairs of components that meet come first; of two that are one row each the sketches decide. Then each row of the one
    with fewer rows meets those of the other, so a large component is not repeated for each row at its edge.
    """
    meeting = placed.groupBy("shingle").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low < high").select("shingle")
    entries = stage(placed.join(meeting, "shingle", "left_semi"), "meeting-shingles")
    sketched = _sketches(rows.join(entries.select(F.col("row").alias("doc_id")).distinct(), "doc_id", "left_semi"))
    entries = stage(entries.join(stage(sketched, "sketches"), "row"), "sketched-shingles")
    alone = F.when(F.count(F.lit(1)) == 1, F.any_value("sketch"))
    each = entries.groupBy("shingle", "component").agg(F.count(F.lit(1)).alias("n"), F.min("size").alias("size"), F.max("left").alias("left"), alone.alias("sketch"))
    other = each.select("shingle", *[F.col(n).alias(f"other_{n}") for n in ("component", "n", "size", "left", "sketch")])
    possible = _possible(*(F.col(n) for n in ("size", "left", "other_size", "other_left")))
    possible &= F.coalesce(_near(*(F.col(n) for n in ("size", "sketch", "other_size", "other_sketch"))), F.lit(True))
    apart = each.join(other, "shingle").where((F.col("component") < F.col("other_component")) & possible)
    fewer = F.col("n") <= F.col("other_n")
    first, second = F.when(fewer, F.col("component")).otherwise(F.col("other_component")), F.when(fewer, F.col("other_component")).otherwise(F.col("component"))
    apart = apart.select("shingle", first.alias("component_a"), second.alias("component_b"))
    a, b = (entries.select("shingle", F.col("row").alias(n), *[F.col(c).alias(f"{c}_{n}") for c in ("component", "size", "left", "sketch")]) for n in "ab")
    pairs = apart.join(a, ["shingle", "component_a"]).join(b, ["shingle", "component_b"])
    pairs = pairs.where(_possible(*(F.col(n) for n in ("size_a", "left_a", "size_b", "left_b"))))
    return pairs.where(_near(*(F.col(n) for n in ("size_a", "sketch_a", "size_b", "sketch_b")))).select("a", "b")


def near_rows(rows: DataFrame) -> DataFrame:
    """node and component of the rows that are near copies of others: the least number that near pairs lead to.

    ``rows``: doc_id, a number of each row, and text; in buckets by doc_id at best, as texts are looked up several times.
    Null counts as empty text.
    """
    shared = _shared(rows)
    found = _checked(simhash.near_pairs(rows), rows)
    labels = _merged(rows.sparkSession.createDataFrame([], "row long, component long"), found)
    labels = _merged(labels, _checked(_next_ones(_placed(shared, labels), [F.col("size"), F.col("row")]), rows))
    placed = _placed(shared, labels)
    # Where components meet in crowds, each row is compared with the next one in an order that changes each turn, as long
    # as that links many: a group of near copies is about one component before any two rows of it are paired.
    for turn in range(TURNS):
        tested = stage(_next_ones(_crowded(placed), [F.xxhash64(F.lit(turn), "row"), F.col("row")]).distinct(), "crowded")
        near = _checked(tested, rows)
        linked = near.count()
        if linked:
            labels = _merged(labels, near)
            placed = _placed(shared, labels)
        if linked * LEAST_LINKED < tested.count() or not linked:
            break
    pairs = _left_pairs(placed, rows)
    return _merged(labels, _checked(pairs, rows)).withColumnRenamed("row", "node")


def without_near_copies(docs: DataFrame, nameless: bool = True) -> DataFrame:
    """One row of each group that near copies connect, that of the least doc_id, with all its columns.

    A null doc_id is greater than any other. Rows without a doc_id stay, but link others, unless
    ``nameless`` is False: then they are judged like all rows. Null and empty texts, and texts without
    words, are copies of each other. An empty table gives an empty result.
    """
    key = fresh(docs, "row_key")
    parts = tasks(docs.sparkSession)
    dealt = docs.withColumn(key, F.monotonically_increasing_id()).repartition(parts, key)
    keyed = stage_buckets(dealt, "near-copy-rows", key, parts)
    rows = texts(keyed.select(F.col(key).alias("doc_id"), "text"))
    ids = keyed.select(F.col(key).alias("node"), F.col("doc_id").cast("long").alias("doc_id"))
    grouped = stage(near_rows(rows).join(ids, "node"), "near-groups")
    order = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "node")
    kept = grouped.groupBy("component").agg(F.min(order)["node"].alias("kept"))
    gone = grouped.join(kept, "component").where("node <> kept")
    gone = gone.where("doc_id is not null") if nameless else gone
    return keyed.join(gone.select(F.col("node").alias(key)), key, "left_anti").select(docs.columns)
