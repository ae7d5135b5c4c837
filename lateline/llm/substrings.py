"""Removal of long word sequences that occur earlier, by fixed-block anchors.

An index holds the non-overlapping blocks of ``BLOCK`` words of every document, and every rolling
window of as many words probes it. A sequence of at least ``2 * BLOCK - 1`` words contains a whole block
of its earlier place, so each repeat of ``WINDOW`` words is hit. Around the hits all windows of
``WINDOW`` words are compared, which extends each hit to its maximal repeat: overlapping windows that
start earlier join into one removed span.

Index and probes are dealt into shards by hash. Rows are too small to be shuffled one by one, so
documents are read in units of a few megabytes, and a unit sends each shard one packed, sorted array.
Answers go back to the unit in the same form. Units are stored once in buckets, so that text is not
shuffled at all. In a unit a sequence is sent once, so a passage that a third of all documents hold
costs a shard one entry for each unit.

Blocks are found by 32 bits of a hash and the shard; false hits only cost time. Windows are compared by
96 bits.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import cache
from uuid import uuid4

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lateline.llm.common import as_bytes, by_shard, packed, packed_ascending, slices, tasks, texts, unpacked, unpacked_ascending
from lateline.sources.staging import shared_folder, stage

WINDOW, BLOCK = 20, 10
UNIT_BYTES = 4_000_000
#: Units of a bucket, on average.
BUCKET_UNITS = 4
#: Bytes hashed at once.
PART = 1_000_000
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
NEXT_SPACE = re.compile(rb"[\x20\x09-\x0D]")
#: Odd factors of the polynomial hashes, by use.
LETTERS, FIRST, SECOND, BLOCKS = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB))


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


@cache
def _powers(factor: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of a factor and of its inverse, modulo 2**64."""
    up, down = (np.full(size, f, np.uint64) for f in (factor, pow(factor, -1, 1 << 64)))
    up[0] = down[0] = 1
    return np.cumprod(up), np.cumprod(down)


def _sums(values: np.ndarray, factor: np.uint64, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Polynomial hash of each run of values."""
    size = 1 << max(20, int(len(values)).bit_length())
    up, down = _powers(int(factor), size)
    total = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * up[: len(values)], out=total[1:])
    return (total[ends] - total[starts]) * down[starts]


def words(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """The hash and the start of each word."""
    hashes, places, at = [], [], 0
    while at < len(text):
        found = NEXT_SPACE.search(text, at + PART) if len(text) - at > PART else None
        end = found.start() if found else len(text)
        raw = np.frombuffer(text, np.uint8, end - at, at)
        solid = np.concatenate([[False], ~SPACE[raw], [False]])
        edges = np.flatnonzero(solid[1:] != solid[:-1])
        starts, ends = edges[::2], edges[1::2]
        hashes.append(mixed(_sums(raw.astype(np.uint64) + np.uint64(1), LETTERS, starts, ends) + (ends - starts).astype(np.uint64)))
        places.append(starts + at)
        at = end
    return (np.concatenate(hashes), np.concatenate(places)) if hashes else (np.zeros(0, np.uint64), np.zeros(0, np.int64))


class Unit:
    """The words of a unit's documents, one after another in the order of doc_id (null last) and row."""

    def __init__(self, table: pa.Table) -> None:
        table = table.sort_by([("doc_id", "ascending"), ("row", "ascending")])
        self.doc_ids = table["doc_id"].to_pylist()
        self.texts = as_bytes(table["text"].combine_chunks())
        joined = b"\n".join(self.texts)
        self.hashes, places = words(joined)
        ends = np.cumsum([len(t) + 1 for t in self.texts])
        self.ends = np.searchsorted(places, ends)  # of each document, in words
        self.counts = np.diff(self.ends, prepend=0)
        self.begin = np.repeat(self.ends - self.counts, self.counts)  # of the document of each word
        self.left = np.repeat(self.ends, self.counts) - np.arange(len(self.hashes))

    def windows(self, size: int, starts: np.ndarray, factor: np.uint64) -> np.ndarray:
        return mixed(_sums(self.hashes, factor, starts, starts + size))

    def blocks(self, block: int, window: int, shards: int) -> tuple[np.ndarray, np.ndarray]:
        """Start and code (shard and 32 bits) of every window of a block's size, in texts that hold a repeat."""
        long_ = np.repeat(self.counts >= window, self.counts)
        starts = np.flatnonzero((self.left >= block) & long_)
        found = self.windows(block, starts, BLOCKS)
        return starts, ((found >> np.uint64(32)) % np.uint64(shards)) << np.uint64(32) | found & np.uint64(0xFFFFFFFF)


def _of_shards(codes: np.ndarray, shards: int) -> list[bytes]:
    """Ascending codes, cut by shard and packed."""
    cuts = np.searchsorted(codes, np.arange(shards + 1).astype(np.uint64) << np.uint64(32))
    low = codes.astype(np.uint32)
    return [packed_ascending(low[a:b]) for a, b in zip(cuts, cuts[1:])]


def _anchors(block: int, window: int, shards: int):
    """Per shard: blocks that are once in the unit, blocks that are there again, and windows that are no block."""

    def run(key: tuple, table: pa.Table) -> pa.Table:
        unit = Unit(table)
        starts, codes = unit.blocks(block, window, shards)
        anchored = (starts - unit.begin[starts]) % block == 0
        order = np.argsort(codes, kind="stable")
        codes, anchored = codes[order], anchored[order]
        heads = np.flatnonzero(np.diff(codes, prepend=~codes[:1]))
        many = np.diff(np.append(heads, len(codes))) > 1
        block_ = np.maximum.reduceat(anchored, heads) if len(heads) else np.zeros(0, bool)
        unique = codes[heads]
        columns = [_of_shards(unique[x], shards) for x in (block_ & ~many, block_ & many, ~block_)]
        return pa.table({"shard": pa.array(range(shards), pa.int32()), "unit": pa.array([key[0].as_py()] * shards, pa.int64()), **{n: pa.array(c, pa.binary()) for n, c in zip(("once", "again", "probes"), columns)}})

    return run


def _hits(key: tuple, table: pa.Table) -> pa.Table:
    """Of each unit's codes in this shard, those that are a block of some unit and occur at another place too."""
    units = table["unit"].to_numpy()
    keys, weight, block, owner = [], [], [], []
    for name, times, is_block in (("once", 1, True), ("again", 2, True), ("probes", 1, False)):
        for i, blob in enumerate(table[name].to_pylist()):
            keys.append(unpacked_ascending(blob, np.uint32))
            owner.append(np.full(len(keys[-1]), i, np.uint32))
            weight.append(np.full(len(keys[-1]), times, np.uint8))
            block.append(np.full(len(keys[-1]), is_block))
    keys, weight, block, owner = (np.concatenate(x) for x in (keys, weight, block, owner))
    order = np.argsort(keys, kind="stable")
    keys, weight, block, owner = (x[order] for x in (keys, weight, block, owner))
    if not len(keys):
        return pa.table({"unit": pa.array([], pa.int64()), "shard": pa.array([], pa.int32()), "found": pa.array([], pa.binary())})
    heads = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
    hit = (np.add.reduceat(weight, heads, dtype=np.int64) > 1) & np.maximum.reduceat(block, heads)
    hit = np.repeat(hit, np.diff(np.append(heads, len(keys))))
    keys, owner = keys[hit], owner[hit]
    order = np.argsort(owner, kind="stable")
    keys, owner = keys[order], owner[order]
    cuts = np.searchsorted(owner, np.arange(len(units) + 1))
    found = [(units[i], packed_ascending(keys[a:b])) for i, (a, b) in enumerate(zip(cuts, cuts[1:])) if b > a]
    return pa.table({"unit": pa.array([u for u, _ in found], pa.int64()), "shard": pa.array([key[0].as_py()] * len(found), pa.int32()), "found": pa.array([x for _, x in found], pa.binary())})


MAXIMUM = np.iinfo(np.int64).max  # stands for a null doc_id in comparisons


def _candidates(block: int, window: int, shards: int):
    """Windows that hold a hit: per shard their first places in the unit, and the places that repeat one of those."""

    def run(key: tuple, table: pa.Table, hits: pa.Table) -> pa.Table:
        names = ["shard", "unit", "first", "second", "doc_ids", "starts", "repeats"]
        empty = pa.table([pa.array([], t) for t in (pa.int32(), pa.int64(), *[pa.binary()] * 5)], names=names)
        if not table.num_rows or not hits.num_rows:
            return empty
        unit = Unit(table)
        starts, codes = unit.blocks(block, window, shards)
        answers = [unpacked_ascending(x, np.uint32).astype(np.uint64) | np.uint64(s << 32) for s, x in zip(hits["shard"].to_pylist(), hits["found"].to_pylist())]
        found = np.sort(np.concatenate(answers))
        place = np.minimum(np.searchsorted(found, codes), len(found) - 1)
        hit = np.zeros(len(unit.hashes) + window + 1, np.int64)
        hit[starts[found[place] == codes] + 1] = 1
        before = np.cumsum(hit)
        whole = np.flatnonzero(unit.left >= window)
        whole = whole[before[whole + window - block + 1] > before[whole]]
        first = unit.windows(window, whole, FIRST)
        second = unit.windows(window, whole, SECOND).astype(np.uint32)
        order = np.lexsort((second, first))  # stable: places stay ascending
        same = np.append(False, (first[order][1:] == first[order][:-1]) & (second[order][1:] == second[order][:-1]))
        leads, repeats = np.sort(order[~same]), np.sort(order[same])
        ids = np.array([MAXIMUM if d is None else d for d in unit.doc_ids], np.int64)
        own = np.repeat(np.arange(len(ids)), unit.counts)
        shard = first % np.uint64(shards)
        again = dict(by_shard(shard[repeats], shards))
        rows, nothing = [], np.zeros(0, np.int64)
        for s, places in by_shard(shard[leads], shards):  # a repeat's shard has its first place too
            lead, more = leads[places], repeats[again.get(s, nothing)]
            rows.append((s, key[0].as_py(), packed(first[lead]), packed(second[lead]), packed(ids[own[whole[lead]]]), packed_ascending(whole[lead].astype(np.uint32)), packed_ascending(whole[more].astype(np.uint32))))
        return pa.table([pa.array(c, f.type) for c, f in zip(zip(*rows), empty.schema)], names=names) if rows else empty

    return run


def _later(key: tuple, table: pa.Table) -> pa.Table:
    """Starts of windows, by unit, whose words start earlier: all but the first of each digest."""
    units = table["unit"].to_numpy()
    blobs = {n: table[n].to_pylist() for n in ("first", "second", "doc_ids", "starts", "repeats")}
    starts = [unpacked_ascending(x, np.uint32) for x in blobs["starts"]]
    owner = np.repeat(np.arange(len(units)), [len(x) for x in starts])
    first, second, ids = (np.concatenate([unpacked(x, t) for x in blobs[n]]) for n, t in (("first", np.uint64), ("second", np.uint32), ("doc_ids", np.int64)))
    start = np.concatenate(starts)
    order = np.lexsort((start, units[owner], ids, second, first))
    same = np.append(False, (first[order][1:] == first[order][:-1]) & (second[order][1:] == second[order][:-1]))
    later = np.zeros(len(start), bool)
    later[order[same]] = True
    found = []
    for i, blob in enumerate(blobs["repeats"]):
        both = np.sort(np.concatenate([start[(owner == i) & later], unpacked_ascending(blob, np.uint32)]))
        if len(both):
            found.append((units[i], packed_ascending(both)))
    return pa.table({"unit": pa.array([u for u, _ in found], pa.int64()), "starts": pa.array([x for _, x in found], pa.binary())})


def _kept(window: int):
    def run(key: tuple, table: pa.Table, later: pa.Table) -> pa.Table:
        unit = Unit(table)
        cover = np.zeros(len(unit.hashes) + 1, np.int64)
        for blob in later["starts"].to_pylist():
            starts = unpacked_ascending(blob, np.uint32)
            cover[starts] += 1
            cover[starts + window] -= 1
        gone = np.cumsum(cover)[:-1] > 0
        removed, digests, spans = [], [], []
        for text, end, count in zip(unit.texts, unit.ends.tolist(), unit.counts.tolist()):
            own = gone[end - count : end]
            removed.append(int(own.sum()))
            left = text.split()
            if removed[-1]:
                left = [left[i] for i in np.flatnonzero(~own).tolist()]
            digests.append(hashlib.sha256(b" ".join(left)).hexdigest())
            edges = np.flatnonzero(np.diff(own, prepend=False, append=False)).tolist() if removed[-1] else []
            spans.append([{"begin": a, "end": b} for a, b in zip(edges[::2], edges[1::2])])
        kind = pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())]))
        return pa.table({"doc_id": pa.array(unit.doc_ids, pa.int64()), "n_words": pa.array(unit.counts, pa.int64()), "n_removed": pa.array(removed, pa.int64()), "kept_sha256": pa.array(digests), "spans": pa.array(spans, kind)})

    return run


def _units(docs: DataFrame, unit_bytes: int) -> DataFrame:
    """The texts with unit and row, stored in buckets of units: read by unit they need no shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unit, row, held = TaskContext.get().partitionId() << 32, 0, 0
        for batch in slices(batches, "text", unit_bytes):
            size = batch.column("text").nbytes
            if held and held + size > unit_bytes:
                unit, held = unit + 1, 0
            held += size
            rows = np.arange(row, row + batch.num_rows)
            row += batch.num_rows
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("text"), pa.array(np.full(batch.num_rows, unit)), pa.array(rows)], names=["doc_id", "text", "unit", "row"])

    spark, selected = docs.sparkSession, texts(docs)
    size = selected.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(tasks(spark), size // (BUCKET_UNITS * unit_bytes))
    entry, path = f"units_{uuid4().hex}", f"{shared_folder(spark).rstrip('/')}/units-{uuid4().hex}"
    writer = selected.mapInArrow(run, "doc_id long, text string, unit long, row long").write.format("parquet").option("compression", "zstd")
    writer.bucketBy(int(buckets), "unit").option("path", path).saveAsTable(entry)
    stored = spark.table(entry)
    spark.sql(f"drop table {entry}")  # the files of an external table stay
    return stored


def remove_repeats(docs: DataFrame, window: int = WINDOW, block: int = BLOCK, unit_bytes: int = UNIT_BYTES) -> DataFrame:
    """A row for each row of ``docs``: doc_id, n_words, n_removed, kept_sha256, spans.

    A word is removed if a window of ``window`` words that covers it also starts earlier: in a smaller
    doc_id or before it in the same document. Windows are judged on the input. spans are the removed
    runs of words, as begin and end; kept_sha256 is of the other words joined by one blank. Null texts
    have no words. Of rows repeated with one doc_id one comes first; rows without a doc_id come after
    all others. An empty table gives an empty result. Other columns are not read.
    """
    if window < 2 * block - 1:
        raise ValueError("a window must hold a whole block wherever it starts")
    spark = docs.sparkSession
    shards = tasks(spark)
    units = _units(docs, unit_bytes)
    by_unit = units.groupBy("unit")
    sent = by_unit.applyInArrow(_anchors(block, window, shards), "shard int, unit long, once binary, again binary, probes binary")
    hits = stage(sent.groupBy("shard").applyInArrow(_hits, "unit long, shard int, found binary"), "hits")
    schema = "shard int, unit long, first binary, second binary, doc_ids binary, starts binary, repeats binary"
    sent = by_unit.cogroup(hits.groupBy("unit")).applyInArrow(_candidates(block, window, shards), schema)
    later = stage(sent.groupBy("shard").applyInArrow(_later, "unit long, starts binary"), "later")
    schema = "doc_id long, n_words long, n_removed long, kept_sha256 string, spans array<struct<begin:long,end:long>>"
    return by_unit.cogroup(later.groupBy("unit")).applyInArrow(_kept(window), schema)
