"""Exact deduplication by grace hash partitioning.

Records are dealt out by a hash of their text: by Spark between tasks, and within a task into spill
files, again and again by further bits of the hash, until a bucket fits the memory given to its
open-addressing table. The table compares complete texts, so unequal texts with one hash stay apart.

Copies are merged in each input partition before the shuffle. So a text that a third of all rows
hold is sent once by each input partition, not once by each row.
"""

from __future__ import annotations

import hashlib
import os
import pickle
import tempfile
from collections.abc import Iterable, Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lateline.llm.common import as_bytes, fresh, id_text, slices, tasks, texts

#: Texts of a task held in memory at once, in bytes; more go to spill files.
TABLE_BYTES = 48_000_000
#: Spill files of one level: so many bits of the hash.
LEVEL_BITS = 4

Record = tuple[int, bytes, int | None, int]  # hash, text, largest id, rows


def larger(a: int | None, b: int | None) -> int | None:
    return b if a is None else a if b is None else max(a, b)


class TextTable:
    """Open addressing with linear probing over hashes; a slot matches only if the whole text is equal."""

    def __init__(self) -> None:
        self.slots: list[Record | None] = [None] * 1024
        self.filled = self.bytes = 0

    def _slot(self, key: int, text: bytes) -> int:
        mask = len(self.slots) - 1
        at = key & mask
        while (found := self.slots[at]) is not None and (found[0] != key or found[1] != text):
            at = (at + 1) & mask
        return at

    def add(self, record: Record) -> None:
        key, text, largest, rows = record
        at = self._slot(key, text)
        if (found := self.slots[at]) is not None:
            self.slots[at] = key, found[1], larger(found[2], largest), found[3] + rows
            return
        self.slots[at] = record
        self.filled += 1
        self.bytes += len(text) + 100
        if 2 * self.filled > len(self.slots):
            old, self.slots = self.slots, [None] * (2 * len(self.slots))
            for x in filter(None, old):
                self.slots[self._slot(x[0], x[1])] = x

    def records(self) -> Iterator[Record]:
        return filter(None, self.slots)


def merged(records: Iterable[Record], most: int = TABLE_BYTES, level: int = 0) -> Iterator[Record]:
    """One record for each different text, in memory of about ``most`` bytes and one text.

    Copies merge in the table, so what is spilled is different texts. Texts that share all 64 bits of
    the hash can't be split further and stay in one table.
    """
    records, table = iter(records), TextTable()
    for record in records:
        table.add(record)
        if table.bytes > most and LEVEL_BITS * (level + 1) <= 64:
            break
    else:
        yield from table.records()
        return
    with tempfile.TemporaryDirectory(prefix="grace-") as folder:
        files = [open(os.path.join(folder, str(i)), "wb") for i in range(1 << LEVEL_BITS)]
        while True:
            for x in table.records():
                pickle.dump(x, files[x[0] >> (64 - LEVEL_BITS * (level + 1)) & (len(files) - 1)], protocol=5)
            table = TextTable()
            for record in records:
                table.add(record)
                if table.bytes > most:
                    break
            else:
                break
        for x in table.records():
            pickle.dump(x, files[x[0] >> (64 - LEVEL_BITS * (level + 1)) & (len(files) - 1)], protocol=5)
        del table
        for file in files:
            file.close()
            with open(file.name, "rb") as spilled:
                yield from merged(_loaded(spilled), most, level + 1)
            os.unlink(file.name)


def _loaded(file) -> Iterator[Record]:
    while True:
        try:
            yield pickle.load(file)
        except EOFError:
            return


def _batches(records: Iterable[Record], schema: pa.Schema, row) -> Iterator[pa.RecordBatch]:
    rows, held = [], 0
    for x in records:
        rows.append(row(x))
        held += len(x[1])
        if held > 4_000_000 or len(rows) == 10_000:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)
            rows, held = [], 0
    if rows:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


LOCAL = pa.schema([("key", pa.int64()), ("text", pa.binary()), ("largest", pa.int64()), ("rows", pa.int64())])
GROUPS = pa.schema([("text_sha256", pa.string()), ("keep_id", pa.int64()), ("group_size", pa.int64())])


def text_groups(docs: DataFrame, most: int = TABLE_BYTES) -> DataFrame:
    """A row for each different text: its SHA-256, the largest doc_id that has it, and its rows."""

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def records():
            for batch in slices(batches, "text"):
                for doc_id, text in zip(batch.column("doc_id").to_pylist(), as_bytes(batch.column("text"))):
                    yield xxhash.xxh3_64_intdigest(text), text, doc_id, 1

        # signed for Spark, which has no unsigned integers
        return _batches(merged(records(), most), LOCAL, lambda x: (x[0] - (1 << 63), *x[1:]))

    def second(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def records():
            for batch in batches:
                columns = [c.to_pylist() for c in batch.columns]
                yield from ((key + (1 << 63), *rest) for key, *rest in zip(*columns))

        return _batches(merged(records(), most), GROUPS, lambda x: (hashlib.sha256(x[1]).hexdigest(), x[2], x[3]))

    local = texts(docs).mapInArrow(first, "key long, text binary, largest long, rows long")
    dealt = local.repartition(tasks(docs.sparkSession), "key")
    return dealt.mapInArrow(second, "text_sha256 string, keep_id long, group_size long")


def text_digest() -> Column:
    return F.sha2(F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary"), 256)


def exact_dedup(docs: DataFrame, most: int = TABLE_BYTES) -> DataFrame:
    """A row for each row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when identical; null counts as empty. Of equal texts the row with the largest
    doc_id stays; a null doc_id is less than any other, and a group of null ids has a null keep_id.
    Rows repeated with one doc_id and text count one by one, and one of them stays. An empty table
    gives an empty result. Other columns are not read.
    """
    ids = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_digest().alias("text_sha256"))
    ids = ids.groupBy("doc_id", "text_sha256").agg(F.count(F.lit(1)).alias("repeats"))
    # A text that very many documents share is a hot key of this join; adaptive execution splits it.
    joined = ids.join(text_groups(docs, most), "text_sha256").withColumn("repeat", F.explode(F.sequence(F.lit(1), "repeats")))
    kept = F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("repeat") == 1)
    return joined.select("doc_id", "keep_id", "group_size", kept.alias("kept"), "text_sha256")


def without_copies(docs: DataFrame, most: int = TABLE_BYTES) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns."""
    key = fresh(docs, "row_key")
    kept = exact_dedup(docs, most).where("kept").select(F.concat_ws(":", id_text(), "text_sha256").alias(key))
    rows = docs.withColumn(key, F.concat_ws(":", id_text(), text_digest()))
    # Repeated rows of one id and text are an aggregate, which merges them before its shuffle.
    return rows.join(kept, key, "left_semi").dropDuplicates([key]).drop(key)
