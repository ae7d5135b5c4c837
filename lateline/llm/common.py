"""Helpers of several operators: tables, row keys, batches of rows, packed arrays."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word: a longest run of characters other than these six kinds of white space.
WORD = r"[^\x20\x09-\x0D]+"


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def fresh(table: DataFrame, name: str) -> str:
    """A column name that the table does not have, in any case."""
    taken = {c.lower() for c in table.columns}
    while name.lower() in taken:
        name += "_"
    return name


def id_text(doc_id: str = "doc_id") -> Column:
    """The id as text, for joins in which null ids meet."""
    return F.coalesce(F.col(doc_id).cast("string"), F.lit("null"))


#: Rows of a batch that Spark hands to Python: a few megabytes of texts.
BATCH_ROWS = 2_000


def texts(docs: DataFrame) -> DataFrame:
    """doc_id as long and text as string. Sets the session's batch size, as texts are large rows."""
    docs.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def tasks(spark: SparkSession) -> int:
    """How many partitions a shuffle has; also the number of shards of a packed shuffle."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def slices(batches: Iterator[pa.RecordBatch], column: str, most: int = 4_000_000) -> Iterator[pa.RecordBatch]:
    """Cut batches so that a text column holds about ``most`` bytes in each; a row is never cut."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
        start = 0
        while start < batch.num_rows:
            done = sizes[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(sizes, done + most, side="right")))
            yield batch.slice(start, stop - start)
            start = stop


def as_bytes(column: pa.Array) -> list[bytes]:
    """The texts in UTF-8; null is empty."""
    return [b"" if x is None else x for x in column.cast(pa.binary()).to_pylist()]


@cache
def _squeezer() -> tuple[zstandard.ZstdCompressor, zstandard.ZstdDecompressor]:
    return zstandard.ZstdCompressor(level=1), zstandard.ZstdDecompressor()


def packed(values: np.ndarray) -> bytes:
    """An array of integers by planes of bytes, compressed: for shuffling many at once."""
    planes = np.ascontiguousarray(values).view(np.uint8).reshape(len(values), values.itemsize).T
    return _squeezer()[0].compress(np.ascontiguousarray(planes).tobytes())


def unpacked(blob: bytes, kind: type) -> np.ndarray:
    raw = np.frombuffer(_squeezer()[1].decompress(blob), np.uint8)
    width = np.dtype(kind).itemsize
    return np.ascontiguousarray(raw.reshape(width, -1).T).reshape(-1).view(kind)


def packed_ascending(values: np.ndarray) -> bytes:
    """The same for an ascending array, by its differences."""
    return packed(np.diff(values, prepend=values.dtype.type(0)))


def unpacked_ascending(blob: bytes, kind: type) -> np.ndarray:
    return np.cumsum(unpacked(blob, kind), dtype=kind)


def by_shard(shard: np.ndarray, shards: int) -> Iterator[tuple[int, np.ndarray]]:
    """The places of each shard that has some, ascending."""
    shard = shard.astype(np.uint16) if shards < 1 << 16 else shard  # sorted by digits, in less memory
    order = np.argsort(shard, kind="stable")
    cuts = np.searchsorted(shard[order], np.arange(shards + 1).astype(shard.dtype))
    for i in np.flatnonzero(np.diff(cuts)):
        yield int(i), order[cuts[i] : cuts[i + 1]]


#: What empties the memories that a worker keeps from task to task.
_kept: list[Callable[[], None]] = []


def keep(empty: Callable[[], None]) -> None:
    """Note how a memory that lasts beyond a task is emptied."""
    _kept.append(empty)


def let_go() -> None:
    """Empty all memories of this worker, for tasks that need the room; they fill again where they are used."""
    for empty in _kept:
        empty()


#: Rows of a table of parameters that may be broadcast; a longer one is joined by a shuffle.
BROADCAST_ROWS = 50_000


def parameters(table: DataFrame, rows: int) -> DataFrame:
    """A driver-made table of ``rows`` rows for a join: broadcast if it is short."""
    return F.broadcast(table) if rows <= BROADCAST_ROWS else table
