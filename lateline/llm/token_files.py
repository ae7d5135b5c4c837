"""Token files: ids of every document, each compressed alone with one shared zstandard dictionary.

A set of files is a folder with two tables: ``dictionary`` (the dictionary, its SHA-256, the width of
an id) and ``blocks``. A block holds compressed documents in ascending doc_id order, one after another,
and an index with the id, byte offset and number of tokens of each; it names the dictionary by its
SHA-256. Blocks are dealt into shards by ranges of doc_id. One document is read by its block's index:
only its own bytes are decompressed.
"""

from __future__ import annotations

import bisect
import hashlib
import math
import zlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lateline.llm.common import as_bytes, slices, texts
from lateline.llm.tokens import default_path, text_ids

END_ID = 2
DICTIONARY_BYTES = 32_768
#: The dictionary is trained on at most so many documents, of at most so many characters each.
SAMPLE_ROWS, SAMPLE_CHARACTERS = 1_000, 20_000
#: Documents of a shard, and bytes of a block.
SHARD_ROWS, BLOCK_BYTES = 10_000, 2_000_000


def _narrow(ids: bytes, width: int) -> bytes:
    return ids if width == 4 else np.frombuffer(ids, "<u4").astype("<u2").tobytes()


def _wide(ids: bytes, width: int) -> bytes:
    return ids if width == 4 else np.frombuffer(ids, "<u2").astype("<u4").tobytes()


def train_dictionary(samples: list[bytes], most: int = DICTIONARY_BYTES) -> bytes:
    """A zstandard dictionary; of too few samples their end, which serves as one; of none, nothing."""
    try:
        return zstandard.train_dictionary(most, samples).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[-most:]


@cache
def _codec(dictionary: bytes) -> tuple[zstandard.ZstdCompressor, zstandard.ZstdDecompressor]:
    shared = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
    return zstandard.ZstdCompressor(level=3, dict_data=shared), zstandard.ZstdDecompressor(dict_data=shared)


def sample_dictionary(docs: DataFrame, path: str, width: int) -> bytes:
    """Trained on serialised ids of the documents whose id hashes least."""
    short = docs.where(F.length("text") <= SAMPLE_CHARACTERS)
    ids = short.select("doc_id").distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE_ROWS)
    chosen = short.join(F.broadcast(ids), "doc_id").groupBy("doc_id").agg(F.min("text").alias("text"))  # SAMPLE_ROWS ids
    rows = sorted(chosen.collect())
    return train_dictionary([_narrow(x, width) for x in text_ids(path).ids([r["text"].encode() for r in rows])])


BLOCK = pa.schema(
    [("shard", pa.int32()), ("block", pa.int32()), ("first_id", pa.int64()), ("last_id", pa.int64()), ("tokens", pa.int64()), ("dictionary_sha256", pa.string()), ("doc_ids", pa.list_(pa.int64())), ("offsets", pa.list_(pa.int64())), ("n_tokens", pa.list_(pa.int64())), ("data", pa.binary())]
)
BLOCK_SQL = "shard int, block int, first_id long, last_id long, tokens long, dictionary_sha256 string, doc_ids array<long>, offsets array<long>, n_tokens array<long>, data binary"


def write(docs: DataFrame, folder: str, path: str | None = None, end_id: int = END_ID, shard_rows: int = SHARD_ROWS, block_bytes: int = BLOCK_BYTES) -> None:
    """Write the ids of every whole text, and the end id after each, as token files.

    Reads doc_id and text; a null text is empty. Rows repeated with one doc_id are kept, next to each
    other. Rows without a doc_id come first, in shards of their own. An empty table gives files without
    blocks.
    """
    spark, path, selected = docs.sparkSession, path or default_path(), texts(docs)
    width = 2 if max(text_ids(path).tokenizer.get_vocab_size(), end_id + 1) <= 1 << 16 else 4
    dictionary = sample_dictionary(selected, path, width)
    digest = hashlib.sha256(dictionary).hexdigest()
    head = spark.createDataFrame([(dictionary, digest, width)], "dictionary binary, dictionary_sha256 string, id_bytes int")
    head.coalesce(1).write.parquet(f"{folder}/dictionary")

    counts = selected.agg(F.count("doc_id").alias("named"), F.count(F.lit(1)).alias("all")).first()
    shards, nameless = (max(1, math.ceil(n / shard_rows)) for n in (counts["named"], counts["all"] - counts["named"]))
    cuts = [i / shards for i in range(1, shards)]
    bounds = sorted(set(selected.approxQuantile("doc_id", cuts, min(0.01, 0.1 / shards)))) if cuts and counts["named"] else []
    end = np.array([end_id], "<u4").tobytes()

    def compress(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, (compressor, _), row = text_ids(path), _codec(dictionary), 0
        for batch in slices(batches, "text"):
            doc_ids = batch.column("doc_id").to_pylist()
            found = [ids + end for ids in encoder.ids(as_bytes(batch.column("text")))]
            place = [nameless + bisect.bisect_right(bounds, d) if d is not None else (row + i) % nameless for i, d in enumerate(doc_ids)]
            row += len(doc_ids)
            frames = [compressor.compress(_narrow(ids, width)) for ids in found]
            columns = [pa.array(place, pa.int32()), pa.array(doc_ids, pa.int64()), pa.array([len(x) // 4 for x in found], pa.int64()), pa.array([zlib.crc32(x) for x in found], pa.int64()), pa.array(frames, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["shard", "doc_id", "n", "crc", "frame"])

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, block, rows, held = None, 0, [], 0

        def made() -> pa.RecordBatch:
            ids, n, frames = zip(*rows)
            offsets = np.cumsum([0, *map(len, frames[:-1])]).tolist()
            row = (shard, block, ids[0], ids[-1], sum(n), digest, list(ids), offsets, list(n), b"".join(frames))
            return pa.RecordBatch.from_arrays([pa.array([x], f.type) for x, f in zip(row, BLOCK)], schema=BLOCK)

        for batch in batches:
            for own, doc_id, n, _, frame in zip(*(c.to_pylist() for c in batch.columns)):
                if rows and (own != shard or held >= block_bytes):
                    yield made()
                    block, rows, held = block + 1 if own == shard else 0, [], 0
                shard = own
                rows.append((doc_id, n, frame))
                held += len(frame) + 24
        if rows:
            yield made()

    framed = selected.mapInArrow(compress, "shard int, doc_id long, n long, crc long, frame binary")
    dealt = framed.repartitionById(nameless + len(bounds) + 1, F.col("shard")).sortWithinPartitions("shard", "doc_id", "n", "crc")
    dealt.mapInArrow(gather, BLOCK_SQL).write.parquet(f"{folder}/blocks")


def _dictionary(spark: SparkSession, folder: str) -> tuple[bytes, str, int]:
    head = spark.read.parquet(f"{folder}/dictionary").first()
    found = bytes(head["dictionary"])
    if hashlib.sha256(found).hexdigest() != head["dictionary_sha256"]:
        raise ValueError("the dictionary does not have the digest that its table gives")
    return found, head["dictionary_sha256"], head["id_bytes"]


def read(spark: SparkSession, folder: str) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of every document, from the files."""
    dictionary, digest, width = _dictionary(spark, folder)
    blocks = spark.read.parquet(f"{folder}/blocks")
    # One row for each shard goes through one task; blocks are summed shard by shard.
    totals = blocks.groupBy("shard").agg(F.sum("tokens").alias("tokens"))
    before = F.sum("tokens").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1))
    totals = totals.select("shard", F.coalesce(before, F.lit(0)).alias("shard_start"))
    before = F.sum("tokens").over(Window.partitionBy("shard").orderBy("block").rowsBetween(Window.unboundedPreceding, -1))
    starts = blocks.select("shard", "block", F.coalesce(before, F.lit(0)).alias("block_start")).join(totals, "shard")
    starts = starts.select("shard", "block", (F.col("shard_start") + F.col("block_start")).alias("start"))
    columns = ["dictionary_sha256", "start", "doc_ids", "offsets", "n_tokens", "data"]

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decompressor = _codec(dictionary)[1]
        for batch in batches:
            for i in range(batch.num_rows):
                named, start, doc_ids, offsets, n_tokens, data = (c[i].as_py() for c in batch.columns)
                if named != digest:
                    raise ValueError("a block was written with another dictionary")
                found = [_wide(decompressor.decompress(data[a:b]), width) for a, b in zip(offsets, [*offsets[1:], len(data)])]
                if [len(x) // 4 for x in found] != n_tokens:
                    raise ValueError("a document does not have as many ids as the index says")
                begins = start + np.cumsum([0, *n_tokens[:-1]])
                yield pa.RecordBatch.from_arrays([pa.array(doc_ids, pa.int64()), pa.array(begins, pa.int64()), pa.array(n_tokens, pa.int64()), pa.array([zlib.crc32(x) for x in found], pa.int64())], names=["doc_id", "start", "n_tokens", "ids_crc32"])

    return blocks.join(starts, ["shard", "block"]).select(columns).mapInArrow(decode, "doc_id long, start long, n_tokens long, ids_crc32 long")


def document_ids(spark: SparkSession, folder: str, doc_id: int) -> list[int] | None:
    """The ids of one document: its block is found by its range of ids, and only its bytes are decompressed."""
    dictionary, _, width = _dictionary(spark, folder)
    blocks = spark.read.parquet(f"{folder}/blocks").where(F.col("first_id").isNotNull() & F.lit(doc_id).between(F.col("first_id"), F.col("last_id")))
    at = (F.array_position("doc_ids", F.lit(doc_id)) - 1).cast("int")
    found = blocks.where(at >= 0).select("offsets", "data", at.alias("at")).first()
    if not found:
        return None
    offsets, data, i = [*found["offsets"], len(found["data"])], bytes(found["data"]), found["at"]
    ids = _wide(_codec(dictionary)[1].decompress(data[offsets[i] : offsets[i + 1]]), width)
    return np.frombuffer(ids, "<u4").tolist()
