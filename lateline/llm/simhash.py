"""Near-duplicate groups by SimHash fingerprints.

A document's fingerprint has a bit for each of the 64 bits of its shingles' XXH64 (seed 42): 1 if it is
set in more than half of them. Fingerprints within a few bits are linked (``hamming``), and documents
whose fingerprints links connect are one group (``components``). Only different fingerprints are
compared, so exact copies cost nothing there.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lateline.llm import hamming
from lateline.llm.common import as_bytes, slices, texts
from lateline.llm.components import components
from lateline.sources.staging import stage

SHINGLE_WORDS, DISTANCE, SEED = 3, 2, 42
#: Shingles of a long text that are counted at once.
COUNTED = 100_000


def shingles(words: list[bytes], size: int) -> Iterator[bytes]:
    """Runs of ``size`` words; of fewer words the whole sequence, of none nothing."""
    if len(words) < size:
        return iter([b" ".join(words)] if words else [])
    return map(b" ".join, zip(*(words[i:] for i in range(size))))


def mixed(values: np.ndarray) -> np.ndarray:
    """Other 64-bit hashes made of 64-bit hashes, by multiplying and shifting."""
    values = (values ^ (values >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


def fingerprints(contents: list[bytes], size: int, words: int = 1) -> np.ndarray:
    """The fingerprint of each UTF-8 text as a row of words, 0 for one without words. A-Z count as lower case.

    The first word is of the shingles' hashes, each further one of the hashes of those before.
    """
    digest = xxhash.xxh64_intdigest
    result = np.zeros((len(contents), words), np.uint64)
    for i, text in enumerate(contents):
        found = np.fromiter((digest(s, SEED) for s in shingles(text.lower().split(), size)), np.uint64)
        for word in range(words if len(found) else 0):
            found = mixed(found) if word else found
            ones = np.zeros(64, np.int64)
            for start in range(0, len(found), COUNTED):
                some = found[start : start + COUNTED].astype(">u8").view(np.uint8).reshape(-1, 8)
                ones += np.unpackbits(some, axis=1).sum(axis=0, dtype=np.int64)
            result[i, word] = np.packbits(2 * ones > len(found)).view(">u8")[0]
    return result


def with_fingerprints(docs: DataFrame, size: int, words: int) -> DataFrame:
    """doc_id and print, the fingerprint's words as signed longs, of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            prints = fingerprints(as_bytes(batch.column("text")), size, words).view(np.int64)
            lists = pa.ListArray.from_arrays(np.arange(0, prints.size + 1, words, np.int32), pa.array(prints.reshape(-1)))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), lists], names=["doc_id", "print"])

    return texts(docs).mapInArrow(run, "doc_id long, print array<long>")


def near_pairs(docs: DataFrame, size: int = SHINGLE_WORDS, distance: int = DISTANCE) -> DataFrame:
    """Pairs (a, b) of doc_ids that connect the rows whose fingerprints differ in at most ``distance`` bits, without null.

    Each row is paired with the least one of its fingerprint, and these as ``hamming`` links their fingerprints: a star,
    not all pairs. A fingerprint that very many rows share is a hot key; adaptive execution splits it.
    """
    prints = stage(with_fingerprints(docs, size, 1).where("doc_id is not null").withColumn("key", F.col("print")[0]), "fingerprints")
    least = stage(prints.groupBy("key").agg(F.min("print").alias("print"), F.min("doc_id").alias("least")), "different-fingerprints")
    same = prints.join(least.select("key", F.col("least").alias("a")), "key").select("a", F.col("doc_id").alias("b")).where("a <> b")
    links = hamming.links(least.select(F.col("key").alias("node"), "print"), 1, distance, distance + 1)
    of_a, of_b = (least.select(F.col("key").alias(key), F.col("least").alias(name)) for key, name in (("a", "least_a"), ("b", "least_b")))
    return same.unionAll(links.join(of_a, "a").join(of_b, "b").select("least_a", "least_b"))


def near_groups(docs: DataFrame, size: int = SHINGLE_WORDS, distance: int = DISTANCE, words: int = 1, ranges: int = DISTANCE + 1, split: int = hamming.SPLIT) -> DataFrame:
    """doc_id, fingerprint (16 hexadecimal digits a word) and component_id of every row of ``docs``.

    component_id is the least doc_id that links lead to, its own included; fingerprints that differ in
    at most ``distance`` bits are linked, all of them if there are more ``ranges`` than that. Null and
    empty texts, and texts without words, have fingerprint 0 and are linked like others. Rows repeated
    with one doc_id each have a row and are in one group. A null doc_id is no group's id unless the group has no other: then
    that is null. An empty table gives an empty result. Other columns are not read.
    """
    prints = with_fingerprints(docs, size, words)
    # Further words make a fingerprint's key a hash of them; the only word is its own key.
    key = F.col("print")[0] if words == 1 else F.xxhash64("print")
    prints = stage(prints.withColumn("key", key), "fingerprints")
    # A fingerprint's node is its key, with or without ids; the least id of a component is found afterwards.
    different = prints.groupBy("key").agg(F.min("print").alias("print"), F.min("doc_id").alias("least_id"))
    different = stage(different, "different-fingerprints")
    linked = components(hamming.links(different.select(F.col("key").alias("node"), "print"), words, distance, ranges, split))
    placed = different.select("key", "least_id").join(linked.withColumnRenamed("node", "key"), "key", "left")
    placed = stage(placed.withColumn("component", F.coalesce("component", "key")), "placed-fingerprints")
    least = placed.groupBy("component").agg(F.min("least_id").alias("component_id"))
    groups = placed.join(least, "component").select("key", "component_id")
    # A fingerprint that very many documents share is a hot key; adaptive execution splits it.
    digits = F.transform("print", lambda x: F.lower(F.lpad(F.hex(x), 16, "0")))
    return prints.join(groups, "key").select("doc_id", F.array_join(digits, "").alias("fingerprint"), "component_id")
