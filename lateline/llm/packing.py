"""Best-two-fit packing of tokenised documents into sequences.

A sequence is filled greedily, with the longest piece that still fits each time. Then its smallest
piece is replaced by two unpacked pieces if they fit the gap this leaves more tightly. Pieces are dealt
into blocks of a fixed number of rows at random, and each block is packed alone: it wastes part of
its last sequences only, a share that does not grow with the input.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lateline.llm.common import as_bytes, slices, texts
from lateline.llm.tokens import default_path, text_ids
from lateline.sources.staging import stage

SEQUENCE_TOKENS = 2_048
END_ID = 0
#: Pieces packed together.
BLOCK_ROWS = 50_000

PIECE = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()), ("salt", pa.int64())])
PIECE_SQL = "doc_id long, piece int, start long, length long, ids_crc32 long, salt long"


def pieces(docs: DataFrame, path: str, most: int = SEQUENCE_TOKENS, end_id: int = END_ID) -> DataFrame:
    """The ids of each whole text and the end id, cut where a sequence is full."""
    end = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, row = text_ids(path), 0
        task = TaskContext.get().partitionId()
        for batch in slices(batches, "text"):
            out = []
            for doc_id, ids in zip(batch.column("doc_id").to_pylist(), encoder.ids(as_bytes(batch.column("text")))):
                ids += end
                for n, at in enumerate(range(0, len(ids), 4 * most)):
                    part = ids[at : at + 4 * most]
                    out.append((doc_id, n, at // 4, len(part) // 4, zlib.crc32(part), (task << 40) + row))
                    row += 1
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), PIECE)], schema=PIECE)

    return texts(docs).mapInArrow(run, PIECE_SQL)


def best_two_fit(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Sequence and place of each piece; ``lengths`` are between 1 and ``capacity``."""
    order = np.argsort(lengths, kind="stable")
    ends = np.searchsorted(lengths[order], np.arange(capacity + 1), side="right")
    left = np.diff(ends, prepend=0).tolist()  # unpacked pieces by length
    next_ = ends.tolist()
    there = sum(1 << i for i, n in enumerate(left) if n)  # the lengths that have some
    sequence, place = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    number = 0

    def longest(most: int) -> int:
        """The longest unpacked piece of at most that length; 0 if there is none."""
        return max(0, (there & ((1 << (most + 1)) - 1)).bit_length() - 1)

    def take(length: int) -> None:
        nonlocal there
        left[length] -= 1
        if not left[length]:
            there &= ~(1 << length)

    while there:
        chosen, gap = [], capacity
        while gap and (length := longest(gap)):
            take(length)
            chosen.append(length)
            gap -= length
        if gap:
            smallest = chosen[-1]
            room, best = gap + smallest, (smallest, 0, 0)
            a = longest(room - 1)
            while a and 2 * a >= best[0] + 1:
                # the second is no longer than the first, and another piece
                second = min(a, room - a)
                b = longest(second if second < a or left[a] > 1 else second - 1)
                if b and a + b > best[0]:
                    best = a + b, a, b
                    if a + b == room:
                        break
                a = longest(a - 1)
            if best[1]:
                chosen.pop()
                left[smallest] += 1
                there |= 1 << smallest
                for length in best[1:]:
                    take(length)
                    chosen.append(length)
        at = 0
        for length in chosen:
            next_[length] -= 1
            i = order[next_[length]]
            sequence[i], place[i] = number, at
            at += length
        number += 1
    return sequence, place


def pack(docs: DataFrame, path: str | None = None, most: int = SEQUENCE_TOKENS, end_id: int = END_ID, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """A row for each piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    Reads doc_id and text; a null text is empty and still has its end id. Rows repeated with one
    doc_id are packed one by one. Pieces of one document can be in any sequences. An empty table gives
    an empty result.
    """
    cut = stage(pieces(docs, path or default_path(), most, end_id), "pieces")
    blocks = max(1, math.ceil(cut.count() / block_rows))

    def run(key: tuple, table: pa.Table) -> pa.Table:
        table = table.sort_by([("length", "ascending"), ("salt", "ascending")])
        sequence, place = best_two_fit(table["length"].to_numpy(), most)
        table = table.select(["doc_id", "piece", "start", "length", "ids_crc32"])
        return table.append_column("sequence_id", pa.array(sequence + (key[0].as_py() << 32))).append_column("offset", pa.array(place))

    dealt = cut.withColumn("block", F.pmod(F.xxhash64("salt"), F.lit(blocks).cast("long")))
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"
    return dealt.groupBy("block").applyInArrow(run, schema)
