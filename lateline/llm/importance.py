"""Draw the documents that look most like a target: importance weights from hashed word features, ranked with noise.

1. A pre-tokenizer of the tokenizers library, an untrained ``Split`` by a regular expression, gives the words of
   an ASCII-lowered text with their offsets. Every window of consecutive offset pairs is a feature; the CRC of its
   text names its bucket. The buckets of a document are stored packed, so texts are cut into words once.
2. Bucket histograms of the documents and of the target texts give every bucket a gain, the logarithm of how much more often the
   target has it. There is one number a bucket: this is all that passes through the driver.
3. The weight of a document is the sum of its gains. With Gumbel noise from a hash of its id added, the highest
   scores are a draw without replacement, in proportion to the weights.

The ranks come from sorting the eligible rows into ranges of score and counting the rows of the ranges before;
no task gets more than a range, and equal scores are spread too.

Rows: a null text has no words; a null id counts as the text ``null`` in the noise, and comes after other ids in a tie;
repeated rows and ids are documents of their own. Of rows equal in score and id the one with the lesser weight comes first. No documents
give no rows; without target texts the gains are those of even counts. Other columns are not read.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Callable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from tokenizers import Regex, pre_tokenizers

from lateline.llm.common import parameters, slices, texts
from lateline.sources.staging import stage

#: A word: a longest run of digits, small letters and characters beyond ASCII.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
BUCKETS = 10_000
SIZES = (1, 1)  # words of the shortest and longest window
LEAST_WORDS = 20
PERCENT = 10
SEED = "2024"
#: Characters of a piece of a very long text; pieces end between words.
PIECE = 1_000_000
#: Words whose bucket a task remembers.
MEMORY = 500_000

FEATURES = "doc_id long, n_words long, n_features long, buckets binary"


@cache
def _split() -> pre_tokenizers.PreTokenizer:
    return pre_tokenizers.Split(Regex(WORD), "removed", invert=True)


_BETWEEN = re.compile(r"[\x00-\x2F\x3A-\x60\x7B-\x7F]")


def _pieces(text: str) -> Iterator[str]:
    start = 0
    while len(text) - start > PIECE:
        cut = _BETWEEN.search(text, start + PIECE)
        if not cut:
            break
        yield text[start : cut.start()]
        start = cut.start()
    yield text[start:] if start else text


class _Buckets(dict):
    """The bucket of a feature, remembered for a while."""

    def __init__(self, buckets: int):
        super().__init__()
        self.buckets = buckets

    def __missing__(self, feature: str) -> int:
        if len(self) >= MEMORY:
            self.clear()
        bucket = self[feature] = zlib.crc32(feature.encode()) % self.buckets
        return bucket


def _windows(text: str, found: list[tuple[str, tuple[int, int]]], before: list[str], sizes: tuple[int, int]) -> Iterator[str]:
    """Features that end in this piece; ``before`` are the last words of the piece before."""
    words = before + [word for word, _ in found]
    offsets = [None] * len(before) + [pair for _, pair in found]
    for last in range(len(before), len(words)):
        for size in range(sizes[0], sizes[1] + 1):
            first = last - size + 1
            if first < 0:
                break
            start, end = offsets[first], offsets[last]
            # One space between each two words: the window is a piece of the text as it is.
            joined = text[start[0] : end[1]] if start else ""
            yield joined if joined.split(" ") == words[first : last + 1] else " ".join(words[first : last + 1])


def _document(text: str, sizes: tuple[int, int], memory: _Buckets) -> tuple[int, np.ndarray]:
    """Words and the buckets of all features of a lowered text."""
    words, parts, before = 0, [], []
    for piece in _pieces(text):
        found = _split().pre_tokenize_str(piece)
        words += len(found)
        if sizes == (1, 1):
            part = np.fromiter((memory[word] for word, _ in found), np.uint32, len(found))
        else:
            part = np.fromiter((memory[feature] for feature in _windows(piece, found, before, sizes)), np.uint32)
            kept = sizes[1] - 1
            before = (before + [word for word, _ in found])[-kept:] if kept else []
        parts.append(part)
    return words, parts[0] if len(parts) == 1 else np.concatenate(parts)


def _cut(sizes: tuple[int, int], buckets: int) -> Callable:
    width = np.uint16 if buckets <= 2**16 else np.uint32

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memory = _Buckets(buckets)
        for batch in slices(batches, "text"):
            lowered = pc.ascii_lower(pc.fill_null(batch["text"], "")).to_pylist()
            found = [_document(text, sizes, memory) for text in lowered]
            yield pa.RecordBatch.from_arrays(
                [
                    batch["doc_id"],
                    pa.array([words for words, _ in found], pa.int64()),
                    pa.array([len(codes) for _, codes in found], pa.int64()),
                    pa.array([codes.astype(width).tobytes() for _, codes in found], pa.binary()),
                ],
                names=["doc_id", "n_words", "n_features", "buckets"],
            )

    return run


def features(docs: DataFrame, sizes: tuple[int, int] = SIZES, buckets: int = BUCKETS) -> DataFrame:
    """``(doc_id, n_words, n_features, buckets)`` of every document; buckets are packed little-endian integers."""
    return texts(docs).mapInArrow(_cut(sizes, buckets), FEATURES)


def _codes(column: pa.Array, buckets: int) -> np.ndarray:
    """The buckets of all documents of a batch, one after the other."""
    kind = np.uint16 if buckets <= 2**16 else np.uint32
    column = column.cast(pa.large_binary())
    ends = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    return np.frombuffer(data, np.uint8)[ends[0] : ends[-1]].view(kind) if data is not None and len(column) else np.empty(0, kind)


def histogram(found: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """How often each bucket occurs: a number for each on the driver, whatever the table."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(buckets, np.int64)
        for batch in batches:
            counts += np.bincount(_codes(batch["buckets"], buckets), minlength=buckets)
        filled = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(filled), pa.array(counts[filled])], names=["bucket", "n"])

    rows = found.select("buckets").mapInArrow(count, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    counts = np.zeros(buckets, np.int64)
    for row in rows.collect():  # at most one row a bucket
        counts[row["bucket"]] = row["n"]
    return counts


def gains(own: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Floored thousandths of the logarithm of target share over own share, each with one count more a bucket."""
    size = len(own)
    more = (target + 1.0) * float(own.sum() + size)
    less = (own + 1.0) * float(target.sum() + size)
    return np.floor(1000 * np.log(more / less)).astype(np.int64)


def weights(found: DataFrame, gain: np.ndarray) -> DataFrame:
    """``(doc_id, n_words, n_features, weight)``: the sum of the gains of all features of a document."""
    size = len(gain)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sums = np.concatenate([[0], np.cumsum(gain[_codes(batch["buckets"], size)])])
            ends = np.concatenate([[0], np.cumsum(batch["n_features"].to_numpy())])
            weight = pa.array(sums[ends[1:]] - sums[ends[:-1]], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], batch["n_words"], batch["n_features"], weight],
                names=["doc_id", "n_words", "n_features", "weight"],
            )

    return found.mapInArrow(add, "doc_id long, n_words long, n_features long, weight long")


def noise(seed: str) -> Column:
    """Gumbel noise in thousandths, from the first 32 bits of a SHA-256 of seed and id."""
    named = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("null")))
    bits = F.conv(F.substring(F.sha2(named, 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((bits + 0.5) / F.lit(4294967296.0)))).cast("long")


def ranked(scored: DataFrame, order: list[Column], most: int) -> DataFrame:
    """The rows with a ``rank`` from 1 by ``order``, null beyond ``most``: ranges of the order are sorted, then counted."""
    parts = scored.repartitionByRange(*order).sortWithinPartitions(*order)
    # The number of the range is above 33 bits, the place in it below.
    placed = stage(parts.withColumn("place", F.monotonically_increasing_id()), "ranked")
    part = F.shiftright("place", 33)
    counts = placed.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n")).orderBy("part").collect()  # a row a range
    rows, before = [], 0
    for row in counts:
        rows.append((row["part"], before))
        before += row["n"]
    table = placed.sparkSession.createDataFrame(rows, "part long, before long")
    place = F.col("before") + F.col("place").bitwiseAND(2**33 - 1) + 1
    joined = placed.withColumn("part", part).join(parameters(table, len(rows)), "part")
    return joined.withColumn("rank", F.when(place <= most, place)).drop("part", "before", "place")


def resample(
    docs: DataFrame,
    target: DataFrame,
    sizes: tuple[int, int] = SIZES,
    buckets: int = BUCKETS,
    least_words: int = LEAST_WORDS,
    percent: int = PERCENT,
    seed: str = SEED,
) -> DataFrame:
    """``(doc_id, n_features, weight, score, rank)`` of every document; the drawn ones have ranks 1, 2, 3, …

    ``target`` has a column ``text``. Drawn are ``percent`` of the documents with at least ``least_words`` words,
    rounded down.
    """
    found = stage(features(docs, sizes, buckets), "features")
    wanted = features(target.select(F.lit(0).alias("doc_id"), "text"), sizes, buckets)
    gain = gains(histogram(found, buckets), histogram(wanted, buckets))
    scored = weights(found, gain).withColumn("score", F.col("weight") + noise(seed))
    scored = stage(scored.withColumn("row", F.monotonically_increasing_id()), "scored")
    eligible = scored.where(F.col("n_words") >= least_words)
    order = [F.desc("score"), F.asc_nulls_last("doc_id"), F.asc("weight"), F.asc("n_features"), F.asc("row")]
    drawn = ranked(eligible, order, eligible.count() * percent // 100)
    others = scored.where(F.col("n_words") < least_words).withColumn("rank", F.lit(None).cast("long"))
    columns = ["doc_id", "n_features", "weight", "score", "rank"]
    return drawn.select(columns).unionByName(others.select(columns))


SQL = r"""
    with steps as (
        select list_transform(range(256), lambda i: list_reduce(list_concat([i], range(8)), lambda c, k:
            case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end)) as step
    ),
    texts as (
        select 'own' as side, row_number() over () as row_id, doc_id, text from documents
        union all select 'target', 0, null, text from benchmark
    ),
    words as (
        select side, row_id, unnest(regexp_extract_all(
            translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) as word
        from texts
    ),
    counted as (select side, row_id, word, count(*) as n from words group by all),
    hashed as (
        select word, xor(4294967295, list_reduce(list_concat([4294967295], list_transform(range(len(code) // 2), lambda i:
            16 * (instr('0123456789ABCDEF', code[2 * i + 1]) - 1) + instr('0123456789ABCDEF', code[2 * i + 2]) - 1)),
            lambda c, b: xor(c >> 8, step[(xor(c, b) & 255) + 1]))) % 10000 as bucket
        from (select distinct word, hex(word) as code from counted), steps
    ),
    sums as (
        select bucket, coalesce(sum(n) filter (side = 'own'), 0)::bigint as s,
               coalesce(sum(n) filter (side = 'target'), 0)::bigint as t
        from counted join hashed using (word) group by bucket
    ),
    gains as (
        select bucket, floor(1000 * ln((t + 1)::double * (sum(s) over () + 10000)::double
                             / ((s + 1)::double * (sum(t) over () + 10000)::double)))::bigint as gain from sums
    ),
    weights as (
        select row_id, sum(n)::bigint as n_features, sum(n * gain)::bigint as weight
        from counted join hashed using (word) join gains using (bucket) where side = 'own' group by row_id
    ),
    scored as (
        select doc_id, coalesce(n_features, 0) as n_features, coalesce(weight, 0) as weight,
               coalesce(weight, 0) + floor(-1000 * ln(-ln(
                   (('0x' || sha256('2024:' || doc_id)[:8])::bigint + 0.5) / 4294967296)))::bigint as score
        from texts left join weights using (row_id) where side = 'own'
    ),
    placed as (
        select *, n_features >= 20 as eligible,
               row_number() over (partition by n_features >= 20 order by score desc, doc_id) as place from scored
    )
    select doc_id, n_features, weight, score,
           case when eligible and place <= 10 * count(*) filter (eligible) over () // 100 then place end as rank
    from placed
"""
