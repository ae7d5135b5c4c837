"""Quality by an interpolated modified Kneser-Ney model of trusted text.

A bigram model is trained on the documents that labels call good, all of them but a held-out part. The
perplexity of every document under it is compared with a quantile of the held-out good documents of
its language: what good text that the model has not seen rarely exceeds is rejected.

Every word of the training text is known, however rare, so both words and pairs of words grow with the
input, and both lie in shards: words by a hash, pairs by one of their words. Documents
are read in units of a few megabytes, held as arrays of numbers in buckets. A unit sends each shard the
different words, later the different pairs, that it needs as one packed array, and gets their numbers
and counts back. Only counts of counts reach the driver. Texts are not shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lateline.llm.common import BATCH_ROWS, as_bytes, by_shard, fresh, let_go, packed, packed_ascending, slices, tasks, unpacked, unpacked_ascending
from lateline.sources.staging import stage, stage_buckets

#: Numbers of words are 32 bits wide; two are the unknown word and the beginning of a text.
UNKNOWN, BEGIN, FIRST = 0, 1, 2
#: Bits of a word's hash that are dropped; words that share the other 48 count as one word.
KEY_SHIFT = 16
#: Words that a unit has so often have the first codes.
COMMON = 4
#: So many of a shard's words are frequent: pairs that begin with one of them may be more than a shard holds.
FREQUENT = 64
UNIT_BYTES = 16_000_000
BUCKET_UNITS = 2
#: Words of a unit that are scored at once.
PART_WORDS = 1 << 18
#: One in so many good documents is held out for the quantiles, by a hash of its id.
HELD_OUT = 5
#: The quantile of held-out good documents above which a document of the language is rejected.
QUANTILE = 0.99
#: A text's mean log probability is taken together with so many words at its language's mean, so that
#: a few rare words do not condemn a short text.
PRIOR_WORDS = 50
#: Held-out documents that a language needs for a quantile of its own; others take that of all.
LANGUAGE_ROWS = 100
#: What is counted of each word: how often pairs that it begins are seen beyond three times, its pairs that are
#: seen once, twice and more often, and the different words before it.
SUMS = 5


def _texts(docs: DataFrame) -> DataFrame:
    docs.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text"))


def _units(docs: DataFrame, unit_bytes: int) -> tuple[DataFrame, int]:
    """Units of documents, a row each, stored in so many buckets.

    A unit's different words are asked of the shards of their hashes. Codes are the places of
    words among them, common ones first, as small numbers take less room.
    """
    spark = docs.sparkSession
    shards = tasks(spark)
    asks_type = pa.list_(pa.struct([("shard", pa.int32()), ("keys", pa.binary())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go()
        unit = TaskContext.get().partitionId() << 32
        doc_ids, langs, lengths, words, seen, held = [], [], [], [], {}, 0

        def made() -> pa.RecordBatch:
            keys = np.fromiter((xxhash.xxh3_64_intdigest(w) for w in seen), np.uint64, len(seen)) >> np.uint64(KEY_SHIFT)
            keys, place = np.unique(keys, return_inverse=True)
            keys, owner = np.divmod(keys, np.uint64(shards))  # a shard's number says the rest
            asks = list(by_shard(owner, shards))
            slots = np.empty(len(keys), np.uint32)
            slots[np.concatenate([np.empty(0, np.int64)] + [at for _, at in asks])] = np.arange(len(keys), dtype=np.uint32)
            text = slots[place][np.concatenate(words)]
            counts = np.bincount(text, minlength=len(keys))
            common = np.flatnonzero(counts >= COMMON)
            common = common[np.argsort(-counts[common], kind="stable")].astype(np.uint32)
            codes = np.empty(len(keys), np.uint32)
            codes[_slots(common, len(keys))] = np.arange(len(keys), dtype=np.uint32)
            arrays = [
                pa.array([unit], pa.int64()),
                pa.array([doc_ids], pa.list_(pa.int64())),
                pa.array([langs], pa.list_(pa.string())),
                pa.array([packed(np.array(lengths, np.uint32))]),
                pa.array([packed(codes[text])]),
                pa.array([packed(common)]),
                pa.array([[{"shard": s, "keys": packed_ascending(keys[at])} for s, at in asks]], asks_type),
            ]
            return pa.RecordBatch.from_arrays(arrays, names=["unit", "doc_ids", "langs", "lengths", "codes", "common", "asks"])

        for batch in slices(batches, "text", unit_bytes):
            for doc_id, lang, text in zip(batch.column("doc_id").to_pylist(), batch.column("lang").to_pylist(), as_bytes(batch.column("text"))):
                found = np.array([seen.setdefault(w, len(seen)) for w in text.split()], np.uint32)
                doc_ids.append(doc_id)
                langs.append(lang)
                lengths.append(len(found))
                words.append(found)
                held += len(text)
            if held >= unit_bytes:
                yield made()
                unit, held = unit + 1, 0
                doc_ids, langs, lengths, words, seen = [], [], [], [], {}
        if doc_ids:
            yield made()

    selected = _texts(docs)
    size = selected.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = int(max(shards, size // (BUCKET_UNITS * unit_bytes)))
    schema = "unit long, doc_ids array<long>, langs array<string>, lengths binary, codes binary, common binary, asks array<struct<shard: int, keys: binary>>"
    return stage_buckets(selected.mapInArrow(run, schema), "units", "unit", buckets), buckets


def _slots(common: np.ndarray, words: int) -> np.ndarray:
    """The place in the order of shards and hashes of each code of so many words."""
    rest = np.ones(words, bool)
    rest[common] = False
    return np.concatenate([common, np.flatnonzero(rest).astype(np.uint32)])


def _text(unit: pa.Table, words: int) -> np.ndarray:
    """The words of a unit's documents, as places in the order of shards and hashes."""
    return _slots(unpacked(unit["common"][0].as_py(), np.uint32), words)[unpacked(unit["codes"][0].as_py(), np.uint32)]


def _table(rows: list[tuple], **types: pa.DataType) -> pa.Table:
    return pa.table([pa.array([r[i] for r in rows], t) for i, t in enumerate(types.values())], names=list(types))


def _looked_up(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Whether each wanted key is among the ascending keys, and where."""
    if not len(keys):
        return np.zeros(len(wanted), bool), np.zeros(len(wanted), np.int64)
    place = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return keys[place] == wanted, place


def _in_training(places: list[int], lengths: np.ndarray) -> np.ndarray:
    """Which words of a unit belong to its training documents."""
    train = np.zeros(len(lengths), bool)
    train[places] = True
    return np.repeat(train, lengths)


def _word_counts(key: tuple, unit: pa.Table, chosen: pa.Table) -> pa.Table:
    """Different words of a unit's training documents and their counts, per shard."""
    rows = []
    if unit.num_rows and chosen.num_rows:
        lengths = unpacked(unit["lengths"][0].as_py(), np.uint32)
        asks = [(a["shard"], unpacked_ascending(a["keys"], np.uint64)) for a in unit["asks"][0].as_py()]
        words = sum(len(keys) for _, keys in asks)
        counts, start = np.bincount(_text(unit, words)[_in_training(chosen["place"].to_pylist(), lengths)], minlength=words), 0
        for shard, keys in asks:
            own = counts[start : start + len(keys)]
            start += len(keys)
            if own.any():
                rows.append((shard, packed_ascending(keys[own > 0]), packed(own[own > 0].astype(np.uint64))))
    return _table(rows, shard=pa.int32(), keys=pa.binary(), counts=pa.binary())


def _numbered(shards: int):
    def run(key: tuple, table: pa.Table) -> pa.Table:
        """A shard's words and their numbers, small for frequent ones; no two shards share a number."""
        shard = key[0].as_py()
        keys = np.concatenate([unpacked_ascending(x, np.uint64) for x in table["keys"].to_pylist()])
        counts = np.concatenate([unpacked(x, np.uint64) for x in table["counts"].to_pylist()])
        found, place = np.unique(keys, return_inverse=True)
        numbers = np.empty(len(found), np.uint64)
        numbers[np.argsort(-np.bincount(place, counts), kind="stable")] = FIRST + shard + shards * np.arange(len(found), dtype=np.uint64)
        if numbers.max() >> np.uint64(32):
            raise OverflowError("more than 2 ** 32 different words of training text")
        return _table([(shard, packed_ascending(found), packed(numbers.astype(np.uint32)))], shard=pa.int32(), keys=pa.binary(), numbers=pa.binary())

    return run


def _numbers(key: tuple, asked: pa.Table, known: pa.Table) -> pa.Table:
    """The numbers of the words that each unit asks of this shard; unknown ones have none in training text."""
    keys, numbers = np.empty(0, np.uint64), np.empty(0, np.uint32)
    if known.num_rows:
        keys, numbers = unpacked_ascending(known["keys"][0].as_py(), np.uint64), unpacked(known["numbers"][0].as_py(), np.uint32)
    rows = []
    for unit, shard, blob in zip(*(asked[c].to_pylist() for c in ("unit", "shard", "keys"))):
        some, place = _looked_up(keys, unpacked_ascending(blob, np.uint64))
        answer = np.full(len(some), UNKNOWN, np.uint32)
        answer[some] = numbers[place[some]]
        rows.append((unit, shard, packed(answer)))
    return _table(rows, unit=pa.int64(), shard=pa.int32(), numbers=pa.binary())


def _words(unit: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The numbers of a unit's different words, its words as places among these, and the documents' lengths."""
    lengths = unpacked(unit["lengths"][0].as_py(), np.uint32).astype(np.int64)
    numbers = np.concatenate([np.empty(0, np.uint32)] + [unpacked(x, np.uint32) for x in unit["numbers"][0].as_py() or []])
    return numbers, _text(unit, len(numbers)), lengths


def _before(words: np.ndarray, lengths: np.ndarray, begin: int, start: int = 0, stop: int | None = None) -> np.ndarray:
    """The word before each word of documents of these lengths, or before those from ``start`` to ``stop``."""
    before = np.empty(len(words[start:stop]), words.dtype)
    before[:1] = words[start - 1] if start else begin
    before[1:] = words[start:stop][:-1]
    begins = (np.cumsum(lengths) - lengths)[lengths > 0] - start
    before[begins[(begins >= 0) & (begins < len(before))]] = begin
    return before


def _pairs(numbers: np.ndarray, text: np.ndarray, lengths: np.ndarray, start: int = 0, stop: int | None = None) -> np.ndarray:
    """The pair of each word, or those from ``start`` to ``stop``, and the one before it as one number."""
    pairs = np.append(numbers, np.uint32(BEGIN))[_before(text, lengths, len(numbers), start, stop)].astype(np.uint64)
    pairs <<= np.uint64(32)
    pairs |= numbers[text[start:stop]]
    return pairs


def _distinct(values: np.ndarray) -> np.ndarray:
    """Different values, ascending, in little memory: the array itself is sorted."""
    values.sort()
    return values[np.append(True, values[1:] != values[:-1])[: len(values)]]


def _split(pairs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return pairs >> np.uint64(32), pairs & np.uint64(0xFFFFFFFF)


def packed_pairs(pairs: np.ndarray) -> bytes:
    """Ascending different pairs by the steps of their first words, and of second words after the same first one."""
    before, word = _split(pairs)
    step = np.diff(before, prepend=np.uint64(0))
    return packed(step << np.uint64(32) | np.where(step == 0, np.diff(word, prepend=np.uint64(0)), word))


def unpacked_pairs(blob: bytes) -> np.ndarray:
    step, word = _split(unpacked(blob, np.uint64))
    starts = np.flatnonzero(step)  # the first word of the first pair is not 0, the unknown word
    total = np.cumsum(word)
    total -= np.repeat(total[starts] - word[starts], np.diff(np.append(starts, len(word))))
    return np.cumsum(step) << np.uint64(32) | total


def _owner(numbers: np.ndarray, shards: int) -> np.ndarray:
    """The shard of words by their numbers."""
    return (numbers + np.uint64(shards - FIRST % shards)) % np.uint64(shards)


def _shard(pairs: np.ndarray, shards: int) -> np.ndarray:
    """The first word's, so that a shard's pairs are near each other; a frequent first word's are spread by the second.

    Pairs with an unknown word are not in training text: they have the number beyond all shards.
    """
    numbers = pairs >> np.uint64(32)
    unknown = (numbers == UNKNOWN) | (pairs.astype(np.uint32) == UNKNOWN)
    frequent = numbers < FIRST + FREQUENT * shards
    numbers[frequent] = pairs[frequent] & np.uint64(0xFFFFFFFF)
    numbers = _owner(numbers, shards)
    numbers[unknown] = shards
    return numbers


def _pair_counts(shards: int):
    """Different pairs of a unit's training documents and their counts, per shard."""

    def run(key: tuple, unit: pa.Table) -> pa.Table:
        words = _words(unit)
        found, counts = np.unique(_pairs(*words)[_in_training(unit["train"][0].as_py() or [], words[2])], return_counts=True)
        rows = [(s, packed_pairs(found[at]), packed(counts[at].astype(np.uint32))) for s, at in by_shard(_shard(found, shards), shards)]
        return _table(rows, shard=pa.int32(), pairs=pa.binary(), counts=pa.binary())

    return run


def _summed(key: tuple, table: pa.Table) -> pa.Table:
    """A shard of the model: its pairs and their counts over all units, and how many are seen 1 to 4 times."""
    pairs = np.concatenate([unpacked_pairs(x) for x in table["pairs"].to_pylist()])
    counts = np.concatenate([unpacked(x, np.uint32) for x in table["counts"].to_pylist()])
    found, place = np.unique(pairs, return_inverse=True)
    total = np.bincount(place, counts, len(found)).astype(np.uint64)
    times = [int((total == n).sum()) for n in (1, 2, 3, 4)]
    rows = [(key[0].as_py(), packed_pairs(found), packed(total), times)]
    return _table(rows, shard=pa.int32(), pairs=pa.binary(), counts=pa.binary(), times=pa.list_(pa.int64()))


def word_sums(pairs: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The words of different pairs, ascending, and the ``SUMS`` of each."""
    before, word = _split(pairs)
    words, place = np.unique(np.concatenate([before, word]), return_inverse=True)
    first, second = place[: len(pairs)], place[len(pairs) :]
    columns = [np.bincount(first, w, len(words)) for w in (np.maximum(counts, 3) - 3, counts == 1, counts == 2, counts > 2)]
    return words, np.array([*columns, np.bincount(second, minlength=len(words))]).astype(np.uint64)


def _word_sums(shards: int):
    """The sums of each shard of pairs, sent to the shards of the words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for pairs, counts in zip(batch.column("pairs").to_pylist(), batch.column("counts").to_pylist()):
                words, sums = word_sums(unpacked_pairs(pairs), unpacked(counts, np.uint64))
                rows = [(s, packed_ascending(words[at]), packed(sums[:, at].reshape(-1))) for s, at in by_shard(_owner(words, shards), shards)]
                yield from _table(rows, shard=pa.int32(), words=pa.binary(), sums=pa.binary()).to_batches()

    return run


def _word_model(key: tuple, table: pa.Table) -> pa.Table:
    """A shard of words and their sums over all shards of pairs; and what is needed of all words together."""
    words = np.concatenate([unpacked_ascending(x, np.uint64) for x in table["words"].to_pylist()])
    parts = np.concatenate([unpacked(x, np.uint64).reshape(SUMS, -1) for x in table["sums"].to_pylist()], axis=1)
    found, place = np.unique(words, return_inverse=True)
    sums = np.array([np.bincount(place, part, len(found)) for part in parts]).astype(np.uint64)
    rows = [(key[0].as_py(), packed_ascending(found), packed(sums.reshape(-1)), facts(found, sums))]
    return _table(rows, shard=pa.int32(), words=pa.binary(), sums=pa.binary(), facts=pa.list_(pa.int64()))


def facts(words: np.ndarray, sums: np.ndarray) -> list[int]:
    """Counts that add up over shards: words, pairs, words after 1 to 4 and after 3 or more different words, and
    the sums of the beginning of a text."""
    before = sums[-1]
    begin = sums[:4, words == BEGIN].sum(axis=1)
    return [int(x) for x in ((words != BEGIN).sum(), before.sum(), *((before == n).sum() for n in (1, 2, 3, 4)), (before > 2).sum(), *begin)]


#: The length of ``facts``.
FACTS = 11


def discounts(times: list[int]) -> tuple[float, float, float]:
    """Those of modified Kneser-Ney for what is seen once, twice and more often, from how much is seen 1 to 4 times.

    Where there is too little to estimate them, half of the count of one is taken.
    """
    if not all(times):
        return 0.5, 0.5, 0.5
    share = times[0] / (times[0] + 2 * times[1])
    found = [n - (n + 1) * share * times[n] / times[n - 1] for n in (1, 2, 3)]
    return tuple(min(max(d, 0.0), float(n)) for n, d in enumerate(found, 1))


def discounted(counts: np.ndarray, by: tuple[float, float, float]) -> np.ndarray:
    return np.maximum(counts - np.array([0.0, *by])[np.minimum(counts, 3)], 0.0)


def constants(times: list[int], all_facts: list[int]) -> dict:
    """What holds for all words: discounts, the number of pairs, the share left for any word, the beginning's sums."""
    known, pairs, *after, third = all_facts[:7]
    single = discounts(after)
    left = single[0] * after[0] + single[1] * after[1] + single[2] * third
    share = (left / pairs if pairs else 1.0) / (known + 1)
    return {"pair": discounts(times), "single": single, "pairs": max(1, pairs), "share": share, "begin": all_facts[7:]}


def lower(before: np.ndarray, held: dict) -> np.ndarray:
    """The probability of words by the number of different words before them, and the rest evenly over all words."""
    return discounted(before, held["single"]) / held["pairs"] + held["share"]


def totals(sums: np.ndarray) -> np.ndarray:
    """How often any word follows words of these sums."""
    return sums[0] + sums[1] + 2 * sums[2] + 3 * sums[3]


def given(sums: np.ndarray, held: dict) -> np.ndarray:
    """The share that pairs leave to single words, after words of these sums."""
    one, two, more = held["pair"]
    total = totals(sums)
    return np.where(total > 0, (one * sums[1] + two * sums[2] + more * sums[3]) / np.maximum(total, 1), 1.0)


def log_probabilities(counts: np.ndarray, total: np.ndarray, share: np.ndarray, word: np.ndarray, held: dict) -> np.ndarray:
    """Of pairs with these counts: of the word before, its total and ``given``, and the word's ``lower``."""
    return np.log(discounted(counts, held["pair"]) / np.maximum(total, 1) + share * word)


def _asked(shards: int):
    def run(key: tuple, unit: pa.Table) -> pa.Table:
        found = _distinct(_pairs(*_words(unit)))
        rows = [(s, key[0].as_py(), packed_pairs(found[at])) for s, at in by_shard(_shard(found, shards), shards)]
        return _table(rows, shard=pa.int32(), unit=pa.int64(), asked=pa.binary())

    return run


def _counts(key: tuple, asked: pa.Table, model: pa.Table) -> pa.Table:
    """The counts of the pairs that each unit asks of this shard."""
    pairs, counts = np.empty(0, np.uint64), np.empty(0, np.uint64)
    if model.num_rows:
        pairs, counts = unpacked_pairs(model["pairs"][0].as_py()), unpacked(model["counts"][0].as_py(), np.uint64)
    rows = []
    for unit, shard, blob in zip(*(asked[c].to_pylist() for c in ("unit", "shard", "asked"))):
        some, place = _looked_up(pairs, unpacked_pairs(blob))
        answer = np.zeros(len(some), np.uint64)
        answer[some] = counts[place[some]]
        rows.append((unit, shard, True, packed(answer)))
    return _table(rows, unit=pa.int64(), shard=pa.int32(), pair=pa.bool_(), answer=pa.binary())


def _sums(key: tuple, asked: pa.Table, model: pa.Table) -> pa.Table:
    """The sums of the words that each unit has of this shard; an unknown word's are zero."""
    words, sums = np.empty(0, np.uint64), np.empty((SUMS, 0), np.uint64)
    if model.num_rows:
        words, sums = unpacked_ascending(model["words"][0].as_py(), np.uint64), unpacked(model["sums"][0].as_py(), np.uint64).reshape(SUMS, -1)
    rows = []
    for unit, shard, blob in zip(*(asked[c].to_pylist() for c in ("unit", "shard", "numbers"))):
        some, place = _looked_up(words, unpacked(blob, np.uint32).astype(np.uint64))
        answer = np.zeros((SUMS, len(some)), np.uint64)
        answer[:, some] = sums[:, place[some]]
        rows.append((unit, shard, False, packed(answer.reshape(-1))))
    return _table(rows, unit=pa.int64(), shard=pa.int32(), pair=pa.bool_(), answer=pa.binary())


def _scored(shards: int, held: dict):
    def run(key: tuple, unit: pa.Table, answers: pa.Table) -> pa.Table:
        numbers, text, lengths = _words(unit)
        by_kind = {True: {}, False: {}}
        for pair, shard, blob in zip(*(answers[c].to_pylist() for c in ("pair", "shard", "answer"))):
            by_kind[pair][shard] = blob
        words = (unpacked(by_kind[False][s], np.int64).reshape(SUMS, -1) for s in sorted(by_kind[False]))
        sums = np.concatenate([*words, np.array([[x] for x in (*held["begin"], 0)], np.int64)], axis=1)
        total, shares, lowers = totals(sums), given(sums, held), lower(sums[-1], held)
        found = _distinct(_pairs(numbers, text, lengths))
        counts = np.zeros(len(found), np.int64)
        for s, at in by_shard(_shard(found, shards), shards):
            counts[at] = unpacked(by_kind[True][s], np.int64)
        logs = np.zeros(len(text) + 1)
        for start in range(0, len(text), PART_WORDS):
            part = start, start + PART_WORDS
            some, place = np.unique(_pairs(numbers, text, lengths, *part), return_inverse=True)
            place = np.searchsorted(found, some)[place]
            before = _before(text, lengths, sums.shape[1] - 1, *part)
            logs[1:][slice(*part)] = log_probabilities(counts[place], total[before], shares[before], lowers[text[slice(*part)]], held)
        np.cumsum(logs, out=logs)
        ends = np.cumsum(lengths)
        return pa.table({"doc_id": unit["doc_ids"][0].values, "lang": unit["langs"][0].values, "n_words": pa.array(lengths), "log_probability": pa.array(logs[ends] - logs[ends - lengths])})

    return run


def good_documents(labels: DataFrame) -> DataFrame:
    """doc_id of the documents all of whose labels are of quality 1."""
    named = labels.where("doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id"))
    return named.agg(F.min("quality").alias("least"), F.max("quality").alias("most"), F.count_if(F.col("quality").isNull()).alias("open")).where("least = 1 and most = 1 and open = 0").select("doc_id")


def with_held(good: DataFrame) -> DataFrame:
    """doc_id, and whether the document is held out."""
    return good.withColumn("held", F.pmod(F.xxhash64("doc_id"), F.lit(HELD_OUT)) == 0)


def scores(docs: DataFrame, good: DataFrame, unit_bytes: int = UNIT_BYTES) -> tuple[DataFrame, DataFrame]:
    """doc_id, lang, n_words and log_probability of every row of ``docs``; and doc_id of the good documents held out.

    ``good``: doc_id and held of the good documents, one row each.
    """
    shards = tasks(docs.sparkSession)
    units, buckets = _units(docs, unit_bytes)
    places = units.select(F.col("unit").alias("owner"), F.posexplode("doc_ids").alias("place", "doc_id"))
    chosen = places.join(good.where("not held"), "doc_id").select("owner", "place")

    # Words: numbered in shards, then the numbers of each unit's words.
    counted = units.select("unit", "lengths", "codes", "common", "asks").groupBy("unit").cogroup(chosen.groupBy("owner"))
    counted = counted.applyInArrow(_word_counts, "shard int, keys binary, counts binary")
    words = counted.groupBy("shard").applyInArrow(_numbered(shards), "shard int, keys binary, numbers binary")
    asked = units.select("unit", F.inline("asks")).groupBy("shard").cogroup(words.groupBy("shard"))
    answers = asked.applyInArrow(_numbers, "unit long, shard int, numbers binary").repartition(buckets, "unit")
    own = answers.groupBy("unit").agg(F.array_sort(F.collect_list(F.struct("shard", "numbers"))).alias("words"))
    train = chosen.groupBy(F.col("owner").alias("unit")).agg(F.collect_list("place").alias("train"))
    own = stage_buckets(own.join(train, "unit", "left"), "unit-words", "unit", buckets)
    units = units.drop("asks").join(own.select("unit", F.col("words.numbers").alias("numbers"), "train"), "unit", "left")

    # Pairs: counted in shards; the sums of words from them, in the shards of the words.
    sent = units.select("unit", "lengths", "codes", "common", "numbers", "train").groupBy("unit")
    sent = sent.applyInArrow(_pair_counts(shards), "shard int, pairs binary, counts binary")
    model = stage(sent.groupBy("shard").applyInArrow(_summed, "shard int, pairs binary, counts binary, times array<long>"), "pairs")
    sums = model.select("pairs", "counts").mapInArrow(_word_sums(shards), "shard int, words binary, sums binary")
    sums = stage(sums.groupBy("shard").applyInArrow(_word_model, "shard int, words binary, sums binary, facts array<long>"), "word-sums")
    times = [x or 0 for x in model.agg(*[F.sum(F.col("times")[i]) for i in range(4)]).first()]
    held = constants(times, [x or 0 for x in sums.agg(*[F.sum(F.col("facts")[i]) for i in range(FACTS)]).first()])

    # Scores: each unit gets the counts of its pairs and the sums of its words.
    asked = units.select("unit", "lengths", "codes", "common", "numbers").groupBy("unit").applyInArrow(_asked(shards), "shard int, unit long, asked binary")
    schema = "unit long, shard int, pair boolean, answer binary"
    counts = asked.groupBy("shard").cogroup(model.groupBy("shard")).applyInArrow(_counts, schema)
    answers = counts.unionAll(own.select("unit", F.inline("words")).groupBy("shard").cogroup(sums.groupBy("shard")).applyInArrow(_sums, schema))
    schema = "doc_id long, lang string, n_words long, log_probability double"
    scored = units.drop("train").groupBy("unit").cogroup(answers.groupBy("unit")).applyInArrow(_scored(shards, held), schema)
    return stage(scored, "scores"), good.where("held").select("doc_id")


def classify(docs: DataFrame, labels: DataFrame, quantile: float = QUANTILE, prior: int = PRIOR_WORDS, **options) -> DataFrame:
    """A row for each row of ``docs``: doc_id, lang, n_words, perplexity, evened, threshold, kept.

    perplexity is of the text under the model of good text, null without words; evened is the one that
    is compared, pulled to the language's mean as if ``prior`` more words had it. A document is kept
    unless its evened perplexity is above the threshold of its language, which is the ``quantile`` of
    held-out good documents; so are documents without words, and all if nothing is held out. Null
    languages are a language of their own. A language with few held-out documents takes the quantile
    of all of them. Rows repeated with one doc_id each have a row. An empty table gives an empty result.
    """
    return _judged(docs, with_held(good_documents(labels)), quantile, prior, **options)


def _judged(docs: DataFrame, good: DataFrame, quantile: float = QUANTILE, prior: int = PRIOR_WORDS, **options) -> DataFrame:
    """The same by the good documents, as ``scores`` takes them."""
    scored, held = scores(docs, good, **options)
    # Null is a language apart from the empty one: every named one has a sign more.
    language = F.coalesce(F.concat(F.lit("="), "lang"), F.lit(""))
    scored = scored.withColumn("language", language)
    known = scored.where("n_words > 0").join(held, "doc_id", "left_semi").select("language", "n_words", "log_probability")
    known = stage(known, "held-out")
    mean = (F.sum("log_probability") / F.sum("n_words")).alias("mean")
    every = known.agg(mean.alias("every_mean"))
    means = known.groupBy("language").agg(mean, F.count(F.lit(1)).alias("n")).where(F.col("n") >= LANGUAGE_ROWS).select("language", "mean")

    def evened(table: DataFrame) -> DataFrame:
        with_means = table.join(means, "language", "left").join(F.broadcast(every))  # one row
        centre = F.round(F.coalesce("mean", "every_mean"), 9)
        value = F.exp(-(F.col("log_probability") + prior * centre) / (F.col("n_words") + prior))
        return with_means.withColumn("evened", value).drop("every_mean")

    compared = evened(known)
    limit = F.percentile_approx("evened", F.lit(quantile), F.lit(10_000)).alias("limit")
    limits = compared.where("mean is not null").groupBy("language").agg(limit)
    common = compared.agg(limit.alias("every_limit"))
    judged = evened(scored).join(limits, "language", "left").join(F.broadcast(common))
    judged = judged.withColumn("threshold", F.coalesce("limit", "every_limit"))
    some = F.col("n_words") > 0
    return judged.select(
        "doc_id",
        "lang",
        "n_words",
        F.when(some, F.exp(-F.col("log_probability") / F.col("n_words"))).alias("perplexity"),
        F.when(some, F.col("evened")).alias("evened"),
        "threshold",
        F.coalesce(~some | (F.col("evened") <= F.col("threshold")), F.lit(True)).alias("kept"),
    )


def without_rejected(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns.

    Each row has the verdict that ``classify`` gives it, also without a doc_id or with one that others have.
    """
    key = fresh(docs, "row_key")
    rows = stage(docs.withColumn(key, F.monotonically_increasing_id()), "quality-rows")
    ids = rows.select(F.col(key).alias("row"), F.col("doc_id").cast("long").alias("doc_id"))
    good = ids.join(with_held(good_documents(labels)), "doc_id").select(F.col("row").alias("doc_id"), "held")
    judged = _judged(rows.select(F.col(key).alias("doc_id"), "text", "lang"), stage(good, "good-rows"), **options)
    rejected = judged.where("not kept").select(F.col("doc_id").alias(key))
    return rows.join(rejected, key, "left_anti").select(docs.columns)
