"""The operators for training data against brute force, on small tables with the awkward cases."""

import hashlib
import math
import random
import re
import textwrap
import tracemalloc
import zlib
from collections import Counter, defaultdict
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from lateline.llm import components, exact, hamming, jaccard, license_texts, licenses, mixing, neighbours, packing, preferences, quality, simhash, substrings, token_files, tokens
from lateline.llm.common import let_go
from lateline.sources.staging import shared_folder
from tests.plans import physical_plan

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, size string, `rank` string, node long"


def words_of(text):
    return WORD.findall(text or "")


def sentence(rng, n, most=400):
    return " ".join(f"w{int(most * rng.random() ** 2)}" for _ in range(n))


@pytest.fixture(scope="module")
def rows():
    """Null and empty texts, ties, repeated rows, copies, a very long text, shared passages, odd white space."""
    rng = random.Random(7)
    texts = [sentence(rng, rng.randint(1, 120)) for _ in range(150)]
    passage = sentence(rng, 45)
    texts += [f"{sentence(rng, 9)} {passage} {sentence(rng, i)}" for i in range(12)]
    texts += [texts[3]] * 40 + [texts[4].upper()] + [None, "", " \t\n", None, "one", "A b c\x0bd", "café Ǩ <|endoftext|> 0 100 it's"]
    texts += [sentence(rng, 60_000, 5000), " ".join(["again"] * 300)]
    texts += [texts[10] + " more", texts[11] + " and more"]
    made = [(i, t, ["en", "de", None][i % 3], ["a", "b", None, "a", "a"][i % 5], "x", "y", 1) for i, t in enumerate(texts)]
    return made + [made[5], made[5], (None, "without an id", None, None, None, None, None), (None, None, "en", "a", None, None, None)]


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(5)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def collected(table):
    return Counter(tuple(r) for r in table.collect())


# --- mixing ---


def test_targets():
    assert mixing.targets([100, 100, 100], [1, 2, 3]) == [50, 100, 150]
    assert mixing.targets([10, 1000], [3, 1]) == [30, 980]
    assert mixing.targets([0, 5], [1, 1]) == [0, 5] and mixing.targets([], []) == []


def test_mix(docs, rows):
    got = mixing.mix(docs, block_rows=50).collect()
    assert Counter((r.doc_id, r.size) for r in got) == Counter((r[0], len(words_of(r[1]))) for r in rows)
    by = defaultdict(list)
    for r in got:
        by[r.source].append(r)
        assert 0 <= r.taken <= 3 * r.size and r.taken == r.copies * r.size
    names = sorted(by, key=lambda s: (s is None, s or ""))
    sizes = [sum(r.size for r in by[s]) for s in names]
    goals = mixing.targets(sizes, [1, 2, 3])
    for name, size, goal in zip(names, sizes, goals):
        assert {(r.source_size, r.target) for r in by[name]} == {(size, goal)}
        # The rates solve the dual: exponential in the size, and their words meet the target.
        assert sum(r.rate * r.size for r in by[name]) == pytest.approx(goal, rel=1e-6)
        tilt = {round(math.log(r.rate) / r.size, 7) for r in by[name] if r.size and 1e-9 < r.rate < 2.999 and r.size < 1000}
        assert len(tilt) <= 2
    assert collected(mixing.mix(docs, block_rows=50).select("doc_id", "taken")) == Counter((r.doc_id, r.taken) for r in got)


def test_rows_of_one_id_are_rounded_in_many_blocks(spark, monkeypatch):
    rng = random.Random(29)
    table = spark.createDataFrame([(None if i % 2 else 7, sentence(rng, rng.randint(1, 40)), "s") for i in range(2000)], "doc_id long, text string, source string")
    largest, real = spark.sparkContext.accumulator(0), mixing._rounded

    def counted(most):
        inner = real(most)

        def run(key, rows):
            largest.add(max(0, rows.num_rows - 250))
            return inner(key, rows)

        return run

    monkeypatch.setattr(mixing, "_rounded", counted)
    got = mixing.mix(table, block_rows=100).collect()
    assert len(got) == 2000 and largest.value == 0


def test_mix_is_near_its_targets(spark):
    rng = random.Random(3)
    table = spark.createDataFrame([(i, " ".join(["x"] * int(rng.lognormvariate(4, 1))), f"s{min(int(rng.random() * 9), 5)}") for i in range(3000)], "doc_id long, text string, source string")
    for r in mixing.mix(table, block_rows=200).groupBy("source").agg({"taken": "sum", "target": "max"}).collect():
        assert r["sum(taken)"] == pytest.approx(r["max(target)"], rel=0.01)


def test_mixed_rows_are_the_copies(docs):
    taken = {}
    for r in mixing.mix(docs).collect():
        taken.setdefault(r.doc_id, []).append(r.copies)
    mixed = mixing.mixed_rows(docs)
    assert mixed.columns == docs.columns
    got = Counter(r.doc_id for r in mixed.collect())
    assert got == Counter({d: math.ceil(sum(c) / len(c)) * len(c) for d, c in taken.items() if sum(c)})


def test_mixed_rows_without_ids_meet_the_targets(spark):
    rng = random.Random(23)
    made = [(i if i % 3 else None if i % 2 else i % 7, sentence(rng, rng.randint(20, 60)), f"s{i % 4 and 1}") for i in range(1200)]
    table = spark.createDataFrame(made, "doc_id long, text string, source string").repartition(4)
    goals = {r["source"]: r["target"] for r in mixing.mix(table).select("source", "target").distinct().collect()}
    got, words = mixing.mixed_rows(table).collect(), Counter()
    for r in got:
        words[r.source] += len(words_of(r.text))
    assert max(Counter(tuple(r) for r in got).values()) <= 3
    for source, goal in goals.items():
        assert words[source] == pytest.approx(goal, abs=61)
    taken = {tuple(r)[:2]: r.taken for r in mixing.mix(table).groupBy("doc_id", "source").agg(F.sum("taken").alias("taken")).collect()}
    by_id = Counter()
    for r in got:
        by_id[r.doc_id, r.source] += len(words_of(r.text))
    assert by_id == Counter({k: n for k, n in taken.items() if n})


# --- SimHash ---


def plain_fingerprint(text, size=3):
    found = [c.lower() if "A" <= c <= "Z" else c for c in text or ""]
    found = words_of("".join(found))
    runs = [" ".join(found[i : i + size]) for i in range(len(found) - size + 1)] or ([" ".join(found)] if found else [])
    hashes = [xxhash.xxh64_intdigest(r.encode(), 42) for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def least_reachable(nodes, linked):
    least = {n: n for n in nodes}
    changed = True
    while changed:
        changed = False
        for a, b in linked:
            low = min(least[a], least[b])
            if least[a] != low or least[b] != low:
                least[a] = least[b] = low
                changed = True
    return least


@pytest.mark.parametrize("split", [2, 4096])
def test_near_groups(docs, rows, split):
    prints = {r[0]: plain_fingerprint(r[1]) for r in rows if r[0] is not None}
    near = [(a, b) for a in prints for b in prints if a < b and (prints[a] ^ prints[b]).bit_count() <= 2]
    least = least_reachable(prints, near)
    got = collected(simhash.near_groups(docs, split=split).where("doc_id is not null"))
    repeats = Counter(r[0] for r in rows if r[0] is not None)
    assert got == Counter({(d, f"{prints[d]:016x}", least[d]): repeats[d] for d in prints})
    without = simhash.near_groups(docs, split=split).where("doc_id is null").collect()
    zero = least[next(d for d, p in prints.items() if p == 0)]
    assert sorted((r.component_id is None, r.component_id) for r in without) == [(False, zero), (True, None)]


@pytest.mark.parametrize("distance, words", [(0, 1), (2, 1), (3, 2), (9, 2)])
def test_stars_connect_what_links_do(distance, words):
    rng = np.random.default_rng(distance)
    base = rng.integers(0, 1 << 63, (20, words), np.uint64)
    prints = np.unique(np.concatenate([base] + [base ^ (np.uint64(1) << rng.integers(0, 63, base.shape).astype(np.uint64)) for _ in range(30)]), axis=0)
    bucket = rng.integers(0, 3, len(prints))
    a, b = hamming.stars(bucket, prints, distance)
    near = [(i, j) for i in range(len(prints)) for j in range(i) if bucket[i] == bucket[j] and hamming.differing(prints[i : i + 1] ^ prints[j : j + 1])[0] <= distance]
    wanted, got = least_reachable(range(len(prints)), near), least_reachable(range(len(prints)), list(zip(a.tolist(), b.tolist())))
    assert wanted == got


def test_gray_rank():
    codes = np.arange(64, dtype=np.uint64)
    assert hamming.gray_rank(codes ^ (codes >> np.uint64(1))).tolist() == codes.tolist()


def test_components(spark):
    rng = random.Random(5)
    linked = [(rng.randint(0, 300), rng.randint(0, 300)) for _ in range(200)] + [(i, i + 1) for i in range(1000, 1100)] + [(7, 7), (2000, 5), (2000, 5)]
    got = dict(tuple(r) for r in components.components(spark.createDataFrame(linked, "a long, b long")).collect())
    nodes = {n for pair in linked if pair[0] != pair[1] for n in pair}
    assert got == least_reachable(nodes, [p for p in linked if p[0] != p[1]])


@pytest.mark.parametrize("order", ["rising", "mixed", "halves"])
def test_components_of_a_path_take_few_rounds(spark, monkeypatch, order):
    path = list(range(1000))
    if order == "mixed":
        random.Random(3).shuffle(path)
    if order == "halves":
        path = [i // 2 + 500 * (i % 2) for i in range(1000)]
    rounds, real = [], components.stage
    monkeypatch.setattr(components, "stage", lambda table, name: rounds.append(name) or real(table, name))
    linked = spark.createDataFrame(list(zip(path, path[1:])), "a long, b long")
    got = components.components(linked)
    assert {tuple(r) for r in got.collect()} == {(i, 0) for i in path}
    assert rounds.count("labels") <= 12 and rounds.count("parents") <= 24


def test_near_groups_without_ids(spark):
    """Many fingerprints without any id: null groups, and none of them joined with others."""
    texts = [f"a{i} b{i} c{i} d{i}" for i in range(400)]
    made = [(None, t) for t in texts] + [(i, t) for i, t in enumerate(texts[:40])]
    got = simhash.near_groups(spark.createDataFrame(made, "doc_id long, text string").repartition(3)).collect()
    prints = {t: plain_fingerprint(t) for t in texts}
    near = [(a, b) for a in texts for b in texts if a < b and (prints[a] ^ prints[b]).bit_count() <= 2]
    least, ids = least_reachable(texts, near), {}
    for i, t in enumerate(texts[:40]):
        ids.setdefault(least[t], i)
    wanted = Counter((d, f"{prints[t]:016x}", ids.get(least[t])) for d, t in made)
    assert Counter(tuple(r) for r in got) == wanted


def test_near_copies_stage(spark):
    rng = random.Random(11)
    base = [sentence(rng, 200, 5000).split() for _ in range(30)]
    texts = [" ".join(b) for b in base]
    for b in base[:10]:
        copy = list(b)
        copy[50], copy[150] = "other", "words"
        texts.append(" ".join(copy))
    table = spark.createDataFrame([(i, t, "extra") for i, t in enumerate(texts)] + [(None, texts[0], "n")], "doc_id long, text string, node string")
    kept = jaccard.without_near_copies(table)
    assert kept.columns == table.columns
    assert sorted(r.doc_id for r in kept.where("doc_id is not null").collect()) == list(range(30)) and kept.count() == 31


def plain_similarity(a, b):
    def runs(text):
        found = words_of((text or "").lower())
        return {tuple(found[i : i + 5]) for i in range(len(found) - 4)} or {tuple(found)}

    a, b = runs(a), runs(b)
    return Fraction(len(a & b), len(a | b))


def test_near_copies_around_the_similarity(spark):
    """Four changed words of 184 are a similarity of just 0.8, three 0.85 and five 0.76; repeats count once."""
    rng = random.Random(17)
    texts = [None, " \t", "short text", "Short  text", "short words"]
    for i in range(120):
        base = [f"v{i}x{j}" for j in range(184)]
        copy = list(base)
        for at in rng.sample(range(5, 180, 6), 3 + i % 3):
            copy[at] = f"other{i}x{at}"
        texts += [" ".join(base), " ".join(copy)]
    line = "the same line again and again in every text "
    texts += [line * 40 + " ".join(f"t{i}x{j}" for j in range(60)) for i in range(30)]
    chain = [f"c{j}" for j in range(184)]
    for i in range(6):  # each is near to the next, not to those after
        texts.append(" ".join(chain))
        chain[20 * i + 10] = chain[20 * i + 20] = chain[20 * i + 15] = f"new{i}"
    near = [(i, j) for i in range(len(texts)) for j in range(i) if plain_similarity(texts[i], texts[j]) >= Fraction(4, 5)]
    found = Counter(plain_similarity(texts[i], texts[j]) for i, j in near)
    assert found[Fraction(4, 5)] == 40
    least = least_reachable(range(len(texts)), near)
    table = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    kept = jaccard.without_near_copies(table)
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(least.values()))
    assert jaccard.without_near_copies(table.limit(0)).count() == 0


def test_a_group_of_near_copies_is_not_paired_row_by_row(spark, monkeypatch):
    """About half of all pairs are similar: as many confirmed links would grow with the square of the group."""
    rng, base = random.Random(23), [f"v{j}" for j in range(184)]
    texts = [" ".join(f"other{i}x{j}" if j in changed else w for j, w in enumerate(base)) for i in range(200) for changed in [set(rng.sample(range(184), 2))]]
    near = [(i, j) for i in range(200) for j in range(i) if plain_similarity(texts[i], texts[j]) >= Fraction(4, 5)]
    least = least_reachable(range(200), near)
    checked, confirmed = jaccard._checked, []

    def counted(pairs, rows):
        found = checked(pairs, rows)
        confirmed.append(found.count())
        return found

    monkeypatch.setattr(jaccard, "_checked", counted)
    kept = jaccard.without_near_copies(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3))
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(least.values()))
    assert len(near) > 6000 > 2000 > sum(confirmed)


def test_rows_at_the_edge_of_a_group_are_not_paired_row_by_row(spark, monkeypatch):
    """Each is near to a text that is not there, and few are similar: 19,900 pairs share shingles and have the sizes for it."""
    rng, base = random.Random(31), [f"v{j}" for j in range(184)]
    texts = [" ".join(f"other{i}x{j}" if j in changed else w for j, w in enumerate(base)) for i in range(200) for changed in [set(rng.sample(range(184), 3))]]
    near = [(i, j) for i in range(200) for j in range(i) if plain_similarity(texts[i], texts[j]) >= Fraction(4, 5)]
    least = least_reachable(range(200), near)
    checked, compared = jaccard._checked, []

    def counted(pairs, rows):
        compared.append(pairs.distinct().count())
        return checked(pairs, rows)

    monkeypatch.setattr(jaccard, "_checked", counted)
    kept = jaccard.without_near_copies(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3))
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(least.values()))
    assert compared[-1] < 2 * len(near) + 200 < 5000


def test_comparing_pairs_shuffles_no_other_texts(spark, monkeypatch):
    """Rows lie in buckets, and those of pairs are picked where they are."""
    rng, plans, stage = random.Random(41), [], jaccard.stage
    base = [sentence(rng, 200, 900) for _ in range(20)]
    table = spark.createDataFrame(list(enumerate(base + [b + " more" for b in base[:5]])), "doc_id long, text string")

    def noted(table, name):
        if name == "near-pairs":
            plans.append(physical_plan(table))
        return stage(table, name)

    monkeypatch.setattr(jaccard, "stage", noted)
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        kept = jaccard.without_near_copies(table)
        assert sorted(r.doc_id for r in kept.collect()) == list(range(20))
        assert "Bucketed: true" in physical_plan(kept)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    assert plans and all(p.count("LeftSemi") == p.count("Bucketed: true") == 2 for p in plans)


def test_sketches_never_differ_in_more_bits_than_shingles(spark):
    """Also of texts with more shingles than bits."""
    rng = random.Random(37)
    texts = [sentence(rng, n, 900) for n in (0, 3, 50, 400, 3000) for _ in range(2)] + [None]
    texts += [t + " and more" for t in texts[:-1]]
    table = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    sketches = {r.row: r.sketch for r in jaccard._sketches(table).collect()}
    sets = [jaccard.shingles((t or "").encode()) for t in texts]
    for i in range(len(texts)):
        for j in range(i):
            bits = sum(((x ^ y) % 2**64).bit_count() for x, y in zip(sketches[i], sketches[j]))
            assert bits <= len(sets[i] ^ sets[j])


def test_near_copies_begin_with_fingerprints(spark, monkeypatch):
    """The stage's first links are op2's: they connect just the rows that its groups do."""
    rng = random.Random(29)
    base = [sentence(rng, 200, 900) for _ in range(20)]
    table = spark.createDataFrame(list(enumerate(base + [b + " more" for b in base] + base[:5] + [None, ""])), "doc_id long, text string")
    least = least_reachable(range(47), [tuple(r) for r in simhash.near_pairs(table).collect()])
    assert least == {r.doc_id: r.component_id for r in simhash.near_groups(table).collect()}
    assert len(set(least.values())) < 42
    called, pairs = [], simhash.near_pairs
    monkeypatch.setattr(jaccard.simhash, "near_pairs", lambda rows: called.append(rows) or pairs(rows))
    assert corpus_pipeline.near_copies(spark, table.withColumn("n_chars", F.lit(1)), "").count() == 21 and len(called) == 1


# --- substrings ---


def plain_repeats(rows, window):
    seen, out = set(), Counter()
    for doc_id, text in rows:
        found = words_of(text)
        gone = [False] * len(found)
        for i in range(len(found) - window + 1):
            key = tuple(found[i : i + window])
            if key in seen:
                gone[i : i + window] = [True] * window
            seen.add(key)
        kept = " ".join(w for w, g in zip(found, gone) if not g)
        out[doc_id, len(found), sum(gone), hashlib.sha256(kept.encode()).hexdigest()] += 1
    return out


@pytest.mark.parametrize("unit_bytes, window, block", [(2_000, 20, 10), (4_000_000, 20, 10), (5_000, 7, 4)])
def test_remove_repeats(docs, rows, unit_bytes, window, block):
    ordered = sorted(((r[0], r[1]) for r in rows), key=lambda r: (r[0] is None, r[0] or 0))
    got = collected(substrings.remove_repeats(docs, window, block, unit_bytes).drop("spans"))
    wanted = plain_repeats(ordered, window)
    assert {k: n for k, n in got.items() if k[0] is not None} == {k: n for k, n in wanted.items() if k[0] is not None}
    assert sum(got.values()) == len(rows)


def test_removed_spans(docs):
    for r in substrings.remove_repeats(docs).collect():
        assert sum(s.end - s.begin for s in r.spans) == r.n_removed and all(s.end - s.begin >= 20 for s in r.spans)


# --- exact copies ---


@pytest.mark.parametrize("most", [300, 48_000_000])
def test_exact_dedup(docs, rows, most):
    groups = defaultdict(list)
    for r in rows:
        groups[r[1] or ""].append(r[0])
    wanted = Counter()
    for text, ids in groups.items():
        keep = max((i for i in ids if i is not None), default=None)
        digest = hashlib.sha256(text.encode()).hexdigest()
        for doc_id, n in Counter(ids).items():
            for repeat in range(n):
                wanted[doc_id, keep, len(ids), doc_id == keep and not repeat, digest] += 1
    assert collected(exact.exact_dedup(docs, most)) == wanted
    kept = exact.without_copies(docs, most)
    assert kept.columns == docs.columns and Counter(r.text or "" for r in kept.collect()) == Counter(dict.fromkeys(groups, 1))


def test_texts_of_one_hash_stay_apart():
    records = [(5, b"a", 1, 1), (5, b"b", 2, 1), (5, b"a", 9, 1), (5, b"c" * 500, None, 1)]
    assert sorted(exact.merged(records, most=100)) == [(5, b"a", 9, 2), (5, b"b", 2, 1), (5, b"c" * 500, None, 1)]


# --- quality ---


def made_unit(rng, n_words, vocabulary, length):
    """A unit of documents of this length, with its words' numbers of one shard; and its words."""
    text = rng.integers(0, vocabulary, n_words).astype(np.uint32)
    lengths = np.append(np.full(n_words // length, length), [0, n_words % length]).astype(np.uint32)
    numbers = np.arange(vocabulary, dtype=np.uint32) + np.uint32(quality.FIRST)
    columns = {
        "doc_ids": pa.array([range(len(lengths))], pa.list_(pa.int64())),
        "langs": pa.array([["en"] * len(lengths)], pa.list_(pa.string())),
        "lengths": pa.array([quality.packed(lengths)]),
        "codes": pa.array([quality.packed(text)]),
        "common": pa.array([quality.packed(np.empty(0, np.uint32))]),
        "numbers": pa.array([[quality.packed(numbers)]], pa.list_(pa.binary())),
        "train": pa.array([range(0, len(lengths), 2)], pa.list_(pa.int64())),
    }
    return pa.table(columns), text, lengths


def test_pairs_of_parts_are_those_of_the_unit():
    unit, text, lengths = made_unit(np.random.default_rng(3), 1_003, 40, 25)
    starts = set((np.cumsum(lengths) - lengths)[lengths > 0].tolist())
    plain = [((quality.BEGIN if i in starts else int(text[i - 1]) + quality.FIRST) << 32) + int(text[i]) + quality.FIRST for i in range(len(text))]
    words = quality._words(unit)
    assert quality._pairs(*words).tolist() == plain
    for size in (1, 24, 25, 26, 500, 2_000):
        assert [p for s in range(0, len(text), size) for p in quality._pairs(*words, s, s + size).tolist()] == plain
    assert quality._distinct(np.array(plain, np.uint64)).tolist() == sorted(set(plain))
    assert not len(quality._distinct(np.empty(0, np.uint64)))


def test_a_unit_is_scored_in_little_memory():
    """Of each word one pair and a few numbers at a time, and a part's arrays; it was 75 bytes a word."""
    n, vocabulary, shards = 2_000_000, 2_000, 1
    unit, text, _ = made_unit(np.random.default_rng(5), n, vocabulary, 400)
    asked = quality._asked(shards)((pa.scalar(0),), unit)
    pairs = quality.unpacked_pairs(asked["asked"][0].as_py())
    counts = np.ones(len(pairs), np.uint64)
    words, sums = quality.word_sums(pairs, counts)
    held = quality.constants([1, 1, 1, 1], quality.facts(words, sums))
    rows = [(0, 0, True, quality.packed(counts)), (0, 0, False, quality.packed(sums[:, words != quality.BEGIN].reshape(-1)))]
    answers = quality._table(rows, unit=pa.int64(), shard=pa.int32(), pair=pa.bool_(), answer=pa.binary())
    del pairs, counts, words, sums, rows
    tracemalloc.start()
    try:
        scored = quality._scored(shards, held)((pa.scalar(0),), unit, answers)
        most = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert scored["n_words"].to_pylist()[0] == 400 and np.isfinite(scored["log_probability"].to_numpy()).all()
    assert most < 55 * n


def test_tasks_that_need_room_let_go_of_remembered_words():
    ids = tokens.text_ids(tokens.default_path())
    before = ids.ids([b"some words, and others"])
    assert ids.new
    let_go()
    assert not ids.new and not ids.old and ids.ids([b"some words, and others"]) == before


def test_log_probabilities_are_a_distribution():
    """Probabilities of all words after any word sum to one, the unknown word among them."""
    rng = np.random.default_rng(1)
    known = 40
    text = np.append(np.arange(known), rng.zipf(1.5, 3000).clip(1, known) - 1) + quality.FIRST
    pairs = (np.append(quality.BEGIN, text[:-1]).astype(np.uint64) << np.uint64(32)) | text.astype(np.uint64)
    found, counts = np.unique(pairs, return_counts=True)
    words, sums = quality.word_sums(found, counts)
    assert quality.totals(sums).sum() == len(text) and sums[-1].sum() == len(found)
    all_facts = quality.facts(words, sums)
    assert len(all_facts) == quality.FACTS and all_facts[:2] == [known, len(found)]
    held = quality.constants([int((counts == n).sum()) for n in (1, 2, 3, 4)], all_facts)
    lower = {w: x for w, x in zip(words.tolist(), quality.lower(sums[-1].astype(np.int64), held))}
    given, own = quality.given(sums.astype(np.int64), held), dict(zip(found.tolist(), counts.tolist()))
    assert sum(lower.get(w, held["share"]) for w in range(quality.FIRST, quality.FIRST + known)) + held["share"] == pytest.approx(1.0)
    for before in (quality.BEGIN, 2, 3, 17, 41):
        at = words.tolist().index(before)
        every = [quality.UNKNOWN, *range(quality.FIRST, quality.FIRST + known)]
        asked = np.array([own.get(before << 32 | w, 0) for w in every])
        logs = quality.log_probabilities(asked, quality.totals(sums)[at], given[at], np.array([lower.get(w, held["share"]) for w in every]), held)
        assert np.exp(logs).sum() == pytest.approx(1.0)


def test_packed_pairs():
    rng = np.random.default_rng(3)
    for n, most in ((0, 5), (1, 2), (400, 30), (400, 2**32 - 1)):
        pairs = np.unique(rng.integers(1, most, n, np.uint64) << np.uint64(32) | rng.integers(0, most, n, np.uint64))
        assert np.array_equal(quality.unpacked_pairs(quality.packed_pairs(pairs)), pairs)


def test_discounts():
    assert quality.discounts([100, 40, 20, 10]) == pytest.approx((1 - 2 * (100 / 180) * 0.4, 2 - 3 * (100 / 180) * 0.5, 3 - 4 * (100 / 180) * 0.5))
    assert quality.discounts([3, 0, 0, 0]) == (0.5, 0.5, 0.5)


@pytest.fixture(scope="module")
def judged(spark):
    rng = random.Random(2)
    rows, labels = [], []
    for i in range(900):
        lang, bad = ["en", "de", None][i % 3], i % 9 == 0
        text = " ".join(f"{'junk' if bad else lang}{int(200 * rng.random() ** 3) if not bad else rng.randint(0, 99999)}" for _ in range(rng.randint(5, 200)))
        rows.append((i, text, lang, "x"))
        if i % 2:
            labels.append((i, 0 if bad else 1, 0))
    rows += [(900, None, "en", "x"), (901, "", None, "x"), (None, "junk", "en", "x"), rows[1]]
    labels += [(None, 1, 0), (3, None, 0), (5, 0, 0), (99999, 1, 0)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, n_words string"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_classify(judged):
    docs, labels = judged
    got = quality.classify(docs, labels, unit_bytes=20_000).collect()
    assert len(got) == docs.count()
    for r in got:
        if r.doc_id is not None and r.doc_id < 900 and r.n_words > 20:
            assert r.kept == (r.doc_id % 9 != 0) or r.kept is False and r.perplexity > 50
    good = [r.kept for r in got if r.doc_id is not None and r.doc_id % 9 and r.doc_id < 900]
    bad = [r.kept for r in got if r.doc_id is not None and r.doc_id % 9 == 0 and r.doc_id < 900]
    assert sum(good) > 0.95 * len(good) and sum(bad) < 0.1 * len(bad)
    assert all(r.kept and r.perplexity is None for r in got if r.doc_id in (900, 901))
    again = {(r.doc_id, r.n_words): r.perplexity for r in quality.classify(docs, labels, unit_bytes=3_000).collect()}
    assert all(r.perplexity is None or r.perplexity == pytest.approx(again[r.doc_id, r.n_words]) for r in got)


def plain_discounts(counts):
    n = [0, *(sum(c == k for c in counts) for k in (1, 2, 3, 4))]
    if not all(n[1:]):
        return 0.0, 0.5, 0.5, 0.5
    y = n[1] / (n[1] + 2 * n[2])
    return 0.0, *(min(max(k - (k + 1) * y * n[k + 1] / n[k], 0.0), float(k)) for k in (1, 2, 3))


def plain_model(texts):
    """log probability of a text under the interpolated modified Kneser-Ney bigrams of ``texts``."""
    pairs = Counter(p for t in texts for p in zip(["<begin>", *words_of(t)], words_of(t)))
    followed, preceded = defaultdict(dict), Counter()
    for (before, word), count in pairs.items():
        followed[before][word] = count
        preceded[word] += 1
    of_pair, of_word = plain_discounts(pairs.values()), plain_discounts(preceded.values())
    left = sum(of_word[min(c, 3)] for c in preceded.values()) / len(pairs) if pairs else 1.0

    def single(word):
        c = preceded[word]
        return max(c - of_word[min(c, 3)], 0.0) / max(1, len(pairs)) + left / (len(preceded) + 1)

    def log_probability(text):
        total = 0.0
        for before, word in zip(["<begin>", *words_of(text)], words_of(text)):
            after = followed.get(before)
            if not after:
                total += math.log(single(word))
                continue
            c, n = after.get(word, 0), sum(after.values())
            share = sum(of_pair[min(x, 3)] for x in after.values()) / n
            total += math.log(max(c - of_pair[min(c, 3)], 0.0) / n + share * single(word))
        return total

    return log_probability


def plain_verdicts(rows, labels, language_rows, quantile=0.99):
    """n_words, perplexity, evened, threshold and kept of each row (doc_id, text, lang), in their order."""
    given = defaultdict(list)
    for doc_id, value in labels:
        given[doc_id].append(value)
    good = {d for d, values in given.items() if d is not None and set(values) == {1}}
    signed = {d: xxhash.xxh64_intdigest(d.to_bytes(8, "little", signed=True), 42) for d in good}
    held = {d for d, h in signed.items() if (h - (1 << 64) if h >> 63 else h) % 5 == 0}
    score = plain_model([t for d, t, _ in rows if d in good - held])
    scored = [(d, lang, len(words_of(t)), score(t)) for d, t, lang in rows]
    known = [r for r in scored if r[0] in held and r[2]]
    by = defaultdict(list)
    for r in known:
        by[r[1]].append(r)
    every = sum(r[3] for r in known) / sum(r[2] for r in known)
    means = {k: sum(r[3] for r in v) / sum(r[2] for r in v) for k, v in by.items() if len(v) >= language_rows}

    def evened(r):
        return math.exp(-(r[3] + 50 * means.get(r[1], every)) / (r[2] + 50))

    def limit(some):
        return sorted(map(evened, some))[math.ceil(quantile * len(some)) - 1]

    limits, common = {k: limit(by[k]) for k in means}, limit(known)
    out = []
    for r in scored:
        top = limits.get(r[1], common)
        out.append((r[2], math.exp(-r[3] / r[2]) if r[2] else None, evened(r) if r[2] else None, top, not r[2] or evened(r) <= top + 1e-9))
    return out


def test_classify_equals_brute_force(spark, monkeypatch):
    """Perplexities, thresholds and verdicts, with languages null, empty and too rare for a threshold of their own."""
    monkeypatch.setattr(quality, "LANGUAGE_ROWS", 10)
    rng, rows, labels = random.Random(31), [], []
    for i in range(900):
        lang = ["en", "", None, "de"][i % 3 if i % 50 else 3]
        spread = 3 if i % 7 else 1
        rows.append((i - 100, " ".join(f"{lang}{int(300 * rng.random() ** spread)}" for _ in range(rng.randint(1, 90))), lang))
        if i % 2:
            labels.append((i - 100, int(i % 7 > 0)))
    rows += [(2000, None, "en"), (2001, " \t", ""), (None, "en1 en2", "en"), rows[1], (2002, "it 12", "it")]
    labels += [(None, 1), (-97, 0), (-95, None), (5000, 1), (-93, 1)]
    wanted = plain_verdicts(rows, labels, 10, 0.9)
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3)
    got = quality.classify(docs, spark.createDataFrame(labels, "doc_id long, quality int"), 0.9, unit_bytes=9_000).collect()
    key = lambda r: (r[0] is None, r[0], str(r[1]), r[2])
    got = sorted(((r.doc_id, r.lang, r.n_words, r.perplexity, r.evened, r.threshold, r.kept) for r in got), key=key)
    wanted = sorted(((d, lang, *w) for (d, _, lang), w in zip(rows, wanted)), key=key)
    assert len({w[5] for w in wanted}) >= 3 and 0 < sum(not w[6] for w in wanted) < 300
    assert len(got) == len(wanted)
    for a, b in zip(got, wanted):
        assert a[:3] == b[:3] and a[6] == b[6], (a, b)
        assert all(x is y is None or x == pytest.approx(y, rel=1e-6) for x, y in zip(a[3:6], b[3:6])), (a, b)


def test_rejected_rows_go(judged):
    docs, labels = judged
    kept = quality.without_rejected(docs, labels)
    assert kept.columns == docs.columns and 780 < kept.count() < 820
    assert quality.without_rejected(docs, labels.limit(0)).count() == docs.count()


def test_rows_without_an_id_are_judged(judged):
    docs, labels = judged
    verdicts = Counter((r.doc_id, r.lang, r.n_words) for r in quality.classify(docs, labels).where("kept").collect())
    nameless = docs.where("doc_id % 5 = 1").selectExpr("cast(null as long) as doc_id", "text", "lang", "n_words")
    other = docs.where("doc_id % 18 = 0").selectExpr("doc_id + 2 as doc_id", "text", "lang", "n_words")
    every = docs.unionAll(nameless).unionAll(other)
    judged_rows = quality.classify(every, labels).where("kept").collect()
    kept = quality.without_rejected(every, labels).collect()
    assert Counter((r.doc_id, r.lang, len(words_of(r.text))) for r in kept) == Counter((r.doc_id, r.lang, r.n_words) for r in judged_rows)
    assert sum(r.doc_id is None for r in kept) < nameless.count() and len(verdicts) > 700


def test_near_copies_without_an_id_go(spark):
    texts = [" ".join(f"v{i}x{j}" for j in range(184)) for i in range(4)]
    made = [(0, texts[0]), (None, texts[0] + " more"), (None, texts[1]), (None, texts[1] + " more"), (2, texts[2]), (2, texts[3]), (1, texts[3] + " more")]
    table = spark.createDataFrame(made, "doc_id long, text string")
    kept = [(r.doc_id, r.text[:3]) for r in jaccard.without_near_copies(table, nameless=False).collect()]
    assert sorted(kept, key=str) == [(0, "v0x"), (1, "v3x"), (2, "v2x"), (None, "v1x")]


# --- tokens ---


def ids_of(text, end):
    return [*Tokenizer.from_file(tokens.default_path()).encode(text or "", add_special_tokens=False).ids, end]


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def test_ids_by_word_are_the_tokenizers():
    texts = ["It's 100 O'Clock... we're <|endoftext|> A<|ENDOFTEXT|>b", "J̌ Ķ İstanbul Été, naïve!!! ×÷ …", "tabs\tand\x0blines\x1c x", "Hello,world. (a)b's 'tis <|", "", "don't $$$ x0x 0 00"]
    found = tokens.TextIds(tokens.default_path()).ids([t.encode() for t in texts])
    assert [np.frombuffer(f, "<u4").tolist() for f in found] == [ids_of(t, 0)[:-1] for t in texts]


def test_a_word_of_many_texts_is_looked_up_once():
    class Counting(dict):
        looked = 0

        def get(self, *key):
            Counting.looked += 1
            return super().get(*key)

        def __getitem__(self, key):
            Counting.looked += 1
            return super().__getitem__(key)

    ids, texts = tokens.TextIds(tokens.default_path()), ["Some words. été! " * 500, "", " \n", "words, x.\n.y z;", "some"]
    ids.new = Counting()
    found = ids.ids([t.encode() for t in texts])
    assert [np.frombuffer(f, "<u4").tolist() for f in found] == [ids_of(t, 0)[:-1] for t in texts]
    assert Counting.looked < 100 and ids.ids([]) == []


def test_pack(docs, rows):
    got = packing.pack(docs, block_rows=100).collect()
    wanted, tokens_ = Counter(), 0
    for r in rows:
        ids = ids_of(r[1], 0)
        tokens_ += len(ids)
        for n, at in enumerate(range(0, len(ids), 2048)):
            wanted[r[0], n, at, len(ids[at : at + 2048]), crc(ids[at : at + 2048])] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == wanted
    sequences = defaultdict(list)
    for r in got:
        sequences[r.sequence_id].append((r.offset, r.length))
    for placed in sequences.values():
        at = 0
        for offset, length in sorted(placed):
            assert offset == at
            at += length
        assert at <= 2048
    assert len(sequences) <= -(-tokens_ // 2048) + 4


def test_best_two_fit_replaces_the_smallest():
    # 6 + 3 leaves 1; 3 is replaced by 2 + 2, which fill the gap.
    sequence, place = packing.best_two_fit(np.array([6, 3, 2, 2]), 10)
    assert sequence.tolist() == [0, 1, 0, 0] and sorted(place[[0, 2, 3]].tolist()) == [0, 6, 8]


def test_token_files(spark, docs, rows):
    folder = f"{shared_folder(spark)}/token-files-test"
    token_files.write(docs, folder, shard_rows=40, block_bytes=3_000)
    got = token_files.read(spark, folder).orderBy("start").collect()
    encoded = Counter((r[0], len(ids_of(r[1], 2)), crc(ids_of(r[1], 2))) for r in rows)
    assert Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in got) == encoded
    named = [r.doc_id for r in got if r.doc_id is not None]
    assert named == sorted(named)
    at = 0
    for r in got:
        assert r.start == at
        at += r.n_tokens
    assert token_files.document_ids(spark, folder, 20) == ids_of(rows[20][1], 2)
    assert token_files.document_ids(spark, folder, 10**9) is None


def test_dictionary_of_few_samples():
    assert token_files.train_dictionary([]) == b"" and token_files.train_dictionary([b"abc", b"def"]) == b"abcdef"


# --- licences, preferences, neighbours ---


def test_licenses(spark):
    mit = licenses.KNOWN[3][1]
    rows = [(1, "Copyright (c) 2020 A. Person\n\n" + mit.upper().replace(" ", "  ")), (2, "text\nReleased under the M.I.T.\nRELEASED UNDER THE MIT LICENCE!\nmore"), (3, None), (4, ""), (5, mit + " and"), (None, mit), (2, "Licensed under CC BY-NC 4.0."), (None, "no notice"), (None, "Licensed under CC BY 4.0.\nReleased under the MIT License.")]
    table = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, license_id string")
    found = licenses.scan(table, licenses.digests(spark))
    got = Counter((r.doc_id, r.license_id, r.notices) for r in found.collect())
    own = [(1, "MIT", "MIT"), (2, None, "MIT"), (3, None, None), (4, None, None), (5, None, None), (None, "MIT", "MIT"), (2, "CC-BY-NC-4.0", "CC-BY-NC-4.0")]
    assert got == Counter(own + [(None, None, None), (None, None, "CC-BY-4.0,MIT")])


def test_complete_licenses(spark):
    """Files with a title, a holder and lines wrapped anew, of every text that is held complete."""
    bsd = license_texts.BSD
    two = bsd[: bsd.index("3. Neither")] + bsd[bsd.index("THIS SOFTWARE") :]
    filled = license_texts.APACHE_2.replace("[yyyy] [name of copyright owner]", "2021 A. Person")
    texts = [("MIT", "MIT License", licenses.KNOWN[3][1]), ("MIT", "The MIT License (MIT)", licenses.KNOWN[3][1]), ("ISC", "ISC License", license_texts.ISC), ("BSD-3-Clause", "BSD 3-Clause License", bsd), ("BSD-2-Clause", "BSD 2-Clause License", two)]
    files = [(name, f"{title}\n\nCopyright (c) 2020, A. Person\n\n{text}") for name, title, text in texts]
    files += [("Apache-2.0", license_texts.APACHE_2), ("Apache-2.0", filled), ("Apache-2.0", filled[: filled.index("   APPENDIX")])]
    files += [("GPL-2.0", license_texts.GPL_2), ("GPL-3.0", license_texts.GPL_3), ("MPL-2.0", license_texts.MPL_2), ("CC0-1.0", license_texts.CC0)]
    rows, wanted = [], {}
    for name, text in files:
        paragraphs = re.split(r"\n\s*\n", text)
        for width in (0, 50, 78, 100):
            wanted[len(rows)] = name
            # Lines of a holder stay lines, and spellings of two words are told within a line.
            joined = [p if re.search(r"(?i)copyright \(c\)", p) else " ".join(p.split()).replace("copyright owner", "copyright~owner").replace("non infringement", "non~infringement") for p in paragraphs]
            wrapped = [textwrap.fill(j, width, break_on_hyphens=False, break_long_words=False).replace("~", " ") if width and j != p else p for j, p in zip(joined, paragraphs)]
            rows.append((len(rows), "\n\n".join(wrapped)))
            wanted[len(rows)] = None
            rows.append((len(rows), "\n\n".join(wrapped[:-1])))  # not whole
    cut = [i for i, (_, text) in enumerate(rows) if "Apache" in text and i % 2]
    found = licenses.scan(spark.createDataFrame(rows, "doc_id long, text string"), licenses.digests(spark))
    got = {r.doc_id: r.license_id for r in found.collect()}
    assert {i: n for i, n in got.items() if i % 2 == 0} == {i: n for i, n in wanted.items() if i % 2 == 0}
    assert {i for i, n in got.items() if i % 2 and n} <= set(cut)


def test_preferences(spark):
    rows = [
        (0, 0, "system", "s"), (1, 0, "system", "s"), (0, 1, "user", "q"), (1, 1, "user", "q"), (0, 2, "assistant", "good"), (1, 2, "assistant", "bad"), (1, 3, "user", "why"),
        (2, 0, "user", "alone"), (2, None, None, None), (4, 0, "user", "same"), (5, 0, "user", "same"), (5, 0, "user", "same"), (None, 0, "user", "x"),
    ]
    table = spark.createDataFrame([(*r, 1) for r in rows], "conv_id long, turn long, role string, text string, part int")
    got = {(r.pair_id, r.part, r.turn, r.rendered, r.loss) for r in preferences.preferences(table, *preferences.neighbouring()).collect()}

    def turn(role, text):
        return f"<|{role}|>\n{text}<|end|>\n"

    assert got == {
        (0, "prompt", 0, turn("system", "s"), False), (0, "prompt", 1, turn("user", "q"), False), (0, "chosen", 2, turn("assistant", "good"), True),
        (0, "rejected", 2, turn("assistant", "bad"), True), (0, "rejected", 3, turn("user", "why"), False),
        (1, "chosen", None, turn("", ""), False), (1, "chosen", 0, turn("user", "alone"), False), (2, "prompt", 0, turn("user", "same"), False),
    }


@pytest.mark.parametrize("blocks", [(3, 20), (2048, 16384)])
def test_nearest(spark, blocks):
    rng = np.random.default_rng(4)
    vectors = rng.normal(size=(300, 9)).astype(np.float32)
    vectors[50:60] = vectors[0]  # ties
    vectors[70] *= 1e18
    rows = [(i, [float(x) for x in v], 1) for i, v in enumerate(vectors)]
    rows += [(300, None, 1), (310, [0.0] * 9, 1), (320, [float("nan")] * 9, 1), (330, [None] * 9, 1), (340, [1.0, 2.0], 1), (341, [1.0, 2.5], 1), rows[20], (None, rows[0][1], 1)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>, score int")
    got = collected(neighbours.nearest(table, table.vec_id % 10 == 0, 10, *blocks))
    usable = {r[0]: np.array(r[1], np.float32).astype(float) for r in rows if r[0] is not None and r[1] and None not in r[1] and np.isfinite(r[1]).all() and np.any(r[1])}
    wanted = Counter()
    for q, a in usable.items():
        if q % 10 == 0:
            found = sorted((float(np.sqrt(np.cumsum((a - b) ** 2)[-1])), v) for v, b in usable.items() if v != q and len(a) == len(b))
            wanted.update((q, n, v, d) for n, (d, v) in enumerate(found[:10], 1))
    assert got == wanted


# --- empty tables ---


def test_empty_tables(spark, empty):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    results = [
        mixing.mix(empty), mixing.mixed_rows(empty), simhash.near_groups(empty), jaccard.without_near_copies(empty), substrings.remove_repeats(empty), exact.exact_dedup(empty),
        exact.without_copies(empty), quality.classify(empty, labels), quality.without_rejected(empty, labels), packing.pack(empty), licenses.scan(empty, licenses.digests(spark)),
        preferences.preferences(spark.createDataFrame([], "conv_id long, turn long, role string, text string"), *preferences.neighbouring()),
    ]
    none = spark.createDataFrame([], "vec_id long, embedding array<float>")
    results.append(neighbours.nearest(none, none.vec_id % 100 == 0))
    token_files.write(empty, folder := f"{shared_folder(spark)}/token-files-empty")
    results.append(token_files.read(spark, folder))
    assert [r.count() for r in results] == [0] * len(results)
