"""The pipeline's stages, each on what the one before kept, against brute force; and all of them in one run."""

import math
import random
from collections import Counter, defaultdict
from fractions import Fraction

import corpus_pipeline
from lateline.llm import mixing
from tests.llm.test_operators import crc, ids_of, least_reachable, plain_similarity, plain_verdicts, sentence, words_of

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def made():
    """Good and bad texts, exact and near copies, long texts, null texts, rows without an id."""
    rng, rows, labels = random.Random(41), [], []
    for i in range(240):
        bad = i % 8 == 0
        text = " ".join(f"junk{rng.randint(0, 99999)}" for _ in range(80)) if bad else sentence(rng, rng.randint(30, 150), 900)
        rows.append((i, text, ["en", "de", None][i % 3], ["a", "b", None, "a"][i % 4]))
        if i % 2 == 0 or i % 3 == 0:
            labels.append((i, int(not bad)))
    rows += [(300 + i, rows[i + 1][1], "en", "b") for i in range(0, 40, 8)]
    rows += [(400 + i, rows[i + 2][1] + " more", "de", "a") for i in range(0, 40, 8)]
    rows += [(500 + i, rows[3][1], "en", "a") for i in range(30)]
    rows += [(600, None, "en", "a"), (601, "", None, "b"), (602, sentence(rng, 6000, 900), "en", "a")]
    rows += [(None, rows[5][1] + " and more", "en", "a"), (None, sentence(rng, 60, 900), "de", None)]
    return [(*r, len(r[1] or "")) for r in rows], labels


def quality_filter(rows, labels):
    verdicts = plain_verdicts([r[:3] for r in rows], labels, 100)
    return [r for r, v in zip(rows, verdicts) if v[-1]]


def exact_copies(rows):
    kept = {}
    for r in rows:
        text = r[1] or ""
        if text not in kept or (kept[text][0] is None, -(kept[text][0] or 0)) > (r[0] is None, -(r[0] or 0)):
            kept[text] = r
    return list(kept.values())


def near_copies(rows):
    near = [(i, j) for i in range(len(rows)) for j in range(i) if plain_similarity(rows[i][1], rows[j][1]) >= Fraction(4, 5)]
    least, groups = least_reachable(range(len(rows)), near), defaultdict(list)
    for i, group in least.items():
        groups[group].append(rows[i])
    return [min(g, key=lambda r: (r[0] is None, r[0] or 0)) for g in groups.values()]


def source_mix(rows):
    """Rates by bisection, rounded from large to small with the words left over carried on."""
    by = defaultdict(list)
    for r in rows:
        by[r[3]].append((len(words_of(r[1])), r))
    names = sorted(by, key=lambda s: (s is None, s or ""))
    goals = mixing.targets([sum(n for n, _ in by[s]) for s in names], [1, 2, 3])
    out = []
    for name, goal in zip(names, goals):
        scale = sum(n for n, _ in by[name]) / len(by[name])
        rate = lambda x, n: min(3.0, math.exp(min(x * n / scale, 5.0)))  # noqa: E731, B023
        low, high = -200.0, 200.0
        for _ in range(200):
            middle = (low + high) / 2
            if sum(n * rate(middle, n) for n, _ in by[name]) < goal:
                low = middle
            else:
                high = middle
        carry = 0.0
        for n, r in sorted(by[name], key=lambda x: (-x[0], x[1][0] is None, x[1][0] or 0)):
            copies = min(3, max(0, math.floor(rate(low, n) + carry / n + 0.5))) if n else 1
            carry += (rate(low, n) - copies) * n
            out += [r] * copies
    return out


def pieces(rows):
    out = []
    for r in rows:
        ids = ids_of(r[1], 0)
        out += [(r[0], n, at, len(ids[at : at + 2048]), crc(ids[at : at + 2048])) for n, at in enumerate(range(0, len(ids), 2048))]
    return out


def assert_packed(got, rows):
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == Counter(pieces(rows))
    sequences = defaultdict(list)
    for r in got:
        sequences[r.sequence_id].append((r.offset, r.length))
    for placed in sequences.values():
        ends = [0, *(sum(x) for x in sorted(placed))]
        assert [x for x, _ in sorted(placed)] == ends[:-1] and ends[-1] <= 2048
    assert len(sequences) <= -(-sum(r.length for r in got) // 2048) + 4


def test_stages_and_run(spark, tmp_path):
    rows, labels = made()
    folder = str(tmp_path)
    spark.createDataFrame(rows, SCHEMA).repartition(3).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(*x, 0) for x in labels], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    plain = [lambda r: quality_filter(r, labels), exact_copies, near_copies, source_mix]
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for (name, function), expected in zip(corpus_pipeline.STAGES, plain):
        wanted = expected(rows)
        result = function(spark, docs, folder)
        assert result.columns == COLUMNS, name
        result.write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
        got = [tuple(r) for r in docs.collect()]
        assert Counter(got) == Counter(wanted), name
        assert name == "source_mix" or 0 < len(got) < len(rows)
        rows = wanted
    name, function = corpus_pipeline.STAGES[-1]
    assert_packed(function(spark, docs, folder).collect(), rows)
    assert_packed(corpus_pipeline.run(spark, folder).collect(), rows)
