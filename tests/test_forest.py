"""The forest: growth in one task and level by level, against a plain tree, storage, and plans without trees."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from lateline.ml import forest, prepare, scoring
from lateline.schema import TARGET

NUMBERS, TEXTS = ["n", "m"], ["t", "u"]
SCHEMA = f"n double, m double, t string, u string, {TARGET} int"


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(5)
    made = []
    for _ in range(600):
        n, m, t = rng.randint(0, 9), rng.random(), rng.choice(["a", "b", "c", None])
        made.append((float(n), m, t, rng.choice("xy"), int(rng.random() < (0.8 if n > 4 and t == "a" else 0.3))))
    return made + [(None, 0.5, None, None, 1)] * 3


@pytest.fixture(scope="module")
def train(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def preparation(train):
    return prepare.fit_preparation(train, NUMBERS, TEXTS)


WEIGHTS = {0: 0.7, 1: 1.9}


def fitted(train, preparation, **settings):
    return forest.fit_forest(train, preparation, WEIGHTS, forest.ForestSettings(**settings))


def node_rows(model):
    return sorted(tuple(r) for r in model.nodes.withColumn("gain", F.round("gain", 6)).collect())


def test_level_by_level_equals_growth_in_one_task(train, preparation):
    whole = fitted(train, preparation, trees=5, depth=7, seed=3)
    parts = fitted(train, preparation, trees=5, depth=7, seed=3, large_rows=40)
    assert node_rows(whole) == node_rows(parts) and len(node_rows(whole)) > 100
    assert node_rows(whole) != node_rows(fitted(train, preparation, trees=5, depth=7, seed=4))


def grown(codes, labels, layout, depth):
    """A plain tree over all slots: ``{node: (slot, cut, weights)}``."""
    nodes, weight = {}, [WEIGHTS[0], WEIGHTS[1]]

    def value(row, slot):
        code = row[layout.feature[slot]]
        return code if layout.level[slot] < 0 else int(code == layout.level[slot])

    def weights(picked):
        ones = sum(labels[i] for i in picked)
        return (len(picked) - ones) * weight[0], ones * weight[1]

    def purity(a, b):
        return (a * a + b * b) / (a + b)

    def split(node, picked, level):
        best = (-1.0, -1, 0)
        if level < depth and 0 < sum(labels[i] for i in picked) < len(picked):
            for slot in range(len(layout.feature)):
                for cut in range(layout.width[slot]):
                    left = [i for i in picked if value(codes[i], slot) <= cut]
                    if 0 < len(left) < len(picked):
                        right = [i for i in picked if value(codes[i], slot) > cut]
                        score = purity(*weights(left)) + purity(*weights(right))
                        if score > best[0] + 1e-9:
                            best = (score, slot, cut)
        nodes[node] = (best[1], best[2], weights(picked))
        if best[1] >= 0:
            split(2 * node, [i for i in picked if value(codes[i], best[1]) <= best[2]], level + 1)
            split(2 * node + 1, [i for i in picked if value(codes[i], best[1]) > best[2]], level + 1)

    split(1, list(range(len(codes))), 0)
    return nodes


def test_against_a_plain_tree(train, preparation):
    settings = forest.ForestSettings(1, 3, slots=99, bins=6, bootstrap=False, quantile_error=0)
    model = forest.fit_forest(train, preparation, WEIGHTS, settings)
    numbers, texts = forest._inputs(preparation)
    table = forest.coded(preparation, train).select(*numbers, *texts, TARGET).toPandas()
    codes = model.layout.encode([table[name].to_numpy() for name in [*numbers, *texts]])
    expected = grown(codes.tolist(), table[TARGET].tolist(), model.layout, 3)
    found = {r["node"]: r for r in model.nodes.collect()}
    assert set(found) == set(expected)
    for node, (slot, cut, weights) in expected.items():
        assert (found[node]["slot"], found[node]["cut"]) == (slot, cut)
        assert (found[node]["weight_0"], found[node]["weight_1"]) == pytest.approx(weights)
    share = forest.importances(model).agg(F.sum("importance")).first()[0]
    assert share == pytest.approx(1)


def test_scores_and_storage(spark, train, preparation, tmp_path, monkeypatch):
    model = fitted(train, preparation, trees=7, depth=6)
    before = sorted(r[0] for r in scoring.score(model, train).select("late_probability").collect())
    assert min(before) >= 0 and max(before) <= 1 and len(set(before)) > 20
    scoring.save_model(model, str(tmp_path / "m"))
    again = scoring.load_model(str(tmp_path / "m"))
    assert before == sorted(r[0] for r in scoring.score(again, train).select("late_probability").collect())
    # Sent tree by tree, the sums are the same.
    monkeypatch.setattr(forest, "SEND_BYTES", 1)
    parts = sorted(r[0] for r in scoring.score(model, train).select("late_probability").collect())
    assert parts == pytest.approx(before)
    unseen = spark.createDataFrame([(None, None, "new", None)], "n double, m double, t string, u string")
    assert 0 <= scoring.score(model, unseen).first()["late_probability"] <= 1


def test_plans_hold_no_trees(train, preparation):
    sizes = []
    for depth in (2, 8):
        plan = scoring.score(fitted(train, preparation, trees=4, depth=depth), train)
        sizes.append(len(plan._jdf.queryExecution().toString()))
    assert abs(sizes[0] - sizes[1]) < 500


def test_pure_and_constant_rows(spark):
    same = spark.createDataFrame([(1.0, 1.0, "a", "b", i % 2) for i in range(10)], SCHEMA)
    model = fitted(same, prepare.fit_preparation(same, NUMBERS, TEXTS), trees=2, depth=5, bootstrap=False, large_rows=3)
    assert [(r["node"], r["slot"]) for r in model.nodes.collect()] == [(1, -1)] * 2
    assert forest.importances(model).count() == 0
    pure = spark.createDataFrame([(float(i), 1.0, "a", "b", 1) for i in range(10)], SCHEMA)
    model = fitted(pure, prepare.fit_preparation(pure, NUMBERS, TEXTS), trees=2, depth=5)
    assert {r["late_probability"] for r in scoring.score(model, pure).collect()} == {1.0}


def test_bootstrap_takes_rows_once_on_average():
    times = forest._times(np.arange(200_000, dtype=np.uint64), 3, forest.ForestSettings())
    assert abs(times.mean() - 1) < 0.01 and abs((times == 0).mean() - np.exp(-1)) < 0.01
    other = forest._times(np.arange(200_000, dtype=np.uint64), 4, forest.ForestSettings())
    assert abs(np.corrcoef(times, other)[0, 1]) < 0.01


def test_wide_nodes_split_like_others():
    layout, rng = forest.Layout([[0.5, 1.5], [3.5]], [5, 1]), np.random.default_rng(1)
    codes = np.stack([rng.integers(0, n, 900) for n in (3, 2, 5, 1)], axis=1).astype(np.uint8)
    label, times, settings = rng.integers(0, 2, 900), rng.integers(1, 4, 900), forest.ForestSettings(depth=9)
    tables = [forest._grow(codes, label, times, 3, 1, layout, settings, np.array([0.7, 1.9]), wide) for wide in (1, 50, 10**6)]
    assert tables[0] == tables[1] == tables[2] and tables[0].num_rows > 50


def test_a_feature_is_counted_once_for_all_its_levels():
    layout, rng = forest.Layout([[0.5, 1.5]], [30]), np.random.default_rng(2)
    codes, label, times = np.stack([rng.integers(0, 3, 500), rng.integers(0, 30, 500)], axis=1), rng.integers(0, 2, 500), rng.integers(1, 4, 500)
    asked, drawn = [], np.arange(31)
    counts, ends = forest._slot_counts(lambda f: asked.append(int(f)) or codes[:, f], label, times, drawn, layout)
    assert asked == [0, 1]
    flat, starts, none = codes.reshape(-1), np.arange(500) * 2, np.zeros(500, np.int64)
    for slot in drawn:
        expected, _ = forest._counts(flat, starts, none, label, times, np.array([slot]), layout)
        assert (counts[ends[slot] : ends[slot + 1]] == expected).all()


def test_small_nodes_count_only_the_rows_that_have_a_level(monkeypatch):
    layout, rng = forest.Layout([[0.5, 1.5], [3.5]], [5, 3]), np.random.default_rng(4)
    codes = np.stack([rng.integers(0, n, 900) for n in (3, 2, 5, 3)], axis=1).astype(np.uint8)
    counts, asked = forest._counts, []

    def counted(codes, starts, node, label, times, slot, layout):
        asked.extend(slot.tolist())
        return counts(codes, starts, node, label, times, slot, layout)

    monkeypatch.setattr(forest, "_counts", counted)
    label, times = rng.integers(0, 2, 900), rng.integers(1, 4, 900)
    grown = forest._grow(codes, label, times, 3, 1, layout, forest.ForestSettings(depth=9), np.array([0.7, 1.9]), 10**6)
    assert set(grown["slot"].to_pylist()) > {0, 2, 3} and set(asked) == {0, 1}


def test_rows_are_placed_as_one_by_one():
    """Also with codes of four bytes, and of rows whose level no training row had."""
    layout, rng = forest.Layout([[0.5, 1.5], [3.5]], [70_000, 3]), np.random.default_rng(5)
    assert layout.kind is np.uint32
    codes = np.stack([rng.integers(0, n, 500) for n in (3, 2, 4, 4)], axis=1).astype(layout.kind)
    codes[:9, 2] = 70_000
    label, times, settings = rng.integers(0, 2, 500), np.ones(500, np.int64), forest.ForestSettings(depth=6, slots=10**6)
    nodes = forest._grow(codes, label, times, 0, 1, layout, settings, np.ones(2)).to_pylist()
    top, rows = forest._Top(), np.arange(3, 500, 2)
    top.splits = {r["node"]: (r["slot"], r["cut"]) for r in nodes if r["slot"] >= 0}
    expected = []
    for row in rows:
        node = 1
        while node in top.splits:
            slot, cut = top.splits[node]
            code, level = int(codes[row, layout.feature[slot]]), layout.level[slot]
            node = 2 * node + ((code if level < 0 else int(code == level)) > cut)
        expected.append(node)
    assert top.place(codes, layout, rows).tolist() == expected and len(set(expected)) > 20


def test_a_wide_node_reads_its_rows_once_for_all_levels(monkeypatch):
    """Not slot by slot; also in many small parts, and among nodes that are counted otherwise."""
    layout, rng = forest.Layout([[0.5, 1.5], [3.5]], [5, 3]), np.random.default_rng(6)
    codes = np.stack([rng.integers(0, n, 900) for n in (3, 2, 6, 3)], axis=1).astype(np.uint8)
    label, times, settings = rng.integers(0, 2, 900), rng.integers(1, 4, 900), forest.ForestSettings(depth=8)
    grown = lambda wide: forest._grow(codes, label, times, 3, 1, layout, settings, np.array([0.7, 1.9]), wide)
    expected = grown(10**6)
    monkeypatch.setattr(forest, "_best_of_slots", None)
    assert grown(0) == expected and expected.num_rows > 50
    monkeypatch.setattr(forest, "COUNTED_CELLS", 40)
    monkeypatch.setattr(forest, "COUNTED_ROWS", 7)
    assert grown(0) == expected


def test_only_rows_on_the_way_to_a_wanted_node_are_followed():
    layout, rng = forest.Layout([[0.5, 1.5], [3.5]], [5, 3]), np.random.default_rng(7)
    codes = np.stack([rng.integers(0, n, 700) for n in (3, 2, 6, 3)], axis=1).astype(np.uint8)
    settings, rows, top = forest.ForestSettings(), np.arange(700, dtype=np.uint64), forest._Top()
    top.splits = {1: (0, 0), 3: (4, 0), 6: (1, 0), 2: (7, 0)}
    times, read = forest._times(rows, 2, settings), []
    taken = np.flatnonzero(times)
    place = top.place(codes, layout, taken)

    class Columns(list):
        def __getitem__(self, feature):
            read.append(int(feature))
            return super().__getitem__(feature)

    for wanted in ([4, 5, 7, 12, 13], [13], [2, 7]):
        read.clear()
        found = {node: (here.tolist(), of.tolist()) for node, here, of in forest._dealt(rows, Columns(codes.T), 2, top, wanted, layout, settings)}
        assert found == {n: (taken[place == n].tolist(), times[taken[place == n]].tolist()) for n in wanted if n != 2 and (place == n).any()} | (
            {2: (taken[np.isin(place, [4, 5])].tolist(), times[taken[np.isin(place, [4, 5])]].tolist())} if 2 in wanted else {}
        )
    assert layout.feature[7] not in read  # node 2 is not split here


def test_how_often_a_row_is_taken_is_exact_at_the_bounds():
    settings, rows = forest.ForestSettings(), np.arange(300_000, dtype=np.uint64)
    salt = forest._hashed(np.array([settings.seed * 1_000_003 + 9]))[0]
    share = (forest._hashed(rows ^ salt) >> np.uint64(11)) / 2.0**53
    assert (forest._times(rows, 9, settings) == sum((share >= bound).astype(int) for bound in forest._POISSON)).all()
    assert 0 < (forest._SURE == 255).sum() <= 12
