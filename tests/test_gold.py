import pytest
from pyspark.sql import functions as F

from fixtures.orders_wide import clean_lines
from lateline.operators import rollup
from lateline.operators.rollup import MEASURES, roll_up
from lateline.plans import gold, views
from tests.plans import physical_plan

SF = "/root/testdata/sf0.001"
LINE = (
    "order_id double, late_delivery_risk double, is_loss_order int, sales double, order_profit_per_order double, "
    "days_for_shipping_real double, profit_margin double, order_item_discount_rate double, product_name string, "
    "category_name string, shipping_mode string, market string, order_region string, order_country string, "
    "delivery_status string, discount_level string"
)


def line(order, late, loss, sales, profit, days, category="c", product="p", market="m"):
    margin = None if not sales else (profit or 0) / sales
    return (
        order, late, loss, sales, profit, days, margin, 0.1, product, category, "mode", market, "r", "n", "s", "Low",
    )


@pytest.fixture(scope="module")
def lines(spark):
    rows = [
        line(1.0, 1.0, 0, 10.0, 1.0, 2.0, "a"),
        line(1.0, 0.0, 1, 30.0, -3.0, 4.0, "b"),
        line(2.0, 0.0, 0, 5.0, 1.0, None, "a"),
        line(None, 1.0, 1, 7.0, -1.0, 6.0, "a"),
        line(3.0, None, 0, None, None, 1.0, "b", market=None),
        line(4.0, 1.0, 1, 0.0, -2.0, 1.0, "c"),
        line(4.0, 1.0, 1, 0.0, -2.0, 1.0, "c"),
    ]
    return spark.createDataFrame(rows, LINE)


def direct(lines, keys):
    """The same figures with distinct counts over the lines themselves."""
    late = F.count_distinct(F.when(F.col("late_delivery_risk") == 1, F.col("order_id")))
    loss = F.count_distinct(F.when(F.col("is_loss_order") == 1, F.col("order_id")))
    orders = F.count_distinct("order_id")
    rate = {n: F.when(orders > 0, c / orders * 100).otherwise(0.0) for n, c in (("late", late), ("loss", loss))}
    columns = {
        "total_orders": orders,
        "late_orders": late,
        "loss_orders": loss,
        "late_delivery_rate": rate["late"],
        "loss_rate": rate["loss"],
        "total_sales": F.sum("sales"),
        "total_profit": F.sum("order_profit_per_order"),
        "average_profit_per_order": F.avg("order_profit_per_order"),
        "average_shipping_days": F.avg("days_for_shipping_real"),
        "average_profit_margin": F.avg("profit_margin") * 100,
        "average_discount_rate": F.avg("order_item_discount_rate") * 100,
    }
    return lines.groupBy(*keys).agg(*[c.alias(n) for n, c in columns.items()])


def close(table):
    rows = [tuple(round(v, 6) if isinstance(v, float) else v for v in row) for row in table.collect()]
    return sorted(rows, key=str)


@pytest.mark.parametrize("keys", [[], ["category_name"], ["market"], ["product_name", "category_name"]])
def test_two_levels_equal_distinct_counts(lines, keys):
    assert close(roll_up(lines, keys, MEASURES)) == close(direct(lines, keys))
    assert close(roll_up(lines.limit(0), keys, MEASURES)) == close(direct(lines.limit(0), keys))


def test_two_levels_equal_distinct_counts_on_the_given_data(spark):
    table = clean_lines(spark, SF)
    for keys in [["shipping_mode"], ["product_name", "category_name"]]:
        ours, plain = (t.orderBy(*keys).collect() for t in (roll_up(table, keys, MEASURES), direct(table, keys)))
        assert len(ours) == len(plain) > 0
        for one, other in zip(ours, plain):
            assert one[: len(keys)] == other[: len(keys)]
            assert list(one[len(keys) :]) == pytest.approx(list(other[len(keys) :]))


def test_an_order_is_late_in_a_group_if_any_line_is(lines):
    rows = {row["category_name"]: row for row in gold.gold_table(lines, "late_by_category").collect()}
    assert (rows["a"]["total_orders"], rows["a"]["late_orders"], rows["a"]["total_sales"]) == (2, 1, 22.0)
    assert (rows["b"]["total_orders"], rows["b"]["late_orders"]) == (2, 0)
    assert (rows["c"]["total_orders"], rows["c"]["late_delivery_rate"]) == (1, 100.0)


@pytest.mark.parametrize("name", gold.TABLES)
def test_schemas_and_single_pass(lines, name):
    table = gold.gold_table(lines, name)
    assert [(f.name, f.dataType) for f in table.schema] == [(f.name, f.dataType) for f in gold.TABLES[name].schema]
    from_groups = gold.gold_table_from_groups(gold.gold_groups(lines), name)
    assert close(table) == close(from_groups)
    assert table.collect() == [] or [r[0] for r in table.collect()] == [r[0] for r in from_groups.collect()]


def test_empty_input(lines):
    empty = lines.limit(0)
    assert tuple(gold.gold_table(empty, "executive_kpis").first()) == (0, None, None, 0.0, None, None)
    assert tuple(gold.gold_table_from_groups(gold.gold_groups(empty), "executive_kpis").first()) == (
        0, None, None, 0.0, None, None,
    )
    assert gold.gold_table(empty, "late_by_market").count() == 0


def test_number_of_partitions_does_not_matter(lines):
    assert close(gold.gold_groups(lines, "decimal(18,4)", partitions=3)) == close(gold.gold_groups(lines, "decimal(18,4)"))


def test_no_line_is_expanded_per_key_set(lines):
    assert "Expand" not in physical_plan(gold.gold_groups(lines))


def test_orders_are_shuffled_once_for_all_key_sets(lines):
    plan = physical_plan(gold.gold_groups(lines, partitions=3))
    exchanges = [text for text in plan.splitlines() if "hashpartitioning" in text]
    assert [("order_id" in x, "__home" in x, "key_set" in x) for x in exchanges] == [
        (False, False, True), (False, True, False), (True, False, False),
    ]


@pytest.mark.parametrize("batch", [1, 3, 10_000])
def test_orders_of_any_length_count_once_in_a_group(spark, batch):
    """An order that goes on over many batches, late or at a loss only in some of its lines; absent ids and keys."""
    rows = [line(7.0, float(i % 5 == 3), int(i % 7 == 6), 1.0, 1.0, 1.0, f"c{i % 4}", f"p{i % 6}", [None, "m", "n"][i % 3]) for i in range(60)]
    rows += [line(float(i // 3), float(i % 4 == 1), int(i % 9 == 2), 2.0, 1.0, 1.0, f"c{i % 3}", f"p{i % 2}") for i in range(60)]
    rows += [line(None, 1.0, 1, 3.0, -1.0, 1.0, "c1", "p1") for _ in range(4)]
    table = spark.createDataFrame(rows, LINE)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
    try:
        groups = gold.gold_groups(table, partitions=2).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    for name, keys in gold.KEY_SETS.items():
        got = [tuple(row[c] for c in [*keys, *MEASURES]) for row in groups if row["key_set"] == name]
        rounded = [tuple(round(v, 6) if isinstance(v, float) else v for v in row) for row in got]
        assert sorted(rounded, key=str) == close(direct(table, keys))


def test_no_table_of_groups_and_orders_is_built(lines):
    """An aggregate by group and order is nine times the lines."""
    plan = physical_plan(gold.gold_groups(lines))
    assert not [text for text in plan.splitlines() if "HashAggregate" in text and "key_set" in text and "order_id" in text]


@pytest.mark.parametrize("frequent", [1, 4, 10**9])
def test_only_frequent_orders_are_added_up_before_the_shuffle(spark, monkeypatch, frequent):
    """The others go as they are; each way gives the same, also for absent ids, repeated lines and partly late orders."""
    rows = [line(float(i % 9), float(i % 5 == 3), int(i % 7 == 6), 1.5, 1.0, 1.0, f"c{i % 4}", f"p{i % 2}", [None, "m"][i % 2]) for i in range(40)]
    rows += [line(None, 1.0, 1, 3.0, -1.0, 1.0, "c1", "p1") for _ in range(4)]
    table = spark.createDataFrame(rows, LINE)
    monkeypatch.setattr(rollup, "FREQUENT_LINES", frequent)
    groups = gold.gold_groups(table, "decimal(18,4)")
    plan = physical_plan(groups)
    assert "LeftAnti" in plan and "LeftSemi" in plan and "SortMergeJoin" not in plan
    orders = rollup._orders(table, rollup.all_keys(gold.KEY_SETS), MEASURES, "double", 2).collect()
    ids = [row["order_id"] for row in orders]
    assert ids.count(None) == 1 and len(ids) == (41 if frequent > 5 else len(set(map(tuple, orders))))
    for name, keys in gold.KEY_SETS.items():
        got = [tuple(row[c] for c in [*keys, *MEASURES]) for row in groups.collect() if row["key_set"] == name]
        rounded = [tuple(round(v, 6) if isinstance(v, float) else v for v in row) for row in got]
        assert sorted(rounded, key=str) == close(direct(table, keys))


def test_support_floor(spark):
    rows = [line(float(i), 1.0, 0, 1.0, 1.0, 1.0, "k", "nineteen") for i in range(19)]
    rows += [line(float(i), 0.0, 0, 1.0, 1.0, 1.0, "k", "twenty") for i in range(20)]
    table = gold.gold_table(spark.createDataFrame(rows, LINE), "risky_products")
    assert [row["product_name"] for row in table.collect()] == ["twenty"]


def test_ties_go_by_key(spark):
    rows = [line(float(i), 1.0, 0, 1.0, 1.0, 1.0, f"k{i:02}") for i in range(30, 0, -1)]
    table = gold.gold_table(spark.createDataFrame(rows, LINE), "profit_margin_by_category")
    assert [row["category_name"] for row in table.collect()] == [f"k{i:02}" for i in range(1, 21)]


def test_properties_on_the_given_data(spark):
    table = clean_lines(spark, SF)
    total = gold.gold_table(table, "executive_kpis").first()
    for name in ["late_by_shipping_mode", "late_by_market", "late_by_region", "late_by_category"]:
        rows = gold.gold_table(table, name).collect()
        assert all(0 <= row["late_delivery_rate"] <= 100 and row["late_orders"] <= row["total_orders"] for row in rows)
        assert [r["late_delivery_rate"] for r in rows] == sorted((r["late_delivery_rate"] for r in rows), reverse=True)
        assert sum(row["total_sales"] for row in rows) == pytest.approx(total["total_sales"])


def test_views(lines, spark):
    market = gold.gold_table(lines, "late_by_market")
    shares = {row["market"]: row["order_share"] for row in views.market_order_share(market).collect()}
    assert shares == {"m": 75.0, None: 25.0}
    assert views.most_risky_mode(gold.gold_table(lines, "late_by_shipping_mode")).collect() == [("mode",)]
    shown = dict(views.kpi_display(gold.gold_table(lines, "executive_kpis")).collect())
    assert shown["Total Orders"] == "4" and shown["Late Delivery Rate"] == "50.00%"
    tiers = views.shipping_mode_decisions(gold.gold_table(lines, "late_by_shipping_mode")).first()
    assert tiers["level"] == "warning"
    assert tiers["rate_text"] == "50.00%"
    options = sorted(views.column_options(lines, ["market", "category_name"]).collect())
    assert options == [("category_name", "a"), ("category_name", "b"), ("category_name", "c"), ("market", "m")]
    gold_tables = {name: gold.gold_table(lines, name) for name in views.GOLD_OPTIONS.values()}
    every = views.prediction_options(views.gold_options(gold_tables)).collect()
    assert every == sorted(every) and {row["field"] for row in every} == {*views.GOLD_OPTIONS, *views.FIXED_OPTIONS}
