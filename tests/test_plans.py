"""The plans the jobs are meant to have."""

import re

import pytest

import __spark_entry__ as contract
from fixtures.orders_wide import clean_lines
from fixtures.raw_orders import raw_orders
from lateline.operators import cleaning
from lateline.plans import gold
from lateline.sources.staging import stage
from tests.plans import physical_plan

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def written(spark):
    return stage(clean_lines(spark, SF), "clean")


@pytest.mark.parametrize("name", gold.TABLES)
def test_single_tables_have_no_expand_and_no_python(written, name):
    plan = physical_plan(gold.gold_table(written, name))
    assert "Expand" not in plan and "Python" not in plan and "Cartesian" not in plan and "NestedLoop" not in plan
    # One exchange by order, one by key; a third only for the closing sort.
    assert plan.count("Exchange hashpartitioning") == (2 if gold.TABLES[name].keys else 1)


def test_scan_reads_only_the_columns_of_a_table(written):
    plan = physical_plan(gold.gold_table(written, "loss_by_market"))
    schema = re.search(r"ReadSchema: struct<(.*?)>", plan).group(1)
    assert {c.split(":")[0] for c in schema.split(",")} <= {"order_id", "market", "is_loss_order", "sales", "order_profit_per_order"}


def test_all_tables_come_from_one_scan(written):
    plan = physical_plan(gold.gold_groups(written))
    assert plan.count("FileScan") == 1 and plan.count("Generate inline") == 1 and "Expand" not in plan


def test_limits_are_top_k(written):
    for name in ["risky_products", "top_products_by_sales", "late_by_country", "profit_margin_by_category"]:
        assert "TakeOrderedAndProject" in physical_plan(gold.gold_table(written, name))


def test_cleaning_shuffles_nothing(spark):
    raw = stage(raw_orders(spark, SF), "raw")
    plan = physical_plan(cleaning.standardise(cleaning.drop_personal(raw).table)[0])
    assert "Exchange" not in plan and "Python" not in plan
    assert "Customer Email" not in plan


def test_orders_are_joined_last_so_the_roll_up_adds_no_exchange(spark):
    contract.prepare_session(spark)
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = physical_plan(gold.gold_table(clean_lines(spark, SF), "late_by_market"))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    assert "hashpartitioning(l_orderkey" in plan and "hashpartitioning(market" in plan
    assert not re.search(r"hashpartitioning\([^)]*order_id", plan)
    assert "Broadcast" not in plan
