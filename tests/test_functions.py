import pytest
from pyspark.sql import functions as F

from lateline.functions import columns as C
from lateline.functions import display as D
from lateline.functions.names import snake_name, unique_names


@pytest.mark.parametrize(
    "raw, clean",
    [
        ("Order Id", "order_id"),
        ("  Order Id ", "order_id"),
        ("order date (DateOrders)", "order_date"),
        ("SHIPPING DATE (DateOrders)", "shipping_date"),
        ("Days for shipping (real)", "days_for_shipping_real"),
        ("Late_delivery_risk", "late_delivery_risk"),
        ("A/B-C.", "a_b_c"),
        ("_a__b_", "a_b"),
        ("Price (in $) / unit", "price_in_unit"),
    ],
)
def test_snake_name(raw, clean):
    assert snake_name(raw) == clean


@pytest.mark.parametrize(
    "names, unique",
    [
        (["a", "b"], ["a", "b"]),
        (["a", "a", "a"], ["a", "a_1", "a_2"]),
        (["a", "a", "a_1"], ["a", "a_2", "a_1"]),
        (["a_1", "a", "a"], ["a_1", "a", "a_2"]),
        ([], []),
    ],
)
def test_unique_names(names, unique):
    assert unique_names(names) == unique


def one_column(spark, values, kind, expression):
    table = spark.createDataFrame([(v,) for v in values], f"v {kind}")
    return [row[0] for row in table.select(expression(F.col("v"))).collect()]


def test_clean_text(spark):
    values = [" a ", "", "   ", None, "b"]
    assert one_column(spark, values, "string", C.clean_text) == ["a", "Unknown", "Unknown", "Unknown", "b"]


def test_clean_number(spark):
    values = ["$1,200.50", "00725", " -3 ", "n/a", "-", "", None, "1.0E7", "1.2.3"]
    assert one_column(spark, values, "string", C.clean_number) == [1200.5, 725.0, -3.0, None, None, None, None, 1.07, None]


def test_parse_time(spark):
    values = ["1/31/2018 22:56", "13/1/2018 1:05", "2018-01-31", "", None, "1/3/2018 0:05"]
    parsed = one_column(spark, values, "string", lambda v: C.parse_time(v).cast("string"))
    assert parsed == ["2018-01-31 22:56:00", None, None, None, None, "2018-01-03 00:05:00"]


def test_discount_level(spark):
    values = [None, -0.1, 0.0, 0.05, 0.0500001, 0.15, 0.16]
    levels = ["Unknown", "Low", "No Discount", "Low", "Medium", "Medium", "High"]
    assert one_column(spark, values, "double", C.discount_level) == levels


def test_sales_level(spark):
    values = [None, 1.0, 2.0, 2.5, 3.0, 9.0]
    levels = ["Unknown", "Low", "Low", "Medium", "Medium", "High"]
    assert one_column(spark, values, "double", lambda v: C.sales_level(v, 2.0, 3.0)) == levels
    assert set(one_column(spark, values, "double", lambda v: C.sales_level(v, None, None))) == {"Unknown"}


def test_loss_flag_and_margin(spark):
    assert one_column(spark, [None, 0.0, -1.0, 2.0], "double", C.loss_flag) == [0, 0, 1, 0]
    table = spark.createDataFrame([(1.0, 2.0), (1.0, 0.0), (None, 2.0), (1.0, None)], "p double, s double")
    margins = [row[0] for row in table.select(C.profit_margin(F.col("p"), F.col("s"))).collect()]
    assert margins == [0.5, None, None, None]


def test_percentage(spark):
    table = spark.createDataFrame([(1, 4), (1, 0), (1, None), (1, -2), (None, 4)], "a int, b int")
    shares = [row[0] for row in table.select(C.percentage(F.col("a"), F.col("b"))).collect()]
    assert shares == [25.0, 0.0, 0.0, 0.0, None]


def test_human_number(spark):
    values = [None, 0.0, 12.0, 0.125, 999.0, 1000.0, -1500.0, 1234567.0, 36784735.0, 7.5]
    texts = ["0", "0", "12", "0.13", "999", "1.00K", "-1.50K", "1.23M", "36.78M", "7.50"]
    assert one_column(spark, values, "double", D.human_number) == texts
    assert one_column(spark, [None, 5, 65752], "bigint", D.human_number) == ["0", "5", "65.75K"]


def test_risk_tier(spark):
    values = [70.0, 69.99, 50.0, 49.99, 0.0]
    assert one_column(spark, values, "double", D.risk_tier) == ["danger", "warning", "warning", "success", "success"]
