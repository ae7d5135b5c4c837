import datetime
import hashlib

from pyspark.sql import functions as F
from pyspark.sql import types as T

from lateline.operators import cleaning, features, quality
from lateline.plans.clean import clean_orders, sales_thresholds
from lateline.schema import PERSONAL_COLUMNS
from lateline.sources.staging import stage
from tests.plans import physical_plan

RAW = (
    "`Order Id` string, `Sales` string, `Order Profit Per Order` string, `Order Item Discount Rate` string, "
    "`Market` string, `order date (DateOrders)` string, `Days for shipping (real)` string, "
    "`Days for shipment (scheduled)` string, `Customer Email` string, ` customer password ` string"
)
ROWS = [
    ("1", "$100.00", "10", "0", " Europe ", "1/31/2018 22:56", "3", "4", "a@b", "x"),
    ("1", "$100.00", "10", "0", "Europe", "1/31/2018 22:56", "3", "4", "c@d", "y"),
    ("2", "200", "-5", "0.2", "", "bad", "5", "2", None, None),
    ("3", "0", None, None, None, None, None, "2", None, None),
    ("4", "n/a", "1", "0.1", "Asia", "2/1/2018 0:00", "1", "1", None, None),
]


def raw(spark):
    return spark.createDataFrame(ROWS, RAW)


def test_drop_all_columns_of_a_personal_name(spark):
    table = spark.createDataFrame([("a", "b", "c", "d")], "`Customer Email` string, `CUSTOMER EMAIL ` string, Sales string, sales string")
    result = cleaning.drop_personal(table)
    assert result.dropped == ["Customer Email", "CUSTOMER EMAIL "] and "Customer Email" not in result.missing
    assert result.table.columns == ["Sales", "sales"] and tuple(result.table.first()) == ("c", "d")


def test_drop_personal(spark):
    result = cleaning.drop_personal(raw(spark))
    assert result.dropped == ["Customer Email", " customer password "]
    assert result.missing == [name for name in PERSONAL_COLUMNS if name not in ("Customer Email", "Customer Password")]
    assert len(result.table.columns) == 8


def test_rename_keeps_position_and_values(spark):
    table = spark.createDataFrame([(1, 2, 3)], "`A ` int, `a` int, `a_1` int")
    renamed, mapping = cleaning.rename(table)
    assert renamed.columns == ["a", "a_2", "a_1"]
    assert mapping == {"A ": "a", "a": "a_2", "a_1": "a_1"}
    assert tuple(renamed.first()) == (1, 2, 3)


def test_numbers_keep_numeric_input(spark):
    table = spark.createDataFrame([(1.0e7, 5, True)], "sales double, order_id int, product_status boolean")
    row = cleaning.clean_numbers(table).first()
    assert tuple(row) == (1.0e7, 5.0, 1.0)


def test_integer_ids(spark):
    table = spark.createDataFrame([("9007199254740993", "1.5"), ("12.0", "x")], "order_id string, sales string")
    rows = cleaning.clean_numbers(table, integer_ids=True).collect()
    assert [tuple(row) for row in rows] == [(9007199254740993, 1.5), (12, None)]


def test_times_pass_through(spark):
    moment = datetime.datetime(2018, 1, 31, 22, 56)
    table = spark.createDataFrame([(moment, "1/1/2018 1:05")], "order_date timestamp, shipping_date string")
    assert tuple(cleaning.parse_times(table).first()) == (moment, datetime.datetime(2018, 1, 1, 1, 5))


def test_missing_columns_are_skipped(spark):
    table = spark.createDataFrame([("x",)], "other string")
    result = clean_orders(table)
    assert result.table.columns == ["other"] and result.low_sales is None
    assert quality.null_counts(table).count() == 0


def test_clean_orders(spark):
    result = clean_orders(raw(spark), relative_error=0)
    rows = {row["order_id"]: row for row in result.table.collect()}
    assert len(rows) == result.table.count() == 4  # the first two rows are one after cleaning
    assert result.mapping["order date (DateOrders)"] == "order_date"
    first = rows[1.0]
    assert (first["market"], first["sales"], first["shipping_delay_days"], first["profit_margin"]) == (
        "Europe", 100.0, -1.0, 0.1,
    )
    assert (first["order_year"], first["order_month"], first["order_day_of_week"]) == (2018, 1, 4)
    assert rows[2.0]["order_date"] is None and rows[2.0]["market"] == "Unknown" and rows[2.0]["is_loss_order"] == 1
    assert rows[3.0]["profit_margin"] is None and rows[3.0]["is_loss_order"] == 0
    assert [rows[float(i)]["discount_level"] for i in (1, 2, 3, 4)] == ["No Discount", "High", "Unknown", "Medium"]
    assert [rows[float(i)]["sales_level"] for i in (1, 2, 3, 4)] == ["Medium", "High", "Low", "Unknown"]


def test_clean_orders_empty(spark):
    empty = clean_orders(raw(spark).limit(0))
    assert (empty.low_sales, empty.high_sales) == (None, None)
    assert empty.table.count() == 0 and "sales_level" in empty.table.columns
    assert sales_thresholds(empty.table, relative_error=0) == [None, None]


def test_approximate_thresholds_are_within_the_error(spark):
    table = spark.range(10_000).select((F.col("id") * 1.0).alias("sales"))
    low, high = sales_thresholds(table)
    assert abs(low - 3300) <= 100 and abs(high - 6600) <= 100


def test_dedup_is_idempotent_and_counts(spark):
    table = spark.createDataFrame([(1, None), (1, None), (2, "a"), (2, "b")], "order_id int, market string")
    once = cleaning.drop_duplicate_rows(table)
    assert once.count() == cleaning.drop_duplicate_rows(once).count() == 3
    report = quality.duplicate_report(table).first()
    assert tuple(report) == (4, 3, 1, 1)
    assert tuple(quality.duplicate_report(table.limit(0)).first()) == (0, 0, 0, 0)


WIDE_ROWS = [
    (1, None, 0.0), (1, None, -0.0), (2, "a", float("nan")), (2, "a", float("nan")), (2, "b", None), (2, "", None),
    (3, None, None), (None, None, None), (None, None, None),
]


def shown(table):
    return sorted(str(tuple(row)).replace("-0.0", "0.0") for row in table.collect())


def test_rare_duplicates_are_those_of_the_whole_row(spark):
    table = spark.createDataFrame(WIDE_ROWS, "row_hash int, `a b` string, v double")
    table = stage(table.withColumnRenamed("v", "C0"), "rows")
    for row_hash in [F.xxhash64, lambda *names: F.lit(7), lambda *names: F.col(names[0])]:  # the others collide
        single = cleaning.drop_rare_duplicates(table, row_hash)
        assert single.columns == table.columns and single.schema == table.schema
        assert shown(single) == shown(table.dropDuplicates()) and single.count() == 6
    assert cleaning.drop_rare_duplicates(table.limit(0)).count() == 0
    assert cleaning.drop_rare_duplicates(table.select()).count() == table.select().dropDuplicates().count()


def test_rare_duplicates_of_equal_names(spark):
    table = spark.createDataFrame([(1, 2), (1, 2), (2, 1)], "a int, b int").toDF("x", "x")
    assert sorted(map(tuple, cleaning.drop_rare_duplicates(table).collect())) == [(1, 2), (2, 1)]


def test_rare_duplicates_shuffle_hashes_and_copies_only(spark):
    wide = spark.range(2000).select("id", F.repeat(F.col("id").cast("string"), 200).alias("text"))
    table = stage(wide.union(wide.where("id < 3")), "wide")
    single = cleaning.drop_rare_duplicates(table)
    plan = physical_plan(single)
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    exchanges = [line for line in plan.splitlines() if "hashpartitioning" in line]
    assert len(exchanges) == 1  # of the rows with a repeated hash
    assert single.count() == 2000


def test_rare_duplicates_beyond_the_broadcast_threshold(spark):
    table = stage(spark.range(3000).select((F.col("id") % 1000).alias("k"), F.lit("x").alias("v")), "thrice")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        single = cleaning.drop_rare_duplicates(table)
        assert "BroadcastHashJoin" not in physical_plan(single) and single.count() == 1000
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_clean_orders_with_rare_duplicates(spark):
    plain, rare = (clean_orders(raw(spark), relative_error=0, rare_duplicates=flag).table for flag in (False, True))
    assert shown(plain) == shown(rare) and plain.columns == rare.columns


def test_content_digest(spark):
    def digest(*rows):
        return tuple(quality.content_digest(spark.createDataFrame(list(rows), "a string, `b.c` string")).first())

    base = digest(("x", "y"), ("z", None))
    assert digest(("z", None), ("x", "y")) == base
    for other in [("z", ""), ("z", "-"), (None, "z"), ("Z", None)]:
        assert digest(("x", "y"), other) != base
    assert digest(("xy", "")) != digest(("x", "y")) != digest(("", "xy"))
    assert digest(("x", "y"), ("x", "y"), ("z", None)) != base
    assert digest() == (0, None)


def test_content_digest_sums_whole_numbers(spark):
    rows = [(str(i), None if i % 7 == 0 else "\u00e9" * (i % 3)) for i in range(1000)]
    table = spark.createDataFrame(rows, "a string, `b.c` string").repartition(3)
    texts = ["".join("-" if x is None else f"{len(x)}:{x}" for x in row) for row in rows]
    total = sum(int(hashlib.md5(text.encode()).hexdigest()[:15], 16) for text in texts)
    digest = quality.content_digest(table)
    assert tuple(digest.first()) == (1000, str(total)) and total > 1 << 66
    assert "sum(cast(" not in digest._jdf.queryExecution().optimizedPlan().toString().lower()  # no decimal for each row


def test_null_counts(spark):
    lines, _ = cleaning.standardise(raw(spark))
    counts = {row["column_name"]: row["null_count"] for row in quality.null_counts(lines).collect()}
    assert counts == {"order_date": 2, "sales": 1, "order_profit_per_order": 1, "market": 0}


def test_key_report(spark):
    table = spark.createDataFrame([("a", 1), ("a", 2), (None, 3)], "k string, v int")
    assert tuple(quality.key_report(table, "t", ["k"]).first()) == ("t", 3, 1, 1)
    assert tuple(quality.key_report(table.limit(1), "t", []).first()) == ("t", 1, 0, 0)


def test_profile(spark):
    row = quality.profile(raw(spark), "raw").first()
    assert (row["table_name"], row["row_count"], row["column_count"]) == ("raw", 5, 10)


def test_feature_types(spark):
    table = features.add_date_parts(features.add_line_features(cleaning.standardise(raw(spark))[0]))
    types = {field.name: field.dataType for field in table.schema.fields}
    assert types["is_loss_order"] == types["order_year"] == T.IntegerType()
    assert types["shipping_delay_days"] == types["profit_margin"] == T.DoubleType()
