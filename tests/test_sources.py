import json
import os
import time

import pytest
from pyspark.sql import functions as F

from lateline.__main__ import main
from lateline.operators import quality
from lateline.plans import gold, jobs
from lateline.sources import catalog, files, relational, staging
from tests.plans import physical_plan

HEADER = (
    "Order Id,Sales,Customer Email,Market,Category Name,Product Name,Shipping Mode,Order Region,Order Country,"
    "Delivery Status,Late_delivery_risk,Order Profit Per Order,Order Item Discount Rate,Days for shipping (real),"
    "Days for shipment (scheduled),order date (DateOrders)\n"
)
LINES = [
    "1,100.5,a@b,Europe,Ball,Cup,First,West,Espa\xf1a,Late delivery,1,10,0.1,5,2,1/31/2018 22:56\n",
    "1,100.5,c@d,Europe,Ball,Cup,First,West,Espa\xf1a,Late delivery,1,10,0.1,5,2,1/31/2018 22:56\n",
    "2,$50.00,,  ,Bat,Cap,Second,East,Peru,Advance shipping,0,-4,0,1,2,13/1/2018 1:05\n",
]


def write_csv(folder, name="orders.csv", encoding="latin-1", lines=LINES):
    folder.mkdir(exist_ok=True)
    (folder / name).write_bytes((HEADER + "".join(lines)).encode(encoding))
    return str(folder)


def test_find_csv(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        files.find_csv(spark, str(tmp_path / "absent"))
    (tmp_path / "a.txt").write_text("x")
    with pytest.raises(FileNotFoundError):
        files.find_csv(spark, str(tmp_path))
    write_csv(tmp_path)
    found = files.find_csv(spark, str(tmp_path))
    assert found.path.endswith("orders.csv") and found.size_bytes == os.path.getsize(tmp_path / "orders.csv")
    write_csv(tmp_path, "more.csv")
    with pytest.raises(ValueError, match="more than one"):
        files.find_csv(spark, str(tmp_path))
    assert files.named_file(spark, str(tmp_path / "a.txt")).size_bytes == 1
    assert files.named_file(spark, str(tmp_path / "*.csv")).size_bytes == 2 * found.size_bytes
    with pytest.raises(FileNotFoundError):
        files.named_file(spark, str(tmp_path / "absent.csv"))


def test_detect_encoding_reads_every_line(spark, tmp_path):
    late = [LINES[2]] * 500 + [LINES[0]]
    assert files.detect_encoding(spark, write_csv(tmp_path / "l", lines=late)) == "ISO-8859-1"
    assert files.detect_encoding(spark, write_csv(tmp_path / "u", encoding="utf-8", lines=late)) == "utf-8"


def test_read_order_csv(spark, tmp_path):
    path = write_csv(tmp_path / "in")
    texts = files.read_order_csv(spark, path)
    assert {kind for _, kind in texts.dtypes} == {"string"}
    assert texts.first()["Order Country"] == "España"
    assert dict(files.read_order_csv(spark, path, infer_schema=True).dtypes)["Order Id"] == "int"
    assert files.read_order_csv(spark, path, schema="a string, b string").columns == ["a", "b"]


def test_land_overwrites_and_counts(spark, tmp_path):
    raw = files.read_order_csv(spark, write_csv(tmp_path / "in"))
    target = str(tmp_path / "landed")
    assert files.land(raw, target) == files.land(raw, target) == 3
    assert files.read_table(spark, target).columns == raw.columns


def test_landing_is_checked_by_content(spark, tmp_path):
    raw = files.read_order_csv(spark, write_csv(tmp_path / "in"))
    target = str(tmp_path / "landed")
    assert files.land(raw, target, by_content=True) == 3
    kept = tuple(quality.content_digest(raw).first())
    stored = files.read_table(spark, target)
    assert tuple(quality.content_digest(stored).first()) == kept and files.check_content(stored, *kept) == 3
    altered = stored.withColumn("Order Country", F.regexp_replace("Order Country", "Peru", "Perv"))
    files.write_table(altered, str(tmp_path / "altered"))
    with pytest.raises(RuntimeError, match="expected"):
        files.check_content(files.read_table(spark, str(tmp_path / "altered")), *kept)
    assert files.land(raw.limit(0), str(tmp_path / "empty"), by_content=True) == 0


def test_landing_refuses_a_changed_store(spark, tmp_path, monkeypatch):
    raw = files.read_order_csv(spark, write_csv(tmp_path / "in"))
    read = files.read_table
    monkeypatch.setattr(files, "read_table", lambda *given: read(*given).withColumn("Sales", F.lit("1")))
    assert files.land(raw, str(tmp_path / "by_rows")) == 3  # their number alone does not show it
    with pytest.raises(RuntimeError, match="expected"):
        files.land(raw, str(tmp_path / "by_content"), by_content=True)


def test_jobs_end_to_end(spark, tmp_path):
    path = {name: str(tmp_path / name) for name in ["landed", "safe", "clean", "gold", "reports"]}
    log = {"report_path": path["reports"]}
    ingested = jobs.ingest_job(spark, write_csv(tmp_path / "in"), path["landed"], **log)
    assert (ingested["encoding"], ingested["rows_after"], ingested["column_count_after"]) == ("ISO-8859-1", 3, 16)
    safe = jobs.privacy_job(spark, path["landed"], path["safe"], **log)
    assert safe["dropped_columns"] == ["Customer Email"] and safe["column_count_after"] == 15
    clean = jobs.clean_job(spark, path["safe"], path["clean"], relative_error=0, files=1, **log)
    assert (clean["rows_before"], clean["rows_after"], clean["duplicates_removed"]) == (3, 2, 1)
    assert clean["null_summary"]["order_date"] == 1 and clean["low_sales_threshold"] == 50.0
    published = []
    report = jobs.gold_job(
        spark,
        path["clean"],
        path["gold"],
        "decimal(18,4)",
        publish=lambda table, name: published.append((name, table.count())),
        **log,
    )
    assert dict(published) == report["row_counts"] and list(report["row_counts"]) == list(gold.TABLES)
    market = files.read_table(spark, f"{path['gold']}/late_by_market").collect()
    assert [row["market"] for row in market] == ["Europe", "Unknown"]
    kept = files.read_table(spark, path["reports"]).orderBy("started_at").collect()
    assert [row["job"] for row in kept] == ["ingest", "privacy", "clean", "gold"]
    assert json.loads(kept[2]["details"])["created_features"][-1] == "order_day_of_week"


def test_bucketed_table_rolls_up_without_a_large_shuffle(spark, tmp_path):
    path = write_csv(tmp_path / "in")
    jobs.ingest_job(spark, path, str(tmp_path / "landed"))
    jobs.clean_job(spark, str(tmp_path / "landed"), str(tmp_path / "clean"))
    clean = files.read_table(spark, str(tmp_path / "clean"))
    files.write_bucketed(clean, "clean_by_order", 4)
    table = gold.gold_table(spark.table("clean_by_order"), "late_by_market")
    exchanges = [line for line in physical_plan(table).splitlines() if "hashpartitioning" in line]
    assert len(exchanges) == 1 and "hashpartitioning(market" in exchanges[0]
    assert table.collect() == gold.gold_table(clean, "late_by_market").collect()


def test_catalog(spark, tmp_path):
    spark.sql("create database if not exists dashboard")
    jobs.ingest_job(spark, write_csv(tmp_path / "in"), str(tmp_path / "landed"))
    jobs.clean_job(spark, str(tmp_path / "landed"), str(tmp_path / "clean"))
    jobs.gold_job(
        spark,
        str(tmp_path / "clean"),
        str(tmp_path / "gold"),
        publish=lambda table, name: catalog.save_gold(table, "dashboard", name),
    )
    assert catalog.list_tables(spark, "dashboard") == sorted(gold.TABLES)
    with pytest.raises(ValueError, match="late_by_market"):
        catalog.check_schema(spark.table("dashboard.late_by_region"), "late_by_market")


class Writer:
    """Records the calls made on a DataFrame writer."""

    def __init__(self):
        self.calls = []

    def __getattr__(self, name):
        def record(*args, **kwargs):
            self.calls.append((name, args, kwargs))
            return self

        return record


@pytest.mark.parametrize("write, truncate", [(relational.replace_rows, "true"), (relational.replace_table, "false")])
def test_relational_writes(monkeypatch, write, truncate):
    writer = Writer()
    monkeypatch.setattr(relational, "_small", lambda table: writer.mode("overwrite"))
    write(None, "jdbc:x", "dashboard.t", {"user": "u"})
    assert writer.calls == [
        ("mode", ("overwrite",), {}),
        ("option", ("truncate", truncate), {}),
        ("jdbc", ("jdbc:x", "dashboard.t"), {"properties": {"user": "u"}}),
    ]


class Session:
    """Records the calls made on ``read``."""

    def __init__(self):
        self.read = Writer()


def test_relational_reads():
    session = Session()
    login = {"user": "u"}
    relational.read_relational(session, "jdbc:x", "t", login)
    relational.read_relational(session, "jdbc:x", "t", login, relational.KeyRanges("id", 0, 900, 9))
    relational.read_relational(session, "jdbc:x", "t", login, ["id < 5", "id >= 5 or id is null"])
    bounds = {"column": "id", "lowerBound": 0, "upperBound": 900, "numPartitions": 9}
    assert session.read.calls == [
        ("jdbc", ("jdbc:x", "t"), {"properties": login}),
        ("jdbc", ("jdbc:x", "t"), {"properties": login, **bounds}),
        ("jdbc", ("jdbc:x", "t"), {"properties": login, "predicates": ["id < 5", "id >= 5 or id is null"]}),
    ]


def test_publisher_refills_defined_tables(monkeypatch):
    writer = Writer()
    monkeypatch.setattr(relational, "_small", lambda table: writer)
    publish = relational.publisher("jdbc:x", "dashboard", {})
    publish(None, "late_by_market")
    publish(None, "late_by_country")
    assert [call[1] for call in writer.calls] == [
        ("truncate", "true"),
        ("jdbc:x", "dashboard.late_by_market"),
        ("truncate", "false"),
        ("jdbc:x", "dashboard.late_by_country"),
    ]


def test_command_line(spark, tmp_path, capsys):
    folder = write_csv(tmp_path / "in")
    main(["ingest", folder, str(tmp_path / "landed"), "--by-content"])
    main(["privacy", str(tmp_path / "landed"), str(tmp_path / "safe")])
    main(["clean", str(tmp_path / "safe"), str(tmp_path / "clean"), "--relative-error", "0", "--rare-duplicates"])
    main(["gold", str(tmp_path / "clean"), str(tmp_path / "gold"), "--sum-type", "decimal(18,4)"])
    printed = [json.loads(line) for line in capsys.readouterr().out.splitlines()]
    assert [report["job"] for report in printed] == ["ingest", "privacy", "clean", "gold"]
    assert printed[-1]["row_counts"]["late_by_market"] == 2


def test_stage_uses_the_shared_folder(spark):
    folder = staging.shared_folder(spark)
    staged = staging.stage(spark.range(5), "numbers")
    assert staged.count() == 5 and staged.inputFiles()[0].startswith(f"file://{folder}/staged-numbers-")


def test_staged_tables_are_noted_and_discarded(spark):
    from lateline.sources.staging import discard, noted, stage

    with noted() as outer:
        with noted() as inner:
            first = stage(spark.range(3), "one")
        stage(spark.range(2), "two")
    stage(spark.range(1), "three")
    assert len(inner) == 1 and len(outer) == 2 and outer[0] == inner[0]
    assert first.count() == 3
    discard(spark, inner)
    discard(spark, inner)  # what is gone already does not matter
    assert spark.read.parquet(outer[1]).count() == 2
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        spark.read.parquet(inner[0])


def test_stored_and_staged_tables_are_compressed_with_zstd(spark, tmp_path):
    import pyarrow.parquet as pq

    rows = spark.range(1000).selectExpr("id", "cast(id % 7 as string) as name")
    files.write_table(rows, str(tmp_path / "stored"), files=1)
    staged = staging.stage(rows, "small")
    bucketed = staging.stage_buckets(rows, "small", "id", 2)
    for path in [*tmp_path.glob("stored/*.parquet"), *[p.removeprefix("file://") for p in staged.inputFiles() + bucketed.inputFiles()]]:
        assert pq.ParquetFile(path).metadata.row_group(0).column(0).compression == "ZSTD"


def test_shuffle_files_go_with_the_action_that_made_them(spark):
    import __spark_entry__ as entry

    before = {name: spark.conf.get(name, None) for name in entry.SETTINGS}
    entry.prepare_session(spark)
    try:
        disk = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
        held = disk.getAllFiles().toString().count("shuffle_")
        assert staging.stage(spark.range(10_000).repartition(5, "id"), "shuffled").count() == 10_000
        for _ in range(100):  # they are deleted in the background
            left = disk.getAllFiles().toString().count("shuffle_")
            if left <= held:
                break
            time.sleep(0.1)
        assert left <= held
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def test_clean_job_leaves_no_staged_table(spark, tmp_path):
    landed = files.write_table(files.read_order_csv(spark, write_csv(tmp_path / "in")), str(tmp_path / "landed"))
    staged = lambda: {n for n in os.listdir(staging.shared_folder(spark).removeprefix("file:")) if n.startswith("staged-")}
    before = staged()
    report = jobs.clean_job(spark, landed, str(tmp_path / "clean"), relative_error=0, rare_duplicates=True)
    assert staged() == before and files.read_table(spark, str(tmp_path / "clean")).count() == report["rows_after"] == 2


def test_a_compressed_raw_file_lands_like_a_plain_one(spark, tmp_path):
    plain = files.read_order_csv(spark, write_csv(tmp_path / "in"))
    packed = str(tmp_path / "packed")
    blanks = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    plain.write.options(header=True, encoding="ISO-8859-1", compression="lz4", **blanks).csv(packed)
    report = jobs.ingest_job(spark, packed, str(tmp_path / "landed"), file=packed, by_content=True)
    assert report["encoding"] == "ISO-8859-1" and report["rows_after"] == 3
    assert sorted(files.read_table(spark, str(tmp_path / "landed")).collect(), key=str) == sorted(plain.collect(), key=str)
