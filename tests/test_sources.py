from datetime import datetime

import pytest
from pyspark.sql import functions as F

from pricetide.functions.times import add_seconds, iso_text, second_grid
from pricetide.operators import merge
from pricetide.schemas import INSTRUMENTS, PRICE, SEARCH_METRICS, UPDATE_METRICS
from pricetide.sources import readers, synthetic, writers
from pricetide.workspace import shared_folder, stage

LOG = """timestamp,search_id,search_type,query_type,min_price,max_price,price_range_width,text_query,success,duration_ms,total_hits,returned_hits,hits_per_ms,sample_data,error
2024-01-01T10:00:00.000001,1,combined_fund_low_price,combined,1.0,9.5,8.5,Fund,True,12.34,7,7,0.57,"[{'isin': 'US1', 'price': 1.5, 'long_name': ""O'Neil Fund...""}]",
2024-01-01T10:00:01.500000,2,long_name_fund,text_search,,,,Fund,False,3.0,0,0,0.0,[],timed out
"""


def test_search_log_with_samples_in_quotes(spark, tmp_path):
    (tmp_path / "log.csv").write_text(LOG)
    log = readers.read_search_log(spark, str(tmp_path))
    assert log.schema == SEARCH_METRICS
    first, second = log.orderBy("search_id").collect()
    assert [tuple(s) for s in first.sample_data] == [("US1", 1.5, "O'Neil Fund...")]
    assert first.timestamp == datetime(2024, 1, 1, 10, 0, 0, 1)
    assert (first.success, first.error, second.success, second.error) == (True, None, False, "timed out")
    assert (second.sample_data, second.min_price, second.price_range_width) == ([], None, None)


def test_update_log(spark, tmp_path):
    passes = spark.createDataFrame(
        [(datetime(2024, 1, 1, 10, 0, 0, 123456), 185, 50_000, 50_000, 0, 1.9222), (datetime(2024, 1, 1, 10, 0, 4), 186, 10, 0, 10, 0.0)],
        "timestamp timestamp, iteration long, total_instruments long, success_count long, error_count long, duration double",
    )
    path = str(tmp_path / "log")
    writers.export_log_csv(writers.update_log_rows(passes), path)
    log = readers.read_update_log(spark, path)
    assert log.schema == UPDATE_METRICS
    first, second = log.orderBy("iteration").collect()
    assert first.timestamp == datetime(2024, 1, 1, 10, 0, 0, 123456)
    assert (first.duration_seconds, first.updates_per_second) == (1.92, 26011.86)
    assert second.updates_per_second == 0.0


def test_logs_grow(spark, tmp_path):
    path = str(tmp_path / "log")
    for i in (1, 2):
        row = spark.createDataFrame([(i, 2.0, i * 10)], "search_id long, duration double, total_hits long").withColumns(
            {"min_price": F.lit(0.0), "max_price": F.lit(4.0)}
        )
        writers.append_log(writers.search_log_rows(row), path)
    log = spark.read.parquet(path).orderBy("search_id").collect()
    assert [(r.search_id, r.duration_ms, r.hits_per_ms, r.price_range_width) for r in log] == [
        (1, 2000.0, 0.01, 4.0),
        (2, 2000.0, 0.01, 4.0),
    ]


def test_csv_export_writes_zero_bounds_as_empty(spark, tmp_path):
    path = str(tmp_path / "csv")
    row = spark.createDataFrame([(1, 0.0, 4.0, 1.0)], "search_id long, min_price double, max_price double, duration double")
    log = writers.search_log_rows(row.withColumn("total_hits", F.lit(1).cast("long")))
    writers.export_log_csv(log, path)
    back = spark.read.option("header", True).csv(path).first()
    assert (back.min_price, back.max_price) == (None, "4.0")


def test_create_table_replaces(spark):
    assert not readers.table_exists(spark, "instruments_made")
    rows = synthetic.generate(spark, 20)
    writers.create_table(spark, "instruments_made", rows)
    assert readers.table_exists(spark, "instruments_made")
    assert spark.table("instruments_made").count() == 20
    writers.create_table(spark, "instruments_made")
    made = spark.table("instruments_made")
    assert made.count() == 0
    described = {r.column_name: r.data_type for r in readers.describe(made).collect()}
    assert described == {f.name: f.dataType.simpleString() for f in INSTRUMENTS.fields}
    assert described["price"] == PRICE.simpleString()
    spark.sql("drop table instruments_made")


def test_merges_leave_a_bucketed_table_in_place(spark, monkeypatch):
    monkeypatch.setattr(merge, "is_small", lambda df: False)
    made = synthetic.generate(spark, 300)
    writers.create_table(spark, "bucketed", made, buckets=8)
    changes = synthetic.price_pass(made.select("isin"), 1, "2024-01-01 00:00:00")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        patched = merge.patch_rows(spark.table("bucketed"), changes)
        plan = patched._jdf.queryExecution().executedPlan().toString()
        scan = [line for line in plan.splitlines() if "FileScan" in line]
        assert len(scan) == 1 and "Bucketed: true" in scan[0]
        # The only shuffle is that of the changes, none lies above the table's scan.
        assert plan.count("Exchange") == 1
        writers.swap_table(spark, "bucketed", patched, buckets=8)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert spark.table("bucketed").where("update_iteration = 1").count() == 300
    assert not readers.table_exists(spark, "bucketed_next")
    assert not readers.table_exists(spark, "bucketed_last")
    spark.sql("drop table bucketed")


def test_export_and_import_give_the_same_rows(spark, tmp_path, rows):
    made = synthetic.generate(spark, 200)
    path = str(tmp_path / "csv")
    writers.export_csv(made, path, single_file=True)
    writers.export_csv(made, path)
    back = readers.read_instruments_csv(spark, path).withColumn("price", F.col("price").cast(PRICE))
    assert rows(back.drop("row_order")) == rows(made)


def test_synthetic_instruments(spark, rows):
    made = synthetic.generate(spark, 20_000)
    profile = made.agg(
        F.count_distinct("isin").alias("keys"),
        F.min(F.length("isin")).alias("short"),
        F.max(F.length("isin")).alias("long"),
        F.min(F.length("long_name")).alias("min_long"),
        F.max(F.length("long_name")).alias("max_long"),
        F.min("price").alias("low"),
        F.max("price").alias("high"),
        F.count_distinct(F.substring("isin", 1, 2)).alias("countries"),
    ).first()
    assert (profile["keys"], profile["short"], profile["long"]) == (20_000, 12, 12)
    assert profile["min_long"] >= 100 and profile["max_long"] <= 200
    assert profile["low"] >= 1 and profile["high"] <= 5000 and profile["countries"] == 10
    assert made.where(~F.col("isin").rlike("^[A-Z]{2}[A-Z0-9]{9}[0-9]$")).count() == 0
    per_bucket = made.groupBy(
        *[(F.col("price") >= low).alias(f"from_{low}") for low, _ in synthetic.PRICE_BUCKETS]
    ).count().collect()
    assert all(3_000 < r["count"] < 5_000 for r in per_bucket)
    again = synthetic.synthetic_instruments(spark.range(0, 20_000, 1, 13).orderBy(F.desc("id")).repartition(3))
    assert made.exceptAll(again).count() == 0


def test_large_ids_have_different_keys(spark):
    ids = spark.createDataFrame([(k * 10**12 + j,) for k in range(90) for j in range(10)], "id long")
    assert synthetic.synthetic_instruments(ids).select("isin").distinct().count() == 900


def test_own_words(spark):
    words = synthetic.Vocabulary(firms=("Alpaca",), name_patterns=("{firms} {forms}",))
    names = synthetic.generate(spark, 50, words).collect()
    assert all(r.name.startswith("Alpaca ") for r in names)


def test_times(spark):
    df = spark.createDataFrame([(datetime(2024, 1, 1, 10, 0, 0, 5), 2.25)], "t timestamp, s double")
    row = df.select(
        add_seconds(F.col("t"), F.col("s")).alias("end"),
        iso_text(F.col("t")).alias("text"),
        F.size(second_grid(F.col("t"), add_seconds(F.col("t"), F.col("s")))).alias("steps"),
    ).first()
    assert tuple(row) == (datetime(2024, 1, 1, 10, 0, 2, 250005), "2024-01-01T10:00:00.000005", 3)


def test_staged_tables_lie_in_the_shared_folder(spark):
    base = spark.conf.get("spark.checkpoint.dir", None)
    path = shared_folder(spark, "x")
    assert base is None or path.startswith(base)
    assert shared_folder(spark, "x") != path
    assert stage(spark.range(5), "five").count() == 5


def test_required_columns(spark):
    with pytest.raises(ValueError, match=r"\['price'\]"):
        readers.check_columns(spark.createDataFrame([("a", "b", "c")], "isin string, name string, long_name string"))


def test_readers_of_a_published_table_see_a_whole_version(spark):
    for n in (5, 7, 9):
        version = writers.publish(spark, "published", synthetic.generate(spark, n))
        held = spark.table("published")
        assert held.count() == n
    assert version == 3
    # a reader that began with the version before still reads it
    before = spark.table("published__v2")
    writers.publish(spark, "published", synthetic.generate(spark, 3))
    assert spark.table("published").count() == 3 and held.count() == 9
    assert not readers.table_exists(spark, "published__v2") and readers.table_exists(spark, "published__v3")
    del before
    spark.sql("drop view published")
    for n in (3, 4):
        spark.sql(f"drop table published__v{n}")


def test_a_failed_version_is_not_published(spark):
    writers.publish(spark, "published", synthetic.generate(spark, 4))
    broken = synthetic.generate(spark, 4).withColumn("name", F.raise_error(F.lit("no name")).cast("string"))
    with pytest.raises(Exception, match="no name"):
        writers.publish(spark, "published", broken)
    assert spark.table("published").count() == 4
    spark.sql("drop view published")
    for t in spark.catalog.listTables(pattern="published__v*"):
        spark.sql(f"drop table {t.name}")


def test_column_check(spark):
    df = spark.createDataFrame([("A", 1.0)], "isin string, price double")
    assert [tuple(r) for r in readers.column_check(df).collect()] == [
        ("isin", True), ("name", False), ("long_name", False), ("price", True),
    ]


@pytest.mark.parametrize("size", [None, 300])
def test_quoted_line_breaks_are_read_by_several_tasks(spark, tmp_path, size):
    errors = ["", "plain", "two\nlines", 'a "quoted, word"\n\nand more', "x" * 500 + "\n" + "y" * 900, "\r\nbreaks\r\n", '"', "\n\n\n"]
    wanted = [(str(i), errors[i % len(errors)]) for i in range(200)]
    for part in range(2):
        rows = wanted[part::2]
        text = "number,error\r\n" + "".join('%s,"%s"\r\n' % (n, e.replace('"', '""')) for n, e in rows)
        (tmp_path / f"log{part}.csv").write_bytes(text.encode() + b"\n")
    if size:
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
        spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        raw = readers.read_quoted_csv(spark, str(tmp_path))
        got = sorted((int(r.number), r.error or "") for r in raw.collect())
        tasks = spark.read.text(str(tmp_path)).rdd.getNumPartitions()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert [n for n, _ in got] == list(range(200))
    for (_, error), (_, expected) in zip(got, wanted):
        assert error.replace("\r", "") == expected.replace("\r", "")
    assert tasks > 50 if size else tasks < 9


def test_rows_that_cannot_be_read_are_counted(spark, tmp_path):
    lines = ["search_id,duration_ms,success", "1,2.5,true", "2,soon,true", "3", "x,1.0,perhaps", "", "5,,false", "6,1,true,more"]
    (tmp_path / "log.csv").write_text("\n".join(lines))
    raw = readers.read_quoted_csv(spark, str(tmp_path))
    got = {r.what: r["count"] for r in readers.unreadable(raw, SEARCH_METRICS).collect()}
    assert got == {"rows": 6, "misfits": 2, "search_id": 1, "duration_ms": 1, "success": 1}
