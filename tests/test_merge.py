from datetime import datetime

from pyspark.sql import functions as F

from pricetide.operators import merge as M
from pricetide.plans import driver_tables as tables
from pricetide.schemas import INSTRUMENTS
from pricetide.sources import synthetic

TARGET = "isin string, name string, long_name string, price double, updated_at timestamp, update_iteration long"
CHANGES = "isin string, price double, updated_at timestamp, update_iteration long"
T0, T1, T5 = (datetime(2024, 1, 1, 10, 0, s) for s in (0, 1, 5))


def target(spark):
    return spark.createDataFrame([("K1", "a", "aa", 1.0, T0, 7), ("K2", "b", "bb", 2.0, T0, None)], TARGET)


def test_replace_drops_what_the_source_lacks(spark, rows):
    source = spark.createDataFrame(
        [("K1", "c", "cc", 9.0, T1)], "isin string, name string, long_name string, price double, updated_at timestamp"
    )
    assert rows(M.replace_rows(target(spark), source)) == [
        ("K1", "c", "cc", 9.0, T1, None),
        ("K2", "b", "bb", 2.0, T0, None),
    ]


def test_patch_keeps_names_and_never_inserts(spark, rows):
    changes = spark.createDataFrame([("K2", 5.0, T1, 3), ("K9", 6.0, T1, 3)], CHANGES)
    assert rows(M.patch_rows(target(spark), changes)) == [
        ("K1", "a", "aa", 1.0, T0, 7),
        ("K2", "b", "bb", 5.0, T1, 3),
    ]
    assert [r.isin for r in M.unmatched_changes(target(spark), changes).collect()] == ["K9"]
    tally = M.merge_tally(target(spark), changes, seconds=0.0).first()
    assert tuple(tally) == (2, 1, 1, 0.0)


def test_time_decides_before_the_iteration(spark):
    changes = spark.createDataFrame([("K1", 5.0, T5, 1), ("K1", 6.0, T1, 233)], CHANGES)
    once = M.patch_rows(target(spark), changes)
    assert once.where("isin = 'K1'").first().price == 5.0
    assert sorted(M.patch_rows(once, changes).collect()) == sorted(once.collect())


def test_old_changes_are_ignored(spark):
    changes = spark.createDataFrame([("K1", 5.0, datetime(2023, 1, 1), 1)], CHANGES)
    assert M.patch_rows(target(spark), changes).where("isin = 'K1'").first().price == 1.0


def test_replace_and_patch_do_not_commute(spark):
    source = spark.createDataFrame(
        [("K1", "c", "cc", 9.0, T1)], "isin string, name string, long_name string, price double, updated_at timestamp"
    )
    changes = spark.createDataFrame([("K1", 5.0, T5, 8)], CHANGES)
    patched_last = M.patch_rows(M.replace_rows(target(spark), source), changes).where("isin = 'K1'").first()
    replaced_last = M.replace_rows(M.patch_rows(target(spark), changes), source).where("isin = 'K1'").first()
    assert (patched_last.price, patched_last.update_iteration, patched_last["name"]) == (5.0, 8, "c")
    assert (replaced_last.price, replaced_last.update_iteration) == (9.0, None)


def test_a_hot_key_and_many_partitions(spark):
    changes = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, "K1").otherwise(F.concat(F.lit("X"), F.col("id") % 50)).alias("isin"),
        F.col("id").cast("double").alias("price"),
        F.timestamp_seconds("id").alias("updated_at"),
        F.col("id").alias("update_iteration"),
    )
    for parts in (1, 16):
        latest = M.latest_changes(changes.repartition(parts)).where("isin = 'K1'").first()
        assert (latest.price, latest.changes) == (29_997.0, 10_000)


def test_a_pass_sets_every_price(spark):
    made = synthetic.generate(spark, 500).withColumns(
        {"updated_at": F.lit(None).cast("timestamp"), "update_iteration": F.lit(None).cast("long")}
    )
    changes = synthetic.price_pass(made.select("isin"), 4, "2024-01-01 00:00:00")
    patched = M.patch_rows(made, changes)
    assert patched.where("update_iteration = 4").count() == 500
    assert patched.schema["price"].dataType == INSTRUMENTS["price"].dataType
    assert changes.where("price between 1 and 5000").count() == 500


def test_small_and_large_batches_merge_alike(spark, rows, monkeypatch):
    folder = "/root/testdata/sf0.001"
    target, changes = tables.merge_target(spark, folder), tables.price_changes(spark, folder)
    source = tables.replacements(spark, folder)

    def results():
        return [
            rows(M.patch_rows(target, changes, order=tables.CHANGE_ORDER)),
            rows(M.unmatched_changes(target, changes, order=tables.CHANGE_ORDER)),
            rows(M.merge_tally(target, changes)),
            rows(M.replace_rows(target, source)),
        ]

    small = results()
    monkeypatch.setattr(M, "is_small", lambda df: False)
    monkeypatch.setattr(M, "broadcast_if_small", lambda df: df)
    assert results() == small


def test_golden_numbers_of_the_latest_changes(spark):
    folder = "/root/testdata/sf0.01"
    in_one_country = F.concat(F.lit("US"), F.substring("isin", 3, 10))
    changes = tables.price_changes(spark, folder).withColumn("isin", in_one_country)
    listed = tables.merge_target(spark, folder).where("isin not like '%0'")
    patched = M.patch_rows(listed, changes, order=tables.CHANGE_ORDER).where("updated_at is not null")
    row = patched.agg(F.count("*").alias("n"), F.sum("price").alias("s")).first()
    assert row.n == 1800 and abs(row.s - 95_335_140.44) < 0.01
    assert M.unmatched_changes(listed, changes, order=tables.CHANGE_ORDER).count() == 200


def test_of_source_rows_with_one_key_the_last_wins(spark, rows):
    schema = "isin string, name string, long_name string, price double"
    source = [("K1", "a", "aa", 2.0), ("K9", "x", "xx", 1.0), ("K1", "b", None, 3.0), ("K9", "y", "yy", 0.5)]
    expected = [("K1", "b", None, 3.0, None, None), ("K2", "b", "bb", 2.0, T0, None), ("K9", "y", "yy", 0.5, None, None)]
    assert rows(M.replace_rows(target(spark), spark.createDataFrame(source, schema).coalesce(1))) == expected
    numbered = spark.createDataFrame([(*r, i) for i, r in enumerate(source)], schema + ", line long").repartition(4)
    assert rows(M.replace_rows(target(spark), numbered, order=["line"])) == expected
