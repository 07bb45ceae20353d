import glob
import os

import duckdb
import pytest

import __spark_entry__ as entry_points
from check import rows_of
from pricetide.plans.oracle import oracle_sql
from pricetide.plans.registry import QUERIES

SF = "/root/testdata/sf0.001"
TWINS = oracle_sql()


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for path in glob.glob(f"{SF}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        connection.execute(f"create view {name} as select * from '{path}'")
    return connection


def test_entry(spark):
    assert entry_points.entry(spark).count() == 100


def test_every_query_is_listed_with_its_twin():
    assert set(QUERIES) <= set(entry_points.queries()) and set(TWINS) <= set(entry_points.oracle_sql())
    assert set(QUERIES) == set(TWINS)


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_its_twin(spark, db, name):
    df = QUERIES[name](spark, SF)
    got = rows_of(df.columns, df.collect())
    cursor = db.execute(TWINS[name])
    names = [c[0] for c in cursor.description]
    assert sorted(names) == sorted(df.columns)
    assert got == rows_of(names, cursor.fetchall())


def final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", QUERIES)
def test_no_query_compares_all_pairs(spark, name):
    plan = QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan


def test_range_search_reads_little_and_keeps_little(spark):
    plan = QUERIES["price_range_top100"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan
    assert "GreaterThanOrEqual(p_retailprice,910" in plan and "LessThanOrEqual(p_retailprice,960" in plan


def test_key_scan_reads_one_column(spark):
    plan = QUERIES["key_projection"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<p_partkey:bigint>" in plan


def test_best_hits_are_cut_before_the_shuffle(spark):
    plan = final_plan(QUERIES["batch_range_search"](spark, SF)).split("Initial Plan")[0]
    assert plan.count("WindowGroupLimit") == 2


@pytest.mark.parametrize("name", ["by_query_type", "search_duration_stats", "window_stats"])
def test_quantiles_share_one_shuffle_of_counts(spark, name):
    assert "ReusedExchange" in final_plan(QUERIES[name](spark, SF))
