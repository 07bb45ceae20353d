import math
import random
import struct

import numpy as np
import pytest
from pyspark.sql import functions as F

from pricetide.functions.measures import correlation, correlation_label, order_bits, rate
from pricetide.operators.quantiles import PASSES, exact_quantiles, value_counts
from pricetide.operators.ranking import batch_numbers, number_rows, running_total
from pricetide.plans import driver_tables as tables
from pricetide.plans import impact, search_report, update_report
from tests.test_intervals import UPDATES, at, frames

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def logs(spark):
    return tables.update_metrics(spark, SF), tables.search_metrics(spark, SF)


@pytest.mark.parametrize("passes", [PASSES[:1], PASSES])
def test_quantiles_equal_numpy(spark, passes):
    rng = random.Random(11)
    values = {
        "even": [rng.uniform(-5, 5) for _ in range(501)],
        "tail": [rng.lognormvariate(0, 6) for _ in range(400)],
        "hot": [7.25] * 300 + [rng.random() for _ in range(99)],
        "one": [3.0],
        "two": [1.0, 2.0],
        "close": [50 + i * 1e-9 for i in range(333)],
    }
    data = [(g, v) for g, vs in values.items() for v in vs] + [("even", None), ("even", float("nan")), (None, 1.0)]
    df = spark.createDataFrame(data, "g string, v double").repartition(7)
    wanted = {"q1": 0.25, "median": 0.5, "p90": 0.9}
    got = exact_quantiles(value_counts(df, ["g"], "v"), ["g"], wanted, passes).collect()
    assert {r.g for r in got} == set(values)
    for r in got:
        for name, p in wanted.items():
            assert r[name] == pytest.approx(np.quantile(values[r.g], p), rel=1e-12)


def test_running_total_and_row_numbers(spark):
    df = spark.createDataFrame([("g", float(i % 50) - 20, i, 1) for i in range(400)], "g string, v double, t long, n long")
    got = running_total(df, ["g"], "v", ["t"], "n", "upto", bins_per_unit=3).orderBy("v", "t").collect()
    assert [r.upto for r in got] == list(range(1, 401))
    numbered = number_rows(df.repartition(9), "v", "t").orderBy("v", "t").collect()
    assert [r.row_number for r in numbered] == list(range(1, 401))
    batches = batch_numbers(df, "v", "t", batch_size=150).groupBy("batch", "batch_start").count().orderBy("batch")
    assert [tuple(r) for r in batches.collect()] == [(1, 1, 150), (2, 151, 150), (3, 301, 100)]


def test_event_golden_numbers(spark, logs):
    events = spark.read.parquet(f"{SF}/events.parquet")
    row = search_report.numeric_summary(events, "value", deviation=True).first()
    assert row.median == pytest.approx(34.59)
    assert row.stddev == pytest.approx(49.10235064477291)
    q1 = exact_quantiles(value_counts(events, ["event_type"], "value"), ["event_type"], {"q": 0.25})
    assert q1.where("event_type = 'click'").count() == 1


def test_impact_golden_numbers(logs):
    row = impact.update_impact(*logs).first()
    assert row.during == pytest.approx(52.003254, abs=1e-6)
    assert row.outside == pytest.approx(50.04708, abs=1e-6)
    pairs = {r.pair: r.correlation for r in impact.correlations(*logs).collect()}
    assert pairs["update_duration_vs_search_time"] == pytest.approx(0.02566784, abs=1e-8)
    assert pairs["update_rate_vs_search_time"] == pytest.approx(-0.04356468, abs=1e-8)
    assert impact.searches_during(*logs).count() == 283
    assert impact.window_count(*logs).first().windows == 232


def test_window_means_and_stats_agree(logs):
    stats = {r.iteration: (r.search_count, r.avg_search_duration) for r in impact.window_stats(*logs).collect()}
    means = {r.iteration: (r.search_count, r.avg_search_duration) for r in impact.window_means(*logs).collect()}
    assert stats.keys() == means.keys()
    for i, (count, mean) in means.items():
        assert stats[i][0] == count and stats[i][1] == pytest.approx(mean)


def test_macro_and_micro_means(spark):
    updates, _ = frames(spark, [(0, 1.0), (10, 1.0)], [(0, True)])
    searches = spark.createDataFrame(
        [(at(0.5), 1, True, 10.0), (at(10.1), 2, True, 20.0), (at(10.2), 3, True, 20.0), (at(10.3), 4, True, 20.0),
         (at(50), 5, True, 10.0), (at(51), 6, True, 10.0)],
        "timestamp timestamp, search_id long, success boolean, duration_ms double",
    )
    row = impact.update_impact(updates, searches).first()
    assert (row.during, row.during_by_search, row.outside, row.impact_percent) == (15.0, 17.5, 10.0, 50.0)


@pytest.mark.parametrize("rows", [[(1.0, 2.0)], [(1.0, 2.0), (1.0, 3.0)], []])
def test_no_correlation_without_variation(spark, rows):
    df = spark.createDataFrame(rows, "x double, y double")
    row = df.agg(correlation(F.col("x"), F.col("y")).alias("c")).withColumn("label", correlation_label(F.col("c"))).first()
    assert tuple(row) == (None, "No significant correlation")


def test_correlation_equals_numpy(spark):
    rng = random.Random(2)
    data = [(x, x * 0.4 + rng.random()) for x in (rng.random() for _ in range(100))]
    df = spark.createDataFrame(data + [(None, 5.0), (5.0, None)], "x double, y double")
    got = df.agg(correlation(F.col("x"), F.col("y"))).first()[0]
    assert got == pytest.approx(np.corrcoef(*zip(*data))[0, 1])


def test_correlation_labels(spark):
    values = [0.3, 0.31, 0.5, -0.51, 0.7, -0.71]
    df = spark.createDataFrame([(v,) for v in values], "c double")
    labels = [r[0].split()[0] for r in df.select(correlation_label(F.col("c"))).collect()]
    assert labels == ["No", "Weak", "Weak", "Moderate", "Moderate", "Strong"]


def test_no_time_is_rate_zero(spark):
    assert spark.range(1).select(rate(F.lit(100), F.lit(0.0)), rate(F.lit(100), F.lit(4.0))).first() == (0.0, 25.0)


def test_empty_logs_give_empty_reports(spark, logs):
    updates, searches = (df.where("false") for df in logs)
    assert tuple(search_report.search_totals(searches).first()) == (0, 0, 0, None)
    assert tuple(search_report.duration_summary(searches).first()) == (None,) * 5
    assert tuple(update_report.update_totals(updates).first()) == (0, 0, 0)
    assert search_report.duration_by(searches, "query_type").count() == 0
    assert tuple(impact.update_impact(updates, searches).first()) == (None,) * 4


def test_partial_passes_and_odd_rates(spark):
    log = spark.createDataFrame(
        [(at(0), 1, 50_000, 39_000, 0, 1.58, 24_683.54), (at(9), 2, 50_000, 50_000, 0, 2.0, 25_000.0),
         (at(19), 3, 50_000, 50_001, 0, 2.0, 100.0), (at(29), 4, 50_000, 50_000, 0, 1.92, 26_013.36)],
        "timestamp timestamp, iteration long, total_instruments long, success_count long, error_count long, "
        "duration_seconds double, updates_per_second double",
    )
    assert [r.is_partial for r in update_report.flag_partial(log).orderBy("iteration").collect()] == [True, False, False, False]
    assert tuple(update_report.log_checks(log).first()) == (4, 1, 1, 1)


def test_runs_are_told_apart(spark):
    # The second run starts in a later hour, the third within it, the fourth with its first row.
    stamps = [(0, 232), (10, 233), (4000, 1), (4010, 2), (4020, 1), (4030, 2), (9000, 1), (9001, 2), (20000, 3)]
    log = spark.createDataFrame([(at(s), i, 1.0, 1.0) for s, i in stamps], UPDATES)
    got = update_report.run_ids(log).orderBy("timestamp").collect()
    assert [r.run_id for r in got] == [0, 0, 1, 1, 2, 2, 3, 3, 3]


def test_values_that_are_no_numbers_are_left_out(spark):
    from pricetide.plans.search_report import numeric_summary

    log = spark.createDataFrame([(float("nan"),), (2.0,), (4.0,), (None,)], "v double")
    got = numeric_summary(log, "v", deviation=True).collect()[0]
    assert (got["mean"], got["median"], got["max"], got["min"]) == (3.0, 3.0, 4.0, 2.0)
    assert round(got["stddev"], 6) == 1.414214


def test_search_log_with_a_line_break(spark, tmp_path):
    from pricetide.schemas import SEARCH_METRICS
    from pricetide.sources.readers import read_search_log

    names = SEARCH_METRICS.fieldNames()
    row = {"search_id": "1", "duration_ms": "NaN", "error": '"lost,\nthen found"'}
    text = ",".join(names) + "\n" + ",".join(row.get(n, "") for n in names) + "\n"
    (tmp_path / "log.csv").write_text(text)
    got = read_search_log(spark, str(tmp_path / "log.csv")).collect()
    assert [(r.search_id, r.duration_ms, r.error) for r in got] == [(1, None, "lost,\nthen found")]


def test_quantiles_of_values_close_to_zero_and_far_from_it(spark):
    """A million values under 1e-9 share no bin of many values, whatever else there is."""
    small = spark.range(1_000_000, numPartitions=8).select(F.lit("g").alias("g"), ((F.col("id") + 1) * 1e-15).alias("v"))
    far = spark.range(100).select(F.lit("g").alias("g"), (F.col("id") + 1) * F.lit(1e300))
    counts = value_counts(small.union(far.toDF("g", "v")), ["g"], "v")
    wanted = {"low": 0.001, "median": 0.5, "high": 0.9999, "last": 1.0}
    got = exact_quantiles(counts, ["g"], wanted).first()
    values = np.concatenate([np.arange(1, 1_000_001) * 1e-15, np.arange(1, 101) * 1e300])
    for name, p in wanted.items():
        assert got[name] == pytest.approx(np.quantile(values, p), rel=1e-12)
    # what a task of each pass may hold: the bins of the pass before
    bits = order_bits(F.col("value"))
    fullest = [counts.groupBy(F.shiftright(bits, s)).agg(F.count("*").alias("n")).agg(F.max("n")).first()[0] for s in PASSES]
    assert fullest[0] < 5_000 and fullest[1] == 1


def test_order_bits_are_those_of_the_double(spark):
    rng = random.Random(12)
    values = [0.0, -0.0, 5e-324, -5e-324, 2.2250738585072014e-308, 1.7976931348623157e308, math.inf, -math.inf]
    values += [math.ldexp(1, e) for e in range(-1074, 1024)]
    values += [math.nextafter(math.ldexp(1, e), s) for e in range(-1070, 1024) for s in (0, math.inf)]
    values += [struct.unpack("<d", rng.getrandbits(64).to_bytes(8, "little"))[0] for _ in range(2000)]
    values = [v for v in values if v == v]
    rows = spark.createDataFrame([(v,) for v in values], "v double").select("v", order_bits(F.col("v")).alias("b")).collect()
    for v, b in rows:
        bits = int.from_bytes(struct.pack("<d", abs(v)), "little")
        assert b == (-bits if v < 0 else bits)
    odd = spark.sql("select double('NaN') as v union all select null").select(order_bits(F.col("v")).alias("b"))
    assert sorted(r.b for r in odd.collect()) == [0, (1 << 63) - 1]
