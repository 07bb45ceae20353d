import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from pricetide.operators.intervals import (
    LENGTH_STEP,
    bucketed,
    interval_join,
    interval_totals,
    merged_windows,
    windows_of,
)
from pricetide.plans import impact

UPDATES = "timestamp timestamp, iteration long, duration_seconds double, updates_per_second double"
SEARCHES = "timestamp timestamp, search_id long, success boolean, duration_ms double"
START = datetime(2024, 1, 1, 10, 0, 0)


def at(seconds):
    return START + timedelta(microseconds=round(seconds * 1_000_000))


def frames(spark, windows, searches):
    updates = spark.createDataFrame([(at(s), i, d, 100.0 * i) for i, (s, d) in enumerate(windows, 1)], UPDATES)
    points = spark.createDataFrame(
        [(at(s), i, ok, float(i)) for i, (s, ok) in enumerate(searches, 1)], SEARCHES
    )
    return updates, points


WINDOWS = [(0, 2.0), (1, 2.0)]
POINTS = [(0, True), (1.5, True), (3, True), (3.000001, True), (1, False)]


def test_windows_are_closed_and_may_overlap(spark, rows):
    updates, searches = frames(spark, WINDOWS, POINTS)
    pairs = impact.searches_during(updates, searches).select("iteration", "search_id")
    assert rows(pairs) == [(1, 1), (1, 2), (2, 2), (2, 3)]
    assert rows(impact.searches_outside(updates, searches).select("search_id")) == [(4,)]
    assert impact.window_count(updates, searches).first().windows == 2


def test_a_stamp_may_mark_the_end(spark, rows):
    updates, searches = frames(spark, WINDOWS, POINTS)
    pairs = impact.searches_during(updates, searches, stamp="end").select("iteration", "search_id")
    assert rows(pairs) == [(1, 1), (2, 1)]
    with pytest.raises(ValueError):
        impact.update_windows(updates, stamp="middle")


@pytest.mark.parametrize("rows_per_task, broadcast_rows", [(4_000_000, 100_000), (4_000_000, 0), (7, 0)])
@pytest.mark.parametrize("bucket", [None, 0.7, 60])
def test_equals_nested_loops(spark, rows, rows_per_task, broadcast_rows, bucket):
    rng = random.Random(3)
    # Short, empty and very long windows; a third of the searches and windows at one moment.
    windows = [(rng.uniform(0, 100), rng.choice([0.0, 0.01, 0.5, 3.0])) for _ in range(60)]
    windows += [(50.0, 0.25)] * 30 + [(20.0, 70.0)]
    searches = [(50.1 if i % 3 == 0 else rng.uniform(-5, 130), True) for i in range(300)]
    updates, points = frames(spark, windows, searches)
    options = {"bucket_seconds": bucket, "rows_per_task": rows_per_task, "broadcast_rows": broadcast_rows}
    stamps = [(at(s), at(s) + (at(d) - START)) for s, d in windows]
    expected = [
        (w, p)
        for w, (start, end) in enumerate(stamps, 1)
        for p, (s, _) in enumerate(searches, 1)
        if start <= at(s) <= end
    ]
    pairs = impact.searches_during(updates, points, **options).select("iteration", "search_id")
    assert rows(pairs) == sorted(expected, key=repr)
    totals = interval_totals(
        impact.update_windows(updates), points, "timestamp", "duration_ms", ["iteration"], broadcast_rows
    )
    per_window = {}
    for w, p in expected:
        per_window.setdefault(w, []).append(float(p))
    assert {r.iteration: (r["count"], r["mean"]) for r in totals.collect()} == {
        w: (len(ps), pytest.approx(sum(ps) / len(ps))) for w, ps in per_window.items()
    }
    inside = {p for _, p in expected}
    outside = impact.searches_outside(updates, points, **options).select("search_id")
    assert rows(outside) == sorted([(p,) for p in range(1, 301) if p not in inside], key=repr)


def test_no_windows_and_no_points(spark):
    updates, searches = frames(spark, WINDOWS, POINTS)
    none = updates.where("iteration < 0")
    assert impact.searches_during(none, searches).count() == 0
    assert impact.searches_outside(none, searches).count() == 4
    assert impact.searches_outside(updates, searches.where("search_id < 0")).count() == 0


def test_negative_durations_hold_nothing(spark):
    windows = windows_of(
        spark.createDataFrame([(at(5), -3.0)], "t timestamp, d double"), "t", F.col("d")
    )
    points = spark.createDataFrame([(at(4), 1)], "at timestamp, id long")
    assert interval_join(windows, points, "at", ["id"]).count() == 0


@pytest.mark.parametrize("broadcast_rows", [100_000, 0])
def test_totals_keep_values_of_every_size(spark, broadcast_rows):
    updates, _ = frames(spark, [(i * 10, 2.0) for i in range(8)], [])
    inf = float("inf")
    held = [[1e20, 2.0], [1e-10, 3e-10], [inf, 1.0], [float("nan"), 4.0], [1e20], [5e-324, 1e300], [0.0, -2.5], [0.1]]
    rows = [(at(w * 10 + k), 10 * w + k, True, v) for w, own in enumerate(held) for k, v in enumerate(own)]
    searches = spark.createDataFrame(rows, SEARCHES)
    means = impact.window_means(updates, searches, broadcast_rows=broadcast_rows).collect()
    stats = impact.window_stats(updates, searches, broadcast_rows=broadcast_rows).collect()
    expected = {1: (2, 5e19), 2: (2, 2e-10), 3: (2, inf), 4: (1, 4.0), 5: (1, 1e20), 6: (2, 5e299), 7: (2, -1.25), 8: (1, 0.1)}
    found = {r.iteration: (r.search_count, r.avg_search_duration) for r in means}
    assert found == {w: (n, pytest.approx(m, rel=1e-15)) for w, (n, m) in expected.items()}
    assert found == {
        r.iteration: (r.search_count, pytest.approx(r.avg_search_duration, rel=1e-15)) for r in stats
    }


def test_points_beyond_the_windows_and_one_long_window(spark, rows):
    windows = [(i * 100, 2.0) for i in range(200)] + [(-5e6, 1e7)]
    searches = [(i * 50, True) for i in range(400)] + [(6e6 + i, True) for i in range(50)]
    updates, points = frames(spark, windows, searches)
    for broadcast_rows in (100_000, 0):
        pairs = impact.searches_during(updates, points, broadcast_rows=broadcast_rows)
        # every second search is at the start of a short window, the long one holds the first 400
        assert pairs.count() == 200 + 400
        means = impact.window_means(updates, points, broadcast_rows=broadcast_rows).collect()
        assert sorted(r.search_count for r in means) == [1] * 200 + [400]


@pytest.mark.parametrize("rows_per_task, broadcast_rows", [(4_000_000, 100_000), (7, 0)])
def test_points_inside_any_window_come_once(spark, rows_per_task, broadcast_rows):
    rng = random.Random(5)
    windows = [(rng.uniform(0, 900), rng.choice([0.0, 2.0, 40.0])) for _ in range(60)]
    points = [(rng.uniform(0, 1000), True) for _ in range(400)]
    updates, searches = frames(spark, windows, points)
    options = {"rows_per_task": rows_per_task, "broadcast_rows": broadcast_rows}
    found = {
        how: [
            r.search_id
            for r in interval_join(
                impact.update_windows(updates), searches, "timestamp", impact.POINT_ID, how=how, **options
            ).collect()
        ]
        for how in ("inner", "left_semi", "left_anti")
    }
    assert sorted(found["left_semi"]) == sorted(set(found["inner"]))
    assert sorted(found["left_semi"] + found["left_anti"]) == list(range(1, 401))


def test_impact_by_type_leaves_out_what_is_no_number(spark, rows):
    updates, searches = frames(spark, WINDOWS, [*POINTS, (2, True)])
    kind = F.when(F.col("search_id") < 4, "a").otherwise("b")
    searches = searches.withColumn("query_type", kind).withColumn(
        "duration_ms", F.when(F.col("search_id") == 6, F.lit(float("nan"))).otherwise(F.col("duration_ms"))
    )
    assert rows(impact.impact_by_type(updates, searches)) == [
        ("a", 3, 2.0, 0, None, None), ("b", 1, None, 1, 4.0, None)
    ]


@pytest.mark.parametrize("broadcast_rows", [100_000, 0])
def test_a_window_of_years_among_seconds(spark, rows, broadcast_rows):
    """Points of a busy time meet few windows beside a long one elsewhere."""
    rng = random.Random(9)
    # thousands of short windows within two hours, some of hours, and one of three years before
    windows = [(k * 2 + rng.random(), 0.4) for k in range(3600)] + [(20_000 + k * 9000, 5000.0) for k in range(20)]
    windows += [(-100_000_000.0, 95_000_000.0)]
    searches = [(rng.uniform(0, 7200), True) for _ in range(4000)] + [(rng.uniform(-1.1e8, 3e5), True) for _ in range(500)]
    updates, points = frames(spark, windows, searches)
    outside = impact.searches_outside(updates, points, broadcast_rows=broadcast_rows)
    spans = [(at(s), at(s + d)) for s, d in windows]
    expected = [(i,) for i, (s, _) in enumerate(searches, 1) if not any(a <= at(s) <= b for a, b in spans)]
    assert rows(outside.select("search_id")) == sorted(expected, key=repr)

    merged, classes = merged_windows(impact.update_windows(updates), few=True)
    assert len(classes) >= 3
    candidates = None
    for cls in classes:
        width = float(LENGTH_STEP**cls)
        held = bucketed(merged.where(F.col("_class") == cls), width).groupBy("_bucket").count()
        placed = points.withColumn("_bucket", F.floor(F.unix_micros("timestamp") / width)).join(held, "_bucket")
        met = placed.select("search_id", "count")
        candidates = met if candidates is None else candidates.union(met)
    assert candidates.groupBy("search_id").agg(F.sum("count").alias("n")).agg(F.max("n")).first()[0] < 64


def test_times_that_are_no_numbers_count_nowhere(spark):
    updates, points = frames(spark, [(0, 2.0)], [(1, True), (1.5, True), (5, True), (6, True), (7, True)])
    nan = float("nan")
    holes = points.withColumn("duration_ms", F.when(F.col("search_id").isin(2, 4), nan).otherwise(F.col("duration_ms")))
    row = impact.update_impact(updates, holes).first()
    assert (row.during, row.during_by_search, row.outside, row.impact_percent) == (1.0, 1.0, 4.0, -75.0)
    # also where Spark works the rows out while it plans
    literal = spark.sql(
        """select * from values (timestamp '2024-01-01 10:00:01', 1L, true, 1.0D), (timestamp '2024-01-01 10:00:01', 2L, true, double('NaN')),
            (timestamp '2024-01-01 10:00:09', 3L, true, double('NaN')), (timestamp '2024-01-01 10:00:09', 4L, true, 4.0D)
            as v(timestamp, search_id, success, duration_ms)"""
    )
    row = impact.update_impact(updates, literal).first()
    assert (row.during, row.outside) == (1.0, 4.0)


def test_window_stats_of_overlapping_windows_need_no_pairs(spark, rows, monkeypatch):
    """Every window holds thousands of searches, one comes twice, one stands in two lengths under one name."""
    seconds = [(i * 3, 4000.0 + i % 7) for i in range(300)] + [(5e5, 1.0), (0, 0.0)]
    updates, _ = frames(spark, [*seconds, (9, 4003.0)], [])
    number = F.when(F.col("iteration") == len(seconds) + 1, 4).otherwise(F.col("iteration"))
    updates = updates.withColumn("iteration", number).union(updates.where("iteration = 2"))
    made = [(at(k * 1.25), k, k % 5 > 0, float(k * k % 97) if k % 11 else float("nan")) for k in range(4000)]
    searches = spark.createDataFrame(made, "timestamp timestamp, search_id long, success boolean, duration_ms double")
    pairs = impact.searches_during(updates, searches).where("not isnan(duration_ms)").groupBy(*impact.WINDOW)
    expected = pairs.agg(
        F.count("*"), F.round(F.avg("duration_ms"), 6), F.expr("percentile(duration_ms, 0.5)"), F.max("duration_ms")
    )
    expected = rows(expected)
    monkeypatch.setattr(impact, "interval_join", None)
    for broadcast_rows in (100_000, 0):
        found = impact.window_stats(updates, searches, broadcast_rows=broadcast_rows).select(
            *impact.WINDOW,
            "search_count",
            F.round("avg_search_duration", 6),
            "median_search_duration",
            "max_search_duration",
        )
        assert rows(found) == expected
    assert max(r[2] for r in expected) > 4000 and len(expected) >= 300
