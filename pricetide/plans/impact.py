"""How update passes affect the searches that run beside them."""

from functools import reduce

from pyspark.sql import Window
from pyspark.sql import functions as F

from pricetide.functions.measures import (
    correlation,
    correlation_label,
    fixed,
    impact_percent,
    signed_percent,
)
from pricetide.operators.intervals import (
    interval_join,
    interval_sums,
    interval_totals,
    mark_inside,
    measured_points,
    windows_of,
)
from pricetide.operators.stretches import values_at_ranks
from pricetide.plans.search_report import successful
from pricetide.workspace import stage

WINDOW = ["update_timestamp", "iteration"]
ABOUT = ["update_duration", "updates_per_second"]
POINT_ID = ["search_id", "timestamp"]


def update_windows(updates, stamp="start"):
    """The time each pass covers. The log's stamp counts as its start unless told."""
    windows = windows_of(updates, "timestamp", F.col("duration_seconds"), stamp)
    return windows.select(
        F.col("timestamp").alias("update_timestamp"),
        "iteration",
        F.col("duration_seconds").alias("update_duration"),
        "updates_per_second",
        "window_start",
        "window_end",
    )


def searches_during(updates, searches, stamp="start", **options):
    """A row per window and successful search inside it."""
    return interval_join(
        update_windows(updates, stamp), successful(searches), "timestamp", POINT_ID, **options
    )


def searches_outside(updates, searches, stamp="start", **options):
    """Successful searches inside no window."""
    return interval_join(
        update_windows(updates, stamp),
        successful(searches),
        "timestamp",
        POINT_ID,
        how="left_anti",
        **options,
    )


def impact_by_type(updates, searches, by="query_type", stamp="start", **options):
    """Searches and their mean time during and outside updates per type, and the impact in percent.

    A search counts once, however many passes run beside it; times that are no numbers do
    not count for the means.
    """
    points = successful(searches).select("timestamp", "search_id", by, F.col("duration_ms").cast("double").alias("ms"))
    both = mark_inside(update_windows(updates, stamp), points, "timestamp", POINT_ID, "in", **options)
    inside, ms = F.col("in"), F.when(~F.isnan("ms"), F.col("ms"))
    return (
        both.groupBy(by)
        .agg(
            F.count_if(inside).alias("during_count"),
            F.avg(F.when(inside, ms)).alias("during"),
            F.count_if(~inside).alias("outside_count"),
            F.avg(F.when(~inside, ms)).alias("outside"),
        )
        .withColumn("impact_percent", impact_percent(F.col("during"), F.col("outside")))
    )


def window_stats(updates, searches, stamp="start", **options):
    """Search count and mean, median and longest duration of each window with searches, made without pairs."""
    points, bounds = successful(searches), ["window_start", "window_end"]
    windows = update_windows(updates, stamp).where(F.col("iteration").isNotNull())
    windows = windows.groupBy(*WINDOW, *bounds).agg(
        F.count("*").alias("weight"), *[F.max(c).alias(c) for c in ABOUT]
    )
    windows = stage(windows, "windows")
    sums = interval_sums(windows, points, "timestamp", "duration_ms", [*WINDOW, *bounds], **options)
    # rows of one stamp and iteration are one window, of whatever pieces
    pieces = stage(windows.join(sums, [*WINDOW, *bounds]), "window-sums")
    weight = F.col("weight")
    basics = pieces.groupBy(*WINDOW).agg(
        *[F.max(c).alias(c) for c in ABOUT],
        F.sum(weight * F.col("count")).alias("search_count"),
        F.sum(weight * F.col("total")).alias("total"),
    )
    last = F.sum(weight * F.col("count")).over(Window.partitionBy(*WINDOW)) - 1
    stretches = pieces.select(
        *WINDOW,
        "weight",
        "first",
        (F.col("first") + F.col("count")).alias("behind"),
        F.floor(last / 2).alias("low"),
        F.ceil(last / 2).alias("high"),
        last.alias("top"),
    )
    values = measured_points(windows, points, "timestamp", "duration_ms")
    ranked = values_at_ranks(values, ["at"], stretches, WINDOW, ["low", "high", "top"])
    low, high = F.col("low"), F.col("high")
    return basics.join(ranked, WINDOW).select(
        *WINDOW,
        *ABOUT,
        "search_count",
        (F.col("total") / F.col("search_count")).alias("avg_search_duration"),
        F.when(low == high, low).otherwise(low + (high - low) * 0.5).alias("median_search_duration"),
        F.col("top").alias("max_search_duration"),
    )


def window_means(updates, searches, stamp="start", **options):
    """Search count and mean search time of each window with searches, made without pairs."""
    return interval_totals(
        update_windows(updates, stamp),
        successful(searches),
        "timestamp",
        "duration_ms",
        [*WINDOW, *ABOUT],
        **options,
    ).select(
        *WINDOW,
        *ABOUT,
        F.col("count").alias("search_count"),
        F.col("mean").alias("avg_search_duration"),
    )


def window_count(updates, searches, stamp="start", **options):
    means = window_means(updates, searches, stamp, **options)
    return means.agg(F.count("*").alias("windows"))


def correlations(updates, searches, stamp="start", **options):
    """Correlation of pass duration and pass rate with the mean search time beside them."""
    means = window_means(updates, searches, stamp, **options)
    pairs = {
        "update_duration_vs_search_time": "update_duration",
        "update_rate_vs_search_time": "updates_per_second",
    }
    one_row = means.agg(
        *[
            correlation(F.col(column), F.col("avg_search_duration")).alias(name)
            for name, column in pairs.items()
        ]
    )
    return one_row.unpivot([], list(pairs), "pair", "correlation").withColumn(
        "label", correlation_label(F.col("correlation"))
    )


def update_impact(updates, searches, stamp="start", **options):
    """Mean search time during and outside updates, and the impact in percent.

    "During" is the mean of the window means, "outside" the mean over searches;
    `during_by_search` weighs the windows by their searches. Times that are no numbers do
    not count.
    """
    count = F.col("search_count")
    weighted = F.col("avg_search_duration") * count
    during = window_means(updates, searches, stamp, **options).agg(
        F.avg("avg_search_duration").alias("during"),
        F.try_divide(F.sum(weighted), F.sum(count).cast("double")).alias("during_by_search"),
    )
    ms = F.col("duration_ms").cast("double")
    outside = searches_outside(updates, searches, stamp, **options).agg(
        F.avg(F.when(~F.isnan(ms), ms)).alias("outside")
    )
    return during.withColumn("outside", outside.scalar()).withColumn(
        "impact_percent", impact_percent(F.col("during"), F.col("outside"))
    )


def impact_lines(updates, searches, stamp="start", **options):
    """The impact as lines of a report."""
    row = update_impact(updates, searches, stamp, **options).select(
        F.concat(fixed(F.col("during")), F.lit("ms")).alias("Search time during updates"),
        F.concat(fixed(F.col("outside")), F.lit("ms")).alias("Search time without updates"),
        signed_percent(F.col("impact_percent")).alias("Performance impact"),
    )
    return row.unpivot([], row.columns, "measure", "text")


def overlay(updates, searches):
    """Search points and update starts on one time line."""
    points = successful(searches).select("timestamp", F.lit("search").alias("kind"), "duration_ms")
    marks = updates.select(
        "timestamp", F.lit("update_start").alias("kind"), F.lit(None).cast("double").alias("duration_ms")
    )
    return reduce(lambda a, b: a.unionByName(b), [points, marks])


def search_series(searches):
    return successful(searches).select("timestamp", "duration_ms").orderBy("timestamp")


def update_series(updates):
    return updates.select("timestamp", "updates_per_second").orderBy("timestamp")
