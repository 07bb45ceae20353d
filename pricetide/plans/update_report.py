"""Summaries of an update log."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from pricetide.functions.measures import rate
from pricetide.plans.search_report import numeric_summary


def update_totals(updates):
    return updates.agg(
        F.count("*").alias("iterations"),
        F.coalesce(F.sum("success_count"), F.lit(0)).cast("long").alias("updated"),
        F.coalesce(F.sum("error_count"), F.lit(0)).cast("long").alias("errors"),
    )


def update_duration_summary(updates):
    return numeric_summary(updates, "duration_seconds")


def update_rate_summary(updates):
    return numeric_summary(updates, "updates_per_second")


def run_ids(updates, host=None):
    """Number the runs in a log whose iteration restarts with each run.

    Restarts are counted within hours and then over hours, so no task holds more than
    an hour of a log. `host` tells logs apart where several were read together.
    """
    log = ["_host", "_hour"]
    rows = updates.withColumns(
        {
            "_host": F.col(host) if host else F.lit(""),
            "_hour": F.date_trunc("hour", "timestamp"),
        }
    )
    inside = Window.partitionBy(*log).orderBy("timestamp")
    restarted = F.coalesce(F.lag("iteration").over(inside) > F.col("iteration"), F.lit(False))
    rows = rows.withColumn("_restarted", restarted.cast("long"))
    hours = rows.groupBy(*log).agg(
        F.min_by("iteration", "timestamp").alias("first"),
        F.max_by("iteration", "timestamp").alias("last"),
        F.sum("_restarted").alias("restarts"),
    )
    over = Window.partitionBy("_host").orderBy("_hour")
    opens = F.coalesce(F.lag("last").over(over) > F.col("first"), F.lit(False)).cast("long")
    upto = F.sum(F.col("restarts") + F.col("opens")).over(
        over.rowsBetween(Window.unboundedPreceding, 0)
    )
    hours = hours.withColumn("opens", opens).select(*log, (upto - F.col("restarts")).alias("_start"))
    upto = F.sum("_restarted").over(inside.rowsBetween(Window.unboundedPreceding, 0))
    return (
        rows.withColumn("_upto", upto)
        .join(hours, log)
        .withColumn("run_id", F.col("_start") + F.col("_upto"))
        .drop(*log, "_restarted", "_upto", "_start")
    )


def flag_partial(updates):
    """Mark passes that were stopped before all rows were tried."""
    tried = F.col("success_count") + F.col("error_count")
    return updates.withColumn("is_partial", tried < F.col("total_instruments"))


def log_checks(updates, tolerance=0.01):
    """Partial passes, rows counted twice and rates that do not fit their duration."""
    expected = rate(F.col("success_count"), F.col("duration_seconds"))
    tried = F.col("success_count") + F.col("error_count")
    # The stored duration is rounded to 2 places, so the rate may be off in proportion.
    slack = tolerance + expected * F.try_divide(F.lit(0.005), F.col("duration_seconds"))
    return flag_partial(updates).agg(
        F.count("*").alias("rows"),
        F.count_if("is_partial").alias("partial_passes"),
        F.count_if(tried > F.col("total_instruments")).alias("overcounted"),
        F.count_if(F.abs(F.col("updates_per_second") - expected) > slack).alias("odd_rates"),
    )
