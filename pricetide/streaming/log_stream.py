"""Summaries that follow growing logs.

The stream's state is the count of each value per group, spread over tasks by value.
Each trigger turns the counts into exact means and medians.
"""

from pyspark.sql import functions as F

from pricetide.plans.search_report import over_time, summary_of_counts


def _counted(logs, by, value):
    number = F.col(value).cast("double")
    return logs.where(number.isNotNull() & ~F.isnan(number)).groupBy(*by, number.alias("value")).agg(
        F.count("*").alias("n")
    )


def start_summary(logs, out, checkpoint, by=("query_type",), value="duration_ms", trigger=None):
    """Keep mean, median, greatest value and rows per group.

    Each trigger writes the summary whole to its own folder. Without groups the log is
    one group, `everything`.
    """
    if not by:
        by, logs = ["everything"], logs.withColumn("everything", F.lit("all"))
    by = list(by)

    def write(counts, batch_id):
        # The state is read once: the summary needs its counts more than once, but only now.
        kept = f"{out}/counts"
        counts.write.mode("overwrite").parquet(kept)
        counts = counts.sparkSession.read.parquet(kept)
        summary_of_counts(counts, by).write.mode("overwrite").parquet(f"{out}/summary/batch={batch_id}")

    return (
        _counted(logs, by, value)
        .writeStream.outputMode("complete")
        .foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def start_totals(totals, out, checkpoint, trigger=None):
    """Keep the totals of a log: any one-row aggregation of a stream."""

    def write(row, batch_id):
        row.write.mode("overwrite").parquet(f"{out}/summary/batch={batch_id}")

    return (
        totals.writeStream.outputMode("complete")
        .foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def start_over_time(logs, out, checkpoint, width="1 hour", late="1 day", by="query_type", trigger=None):
    """Keep the figures of `over_time` for each time window.

    Each trigger writes the windows it changed to its own folder. Windows that ended more
    than `late` before the newest search leave the state; searches later still do not count.
    """

    def write(windows, batch_id):
        windows.write.mode("overwrite").parquet(f"{out}/windows/batch={batch_id}")

    return (
        over_time(logs.withWatermark("timestamp", late), width, by)
        .writeStream.outputMode("update")
        .foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def windows_so_far(spark, out, by="query_type"):
    """The last figures written for each time window."""
    written = spark.read.parquet(f"{out}/windows")
    figures = F.struct("count", "mean", "max")
    return written.groupBy("window_start", by).agg(F.max_by(figures, "batch").alias("last")).select(
        "window_start", by, "last.*"
    )


def latest_summary(spark, out):
    """The summary of the last finished trigger."""
    all_summaries = spark.read.parquet(f"{out}/summary")
    last = all_summaries.agg(F.max("batch")).scalar()
    return all_summaries.where(F.col("batch") == last).drop("batch")
