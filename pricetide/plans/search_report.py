"""Summaries of a search log."""

from pyspark.sql import functions as F

from pricetide.operators.quantiles import exact_quantiles, value_counts
from pricetide.operators.skew import split_hot_keys

QUARTILES = {"q1": 0.25, "median": 0.5, "q3": 0.75}


def successful(searches):
    return searches.where("success")


def failed(searches):
    return searches.where(~F.col("success"))


def search_totals(searches):
    return searches.agg(
        F.count("*").alias("total"),
        F.count_if(F.col("success")).alias("successful"),
        F.count_if(~F.col("success")).alias("failed"),
        (100 * F.avg(F.col("success").cast("double"))).alias("success_rate"),
    )


def _median_of(df, value):
    """Exact median of a whole column as a scalar."""
    counts = value_counts(df.select(value), [], value).withColumn("everything", F.lit(1))
    return exact_quantiles(counts, ["everything"], {"median": 0.5}).select("median").scalar()


def numeric_summary(df, value, deviation=False):
    """Mean, median, least and greatest value of a column; also its sample deviation.

    Values that are no numbers are left out of all of them.
    """
    df = df.withColumn(value, F.when(~F.isnan(value), F.col(value)))
    extra = [F.stddev_samp(value).alias("stddev")] if deviation else []
    summary = df.agg(
        F.avg(value).alias("mean"), F.min(value).alias("min"), F.max(value).alias("max"), *extra
    )
    return summary.withColumn("median", _median_of(df, value))


def duration_summary(searches):
    return numeric_summary(successful(searches), "duration_ms", deviation=True)


def duration_by(searches, group):
    """Mean, median and number of successful searches per group."""
    return summary_of_counts(value_counts(successful(searches), [group], "duration_ms"), [group])


def summary_of_counts(counts, by, attributes=()):
    """Mean, median, greatest value and number of rows per group, from value counts.

    Both halves read the same shuffled counts, so the source is scanned once.
    """
    n, value = F.col("n"), F.col("value")
    basics = counts.groupBy(*by).agg(
        (F.sum(value * n) / F.sum(n)).alias("mean"),
        F.max(value).alias("max"),
        F.sum(n).alias("count"),
        *[F.max(a).alias(a) for a in attributes],
    )
    return basics.join(exact_quantiles(counts, by, {"median": 0.5}), by)


def approximate_summary(df, by, value, accuracy=10_000):
    """As `duration_by`, with a median off by at most rows / accuracy ranks.

    Keeps a sketch per group instead of its values: for streams that run for long, as the
    totals of `log_stream.start_totals`. What is no number is left out.
    """
    number = _numbers_of(value)
    return df.groupBy(*by).agg(
        F.avg(number).alias("mean"),
        F.percentile_approx(number, 0.5, accuracy).alias("median"),
        F.max(number).alias("max"),
        F.count(number).alias("count"),
    )


#: Size of a quantile sketch, and how far a quantile's rank may be off, as a share of the rows (in 99 of 100 cases).
SKETCH_SIZE, RANK_ERROR = 1000, 0.0028


def sketch_summary(df, by, value, quantiles=None):
    """Mean, greatest value, rows and quantiles per group, the quantiles from a sketch.

    The sketch has a bounded size whatever its rows, and sketches of parts merge into that of
    the whole, so it serves as state of a stream; `quantiles` maps names to probabilities,
    each met within `RANK_ERROR`. What is no number is left out. For exact quantiles see
    `summary_of_counts`.
    """
    number = _numbers_of(value)
    sketch = F.kll_sketch_agg_double(number, SKETCH_SIZE)
    return df.groupBy(*by).agg(
        F.avg(number).alias("mean"),
        F.max(number).alias("max"),
        F.count(number).alias("count"),
        sketch.alias("sketch"),
    ).select(
        *by,
        "mean",
        "max",
        "count",
        *[
            F.when(F.col("count") > 0, F.kll_sketch_get_quantile_double("sketch", F.lit(p))).alias(name)
            for name, p in (quantiles or {"median": 0.5}).items()
        ],
    )


def _numbers_of(value):
    number = F.col(value).cast("double")
    return F.when(~F.isnan(number), number)


def over_time(searches, width="1 hour", by="query_type", value="duration_ms"):
    """Number, mean and greatest duration of successful searches per time window and type.

    Windows follow each other without overlap. Works on streams too, whose watermark
    bounds the windows kept as state.
    """
    number = F.col(value).cast("double")
    number = F.when(~F.isnan(number), number)
    windows = successful(searches).groupBy(F.window("timestamp", width).alias("window"), by).agg(
        F.count("*").alias("count"), F.avg(number).alias("mean"), F.max(number).alias("max")
    )
    return windows.select(F.col("window.start").alias("window_start"), by, "count", "mean", "max")


def box_stats(searches, group="query_type", value="duration_ms"):
    """Quartiles, whiskers within 1.5 quartile ranges and outlier counts per group."""
    counts = value_counts(successful(searches), [group], value)
    marked = _fenced(counts, group)
    inside = F.col("value").between(F.col("low_fence"), F.col("high_fence"))
    return marked.groupBy(group).agg(
        *[F.max(q).alias(q) for q in QUARTILES],
        F.min(F.when(inside, F.col("value"))).alias("low_whisker"),
        F.max(F.when(inside, F.col("value"))).alias("high_whisker"),
        F.coalesce(F.sum(F.when(~inside, F.col("n"))), F.lit(0)).cast("long").alias("outliers"),
    )


def fences(counts, by):
    quartiles = exact_quantiles(counts, by, QUARTILES)
    reach = 1.5 * (F.col("q3") - F.col("q1"))
    return quartiles.withColumn("low_fence", F.col("q1") - reach).withColumn(
        "high_fence", F.col("q3") + reach
    )


def _fenced(counts, group):
    """Value counts beside the fences of their group; groups with many values are split."""
    counts, limits = split_hot_keys(counts, fences(counts, [group]), [group], ["value"])
    return counts.join(limits, [group, "_split"]).drop("_split")


def box_outliers(searches, group="query_type", value="duration_ms"):
    """The values outside the whiskers, with how often each occurs."""
    counts = value_counts(successful(searches), [group], value)
    return _fenced(counts, group).where(~F.col("value").between(F.col("low_fence"), F.col("high_fence"))).select(
        group, "value", "n"
    )


def query_types(searches):
    return searches.select("query_type").distinct()
