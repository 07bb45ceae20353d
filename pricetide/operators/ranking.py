"""Running totals and row numbers without a single-task sort."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from pricetide.functions.measures import order_bins
from pricetide.workspace import stage


def running_totals(df, group, bin, order, totals):
    """Running sums within `group` in the given order; `totals` maps amounts to names.

    Sums run inside bins, which have to follow the order, and start from the totals of
    the bins before: a group with many rows is worked on by many tasks. Rows are best
    pre-aggregated, to a few per distinct value.
    """
    binned = df.withColumn("_bin", bin)
    bins = binned.groupBy(*group, "_bin").agg(*[F.sum(a).alias(a) for a in totals])
    before = Window.partitionBy(*group).orderBy("_bin").rowsBetween(Window.unboundedPreceding, -1)
    starts = bins.select(
        *group,
        "_bin",
        *[F.coalesce(F.sum(a).over(before), F.lit(0)).alias(f"_from_{a}") for a in totals],
    )
    inside = (
        Window.partitionBy(*group, "_bin").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    )
    runs = binned.withColumns({f"_run_{a}": F.sum(a).over(inside) for a in totals})
    summed = runs.join(starts, [*group, "_bin"]).withColumns(
        {name: F.col(f"_from_{a}") + F.col(f"_run_{a}") for a, name in totals.items()}
    )
    return summed.drop("_bin", *[f"_{part}_{a}" for part in ("from", "run") for a in totals])


def running_total(df, group, value, then, amount, total, bins_per_unit=4096):
    """Running sum of `amount` within `group`, ordered by `value` and `then`."""
    bin = order_bins(F.col(value), bins_per_unit)
    return running_totals(df, group, bin, [value, *then], {amount: total}).withColumn(
        total, F.col(total).cast("long")
    )


def number_rows(df, *order, name="row_number"):
    """1-based row numbers over a total order.

    A range sort spreads the rows over tasks; the written copy keeps each row's
    task and place in it, and the rows per task (one number per task) give the
    offsets. The order columns have to identify a row.
    """
    placed = stage(
        df.orderBy(*order).withColumn("_place", F.monotonically_increasing_id()), "numbered"
    )
    # The id holds the task in its upper 31 bits and the place in the lower 33.
    placed = placed.withColumn("_task", F.shiftright("_place", 33)).withColumn(
        "_place", F.col("_place").bitwiseAND(F.lit((1 << 33) - 1))
    )
    before = Window.orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        placed.groupBy("_task")
        .agg(F.count("*").alias("_rows"))
        .select("_task", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before"))
    )
    return (
        placed.join(F.broadcast(offsets), "_task")
        .withColumn(name, F.col("_before") + F.col("_place") + 1)
        .drop("_task", "_place", "_before")
    )


def batch_numbers(df, *order, batch_size=1000):
    """Row number, batch number and the batch's row range, over a total order."""
    numbered = number_rows(df, *order)
    batch = F.floor((F.col("row_number") - 1) / batch_size) + 1
    return numbered.withColumn("batch", batch).withColumn(
        "batch_start", (F.col("batch") - 1) * batch_size + 1
    )


def first_per_group(df, group, order, n, rank="rank"):
    """First `n` rows of each group. Spark cuts each task to n rows before the shuffle."""
    window = Window.partitionBy(*group).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(window)).where(F.col(rank) <= n)
