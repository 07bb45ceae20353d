"""Exact quantiles from counts of values, for groups of any size."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from pricetide.functions.measures import order_bits

# Bits a pass leaves unread, most first: sign, exponent and ten bits of the mantissa, then
# 21 more; the last pass is on the values, which differ in 21 bits at most by then.
PASSES = (42, 21)


def value_counts(df, by, value, attributes=()):
    """Rows per group and distinct value. Repeats combine before the shuffle.

    Rows without a group or a value do not count. That is said here for every column,
    so that later joins have no null tests to push down and all readers of the counts
    share one shuffle. `attributes` are columns that are the same within a group.
    """
    number = F.col(value).cast("double")
    df = df.where(number.isNotNull() & ~F.isnan(number))
    for column in by:
        df = df.where(F.col(column).isNotNull())
    return (
        df.select(*by, *attributes, number.alias("value"))
        .groupBy(*by, "value")
        .agg(F.count("*").alias("n"), *[F.max(a).alias(a) for a in attributes])
    )


def exact_quantiles(counts, by, quantiles, passes=PASSES):
    """Quantiles with linear interpolation, one row per group.

    `counts` comes from `value_counts`, `quantiles` maps output names to
    probabilities. The ranks are found by radix selection: counting by the first bits of
    the values finds the bin that holds a wanted rank, and only its values go on to the
    next pass, which reads more bits. So a task sees at most 2 ** 22 bins of a group,
    however close together or far apart its values lie, and never the group itself.
    """
    last = F.col("rows") - 1
    wanted = F.array_distinct(
        F.concat(
            *[
                F.array(F.floor(last * F.lit(p)), F.ceil(last * F.lit(p)))
                for p in quantiles.values()
            ]
        )
    )
    whole = Window.partitionBy(*by)
    upto = whole.orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)

    # First pass: counts per bin and group hold all wanted ranks at once.
    binned = counts.withColumn("bin", F.shiftright(order_bits(F.col("value")), passes[0]))
    targets = (
        binned.groupBy(*by, "bin")
        .agg(F.sum("n").alias("n"))
        .withColumn("upto", F.sum("n").over(upto))
        .withColumn("rows", F.sum("n").over(whole))
        .withColumn("rank", F.explode(wanted))
        .where((F.col("rank") < F.col("upto")) & (F.col("rank") >= F.col("upto") - F.col("n")))
        .select(*by, "bin", "rows", "rank", (F.col("rank") - F.col("upto") + F.col("n")).alias("left"))
    )

    # Further passes: only the bins that hold a rank, then the values themselves.
    for step in [*passes[1:], None]:
        finer = F.col("value") if step is None else F.shiftright(order_bits(F.col("value")), step)
        ranked = [*by, "rank"]
        upto = Window.partitionBy(*ranked).orderBy("finer").rowsBetween(Window.unboundedPreceding, 0)
        targets = (
            binned.join(targets, [*by, "bin"])
            .withColumn("finer", finer)
            .groupBy(*ranked, "rows", "left", "finer")
            .agg(F.sum("n").alias("n"))
            .withColumn("upto", F.sum("n").over(upto))
            .where((F.col("left") < F.col("upto")) & (F.col("left") >= F.col("upto") - F.col("n")))
            .withColumn("left", F.col("left") - F.col("upto") + F.col("n"))
            .select(*by, "rank", "rows", "left", F.col("finer").alias("bin"))
        )
        if step is not None:
            binned = counts.withColumn("bin", finer)

    # At most two ranks per quantile and group are left.
    found = targets.groupBy(*by).agg(
        F.first("rows").alias("rows"),
        F.map_from_entries(F.collect_list(F.struct("rank", F.col("bin").alias("value")))).alias("at"),
    )

    def interpolated(p):
        place = last * F.lit(float(p))
        low = F.element_at("at", F.floor(place))
        high = F.element_at("at", F.ceil(place))
        return low + (high - low) * (place - F.floor(place))

    return found.select(*by, *[interpolated(p).alias(name) for name, p in quantiles.items()])
