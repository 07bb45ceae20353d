"""Equi-joins that keep one hot key from becoming one task."""

from pyspark.sql import functions as F

ROWS_PER_TASK = 4_000_000
BROADCAST_ROWS = 100_000


def is_small(df, max_rows=BROADCAST_ROWS):
    """Whether a frame has at most `max_rows` rows.

    Asks for one constant behind that many, which Spark looks for in a few partitions
    first, so a large frame is told by its first tasks.
    """
    return not df.select(F.lit(1)).offset(max_rows).take(1)


def broadcast_if_small(df, max_rows=BROADCAST_ROWS):
    """Mark a narrow frame for broadcast when it has at most `max_rows` rows.

    The other side of a join then stays where it is from the start; without the mark a
    large side may be shuffled before the small one is known to be small.
    """
    return F.broadcast(df) if is_small(df, max_rows) else df


def split_hot_keys(left, right, keys, left_id, right_id=None, rows_per_task=ROWS_PER_TASK):
    """Spread the rows of hot join keys over several splits.

    Adds a `_split` column to both sides; joining on `keys + ["_split"]` gives what joining
    on `keys` gave. A hot key's rows are divided by a hash of their id columns and meet a
    copy of the other side's rows in each split. Without `right_id` only the left side is
    divided, so that left rows have no copies and outer or anti joins stay right.

    The table of hot keys has at most rows / rows_per_task rows, which is what makes it
    fit for broadcast.
    """

    def hot(df, name, other):
        rows = df.groupBy(*keys).agg(F.count("*").alias("rows")).where(F.col("rows") > rows_per_task)
        return rows.select(
            *keys,
            F.ceil(F.col("rows") / rows_per_task).alias(name),
            F.lit(1).cast("long").alias(other),
        )

    table = hot(left, "_left_splits", "_right_splits")
    if right_id is not None:
        table = table.unionByName(hot(right, "_right_splits", "_left_splits"))
        table = table.groupBy(*keys).agg(
            F.max("_left_splits").alias("_left_splits"), F.max("_right_splits").alias("_right_splits")
        )
    one = F.lit(1).cast("long")
    lefts, rights = F.coalesce("_left_splits", one), F.coalesce("_right_splits", one)

    def all_of(splits):
        return F.explode(F.sequence(F.lit(0).cast("long"), splits - 1))

    left = left.join(F.broadcast(table), keys, "left")
    right = right.join(F.broadcast(table), keys, "left")
    left = left.withColumn("_left_split", F.pmod(F.xxhash64(*left_id), lefts))
    right = right.withColumn("_left_split", all_of(lefts))
    if right_id is not None:
        right = right.withColumn("_right_split", F.pmod(F.xxhash64(*right_id), rights))
        left = left.withColumn("_right_split", all_of(rights))
        split = F.col("_left_split") * rights + F.col("_right_split")
    else:
        split = F.col("_left_split")
    helpers = ["_left_split", "_right_split", "_left_splits", "_right_splits"]
    return (
        left.withColumn("_split", split).drop(*helpers),
        right.withColumn("_split", split).drop(*helpers),
    )
