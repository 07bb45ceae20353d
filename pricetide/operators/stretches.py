"""Values of given ranks inside stretches of a sequence, without a row for each value of a stretch.

The values of all rows have a rank each. The rows stand in a tree of ranks: a node holds the
rows whose ranks share their first digits, in the order of the sequence. A stretch is two
marks, its places in the root; a node tells how many rows of each child stand before a
mark, so the marks of a stretch say which child holds a wanted rank and where its rows begin
and end there. So a stretch costs a few rows for each digit, however many values it holds,
and the tree has as many rows on each level as there are values.
"""

from pyspark.sql import Window
from pyspark.sql import functions as F

from pricetide.operators.ranking import number_rows
from pricetide.workspace import stage

#: Bits of a rank that a level reads, and bits of a place inside its block, which one task counts through.
DIGIT_BITS = 5
BLOCK_BITS = 12


def _blocks_before(points, digits):
    """Rows of each digit up to it that stand before each block of each node, but for the first blocks."""
    blocks = points.groupBy("node", "block").agg(*[F.count_if(F.col("digit") <= d).alias(f"d{d}") for d in range(digits)])
    upto = Window.partitionBy("node").orderBy("block").rowsBetween(Window.unboundedPreceding, 0)
    sums = F.array(*[F.sum(f"d{d}").over(upto) for d in range(digits)])
    return blocks.select("node", (F.col("block") + 1).alias("block"), sums.alias("before"))


def _of(upto, digit):
    """Rows of a digit, from the rows of each digit up to it."""
    return F.get(upto, digit) - F.coalesce(F.get(upto, digit - 1), F.lit(0))


def _passed(upto, rank):
    """How many digits have all their rows before a rank."""
    return F.size(F.filter(upto, lambda rows: rows <= F.col(rank)))


def _level(points, marks, by, names, bits, left, last):
    """Points and marks of the next level, whose nodes have `bits` more bits; `left` remain behind them."""
    digits = 1 << bits
    # nodes of this level hold no more rows than this
    many = bits + left > BLOCK_BITS
    block = (F.shiftright("pos", BLOCK_BITS) if many else F.lit(0)).cast("long").alias("block")
    digit = F.shiftright("rank", left).bitwiseAND(F.lit(digits - 1)).cast("int").alias("digit")
    points = points.select("node", block, "pos", "rank", digit)
    before = _blocks_before(points, digits) if many else None

    def with_before(df):
        if before is None:
            return df.withColumn("before", F.lit(None).cast("array<long>"))
        return df.join(before, ["node", "block"], "left")

    # dealt and sorted first, so that the counters are made where they are summed up
    rows = points.select("node", block, "pos", F.lit(1).alias("side"), "digit").unionByName(
        marks.select(*by, "node", block, "pos", F.lit(0).alias("side"), "weight", *names), allowMissingColumns=True
    )
    rows = rows.repartition("node", "block").sortWithinPartitions("node", "block", "pos", "side")
    so_far = Window.partitionBy("node", "block").orderBy("pos", "side").rowsBetween(Window.unboundedPreceding, 0)
    upto = F.array(*[F.count(F.when(F.col("digit") <= d, 1)).over(so_far) for d in range(digits)])
    counted = with_before(rows.withColumn("inside", upto).where("side = 0"))
    upto = F.when(F.col("before").isNull(), F.col("inside")).otherwise(
        F.zip_with("inside", "before", lambda inside, before: inside + before)
    )
    counted = counted.select(*by, "node", "weight", *names, upto.alias("upto"))

    # rows of the whole of a stretch's pieces, by digits
    counted = counted.repartition(*by, "node").sortWithinPartitions(*by, "node")
    whole = Window.partitionBy(*by, "node")
    total = F.array(*[F.sum(F.get("upto", F.lit(d)) * F.col("weight")).over(whole) for d in range(digits)])
    found = counted.withColumn("total", total)
    child = {n: f"_child_{n}" for n in names}
    found = found.withColumns({c: F.when(F.col(n).isNotNull(), _passed("total", n)) for n, c in child.items()})
    children = F.array_distinct(F.array_compact(F.array(*child.values())))
    kid = F.col("digit")
    skipped = F.coalesce(F.get("total", kid - 1), F.lit(0))
    marks = found.withColumn("digit", F.explode(children)).select(
        *by,
        (F.shiftleft("node", bits) + kid).alias("node"),
        _of("upto", kid).alias("pos"),
        "weight",
        *[F.when(F.col(c) == kid, F.col(n) - skipped).alias(n) for n, c in child.items()],
    )
    marks = stage(marks, "marks")
    if last:
        return None, marks
    place = Window.partitionBy("node", "block", "digit").orderBy("pos")
    moved = with_before(points.withColumn("place", F.row_number().over(place) - 1))
    moved = moved.select(
        (F.shiftleft("node", bits) + kid).alias("node"),
        (F.col("place") + F.coalesce(_of("before", kid), F.lit(0))).alias("pos"),
        "rank",
    )
    return stage(moved, "places"), marks


def values_at_ranks(values, order, stretches, by, names):
    """The values that have given ranks, counted from 0, among those of each group's stretches.

    `values` has a column `value`; `order` are the columns of its sequence. `stretches` has
    the group (`by`, not NULL), `first` and `behind`, the places in the sequence where a
    stretch begins and ends, `weight`, how many times its values count, and the columns
    `names`, ranks that are the same in all rows of a group and less than its values.
    """
    placed = number_rows(values.select(*dict.fromkeys([*order, "value"])), *dict.fromkeys([*order, "value"]), name="pos")
    placed = placed.select((F.col("pos") - 1).alias("pos"), "value")
    ranked = number_rows(placed, "value", "pos", name="rank").withColumn("rank", F.col("rank") - 1)
    bits = max(ranked.count() - 1, 0).bit_length()

    start = F.lit(0).cast("long").alias("node")
    points = ranked.select(start, "pos", "rank")
    ends = F.array(
        F.struct(F.col("first").alias("pos"), (-F.col("weight")).alias("weight")),
        F.struct(F.col("behind").alias("pos"), F.col("weight").alias("weight")),
    )
    marks = stretches.select(*by, *names, start, F.inline(ends))
    while bits:
        step = min(bits, DIGIT_BITS)
        bits -= step
        points, marks = _level(points, marks, by, names, step, bits, not bits)

    # a node is a rank now; the look-ups of all names share the shuffle of the ranks
    found = marks.groupBy(*by).agg(*[F.max(F.when(F.col(n).isNotNull(), F.col("node"))).alias(n) for n in names])
    for n in names:
        found = found.join(ranked.select(F.col("rank").alias(n), (F.col("value") + 0.0).alias(f"_{n}")), n)
    return found.select(*by, *[F.col(f"_{n}").alias(n) for n in names])
