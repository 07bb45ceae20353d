"""Connected components of a table of links, by contraction."""

from pyspark.sql import functions as F

from pricetide.llm.scratch import Scratch

MAX_ROUNDS = 60


def components(links, a="a", b="b"):
    """(node, component) for every node of `links`; component is the smallest node reached.

    In each round every node moves to the one among itself and its neighbours that a hash,
    another in each round, puts first, and links between moved nodes remain. A constant part
    of the nodes goes in each round whatever the shape, so a long chain takes a logarithmic
    number of rounds. Moves and links of a round are written to the shared folder; a hub's
    links meet only in partial minima and in joins that can be split. Links with a null end
    are left out. No links give no rows.
    """
    scratch = Scratch(links.sparkSession)
    edges = scratch.write(
        links.select(F.col(a).alias("a"), F.col(b).alias("b")).where("a is not null and b is not null").distinct(),
        "links",
    )
    total, first = None, edges
    for number in range(MAX_ROUNDS):
        open_edges = edges.where("a != b")
        if open_edges.isEmpty():
            break
        both = open_edges.select("a", "b").unionByName(open_edges.select(F.col("b").alias("a"), F.col("a").alias("b")))

        def rank(c):
            return F.struct(F.xxhash64(F.lit(number), c).alias("h"), c.alias("n"))

        moves = both.groupBy(F.col("a").alias("node")).agg(F.min(rank(F.col("b"))).alias("near"))
        moves = scratch.write(moves.select("node", F.least("near", rank(F.col("node")))["n"].alias("to")), "moves")
        left = moves.select(F.col("node").alias("a"), F.col("to").alias("to_a"))
        right = moves.select(F.col("node").alias("b"), F.col("to").alias("to_b"))
        moved = open_edges.join(left, "a").join(right, "b").where("to_a != to_b")
        ends = F.least("to_a", "to_b").alias("a"), F.greatest("to_a", "to_b").alias("b")
        edges = scratch.write(moved.select(*ends).distinct(), "links")
        if total is None:
            total = moves
        else:
            ahead = moves.select(F.col("node").alias("to"), F.col("to").alias("next"))
            total = scratch.write(
                total.join(ahead, "to", "left").select("node", F.coalesce("next", "to").alias("to")), "moves"
            )
    else:
        raise RuntimeError(f"links were left after {MAX_ROUNDS} rounds")
    if total is None:
        return first.where("a != b").select(F.col("a").alias("node"), F.col("a").alias("component"))
    scratch.clear(total)
    smallest = total.groupBy("to").agg(F.min("node").alias("component"))
    return total.join(smallest, "to").select("node", "component")
