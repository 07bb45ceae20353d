"""Posting lists of words in the order of prices, for searches that count and fetch.

All rows of all words stand in one order: by word, price and key, with the empty word for
every row. Each has its rank in that order, so the rows of a word within a price range are
the difference of two ranks, and the cheapest of them are the ranks that follow the first.
A rank is looked up as in a skip list: heads of spans, heads of blocks, rows of one block.
So neither a total nor its first hits depend on how many rows a word has.
"""

from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pricetide.functions.text import tokens
from pricetide.operators.skew import BROADCAST_ROWS, broadcast_if_small, is_small
from pricetide.workspace import stage

#: Bits of a rank inside its block, and inside its span. A look-up compares at most 2 ** 9 rows and heads.
BLOCK_BITS = 9
SPAN_BITS = 18

#: Bounds that are open: before every price, and behind every one, also one that is no number.
LOWEST, HIGHEST = float("-inf"), float("nan")

@dataclass
class PriceIndex:
    """`postings` (word, price, key, rank, block), and `heads` (word, price, rank, span, rows).

    Heads are the first postings of blocks and of words; those of words have `rows`, the
    number of rows that the word is in.
    """

    postings: DataFrame
    heads: DataFrame
    key: str

    @property
    def words(self):
        return self.heads.where("rows is not null").select("word", "rows", F.col("rank").alias("start"))


def postings(items, key, price, text=None, asked=None, inline_words=500):
    """A row for each word of each item, and one for the empty word, which every item has.

    Items without a price have none. `asked` is a frame of the words that will be looked
    for; few of them are picked out inside the scan, so that other words make no rows.
    """
    rows = items.select(
        key, F.col(price).cast("double").alias("price"), *([F.col(text).alias("_text")] if text else [])
    ).where(F.col("price").isNotNull())
    if text is None:
        return rows.withColumn("word", F.lit(""))
    found = F.coalesce(tokens(F.col("_text")), F.array().cast("array<string>"))
    few = asked is not None and is_small(asked, inline_words)
    found = F.array_intersect(found, asked.agg(F.collect_set("word")).scalar()) if few else F.array_distinct(found)
    # outer, as for a plain explode Spark would ask first whether there are words, and split the text for that
    rows = rows.select(key, "price", F.explode_outer(F.array_append(found, F.lit(""))).alias("word"))
    if asked is None or few:
        return rows
    every = asked.select("word").union(asked.sparkSession.range(1).select(F.lit("").alias("word")))
    return rows.join(broadcast_if_small(every.distinct()), "word", "left_semi")


def _begins(rank, bits):
    return F.col(rank).bitwiseAND(F.lit((1 << bits) - 1)) == 0


def write_index(listed, path, key="isin", mode="errorifexists"):
    """Sort postings and write them under `path` with what numbers them and their heads."""
    # texts are split up once, not again for the sample that the sort draws
    listed = stage(listed, "postings").orderBy("word", "price", key)
    listed.withColumn("place", F.monotonically_increasing_id()).write.mode(mode).parquet(f"{path}/postings")
    spark = listed.sparkSession
    # a row for each task that sorted: its rows stand behind those of the tasks before
    tasks = spark.read.parquet(f"{path}/postings").groupBy(F.shiftright("place", 33).alias("task"))
    before = Window.orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    tasks = tasks.agg(F.count("*").alias("rows")).select("task", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("before"))
    tasks.coalesce(1).write.mode(mode).parquet(f"{path}/tasks")
    postings = _postings(spark, path, key)
    words = postings.groupBy("word").agg(F.min(F.struct("rank", "price")).alias("first"), F.count("*").alias("rows"))
    words = words.select("word", "first.price", "first.rank", "rows")
    blocks = postings.where(_begins("rank", BLOCK_BITS)).select("word", "price", "rank")
    heads = blocks.unionByName(words, allowMissingColumns=True)
    heads.withColumn("span", F.shiftright("rank", SPAN_BITS)).write.mode(mode).parquet(f"{path}/heads")
    return read_index(spark, path, key)


def _postings(spark, path, key):
    """Sorted postings with their ranks; a row for each task that sorted them is broadcast."""
    rows = spark.read.parquet(f"{path}/postings").withColumn("task", F.shiftright("place", 33))
    rows = rows.join(F.broadcast(spark.read.parquet(f"{path}/tasks")), "task")
    rank = F.col("before") + F.col("place").bitwiseAND(F.lit((1 << 33) - 1))
    return rows.select("word", "price", key, rank.alias("rank"), F.shiftright(rank, BLOCK_BITS).alias("block"))


def read_index(spark, path, key="isin"):
    return PriceIndex(_postings(spark, path, key), spark.read.parquet(f"{path}/heads"), key)


def of_words(index, asked, max_words=BROADCAST_ROWS):
    """The index with the postings of the `asked` words alone, and of the empty word.

    At most `max_words` words are sent to the postings, so that those of others are left
    where they lie; for more, the index stays whole.
    """
    asked = asked.select("word").union(asked.sparkSession.range(1).select(F.lit("").alias("word"))).distinct()
    if not is_small(asked, max_words):
        return index
    asked = F.broadcast(asked)
    return replace(
        index,
        postings=index.postings.join(asked, "word", "left_semi"),
        # heads of spans and blocks of other words serve no look-up either
        heads=index.heads.join(asked, "word", "left_semi"),
    )


def slices(index, searches, few=False):
    """`searches` (word, low, high, ...) with `first` and `behind`, the ranks of their rows.

    `first` is the number of postings before the rows of the word from `low` on, `behind`
    of those up to `high`. Searches of words that no item has are left out, equal ones are
    one. `few` says that there are few enough for a broadcast, so that the index stays
    where it is.
    """
    mine = searches.columns
    sent = F.broadcast if few else (lambda marks: marks)
    # a mark for each bound: side 0 stands before the rows of its price, side 2 behind them
    marks = searches.select(
        *mine,
        F.inline(
            F.array(
                F.struct(F.col("low").alias("mark"), F.lit(0).alias("side")),
                F.struct(F.col("high").alias("mark"), F.lit(2).alias("side")),
            )
        ),
    )
    marks = index.words.select("word", "start").join(sent(marks), "word")

    # the last span head before each mark, in the merged order of both; one row in 2 ** SPAN_BITS is such a head
    spans = index.heads.where(_begins("rank", SPAN_BITS)).select(
        "word", F.col("price").alias("mark"), F.lit(1).alias("side"), F.col("rank").alias("start")
    )
    upto = Window.partitionBy("word").orderBy("mark", "side").rowsBetween(Window.unboundedPreceding, 0)
    last = F.max(F.when(F.col("side") == 1, F.col("start"))).over(upto)
    marks = marks.unionByName(spans, allowMissingColumns=True).withColumn("head", F.greatest("start", last))
    marks = marks.where("side != 1").drop("start")

    below = F.when(F.col("side") == 0, F.col("price") < F.col("mark")).otherwise(F.col("price") <= F.col("mark"))

    def met(marks, rows, bits, place):
        """Rows of the span or block of each mark's head, from the head on."""
        rows = rows.select(F.col("word").alias("_word"), "price", "rank", F.col(place).alias("_place"))
        met = rows.join(sent(marks.withColumn("_place", F.shiftright("head", bits))), "_place")
        return met.where((F.col("_word") == F.col("word")) & (F.col("rank") >= F.col("head")))

    # the head is among them, so every mark meets a row
    closer = F.greatest(F.max(F.when(below, F.col("rank"))), F.col("head")).alias("closer")
    marks = met(marks, index.heads, SPAN_BITS, "span").groupBy(*mine, "mark", "side", "head").agg(closer)
    marks = marks.select(*mine, "mark", "side", F.col("closer").alias("head"))

    def reached(side):
        mine = F.col("side") == side
        return F.coalesce(F.max(F.when(mine & below, F.col("rank") + 1)), F.max(F.when(mine, F.col("head"))))

    sliced = met(marks, index.postings, BLOCK_BITS, "block").groupBy(*mine)
    return sliced.agg(reached(0).alias("first"), F.greatest(reached(0), reached(2)).alias("behind"))


def rows_of(index, sliced, columns, few=False):
    """Postings of ranks from `first` to before `behind`, with `columns` of the slice.

    `few` says that the slices have few blocks, enough for a broadcast.
    """
    sliced = sliced.where("behind > first").select(
        *columns,
        "first",
        "behind",
        F.explode(F.sequence(F.shiftright("first", BLOCK_BITS), F.shiftright(F.col("behind") - 1, BLOCK_BITS))).alias("block"),
    )
    rows = index.postings.withColumnRenamed("word", "_word").join(F.broadcast(sliced) if few else sliced, "block")
    return rows.where((F.col("rank") >= F.col("first")) & (F.col("rank") < F.col("behind"))).select(
        *columns, "price", index.key, "rank", "first"
    )
