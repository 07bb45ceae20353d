"""Single searches over an instruments-like table."""

from functools import reduce

from pyspark.sql import Observation
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StructField, StructType

from pricetide.functions.measures import capped_hits
from pricetide.functions.text import (
    has_all_terms,
    has_any_term,
    may_have_any_term,
    preview,
    query_terms,
    tokens,
)


def in_range(price, low, high):
    """Both bounds inclusive; a bound that is None is open."""
    tests = []
    if low is not None:
        tests.append(F.col(price) >= low)
    if high is not None:
        tests.append(F.col(price) <= high)
    return reduce(lambda a, b: a & b, tests, F.lit(True))


def search_filter(query_type, low=None, high=None, terms=None, price="price", text="long_name"):
    """Condition of one search request."""
    if query_type == "price_range":
        return in_range(price, low, high)
    if query_type == "text_search":
        return has_all_terms(F.col(text), terms)
    if query_type == "combined":
        return in_range(price, low, high) & has_all_terms(F.col(text), terms)
    raise ValueError(f"Unknown query type: {query_type}")


def cheapest(df, n=100, price="price", key="isin"):
    """First n rows by price, ties by key: a top-n per task, then one small merge."""
    return df.orderBy(price, key).limit(n)


def any_term(df, terms, text="long_name"):
    return df.where(has_any_term(F.col(text), terms))


def longer_than(df, characters=150, text="long_name"):
    return df.where(F.length(text) > characters)


def first_rows(df, n, key="isin"):
    return df.orderBy(key).limit(n)


def hit_summary(df, condition, size=100, sample=3, price="price", key="isin", text="long_name"):
    """Hits in all, hits a capped counter shows, hits returned, and the first few.

    One scan, at once: the hits are counted on their way to the first `sample` of them,
    of which each task keeps no more. Nothing is written.
    """
    counted = Observation()
    hits = df.where(condition).select(key, price, preview(F.col(text)).alias(text))
    few = cheapest(hits.observe(counted, F.count("*").alias("hits")), sample, price, key).collect()
    total = F.col("total_hits")
    row = [(counted.get.get("hits", 0), few)]
    kind = StructType([StructField("total_hits", LongType()), StructField("few", ArrayType(hits.schema))])
    return df.sparkSession.createDataFrame(row, kind).select(
        "total_hits",
        capped_hits(total).alias("total_hits_capped"),
        (total > 10_000).alias("total_is_lower_bound"),
        F.least(total, F.lit(size)).alias("returned_hits"),
        F.col("few").alias("sample_data"),
    )


def price_stats(df, price="price"):
    """Smallest, largest and average price; fixed stand-ins for an empty table.

    Prices that are no numbers are left out of all three.
    """
    # The statistics assumed when there are none.
    smallest, largest, average = 1.0, 5000.0, 250.0
    value = F.col(price).cast("double")
    value = F.when(~F.isnan(value), value)
    return df.agg(
        F.coalesce(F.min(value), F.lit(smallest)).alias("min_price"),
        F.coalesce(F.max(value), F.lit(largest)).alias("max_price"),
        F.coalesce(F.avg(value), F.lit(average)).alias("avg_price"),
    )


def length_stats(df, text="long_name"):
    size = F.length(text).cast("long")
    return df.agg(
        F.avg(size).alias("avg_length"), F.min(size).alias("min_length"), F.max(size).alias("max_length")
    )


def row_count(df):
    return df.agg(F.count("*").alias("rows"))


def table_profile(df, key="isin", price="price"):
    """Rows, price range and mean, and distinct key prefixes."""
    return df.agg(
        F.count("*").alias("rows"),
        F.min(price).alias("min_price"),
        F.max(price).alias("max_price"),
        F.avg(F.col(price).cast("double")).alias("avg_price"),
        F.count_distinct(F.substring(key, 1, 2)).alias("countries"),
    )


def _with_term_counts(df, text, terms):
    """Add the words of a row and how often each term occurs among them."""
    words = F.col("_words")
    return df.withColumn("_words", tokens(F.col(text))).withColumns(
        {f"_tf{i}": F.size(words) - F.size(F.array_remove(words, t)) for i, t in enumerate(terms)}
    )


def text_statistics(df, text, query):
    """Rows, mean words per row, and rows with each word of `query`: one row.

    Needs the words of every row; write it out to search the same table again.
    """
    terms = query_terms(query)
    rows = _with_term_counts(df.where(F.col(text).isNotNull()).select(text), text, terms)
    return rows.agg(
        F.count("*").alias("docs"),
        F.avg(F.size("_words")).alias("avg_words"),
        *[F.count_if(F.col(f"_tf{i}") > 0).alias(f"with_term{i}") for i in range(len(terms))],
    )


def by_relevance(
    df, text, query, n=3, key="isin", where=None, statistics=None, k1=1.2, b=0.75
):
    """First n rows by BM25 over rows with any word of `query`, ties by key.

    One scan sums up the table into a single row, unless its `text_statistics` are
    given; one scores the rows that match. Rows never move before the final top n.
    `where` narrows the rows, not the statistics.
    """
    terms = query_terms(query)
    if not terms:
        return df.limit(0).withColumn("score", F.lit(0.0))
    if statistics is None:
        statistics = text_statistics(df, text, query)
    maybe = may_have_any_term(F.col(text), terms)
    rows = _with_term_counts(df.where(maybe if where is None else maybe & where), text, terms)
    rows = rows.withColumn("_stats", statistics.select(F.struct("*")).scalar())
    length = 1 - b + b * F.size("_words") / F.col("_stats.avg_words")
    score = F.lit(0.0)
    for i in range(len(terms)):
        docs, with_term = F.col("_stats.docs"), F.col(f"_stats.with_term{i}")
        idf = F.log(1 + (docs - with_term + 0.5) / (with_term + 0.5))
        tf = F.col(f"_tf{i}")
        score = score + idf * tf / (tf + k1 * length)
    best = rows.select(*df.columns, score.alias("score")).orderBy(F.desc("score"), key).limit(n)
    # Rows without any of the words score 0. Tested before the limit, the score would be
    # worked out twice.
    return best.where("score > 0")
