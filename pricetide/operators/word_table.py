"""A table of the words of a text column, for searching the same texts again and again.

One row per key and word, and one per key for the empty word, which every text has. Written
in the order of words it answers a search from the few row groups that hold the asked words;
the rows of the empty word give the number of texts and their lengths. The texts are not
read again.
"""

from pyspark.sql import functions as F

from pricetide.functions.text import query_terms, tokens
from pricetide.workspace import stage


def word_counts(df, text, key="isin"):
    """Key, word, how often it occurs in the text, and the words of the text in all, counted row by row.

    A text without words has the row of the empty word only; without text there is no row.
    """
    rows = df.select(key, F.sort_array(tokens(F.col(text))).alias("_words")).withColumn("length", F.size("_words"))
    # places behind the last of each word, among the sorted words
    last = F.filter(
        F.sequence(F.lit(1), "length"),
        lambda i: (i == F.col("length")) | (F.get("_words", i) != F.get("_words", i - 1)),
    )
    rows = rows.withColumn("_ends", F.when(F.col("length") > 0, last).otherwise(F.array().cast("array<int>")))

    def counted(end, i):
        times = end - F.coalesce(F.get("_ends", i - 1), F.lit(0))
        return F.struct(F.get("_words", end - 1).alias("word"), times.cast("long").alias("times"))

    empty = F.struct(F.lit("").alias("word"), F.lit(1).cast("long").alias("times"))
    every = F.array_append(F.transform("_ends", counted), empty)
    return rows.where(F.col("_words").isNotNull()).select(key, "length", F.inline(every))


def _merged(words, key):
    """Rows of one key, word and length as one, as keys may repeat."""
    return words.groupBy(key, "word", "length").agg(F.sum("times").alias("times"))


def build(df, text, key="isin"):
    """The words of `word_counts`, a row for each key, word and length."""
    return _merged(word_counts(df, text, key), key)


def write(words, path, key="isin"):
    """Write the words in order. A frequent word takes as many files as it needs.

    Rows of one key, word and length become one where they are sorted, so `word_counts` go
    through one shuffle.
    """
    # texts are split up once, not again for the sample that the ranges are drawn from
    words = stage(words.select(key, "word", "length", "times"), "words")
    dealt = words.repartitionByRange("word", key)
    _merged(dealt, key).sortWithinPartitions("word", key).write.parquet(path)


def statistics(df, text):
    """Texts in all and mean words per text, from the texts themselves."""
    texts = df.where(F.col(text).isNotNull())
    return texts.agg(F.count("*").alias("docs"), F.avg(F.size(tokens(F.col(text)))).alias("avg_words"))


def kept_statistics(words):
    """The same from the word table: one row, read from the empty word's row groups."""
    texts, length = F.sum("times"), F.sum(F.col("length") * F.col("times"))
    return words.where(F.col("word") == "").agg(
        F.coalesce(texts, F.lit(0)).alias("docs"), (length / texts).alias("avg_words")
    )


def keys_with_all(words, query, key="isin"):
    """Keys of the texts with every word of `query`."""
    terms = query_terms(query)
    found = words.where(F.col("word").isin(terms)).groupBy(key).agg(F.count("*").alias("found"))
    return found.where((F.col("found") == len(terms)) & F.lit(bool(terms))).select(key)


def keys_with_any(words, query, key="isin"):
    return words.where(F.col("word").isin(query_terms(query))).select(key).distinct()


def by_relevance(words, stats, query, n=3, key="isin", k1=1.2, b=0.75):
    """First n keys by BM25 over texts with any word of `query`, ties by key."""
    found = words.where(F.col("word").isin(query_terms(query)))
    # A row per word of the query.
    frequency = found.groupBy("word").agg(F.count("*").alias("with_term"))
    found = found.join(F.broadcast(frequency), "word").withColumn(
        "_stats", stats.select(F.struct("docs", "avg_words")).scalar()
    )
    docs, times = F.col("_stats.docs"), F.col("times")
    idf = F.log(1 + (docs - F.col("with_term") + 0.5) / (F.col("with_term") + 0.5))
    length = 1 - b + b * F.col("length") / F.col("_stats.avg_words")
    score = F.sum(idf * times / (times + k1 * length)).alias("score")
    return found.groupBy(key).agg(score).orderBy(F.desc("score"), key).limit(n)
