"""The given parquet tables seen as instruments, changes, logs and searches."""

from pyspark.sql import functions as F


def read(spark, folder, table):
    return spark.read.parquet(f"{folder}/{table}.parquet")


def key_of(number, country="US"):
    country = F.lit(country) if isinstance(country, str) else country
    return F.concat(country, F.lpad(number.cast("string"), 9, "0"), (number % 10).cast("string"))


def instruments_of(parts, country="US"):
    return parts.select(
        key_of(F.col("p_partkey"), country).alias("isin"),
        F.col("p_name").alias("name"),
        F.concat_ws(" ", "p_brand", "p_type", "p_name").alias("long_name"),
        F.col("p_retailprice").alias("price"),
    )


def instruments(spark, folder):
    return instruments_of(read(spark, folder, "part"))


def docs(spark, folder):
    """Documents as a table to search: text by words, length as the number."""
    return read(spark, folder, "documents").select("doc_id", "text", "n_chars")


def price_changes(spark, folder):
    return price_changes_of(read(spark, folder, "lineitem"))


def price_changes_of(line_items):
    """Line items as price changes; the last two columns break ties of the date.

    Returned items change the listing in another country, which the table lacks.
    """
    country = F.when(F.col("l_returnflag") == "R", "GB").otherwise("US")
    return line_items.select(
        key_of(F.col("l_partkey"), country).alias("isin"),
        F.col("l_extendedprice").alias("price"),
        F.col("l_shipdate").cast("timestamp").alias("updated_at"),
        F.col("l_orderkey").alias("update_iteration"),
        F.col("l_linenumber").alias("line"),
    )


CHANGE_ORDER = ["updated_at", "update_iteration", "line"]


def merge_target(spark, folder):
    return instruments(spark, folder).withColumns(
        {
            "updated_at": F.lit(None).cast("timestamp"),
            "update_iteration": F.lit(None).cast("long"),
        }
    )


def replacements(spark, folder):
    """Source of a replacing merge: every part at twice its price, promotions as new listings."""
    country = F.when(F.col("p_type") == "PROMO", "GB").otherwise("US")
    return (
        instruments_of(read(spark, folder, "part"), country)
        .withColumn("price", F.col("price") * 2)
        .withColumn("updated_at", F.lit("2024-01-01 00:00:00").cast("timestamp"))
    )


def dirty_instruments(spark, folder):
    """Every instrument twice, as text and in a known order, first copies with gaps.

    Small parts lack their name in the first copy, large ones their price.
    """
    parts = read(spark, folder, "part")
    cents = F.col("p_retailprice").cast("decimal(10,2)")
    long_name = F.concat_ws(" ", "p_brand", "p_type", "p_name")
    first = parts.select(
        key_of(F.col("p_partkey")).alias("isin"),
        F.when(F.col("p_type") == "SMALL", "NA").otherwise(F.col("p_name")).alias("name"),
        long_name.alias("long_name"),
        F.when(F.col("p_type") == "LARGE", "").otherwise(cents.cast("string")).alias("price"),
        (F.col("p_partkey") * 2).alias("row_order"),
    )
    second = parts.select(
        key_of(F.col("p_partkey")).alias("isin"),
        F.col("p_name").alias("name"),
        long_name.alias("long_name"),
        (cents + 1).cast("decimal(10,2)").cast("string").alias("price"),
        (F.col("p_partkey") * 2 + 1).alias("row_order"),
    )
    return first.unionByName(second)


def update_metrics(spark, folder):
    return update_metrics_of(read(spark, folder, "events"))


def update_metrics_of(events):
    seconds = F.col("value")
    done = 1000 * (1 + F.col("user_id") % 150)
    return events.where("event_type = 'purchase'").select(
        F.col("ts").cast("timestamp").alias("timestamp"),
        F.col("event_id").alias("iteration"),
        F.lit(200000).cast("long").alias("total_instruments"),
        done.alias("success_count"),
        (F.col("event_id") % 3).alias("error_count"),
        seconds.alias("duration_seconds"),
        F.coalesce(F.try_divide(done.cast("double"), seconds), F.lit(0.0)).alias("updates_per_second"),
    )


def search_metrics(spark, folder):
    return search_metrics_of(read(spark, folder, "events"))


def search_metrics_of(events):
    return events.where("event_type <> 'purchase'").select(
        F.col("ts").cast("timestamp").alias("timestamp"),
        F.col("event_id").alias("search_id"),
        F.concat_ws("_", "event_type", (F.col("user_id") % 3).cast("string")).alias("search_type"),
        F.col("event_type").alias("query_type"),
        (F.col("event_id") % 20 != 0).alias("success"),
        F.col("value").alias("duration_ms"),
        F.col("user_id").alias("total_hits"),
    )


WORDS = ["the", "the and", "der und", "le", "La De", "zzz"]


def requests(spark, folder, kinds=("price_range", "text_search", "combined"), low=100, step=37, width=2000):
    """A search request per supplier, of the given kinds in turn."""
    s = F.col("s_suppkey")
    kind = F.element_at(F.array(*map(F.lit, kinds)), (s % len(kinds) + 1).cast("int"))
    from_price = (low + s * step % width).cast("double")
    return (
        read(spark, folder, "supplier")
        .withColumn("kind", kind)
        .select(
            s.alias("query_id"),
            F.concat_ws("_", "kind", (s % 5).cast("string")).alias("search_type"),
            F.col("kind").alias("query_type"),
            F.when(F.col("kind") != "text_search", from_price).alias("min_price"),
            F.when(F.col("kind") != "text_search", from_price + 20 + s * 53 % width).alias("max_price"),
            F.when(
                F.col("kind") != "price_range",
                F.element_at(F.array(*map(F.lit, WORDS)), (s % len(WORDS) + 1).cast("int")),
            ).alias("terms"),
        )
    )
