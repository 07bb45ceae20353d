"""The catalogue of named searches, with bounds derived from the price statistics."""

from pyspark.sql import functions as F

from pricetide.functions.measures import clamp_range
from pricetide.operators.search import price_stats

# Name, kind, words, and bounds in terms of the price statistics.
SEARCHES = [
    ("price_narrow_low", "price_range", None, "min_price", "min_price + 50"),
    ("price_narrow_mid", "price_range", None, "avg_price - 25", "avg_price + 25"),
    ("price_narrow_high", "price_range", None, "max_price - 100", "max_price"),
    ("price_medium_low", "price_range", None, "min_price", "avg_price * 0.5"),
    ("price_medium_mid", "price_range", None, "avg_price * 0.5", "avg_price * 1.5"),
    ("price_medium_high", "price_range", None, "avg_price * 1.5", "max_price"),
    ("price_wide_all", "price_range", None, "min_price", "max_price"),
    ("price_wide_lower_half", "price_range", None, "min_price", "avg_price"),
    ("price_wide_upper_half", "price_range", None, "avg_price", "max_price"),
    ("long_name_investment", "text_search", "Investment", None, None),
    ("long_name_fund", "text_search", "Fund", None, None),
    ("long_name_technology", "text_search", "Technology", None, None),
    ("long_name_global", "text_search", "Global", None, None),
    ("long_name_strategy", "text_search", "Strategy", None, None),
    ("long_name_financial", "text_search", "Financial", None, None),
    ("long_name_management", "text_search", "Management", None, None),
    ("long_name_portfolio", "text_search", "Portfolio", None, None),
    ("long_name_diversified", "text_search", "Diversified", None, None),
    ("long_name_sustainable", "text_search", "Sustainable", None, None),
    ("combined_tech_mid_price", "combined", "Technology", "avg_price * 0.5", "avg_price * 1.5"),
    ("combined_global_high_price", "combined", "Global", "avg_price * 1.5", "max_price"),
    ("combined_fund_low_price", "combined", "Fund", "min_price", "avg_price * 0.5"),
]

# Fixed value: how far a bound may be moved at random, either way.
JITTER = 10


def search_catalogue(instruments, jitter_seed=None, price="price"):
    """The named searches as a queries table for the prices at hand.

    Bounds are clamped into the price range; with a seed they are moved by up to
    JITTER first. The statistics are one row, and the searches unfold from it.
    """
    searches = []
    for i, (name, kind, words, low, high) in enumerate(SEARCHES, 1):
        searches.append(
            F.struct(
                F.lit(i).cast("long").alias("query_id"),
                F.lit(name).alias("search_type"),
                F.lit(kind).alias("query_type"),
                F.expr(low or "null").cast("double").alias("low"),
                F.expr(high or "null").cast("double").alias("high"),
                F.lit(words).cast("string").alias("terms"),
            )
        )
    # Rounded, so that bounds do not depend on the order in which tasks add up.
    stats = price_stats(instruments, price).withColumn("avg_price", F.round("avg_price", 6))
    rows = stats.select("min_price", "max_price", F.inline(F.array(*searches)))
    low, high = F.col("low"), F.col("high")
    if jitter_seed is not None:

        def moved(side):
            part = F.pmod(F.xxhash64("query_id", F.lit(jitter_seed), F.lit(side)), F.lit(2_000_001))
            return (part / 1_000_000 - 1) * JITTER

        low, high = low + moved("low"), high + moved("high")
    has_range = F.col("low").isNotNull()
    clamped_low, clamped_high = clamp_range(low, high, F.col("min_price"), F.col("max_price"))
    return rows.select(
        "query_id",
        "search_type",
        "query_type",
        F.when(has_range, F.round(clamped_low, 2)).alias("min_price"),
        F.when(has_range, F.round(clamped_high, 2)).alias("max_price"),
        "terms",
    )
