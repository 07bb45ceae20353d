"""Synthetic instruments as a function of a row id.

Every value is integer arithmetic on the id, so a table comes out the same however it
is partitioned, needs no shuffle, and can be computed by any engine.
"""

from dataclasses import dataclass

from pyspark.sql import functions as F

from pricetide.functions.text import pad_with_phrases, shorten
from pricetide.schemas import PRICE

# The country codes keys start with.
COUNTRIES = ["US", "GB", "DE", "FR", "JP", "CA", "AU", "CH", "NL", "SE"]

# Price buckets, each as likely as the others.
PRICE_BUCKETS = [(1, 10), (10, 50), (50, 200), (200, 1000), (1000, 5000)]

# Bounds on the length of a long name, and of one that is cut.
LONG_NAME_MIN, LONG_NAME_MAX, LONG_NAME_CUT = 100, 200, 197

PRIME = 2147483647
LOW_KEYS, HIGH_KEYS = 36**4, 36**5
DIGITS = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ"


@dataclass(frozen=True)
class Vocabulary:
    """Words the names are made of. Patterns name the lists they draw from."""

    leads: tuple = (
        "Summit", "Harbor", "Granite", "Northern", "Pioneer", "Crescent", "Liberty",
        "Evergreen", "Global", "Sterling", "Beacon", "Cobalt", "Meridian", "Atlas",
        "Vertex", "Horizon", "Aurora", "Keystone", "Titan", "Juniper",
    )
    firms: tuple = (
        "Textiles", "Shipping", "Foods", "Semiconductors", "Railways", "Chemicals",
        "Insurance", "Software", "Breweries", "Paper", "Robotics", "Optics", "Steel",
        "Tourism", "Water", "Publishing", "Satellites", "Forestry", "Ceramics", "Batteries",
    )
    forms: tuple = (
        "Mills", "Yards", "House", "Guild", "Combine", "Cooperative", "Foundry", "Bureau",
        "Consortium", "Syndicate", "League", "Mutual", "Depot",
    )
    areas: tuple = (
        "Technology Hardware", "Financial Advisory", "Grid Storage", "Organic Farming",
        "Rail Freight", "Water Treatment", "Portfolio Lending", "Urban Housing",
        "Genome Sequencing", "Sustainable Forestry", "Port Operations", "Video Streaming",
        "Precision Optics", "Waste Management", "Satellite Navigation", "Specialty Chemicals",
        "Battery Recycling", "Investment Brokerage", "Technological Research", "Game Publishing",
        "Marine Insurance", "Industrial Robotics", "Dairy Processing", "Payment Networks",
        "Medical Imaging", "Quantum Technologies", "Bridge Building", "Seed Breeding", "Harbour Dredging",
    )
    regions: tuple = (
        "Iberia", "Benelux", "the Alps", "East Africa", "Oceania", "the Andes", "South Asia",
        "Asia-Pacific", "the Balkans", "North Africa", "the Gulf", "Central Europe",
        "the Great Lakes", "Indochina", "the British Isles", "Patagonia", "Frontier Markets", "Lapland", "the Caribbean",
    )
    funds: tuple = (
        "Fund", "Index Fund", "Bond Fund", "Income Fund", "Growth Fund", "Balanced Fund",
        "Pension Fund", "Feeder Fund", "Money Market Fund", "Small Company Fund", "ETF",
        "Closed-End Fund", "Absolute Return Fund", "Investment Fund", "Endowment Fund",
        "Municipal Fund", "Savings Plan",
    )
    strategies: tuple = (
        "Momentum Strategy", "Carry Strategy", "Minimum Variance Strategy", "Barbell Strategy",
        "Fundamental Analysis Strategy", "Contrarian Strategy", "Laddered Maturity Strategy",
        "Equal Weight Strategy", "Trend Strategy", "Covered Call Strategy", "Merger Strategy",
        "Rotation Strategy", "Buy-and-Hold Strategy", "Pairs Strategy", "Tail Risk Strategy",
    )
    closings: tuple = (
        "open to savers abroad", "quoted once a week", "reviewed by two auditors",
        "paid out each spring", "kept at a custodian bank",
    )
    name_patterns: tuple = (
        "House of {leads} {firms}", "{leads} {forms}", "New {leads} {firms}",
        "{firms} {forms} at {leads}", "{leads} and Daughters {firms}",
    )
    long_patterns: tuple = (
        "Units of a {strategies} kept by the {funds}, {areas} shelf, booked in {regions}",
        "From {regions}: {areas2} next to {areas}, shared through one {funds}",
        "Every Global maker of {areas} outside {regions}, owned by way of the {funds}",
        "Investment Club Share, {regions} Series, where {areas} meets the {strategies}",
        "The {funds} lends to Sustainable {areas}, earns by a {strategies} and reports from {regions}",
    )


def scramble(row_id, salt):
    """A number in [0, PRIME) that looks random, from a row id and a salt."""
    folded = (row_id % PRIME + F.floor(row_id / PRIME) * 16807) % PRIME
    once = (folded * 48271 + salt * 40692 + 11) % PRIME
    return (once * 69621 + salt) % PRIME


def pick(row_id, salt, values):
    return F.element_at(F.array(*map(F.lit, values)), (scramble(row_id, salt) % len(values) + 1).cast("int"))


def keys(row_id):
    """Country, nine base-36 characters and a digit; different for different ids.

    The nine characters are a one-to-one function of the id (below 36 to the 9th): the
    low and the high part are shifted in turn by amounts that depend on the other part.
    """
    low, high = row_id % LOW_KEYS, F.floor(row_id / LOW_KEYS)
    low = (low * 485_207 + scramble(high, 1)) % LOW_KEYS
    high = (high * 23_456_789 + scramble(low, 2)) % HIGH_KEYS
    middle = F.concat(F.lpad(F.conv(high, 10, 36), 5, "0"), F.lpad(F.conv(low, 10, 36), 4, "0"))
    digit = (scramble(row_id, 4) % 10).cast("string")
    return F.concat(pick(row_id, 3, COUNTRIES), middle, digit)


def _filled(patterns, row_id, words, salt):
    """One of the patterns, with a word for each list it names. A list named with a 2
    gives a second word."""
    text = pick(row_id, salt, patterns)
    for place, name in enumerate(Vocabulary.__dataclass_fields__):
        for slot, shift in ((f"{{{name}}}", 0), (f"{{{name}2}}", 10)):
            if any(slot in pattern for pattern in patterns):
                word = pick(row_id, salt + place + shift, getattr(words, name))
                text = F.replace(text, F.lit(slot), word)
    return text


def prices(row_id, salt=60):
    """A bucket, then a price inside it, in whole cents."""
    bucket = scramble(row_id, salt) % len(PRICE_BUCKETS)
    cents = scramble(row_id, salt + 1)
    column = F.lit(None).cast("long")
    for i, (low, high) in enumerate(PRICE_BUCKETS):
        column = F.when(bucket == i, low * 100 + cents % ((high - low) * 100 + 1)).otherwise(column)
    return (column / 100).cast(PRICE)


def synthetic_instruments(df, row_id="id", words=Vocabulary()):
    """One instrument per row id of `df`."""
    i = F.col(row_id)
    start = scramble(i, 59) % len(words.closings)
    closings = F.array(*map(F.lit, words.closings))
    turned = F.concat(
        F.slice(closings, start.cast("int") + 1, len(words.closings)),
        F.slice(closings, F.lit(1), start.cast("int")),
    )
    long_name = pad_with_phrases(_filled(words.long_patterns, i, words, 40), turned, LONG_NAME_MIN)
    return df.select(
        keys(i).alias("isin"),
        _filled(words.name_patterns, i, words, 20).alias("name"),
        shorten(long_name, LONG_NAME_MAX, LONG_NAME_CUT).alias("long_name"),
        prices(i).alias("price"),
    )


def generate(spark, n, words=Vocabulary()):
    return synthetic_instruments(spark.range(n), "id", words)


def price_pass(df, iteration, stamp, key="isin"):
    """A change batch that sets a new price for every key of `df`."""
    number = F.conv(F.substring(key, 3, 9), 36, 10).cast("long")
    return df.select(
        key,
        prices(number + F.lit(iteration).cast("long") * 7_919, 70).alias("price"),
        F.lit(stamp).cast("timestamp").alias("updated_at"),
        F.lit(iteration).cast("long").alias("update_iteration"),
    )
