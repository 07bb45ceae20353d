"""A whole table of searches answered in one job.

A search of one word, or of a price range alone, is two look-ups in a price index: its
total is the difference of two ranks, its cheapest hits are the ranks that follow the
first. Searches of several words share the work of their condition: the rows with all its
words are counted by price, the counts give every search its total and the prices its
cheapest hits have, and only rows at those prices are fetched. Nothing is written but the
index, and neither step depends on searches times rows.
"""

from pyspark.sql import functions as F

from pricetide.functions.measures import capped_hits
from pricetide.functions.text import tokens
from pricetide.operators.price_index import HIGHEST, LOWEST, of_words, postings, rows_of, slices, write_index
from pricetide.operators.ranking import first_per_group, running_total
from pricetide.operators.skew import BROADCAST_ROWS
from pricetide.schemas import QUERY_TYPES
from pricetide.workspace import shared_folder, stage

# Most distinct words that are picked out inside the scan; more are picked out by a join.
INLINE_CONDITIONS = 500

SEARCH = ["condition", "low", "high"]


def valid_type(query_type):
    return query_type.isin(QUERY_TYPES)


def check_query_types(queries, known=QUERY_TYPES):
    """Fail, when the queries are read, on a query type that does not exist."""
    kind = F.col("query_type")
    wrong = F.raise_error(F.concat(F.lit("Unknown query type: "), F.coalesce(kind, F.lit("NULL"))))
    return queries.withColumn("query_type", F.when(kind.isin(known), kind).otherwise(wrong))


def _searches(queries):
    """Queries with their text condition (sorted distinct words) and both bounds."""
    kind = F.col("query_type")
    with_text = kind.isin("text_search", "combined")
    with_range = kind.isin("price_range", "combined")
    words = F.array_sort(F.array_distinct(tokens(F.coalesce("terms", F.lit("")))))
    low = F.when(with_range, F.col("min_price").cast("double"))
    high = F.when(with_range, F.col("max_price").cast("double"))
    return (
        queries.withColumn("words", F.when(with_text, words).otherwise(F.array().cast("array<string>")))
        # A text search without words finds nothing.
        .where(~with_text | (F.size("words") > 0))
        .select(
            "query_id",
            "words",
            F.array_join("words", " ").alias("condition"),
            F.coalesce(low, F.lit(LOWEST)).alias("low"),
            F.coalesce(high, F.lit(HIGHEST)).alias("high"),
        )
    )


def _asked(queries, text, check_types):
    if text is None:
        queries = check_query_types(queries, ["price_range"])
    elif check_types:
        queries = check_query_types(queries)
    return _searches(queries)


def _index_of(items, searches, key, price, text, inline_conditions):
    """A price index of the words that the searches ask for, in the shared folder."""
    asked = None if text is None else searches.select(F.explode("words").alias("word")).distinct()
    listed = postings(items, key, price, text, asked, inline_conditions)
    return write_index(listed, shared_folder(items.sparkSession, "price-index"), key)


def _conditions(index, searches, few):
    """The conditions of several words: their rarest word, the others, and the prices their searches span.

    Conditions with a word that no row has are left out.
    """
    several = searches.where(F.size("words") > 1).groupBy("condition", "words").agg(
        F.min("low").alias("low"), F.max("high").alias("high")
    )
    words = several.withColumn("word", F.explode("words"))
    known = index.words.select("word", "rows").join(F.broadcast(words) if few else words, "word")
    anchors = known.groupBy("condition", "words", "low", "high").agg(
        F.min_by("word", F.struct("rows", "word")).alias("word"), F.count("*").alias("known")
    )
    return anchors.where(F.col("known") == F.size("words")).select(
        *SEARCH, "word", F.array_remove("words", F.col("word")).alias("others")
    )


def _ranks(index, searches, size):
    """Slices of the index, a row for each search of one list and for each condition of several words.

    Also whether there are such conditions, and whether the searches and their hits are few.
    """
    counts = searches.agg(F.count("*").alias("n"), F.count_if(F.size("words") > 1).alias("several")).first()
    few = counts.n * size <= BROADCAST_ROWS
    asked = searches.where(F.size("words") < 2).select(
        *SEARCH,
        F.coalesce(F.get("words", F.lit(0)), F.lit("")).alias("word"),
        F.lit(None).cast("array<string>").alias("others"),
    )
    if counts.several:
        asked = asked.unionByName(_conditions(index, searches, few))
    return stage(slices(index, asked, few), "ranks"), counts.several > 0, few


def _matches(index, ranked, few):
    """Condition, price and key of every row with all words of a condition of several.

    Rows come from the list of the condition's rarest word, cut to the prices that its
    searches ask for; a look-up among the other words' rows says whether it has them.
    """
    conditions = ranked.where("others is not null")
    rows = rows_of(index, conditions, ["condition", "others"])
    others = conditions.select(F.explode("others").alias("word")).distinct()
    held = index.postings.join(F.broadcast(others) if few else others, "word", "left_semi")
    found = (
        rows.withColumn("needed", F.size("others"))
        .withColumn("word", F.explode("others"))
        .join(held.select("word", "price", index.key), ["word", "price", index.key])
        .groupBy("condition", "rank", "price", index.key, "needed")
        .agg(F.size(F.collect_set("word")).alias("found"))
    )
    return found.where("found = needed").select("condition", "price", index.key)


def _steps(matched, searches):
    """Running row counts by price, per condition, with the searches' bounds among them.

    `side` is 0 for a lower bound, which counts the rows below it, 1 for a price with its
    rows, and 2 for an upper bound, which counts the rows up to it.
    """
    ladder = matched.groupBy("condition", "price").agg(F.count("*").alias("n"))
    marks = searches.select(
        *SEARCH,
        F.inline(
            F.array(
                F.struct(F.col("low").alias("price"), F.lit(0).alias("side")),
                F.struct(F.col("high").alias("price"), F.lit(2).alias("side")),
            )
        ),
        F.lit(0).cast("long").alias("n"),
    )
    steps = ladder.withColumn("side", F.lit(1)).unionByName(marks, allowMissingColumns=True)
    return running_total(steps, ["condition"], "price", ["side"], "n", "upto")


def _found(steps):
    """Per distinct search: rows below its range and rows in it."""
    below = F.max(F.when(F.col("side") == 0, F.col("upto")))
    upto = F.max(F.when(F.col("side") == 2, F.col("upto")))
    return (
        steps.where("side != 1")
        .groupBy(*SEARCH)
        .agg(below.alias("below"), F.greatest(upto - below, F.lit(0)).alias("total_hits"))
    )


def _totals(queries, asked, found, size):
    answered = asked.select("query_id", *SEARCH).join(found, SEARCH).select("query_id", "total_hits")
    # no hits: searches without words, and those of a word that no row has
    total = F.coalesce("total_hits", F.lit(0).cast("long"))
    return queries.select("query_id").join(answered, "query_id", "left").withColumn("total_hits", total).select(
        "query_id",
        "total_hits",
        capped_hits(F.col("total_hits")).alias("total_hits_capped"),
        (F.col("total_hits") > 10_000).alias("total_is_lower_bound"),
        F.least(F.col("total_hits"), F.lit(size)).alias("returned_hits"),
    )


def batch_totals(
    items,
    queries,
    key="isin",
    price="price",
    text="long_name",
    size=100,
    inline_conditions=INLINE_CONDITIONS,
    check_types=True,
    index=None,
):
    """Hits of every query: total_hits, the same as a capped counter shows it
    (total_hits_capped, total_is_lower_bound) and returned_hits.

    `index` is a `PriceIndex` of the items made before; without one the items are scanned
    once and the words asked for are indexed. An unknown query type fails the job; with
    `check_types=False` the caller has sorted such queries out.
    """
    asked = _asked(queries, text, check_types)
    searches = stage(asked.select("words", *SEARCH).distinct(), "searches")
    index = index or _index_of(items, searches, key, price, text, inline_conditions)
    index = of_words(index, searches.select(F.explode("words").alias("word")))
    ranked, has_several, few = _ranks(index, searches, size)
    found = _total_hits(ranked)
    if has_several:
        steps = _steps(_matches(index, ranked, few), searches.where(F.size("words") > 1))
        found = found.unionByName(_found(steps).select(*SEARCH, "total_hits"))
    return _totals(queries, asked, found, size)


def _total_hits(ranked):
    return ranked.where("others is null").select(*SEARCH, (F.col("behind") - F.col("first")).alias("total_hits"))


def batch_search(
    items,
    queries,
    key="isin",
    price="price",
    text="long_name",
    size=100,
    carry=(),
    inline_conditions=INLINE_CONDITIONS,
    check_types=True,
    index=None,
):
    """Hit totals and cheapest hits of every query.

    Returns two frames: totals as `batch_totals` has them, and hits (query_id, rank, key,
    price and the columns named in `carry`, which are looked up by key and price). Rows
    without a price are no hits. With `text=None` all searches have to be price ranges.
    `index` as for `batch_totals`; beside it only a row or two for each search are written.
    """
    asked = _asked(queries, text, check_types)
    searches = stage(asked.select("words", *SEARCH).distinct(), "searches")
    index = index or _index_of(items, searches, key, price, text, inline_conditions)
    index = of_words(index, searches.select(F.explode("words").alias("word")))
    ranked, has_several, few = _ranks(index, searches, size)
    found = _total_hits(ranked)
    first = ranked.where("others is null").withColumn("behind", F.least("behind", F.col("first") + size))
    # each task keeps no more than the first of each search
    hits = first_per_group(rows_of(index, first, SEARCH, few).drop("first"), SEARCH, ["rank"], size, "place")
    hits = hits.withColumn("rank", F.col("place")).drop("place")
    if has_several:
        matched = _matches(index, ranked, few)
        steps = _steps(matched, searches.where(F.size("words") > 1))
        # a row for each search
        counted = stage(_found(steps), "found")
        found = found.unionByName(counted.select(*SEARCH, "total_hits"))
        hits = hits.unionByName(_hits_of_several(counted, matched, steps, key, size, few))
    totals = _totals(queries, asked, found, size)
    hits = asked.select("query_id", *SEARCH).join(hits, SEARCH).select("query_id", "rank", key, "price")
    if carry:
        # at most `size` rows for each search meet the items where they lie
        wanted = hits.select(key, "price").distinct()
        looked_up = items.withColumn("price", F.col(price).cast("double"))
        looked_up = looked_up.join(F.broadcast(wanted) if few else wanted, [key, "price"], "left_semi")
        kept = F.min(F.struct(*carry)).alias("_kept")
        hits = hits.join(looked_up.groupBy(key, "price").agg(kept), [key, "price"]).select(
            "query_id", "rank", key, "price", *[F.col(f"_kept.{c}") for c in carry]
        )
    return totals, hits


def _hits_of_several(found, matched, steps, key, size, few):
    """The first `size` matches of each search, found from the running counts."""
    # Prices that start within the first `size` places after a lower bound. A search's
    # places lie in at most two blocks of `size`.
    before = F.col("upto") - F.col("n")
    prices = steps.where("side = 1").select(
        "condition", "price", before.alias("before"), F.floor(before / size).alias("block")
    )
    last = F.col("below") + F.least(F.col("total_hits"), F.lit(size))
    needed = (
        found.where("total_hits > 0")
        .withColumn("last", last)
        .withColumn(
            "block",
            F.explode(F.sequence(F.floor(F.col("below") / size), F.floor((F.col("last") - 1) / size))),
        )
        .join(prices, ["condition", "block"])
        .where((F.col("before") >= F.col("below")) & (F.col("before") < F.col("last")))
        .select(*SEARCH, "below", "last", "price", "before")
    )
    # A search needs at most `size` prices, so few searches need few of them.
    wanted = needed.select("condition", "price").distinct()
    rows = matched.join(F.broadcast(wanted) if few else wanted, ["condition", "price"], "left_semi")
    # No price needs more than its first `size` rows, however many it has.
    rows = first_per_group(rows, ["condition", "price"], [key], size, "place")
    return (
        needed.join(rows, ["condition", "price"])
        .withColumn("position", F.col("before") + F.col("place"))
        .where(F.col("position") <= F.col("last"))
        .select(*SEARCH, "price", key, (F.col("position") - F.col("below")).cast("int").alias("rank"))
    )
