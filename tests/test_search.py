import math
import os
import random

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from pricetide.functions.measures import clamp_range, search_label
from pricetide.functions.text import query_terms
from pricetide.operators import search as S
from pricetide.operators import price_index, word_table
from pricetide.operators.batch_search import batch_search, batch_totals
from pricetide.plans import driver_tables as tables
from pricetide.plans.catalogue import search_catalogue
from pricetide.sources.writers import create_table
from pricetide.workspace import shared_folder

QUERY = "query_id long, search_type string, query_type string, min_price double, max_price double, terms string"
ITEM = "isin string, long_name string, price double"


def test_ties_are_broken_by_key(spark):
    df = spark.createDataFrame([("C", 5.0), ("A", 5.0), ("B", 5.0), ("D", 4.0)], "isin string, price double")
    assert [r.isin for r in S.cheapest(df, 2).collect()] == ["D", "A"]


def test_bounds_are_inclusive(spark):
    df = spark.createDataFrame([(9.99,), (10.0,), (60.0,), (60.01,)], "price double")
    found = df.where(S.search_filter("price_range", 10, 60)).collect()
    assert sorted(r.price for r in found) == [10.0, 60.0]


def test_unknown_query_type():
    with pytest.raises(ValueError, match="Unknown query type: fuzzy"):
        S.search_filter("fuzzy")


def test_hit_count_is_exact_and_capped(spark):
    df = spark.range(10_001).select(
        F.lpad(F.col("id").cast("string"), 6, "0").alias("isin"),
        F.lit(10.0).alias("price"),
        F.lit("x" * 60).alias("long_name"),
    )
    row = S.hit_summary(df, S.search_filter("price_range", 10, 60)).first()
    assert (row.total_hits, row.total_hits_capped, row.total_is_lower_bound, row.returned_hits) == (
        10_001,
        10_000,
        True,
        100,
    )
    assert [s.isin for s in row.sample_data] == ["000000", "000001", "000002"]
    assert row.sample_data[0].long_name == "x" * 50 + "..."


def test_price_stats_leave_prices_whole(spark):
    df = spark.createDataFrame([(0.004,), (0.002,), (float("nan"),), (None,)], "price double")
    assert tuple(S.price_stats(df).first()) == (0.002, 0.004, 0.003)
    assert S.price_stats(spark.createDataFrame([(1e16,)], "price double")).first().avg_price == 1e16


def test_price_stats_of_an_empty_table(spark):
    empty = spark.createDataFrame([], "price double")
    assert tuple(S.price_stats(empty).first()) == (1.0, 5000.0, 250.0)


def test_inverted_range(spark):
    low, high = clamp_range(F.lit(12.0), F.lit(3.0), F.lit(1.0), F.lit(10.0))
    assert tuple(spark.range(1).select(low, high).first()) == (2.0, 3.0)


def test_labels(spark):
    df = spark.createDataFrame(
        [("price_range", 1.0, 60.5, None), ("text_search", None, None, "Fund"), ("combined", 1.0, 2.0, "Fund"), ("x", None, None, None)],
        "kind string, low double, high double, terms string",
    )
    label = search_label(F.lit("s"), F.col("kind"), F.col("low"), F.col("high"), F.col("terms"))
    assert [r[0] for r in df.select(label).collect()] == [
        "s: $1.00 - $60.50",
        "s: 'Fund'",
        "s: 'Fund' + $1.00 - $2.00",
        "s: unknown",
    ]


def test_catalogue_has_its_searches_and_bounds(spark):
    df = spark.createDataFrame([(1.0,), (1000.0,), (500.0,)], "price double")
    rows = {r.search_type: r for r in search_catalogue(df).collect()}
    kinds = [r.query_type for r in rows.values()]
    assert len(rows) == 22
    assert [kinds.count(k) for k in ("price_range", "text_search", "combined")] == [9, 10, 3]
    assert (rows["price_narrow_low"].min_price, rows["price_narrow_low"].max_price) == (1.0, 51.0)
    assert rows["price_narrow_high"].min_price == 900.0
    moved = search_catalogue(df, jitter_seed=7).collect()
    for r in moved:
        plain = rows[r.search_type]
        if r.min_price is not None:
            assert abs(r.min_price - plain.min_price) <= 11
            assert 1.0 - 1 <= r.min_price < r.max_price <= 1000.0


def test_relevance_equals_brute_force(spark):
    rng = random.Random(5)
    words = ["fund", "bond", "index", "risk", "asia"]
    docs = [
        (f"K{i:03}", " ".join(rng.choice(words) for _ in range(rng.randint(1, 9))), float(i))
        for i in range(60)
    ]
    df = spark.createDataFrame(docs, ITEM)
    split = {k: t.split() for k, t, _ in docs}
    mean = sum(map(len, split.values())) / len(split)

    def score(key):
        total = 0.0
        for term in ("fund", "asia"):
            having = sum(term in w for w in split.values())
            idf = math.log(1 + (len(split) - having + 0.5) / (having + 0.5))
            tf = split[key].count(term)
            total += idf * tf / (tf + 1.2 * (0.25 + 0.75 * len(split[key]) / mean))
        return total

    expected = sorted(((-score(k), k) for k in split if {"fund", "asia"} & set(split[k])))[:7]
    got = S.by_relevance(df, "long_name", "Fund asia", 7).collect()
    assert [r.isin for r in got] == [k for _, k in expected]
    assert [r.score for r in got] == pytest.approx([-s for s, _ in expected])
    statistics = S.text_statistics(df, "long_name", "Fund asia")
    again = S.by_relevance(df, "long_name", "Fund asia", 7, statistics=statistics).collect()
    assert [r.isin for r in again] == [k for _, k in expected]


def test_word_table(spark, tmp_path):
    rows = [("A", "Fund of funds fund"), ("B", "Bond Fund"), ("C", None), ("D", ""), ("E", "bond")]
    df = spark.createDataFrame(rows, "isin string, long_name string")
    path = str(tmp_path / "words")
    word_table.write(word_table.build(df, "long_name"), path)
    words = spark.read.parquet(path)
    assert words.where("isin = 'A' and word = 'fund'").select("times", "length").first() == (2, 4)

    def keys(df):
        return sorted(r.isin for r in df.collect())

    assert keys(word_table.keys_with_all(words, "Fund")) == ["A", "B"]
    assert keys(word_table.keys_with_all(words, "fund bond")) == ["B"]
    assert keys(word_table.keys_with_all(words, "?")) == []
    assert keys(word_table.keys_with_any(words, "funds bond")) == ["A", "B", "E"]
    plan = word_table.keys_with_all(words, "fund")._jdf.queryExecution().executedPlan().toString()
    assert "In(word, [fund])" in plan or "EqualTo(word,fund)" in plan
    stats = word_table.statistics(df, "long_name")
    assert word_table.kept_statistics(words).first() == stats.first() == (4, 7 / 4)
    got = word_table.by_relevance(words, stats, "bond fund").collect()
    expected = S.by_relevance(df, "long_name", "bond fund").collect()
    assert [(r.isin, round(r.score, 12)) for r in got] == [(r.isin, round(r.score, 12)) for r in expected]


def test_range_searches_skip_files_of_a_sorted_table(spark):
    items = spark.range(10_000).select(F.col("id").cast("string").alias("isin"), (F.col("id") % 977).alias("price"))
    # So few rows would be put into one file.
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        create_table(spark, "by_price", items, sort_by=["price"])
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    spans = spark.table("by_price").groupBy(F.input_file_name()).agg(F.min("price").alias("low"), F.max("price").alias("high"))
    spans = sorted((r.low, r.high) for r in spans.collect())
    assert len(spans) > 1 and all(a[1] <= b[0] for a, b in zip(spans, spans[1:]))
    spark.sql("drop table by_price")


def brute(items, queries, size):
    totals, hits = {}, {}
    for q, _, kind, low, high, terms in queries:
        found = []
        for key, text, price in items:
            if kind in ("price_range", "combined") and not low <= price <= high:
                continue
            if kind in ("text_search", "combined"):
                asked = query_terms(terms)
                if not asked or not set(asked) <= set(query_terms(text)):
                    continue
            found.append((price, key))
        found.sort()
        totals[q] = len(found)
        for rank, (price, key) in enumerate(found[:size], 1):
            hits[q, rank] = (key, price)
    return totals, hits


@pytest.mark.parametrize("inline", [2000, 0])
@pytest.mark.parametrize("size", [3, 100])
def test_batch_search_equals_brute_force(spark, inline, size):
    rng = random.Random(size)
    words = ["fund", "Bond", "index", "risk", "asia-pacific", "o'neil"]
    # A third of the rows share one price and most have one word.
    items = [
        (
            f"K{i:04}",
            " ".join(["fund"] * (i % 5 > 0) + [rng.choice(words) for _ in range(rng.randint(0, 4))]),
            50.0 if i % 3 == 0 else rng.randint(1, 9000) / 100,
        )
        for i in range(700)
    ]
    queries = []
    for q in range(40):
        kind = ["price_range", "text_search", "combined"][q % 3]
        low = rng.randint(0, 80) + 0.5 * (q % 2)
        high = 50.0 if q % 7 == 0 else low + rng.randint(-3, 60)
        terms = " ".join(rng.sample(["Fund", "bond", "asia", "pacific", "O'Neil", "nothing"], rng.randint(1, 2)))
        if q == 4:
            terms = "?!"
        bounds = (None, None) if kind == "text_search" else (float(low), float(high))
        queries.append((q, "s", kind, *bounds, None if kind == "price_range" else terms))
    # The same search twice, and one that takes everything.
    queries += [(100, *queries[0][1:]), (101, "s", "price_range", 0.0, 1e9, None)]
    totals, hits = batch_search(
        spark.createDataFrame(items, ITEM).repartition(5),
        spark.createDataFrame(queries, QUERY),
        size=size,
        inline_conditions=inline,
    )
    expected_totals, expected_hits = brute(items, queries, size)
    assert {r.query_id: r.total_hits for r in totals.collect()} == expected_totals
    assert {r.query_id: r.returned_hits for r in totals.collect()} == {
        q: min(n, size) for q, n in expected_totals.items()
    }
    assert {(r.query_id, r["rank"]): (r.isin, r.price) for r in hits.collect()} == expected_hits


def test_slices_equal_counting(spark, tmp_path):
    rng = random.Random(8)
    odd = [float("-inf"), -1.5, 0.0, 2.0, 2.0, 7.25, 1e300, float("inf"), float("nan")]
    # a list of several blocks, hot prices, a word that few rows have
    items = [(f"K{i:05}", "fund " * (i % 2) + "rare" * (i % 400 == 3), odd[i % 9] if i % 3 else rng.uniform(0, 9)) for i in range(6000)]
    df = spark.createDataFrame(items, ITEM).repartition(4)
    index = price_index.write_index(price_index.postings(df, "isin", "price", "long_name"), str(tmp_path / "index"))
    assert index.postings.agg(F.max("rank")).first()[0] + 1 == index.postings.count() == index.postings.select("rank").distinct().count()
    searches = [(w, rng.choice(odd), rng.choice(odd)) for w in ("", "fund", "rare", "none") for _ in range(25)]
    searches += [("fund", price_index.LOWEST, price_index.HIGHEST), ("", 3.3, 3.4), ("rare", 1.0, 8.0)]
    got = price_index.slices(index, spark.createDataFrame(searches, "word string, low double, high double"))

    def place(price):
        return (1, 0.0) if price != price else (0, price)

    def expected(word, low, high):
        prices = [p for _, text, p in items if not word or word in text.split()]
        return sum(place(low) <= place(p) <= place(high) for p in prices)

    rows = got.collect()
    assert {(r.word, repr(r.low), repr(r.high)): r.behind - r["first"] for r in rows} == {
        (w, repr(a), repr(b)): expected(w, a, b) for w, a, b in searches if w != "none"
    }
    listed = price_index.rows_of(index, got.where("word = 'rare'"), ["word"]).select("isin").distinct()
    assert listed.count() == sum("rare" in t for _, t, p in items)


def written_bytes(spark, run):
    """What `run` leaves in the folder of intermediate tables."""

    def total():
        top = os.path.dirname(shared_folder(spark, "any"))
        return sum(os.path.getsize(os.path.join(where, n)) for where, _, names in os.walk(top) for n in names)

    before = total()
    run()
    return total() - before


def test_many_conditions_write_no_matches(spark, tmp_path):
    rng = random.Random(10)
    words = [f"word{k}" for k in range(200)]
    pairs = [" ".join(words[i] for i in sorted(rng.sample(range(200), 2))) for _ in range(16_000)]
    queries = [(q, "s", "combined", 0.0, 1e9, t) for q, t in enumerate(dict.fromkeys(pairs))][:10_000]
    assert len({q[-1] for q in queries}) == len(queries) == 10_000
    queries = spark.createDataFrame(queries, QUERY)
    left = {}
    for n in (100, 1000):
        items = [(f"K{i:04}", " ".join(rng.sample(words, 40)), float(i % 77)) for i in range(n)]
        df = spark.createDataFrame(items, ITEM)
        listed = price_index.postings(df, "isin", "price", "long_name")
        index = price_index.write_index(listed, str(tmp_path / f"index{n}"))

        def run():
            totals, hits = batch_search(df, queries, size=5, index=index)
            sums = totals.agg(F.sum("total_hits"), F.sum("returned_hits")).first()
            pairs_held = sum(len(set(t.split())) * (len(set(t.split())) - 1) // 2 for _, t, _ in items)
            # about that share of all pairs is asked for
            assert sums[0] == pytest.approx(pairs_held * queries.count() / (200 * 199 / 2), rel=0.05)
            assert hits.count() == sums[1]

        left[n] = written_bytes(spark, run)
    # ten times the rows, which make ten times the matches
    assert left[1000] < 1.3 * left[100]


def test_batch_search_refuses_unknown_types(spark):
    items = spark.createDataFrame([("A", "fund", 1.0)], ITEM)
    queries = spark.createDataFrame([(1, "s", "fuzzy", None, None, "x")], QUERY)
    with pytest.raises(PySparkException, match="Unknown query type: fuzzy"):
        batch_totals(items, queries).collect()


def test_range_only_batches_refuse_text_searches(spark):
    items = spark.createDataFrame([("A", "fund", 1.0)], ITEM)
    queries = spark.createDataFrame([(1, "s", "text_search", None, None, "x")], QUERY)
    with pytest.raises(PySparkException, match="Unknown query type: text_search"):
        batch_totals(items, queries, text=None).collect()


def test_batch_search_over_documents(spark):
    docs = tables.docs(spark, "/root/testdata/sf0.01")
    queries = spark.createDataFrame(
        [
            (1, "s", "combined", 100.0, 900.0, "the and"),
            (2, "s", "text_search", None, None, "le"),
            (3, "s", "price_range", 400.0, 450.0, None),
            (4, "s", "combined", 0.0, 2000.0, "der und"),
            (5, "s", "text_search", None, None, "zzz"),
        ],
        QUERY,
    )
    totals, hits = batch_search(docs, queries, "doc_id", "n_chars", "text")
    assert {r.query_id: (r.total_hits, r.returned_hits) for r in totals.collect()} == {
        1: (134, 100), 2: (138, 100), 3: (25, 25), 4: (71, 71), 5: (0, 0),
    }
    sums = hits.groupBy("query_id").agg(F.sum("doc_id").alias("s")).collect()
    assert {r.query_id: r.s for r in sums} == {1: 46692, 2: 51126, 3: 14949, 4: 36656}


def test_hit_summary_counts_on_the_way_to_the_sample(spark):
    df = spark.createDataFrame([("A", "x", 1.0), ("B", "y" * 60, 0.5), ("C", None, 2.0)], ITEM)

    def run():
        row = S.hit_summary(df, S.search_filter("price_range", 0, 1.5)).first()
        assert row.total_hits == 2
        assert [tuple(s) for s in row.sample_data] == [("B", 0.5, "y" * 50 + "..."), ("A", 1.0, "x")]
        none = S.hit_summary(df, S.search_filter("price_range", 5, 6)).first()
        assert (none.total_hits, none.returned_hits, none.sample_data) == (0, 0, [])
        assert S.hit_summary(df.limit(0), S.search_filter("price_range", 0, 9)).first().total_hits == 0

    assert written_bytes(spark, run) == 0


def test_word_table_takes_one_shuffle_and_merges_repeated_keys(spark, rows, tmp_path):
    texts = [("a", "one two, Two three"), ("a", "one two, Two three"), ("a", "two"), ("b", ""), ("c", None), ("d", "x x x"), (None, "one")]
    df = spark.createDataFrame(texts, "isin string, long_name string")
    counted = word_table.word_counts(df, "long_name")
    assert "Exchange" not in counted._jdf.queryExecution().executedPlan().toString()
    expected = [
        ("a", "", 1, 1), ("a", "", 4, 2), ("a", "one", 4, 2), ("a", "three", 4, 2), ("a", "two", 1, 1), ("a", "two", 4, 4),
        ("b", "", 0, 1), ("d", "", 3, 1), ("d", "x", 3, 3), (None, "", 1, 1), (None, "one", 1, 1),
    ]
    word_table.write(counted, str(tmp_path / "words"))
    columns = ["isin", "word", "length", "times"]
    assert rows(spark.read.parquet(str(tmp_path / "words")).select(columns)) == sorted(expected, key=repr)
    assert rows(word_table.build(df, "long_name").select(columns)) == sorted(expected, key=repr)


def test_a_batch_search_moves_the_postings_of_its_words_alone(spark, tmp_path):
    items = spark.createDataFrame([(f"k{i}", float(i % 7), f"one w{i} two") for i in range(50)], "isin string, price double, long_name string")
    index = price_index.write_index(price_index.postings(items, "isin", "price", "long_name"), str(tmp_path / "index"))
    asked = spark.createDataFrame([("two",), ("w3",), ("none",), ("two",)], "word string")
    cut = price_index.of_words(index, asked)
    assert {r.word: r["count"] for r in cut.postings.groupBy("word").count().collect()} == {"": 50, "two": 50, "w3": 1}
    assert {r.word for r in cut.words.collect()} == {"", "two", "w3"}
    assert price_index.of_words(index, asked, max_words=2) is index
