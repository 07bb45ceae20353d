import pytest
from pyspark.sql import functions as F

from pricetide.functions import text as T

NAMES = [
    (1, "Fundamental Analysis Strategy"),
    (2, "Impact Fund"),
    (3, "Asia-Pacific ETF"),
    (4, "O'Neil Fund"),
    (5, "Risk-Adjusted Diversifi..."),
    (6, None),
]


@pytest.fixture(scope="module")
def names(spark):
    return spark.createDataFrame(NAMES, "id long, long_name string")


def ids(df):
    return sorted(r.id for r in df.collect())


@pytest.mark.parametrize(
    "terms, found",
    [
        ("Fund", [2, 4]),
        ("asia", [3]),
        ("PACIFIC", [3]),
        ("diversifi", [5]),
        ("technology", []),
        ("o'neil fund", [4]),
        ("fund impact", [2]),
        ("", []),
        ("!?", []),
    ],
)
def test_all_terms_match_words_not_substrings(names, terms, found):
    assert ids(names.where(T.has_all_terms(F.col("long_name"), terms))) == found


def test_any_term_and_all_terms_differ(spark):
    rows = [(1, "Investment Bank"), (2, "Index Fund"), (3, "Investment Fund"), (4, "ETF")]
    df = spark.createDataFrame(rows, "id long, t string")
    assert ids(df.where(T.has_any_term(F.col("t"), "investment fund"))) == [1, 2, 3]
    assert ids(df.where(T.has_all_terms(F.col("t"), "investment fund"))) == [3]


@pytest.mark.parametrize(
    "text",
    ["O'Neil & Söhne, v1.2_b", "Asia-Pacific 'quoted' ... end.", "der Hein’s étage № 5", "a.b'c_d .x y. ''"],
)
def test_query_terms_follow_the_token_rule(spark, text):
    column = spark.range(1).select(F.array_distinct(T.tokens(F.lit(text))).alias("t")).first().t
    assert T.query_terms(text) == column


def test_preview(spark):
    df = spark.createDataFrame([("a" * 50,), ("a" * 51,), (None,)], "t string")
    assert [r[0] for r in df.select(T.preview(F.col("t"))).collect()] == [
        "a" * 50,
        "a" * 50 + "...",
        "N/A",
    ]


def test_truncate_and_pad(spark):
    df = spark.createDataFrame([("a" * 200,), ("a" * 201,), ("a" * 60,)], "t string")
    padded = T.pad_with_phrases(F.col("t"), F.array(*[F.lit("twelve chars")] * 8), 100)
    out = [r[0] for r in df.select(T.shorten(padded, 200, 197)).collect()]
    assert out[0] == "a" * 200
    assert out[1] == "a" * 197 + "..." and len(out[1]) == 200
    assert out[2] == "a" * 60 + " twelve chars" * 4
