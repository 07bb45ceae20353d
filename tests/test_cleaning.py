import pytest
from pyspark.sql import functions as F

from pricetide.operators import cleaning as C
from pricetide.sources.readers import read_instruments_csv
from pricetide.sources.writers import export_csv

DIRTY = """isin,name,long_name,price
K1,n,l,
K1,n,l,5
K2,NA,l,1
K3,n,l,2
,n,l,3
,n,l,4
K4,n,l,abc
"""


def write(folder, **files):
    for name, text in files.items():
        (folder / f"{name}.csv").write_text(text)
    return str(folder)


def test_dirty_csv(spark, tmp_path, rows):
    raw = read_instruments_csv(spark, write(tmp_path, a=DIRTY))
    blank = C.blank_to_null(raw)
    assert C.duplicate_count(blank).first().duplicates == 2
    assert C.keep_first(blank).count() == 5
    kept = C.clean(raw, loaded_at="2024-01-01 00:00:00")
    assert [(r.isin, float(r.price)) for r in kept.collect()] == [("K3", 2.0)]
    assert kept.schema["price"].dataType.simpleString() == "decimal(18,2)"
    assert rows(C.load_report(raw)) == [
        ("after_dedup", 5),
        ("after_dropping_incomplete", 1),
        ("read", 7),
    ]
    assert rows(C.missing_counts(C.parse_price(blank))) == [("isin", 2), ("name", 1), ("price", 2)]


def test_columns_are_found_by_name(spark, tmp_path):
    path = write(tmp_path, a='price,isin,long_name,name,extra\n1.5,K1,"the ""long"" one, really",short,x\n')
    row = read_instruments_csv(spark, path).first()
    assert (row.isin, row.name, row.long_name, row.price) == ("K1", "short", 'the "long" one, really', "1.5")


def test_line_breaks_and_spaces_in_texts(spark, tmp_path):
    path = write(tmp_path, a='isin,name,long_name,price\nK1," s ","two\nlines",1\n')
    row = read_instruments_csv(spark, path, multiline=True).first()
    assert (row.name, row.long_name) == (" s ", "two\nlines")
    out = str(tmp_path / "out")
    export_csv(read_instruments_csv(spark, path, multiline=True).drop("row_order"), out)
    again = read_instruments_csv(spark, out, multiline=True).first()
    assert (again.name, again.long_name, again.price) == (" s ", "two\nlines", "1")


def test_missing_column(spark, tmp_path):
    with pytest.raises(ValueError, match="price"):
        read_instruments_csv(spark, write(tmp_path, a="isin,name,long_name\nK1,n,l\n"))


def test_first_copy_over_many_files(spark, tmp_path):
    head = "isin,name,long_name,price\n"
    files = {
        f"part{f}": head + "".join(f"K{i % 7},n{f}_{i},l,{i}\n" for i in range(f, 40)) for f in range(5)
    }
    raw = read_instruments_csv(spark, write(tmp_path, **files))
    first = {r.isin: r.name for r in C.keep_first(raw).collect()}
    assert first == {f"K{i}": f"n0_{i}" for i in range(7)}


@pytest.mark.parametrize("parts", [1, 4, 16])
def test_keep_first_does_not_depend_on_partitions(spark, parts, rows):
    # One key holds a third of the rows.
    df = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("K"), F.col("id") % 97)).alias("isin"),
        (3000 - F.col("id")).alias("row_order"),
    )
    kept = C.keep_first(df.repartition(parts), copies="copies")
    hot = kept.where("isin = 'hot'").first()
    assert (hot.row_order, hot.copies) == (3, 1000)
    assert kept.count() == 98


def test_missing_spellings(spark):
    df = spark.createDataFrame([(t,) for t in ["", "N/A", "null", "None", "nan", "x", "none?"]], "name string")
    kept = C.blank_to_null(df, ["name"]).where("name is not null").collect()
    assert sorted(r.name for r in kept) == ["none?", "x"]


def test_large_prices_are_loaded(spark):
    raw = spark.createDataFrame(
        [("K1", "a", "b", "100000000.00", 1), ("K2", "a", "b", "99999999.99", 2)],
        "isin string, name string, long_name string, price string, row_order long",
    )
    kept = C.clean(raw, loaded_at="2024-01-01 00:00:00")
    assert sorted(str(r.price) for r in kept.collect()) == ["100000000.00", "99999999.99"]


def test_lost_prices_are_counted_by_reason(spark):
    prices = ["1.50", None, "", "n/a", "NaN", "five", "1e16", "9999999999999999.99", "99999999999999999.99", "Infinity", "1e-3"]
    rows = spark.createDataFrame([(str(i), "n", "l", p) for i, p in enumerate(prices)], "isin string, name string, long_name string, price string")
    got = {r.reason: r.rows for r in C.price_losses(rows).collect()}
    kept = C.parse_price(C.blank_to_null(rows)).where("price is not null").count()
    assert sum(got.values()) + kept == len(prices)
    assert got == {"missing": 4, "no_number": 1, "too_large": 3}
