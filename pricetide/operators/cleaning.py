"""Making a raw instruments table fit for loading."""

from pyspark.sql import functions as F

from pricetide.schemas import PRICE, REQUIRED_COLUMNS

# Spellings of a missing value in the CSV files.
MISSING_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None",
    "n/a", "nan", "null",
]


def blank_to_null(df, columns=REQUIRED_COLUMNS):
    """Turn the known spellings of "missing" into NULL."""
    return df.withColumns(
        {c: F.when(~F.col(c).isin(MISSING_TOKENS), F.col(c)) for c in columns}
    )


def parse_price(df, kind=PRICE):
    """Price as a number with two decimals; what cannot be read becomes NULL."""
    return df.withColumn("price", F.col("price").try_cast(kind))


def price_losses(df, kind=PRICE):
    """How many prices `parse_price` makes NULL, by the reason: none given, no number, or too large for `kind`."""
    df, price = blank_to_null(df, ["price"]), F.col("price")
    number = price.try_cast("double")
    lost = price.try_cast(kind).isNull()
    is_number = number.isNotNull() & ~F.isnan(number)
    counts = df.agg(
        F.count_if(price.isNull()).alias("missing"),
        F.count_if(price.isNotNull() & ~F.coalesce(is_number, F.lit(False))).alias("no_number"),
        F.count_if(lost & is_number).alias("too_large"),
    )
    return counts.unpivot([], counts.columns, "reason", "rows")


def duplicate_count(df, key="isin"):
    """Rows beyond the first of each key; rows without a key form one group."""
    return (
        df.groupBy(key)
        .agg(F.count("*").alias("n"))
        .agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).cast("long").alias("duplicates"))
    )


def keep_first(df, key="isin", order="row_order", copies=None):
    """First row of each key in the given order.

    An aggregation rather than a window: the copies of a hot key combine before
    the shuffle. `copies` names an optional column with the rows per key.
    """
    rest = [c for c in df.columns if c != key]
    aggregates = [F.min_by(F.struct(*rest), F.col(order)).alias("first")]
    if copies:
        aggregates.append(F.count("*").alias(copies))
    kept = df.groupBy(key).agg(*aggregates)
    extra = [copies] if copies else []
    return kept.select(*[key if c == key else f"first.{c}" for c in df.columns], *extra)


def missing_counts(df, columns=REQUIRED_COLUMNS):
    """Missing values per column, for columns that have any."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return counts.unpivot([], columns, "column_name", "missing").where("missing > 0")


def drop_incomplete(df, columns=REQUIRED_COLUMNS):
    return df.na.drop(subset=columns)


def clean(df, order="row_order", loaded_at=None, price_type=PRICE):
    """Raw rows to loadable rows: first copy of each key, complete, stamped.

    A key whose first copy is incomplete is dropped even when a later copy is
    complete: duplicates go first, then incomplete rows.
    """
    stamp = F.current_timestamp() if loaded_at is None else F.lit(loaded_at).cast("timestamp")
    rows = parse_price(blank_to_null(df), price_type)
    rows = drop_incomplete(keep_first(rows, "isin", order))
    return rows.select(*REQUIRED_COLUMNS, stamp.alias("updated_at"))


def load_report(df, order="row_order"):
    """Rows read, left after deduplication and left after dropping incomplete rows."""
    rows = parse_price(blank_to_null(df))
    complete = F.lit(True)
    for c in REQUIRED_COLUMNS:
        complete = complete & F.col(c).isNotNull()
    counts = keep_first(rows, "isin", order, copies="copies").agg(
        F.coalesce(F.sum("copies"), F.lit(0)).cast("long").alias("read"),
        F.count("*").alias("after_dedup"),
        F.count_if(complete).alias("after_dropping_incomplete"),
    )
    return counts.unpivot([], counts.columns, "step", "rows")
