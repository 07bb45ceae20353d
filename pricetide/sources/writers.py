"""Writing tables, logs and exports."""

from pyspark.sql import functions as F

from pricetide.functions.measures import milliseconds, range_width, rate
from pricetide.functions.times import iso_text
from pricetide.schemas import INSTRUMENTS, SEARCH_METRICS, UPDATE_METRICS


def conform(df, schema):
    """Columns of a schema in order; those the frame lacks are NULL."""
    return df.select(
        *[
            (F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema.fields
        ]
    )


def create_table(
    spark, name, rows=None, schema=INSTRUMENTS, buckets=None, key="isin", sort_by=None
):
    """Create the table with the declared columns, dropping one that exists.

    With `buckets` the rows lie in that many hash buckets of the key, each sorted, so
    that merges by key move only the changes and leave the table where it is. Spark
    keeps to buckets best when they are as many as `spark.sql.shuffle.partitions`.
    With `sort_by` columns the files follow their order instead, so that searches by a
    range of them skip the files that cannot hold a hit.
    """
    empty = spark.createDataFrame([], schema)
    df = empty if rows is None else conform(rows, schema)
    if buckets:
        # One file per bucket: rows meet in their bucket before they are written.
        writer = df.repartition(buckets, key).write.bucketBy(buckets, key).sortBy(key)
    elif sort_by:
        writer = df.repartitionByRange(*sort_by).sortWithinPartitions(*sort_by).write
    else:
        writer = df.write
    writer.mode("overwrite").saveAsTable(name)


def swap_table(spark, name, rows, **options):
    """Put `rows`, which may be read from the table, in its place.

    They are written beside it first, so readers have the old rows until the end. Should
    the swap itself be cut short, `<name>_last` and `<name>_next` hold both tables.
    """
    create_table(spark, f"{name}_next", rows, **options)
    spark.sql(f"drop table if exists {name}_last")
    if spark.catalog.tableExists(name):
        spark.sql(f"alter table {name} rename to {name}_last")
    spark.sql(f"alter table {name}_next rename to {name}")
    spark.sql(f"drop table if exists {name}_last")


def publish(spark, name, rows, **options):
    """Write `rows` as the next version of a table and point the view `name` at it.

    Readers of the view see the version before or this one, never none: the view is
    replaced in one step once the version is whole. The version before stays for those
    that still read it, older ones go. Returns the version's number.
    """
    versions = sorted(
        int(t.name.rpartition("__v")[2])
        for t in spark.catalog.listTables(pattern=f"{name}__v*")
        if t.name.rpartition("__v")[2].isdigit()
    )
    number = versions[-1] + 1 if versions else 1
    create_table(spark, f"{name}__v{number}", rows, **options)
    spark.sql(f"create or replace view {name} as select * from {name}__v{number}")
    for old in versions[:-1]:
        spark.sql(f"drop table {name}__v{old}")
    return number


def export_csv(df, path, single_file=False):
    """Write a table as CSV with a header, over what is there."""
    options = {
        "header": True,
        "escape": '"',
        "ignoreLeadingWhiteSpace": False,
        "ignoreTrailingWhiteSpace": False,
    }
    rows = df.coalesce(1) if single_file else df
    rows.write.mode("overwrite").options(**options).csv(path)


def update_log_rows(df):
    """Update-metrics rows from passes with counts and `duration` in seconds."""
    return conform(
        df.withColumns(
            {
                "duration_seconds": F.round("duration", 2),
                "updates_per_second": F.round(rate(F.col("success_count"), F.col("duration")), 2),
            }
        ),
        UPDATE_METRICS,
    )


def search_log_rows(df):
    """Search-metrics rows from searches with results and `duration` in seconds."""
    ms = milliseconds(F.col("duration"))
    return conform(
        df.withColumns(
            {
                "price_range_width": F.round(range_width(F.col("min_price"), F.col("max_price")), 2),
                "duration_ms": F.round(ms, 2),
                "hits_per_ms": F.round(rate(F.col("total_hits"), ms), 2),
            }
        ),
        SEARCH_METRICS,
    )


def append_log(df, path):
    df.write.mode("append").parquet(path)


def export_log_csv(df, path):
    """A log as CSV: ISO stamps, nested samples as JSON, zero or absent as empty."""
    columns = {"timestamp": iso_text(F.col("timestamp"))}
    if "sample_data" in df.columns:
        columns["sample_data"] = F.to_json("sample_data")
        for c in ("min_price", "max_price"):
            columns[c] = F.nullif(F.col(c), F.lit(0.0))
        columns["price_range_width"] = F.when(F.col("price_range_width") > 0, F.col("price_range_width"))
    export_csv(df.withColumns(columns), path)
