"""Reading tables and logs."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from pricetide.schemas import REQUIRED_COLUMNS, SAMPLE, SEARCH_METRICS, UPDATE_METRICS


def _read_csv(spark, path, multiline=False):
    # No schema: Spark would bind one by position and ignore the header.
    options = {"header": True, "escape": '"', "multiLine": multiline}
    return spark.read.options(**options).csv(path)


def read_records(spark, path):
    """The records of CSV files with their place, headers and empty lines left out; quoted texts may span lines.

    A file is read by many tasks all the same. Whether a line begins inside quotes follows
    from the number of quotes before it: those of earlier blocks of the file, a number a
    block, and those of earlier lines of its block. Lines that do are joined to the last
    line that does not, in whichever block that is.
    """
    lines = spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("line"),
        "value",
    )
    quotes = (F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))).cast("long")
    lines = lines.withColumn("quotes", quotes)
    blocks = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    none = F.lit(0).cast("long")
    before = lines.groupBy("file", "block").agg(F.sum("quotes").alias("quotes"))
    before = before.select("file", "block", F.coalesce(F.sum("quotes").over(blocks), none).alias("before"))
    inside = Window.partitionBy("file", "block").orderBy("line")
    earlier = F.coalesce(F.sum("quotes").over(inside.rowsBetween(Window.unboundedPreceding, -1)), none)
    marked = lines.join(before, ["file", "block"])
    marked = marked.withColumn("begins", ((F.col("before") + earlier) % 2 == 0).cast("long"))
    marked = marked.withColumn("record", F.sum("begins").over(inside.rowsBetween(Window.unboundedPreceding, 0)))
    # the last record that begins before each block
    last = marked.groupBy("file", "block").agg(F.max("record").alias("records"))
    begun = F.when(F.col("records") > 0, F.struct(F.col("block").alias("in_block"), F.col("records").alias("record")))
    last = last.select("file", "block", F.last(begun, ignorenulls=True).over(blocks).alias("open"))
    owned = marked.join(last, ["file", "block"])
    own = F.struct(F.col("block").alias("in_block"), F.col("record"))
    owned = owned.withColumn("place", F.when(F.col("record") > 0, own).otherwise(F.col("open")))
    parts = F.sort_array(F.collect_list(F.struct("block", "line", "value")))
    records = owned.groupBy("file", "place").agg(parts.alias("parts")).select(
        "file", "place", F.rtrim(F.array_join("parts.value", "\n"), F.lit("\r")).alias("record")
    )
    header = (F.col("place.in_block") == 0) & (F.col("place.record") == 1)
    return records.where(~header & (F.trim("record") != ""))


def read_quoted_csv(spark, path):
    """Columns of CSV files as text, by header name; `_unreadable` has the records that do not fit the header.

    All files have the header of the first. Quoted texts may span lines (`read_records`).
    """
    names = _read_csv(spark, path).columns
    kinds = ", ".join(f"`{c}` string" for c in [*names, "_unreadable"])
    options = {"escape": '"', "mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_unreadable"}
    return read_records(spark, path).select(F.from_csv("record", kinds, options).alias("row")).select("row.*")


def unreadable(raw, schema):
    """Rows in all, rows that do not fit the header, and values of each typed column that cannot be read.

    `raw` is as `read_quoted_csv` gives it. Nothing is left out without a count.
    """
    fits = F.col("_unreadable").isNull()

    def lost(field):
        text = F.nullif(F.trim(field.name), F.lit(""))
        return F.count_if(fits & text.isNotNull() & F.col(field.name).try_cast(field.dataType).isNull())

    typed = [f for f in schema.fields if f.name in raw.columns and f.dataType.typeName() not in ("string", "array")]
    counts = raw.agg(
        F.count("*").alias("rows"), F.count_if(~fits).alias("misfits"), *[lost(f).alias(f.name) for f in typed]
    )
    return counts.unpivot([], counts.columns, "what", "count")


def check_columns(df, required=REQUIRED_COLUMNS):
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise ValueError(f"Missing required columns: {missing}")
    return df


def column_check(df, required=REQUIRED_COLUMNS):
    """The required columns and whether the frame has them, from the plan alone."""
    rows = [(c, c in df.columns) for c in required]
    return df.sparkSession.createDataFrame(rows, "column_name string, present boolean")


def read_instruments_csv(spark, path, multiline=False):
    """Raw instruments as text, found by header name, with their place in the files.

    `multiline` allows line breaks in quoted texts; a file is then read by one task.
    """
    raw = check_columns(_read_csv(spark, path, multiline))
    order = F.struct(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row"),
    )
    return raw.select(*REQUIRED_COLUMNS, order.alias("row_order"))


def _typed(df, schema, **special):
    """Columns of a log by type; what cannot be read, and what is no number, is NULL."""
    check_columns(df, schema.fieldNames())

    def typed(field):
        value = F.col(field.name).try_cast(field.dataType)
        if field.dataType.typeName() == "double":
            value = F.when(~F.isnan(value), value)
        return special.get(field.name, value).alias(field.name)

    return df.select(*[typed(f) for f in schema.fields])


def read_update_log(spark, path):
    return _typed(_read_csv(spark, path), UPDATE_METRICS)


def read_search_log(spark, path, multiline=True):
    """Search log with its nested sample, whose text may use single quotes.

    Error texts may span lines inside quotes, files are read by many tasks all the same.
    Logs known to have none are read without that work with `multiline=False`. Records that
    do not fit the header are left out; `unreadable` counts them.
    """
    raw = read_quoted_csv(spark, path).where("_unreadable is null") if multiline else _read_csv(spark, path)
    sample = F.from_json(F.col("sample_data"), SAMPLE)
    return _typed(raw, SEARCH_METRICS, sample_data=sample)


def keys_of(df, key="isin"):
    """Keys only, so a columnar scan reads one column."""
    return df.select(key)


def table_exists(spark, name):
    return spark.catalog.tableExists(name)


def describe(df):
    """Columns and types as a frame, from the plan alone."""
    rows = [(f.name, f.dataType.simpleString(), f.nullable) for f in df.schema.fields]
    return df.sparkSession.createDataFrame(rows, "column_name string, data_type string, nullable boolean")
