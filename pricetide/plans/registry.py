"""Every query by name, over the given tables."""

from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from pricetide.functions.measures import milliseconds, range_width, rate, search_label
from pricetide.functions.text import preview
from pricetide.functions.times import second_grid
from pricetide.operators import batch_search as batch
from pricetide.operators import cleaning, merge, price_index, quantiles, ranking, search, word_table
from pricetide.operators.intervals import interval_join
from pricetide.plans import catalogue, impact, search_report, update_report
from pricetide.plans import driver_tables as tables
from pricetide.schemas import SAMPLE, SEARCH_METRICS
from pricetide.sources import readers, synthetic, writers
from pricetide.streaming import log_stream, price_stream, search_stream
from pricetide.workspace import exists, shared_folder

QUERIES = {}


def query(function):
    QUERIES[function.__name__] = function
    return function


def plain(df):
    """Results in the form the twins have: naive stamps, doubles nudged and rounded."""
    columns = {}
    for field in df.schema.fields:
        kind = field.dataType.typeName()
        if kind == "timestamp":
            columns[field.name] = F.col(field.name).cast("timestamp_ntz")
        elif kind == "double":
            columns[field.name] = F.round(F.col(field.name) + 1e-9, 6)
    return df.withColumns(columns) if columns else df


_kept = {}


def kept(spark, folder, name, write):
    """Path of what is made from the given tables for several queries, as an index to search.

    The first of them in an application has it written, the others read it.
    """
    about = spark.sparkContext.applicationId, str(folder), name
    if about not in _kept or not exists(spark, _kept[about]):
        path = shared_folder(spark, name)
        write(path)
        _kept[about] = path
    return _kept[about]


# Searches


@query
def price_range_top100(spark, folder):
    rows = tables.instruments(spark, folder)
    return search.cheapest(rows.where(search.search_filter("price_range", 910, 960)))


@query
def price_stats(spark, folder):
    return plain(search.price_stats(tables.instruments(spark, folder)))


@query
def text_all_terms(spark, folder):
    docs = tables.docs(spark, folder)
    hits = docs.where(search.search_filter("text_search", terms="The and", text="text"))
    return search.cheapest(hits.select("doc_id", "n_chars"), 100, "n_chars", "doc_id")


@query
def text_any_term(spark, folder):
    hits = search.any_term(tables.docs(spark, folder), "the hein", "text")
    return search.cheapest(hits.select("doc_id", "n_chars"), 100, "n_chars", "doc_id")


@query
def text_bm25_top3(spark, folder):
    docs = tables.docs(spark, folder)
    return plain(search.by_relevance(docs, "text", "the hein", 3, "doc_id").select("doc_id", "score"))


def written_words(spark, folder):
    def write(path):
        word_table.write(word_table.word_counts(tables.docs(spark, folder), "text", "doc_id"), path, "doc_id")

    return spark.read.parquet(kept(spark, folder, "words", write))


@query
def word_table_all_terms(spark, folder):
    """Keys from the word table, their numbers from the documents; the texts stay unread."""
    keys = word_table.keys_with_all(written_words(spark, folder), "The and", "doc_id")
    hits = tables.docs(spark, folder).select("doc_id", "n_chars").join(keys, "doc_id", "left_semi")
    return search.cheapest(hits, 100, "n_chars", "doc_id")


@query
def word_table_bm25_top3(spark, folder):
    """Words and statistics from the word table; the texts are split up once, to build it."""
    words = written_words(spark, folder)
    stats = word_table.kept_statistics(words)
    return plain(word_table.by_relevance(words, stats, "the hein", 3, "doc_id"))


@query
def combined_search(spark, folder):
    docs = tables.docs(spark, folder)
    wanted = search.search_filter("combined", 100, 900, "the and", "n_chars", "text")
    return search.cheapest(docs.where(wanted).select("doc_id", "n_chars"), 100, "n_chars", "doc_id")


@query
def combined_bm25_top3(spark, folder):
    docs = tables.docs(spark, folder)
    best = search.by_relevance(
        docs, "text", "the hein", 3, "doc_id", where=search.in_range("n_chars", 100, 500)
    )
    return plain(best.select("doc_id", "n_chars", "score"))


@query
def long_text_filter(spark, folder):
    docs = search.longer_than(tables.docs(spark, folder), 150, "text")
    return search.first_rows(docs, 3, "doc_id").select("doc_id", "n_chars")


@query
def long_text_count(spark, folder):
    return search.row_count(search.longer_than(tables.docs(spark, folder), 150, "text"))


@query
def length_stats(spark, folder):
    return plain(search.length_stats(tables.docs(spark, folder), "text"))


@query
def row_count(spark, folder):
    return search.row_count(tables.instruments(spark, folder))


@query
def key_projection(spark, folder):
    return readers.keys_of(tables.instruments(spark, folder))


@query
def preview_rows(spark, folder):
    return plain(search.first_rows(tables.instruments(spark, folder), 10))


@query
def table_profile(spark, folder):
    return plain(search.table_profile(tables.instruments(spark, folder)))


@query
def row_sample(spark, folder):
    few = search.first_rows(tables.docs(spark, folder), 5, "doc_id")
    numbered = ranking.first_per_group(few.withColumn("all", F.lit(1)), ["all"], ["doc_id"], 5, "number")
    return numbered.select(F.col("number").cast("long").alias("number"), "doc_id", preview(F.col("text")).alias("text"))


def sample_text(key, price, text):
    """A nested sample as one text, for comparing."""
    return F.array_join(
        F.transform(
            "sample_data",
            lambda r: F.concat_ws(
                "|", r[key].cast("string"), r[price].cast("long").cast("string"), r[text]
            ),
        ),
        " ; ",
    )


@query
def search_result_summary(spark, folder):
    wanted = search.search_filter("combined", 100, 900, "the and", "n_chars", "text")
    summary = search.hit_summary(
        tables.docs(spark, folder), wanted, price="n_chars", key="doc_id", text="text"
    )
    return summary.withColumn("returned_hits", F.col("returned_hits").cast("long")).withColumn(
        "sample_data", sample_text("doc_id", "n_chars", "text")
    )


@query
def search_catalogue(spark, folder):
    return catalogue.search_catalogue(tables.instruments(spark, folder))


def docs_index_path(spark, folder):
    """The price index of the documents by words and length."""

    def write(path):
        listed = price_index.postings(tables.docs(spark, folder), "doc_id", "n_chars", "text")
        price_index.write_index(listed, path, "doc_id")

    return kept(spark, folder, "docs-index", write)


def searched_docs(spark, folder):
    """Documents and their index, as batch searches take them."""
    index = price_index.read_index(spark, docs_index_path(spark, folder), "doc_id")
    return dict(items=tables.docs(spark, folder), key="doc_id", price="n_chars", text="text", index=index)


def searched_instruments(spark, folder):
    def write(path):
        listed = price_index.postings(tables.instruments(spark, folder), "isin", "price", "long_name")
        price_index.write_index(listed, path)

    index = price_index.read_index(spark, kept(spark, folder, "instruments-index", write))
    return dict(items=tables.instruments(spark, folder), index=index)


@query
def batch_range_search(spark, folder):
    requests = tables.requests(spark, folder, ("price_range",), 890, 7, 120)
    _, hits = batch.batch_search(queries=requests, text=None, **searched_instruments(spark, folder))
    return plain(hits)


@query
def batch_text_search(spark, folder):
    requests = tables.requests(spark, folder, ("text_search",))
    _, hits = batch.batch_search(queries=requests, **searched_docs(spark, folder))
    return plain(hits)


@query
def batch_combined_search(spark, folder):
    requests = tables.requests(spark, folder)
    _, hits = batch.batch_search(queries=requests, **searched_docs(spark, folder))
    return plain(hits)


@query
def batch_search_totals(spark, folder):
    requests = tables.requests(spark, folder)
    totals = batch.batch_totals(queries=requests, **searched_docs(spark, folder))
    return totals.withColumn("returned_hits", F.col("returned_hits").cast("long"))


@query
def catalogue_totals(spark, folder):
    """Without an index made before: the words of the catalogue are indexed for it."""
    instruments = tables.instruments(spark, folder)
    totals = batch.batch_totals(instruments, catalogue.search_catalogue(instruments))
    return totals.select("query_id", "total_hits")


@query
def search_log_rows(spark, folder):
    """Searches of the log with the columns a log row derives."""
    log = tables.search_metrics(spark, folder)
    seconds = F.col("duration_ms") / 1000
    low = F.when(F.col("search_id") % 3 != 1, F.col("search_id").cast("double") / 4)
    kind = F.element_at(
        F.array(*map(F.lit, ["price_range", "text_search", "combined"])),
        (F.col("search_id") % 3 + 1).cast("int"),
    )
    high = low + F.col("total_hits") % 100
    words = F.when(kind != "price_range", F.col("query_type"))
    return plain(
        log.select(
            "search_id",
            search_label(F.col("search_type"), kind, low, high, words).alias("label"),
            range_width(low, high).alias("price_range_width"),
            milliseconds(seconds).alias("duration_ms"),
            rate(F.col("total_hits"), milliseconds(seconds)).alias("hits_per_ms"),
        )
    )


@query
def unknown_search_types(spark, folder):
    """Requests of a type that does not exist fail, each on its own; the others are answered."""
    turn = F.col("query_id") % 7
    kind = F.when(turn == 3, "fuzzy").when(turn != 5, F.col("query_type"))
    requests = tables.requests(spark, folder).withColumn("query_type", kind)
    answers = search_stream.answer(queries=requests, **searched_docs(spark, folder))
    return answers.where("not success").select("query_id", "success", "total_hits", "returned_hits", "error")


# Cleaning and loading


@query
def required_columns(spark, folder):
    """Which of the required columns two of the tables have."""
    checks = {"instruments": tables.instruments(spark, folder), "documents": tables.docs(spark, folder)}
    found = [readers.column_check(df).withColumn("table", F.lit(name)) for name, df in checks.items()]
    return found[0].unionByName(found[1])


def catalogue_name(spark):
    return "listed_" + shared_folder(spark, "x")[-12:]


@query
def table_description(spark, folder):
    """Columns of the instruments table as it is created, and whether it was there before and after."""
    name = catalogue_name(spark)
    before = readers.table_exists(spark, name)
    writers.create_table(spark, name, tables.instruments(spark, folder), buckets=4)
    after = readers.table_exists(spark, name)
    described = readers.describe(spark.table(name))
    spark.sql(f"drop table {name}")
    return described.drop("nullable").withColumns({"existed": F.lit(before), "exists": F.lit(after)})


@query
def table_versions(spark, folder):
    """Rows and highest price that a reader of a table sees as its versions are published."""
    name, seen = catalogue_name(spark), []
    items = tables.instruments(spark, folder)
    for step, rows in enumerate([items, items.where("price < 1000"), items.withColumn("price", F.col("price") * 2)]):
        writers.publish(spark, name, rows)
        figures = spark.table(name).agg(F.count("*").alias("rows"), F.max("price").cast("double").alias("max_price"))
        seen.append((step, *figures.first()))
    spark.sql(f"drop view {name}")
    for number in (2, 3):
        spark.sql(f"drop table {name}__v{number}")
    return plain(spark.createDataFrame(seen, "step long, rows long, max_price double"))


@query
def dup_count(spark, folder):
    return cleaning.duplicate_count(tables.dirty_instruments(spark, folder))


@query
def dedup_keep_first(spark, folder):
    return cleaning.keep_first(tables.dirty_instruments(spark, folder))


@query
def dedup_documents(spark, folder):
    # A long key moves as its digest.
    digest = F.unhex(F.sha2("text", 256)).alias("digest")
    docs = tables.docs(spark, folder).select("doc_id", "n_chars", digest)
    return cleaning.keep_first(docs, "digest", "doc_id").select("doc_id", "n_chars")


@query
def missing_counts(spark, folder):
    rows = cleaning.blank_to_null(tables.dirty_instruments(spark, folder))
    return cleaning.missing_counts(cleaning.parse_price(rows))


@query
def clean_load(spark, folder):
    rows = cleaning.clean(tables.dirty_instruments(spark, folder), loaded_at="2024-01-01 00:00:00")
    return plain(rows.withColumn("price", F.col("price").cast("double")))


@query
def load_report(spark, folder):
    return cleaning.load_report(tables.dirty_instruments(spark, folder))


@query
def price_losses(spark, folder):
    """Prices that cleaning cannot keep, by the reason; some are made too large or are words."""
    rows = tables.dirty_instruments(spark, folder)
    turn = F.col("row_order") % 97
    price = F.when(turn == 5, "1e16").when(turn == 6, "99999999999999999.99").when(turn == 7, "about 5").otherwise(F.col("price"))
    return cleaning.price_losses(rows.withColumn("price", price))


@query
def csv_import(spark, folder):
    """Export as CSV, read back by header, clean."""
    path = shared_folder(spark, "csv")
    rows = tables.dirty_instruments(spark, folder)
    # The files keep the rows' order, so the first copy in file order is known.
    writers.export_csv(rows.orderBy("row_order").drop("row_order"), path)
    raw = readers.read_instruments_csv(spark, path)
    rows = cleaning.clean(raw, loaded_at="2024-01-01 00:00:00")
    return plain(rows.withColumn("price", F.col("price").cast("double")))


@query
def upsert_replace(spark, folder):
    target = tables.merge_target(spark, folder).withColumn("update_iteration", F.lit(7).cast("long"))
    return plain(merge.replace_rows(target, tables.replacements(spark, folder)))


@query
def upsert_last_wins(spark, folder):
    """Line items as whole rows, many of one key: the last of each key stands."""
    columns = ["isin", "price", "updated_at", "update_iteration"]
    rows = tables.price_changes(spark, folder).select(*columns, "line")
    target = tables.merge_target(spark, folder).withColumn("line", F.lit(None).cast("int"))
    return plain(merge.replace_rows(target, rows, order=tables.CHANGE_ORDER).drop("line"))


@query
def patch_prices(spark, folder):
    return plain(
        merge.patch_rows(
            tables.merge_target(spark, folder),
            tables.price_changes(spark, folder),
            order=tables.CHANGE_ORDER,
        )
    )


@query
def patch_prices_twice(spark, folder):
    """The same changes applied again, as after a retry: nothing more changes."""
    changes = tables.price_changes(spark, folder)
    once = merge.patch_rows(tables.merge_target(spark, folder), changes, order=tables.CHANGE_ORDER)
    return plain(merge.patch_rows(once, changes, order=tables.CHANGE_ORDER))


@query
def unmatched_changes(spark, folder):
    return plain(
        merge.unmatched_changes(
            tables.merge_target(spark, folder),
            tables.price_changes(spark, folder),
            order=tables.CHANGE_ORDER,
        )
    )


@query
def merge_tally(spark, folder):
    return plain(
        merge.merge_tally(
            tables.merge_target(spark, folder), tables.price_changes(spark, folder), seconds=2.5
        )
    )


@query
def batch_numbers(spark, folder):
    return ranking.batch_numbers(tables.instruments(spark, folder).select("isin"), "isin").select(
        "isin", "row_number", "batch", "batch_start"
    )


@query
def first_errors(spark, folder):
    """First three unmatched keys of each batch of a thousand changed keys."""
    latest = merge.latest_changes(tables.price_changes(spark, folder), order=tables.CHANGE_ORDER)
    numbered = ranking.batch_numbers(latest.select("isin"), "isin")
    errors = numbered.join(tables.merge_target(spark, folder).select("isin"), "isin", "left_anti")
    first = ranking.first_per_group(errors, ["batch"], ["isin"], 3)
    return first.select("batch", F.col("rank").cast("long").alias("rank"), "isin")


@query
def price_pass(spark, folder):
    """A pass that sets every price anew, applied to the table."""
    target = tables.instruments(spark, folder)
    changes = synthetic.price_pass(readers.keys_of(target), 3, "2024-02-01 00:00:00")
    target = target.withColumns(
        {
            "price": F.col("price").cast("decimal(10,2)"),
            "updated_at": F.lit(None).cast("timestamp"),
            "update_iteration": F.lit(None).cast("long"),
        }
    )
    patched = merge.patch_rows(target, changes)
    return plain(patched.withColumn("price", F.col("price").cast("double")))


# Reports on the logs


def report(name, build):
    def run(spark, folder):
        return plain(
            build(tables.update_metrics(spark, folder), tables.search_metrics(spark, folder))
        )

    run.__name__ = name
    QUERIES[name] = run


report("search_totals", lambda u, s: search_report.search_totals(s))
report("failed_searches", lambda u, s: search_report.failed(s).select("search_id", "timestamp"))
report("search_duration_stats", lambda u, s: search_report.duration_summary(s))
report("by_search_type", lambda u, s: search_report.duration_by(s, "search_type").drop("max"))
report("by_query_type", lambda u, s: search_report.duration_by(s, "query_type").drop("max"))
report("query_types", lambda u, s: search_report.query_types(s))
report("box_stats", lambda u, s: search_report.box_stats(s))
report("box_outliers", lambda u, s: search_report.box_outliers(s))
report("update_totals", lambda u, s: update_report.update_totals(u))
report("update_duration_stats", lambda u, s: update_report.update_duration_summary(u))
report("update_rate_stats", lambda u, s: update_report.update_rate_summary(u))
report(
    "run_ids",
    lambda u, s: update_report.run_ids(
        u.withColumn("iteration", F.col("iteration") % 50), "error_count"
    ).select("timestamp", "error_count", "iteration", "run_id"),
)
report("log_checks", lambda u, s: update_report.log_checks(u))
report(
    "window_join",
    lambda u, s: impact.searches_during(u, s).select("iteration", "search_id", "duration_ms"),
)
report("window_stats", impact.window_stats)
report("window_stats_end_stamp", lambda u, s: impact.window_stats(u, s, stamp="end"))
report("window_count", impact.window_count)


def unmeasured(searches):
    """The search log with one time in seven that is no number."""
    lost = F.col("search_id") % 7 == 2
    return searches.withColumn("duration_ms", F.when(lost, float("nan")).otherwise(F.col("duration_ms")))


report("update_impact_nan", lambda u, s: impact.update_impact(u, unmeasured(s)))
report("empty_report", lambda u, s: search_report.search_totals(s.where("search_id < 0")))
report("empty_summary", lambda u, s: search_report.duration_summary(s.where("search_id < 0")))
report(
    "outside_windows",
    lambda u, s: impact.searches_outside(u, s).select("search_id", "timestamp", "duration_ms"),
)
report("correlations", impact.correlations)
report("update_impact", impact.update_impact)
report("impact_lines", impact.impact_lines)
report("impact_by_type", impact.impact_by_type)
report("search_over_time", lambda u, s: search_report.over_time(s))
report("series_search", lambda u, s: impact.search_series(s))
report("series_update", lambda u, s: impact.update_series(u))
report("overlay", lambda u, s: impact.overlay(u, s))
report(
    "window_seconds",
    lambda u, s: impact.update_windows(u)
    .select("iteration", F.explode(second_grid(F.col("window_start"), F.col("window_end"))).alias("at"))
    .groupBy("iteration")
    .agg(F.count("*").alias("steps"), F.max("at").alias("last_step")),
)


def ten_minute_windows(spark, folder):
    updates = tables.update_metrics(spark, folder).withColumn("duration_seconds", F.lit(600.0))
    return impact.update_windows(updates)


@query
def window_join_bucketed(spark, folder):
    """All events within ten minutes of a pass, with buckets of a given width."""
    return interval_join(
        ten_minute_windows(spark, folder),
        tables.search_metrics(spark, folder),
        "timestamp",
        impact.POINT_ID,
        bucket_seconds=600,
    ).select("iteration", "search_id")


@query
def outside_windows_bucketed(spark, folder):
    return interval_join(
        ten_minute_windows(spark, folder),
        tables.search_metrics(spark, folder),
        "timestamp",
        impact.POINT_ID,
        how="left_anti",
        bucket_seconds=600,
    ).select("search_id")


@query
def update_log_csv(spark, folder):
    """Log rows written as CSV and read back."""
    path = shared_folder(spark, "update-log")
    log = tables.update_metrics(spark, folder)
    rows = writers.update_log_rows(log.withColumn("duration", F.col("duration_seconds")))
    writers.export_log_csv(rows, path)
    return plain(readers.read_update_log(spark, path))


@query
def search_log_csv(spark, folder):
    """Log rows with a nested sample written as CSV and read back."""
    path = shared_folder(spark, "search-log")
    log = tables.search_metrics(spark, folder)
    sample = F.array(
        F.struct(
            F.col("search_type").alias("isin"),
            F.col("duration_ms").alias("price"),
            F.concat(F.lit("O'Neil \"A\", "), F.col("query_type")).alias("long_name"),
        )
    )
    rows = writers.search_log_rows(
        log.withColumns(
            {
                "duration": F.col("duration_ms") / 1000,
                "min_price": F.col("search_id").cast("double"),
                "max_price": (F.col("search_id") + F.col("total_hits") % 10).cast("double"),
                "returned_hits": F.least(F.col("total_hits"), F.lit(100)).cast("long"),
                "sample_data": F.when(F.col("success"), sample).otherwise(
                    F.array().cast(SAMPLE)
                ),
            }
        )
    )
    writers.export_log_csv(rows, path)
    back = readers.read_search_log(spark, path)
    return plain(
        back.select(
            "timestamp",
            "search_id",
            "search_type",
            "success",
            "min_price",
            "price_range_width",
            "duration_ms",
            "total_hits",
            "returned_hits",
            F.size("sample_data").cast("long").alias("samples"),
            F.get("sample_data", F.lit(0))["long_name"].alias("first_name"),
            F.get("sample_data", F.lit(0))["price"].alias("first_price"),
        )
    )


def search_log_text(spark, folder):
    """A search log as CSV text whose errors have line breaks, quotes and commas; some rows are broken."""
    log = tables.search_metrics(spark, folder)
    number = F.col("search_id")
    error = F.concat(F.lit('"timed out,\n after ""'), number, F.lit('"" ms\n\n"'))
    took = F.when(number % 11 == 3, F.lit("soon")).otherwise(F.col("duration_ms").cast("string"))
    line = F.concat_ws(",", number, "query_type", took, F.when(number % 5 == 0, error).otherwise(F.lit("")))
    line = F.when(number % 13 == 4, F.concat(F.lit("lost,"), number)).otherwise(line)
    path = shared_folder(spark, "log-text")
    lines = log.select((number % 16).alias("file"), number.alias("search_id"), line.alias("value"))
    # the header stands at the top of each file
    top = spark.range(16).select("id", F.lit(-1).cast("long"), F.lit("search_id,query_type,duration_ms,error"))
    rows = lines.union(top).repartition("file").sortWithinPartitions("file", "search_id")
    rows.select("file", "value").write.partitionBy("file").text(path)
    return f"{path}/*"


@query
def search_log_lines(spark, folder):
    """Searches of such a log with the length of their error texts."""
    raw = readers.read_quoted_csv(spark, search_log_text(spark, folder)).where("_unreadable is null")
    return plain(
        raw.select(
            F.col("search_id").cast("long").alias("search_id"),
            "query_type",
            F.col("duration_ms").try_cast("double").alias("duration_ms"),
            F.coalesce(F.length("error"), F.lit(0)).alias("error_length"),
        )
    )


@query
def unreadable_log_rows(spark, folder):
    """Rows of such a log, rows that do not fit its header, and times that cannot be read."""
    raw = readers.read_quoted_csv(spark, search_log_text(spark, folder))
    found = readers.unreadable(raw, SEARCH_METRICS)
    return found.where("what in ('rows', 'misfits', 'search_id', 'duration_ms')")


# Streams, drained and read back


def read_stream(spark, folder, table):
    schema = tables.read(spark, folder, table).schema
    # A pattern, because the file source takes a plain path for a folder, and a table may
    # be a folder or a single file.
    return spark.readStream.schema(schema).parquet(f"{folder}/{table}.parque[t]")


#: Files of a micro-batch of a stream in several: its rows are written and read by as many tasks.
FILES_PER_BATCH = 8


def price_stream_of(spark, folder, batches=None, work=None):
    """A folder with the base, and what starts a stream of price changes on it, in so many batches if told."""
    work = work or shared_folder(spark, "price-stream")
    tables.merge_target(spark, folder).write.parquet(f"{work}/base")
    if batches is None:
        changes = tables.price_changes_of(read_stream(spark, folder, "lineitem"))
    else:
        rows = tables.price_changes(spark, folder)
        rows.repartition(batches * FILES_PER_BATCH, F.rand(1)).write.parquet(f"{work}/changes")
        changes = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", FILES_PER_BATCH).parquet(f"{work}/changes")

    def start(**options):
        paths = f"{work}/base", f"{work}/state", f"{work}/checkpoint"
        return price_stream.start(changes, *paths, order=tables.CHANGE_ORDER, **options)

    return work, start


def streamed_table(spark, work):
    return plain(price_stream.current_table(spark, f"{work}/base", f"{work}/state", order=tables.CHANGE_ORDER))


def log_sums(spark, work):
    log = price_stream.update_log(spark, f"{work}/state")
    return log.agg(
        F.sum("total_instruments").alias("total"),
        F.sum("success_count").alias("success_count"),
        F.sum("error_count").alias("error_count"),
        F.count_if(F.col("updates_per_second") < 0).alias("odd_rates"),
    )


@query
def stream_patch_prices(spark, folder):
    work, start = price_stream_of(spark, folder)
    price_stream.finish(start())
    return streamed_table(spark, work)


@query
def stream_update_log(spark, folder):
    work, start = price_stream_of(spark, folder)
    price_stream.finish(start())
    return log_sums(spark, work)


def broken_off_stream(spark, folder):
    """A stream of three batches whose second breaks off when all but its ledger row is written, and goes on."""

    def break_off(batch_id):
        if batch_id == 1:
            raise RuntimeError("broken off on purpose")

    def run(work):
        _, start = price_stream_of(spark, folder, 3, work)
        try:
            price_stream.finish(start(before_commit=break_off))
        except StreamingQueryException:
            price_stream.finish(start())

    return kept(spark, folder, "broken-off-stream", run)


@query
def stream_replay(spark, folder):
    """The table that a stream leaves which broke off inside a batch and ran again from its checkpoint."""
    return streamed_table(spark, broken_off_stream(spark, folder))


@query
def stream_replay_log(spark, folder):
    """The log of such a stream: every change once."""
    return log_sums(spark, broken_off_stream(spark, folder)).drop("odd_rates")


@query
def stream_stop_and_go(spark, folder):
    """The table of a stream that is stopped after two of five batches, compacted, and goes on."""

    def run(work):
        _, start = price_stream_of(spark, folder, 5, work)
        base, state = f"{work}/base", f"{work}/state"

        def stop(batch_id):
            if batch_id == 1:
                price_stream.ask_to_stop(spark, state)

        price_stream.finish(start(before_commit=stop))
        price_stream.compact(spark, base, state, f"{work}/base-2", order=tables.CHANGE_ORDER)
        price_stream.finish(start())

    return streamed_table(spark, kept(spark, folder, "stopped-stream", run))


@query
def stream_search_log(spark, folder):
    work = shared_folder(spark, "search-stream")
    docs = f"{folder}/documents.parquet"
    tables.requests(spark, folder).write.parquet(f"{work}/requests")
    schema = tables.requests(spark, folder).schema
    requests = spark.readStream.schema(schema).parquet(f"{work}/requests")
    search_stream.start(
        requests,
        docs,
        f"{work}/out",
        f"{work}/checkpoint",
        key="doc_id",
        price="n_chars",
        text="text",
        index_path=docs_index_path(spark, folder),
    ).awaitTermination()
    log = search_stream.search_log(spark, f"{work}/out")
    return plain(
        log.select(
            "search_id",
            "search_type",
            "query_type",
            "min_price",
            "max_price",
            "price_range_width",
            "text_query",
            "success",
            "total_hits",
            "returned_hits",
            F.coalesce(sample_text("isin", "price", "long_name"), F.lit("")).alias("sample_data"),
        )
    )


@query
def stream_summary(spark, folder):
    work = shared_folder(spark, "summary-stream")
    searches = tables.search_metrics_of(read_stream(spark, folder, "events"))
    searches = search_report.successful(searches)
    log_stream.start_summary(searches, f"{work}/out", f"{work}/checkpoint").awaitTermination()
    return plain(log_stream.latest_summary(spark, f"{work}/out").drop("max"))


SKETCHED = {"low": 0.25, "median": 0.5, "high": 0.9}


@query
def stream_sketch_summary(spark, folder):
    """Quantiles that a stream keeps in sketches, beside the exact ones they have to lie between."""
    work = shared_folder(spark, "sketch-stream")
    searches = unmeasured(tables.search_metrics_of(read_stream(spark, folder, "events")))
    searches = search_report.successful(searches)
    sketched = search_report.sketch_summary(searches, ["query_type"], "duration_ms", SKETCHED)
    log_stream.start_totals(sketched, f"{work}/out", f"{work}/checkpoint").awaitTermination()
    got = log_stream.latest_summary(spark, f"{work}/out")
    logged = search_report.successful(unmeasured(tables.search_metrics(spark, folder)))
    bounds = {}
    for name, p in SKETCHED.items():
        bounds |= {f"{name}_from": p - search_report.RANK_ERROR, f"{name}_to": p + search_report.RANK_ERROR}
    exact = quantiles.exact_quantiles(quantiles.value_counts(logged, ["query_type"], "duration_ms"), ["query_type"], bounds)
    # the ranks that a sketched value has among all values
    number, met = F.when(~F.isnan("duration_ms"), F.col("duration_ms")), F.lit(True)
    for name, p in SKETCHED.items():
        below = F.count_if(number < F.col(name)) / F.count(number) - search_report.RANK_ERROR
        upto = F.count_if(number <= F.col(name)) / F.count(number) + search_report.RANK_ERROR
        met = met & (below <= p) & (upto >= p)
    within = logged.join(got, "query_type").groupBy("query_type").agg(met.alias("within"))
    found = got.join(exact, "query_type").join(within, "query_type")
    return plain(found.select("query_type", "count", "mean", "max", *bounds, "within"))


@query
def stream_update_summary(spark, folder):
    work = shared_folder(spark, "update-summary-stream")
    updates = tables.update_metrics_of(read_stream(spark, folder, "events"))
    log_stream.start_summary(
        updates, f"{work}/out", f"{work}/checkpoint", by=(), value="duration_seconds"
    ).awaitTermination()
    return plain(log_stream.latest_summary(spark, f"{work}/out").drop("everything"))


@query
def stream_search_totals(spark, folder):
    work = shared_folder(spark, "totals-stream")
    searches = tables.search_metrics_of(read_stream(spark, folder, "events"))
    log_stream.start_totals(
        search_report.search_totals(searches), f"{work}/out", f"{work}/checkpoint"
    ).awaitTermination()
    return plain(log_stream.latest_summary(spark, f"{work}/out"))


@query
def stream_update_totals(spark, folder):
    work = shared_folder(spark, "totals-stream")
    updates = tables.update_metrics_of(read_stream(spark, folder, "events"))
    log_stream.start_totals(
        update_report.update_totals(updates), f"{work}/out", f"{work}/checkpoint"
    ).awaitTermination()
    return plain(log_stream.latest_summary(spark, f"{work}/out"))


@query
def stream_search_over_time(spark, folder):
    work = shared_folder(spark, "over-time-stream")
    searches = tables.search_metrics_of(read_stream(spark, folder, "events"))
    log_stream.start_over_time(searches, f"{work}/out", f"{work}/checkpoint").awaitTermination()
    return plain(log_stream.windows_so_far(spark, f"{work}/out"))


# Synthetic tables


@query
def synth_instruments(spark, folder):
    parts = tables.read(spark, folder, "part")
    made = synthetic.synthetic_instruments(parts, "p_partkey")
    return made.withColumn("price", F.col("price").cast("double"))


@query
def synth_profile(spark, folder):
    orders = tables.read(spark, folder, "orders")
    made = synthetic.synthetic_instruments(orders, "o_orderkey")
    return plain(search.table_profile(made.withColumn("price", F.col("price").cast("double"))))
