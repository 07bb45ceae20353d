import bisect
import random

import pandas as pd
import pyarrow as pa
import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from pricetide.operators import merge
from pricetide.plans import driver_tables as tables
from pricetide.plans import search_report
from pricetide.schemas import SEARCH_METRICS
from pricetide.streaming import keyed_state, log_stream, price_stream, search_stream

SF = "/root/testdata/sf0.001"
ORDER = tables.CHANGE_ORDER


def pieces(df, path, n, by):
    """Write a frame as n files, rows dealt out by a column."""
    for i in range(n):
        df.where(F.pmod(F.xxhash64(by), F.lit(n)) == i).coalesce(1).write.mode("append").parquet(path)
    return df.sparkSession.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(path)


def test_price_stream_equals_one_batch(spark, tmp_path, rows):
    target, changes = tables.merge_target(spark, SF), tables.price_changes(spark, SF)
    base, state = str(tmp_path / "base"), str(tmp_path / "state")
    target.write.parquet(base)
    stream = pieces(changes, str(tmp_path / "changes"), 4, "updated_at")
    price_stream.start(stream, base, state, str(tmp_path / "cp"), order=ORDER).awaitTermination()
    expected = rows(merge.patch_rows(target, changes, order=ORDER))
    assert rows(price_stream.current_table(spark, base, state, order=ORDER)) == expected

    log = price_stream.update_log(spark, state)
    assert sorted(r.iteration for r in log.collect()) == [1, 2, 3, 4]
    sums = log.agg(F.sum("total_instruments"), F.sum("success_count"), F.sum("error_count")).first()
    assert tuple(sums) == tuple(merge.merge_tally(target, changes).first())
    unknown = price_stream.rejected(spark, state).select("isin").distinct()
    assert rows(unknown) == rows(merge.unmatched_changes(target, changes, order=ORDER).select("isin"))

    # A batch that is run again leaves the same table and log.
    price_stream.apply_batch(changes.where("line = 1"), 4, base, state, order=ORDER)
    price_stream.apply_batch(changes.where("line = 1"), 4, base, state, order=ORDER)
    assert rows(price_stream.current_table(spark, base, state, order=ORDER)) == expected
    assert price_stream.update_log(spark, state).count() == 5

    # So does a new base, with or without the changes it holds.
    new_base = str(tmp_path / "new_base")
    price_stream.write_base(spark, base, state, new_base, order=ORDER)
    assert rows(spark.read.parquet(new_base)) == expected
    assert rows(price_stream.current_table(spark, new_base, state, order=ORDER)) == expected


def test_price_stream_goes_on_where_it_stopped(spark, tmp_path):
    base, state, cp = (str(tmp_path / n) for n in ("base", "state", "cp"))
    changes = tables.price_changes(spark, SF)
    tables.merge_target(spark, SF).write.parquet(base)
    stream = pieces(changes, str(tmp_path / "changes"), 2, "updated_at")
    for _ in range(2):
        price_stream.start(stream, base, state, cp, order=ORDER).awaitTermination()
    assert price_stream.update_log(spark, state).count() == 2
    pieces(changes.limit(10), str(tmp_path / "changes"), 1, "updated_at")
    price_stream.start(stream, base, state, cp, order=ORDER).awaitTermination()
    assert price_stream.update_log(spark, state).count() == 3


def stream_of(spark, tmp_path, n):
    """Paths of a price stream and what starts it on `n` files of changes."""
    base, state, cp = (str(tmp_path / name) for name in ("base", "state", "cp"))
    tables.merge_target(spark, SF).write.parquet(base)
    stream = pieces(tables.price_changes(spark, SF), str(tmp_path / "changes"), n, "updated_at")
    return base, state, lambda **options: price_stream.start(stream, base, state, cp, order=ORDER, **options)


def expected_table(spark, rows):
    return rows(merge.patch_rows(tables.merge_target(spark, SF), tables.price_changes(spark, SF), order=ORDER))


def test_price_stream_breaks_off_and_runs_again(spark, tmp_path, rows):
    base, state, start = stream_of(spark, tmp_path, 3)

    def break_off(batch_id):
        if batch_id == 1:
            raise RuntimeError("broken off")

    with pytest.raises(StreamingQueryException, match="broken off"):
        price_stream.finish(start(before_commit=break_off))
    # what the second batch wrote is there, but nobody reads it
    assert spark.read.parquet(f"{state}/log").count() == 2
    assert price_stream.update_log(spark, state).count() == 1
    assert price_stream.finish(start())
    assert sorted(r.iteration for r in price_stream.update_log(spark, state).collect()) == [1, 2, 3]
    assert rows(price_stream.current_table(spark, base, state, order=ORDER)) == expected_table(spark, rows)
    total = price_stream.update_log(spark, state).agg(F.sum("total_instruments")).first()[0]
    assert total == tables.price_changes(spark, SF).count()


def test_price_stream_stops_between_batches_and_is_compacted(spark, tmp_path, rows):
    base, state, start = stream_of(spark, tmp_path, 5)
    asked = []

    def stop(batch_id):
        if batch_id == 1:
            price_stream.ask_to_stop(spark, state)
            asked.append(batch_id)

    assert not price_stream.finish(start(before_commit=stop))
    assert asked == [1] and price_stream.update_log(spark, state).count() == 2
    before = rows(price_stream.current_table(spark, base, state, order=ORDER))
    price_stream.compact(spark, base, state, str(tmp_path / "base2"), order=ORDER)
    assert rows(price_stream.current_table(spark, base, state, order=ORDER)) == before
    assert spark.read.parquet(f"{state}/applied").count() == 0
    assert price_stream.finish(start())
    assert price_stream.update_log(spark, state).count() == 5
    assert rows(price_stream.current_table(spark, base, state, order=ORDER)) == expected_table(spark, rows)
    price_stream.compact(spark, base, state, str(tmp_path / "base3"), order=ORDER)
    assert rows(spark.read.parquet(str(tmp_path / "base3"))) == expected_table(spark, rows)


def test_batches_of_a_price_stream_do_not_read_the_base(spark, tmp_path):
    base, state, start = stream_of(spark, tmp_path, 3)
    query = start()
    assert price_stream.finish(query)
    assert len(query.recentProgress) == 3
    plan = query._jsq.streamingQuery().lastExecution().executedPlan()
    assert "TransformWithState" in plan.toString()
    # the first batch has read the base as the state's first content; the last one's plan names it, but no row was read
    leaves = plan.collectLeaves()
    read = {base in leaves.apply(i).toString(): leaves.apply(i).metrics().apply("numOutputRows").value() for i in range(leaves.size())}
    assert read[True] == 0 < read[False]


def test_late_and_odd_changes_of_a_price_stream(spark, tmp_path):
    base, state, cp = (str(tmp_path / name) for name in ("base", "state", "cp"))
    schema = "isin string, price double, updated_at timestamp, update_iteration long"
    spark.createDataFrame([("A", 1.0, None, None), ("B", 2.0, None, None)], schema).write.parquet(base)
    batches = [
        [("A", 5.0, "2024-01-02 00:00:00.123456", 2), ("A", 4.0, "2024-01-02 00:00:00.123456", 1), ("X", 9.0, "2024-01-01", 1)],
        [("A", 3.0, "2024-01-01 00:00:00", 9), ("B", None, "2024-01-03 00:00:00", 1), (None, 1.0, "2024-01-03", 1)],
        [("A", 7.0, None, 3), ("B", 8.0, "2024-01-03 00:00:00", 2)],
    ]
    for k, batch in enumerate(batches):
        rows = spark.createDataFrame(batch, schema.replace("timestamp", "string"))
        rows = rows.withColumn("updated_at", F.col("updated_at").cast("timestamp"))
        rows.coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        stream = spark.readStream.schema(schema).parquet(str(tmp_path / "in"))
        assert price_stream.finish(price_stream.start(stream, base, state, cp))
    got = {r.isin: (r.price, str(r.updated_at), r.update_iteration) for r in price_stream.current_table(spark, base, state).collect()}
    assert got == {"A": (5.0, "2024-01-02 00:00:00.123456", 2), "B": (8.0, "2024-01-03 00:00:00", 2)}
    log = price_stream.update_log(spark, state).orderBy("iteration").collect()
    assert [(r.total_instruments, r.success_count, r.error_count) for r in log] == [(3, 2, 1), (2, 2, 0), (2, 2, 0)]
    assert [r.isin for r in price_stream.rejected(spark, state).collect()] == ["X"]


def test_search_stream(spark, tmp_path):
    items = str(tmp_path / "items")
    spark.createDataFrame(
        [(f"K{i}", "Index Fund " + "x" * 60, float(i)) for i in range(20)] + [("K99", "Bond", 3.5)],
        "isin string, long_name string, price double",
    ).write.parquet(items)
    queries = spark.createDataFrame(
        [
            (1, "a", "price_range", 3.0, 5.0, None),
            (2, "b", "text_search", None, None, "bond"),
            (3, "c", "fuzzy", None, None, "bond"),
            (4, "d", "combined", 100.0, 200.0, "fund"),
        ],
        "query_id long, search_type string, query_type string, min_price double, max_price double, terms string",
    )
    stream = pieces(queries, str(tmp_path / "queries"), 2, "query_id")
    search_stream.start(stream, items, str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()
    log = search_stream.search_log(spark, str(tmp_path / "out"))
    assert [f.name for f in log.schema] == SEARCH_METRICS.fieldNames()
    rows = {r.search_id: r for r in log.collect()}
    assert {k: r.total_hits for k, r in rows.items()} == {1: 4, 2: 1, 3: 0, 4: 0}
    assert (rows[3].success, rows[3].error) == (False, "Unknown query type: fuzzy")
    assert all(rows[k].success and rows[k].error is None for k in (1, 2, 4))
    assert [(s.isin, s.price) for s in rows[1].sample_data] == [("K3", 3.0), ("K99", 3.5), ("K4", 4.0)]
    assert rows[1].sample_data[0].long_name == ("Index Fund " + "x" * 60)[:50] + "..."
    assert rows[1].price_range_width == 2.0 and rows[1].duration_ms > 0


def test_summary_stream_follows_the_log(spark, tmp_path, rows):
    searches = tables.search_metrics(spark, SF).where("success")
    out, cp, log = (str(tmp_path / n) for n in ("out", "cp", "log"))

    def plain(df):
        return rows(df.select("query_type", F.round("mean", 6), F.round("median", 6), "count"))

    stream = pieces(searches.where("search_id % 2 = 0"), log, 1, "search_id")
    log_stream.start_summary(stream, out, cp).awaitTermination()
    half = search_report.duration_by(searches.where("search_id % 2 = 0"), "query_type")
    assert plain(log_stream.latest_summary(spark, out)) == plain(half)
    stream = pieces(searches.where("search_id % 2 = 1"), log, 2, "search_id")
    log_stream.start_summary(stream, out, cp).awaitTermination()
    assert plain(log_stream.latest_summary(spark, out)) == plain(search_report.duration_by(searches, "query_type"))


def test_approximate_summary_of_a_stream(spark, tmp_path):
    searches = tables.search_metrics(spark, SF).where("success")
    stream = pieces(searches, str(tmp_path / "log"), 2, "search_id")
    summary = search_report.approximate_summary(stream, ["query_type"], "duration_ms")
    out = str(tmp_path / "out")
    log_stream.start_totals(summary, out, str(tmp_path / "cp")).awaitTermination()
    got = {r.query_type: r for r in log_stream.latest_summary(spark, out).collect()}
    exact = {r.query_type: r for r in search_report.duration_by(searches, "query_type").collect()}
    assert got.keys() == exact.keys()
    for kind, row in exact.items():
        assert got[kind]["count"] == row["count"]
        assert abs(got[kind].median - row.median) < 2


def test_sketches_of_a_stream_keep_their_size_and_their_error(spark, tmp_path):
    sketch = F.kll_sketch_agg_double("v", search_report.SKETCH_SIZE)
    sizes = [
        spark.range(n, numPartitions=4).select(F.pmod(F.xxhash64("id"), F.lit(10**9)).cast("double").alias("v")).agg(F.length(sketch)).first()[0]
        for n in (100_000, 2_000_000)
    ]
    # at most some three values of 8 bytes for each unit of its size, however many rows there are
    assert max(sizes) < 8 * 4 * search_report.SKETCH_SIZE

    rows = spark.range(200_000).select((F.col("id") % 2).alias("g"), F.pow(F.col("id") / 1000, F.lit(3.0)).alias("v"))
    rows = rows.withColumn("v", F.when(F.col("v") % 7 < 0.001, float("nan")).otherwise(F.col("v")))
    stream = pieces(rows, str(tmp_path / "log"), 3, "v")
    wanted = {"low": 0.1, "median": 0.5, "high": 0.99}
    summary = search_report.sketch_summary(stream, ["g"], "v", wanted)
    out = str(tmp_path / "out")
    query = log_stream.start_totals(summary, out, str(tmp_path / "cp"))
    query.awaitTermination()
    assert query.lastProgress["stateOperators"][0]["numRowsTotal"] == 2
    for row in log_stream.latest_summary(spark, out).collect():
        values = sorted(r.v for r in rows.where((F.col("g") == row.g) & ~F.isnan("v")).collect())
        assert row["count"] == len(values) and row["max"] == values[-1]
        for name, p in wanted.items():
            place = bisect.bisect_left(values, row[name]) / len(values)
            assert abs(place - p) <= search_report.RANK_ERROR + 1 / len(values)


def test_summaries_leave_out_what_is_no_number(spark, tmp_path):
    rows = spark.createDataFrame([("a", 2.0), ("a", float("nan")), ("a", 4.0), ("b", float("nan"))], "query_type string, duration_ms double")
    stream = pieces(rows, str(tmp_path / "log"), 2, "duration_ms")
    out = str(tmp_path / "out")
    log_stream.start_summary(stream, out, str(tmp_path / "cp")).awaitTermination()
    row = log_stream.latest_summary(spark, out).where("query_type = 'a'").first()
    assert (row["mean"], row["max"], row["count"], row["median"]) == (3.0, 4.0, 2, 3.0)
    row = search_report.approximate_summary(rows.where("query_type = 'a'"), ["query_type"], "duration_ms").first()
    assert (row["mean"], row["max"], row["count"]) == (3.0, 4.0, 2)
    found = {r.query_type: (r["count"], r.median) for r in search_report.sketch_summary(rows, ["query_type"], "duration_ms").collect()}
    assert found["b"] == (0, None) and found["a"][0] == 2


class OneValue:
    """A value state outside a stream."""

    value = None

    def get(self):
        return self.value

    def update(self, value):
        self.value = value


def test_changes_come_packed_by_bucket_and_the_latest_of_each_key_is_kept():
    chance = random.Random(3)
    rows = [
        {"bucket": k % 3, "key": None if k % 50 == 7 else f"{k % 3}-{chance.randrange(9)}", "o0": chance.randrange(40), "o1": k, "payload": f"p{k}"}
        for k in range(2000)
    ]
    batches = pa.Table.from_pylist(rows).to_batches(max_chunksize=300)
    packed = [b.to_pandas() for b in keyed_state.packed_by_bucket(["key", "o0", "o1", "payload"])(iter(batches))]
    # a row for each bucket, not for each change
    assert [list(p["bucket"]) for p in packed] == [[0, 1, 2]]
    state = keyed_state.LatestChanges(2)
    state.kept = OneValue()
    state.handleInitialState((1,), pd.DataFrame({"key": [f"1-{i}" for i in range(8)]}), None)
    # what has no key and what the base does not have is not kept; a second, older batch changes nothing
    mine = [r for r in rows if r["bucket"] == 1 and r["key"]]
    latest = {r["key"]: r for r in sorted(mine, key=lambda r: (r["o0"], r["o1"]))}
    found = next(state.handleInputRows((1,), iter([packed[0].iloc[1:2]]), None)).set_index("key")
    assert set(found.index) == set(latest) and not found["late"].any()
    for key, row in found.iterrows():
        assert (row.known, row.payload) == (key != "1-8", latest[key]["payload"])
        assert row.changes == sum(r["key"] == key for r in mine)
    again = next(state.handleInputRows((1,), iter([pd.DataFrame({"key": [["1-1", "1-8", None]], "o0": [[0, 0, 0]], "o1": [[-1, 0, 0]], "payload": [["a", "b", "c"]]})]), None))
    assert [tuple(r) for r in again.itertuples(index=False)] == [("1-1", True, None, 1, 1), ("1-8", False, "b", 1, 0)]
