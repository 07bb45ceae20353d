"""A stream of price changes applied to a keyed table.

The keys of the base and the order of the latest change of each are state of the stream
(`keyed_state`), so a micro-batch reads its own changes and their state, never the base. It
writes one row per key that it changes; the table is the base with the latest of all written
changes. So a batch costs what it brings, not what the table holds.

A batch counts when it stands in the ledger, which is written last: what a batch left that
broke off is not read, and is written over when the batch runs again from the checkpoint.
`compact` makes a new base of all batches so far, notes it and removes the changes it has
taken in.
"""

import time

from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from pricetide.operators.merge import CHANGE_ORDER, PATCHED, latest_changes, patch_rows
from pricetide.sources.writers import update_log_rows
from pricetide.streaming.keyed_state import KEYS_PER_BUCKET, ROCKS_DB, latest_by_key, unpacked
from pricetide.workspace import exists

STOPPED = "the stream was asked to stop between two batches"


def _folder(state, kind, batch_id):
    return f"{state}/{kind}/batch={batch_id}"


def _delete(spark, path):
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)


def _write_batch(latest, batch_id, state, key, columns, started):
    """Write a batch's `latest` changes (key, known, columns, changes): applied, rejected, log row, ledger row.

    Changes of a known key whose columns are all NULL are older than its latest and are not written.
    """
    spark = latest.sparkSession
    kept = latest.select(key, *columns, "changes", "known", "newer")
    kept.where("known and newer").drop("known", "newer").write.mode("overwrite").parquet(_folder(state, "applied", batch_id))
    kept.where("not known").drop("known", "newer").write.mode("overwrite").parquet(_folder(state, "rejected", batch_id))
    done, all_changes = F.sum(F.when(F.col("known"), F.col("changes"))), F.sum("changes")
    row = latest.agg(
        F.coalesce(all_changes, F.lit(0)).alias("total_instruments"), F.coalesce(done, F.lit(0)).alias("success_count")
    ).select(
        F.current_timestamp().alias("timestamp"),
        F.lit(batch_id + 1).alias("iteration"),
        "total_instruments",
        "success_count",
        (F.col("total_instruments") - F.col("success_count")).alias("error_count"),
        F.lit(time.monotonic() - started).alias("duration"),
    )
    update_log_rows(row).write.mode("overwrite").parquet(_folder(state, "log", batch_id))


def _commit(spark, batch_id, state):
    spark.range(1).select(F.current_timestamp().alias("at")).write.mode("overwrite").parquet(_folder(state, "ledger", batch_id))


def apply_batch(batch, batch_id, base_path, state, key="isin", order=CHANGE_ORDER):
    """Apply changes by hand, outside a stream, as a batch of their own. Reads the key column of the base."""
    spark = batch.sparkSession
    started = time.monotonic()
    columns = list(dict.fromkeys([*PATCHED, *order]))
    incoming = f"{state}/incoming"
    latest_changes(batch, key, order, columns).write.mode("overwrite").parquet(incoming)
    latest = spark.read.parquet(incoming)
    # Right, so that a small batch meets the key column of the base where it lies.
    keys = spark.read.parquet(base_path).select(key, F.lit(True).alias("_known")).distinct()
    latest = keys.join(latest, key, "right").withColumns(
        {"known": F.coalesce("_known", F.lit(False)), "newer": F.lit(True)}
    )
    _write_batch(latest, batch_id, state, key, columns, started)
    _commit(spark, batch_id, state)


def _buckets(spark, base_path, state):
    """State buckets of the stream: settled by the size of the base when it first starts."""
    layout = f"{state}/layout"
    if not exists(spark, f"{layout}/_SUCCESS"):
        rows = spark.read.parquet(base_path).agg(F.greatest(F.ceil(F.count("*") / KEYS_PER_BUCKET), F.lit(1)).alias("buckets"))
        rows.write.mode("overwrite").parquet(layout)
    return spark.read.parquet(layout).first().buckets


def ask_to_stop(spark, state):
    """Leave the marker that ends the stream of `state` once its running batch is done."""
    spark.range(1).write.mode("overwrite").parquet(f"{state}/stop")


def start(changes, base_path, state, checkpoint, key="isin", order=CHANGE_ORDER, before_commit=None, **trigger):
    """Run the stream; without a trigger it takes what is there and stops.

    A marker of `ask_to_stop` left before does not count. `before_commit` is called with the
    id of each batch when all but its ledger row is written.
    """
    spark = changes.sparkSession
    columns = list(dict.fromkeys([*PATCHED, *order]))
    schema = changes.schema
    base = spark.read.parquet(base_path).select(key)
    latest = latest_by_key(changes, base, key, order, columns, _buckets(spark, base_path, state))
    _delete(spark, f"{state}/stop")

    def run(batch, batch_id):
        spark = batch.sparkSession
        if exists(spark, f"{state}/stop"):
            raise RuntimeError(STOPPED)
        started = time.monotonic()
        # The state is read once: the batch is written first, then its parts are read from there.
        incoming = f"{state}/incoming"
        batch.write.mode("overwrite").parquet(incoming)
        rows = spark.read.parquet(incoming).withColumn("newer", F.col("payload").isNotNull()).withColumnRenamed("key", key)
        _write_batch(unpacked(rows, schema, columns), batch_id, state, key, columns, started)
        if before_commit is not None:
            before_commit(batch_id)
        _commit(spark, batch_id, state)

    # the query keeps the settings it is started with
    setting = "spark.sql.streaming.stateStore.providerClass"
    usual = spark.conf.get(setting)
    spark.conf.set(setting, ROCKS_DB)
    try:
        return (
            latest.writeStream.outputMode("update")
            .foreachBatch(run)
            .option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"availableNow": True}))
            .start()
        )
    finally:
        spark.conf.set(setting, usual)


def finish(query):
    """Wait for the end of a stream; True if it took all there was, False if it was asked to stop."""
    try:
        query.awaitTermination()
    except StreamingQueryException as error:
        if STOPPED not in str(error):
            raise
        return False
    return True


def committed(spark, state, kind):
    """Rows of one kind of the batches in the ledger."""
    ledger = spark.read.parquet(f"{state}/ledger").select("batch").distinct()
    # one row for each batch not yet compacted
    return spark.read.parquet(f"{state}/{kind}").join(F.broadcast(ledger), "batch", "left_semi")


def _base(spark, base_path, state):
    """The base to read: the one last compacted, or else the given one; and the batches it has taken in."""
    if not exists(spark, f"{state}/bases"):
        return base_path, -1
    last = spark.read.parquet(f"{state}/bases").orderBy(F.desc("upto")).first()
    return last.path, last.upto


def current_table(spark, base_path, state, key="isin", order=CHANGE_ORDER):
    """The base with all applied changes of batches in the ledger."""
    path, upto = _base(spark, base_path, state)
    changes = committed(spark, state, "applied").where(F.col("batch") > upto)
    return patch_rows(spark.read.parquet(path), changes, key, order)


def write_base(spark, base_path, state, new_base, key="isin", order=CHANGE_ORDER):
    """Write the current table as a new base.

    Applying a change again alters nothing, so the old changes may stay until they are
    deleted, and the stream can go on with either base meanwhile.
    """
    current_table(spark, base_path, state, key, order).write.parquet(new_base)


def compact(spark, base_path, state, new_base, key="isin", order=CHANGE_ORDER):
    """Make `new_base` the base of all batches so far and remove their applied changes.

    The base is written, then noted, then the folders go; cut short at any point, a reader
    still sees the same table, and compacting again finishes the work.
    """
    upto = spark.read.parquet(f"{state}/ledger").agg(F.max("batch")).first()[0]
    write_base(spark, base_path, state, new_base, key, order)
    note = spark.range(1).select(F.lit(new_base).alias("path"), F.lit(upto).cast("long").alias("upto"))
    note.coalesce(1).write.mode("append").parquet(f"{state}/bases")
    schema = spark.read.parquet(f"{state}/applied").drop("batch").schema
    taken = spark.read.parquet(f"{state}/ledger").where(F.col("batch") <= upto).select("batch").distinct()
    for row in taken.collect():
        spark.createDataFrame([], schema).write.mode("overwrite").parquet(_folder(state, "applied", row.batch))


def update_log(spark, state):
    return committed(spark, state, "log").drop("batch")


def rejected(spark, state):
    return committed(spark, state, "rejected").drop("batch")
