"""A stream of search requests answered from a snapshot, one log row each.

The snapshot's price index is made once, before the stream starts; a micro-batch looks its
searches up and reads the texts of its hits alone.
"""

import time

from pyspark.sql import functions as F

from pricetide.functions.text import preview
from pricetide.operators.batch_search import batch_search, valid_type
from pricetide.operators.price_index import postings, read_index, write_index
from pricetide.sources.writers import search_log_rows
from pricetide.workspace import exists

SAMPLE_SIZE = 3


def answer(items, queries, key="isin", price="price", text="long_name", size=100, index=None):
    """Searches with their hit counts and first hits; a wrong query type is a failed search."""
    good = valid_type(F.coalesce("query_type", F.lit("")))
    items = items.withColumn("preview", preview(F.col(text)))
    totals, hits = batch_search(
        items, queries.where(good), key, price, text, size, carry=["preview"], check_types=False, index=index
    )
    samples = hits.where(F.col("rank") <= SAMPLE_SIZE).groupBy("query_id").agg(
        F.transform(
            F.array_sort(
                F.collect_list(
                    F.struct(
                        "rank",
                        F.col(key).cast("string").alias("isin"),
                        "price",
                        F.col("preview").alias("long_name"),
                    )
                )
            ),
            lambda r: F.struct(r["isin"].alias("isin"), r["price"].alias("price"), r["long_name"].alias("long_name")),
        ).alias("sample_data")
    )
    answered = queries.where(good).join(totals, "query_id").join(samples, "query_id", "left")
    answered = answered.withColumns(
        {"success": F.lit(True), "error": F.lit(None).cast("string")}
    )
    wrong = queries.where(~good).withColumns(
        {
            "success": F.lit(False),
            "total_hits": F.lit(0).cast("long"),
            "returned_hits": F.lit(0).cast("long"),
            "error": F.concat(F.lit("Unknown query type: "), F.coalesce("query_type", F.lit("NULL"))),
        }
    )
    return answered.unionByName(wrong, allowMissingColumns=True)


def log_rows(answers, seconds):
    """Search-metrics rows of answered searches that took `seconds` each."""
    return search_log_rows(
        answers.withColumns(
            {
                "timestamp": F.current_timestamp(),
                "search_id": F.col("query_id"),
                "text_query": F.col("terms"),
                "duration": F.lit(float(seconds)),
            }
        )
    )


def answer_batch(batch, batch_id, items_path, out, index_path=None, **table):
    """Answer one micro-batch and write its log rows. Its searches share the time taken."""
    spark = batch.sparkSession
    started = time.monotonic()
    answers = f"{out}/answers"
    index = read_index(spark, index_path, table.get("key", "isin")) if index_path else None
    answer(spark.read.parquet(items_path), batch, index=index, **table).write.mode("overwrite").parquet(answers)
    done = spark.read.parquet(answers)
    each = (time.monotonic() - started) / max(done.count(), 1)
    log_rows(done, each).write.mode("overwrite").parquet(f"{out}/log/batch={batch_id}")


def index_items(spark, items_path, path, key="isin", price="price", text="long_name"):
    """Write the price index of a snapshot, unless it is there; returns its path."""
    if not exists(spark, f"{path}/heads/_SUCCESS"):
        # what a run that was cut short has left is written over
        write_index(postings(spark.read.parquet(items_path), key, price, text), path, key, mode="overwrite")
    return path


def start(queries, items_path, out, checkpoint, trigger=None, index_path=None, **table):
    """Run the stream. Without the path of a price index one is made in `out`, once."""
    columns = {c: table[c] for c in ("key", "price", "text") if c in table}
    index_path = index_path or index_items(queries.sparkSession, items_path, f"{out}/index", **columns)
    return (
        queries.writeStream.foreachBatch(
            lambda batch, batch_id: answer_batch(batch, batch_id, items_path, out, index_path, **table)
        )
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def search_log(spark, out):
    return spark.read.parquet(f"{out}/log").drop("batch")
