"""The queries of this subpackage and their SQL twins."""

import os
import secrets

from pyspark.sql import functions as F

from pricetide.llm.alignment import aligned
from pricetide.llm.bpe import encoded
from pricetide.llm.decontamination import contained_items
from pricetide.llm.exact_dedup import exact_duplicates
from pricetide.llm.line_dedup import without_repeated_runs
from pricetide.llm.near_duplicates import near_duplicates
from pricetide.llm.periodic_runs import periodic_runs
from pricetide.llm.pseudonyms import pseudonymised
from pricetide.llm.quality import quality_scores
from pricetide.llm.sharding import sharded
from pricetide.llm.toxicity import toxicity_scores
from pricetide.llm.warc import derivatives, responses
from pricetide.llm.wordpiece import piece_counts

QUERIES = {}
ORACLE_SQL = {}
#: The key of the pseudonyms. Without one in the environment each process draws its own, which nobody can undo later.
SECRET = os.environ.get("PRICETIDE_SECRET", secrets.token_hex()).encode()


def query(function):
    QUERIES[function.__name__] = function
    return function


def table(spark, folder, name):
    return spark.read.parquet(f"{folder}/{name}.parquet")


def vocabulary_path(name="byte_bpe_50k.json"):
    """Where a vocabulary of the installed public tokenizers is, the byte-level one if none is named."""
    import public_tokenizers

    return public_tokenizers.path(name)


@query
def op1_exact_dedup(spark, folder):
    return exact_duplicates(table(spark, folder, "documents"))


ORACLE_SQL["op1_exact_dedup"] = r"""
WITH d AS (
  SELECT doc_id, length(coalesce(text, '')) AS points,
    sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256 FROM documents)
SELECT doc_id, first_value(doc_id) OVER g AS keep_id, count(*) OVER (PARTITION BY text_sha256) AS group_size,
  row_number() OVER g = 1 AS kept, text_sha256
FROM d WINDOW g AS (PARTITION BY text_sha256 ORDER BY points DESC, doc_id)"""


@query
def op2_quality(spark, folder):
    return quality_scores(table(spark, folder, "documents"), table(spark, folder, "labels"))


@query
def op3_warc_derivatives(spark, folder):
    """Both records of every page; blocks as lengths and digests."""
    return derivatives(responses(table(spark, folder, "pages"))).select(
        "record_id",
        "record_type",
        "target_uri",
        "refers_to",
        "concurrent_to",
        "payload_digest",
        "block_digest",
        F.octet_length("block").alias("content_length"),
        F.sha2("block", 256).alias("block_sha256"),
    )


@query
def op4_pseudonyms(spark, folder):
    """Every document with its values replaced; `n_values` is 0 where there were none."""
    rows = pseudonymised(table(spark, folder, "documents"), SECRET)
    return rows.select(
        "doc_id",
        F.size("values").alias("n_values"),
        (F.size("values") > 0).alias("changed"),
        F.concat_ws(",", F.array_sort(F.array_distinct("values.kind"))).alias("kinds"),
        "text",
    )


@query
def op5_decontamination(spark, folder):
    return contained_items(table(spark, folder, "documents"), table(spark, folder, "benchmark"), size=5, percent=80)


def _shingles(source, key):
    """SQL for the distinct five-word shingles of a table's texts; shorter texts whole."""
    lower = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    words = rf"list_filter(regexp_split_to_array({lower}, '[\x20\x09-\x0D]+'), lambda x: x <> '')"
    return f"""SELECT DISTINCT {key}, unnest(list_transform(range(1, greatest(len(w) - 3, 2)),
      lambda i: array_to_string(list_slice(w, i, i + 4), ' '))) AS s
    FROM (SELECT {key}, {words} AS w FROM {source}) WHERE len(w) > 0"""


ORACLE_SQL["op5_decontamination"] = f"""
WITH d AS ({_shingles("documents", "doc_id")}), b AS ({_shingles("benchmark", "item_id")}),
n AS (SELECT item_id, count(*) AS n_item FROM b GROUP BY item_id),
p AS (SELECT doc_id, item_id, count(*) AS shared FROM d JOIN b USING (s) GROUP BY doc_id, item_id)
SELECT doc_id, item_id, shared, n_item, shared / n_item AS containment
FROM p JOIN n USING (item_id) WHERE 100 * shared >= 80 * n_item"""


@query
def op6_bpe(spark, folder):
    return encoded(table(spark, folder, "documents"), vocabulary_path(), digests=True)


@query
def op7_toxicity(spark, folder):
    return toxicity_scores(table(spark, folder, "documents"), table(spark, folder, "labels"))


@query
def op8_line_dedup(spark, folder):
    """What is left of every text: lines deleted, code points and SHA-256 of the rest."""
    rows = without_repeated_runs(table(spark, folder, "documents"))
    return rows.select(
        "doc_id",
        "lines_deleted",
        F.coalesce(F.length("text"), F.lit(0)).alias("chars_left"),
        F.sha2(F.coalesce("text", F.lit("")), 256).alias("text_sha256"),
    )


@query
def op9_near_duplicates(spark, folder):
    return near_duplicates(table(spark, folder, "documents"), size=4, percent=80)


@query
def op10_piece_counts(spark, folder):
    return piece_counts(table(spark, folder, "documents"), vocabulary_path())


@query
def op11_sharding(spark, folder):
    """The shard and slot of every document, sixteen shards of near equal bytes."""
    return sharded(table(spark, folder, "documents"))


@query
def op12_alignment(spark, folder):
    """How the tokens of a byte-level vocabulary and of a piece model fit in every document."""
    rows = aligned(table(spark, folder, "documents"), vocabulary_path(), vocabulary_path("piece_bpe_32k.model"), digests=True)
    return rows.withColumnRenamed("groups", "groups_sha256")


def with_periods(docs):
    """`docs` as doc_id and text, a tenth of them periodic from some word on.

    h is the CRC-32 of the id. Where h ends in 0 and there are n > 0 words, word a + i for
    a = h / 10 % n becomes word a + i % p; p = 1 + (n - a) / (3 + h / 10 % 8), rounded down.
    """
    hashed = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    g = F.floor(hashed / 10)

    def periodic(words):
        n = F.size(words).cast("long")
        a = F.pmod(g, n)
        p = 1 + F.floor((n - a) / (3 + g % 8))
        return F.concat_ws(" ", F.transform(words, lambda w, i: F.when(i < a, w).otherwise(F.get(words, (a + (i - a) % p).cast("int")))))

    # in an array of one, as its lambda keeps the words from being split anew for each of them
    split = F.array(F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != ""))
    changed = F.get(F.transform(split, lambda words: F.when(F.size(words) > 0, periodic(words)).otherwise("")), 0)
    return docs.select("doc_id", F.when(hashed % 10 == 0, changed).otherwise(F.col("text")).alias("text"))


@query
def op13_periodic_runs(spark, folder):
    """The runs of every document, of which a tenth are made periodic first."""
    return periodic_runs(with_periods(table(spark, folder, "documents")), digests=True)
