"""A corpus in five stages: toxicity, line dedup, near duplicates, decontamination, encoding.

Each stage takes (spark, docs, sf_dir) and works on what the one before kept. All but the
last return the columns of documents, whatever their names, for the rows that they keep.
Rows are told apart even where their ids are missing or repeat. Texts are read whole; no
rows give no rows.
"""

from pyspark.sql import functions as F

from pricetide.llm.bpe import encoded
from pricetide.llm.decontamination import contained_items
from pricetide.llm.line_dedup import without_repeated_runs
from pricetide.llm.near_duplicates import near_duplicates
from pricetide.llm.queries import table, vocabulary_path
from pricetide.llm.toxicity import without_toxic
from pricetide.operators.skew import broadcast_if_small
from pricetide.workspace import stage


#: Ids sent to all executors at most, 8 bytes each; more meet the documents by shuffling.
BROADCAST_IDS = 1_000_000


def _identified(docs):
    """`docs` and the name of a column that tells its rows apart.

    That is doc_id where it does. Else the rows are written out once in the order of id and
    text with a number for each, so that rows which change places in a repeated task keep theirs.
    """
    if docs.groupBy("doc_id").count().where("doc_id is null or count > 1").isEmpty():
        return docs, "doc_id"
    name = "row"
    while name in docs.columns:
        name += "_"
    ordered = docs.orderBy(F.asc_nulls_last("doc_id"), "text")
    return stage(ordered.withColumn(name, F.monotonically_increasing_id()), "numbered"), name


def _without(docs, key, ids):
    """`docs` without the rows of these keys, which are given as doc_id."""
    ids = broadcast_if_small(stage(ids.select(F.col("doc_id").alias(key)).distinct(), "ids"), BROADCAST_IDS)
    return docs.join(ids, key, "left_anti")


def toxicity(spark, docs, sf_dir):
    """Rows that score 0.5 or more go, each by its own text.

    Null and empty texts stay unless the classifier's bias alone is toxic; equal texts go or
    stay together. Without labels all rows stay.
    """
    return without_toxic(docs, table(spark, sf_dir, "labels"))


def line_dedup(spark, docs, sf_dir):
    """Later copies of runs of lines go; a document of which nothing but white space is left goes too.

    Null, empty and blank texts stay as they are, as nothing is cut from them. Rows of one id and
    text are cut alike; null ids come last.
    """
    columns = docs.columns
    # columns that the operator's own take the place of are kept aside
    aside = {c: f"{c} given {len(columns)}" for c in ("lines_deleted", "deleted") if c in columns}
    cut = without_repeated_runs(docs.withColumnsRenamed(aside))
    lost = F.col("lines_deleted") > 0
    cut = cut.where(~lost | (F.trim("text", F.lit(" \t\n\r")) != ""))
    if "n_chars" in columns:
        signs = F.length("text").cast(docs.schema["n_chars"].dataType)
        cut = cut.withColumn("n_chars", F.when(lost, signs).otherwise(F.col("n_chars")))
    return cut.select(*[F.col(aside.get(c, c)).alias(c) for c in columns])


def near_dedup(spark, docs, sf_dir):
    """One row of each group of near duplicates (five words, 0.8) stays, the one with the smallest id.

    Rows without words (null, empty, blank) are in no group and stay. Rows that repeat an id are
    compared like others; of those and of rows without an id the first by id and text stays.
    """
    rows, key = _identified(docs)
    found = near_duplicates(rows, key=key, size=5, percent=80).where("not kept")
    return _without(rows, key, found).select(*docs.columns)


def decontamination(spark, docs, sf_dir):
    """Rows that contain 80 % of a benchmark item go, those without an id too.

    Rows without words contain nothing and stay, as do clean rows that share an id with one that goes.
    """
    rows, key = _identified(docs)
    found = contained_items(rows, table(spark, sf_dir, "benchmark"), key=key, size=5, percent=80)
    return _without(rows, key, found).select(*docs.columns)


def encoding(spark, docs, sf_dir):
    """Tokens of each row that is left, as number and digests; null and empty texts have none."""
    return encoded(docs, vocabulary_path(), digests=True)


STAGES = [
    ("toxicity", toxicity),
    ("line dedup", line_dedup),
    ("near duplicates", near_dedup),
    ("decontamination", decontamination),
    ("encoding", encoding),
]

#: SQL expresses neither the learned scores nor the merges; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark, sf_dir):
    """All stages over documents, each but the last written to the shared folder."""
    docs = table(spark, sf_dir, "documents")
    for number, (name, function) in enumerate(STAGES):
        docs = function(spark, docs, sf_dir)
        if number < len(STAGES) - 1:
            docs = stage(docs, name.replace(" ", "-"))
    return docs
