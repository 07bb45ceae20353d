"""Test items inside documents: MinHash containment search, then exact containment.

An item's sketch is the `SKETCH` smallest of its hashed shingles under a function of its
size class (classes double), a sample without repeats. A document is a candidate if it has
a shingle of the sketch and its own size class can hold `percent` of the item. Unlike a
comparison of two sketches this does not grow weaker with the document's length: an item
contained to 80 % escapes a sketch of 16 with probability under 0.2^16, however long the
text. Candidates are confirmed on whole sets.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from pricetide.llm.scratch import Scratch, send_if_small
from pricetide.llm.shipping import map_batches
from pricetide.llm.words import distinct, mix, pieces, shingles, word_hashes

SKETCH = 16
#: Sketch values sent along with the search at most, 8 bytes each; more are joined by shuffling.
SKETCH_VALUES = 1_000_000
BROADCAST_IDS = 1_000_000
ROWS_COMPARED = 200
_U = np.uint64


def text_sets(column, size):
    """The sorted distinct shingles of each text."""
    for _, data, offsets in pieces(column):
        values, firsts = distinct(*shingles(*word_hashes(data, offsets), size))
        yield from (values[a:b] for a, b in zip(firsts[:-1], firsts[1:]))


def size_class(n):
    """Size classes double: 1, 2-3, 4-7, ..."""
    return np.floor(np.log2(np.maximum(n, 1))).astype(np.int32)


def item_sketches(size):
    def run(batches):
        for batch in batches:
            ids, counts, values = [], [], []
            for item, own in zip(batch.column(0).to_pylist(), text_sets(batch.column(1), size)):
                kind = _U(size_class(len(own)))
                with np.errstate(over="ignore"):
                    order = np.argsort(mix(own ^ mix(kind + _U(1))), kind="stable")
                picked = own[order[:SKETCH]]
                ids += [item] * len(picked)
                counts += [len(own)] * len(picked)
                values.append(picked)
            values = np.concatenate([np.zeros(0, np.uint64), *values])
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(counts, pa.int64()), pa.array(values.view(np.int64))],
                names=["item_id", "n_item", "value"],
            )

    return run


def search_batches(size, wanted):
    """(doc_id, n, value) of the document shingles that are `wanted`, or of all with None."""

    def run(batches):
        for batch in batches:
            ids = batch.column(0)
            for row, data, offsets in pieces(batch.column(1)):
                values, firsts = shingles(*word_hashes(data, offsets), size)
                of_text = np.repeat(np.arange(len(offsets) - 1), np.diff(firsts))
                if wanted is not None:
                    at = np.minimum(np.searchsorted(wanted, values), max(len(wanted) - 1, 0))
                    hit = wanted[at] == values if len(wanted) else np.zeros(len(values), bool)
                    values, of_text = values[hit], of_text[hit]
                counts = np.diff(firsts)  # repeats included: an upper bound of the size of the set
                yield pa.RecordBatch.from_arrays(
                    [ids.take(pa.array(row + of_text)), pa.array(counts[of_text].astype(np.int64)), pa.array(values.view(np.int64))],
                    names=["doc_id", "n", "value"],
                )

    return run


def contain_batches(size, percent):
    def run(batches):
        last, last_set = None, None
        for batch in batches:
            kept, shared, sizes = [], [], []
            for start in range(0, batch.num_rows, ROWS_COMPARED):
                part = batch.slice(start, ROWS_COMPARED)
                items = text_sets(part.column(3), size)
                for row, item in enumerate(items):
                    text = part.column(2)[row]
                    if last is None or text != last:  # rows of one document mostly stand together
                        last, last_set = text, next(text_sets(pa.array([text.as_py()], pa.string()), size))
                    both = len(np.intersect1d(item, last_set, assume_unique=True))
                    kept.append(len(item) > 0 and 100 * both >= percent * len(item))
                    shared.append(both)
                    sizes.append(len(item))
            out = pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(shared, pa.int64()), pa.array(sizes, pa.int64())],
                names=["doc_id", "item_id", "shared", "n_item"],
            )
            yield out.filter(pa.array(kept, pa.bool_()))

    return run


def contained_items(docs, items, size=5, percent=80, text="text", key="doc_id", item_text="text", item_key="item_id"):
    """Items of which a document has at least `percent` of the distinct `size`-word shingles.

    Words are lower-cased (A-Z) runs between white space. One row for each such pair:
    doc_id, item_id, shared, n_item, containment (shared / n_item).

    An item of fewer than `size` words has one shingle, its whole sequence, which only a
    document of the same words has. Null, empty and white texts have no shingles and are in
    no pair, nor are rows with a null id. Rows that repeat an id count as one where any of
    them is in a pair; the best containment stands. Without rows on a side there are no
    pairs.
    """
    scratch = Scratch(docs.sparkSession)
    tests = items.select(F.col(item_key).cast("long").alias("item_id"), F.col(item_text).cast("string").alias("item_text"))
    tests = tests.where("item_id is not null and item_text is not null")
    texts = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    texts = texts.where("doc_id is not null and text is not null")
    sketch = scratch.write(map_batches(tests, item_sketches(size), "item_id long, n_item long, value long"), "sketch")
    wanted = None
    if sketch.count() <= SKETCH_VALUES:
        rows = sketch.select("value").distinct().toPandas()
        wanted = np.sort(rows["value"].to_numpy(np.int64).view(np.uint64))
    found = map_batches(texts, search_batches(size, wanted), "doc_id long, n long, value long")
    few = F.broadcast(sketch) if wanted is not None else sketch
    large_enough = F.lit(100) * F.col("n") >= F.lit(percent) * F.col("n_item")
    pairs = found.join(few, "value").where(large_enough).select("doc_id", "item_id").distinct()
    pairs = scratch.write(pairs, "pairs")
    ids = send_if_small(scratch.write(pairs.select("doc_id").distinct(), "ids"), BROADCAST_IDS)
    texts = texts.join(ids, "doc_id", "left_semi")
    rows = texts.join(pairs.join(tests, "item_id"), "doc_id").select("doc_id", "item_id", "text", "item_text")
    schema = "doc_id long, item_id long, shared long, n_item long"
    sure = scratch.write(map_batches(rows, contain_batches(size, percent), schema), "contained")
    scratch.clear(sure)
    best = sure.groupBy("doc_id", "item_id").agg(F.max("shared").alias("shared"), F.max("n_item").alias("n_item"))
    return best.withColumn("containment", F.col("shared") / F.col("n_item"))
