"""Near duplicates by MinHash with tensored banding.

A text's set of word shingles gets two collections of `ROWS_OF_TABLES` small hashes, each
of `SMALL` minima. Every small hash of the first with every one of the second makes the key
of one table, so 12 x 12 tables of six minima need 72 minima instead of 864. Two sets of
similarity s meet in a table with probability (1 - (1 - s^3)^12)^2: 0.9996 at 0.8.

A key is shared only if both its halves are, so halves that no second text has are
dropped before keys are formed; most texts end there.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from pricetide.llm.components import components
from pricetide.llm.scratch import Scratch, send_if_small
from pricetide.llm.shipping import map_batches
from pricetide.llm.words import distinct, mix, pieces, shingles, sums, word_hashes

SMALL = 3
ROWS_OF_TABLES = 12
MINIMA = 2 * SMALL * ROWS_OF_TABLES
#: Ids sent to all executors at most, 8 bytes each; more are joined by shuffling.
BROADCAST_IDS = 1_000_000
#: Pairs of texts taken up at once in a task.
ROWS_COMPARED = 200
#: Members of a component that one part of a join compares with others.
PART = 256
_U = np.uint64
_FACTORS = np.random.default_rng(9).integers(0, 1 << 63, MINIMA, dtype=np.uint64) * _U(2) + _U(1)
_SHIFTS = np.random.default_rng(10).integers(0, 1 << 64, MINIMA, dtype=np.uint64)
_SKETCH = "doc_id long, n_shingles long, set_1 long, set_2 long, halves array<long>"


def half_keys(values, firsts):
    """The small hashes of each text, one column for each; rows without values are 0."""
    rows = np.flatnonzero(np.diff(firsts))
    minima = np.zeros((len(rows), MINIMA), np.uint64)
    for i in range(MINIMA if len(rows) else 0):
        minima[:, i] = np.minimum.reduceat(values * _FACTORS[i] + _SHIFTS[i], firsts[:-1][rows])
    total = np.zeros((len(rows), MINIMA // SMALL), np.uint64)
    for k in range(SMALL):
        total = mix(total + minima[:, k::SMALL])
    total = mix(total + np.arange(MINIMA // SMALL, dtype=np.uint64))
    full = np.zeros((len(firsts) - 1, MINIMA // SMALL), np.uint64)
    full[rows] = total
    return full


def sketch_batches(size):
    def run(batches):
        for batch in batches:
            ids = batch.column(0)
            for row, data, offsets in pieces(batch.column(1)):
                with np.errstate(over="ignore"):
                    values, firsts = distinct(*shingles(*word_hashes(data, offsets), size))
                    halves = half_keys(values, firsts)
                    one, two = sums(mix(values), firsts), sums(mix(values ^ _SHIFTS[0]), firsts)
                counts = np.diff(firsts)
                offsets32 = np.concatenate([[0], np.cumsum(np.where(counts > 0, halves.shape[1], 0))])
                yield pa.RecordBatch.from_arrays(
                    [
                        ids.slice(row, len(counts)),
                        pa.array(counts.astype(np.int64)),
                        pa.array(one.view(np.int64)),
                        pa.array(two.view(np.int64)),
                        pa.ListArray.from_arrays(
                            pa.array(offsets32.astype(np.int32)), pa.array(halves[counts > 0].reshape(-1).view(np.int64))
                        ),
                    ],
                    names=["doc_id", "n_shingles", "set_1", "set_2", "halves"],
                )

    return run


def sketches(docs, size, text="text", key="doc_id"):
    """Size, 128-bit name and small hashes of each text's set of `size`-word shingles."""
    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return map_batches(rows, sketch_batches(size), _SKETCH)


def table_keys(sets, scratch):
    """(key, id, n): the table keys of `sets` (id, n, halves) with both halves shared."""
    halves = sets.select("id", "n", F.posexplode("halves").alias("place", "half"))
    shared = halves.groupBy("half").agg(F.count("*").alias("rows")).where("rows > 1").select("half")
    left = halves.join(send_if_small(scratch.write(shared, "halves"), BROADCAST_IDS), "half", "left_semi")
    first = F.col("place") < ROWS_OF_TABLES
    kept = left.groupBy("id", "n").agg(
        F.collect_list(F.when(first, F.col("half"))).alias("one"), F.collect_list(F.when(~first, F.col("half"))).alias("two")
    )
    pairs = kept.select("id", "n", F.explode("one").alias("one"), "two").select(
        "id", "n", "one", F.explode("two").alias("two")
    )
    return scratch.write(pairs.select(F.xxhash64("one", "two").alias("key"), "id", "n"), "keys")


def _near_enough(a, b, percent):
    return (F.lit(100) * F.least(a, b)) >= (F.lit(percent) * F.greatest(a, b))


def _centre_pairs(members, percent):
    """Each member with the member that a hash puts first in its key."""
    centre = members.groupBy("key").agg(F.min(F.struct(F.xxhash64("id").alias("h"), "id", "n")).alias("c"))
    pairs = members.join(centre, "key").where(
        (F.col("id") != F.col("c.id")) & _near_enough(F.col("n"), F.col("c.n"), percent)
    )
    return pairs.select(F.least("id", "c.id").alias("a"), F.greatest("id", "c.id").alias("b")).distinct()


def _unique_shingles(sets):
    """(id, unique): how many shingles of each id in `sets` (id, shingles) no other id there has.

    Each shingle becomes one row that knows one id that has it; no shingle's ids are gathered.
    """
    held = sets.select("id", F.explode("shingles").alias("shingle"))
    single = held.groupBy("shingle").agg(F.count("*").alias("rows"), F.min("id").alias("id")).where("rows = 1")
    return single.groupBy("id").agg(F.count("*").alias("unique"))


def _open_links(members, found, texts, size, percent, scratch):
    """Links (a, b) between components found so far that share a key.

    Members outside a key's largest component are compared with all members of that one,
    and with each other, so a group that has come together costs nothing. Rows are sent for
    members, not for pairs; pairs exist only inside joins over parts of `PART` members, and
    links alone leave them. Members that cannot reach the
    similarity are left out before: two sets share at most the shingles that each has in
    common with any other set here.
    """
    labels = found.select(F.col("node").alias("id"), "component")
    rows = members.join(labels, "id", "left").withColumn("component", F.coalesce("component", "id"))

    def several(rows):
        counts = rows.groupBy("key", "component").agg(F.count("*").alias("rows"), F.min("n").alias("n"))
        top = counts.groupBy("key").agg(
            F.max(F.struct("rows", "component")).alias("top"), F.count("*").alias("parts"), F.min("n").alias("least")
        )
        return top.where("parts > 1").select("key", F.col("top.component").alias("top"), "least")

    rows = scratch.write(rows.join(several(rows).select("key"), "key"), "members")
    ids = send_if_small(scratch.write(rows.select("id").distinct(), "ids"), BROADCAST_IDS)
    sets = map_batches(texts.join(ids, "id", "left_semi"), set_batches(size), "id long, shingles array<long>")
    sets = scratch.write(sets, "sets")
    unique = scratch.write(_unique_shingles(sets), "unique")
    rows = rows.join(unique, "id", "left").withColumn("common", F.col("n") - F.coalesce("unique", F.lit(0)))
    rows = scratch.write(rows.where(F.lit(100) * F.col("common") >= F.lit(percent) * F.col("n")), "members")
    rows = rows.join(several(rows), "key").where(
        _reachable(F.col("common"), F.col("n"), F.col("least"), percent)
    )
    rows = scratch.write(rows.select("key", "id", "n", "common", "component", "top"), "members")

    others = rows.where("component != top").select(
        "key", F.col("id").alias("x"), F.col("n").alias("nx"), F.col("common").alias("cx"), F.col("component").alias("own"), "top"
    )
    if others.isEmpty():
        return None
    inside = rows.select("id", "n", "common", "component").distinct()
    tops = others.select("x", "nx", "cx", F.col("top").alias("component")).distinct()
    links = _linked(tops, inside, "component", sets, percent, F.lit(True))
    # components besides the largest meet by key; of keys with the same members one is enough
    sides = others.groupBy("key").agg(
        F.bit_xor(F.xxhash64("x")).alias("one"),
        F.bit_xor(F.xxhash64("x", F.lit(1))).alias("two"),
        F.count("*").alias("rows"),
        (F.min("own") != F.max("own")).alias("several"),
    )
    sides = sides.where("several").groupBy("one", "two", "rows").agg(F.min("key").alias("key")).select("key")
    others = scratch.write(others.join(sides, "key").drop("top"), "others")
    partners = others.select(
        "key", F.col("x").alias("id"), F.col("nx").alias("n"), F.col("cx").alias("common"), F.col("own").alias("component")
    )
    links = links.unionByName(_linked(others, partners, "key", sets, percent, F.col("own") < F.col("component")))
    return scratch.write(links.distinct(), "links")


def _reachable(common, one, two, percent):
    """100 * shared >= percent * (one + two - shared), with `common` in place of shared."""
    return F.lit(100 + percent) * common >= F.lit(percent) * (one + two)


def _linked(left, right, by, sets, percent, condition):
    """Links (a, b) of `left` (x, nx, cx) to `right` (id, n, common) with the same `by`.

    `right` is dealt out in parts of about `PART` rows and `left` goes to each of them. The
    sets are compared inside the join, so that only links are rows of their own.
    """
    splits = right.groupBy(by).agg(F.ceil(F.count("*") / PART).alias("splits"))
    right = right.join(splits, by).withColumn("part", F.pmod(F.xxhash64("id"), "splits")).drop("splits").join(sets, "id")
    first = F.lit(0).cast("long")
    left = left.join(splits, by).withColumn("part", F.explode(F.sequence(first, F.col("splits") - 1))).drop("splits")
    left = left.join(sets.select(F.col("id").alias("x"), F.col("shingles").alias("shingles_x")), "x")
    shared = F.size(F.array_intersect("shingles", "shingles_x"))
    links = left.join(right, [by, "part"]).where(
        condition
        & _reachable(F.least("cx", "common"), F.col("nx"), F.col("n"), percent)
        & _reachable(shared, F.size("shingles"), F.size("shingles_x"), percent)
    )
    return links.select(F.col("x").alias("a"), F.col("id").alias("b"))


def set_batches(size):
    def run(batches):
        for batch in batches:
            ids = batch.column(0)
            for row, data, offsets in pieces(batch.column(1)):
                values, firsts = distinct(*shingles(*word_hashes(data, offsets), size))
                lists = pa.ListArray.from_arrays(pa.array(firsts.astype(np.int32)), pa.array(values.view(np.int64)))
                yield pa.RecordBatch.from_arrays([ids.slice(row, len(lists)), lists], names=["id", "shingles"])

    return run


def text_sets(column, size):
    """The sorted distinct shingles of each text."""
    for _, data, offsets in pieces(column):
        values, firsts = distinct(*shingles(*word_hashes(data, offsets), size))
        yield from (values[a:b] for a, b in zip(firsts[:-1], firsts[1:]))


def compare_batches(size, percent):
    def run(batches):
        for batch in batches:
            kept = []
            for row in range(0, batch.num_rows, ROWS_COMPARED):
                part = batch.slice(row, ROWS_COMPARED)
                for one, two in zip(text_sets(part.column(2), size), text_sets(part.column(3), size)):
                    both = len(np.intersect1d(one, two, assume_unique=True))
                    kept.append(both > 0 and 100 * both >= percent * (len(one) + len(two) - both))
            kept = pa.array(kept, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(kept), batch.column(1).filter(kept)], names=["a", "b"])

    return run


def verified(pairs, texts, size, percent, scratch):
    """The pairs whose whole sets are similar enough."""
    ids = scratch.write(pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct(), "ids")
    wanted = send_if_small(ids, BROADCAST_IDS)
    texts = scratch.write(texts.join(wanted, "id", "left_semi"), "texts")
    rows = pairs.join(texts.select(F.col("id").alias("b"), F.col("text").alias("text_b")), "b")
    rows = rows.join(texts.select(F.col("id").alias("a"), F.col("text").alias("text_a")), "a")
    rows = rows.select("a", "b", "text_a", "text_b")
    return scratch.write(map_batches(rows, compare_batches(size, percent), "a long, b long").distinct(), "links")


def near_duplicates(docs, text="text", key="doc_id", size=5, percent=80):
    """Groups of texts whose word sets are linked by 100 * intersection >= `percent` * union.

    `docs` is read as lower-cased (A-Z) words between white space; its other columns are
    not looked at. One row for each row of `docs`: doc_id, n_shingles, component_id (the
    smallest doc_id reached over links), kept (doc_id = component_id).

    Texts with equal sets are one class and are compared once, by the class's smallest id.
    In each table key all members are compared with one of them; members of keys that then
    still lie in several components are compared with the rest unless a bound rules them
    out, so that no link between classes that share a key is lost. Every link is confirmed on the whole sets.

    Null and empty texts, and texts of white space, have no shingles and stay alone. Rows
    that repeat a doc_id with another text have the component of their own text. Rows with
    a null doc_id are compared with nothing: component_id is null and they are kept. No
    rows give no rows.
    """
    scratch = Scratch(docs.sparkSession)
    sets = scratch.write(sketches(docs, size, text, key), "sketches")
    real = sets.where("n_shingles > 0 and doc_id is not null")
    classes = scratch.write(
        real.groupBy("set_1", "set_2", F.col("n_shingles").alias("n")).agg(
            F.min("doc_id").alias("id"), F.first("halves").alias("halves")
        ),
        "classes",
    )
    members = table_keys(classes, scratch)
    texts = docs.select(F.col(key).cast("long").alias("id"), F.col(text).cast("string").alias("text"))
    texts = texts.where("id is not null and text is not null")
    pairs = scratch.write(_centre_pairs(members, percent), "pairs")
    links = verified(pairs, texts, size, percent, scratch)
    found = components(links)
    rest = _open_links(members, found, texts, size, percent, scratch)
    if rest is not None:
        found = components(links.unionByName(rest))
    found = scratch.write(found.select(F.col("node").alias("id"), "component"), "components")
    scratch.clear(sets, classes, found)
    own = classes.select("set_1", "set_2", "id").join(send_if_small(found, BROADCAST_IDS), "id", "left")
    own = own.select("set_1", "set_2", F.coalesce("component", "id").alias("component"))
    rows = sets.select("doc_id", "n_shingles", "set_1", "set_2").join(own, ["set_1", "set_2"], "left")
    label = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id"))
    kept = F.coalesce(F.col("doc_id") == label, F.lit(True))
    return rows.select("doc_id", "n_shingles", label.alias("component_id"), kept.alias("kept"))
