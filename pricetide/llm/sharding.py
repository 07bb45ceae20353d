"""Shards of near equal size by sampled splitters.

Records are ordered by a hash of their text, so equal texts are neighbours and a hot source
is spread. A sample of keys, drawn by size, gives splitters that cut this order into many
ranges of about one weight; ranges that turn out overfull are sampled again and cut finer.
Records are dealt by range, sorted inside it, and sums over the ranges before give every
record its exact place in bytes and rows of the whole order. A shard is a stretch of that
order, so its size does not depend on the luck of the sample.

A group of equal texts goes to one shard unless it is large beside a shard; such a group is
cut by record, as it may hold more bytes than a shard.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, LongType, StructField, StructType

from pricetide.llm.scratch import Scratch
from pricetide.llm.shipping import map_batches

SHARDS = 16
#: Ranges for each shard at least, and rows for each range at most (on average).
RANGES_PER_SHARD = 64
ROWS_PER_RANGE = 4_000_000
#: Keys sampled for each range; all of them go to the driver, 32 bytes each.
KEYS_PER_RANGE = 32
#: A group that has at most this share of a shard's mean size is never cut.
WHOLE_SHARE = 1 / 32
#: A range is overfull from this many times its share on.
OVERFULL = 2.0
#: So many times more keys are drawn each time from the ranges that are cut again.
MORE_KEYS = 8
ORDER = ["group", "tie", "row"]
COLUMNS = "doc_id long, size long, text_crc32 long, law string, shard int, slot long, grown_shard int"
_FIRST = np.iinfo(np.int64).min


def places_in(splitters, group, tie, row):
    """How many splitters are not behind each record, all three numbers compared in turn.

    Splitters are sorted rows of (group, tie, row). Most records differ from every splitter
    in the first number; only those of a splitter's group look at the others.
    """
    low = np.searchsorted(splitters[:, 0], group, "left")
    high = np.searchsorted(splitters[:, 0], group, "right")
    for k in np.unique(low[high > low]):
        mine = np.flatnonzero((low == k) & (high > low))
        end = int(high[mine[0]])
        ties = list(map(tuple, splitters[k:end, 1:].tolist()))
        # a group with a single splitter begins at it
        if ties == [(_FIRST, _FIRST)]:
            low[mine] = end
            continue
        all_rows = np.array(ties, dtype="i8,i8")
        wanted = np.empty(len(mine), dtype="i8,i8")
        wanted["f0"], wanted["f1"] = tie[mine], row[mine]
        order = np.lexsort((np.r_[all_rows["f1"], wanted["f1"]], np.r_[all_rows["f0"], wanted["f0"]]))
        from_splitters = order < len(ties)
        seen = np.cumsum(from_splitters)
        place = np.empty(len(order), np.int64)
        place[order] = seen
        low[mine] = k + place[len(ties) :]
    return low


def splitters_of(sample, pieces):
    """Weighted quantiles of sorted sampled keys as splitters.

    `sample` holds (group, tie, row, weight). The first splitter that falls into a group is
    put to its beginning, so only groups that hold several are cut.
    """
    keys = sorted(sample)
    weight = np.cumsum([k[3] for k in keys])
    wanted = weight[-1] * np.arange(1, pieces) / pieces
    found, last = [], None
    for at in np.unique(np.searchsorted(weight, wanted, "left")):
        group, tie, row, _ = keys[min(at, len(keys) - 1)]
        found.append((group, tie, row) if group == last else (group, _FIRST, _FIRST))
        last = group
    return found


def with_range(rows, splitters):
    """`rows` with `range` and `whole`, false for records of a group that has several ranges."""
    table = np.array(sorted(splitters), np.int64).reshape(-1, 3)
    cut = np.unique(table[table[:, 1] != _FIRST, 0])
    schema = StructType([*rows.schema.fields, StructField("range", LongType()), StructField("whole", BooleanType())])

    def run(batches):
        for batch in batches:
            group, tie, row = (batch.column(batch.schema.get_field_index(c)).to_numpy() for c in ORDER)
            found = pa.array(places_in(table, group, tie, row).astype(np.int64))
            whole = pa.array(~np.isin(group, cut))
            yield pa.RecordBatch.from_arrays([*batch.columns, found, whole], names=schema.names)

    return map_batches(rows, run, schema)


def sampled(rows, weight, share):
    """Keys of `rows`, each drawn with a chance of `share` times its weight, as tuples with what each stands for."""
    chance = F.least(weight * F.lit(float(share)), F.lit(1.0))
    drawn = F.shiftrightunsigned(F.xxhash64(*ORDER, F.lit("sample")), 11) / F.lit(float(1 << 53))
    picked = rows.withColumns({"_weight": weight, "_chance": chance}).where(drawn < F.col("_chance"))
    return [tuple(r) for r in picked.select(*ORDER, (F.col("_weight") / F.col("_chance")).alias("stands_for")).collect()]


def cut_into_ranges(rows, total_bytes, total_rows, ranges):
    """Splitters, and (range, bytes, rows) of each range that is not empty.

    A record weighs its share of the bytes plus its share of the rows, so that neither long
    texts nor many empty ones fill a range. Ranges of more than `OVERFULL` shares are sampled
    on their own and cut again, until none is left that more splitters would cut.
    """
    # all weights together are 1
    weight = (F.col("size") / F.lit(2.0 * total_bytes)) + F.lit(0.5 / total_rows)
    share = ranges * KEYS_PER_RANGE
    splitters = set(splitters_of(sampled(rows, weight, share), ranges))
    while True:
        ranged = with_range(rows, splitters)
        filled = ranged.groupBy("range").agg(F.sum("size").alias("bytes"), F.count("*").alias("rows")).collect()
        shares = {r.range: (r.bytes / (2 * total_bytes) + r.rows / (2 * total_rows)) * ranges for r in filled}
        many = {r.range: r.rows for r in filled}
        overfull = [k for k, x in shares.items() if x > OVERFULL and many[k] > 1]
        if not overfull:
            return splitters, filled
        share *= MORE_KEYS
        again = ranged.where(F.col("range").isin(overfull))
        by_range, table = {}, np.array(sorted(splitters), np.int64).reshape(-1, 3)
        for key in sampled(again, weight, share):
            at = int(places_in(table, *(np.array([x], np.int64) for x in key[:3]))[0])
            by_range.setdefault(at, []).append(key)
        more = set()
        for at, keys in by_range.items():
            begin = tuple(table[at - 1].tolist()) if at else None
            for new in splitters_of(keys, max(2, int(np.ceil(shares[at])))):
                # where the range begins with this group or inside it, its start cuts nothing: cut by record
                if new[1] == _FIRST and begin is not None and begin >= new:
                    inside = sorted(k[:3] for k in keys if k[0] == new[0])
                    new = inside[len(inside) // 2]
                more.add(new)
        if more <= splitters:
            return splitters, filled
        splitters |= more


def placed(docs, shards, text, key, keep_rows):
    """(doc_id, size, text_crc32, range, shard, rank, [record]) of all rows, written; and the scratch tables."""
    scratch = Scratch(docs.sparkSession)
    content = F.coalesce(F.col(text).cast("string"), F.lit(""))
    doc_id = F.col(key).cast("long")
    columns = [
        doc_id.alias("doc_id"),
        (F.octet_length(content).cast("long") + 1).alias("size"),
        F.crc32(content.cast("binary")).alias("text_crc32"),
        F.xxhash64(content).alias("group"),
        F.xxhash64(doc_id).alias("tie"),
    ]
    if keep_rows:
        columns.append(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("record"))
    rows = scratch.write(docs.select(*columns).withColumn("row", F.monotonically_increasing_id()), "records")
    total_bytes, total_rows = rows.agg(F.sum("size"), F.count("*")).first()
    if not total_rows:
        return None, scratch
    ranges = max(shards * RANGES_PER_SHARD, -(-total_rows // ROWS_PER_RANGE))
    keys = rows.select("size", *ORDER)
    splitters, filled = cut_into_ranges(keys, total_bytes, total_rows, ranges)
    starts, size_before, rows_before = [], 0, 0
    for r in sorted(filled):
        starts.append((r.range, size_before, rows_before))
        size_before, rows_before = size_before + r.bytes, rows_before + r.rows
    starts = docs.sparkSession.createDataFrame(starts, "range long, size_before long, rows_before long")
    inside = Window.partitionBy("range").orderBy(*ORDER)
    group = Window.partitionBy("range", "group")
    ranged = with_range(rows, splitters)
    # groups with several ranges, fewer than splitters; each begins where its first range does
    several = ranged.where(~F.col("whole")).groupBy("group")
    several = several.agg(F.min("range").alias("range"), F.sum("size").alias("group_length"))
    several = several.where(F.col("group_length") <= F.lit(total_bytes / shards * WHOLE_SHARE))
    several = several.join(F.broadcast(starts), "range").select("group", "group_length", F.col("size_before").alias("group_begin"))
    found = ranged.withColumns(
        {
            "number": F.row_number().over(inside) - 1,
            "before": F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, 0)) - F.col("size"),
        }
    )
    found = found.join(F.broadcast(starts), "range").join(F.broadcast(scratch.write(several, "groups")), "group", "left")
    # what is placed as one, from where on and how long: the group, or the record of a group that is cut
    in_range = F.col("size_before") + F.when(F.col("whole"), F.min("before").over(group)).otherwise(F.col("before"))
    length = F.when(F.col("whole"), F.sum("size").over(group)).otherwise(F.col("size"))
    middle = 2 * F.coalesce("group_begin", in_range) + F.coalesce("group_length", length)
    found = found.withColumn("middle", middle)
    shard = F.expr(f"(middle * {shards}) div {2 * total_bytes}")
    out = ["doc_id", "size", "text_crc32", "range", shard.cast("int").alias("shard")]
    out += [(F.col("rows_before") + F.col("number")).alias("rank"), *(["record"] if keep_rows else [])]
    return scratch.write(found.select(*out), "placed"), scratch


def _with_slots(rows):
    """Number of each record in its shard, from 0 without gaps; one row a shard is sent to all tasks."""
    firsts = rows.groupBy("shard").agg(F.min("rank").alias("first_rank"))
    return rows.join(F.broadcast(firsts), "shard").withColumn("slot", F.col("rank") - F.col("first_rank"))


def sharded(docs, shards=SHARDS, text="text", key="doc_id"):
    """The shard and slot of every row under the law `bytes`: sizes near equal.

    Gives doc_id, size (bytes of the text in UTF-8 plus 1, 1 for a null text), text_crc32,
    law, shard (from 0), slot (from 0 without gaps inside the shard) and grown_shard (null
    under this law). A shard's size differs from the mean by no more than the groups of
    equal texts, or the single records, at its two borders. Groups of up to 1/32 of that mean
    are never cut, larger ones may be.

    A null text is treated as an empty one. Rows that repeat a doc_id are rows of their own;
    rows with a null doc_id are kept. Rows that agree in doc_id and text may change places.
    No rows give no rows. Other columns are not looked at. With fewer records than shards, or
    a record larger than a shard, some shards stay empty.
    """
    rows, scratch = placed(docs, shards, text, key, False)
    if rows is None:
        return docs.sparkSession.createDataFrame([], COLUMNS)
    scratch.clear(rows)
    return _with_slots(rows).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def write_shards(docs, path, shards=SHARDS, text="text", key="doc_id"):
    """Write all rows to a folder for each shard, `path`/shard=N, as Parquet files in the order of slots.

    A file holds `slot` and the whole row as `record`, so no column's name can clash. A
    range is written by one task, a shard by many. Without rows nothing is written.
    """
    rows, scratch = placed(docs, shards, text, key, True)
    if rows is None:
        return
    ranged = _with_slots(rows).repartition("range").sortWithinPartitions("shard", "slot")
    ranged.select("shard", "slot", "record").write.partitionBy("shard").parquet(path)
    scratch.clear()
