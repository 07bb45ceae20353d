"""Exact duplicates by block naming, on DataFrame functions only.

Texts are cut into blocks of `BLOCK` bytes. Distinct blocks are sorted and their rank is
their name; then adjacent names are paired, distinct pairs sorted and named again, until
one name is left of each text. Different texts never get one name, as names stand for
sorted content and not for hashes.
"""

from pyspark.sql import functions as F

from pricetide.llm.scratch import Scratch, send_if_small

BLOCK = 8192
#: Hash pairs of repeated texts sent to all executors at most, 16 bytes each.
BROADCAST_HASHES = 1_000_000
WHITE_SPACE = " \t\n\x0b\x0c\r"


def without_white_space(text):
    for c in WHITE_SPACE:
        text = F.replace(text, F.lit(c), F.lit(""))
    return text


def named(distinct, columns, scratch, ranged_by=None):
    """`distinct` with `name`, the dense rank of each row in the order of `columns`.

    Rows are sorted in ranges of `ranged_by`, or else of all `columns`; a row's rank is its
    place in its range plus the number of rows in earlier ranges, a sum over one row for
    each range.
    """
    ranges = distinct.repartitionByRange(*(ranged_by or columns)).sortWithinPartitions(*columns)
    rows = scratch.write(ranges.withColumn("at", F.monotonically_increasing_id()), "names")
    part = F.shiftright("at", 33)
    sizes = rows.groupBy(part.alias("part")).agg(F.count("*").alias("rows")).collect()
    before, total = [], 0
    for size in sorted(sizes):
        before.append(F.struct(F.lit(size["part"]).cast("long").alias("part"), F.lit(total).cast("long").alias("before")))
        total += size["rows"]
    if not before:
        return rows.withColumn("name", F.col("at")).drop("at")
    starts = distinct.sparkSession.range(1).select(F.inline(F.array(*before)))
    rows = rows.withColumn("part", part).join(F.broadcast(starts), "part")
    place = F.col("at").bitwiseAND(F.lit((1 << 33) - 1))
    return rows.withColumn("name", F.col("before") + place).drop("at", "part", "before")


def block_names(texts, scratch):
    """(row, pos, name) of the blocks of `texts` (row, content).

    Distinct blocks are sorted by their MD5 digest, then their content, so that the ranges
    are sampled by digests, 16 bytes each, and no block is a key of a shuffle; the names
    stand for the content all the same. Rows meet them by digest, after a look whether any
    two blocks share one. Should that ever be, all meet by content.
    """
    count = F.greatest(F.ceil(F.octet_length("content") / BLOCK), F.lit(1))
    places = texts.select("row", "content", F.explode(F.sequence(F.lit(0).cast("long"), count - 1)).alias("pos"))
    start = (F.col("pos") * BLOCK + 1).cast("int")
    blocks = places.select("row", "pos", F.substring("content", start, F.lit(BLOCK)).alias("block"))
    blocks = blocks.withColumn("digest", F.unhex(F.md5("block")))
    kinds = blocks.groupBy("digest").agg(F.min("block").alias("block"), F.max("block").alias("last"))
    kinds = scratch.write(kinds, "blocks")
    if kinds.where("block != last").isEmpty():
        names = named(kinds.drop("last"), ["digest", "block"], scratch, ["digest"])
        names = scratch.write(names.select("digest", "name"), "names")
        return blocks.select("row", "pos", "digest").join(names, "digest").select("row", "pos", "name")
    kinds = scratch.write(blocks.groupBy("digest", "block").agg(F.lit(1).alias("_")).drop("_"), "blocks")
    names = scratch.write(named(kinds, ["digest", "block"], scratch, ["digest"]), "names")
    return blocks.join(names, ["digest", "block"]).select("row", "pos", "name")


def identities(texts, scratch):
    """(row, level, name): equal texts, and only they, have one level and name."""
    names, done, level = scratch.write(block_names(texts, scratch), "level"), [], 0
    while True:
        sizes = names.groupBy("row").agg(F.max("pos").alias("last"))
        single = sizes.where("last = 0").select("row")
        # first blocks of finished rows have no successor in their row
        pairs = names.groupBy("row", F.shiftright("pos", 1).alias("pos")).agg(
            F.max(F.when(F.col("pos") % 2 == 0, F.col("name"))).alias("one"),
            F.coalesce(F.max(F.when(F.col("pos") % 2 == 1, F.col("name"))), F.lit(-1).cast("long")).alias("two"),
        )
        done.append(names.join(single, "row", "left_semi").select("row", F.lit(level).alias("level"), "name"))
        pairs = pairs.join(single, "row", "left_anti")
        pairs = scratch.write(pairs, "pairs")
        if pairs.isEmpty():
            break
        distinct = pairs.groupBy("one", "two").agg(F.lit(1).alias("_")).select("one", "two")
        pair_names = named(distinct, ["one", "two"], scratch)
        names = scratch.write(pairs.join(pair_names, ["one", "two"]).select("row", "pos", "name"), "level")
        level += 1
    for rows in done[1:]:
        done[0] = done[0].unionByName(rows)
    return done[0]


def exact_duplicates(docs, text="text", key="doc_id"):
    """Groups of texts that are equal without white space (space, \\t to \\r).

    One row for each row of `docs`, whose other columns are not looked at: doc_id, keep_id
    (doc_id of the group's row with most code points in its original text, then the
    smallest doc_id), group_size, kept (true for exactly one row of a group), text_sha256
    (of the text without white space).

    A text whose length and 64-bit hash no other text has is alone; its content goes no
    further. All others are named by content.

    A null text counts as empty; empty texts are one group. Rows that repeat a doc_id are
    rows of their own, of equal ones any one stays. A row with a null doc_id goes last among
    rows of equal length. No rows give no rows.
    """
    scratch = Scratch(docs.sparkSession)
    plain = without_white_space(F.coalesce(F.col(text).cast("string"), F.lit("")))
    rows = docs.select(
        F.col(key).cast("long").alias("doc_id"),
        F.coalesce(F.length(F.col(text).cast("string")), F.lit(0)).alias("points"),
        plain.alias("plain"),
    ).withColumns({"hash": F.xxhash64("plain"), "bytes": F.octet_length("plain")})
    heads = scratch.write(
        rows.select("doc_id", "hash", "bytes", F.sha2("plain", 256).alias("text_sha256")), "heads"
    )
    repeated = heads.groupBy("hash", "bytes").agg(F.count("*").alias("rows")).where("rows > 1").select("hash", "bytes")
    written = scratch.write(repeated, "repeated")
    repeated = send_if_small(written, BROADCAST_HASHES)
    alone = heads.join(repeated, ["hash", "bytes"], "left_anti").select(
        "doc_id",
        F.col("doc_id").alias("keep_id"),
        F.lit(1).cast("long").alias("group_size"),
        F.lit(True).alias("kept"),
        "text_sha256",
    )
    texts = scratch.write(
        rows.join(repeated, ["hash", "bytes"], "left_semi")
        .select("doc_id", "points", F.col("plain").cast("binary").alias("content"))
        .withColumn("row", F.monotonically_increasing_id()),
        "texts",
    )
    found = scratch.write(identities(texts.select("row", "content"), scratch), "identities")
    info = texts.select("row", "doc_id", "points", F.sha2("content", 256).alias("text_sha256"))
    members = scratch.write(found.join(info, "row"), "members")
    order = F.struct(-F.col("points"), F.col("doc_id").isNull(), F.col("doc_id").alias("id"), F.col("row").alias("r"))
    groups = members.groupBy("level", "name").agg(F.min(order).alias("first"), F.count("*").alias("group_size"))
    scratch.clear(heads, written, members)
    return members.join(groups, ["level", "name"]).select(
        "doc_id", F.col("first.id").alias("keep_id"), "group_size", (F.col("first.r") == F.col("row")).alias("kept"), "text_sha256"
    ).unionByName(alone)
