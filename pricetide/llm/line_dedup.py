"""Repeated runs of lines found by winnowing, on DataFrame functions only.

A line here ends at a line break or at a sentence's end, so a passage is found in whatever
paragraph it stands. Blank lines do not count.

Each line starts a gram: the fewest lines from it on that have `GRAM_BYTES` bytes, some
fifteen words. In each stretch of as many bytes from a line on, the gram with the smallest
hash is a fingerprint. A run of twice that length, some thirty words, therefore has a
fingerprint wherever it occurs, and the same one each time. Fingerprints are joined with the
first place of their hash, the match is extended both ways while lines agree, and of runs
of `RUN_BYTES` bytes or more the later ones go. White space at the ends of lines is in no
count.

Shorter repeats go by whole newline lines (what stands between two line breaks, of whatever
number of sentences): of those with `LINE_WORDS` words or `LINE_BYTES` bytes the first place
of each stays, the later ones go.
"""

from pyspark.sql import Window
from pyspark.sql import functions as F

from pricetide.llm.scratch import Scratch, send_if_small
from pricetide.operators.skew import split_hot_keys

GRAM_BYTES = 90
RUN_BYTES = 2 * GRAM_BYTES
#: Newline lines that count alone have so many words or, as in scripts without spaces, so many bytes.
LINE_WORDS = 4
LINE_BYTES = 24
#: Rows of hashes or of documents with runs that are sent to all executors at most; more are joined by shuffling.
BROADCAST_ROWS = 500_000
#: Lines that a match is extended over at most. Fingerprints of a run start at most `GRAM_BYTES` bytes apart and at most
#: twice that from its ends, and a line has one byte at least, so what lies further off has a fingerprint of its own.
AHEAD = 2 * GRAM_BYTES
#: Stretches that meet the same first text in one task at most, about; more are split.
SPLIT_ROWS = 5_000
WHITE_SPACE = " \t\n\x0b\x0c\r"
ODD_SPACE = r"[\t\x0B\f\r]"
NOT_BLANK = r"[^ \t\n\x0B\f\r]"
WORDS = r"\S" + r"\S*\s+\S" * (LINE_WORDS - 1)
#: Splits behind a line break and behind the space after a full stop, question or exclamation mark.
LINE_ENDS = r"(?<=\n)|(?<=[.!?] )"
_MARK = "\x1e"


def text_lines(text):
    """The lines of a text with what ends them; together they are the text.

    Ends are marked by a sign to split at, which is much faster than a pattern; a text that
    has the sign itself is split by the pattern.
    """
    marked = text
    for end in ("\n", ". ", "! ", "? "):
        marked = F.replace(marked, F.lit(end), F.lit(end + _MARK))
    return F.when(F.contains(text, F.lit(_MARK)), F.split(text, LINE_ENDS)).otherwise(F.split(marked, _MARK))


def with_lines(documents):
    """`documents` (id, text_hash, text) with their lines in place of the text.

    lines: pos, hash and size of the lines that are not blank, without white space at their
    ends. newline_lines: first, last and hash of the newline lines that count alone, by
    place among the lines of `text_lines`.
    """
    text = F.col("text")

    def bare(x):
        """Without white space at the ends; the plain trim is much faster than that by a set of signs."""
        return F.when(F.col("odd"), F.trim(x, F.lit(WHITE_SPACE))).otherwise(F.trim(F.replace(x, F.lit("\n"), F.lit(""))))

    def counts(x):
        return (F.octet_length(x["line"]) >= LINE_BYTES) | F.rlike(x["line"], F.lit(WORDS))

    # each of these columns is read more than once and therefore made once, before the next
    parts = documents.select("id", "text_hash", "text", text_lines(text).alias("parts"), F.rlike(text, F.lit(ODD_SPACE)).alias("odd"))
    ends = F.filter(F.transform("parts", lambda x, i: F.when(F.endswith(x, F.lit("\n")), i)), lambda i: i.isNotNull())
    parts = parts.withColumn("ends", ends)
    lines = F.transform(
        F.transform("parts", bare),
        lambda x, i: F.struct(i.alias("pos"), F.xxhash64(x).alias("hash"), F.octet_length(x).alias("size")),
    )
    first = F.concat(F.array(F.lit(0)), F.transform("ends", lambda i: i + 1))
    last = F.concat("ends", F.array(F.size("parts") - 1))
    places = F.zip_with(first, last, lambda a, b: F.struct(a.alias("first"), b.alias("last")))
    whole = F.zip_with(
        F.transform(F.split(text, "\n"), bare), places, lambda x, at: F.struct(at["first"], at["last"], x.alias("line"))
    )
    alone = F.transform(F.filter(whole, counts), lambda x: F.struct(x["first"], x["last"], F.xxhash64(x["line"]).alias("hash")))
    return parts.select(
        "id", "text_hash", F.filter(lines, lambda x: x["size"] > 0).alias("lines"), alone.alias("newline_lines")
    )


def fingerprints(lines):
    """(id, text_hash, at, gram): the selected grams of each document's lines."""
    document = Window.partitionBy("id", "text_hash")
    before = F.sum("size").over(document.orderBy("at").rowsBetween(Window.unboundedPreceding, -1))
    lines = lines.withColumn("start", F.coalesce(before, F.lit(0).cast("long")))
    ahead = document.orderBy("start").rangeBetween(0, GRAM_BYTES - 1)
    grams = lines.select(
        "id",
        "text_hash",
        "at",
        "start",
        F.xxhash64(F.collect_list("hash").over(ahead)).alias("gram"),
        (F.sum("size").over(ahead) >= GRAM_BYTES).alias("whole"),
    )
    best = F.min(F.when(F.col("whole"), F.struct("gram", (-F.col("at")).alias("back")))).over(ahead)
    picked = grams.select("id", "text_hash", best.alias("best")).where("best is not null")
    return picked.select("id", "text_hash", (-F.col("best.back")).alias("at"), "best.gram").distinct()


def matches(documents, scratch):
    """Stretches of lines to compare: (id, text_hash, id_0, text_hash_0, shift, low, high).

    The first place of a fingerprint in a document meets its first place of all, later ones
    meet the place before in the same document, so lines that repeat at one distance have
    one distance all along. Fingerprints of a document that have the same distance from
    places in the same text make one stretch while they are near each other, extended on
    both sides.
    """
    lines = documents.select("id", "text_hash", F.posexplode("lines").alias("at", "line"))
    lines = lines.select("id", "text_hash", "at", "line.hash", "line.size")
    prints = scratch.write(fingerprints(lines), "fingerprints")
    again = prints.groupBy("gram").agg(F.count("*").alias("rows")).where("rows > 1").select("gram")
    again = send_if_small(scratch.write(again, "grams"), BROADCAST_ROWS)
    prints = scratch.write(prints.join(again, "gram", "left_semi"), "fingerprints")
    own = Window.partitionBy("id", "text_hash", "gram").orderBy("at")
    prints = scratch.write(prints.withColumn("before", F.lag("at").over(own)), "fingerprints")
    inside = prints.where("before is not null").select(
        "id",
        "text_hash",
        "at",
        F.col("id").alias("id_0"),
        F.col("text_hash").alias("text_hash_0"),
        (F.col("at") - F.col("before")).alias("shift"),
    )
    prints = prints.where("before is null").select("id", "text_hash", "at", "gram")
    first = prints.groupBy("gram").agg(F.min(F.struct("id", "text_hash", "at")).alias("first"))
    # a passage that stands in very many texts meets its first place in several tasks
    prints, first = split_hot_keys(prints, first, ["gram"], ["id", "text_hash"], rows_per_task=SPLIT_ROWS)
    found = prints.join(first, ["gram", "_split"]).where(F.struct("id", "text_hash", "at") != F.col("first"))
    found = found.select(
        "id",
        "text_hash",
        "at",
        F.col("first.id").alias("id_0"),
        F.col("first.text_hash").alias("text_hash_0"),
        (F.col("at") - F.col("first.at")).alias("shift"),
    ).unionByName(inside)
    diagonal = ["id", "text_hash", "id_0", "text_hash_0", "shift"]
    order = Window.partitionBy(*diagonal).orderBy("at")
    gap = F.col("at") - F.lag("at").over(order) > AHEAD
    found = found.withColumn("new", F.coalesce(gap, F.lit(True)).cast("int"))
    found = found.withColumn("stretch", F.sum("new").over(order))
    found = found.groupBy(*diagonal, "stretch").agg(F.min("at").alias("low"), F.max("at").alias("high"))
    low = F.greatest(F.col("low") - AHEAD, F.col("shift"), F.lit(0))
    return found.select(*diagonal, low.alias("low"), (F.col("high") + AHEAD).alias("high"))


def later_lines(documents, scratch):
    """(id, text_hash, first, last): newline lines that have an earlier place."""
    lines = documents.select("id", "text_hash", F.explode("newline_lines").alias("line"))
    lines = lines.select("id", "text_hash", "line.first", "line.last", "line.hash")
    place = F.struct("id", "text_hash", "first")
    again = lines.groupBy("hash").agg(F.min(place).alias("place"), F.count("*").alias("rows")).where("rows > 1")
    again = scratch.write(again.select("hash", "place"), "first-lines")
    if again.count() <= BROADCAST_ROWS:
        found = lines.join(F.broadcast(again), "hash")
    else:
        lines, again = split_hot_keys(lines, again, ["hash"], ["id", "text_hash", "first"])
        found = lines.join(again, ["hash", "_split"])
    return found.where(place != F.col("place")).select("id", "text_hash", "first", "last")


def later_runs(documents, scratch):
    """(id, text_hash, runs): the stretches of line positions to delete in each document."""
    alone = later_lines(documents, scratch)
    found = scratch.write(matches(documents, scratch), "matches")
    ids = found.select("id", "text_hash").unionByName(
        found.select(F.col("id_0").alias("id"), F.col("text_hash_0").alias("text_hash"))
    )
    ids = send_if_small(scratch.write(ids.distinct(), "ids"), BROADCAST_ROWS)
    documents = documents.join(ids, ["id", "text_hash"], "left_semi")

    def cut(hashes, low, high):
        return F.slice(hashes, low + 1, F.greatest(high - low + 1, F.lit(0)))

    first = documents.select(F.col("id").alias("id_0"), F.col("text_hash").alias("text_hash_0"), F.col("lines.hash").alias("all"))
    # a text that holds the first copy of what many repeat meets them in several tasks
    stretch = ["id", "text_hash", "shift", "low"]
    found, first = split_hot_keys(found, first, ["id_0", "text_hash_0"], stretch, rows_per_task=SPLIT_ROWS)
    own = found.join(documents, ["id", "text_hash"]).select(
        *found.columns,
        cut(F.col("lines.hash"), F.col("low"), F.col("high")).alias("hashes"),
        cut(F.col("lines.size"), F.col("low"), F.col("high")).alias("sizes"),
        cut(F.col("lines.pos"), F.col("low"), F.col("high")).alias("places"),
    )
    both = own.join(first, ["id_0", "text_hash_0", "_split"]).withColumn(
        "source", cut(F.col("all"), F.col("low") - F.col("shift"), F.col("high") - F.col("shift"))
    )
    key = ["id_0", "text_hash_0", "_split", *stretch]
    line = F.arrays_zip("hashes", "source", "sizes", "places")
    equal = both.select(*key, F.posexplode(line).alias("at", "line")).where("line.hashes = line.source")
    order = F.row_number().over(Window.partitionBy(*key).orderBy("at"))
    runs = (
        equal.select(*key, "at", F.col("line.places").alias("pos"), F.col("line.sizes").alias("size"))
        .withColumn("run", F.col("at") - order)
        .groupBy(*key, "run")
        .agg(F.min("pos").alias("first"), F.max("pos").alias("last"), F.sum("size").alias("size"))
        .where(F.col("size") >= RUN_BYTES)
    )
    runs = runs.select("id", "text_hash", "first", "last").unionByName(alone).distinct()
    # overlapping stretches, found along several distances, become one
    order = Window.partitionBy("id", "text_hash").orderBy("first", "last")
    before = F.max("last").over(order.rowsBetween(Window.unboundedPreceding, -1))
    runs = runs.withColumn("new", F.coalesce(F.col("first") > before + 1, F.lit(True)).cast("int"))
    runs = runs.withColumn("part", F.sum("new").over(order))
    runs = runs.groupBy("id", "text_hash", "part").agg(F.min("first").alias("first"), F.max("last").alias("last"))
    return runs.groupBy("id", "text_hash").agg(
        F.sort_array(F.collect_list(F.struct("first", "last"))).alias("runs"),
        F.sum(F.col("last") - F.col("first") + 1).alias("lines_deleted"),
    )


def without_repeated_runs(docs, text="text", key="doc_id"):
    """`docs` without the later copies of runs of lines that repeat.

    Returns the columns of `docs` with the text that is left, `lines_deleted` and
    `deleted`, which take the place of columns of these names (first and last position of each deleted stretch, counting the lines of
    `text_lines`, blank ones too, from 0). Texts come in the order of key and hash of the text; of a run
    that occurs again, in another text or further down in the same, the first one stays.
    What is deleted always occurs at an earlier place. A run of `RUN_BYTES` bytes or more
    whose fingerprints first occur in one place goes as a whole, a newline line of
    `LINE_WORDS` words or `LINE_BYTES` bytes wherever its first place is.

    A null text stays null; empty texts stay. Rows with the same key and text are one
    document and are cut alike. A null key comes last. No rows give no rows.
    """
    scratch = Scratch(docs.sparkSession)
    names = {"_id": F.coalesce(F.col(key).cast("long"), F.lit((1 << 63) - 1)), "_hash": F.xxhash64(F.col(text))}
    # a condition on the lines would be pushed down and make them twice
    documents = docs.where(F.rlike(F.col(text), F.lit(NOT_BLANK))).select(
        names["_id"].alias("id"), names["_hash"].alias("text_hash"), F.col(text).cast("string").alias("text")
    )
    documents = scratch.write(with_lines(documents), "lines")
    unique = documents.groupBy("id", "text_hash").agg(F.count("*").alias("rows")).where("rows > 1")
    if not unique.isEmpty():
        documents = scratch.write(documents.dropDuplicates(["id", "text_hash"]), "lines")
    runs = scratch.write(later_runs(documents, scratch), "runs")
    scratch.clear(runs)
    # the row goes as one column, beside which no name of its own can clash
    rows = docs.select(
        F.struct("*").alias("row"), names["_id"].alias("id"), names["_hash"].alias("text_hash"), F.col(text).alias("whole")
    ).join(send_if_small(runs, BROADCAST_ROWS), ["id", "text_hash"], "left")

    def gone(i):
        return F.exists("runs", lambda run: (i >= run["first"]) & (i <= run["last"]))

    cut = F.array_join(F.filter(text_lines(F.col("whole")), lambda x, i: ~gone(i)), "")
    left = F.when(F.col("runs").isNotNull(), cut).otherwise(F.col("whole"))
    own = {text: left, "lines_deleted": F.coalesce("lines_deleted", F.lit(0).cast("long")), "deleted": F.col("runs")}
    columns = [c for c in docs.columns if c not in ("lines_deleted", "deleted")]
    return rows.select(
        *[own[c].alias(c) if c == text else F.col("row").getField(c).alias(c) for c in columns],
        *[own[c].alias(c) for c in ("deleted", "lines_deleted")],
    )
