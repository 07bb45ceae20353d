"""Keyed merges: whole-row replacement and partial price updates."""

from pyspark.sql import functions as F

from pricetide.functions.measures import rate
from pricetide.operators.skew import broadcast_if_small, is_small

CHANGE_ORDER = ["updated_at", "update_iteration"]
PATCHED = ["price", "updated_at", "update_iteration"]


def last_of_each_key(source, key="isin", order=None):
    """The last row of each key by the `order` columns, or else in the order the frame has."""
    at = F.monotonically_increasing_id() if order is None else F.struct(*order)
    rest = [c for c in source.columns if c != key]
    last = source.withColumn("_at", at).groupBy(key).agg(F.max_by(F.struct(*rest), "_at").alias("_last"))
    return last.select(*[key if c == key else f"_last.{c}" for c in source.columns])


def replace_rows(target, source, key="isin", order=None):
    """Insert source rows, replacing the whole row where the key exists.

    Columns the source lacks become NULL in replaced rows. Of source rows with one key the
    last wins, as if they were written one after the other (`last_of_each_key`).
    """
    source = last_of_each_key(source, key, order)
    kept = target.join(broadcast_if_small(source.select(key)), key, "left_anti")
    return kept.unionByName(source, allowMissingColumns=True).select(*target.columns)


def latest_changes(changes, key="isin", order=CHANGE_ORDER, columns=PATCHED):
    """Last change of each key, and how many changes the key had (`changes`).

    The changes of a hot key combine before the shuffle.
    """
    return (
        changes.groupBy(key)
        .agg(
            F.max_by(F.struct(*columns), F.struct(*order)).alias("last"),
            F.count("*").alias("changes"),
        )
        .select(key, *[f"last.{c}" for c in columns], "changes")
    )


def patch_rows(target, changes, key="isin", order=CHANGE_ORDER, columns=PATCHED):
    """Set the patched columns of known keys to their latest change.

    Unknown keys are never inserted. A change older than the row is ignored, so
    applying a batch again alters nothing.
    """
    new = latest_changes(changes, key, order, columns).select(
        key, *[F.col(c).alias(f"_new_{c}") for c in columns]
    )
    if is_small(changes):
        # No more keys than changes: the target stays where it is.
        new = F.broadcast(new)
    due = F.col("_new_updated_at").isNotNull() & (
        F.col("updated_at").isNull() | (F.col("_new_updated_at") >= F.col("updated_at"))
    )
    patched = target.join(new, key, "left").withColumns(
        {c: F.when(due, F.col(f"_new_{c}")).otherwise(F.col(c)) for c in columns}
    )
    return patched.select(*target.columns)


def unmatched_changes(target, changes, key="isin", order=CHANGE_ORDER, columns=PATCHED):
    """Latest change of each key the target does not have."""
    latest = latest_changes(changes, key, order, columns)
    known = target.select(key)
    if is_small(changes):
        known = known.join(F.broadcast(changes.select(key)), key, "left_semi")
    return latest.join(known, key, "left_anti")


def merge_tally(target, changes, key="isin", seconds=None):
    """Changes in all, applied and failed, and the rate of applied ones."""
    per_key = changes.groupBy(key).agg(F.count("*").alias("n"))
    if is_small(changes):
        per_key = F.broadcast(per_key)
    applied = per_key.join(target.select(key), key).agg(F.sum("n").alias("n"))
    tally = changes.agg(F.count("*").alias("total")).select(
        "total", F.coalesce(applied.scalar(), F.lit(0)).cast("long").alias("success_count")
    )
    tally = tally.withColumn("error_count", F.col("total") - F.col("success_count"))
    if seconds is None:
        return tally
    return tally.withColumn("updates_per_second", rate(F.col("success_count"), F.lit(seconds)))
