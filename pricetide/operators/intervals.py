"""Joining points in time with the windows they fall into."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from pricetide.functions.measures import times_power
from pricetide.functions.times import add_seconds, micros
from pricetide.operators.ranking import running_totals
from pricetide.operators.skew import BROADCAST_ROWS, ROWS_PER_TASK, is_small, split_hot_keys
from pricetide.workspace import stage

# Cells per mean window length, and most bins, of running totals over time.
CELLS_PER_WINDOW = 16
MAX_BINS = 100_000

# Exact sums: binary digits of a band of values, digits kept below it, bands of the infinities.
BAND_BITS, SPARE_BITS, INFINITE = 32, 54, 1000

# Windows whose lengths differ less than so many times share buckets of one width.
LENGTH_STEP = 16


def windows_of(df, ts, seconds, stamp="start"):
    """Add `window_start` and `window_end` to rows that have a stamp and a duration.

    `stamp` says which end of the work the stamp marks.
    """
    if stamp == "start":
        start, end = F.col(ts).cast("timestamp"), add_seconds(F.col(ts), seconds)
    elif stamp == "end":
        start, end = add_seconds(F.col(ts), -seconds), F.col(ts).cast("timestamp")
    else:
        raise ValueError(f"stamp must be 'start' or 'end', not {stamp!r}")
    return df.withColumn("window_start", start).withColumn("window_end", end)


def _islands(windows, few):
    """Overlapping windows merged into separate ones."""
    if few:
        # Few enough for one task, which keeps the latest end so far.
        order = Window.orderBy("_from")
        reach = F.max("_to").over(order.rowsBetween(Window.unboundedPreceding, -1))
        opens = F.coalesce(F.col("_from") > reach, F.lit(True)).cast("long")
        numbered = windows.withColumn("_opens", opens).withColumn("_island", F.sum("_opens").over(order))
        return numbered.groupBy("_island").agg(F.min("_from").alias("_from"), F.max("_to").alias("_to"))
    bounds = (
        windows.select(
            F.inline(
                F.array(
                    F.struct(F.col("_from").alias("at"), F.lit(0).alias("side"), F.lit(1).alias("step")),
                    F.struct(F.col("_to").alias("at"), F.lit(2).alias("side"), F.lit(-1).alias("step")),
                )
            )
        )
        .groupBy("at", "side")
        .agg(F.sum("step").alias("step"))
    )
    bin = F.floor(F.col("at") / _bin_width(windows))
    steps = running_totals(bounds, [], bin, ["at", "side"], {"step": "open"})
    # An island begins where a first window opens and ends where none is left open.
    edges = steps.where((F.col("open") == 0) | (F.col("open") == F.col("step"))).select(
        "at", "side", (F.col("side") == 0).cast("long").alias("begins")
    )
    numbered = running_totals(edges, [], bin, ["at", "side"], {"begins": "_island"})
    return numbered.groupBy("_island").agg(F.min("at").alias("_from"), F.max("at").alias("_to"))


def _bin_width(windows):
    """Width of the bins of running totals over the time the windows span."""
    span = windows.agg(F.max("_to") - F.min("_from")).scalar()
    return F.coalesce(F.greatest(span / MAX_BINS, F.lit(4_000_000.0)), F.lit(4e6))


def length_class(length):
    """Which power of LENGTH_STEP microseconds a length reaches, from a millisecond on."""
    return F.floor(F.log(float(LENGTH_STEP), F.greatest(length, F.lit(1000))))


def bucketed(windows, width):
    """A row for each bucket of `width` microseconds that a window touches."""
    buckets = F.sequence(F.floor(F.col("_from") / width), F.floor(F.col("_to") / width))
    return windows.withColumn("_bucket", F.explode(buckets))


def merged_windows(windows, few):
    """Overlapping windows merged into separate ones, written, with the class of their length; and the classes."""
    bounds = {"_from": micros(F.col("window_start")), "_to": micros(F.col("window_end"))}
    windows = windows.select(*[c.alias(n) for n, c in bounds.items()]).where(F.col("_to") >= F.col("_from"))
    merged = _islands(windows, few).select("_from", "_to", length_class(F.col("_to") - F.col("_from")).alias("_class"))
    # read once for each class, of which there are as many as powers of LENGTH_STEP between a second and years
    merged = stage(merged, "merged-windows")
    return merged, sorted(r[0] for r in merged.select("_class").distinct().collect())


def mark_inside(
    windows, points, ts, point_id, name="inside", rows_per_task=ROWS_PER_TASK, broadcast_rows=BROADCAST_ROWS
):
    """`points` with the column `name`: whether any window's [window_start, window_end] holds them.

    Overlapping windows are merged first. The merged ones are classed by their length, and a
    point looks into one bucket of each class. Buckets are no longer than the windows of
    their class, which lie apart, so a point meets three of them at most, whatever the
    windows of other lengths are. A class of few windows is broadcast; else its buckets meet
    by a shuffle, and buckets with too many points are split by `point_id`.
    """
    few = is_small(windows, broadcast_rows // (LENGTH_STEP + 2))
    merged, classes = merged_windows(windows, few)
    columns, inside = points.columns, F.lit(False)
    points = points.withColumn("_at", micros(F.col(ts)))
    for number, cls in enumerate(classes):
        width = float(LENGTH_STEP**cls)
        mine = bucketed(merged.where(F.col("_class") == cls), width).select("_bucket", "_from", "_to")
        mine = mine.withColumn("_found", F.lit(True))
        points = points.withColumn("_bucket", F.floor(F.col("_at") / width))
        on = (F.col("p._bucket") == F.col("w._bucket")) & F.col("p._at").between(F.col("w._from"), F.col("w._to"))
        if few or is_small(mine, broadcast_rows):
            mine = F.broadcast(mine)
        else:
            points, mine = split_hot_keys(points, mine, ["_bucket"], point_id, None, rows_per_task)
            on = on & (F.col("p._split") == F.col("w._split"))
        met = points.alias("p").join(mine.alias("w"), on, "left")
        found = f"_in_{number}"
        kept = [*columns, "_at", *[f"_in_{k}" for k in range(number)]]
        points = met.select(*[F.col(f"p.{c}") for c in kept], F.col("w._found").isNotNull().alias(found))
        inside = inside | F.col(found)
    return points.select(*columns, inside.alias(name))


def interval_join(
    windows,
    points,
    ts,
    point_id,
    how="inner",
    bucket_seconds=None,
    rows_per_task=ROWS_PER_TASK,
    broadcast_rows=BROADCAST_ROWS,
):
    """Points joined with the windows whose [window_start, window_end] holds them.

    `how` is "inner" (a row per point and window), "left_anti" (points in no window) or
    "left_semi" (points in any window, once each). For the last two overlapping windows are
    merged first, so that a point meets few of them.

    Both sides meet on time buckets. Windows are classed by length and each class has
    buckets of its own width, so one long window does not widen the buckets of the others:
    a window covers at most LENGTH_STEP + 2 buckets. For pairs a point gets a copy for each
    class there is (one for each power of LENGTH_STEP), else see `mark_inside`. Few windows
    go to the points as a broadcast; otherwise buckets with too many points are split by
    `point_id`, for pairs also those with too many windows. `bucket_seconds` sets one width
    for all instead.
    """
    if how != "inner" and bucket_seconds is None:
        marked = mark_inside(windows, points, ts, point_id, "_inside", rows_per_task, broadcast_rows)
        return marked.where(F.col("_inside") == (how == "left_semi")).drop("_inside")
    windows = windows.withColumns(
        {"_from": micros(F.col("window_start")), "_to": micros(F.col("window_end"))}
    ).where(F.col("_to") >= F.col("_from"))
    # So many buckets a window covers at most.
    few = is_small(windows, broadcast_rows // (LENGTH_STEP + 2))
    if how != "inner":
        windows, window_id = _islands(windows.select("_from", "_to"), few), None
    else:
        window_id = windows.columns
    length = F.col("_to") - F.col("_from")
    windows = windows.withColumn("_class", F.lit(0).cast("long"))
    points = points.withColumn("_at", micros(F.col(ts))).withColumn("_class", F.lit(0).cast("long"))
    if bucket_seconds is not None:
        width = F.lit(bucket_seconds * 1_000_000.0)
    elif how == "inner":
        windows = windows.withColumn("_class", length_class(length))
        classes = windows.agg(F.collect_set("_class")).scalar()
        points = points.withColumn("_class", F.explode(classes))
        width = F.pow(F.lit(float(LENGTH_STEP)), F.col("_class"))
    windows = bucketed(windows, width)
    if bucket_seconds is not None:
        few = few and is_small(windows, broadcast_rows)
    points = points.withColumn("_bucket", F.floor(F.col("_at") / width))
    inside = (
        (F.col("p._class") == F.col("w._class"))
        & (F.col("p._bucket") == F.col("w._bucket"))
        & F.col("p._at").between(F.col("w._from"), F.col("w._to"))
    )
    if few:
        windows = F.broadcast(windows)
    else:
        points, windows = split_hot_keys(
            points, windows, ["_class", "_bucket"], point_id, window_id, rows_per_task
        )
        inside = inside & (F.col("p._split") == F.col("w._split"))
    p, w = points.alias("p"), windows.alias("w")
    helpers = {"_class", "_bucket", "_split", "_at", "_from", "_to"}
    columns = [F.col(f"p.{c}") for c in points.columns if c not in helpers]
    if how == "inner":
        columns = [F.col(f"w.{c}") for c in windows.columns if c not in helpers] + columns
    return p.join(w, inside, how).select(*columns)


def _exact(value):
    """A double as (band, units): a whole number of units of 2^(BAND_BITS * band - SPARE_BITS).

    Infinities have bands of their own, where units count them.
    """
    value = F.when(~F.isnan(value), value)  # said here too, as a filter may be worked out later than this
    infinite = F.abs(value) == float("inf")
    exponent = F.floor(F.log2(F.abs(value)) / BAND_BITS)
    none = F.lit(0).cast("long")
    band = F.when(infinite, F.when(value > 0, INFINITE).otherwise(-INFINITE)).otherwise(
        F.when(value != 0, exponent).otherwise(none)
    )
    scaled = times_power(F.when(~infinite, value), SPARE_BITS - BAND_BITS * band)
    # both halves fit a long, and neither is rounded
    high = F.floor(scaled / 2.0**BAND_BITS)
    low = (scaled - high * F.lit(2.0**BAND_BITS)).cast("long")
    whole = high.cast("decimal(20,0)") * F.lit(2**BAND_BITS).cast("decimal(10,0)") + low.cast("decimal(20,0)")
    return band, F.when(infinite, F.lit(1).cast("decimal(20,0)")).otherwise(whole)


def _double(band, units):
    """The sum that `units` of a band stand for."""
    endless = F.when(units > 0, F.when(band > 0, float("inf")).otherwise(float("-inf"))).otherwise(0.0)
    finite = times_power(units.cast("double"), BAND_BITS * band - SPARE_BITS)
    return F.when(F.abs(band) == INFINITE, endless).otherwise(finite)


def measured_points(windows, points, ts, value):
    """Points with a number as `value` in the time that the windows span, as `at` and `value`."""
    windows = windows.where(F.col("window_end") >= F.col("window_start"))
    first, last = windows.agg(F.min("window_start")).scalar(), windows.agg(F.max("window_end")).scalar()
    return points.where(F.col(ts).between(first, last)).select(
        micros(F.col(ts)).alias("at"), F.col(value).try_cast("double").alias("value")
    ).where(F.col("value").isNotNull() & ~F.isnan("value"))


def interval_sums(windows, points, ts, value, keys, broadcast_rows=BROADCAST_ROWS):
    """Number and sum of the values inside each window, without making pairs.

    `first` is the number of `measured_points` before a window. Number and sum are differences of running totals over time, at the end and at the start of a
    window, so the cost does not depend on how much windows overlap. Points outside the
    time the windows span are cut off first; points that share a cell of time with no
    window bound combine before the shuffle; a bin holds at most a row per microsecond and
    band. Values are summed as whole numbers in bands of 32 binary digits (most columns
    have one or two, doubles have 66 at most), so a huge value takes nothing from small
    ones elsewhere. NULL and NaN are left out, infinities count. `keys` tell windows
    apart; windows without points are left out.
    """
    points = measured_points(windows, points, ts, value)
    windows = windows.where(F.col("window_end") >= F.col("window_start"))
    windows = windows.select(
        *keys, micros(F.col("window_start")).alias("_from"), micros(F.col("window_end")).alias("_to")
    )
    length = F.avg(F.col("_to") - F.col("_from"))
    cell = windows.agg(F.greatest(length / CELLS_PER_WINDOW, F.lit(1000.0))).scalar()
    cell = F.coalesce(cell, F.lit(1000.0))
    band, units = _exact(F.col("value"))
    points = points.select("at", band.alias("band"), units.alias("units"))
    # at most 66 numbers
    bands = points.agg(F.collect_set("band")).scalar()
    bounds = windows.select(F.explode(F.array("_from", "_to")).alias("at"))
    if is_small(windows, broadcast_rows // 2):
        # Elsewhere a point may stand at one moment of its cell, safely inside it.
        cells = bounds.select(F.floor(F.col("at") / cell).alias("cell")).distinct()
        points = points.withColumn("cell", F.floor(F.col("at") / cell)).join(
            F.broadcast(cells.withColumn("bound", F.lit(True))), "cell", "left"
        )
        moment = F.floor(F.col("cell") * cell) + 2
        points = points.withColumn("at", F.when(F.col("bound"), F.col("at")).otherwise(moment))
    values = points.groupBy("at", "band").agg(F.count("*").alias("n"), F.sum("units").alias("total"))
    marks = windows.withColumn("band", F.explode(bands)).select(
        *keys,
        "band",
        F.inline(
            F.array(
                F.struct(F.col("_from").alias("at"), F.lit(0).alias("side")),
                F.struct(F.col("_to").alias("at"), F.lit(2).alias("side")),
            )
        ),
        F.lit(0).cast("long").alias("n"),
        F.lit(0).cast("decimal(38,0)").alias("total"),
    )
    steps = values.withColumn("side", F.lit(1)).unionByName(marks, allowMissingColumns=True)
    bin = F.floor(F.col("at") / _bin_width(windows))
    totals = {"n": "n_upto", "total": "total_upto"}
    steps = running_totals(steps, ["band"], bin, ["at", "side"], totals)

    def inside(name):
        upto = F.max(F.when(F.col("side") == 2, F.col(name)))
        return upto - F.max(F.when(F.col("side") == 0, F.col(name)))

    per_band = steps.where("side != 1").groupBy(*keys, "band").agg(
        F.max(F.when(F.col("side") == 0, F.col("n_upto"))).cast("long").alias("first"),
        inside("n_upto").cast("long").alias("n"), inside("total_upto").alias("units")
    )
    found = per_band.groupBy(*keys).agg(
        F.sum("first").alias("first"),
        F.sum("n").alias("count"),
        F.sum(_double(F.col("band"), F.col("units"))).alias("total"),
    )
    return found.where(F.col("count") > 0)


def interval_totals(windows, points, ts, value, keys, broadcast_rows=BROADCAST_ROWS):
    """Number and mean of the values inside each window, see `interval_sums`."""
    found = interval_sums(windows, points, ts, value, keys, broadcast_rows)
    return found.select(*keys, "count", (F.col("total") / F.col("count")).alias("mean"))
