"""The latest change of every known key, kept as state of a stream.

A state row holds a bucket of some hundred keys as one Arrow table, so a micro-batch reads
and writes the buckets that its changes fall into, by one call each, and nothing of the
base. The base's keys are the state's first content; they are read once.
"""

import sys

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor

# executors get this module's code with the processor, they need not have it
cloudpickle.register_pickle_by_value(sys.modules[__name__])

KEYS_PER_BUCKET = 128
#: Rows that a task packs by buckets at a time: the state's workers take time for each row they are given.
ROWS_PER_CHUNK = 500_000
ROCKS_DB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
#: Stands for NULL in an order column, before every value.
NEVER = -(1 << 63)


def _number(column, kind):
    """An order column as a whole number."""
    if kind in ("timestamp", "timestamp_ntz"):
        column = F.unix_micros(column.cast("timestamp"))
    elif kind == "date":
        column = F.unix_date(column)
    elif kind not in ("byte", "short", "integer", "long"):
        raise ValueError(f"changes cannot be ordered by a column of type {kind}")
    return F.coalesce(column.cast("long"), F.lit(NEVER))


def _packed(df, columns):
    """Columns as one JSON text, stamps as microseconds, so that no value changes on its way."""
    kinds = {f.name: f.dataType.typeName() for f in df.schema.fields}
    return F.to_json(
        F.struct(*[(F.unix_micros(c) if kinds[c] == "timestamp" else F.col(c)).alias(c) for c in columns]),
        {"ignoreNullFields": "false"},
    )


def unpacked(rows, schema, columns):
    """`payload` of `rows` as columns again, with their types in `schema`."""
    kinds = {f.name: f.dataType for f in schema.fields}
    stamps = [c for c in columns if kinds[c].typeName() == "timestamp"]
    types = ", ".join(f"`{c}` {'bigint' if c in stamps else kinds[c].simpleString()}" for c in columns)
    back = F.from_json("payload", types)
    found = rows.withColumn("_back", back)
    values = {c: F.timestamp_micros(f"_back.{c}") if c in stamps else F.col(f"_back.{c}") for c in columns}
    return found.withColumns(values).drop("_back", "payload")


def _earlier(rows, others):
    """Whether each row comes before the other array's row at its place, by all columns in turn."""
    result = np.zeros(len(rows), bool)
    for one, two in zip(reversed(rows.T), reversed(others.T), strict=True):
        result = (one < two) | ((one == two) & result)
    return result


def packed_by_bucket(names):
    """For `mapInArrow`: rows with a bucket as a row for each bucket of a chunk, with a list for each column."""

    def listed(held):
        rows = pa.Table.from_batches(held).sort_by("bucket")
        bucket = rows["bucket"].to_numpy()
        first = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]])
        bounds = pa.array(np.r_[first, len(bucket)], pa.int32())
        lists = [pa.ListArray.from_arrays(bounds, pa.concat_arrays(rows[c].chunks)) for c in names]
        return pa.RecordBatch.from_arrays([pa.array(bucket[first]), *lists], ["bucket", *names])

    def pack(batches):
        held, rows = [], 0
        for batch in batches:
            if batch.num_rows:
                held.append(batch)
                rows += batch.num_rows
            if rows >= ROWS_PER_CHUNK:
                yield listed(held)
                held, rows = [], 0
        if held:
            yield listed(held)

    return pack


class LatestChanges(StatefulProcessor):
    """Takes (bucket, key, o0.., payload), packed, and gives key, known, payload, changes, late.

    `payload` is that of the key's newest change, or None where the state has a newer one;
    `late` counts changes older than what the state had. Of keys the base does not have
    nothing is kept.
    """

    def __init__(self, n_order):
        self.order = [f"o{i}" for i in range(n_order)]

    def init(self, handle):
        self.kept = handle.getValueState("kept", "rows binary")

    def _read(self):
        """Keys of the bucket and their latest order, a row for each; none where there is no state."""
        state = self.kept.get()
        if state is None:
            return pd.Index([], dtype=object), np.empty((0, len(self.order)), np.int64)
        with pa.ipc.open_stream(state[0]) as stream:
            rows = stream.read_all()
        return pd.Index(rows["key"].to_numpy(), dtype=object), np.column_stack([rows[c].to_numpy() for c in self.order])

    def _write(self, keys, latest):
        columns = {"key": pa.array(keys, pa.string())} | {c: latest[:, i] for i, c in enumerate(self.order)}
        table = pa.table(columns)
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, table.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
            out.write_table(table)
        self.kept.update((sink.getvalue().to_pybytes(),))

    def handleInitialState(self, key, initialState, timerValues):
        keys, latest = self._read()
        more = pd.Index(initialState["key"].unique(), dtype=object).difference(keys, sort=False)
        never = np.full((len(more), len(self.order)), NEVER)
        self._write([*keys, *more], np.concatenate([latest, never]))

    def handleInputRows(self, key, rows, timerValues):
        packs = list(rows)

        def column(name):
            return np.concatenate([np.asarray(part) for pack in packs for part in pack[name]])

        name, payload = column("key"), column("payload")
        order = np.column_stack([column(c) for c in self.order])
        codes, names = pd.factorize(name)
        if (codes < 0).any():  # rows without a key
            payload, order, codes = payload[codes >= 0], order[codes >= 0], codes[codes >= 0]
        keys, kept = self._read()
        place = keys.get_indexer(names)
        known = place >= 0
        before = np.full((len(names), len(self.order)), NEVER)
        before[known] = kept[place[known]]
        late = np.bincount(codes[_earlier(order, before[codes])], minlength=len(names))
        # the last row of each key by its order
        sorted_rows = np.lexsort((*reversed(order.T), codes))
        last = sorted_rows[np.r_[codes[sorted_rows][1:] != codes[sorted_rows][:-1], np.ones(min(len(codes), 1), bool)]]
        newer = ~_earlier(order[last], before)
        changed = known & newer
        if changed.any():
            kept = kept.copy()
            kept[place[changed]] = order[last][changed]
            self._write(keys, kept)
        yield pd.DataFrame(
            {
                "key": names,
                "known": known,
                "payload": np.where(newer | ~known, payload[last], None),
                "changes": np.bincount(codes, minlength=len(names)),
                "late": np.where(known, late, 0),
            }
        )

    def close(self):
        pass


OUTPUT = "key string, known boolean, payload string, changes long, late long"


def latest_by_key(changes, base, key, order, columns, buckets):
    """A stream of `OUTPUT` rows: a row for each key that a micro-batch has changes of."""
    kinds = {f.name: f.dataType.typeName() for f in changes.schema.fields}
    bucket = F.pmod(F.xxhash64(F.col(key).cast("string")), F.lit(buckets)).alias("bucket")
    name = F.col(key).cast("string").alias("key")
    numbers = [_number(F.col(c), kinds[c]).alias(f"o{i}") for i, c in enumerate(order)]
    rows = changes.select(bucket, name, *numbers, _packed(changes, columns).alias("payload"))
    first = base.where(F.col(key).isNotNull()).select(bucket, name)
    names = ["key", *[f"o{i}" for i in range(len(order))], "payload"]
    lists = [f"{n} array<{'string' if n in ('key', 'payload') else 'long'}>" for n in names]
    rows = rows.select("bucket", *names).mapInArrow(packed_by_bucket(names), ", ".join(["bucket long", *lists]))
    return rows.groupBy("bucket").transformWithStateInPandas(
        LatestChanges(len(order)), OUTPUT, "update", "none", first.groupBy("bucket")
    )
