"""Functions over Arrow batches whose modules reach every executor."""

import ctypes
import os
import tempfile
import zipfile

import pyarrow as pa

import pricetide

_shipped = set()
#: Rows in an Arrow batch at most. Executor and worker both hold whole batches, and texts are long.
BATCH_ROWS, _ROWS_SETTING, _SPARKS_OWN = 2_000, "spark.sql.execution.arrow.maxRecordsPerBatch", "10000"


def ship(spark):
    """Hand this package to the session's executors, once for each application."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    top = os.path.dirname(os.path.abspath(pricetide.__file__))
    folder = tempfile.mkdtemp(prefix="pricetide-")
    path = os.path.join(folder, "pricetide_package.zip")
    with zipfile.ZipFile(path, "w") as out:
        for where, _, names in os.walk(top):
            for name in sorted(names):
                if name.endswith(".py"):
                    full = os.path.join(where, name)
                    out.write(full, os.path.relpath(full, os.path.dirname(top)))
    context.addPyFile(path)  # read by Spark now and fetched from the driver by each executor
    _shipped.add(context.applicationId)


def hand_back_memory():
    """Give memory that is free again back to the system.

    Worker processes outlive their tasks; what they keep for themselves would be missing
    in the executor while it runs stages without Python.
    """
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # only glibc has it
    if trim is not None:
        trim(0)


def map_batches(df, function, schema):
    """`function` over the Arrow batches of each partition; workers hand back memory at a task's end.

    Where the session has Spark's own batch size, it gets `BATCH_ROWS`.
    """
    conf = df.sparkSession.conf
    if conf.get(_ROWS_SETTING) == _SPARKS_OWN:
        conf.set(_ROWS_SETTING, str(BATCH_ROWS))

    def run(batches):
        yield from function(batches)
        hand_back_memory()

    ship(df.sparkSession)
    return df.mapInArrow(run, schema)
