"""Where intermediate tables go: the folder every executor shares."""

import atexit
import shutil
import tempfile
import uuid

_local_folder = None


def shared_folder(spark, purpose):
    """A new, unused path under `spark.checkpoint.dir`.

    Where the setting is missing a temporary folder stands in, but only for a
    local master: a cluster has to name a folder its executors can all reach.
    """
    global _local_folder
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        if _local_folder is None:
            _local_folder = tempfile.mkdtemp(prefix="pricetide-")
            atexit.register(shutil.rmtree, _local_folder, ignore_errors=True)
        base = _local_folder
    return f"{base.rstrip('/')}/pricetide/{purpose}-{uuid.uuid4().hex}"


def stage(df, purpose):
    """Write `df` to the shared folder and read it back, cutting its lineage."""
    path = shared_folder(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def exists(spark, path):
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(place)
