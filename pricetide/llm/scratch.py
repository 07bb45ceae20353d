"""Intermediate tables of one operator, removed as soon as nothing reads them."""

from pyspark.sql import functions as F

from pricetide.workspace import shared_folder


class Scratch:
    """Tables in the shared folder. `clear` removes all but those still named as needed."""

    def __init__(self, spark):
        self.spark = spark
        self.paths = {}

    def write(self, df, purpose):
        """Write `df`, read it back and so cut its lineage."""
        path = shared_folder(self.spark, purpose)
        df.write.parquet(path)
        back = self.spark.read.schema(df.schema).parquet(path)
        self.paths[id(back)] = (path, back)
        return back

    def clear(self, *needed):
        keep = {id(x) for x in needed}
        jvm = self.spark.sparkContext._jvm
        hadoop = self.spark.sparkContext._jsc.hadoopConfiguration()
        for name, (path, _) in list(self.paths.items()):
            if name not in keep:
                place = jvm.org.apache.hadoop.fs.Path(path)
                place.getFileSystem(hadoop).delete(place, True)
                del self.paths[name]


def send_if_small(written, max_rows):
    """Mark a written table for broadcast when it has at most `max_rows` rows.

    The rows are counted in the files' footers, nothing is brought to the driver. A larger
    table is left to a join that shuffles.
    """
    return F.broadcast(written) if written.count() <= max_rows else written
