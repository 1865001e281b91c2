"""Many files, each in a folder named after its key: ``key=<value>/part-...``, as Spark's partitioned writer names them.

On a local or mounted file system Hadoop, where it lacks its native library, starts three processes for each file that
Spark's writer makes (permissions of the file, of its checksums and of its folder), which take far longer than the file
does.  There, tasks write the files themselves, as a data source of Spark's: what a failed task has written is never seen,
and the finished folder takes its place by one renaming.  In every other store Spark's own writer makes the files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_FORMAT = "edgeloom_folders"


def _opened(spark: SparkSession, path: str) -> str | None:
    """``path`` as a folder that tasks can open; None in stores that only Spark reaches."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    at = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(where).toUri()
    return at.getPath().rstrip("/") if at.getScheme() == "file" else None


def _source() -> type:
    """The data source; its classes are local so that they travel to the tasks whole."""
    from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

    class Attempt(WriterCommitMessage):
        def __init__(self, folder):
            self.folder = folder

    class Writer(DataSourceArrowWriter):
        """Rows are ``value`` (None: no value) and ``line``, equal values on end."""

        def __init__(self, path, key):
            import os
            import uuid

            self.path, self.key = path, key
            self.staging = f"{os.path.dirname(path)}/_{os.path.basename(path)}.{uuid.uuid4().hex[:12]}"

        def name(self, value):
            import re

            # fixed values: what Spark escapes in names of folders, and its name for no value
            return f"{self.key}=" + (re.sub(r"[\x01-\x1f\"#%'*/:=?\\\x7f{\[\]^]", lambda m: f"%{ord(m[0]):02X}", value) if value else "__HIVE_DEFAULT_PARTITION__")

        def write(self, iterator):
            import os
            import uuid

            import pyarrow.compute as pc

            attempt = f"{self.staging}/{uuid.uuid4().hex}"
            os.makedirs(attempt)
            at, out = None, None
            try:
                for batch in iterator:
                    runs, lines, first = pc.run_end_encode(batch.column(0)), batch.column(1).to_pylist(), 0
                    for value, end in zip(runs.values.to_pylist(), runs.run_ends.to_pylist(), strict=True):
                        name = self.name(value)
                        if name != at:
                            if out:
                                out.close()
                            os.mkdir(f"{attempt}/{name}")
                            at, out = name, open(f"{attempt}/{name}/part-00000.txt", "xb")
                        out.writelines((line or b"") + b"\n" for line in lines[first:end])
                        first = end
            finally:
                if out:
                    out.close()
            return Attempt(attempt)

        def commit(self, messages):
            import os
            import shutil

            whole = f"{self.staging}/whole"
            os.makedirs(whole)
            for message in messages:
                if message:
                    with os.scandir(message.folder) as found:
                        for made in found:
                            os.rename(made.path, f"{whole}/{made.name}")
            open(f"{whole}/_SUCCESS", "wb").close()
            if os.path.exists(self.path):
                os.rename(self.path, f"{self.staging}/old")
            os.rename(whole, self.path)
            shutil.rmtree(self.staging)

        def abort(self, messages):
            import shutil

            shutil.rmtree(self.staging, ignore_errors=True)

    class Folders(DataSource):
        @classmethod
        def name(cls):
            return "edgeloom_folders"

        def writer(self, schema, overwrite):
            return Writer(self.options["path"], self.options["key"])

    return Folders


def one_file_each(lines: DataFrame, path: str, key: str, *order: str) -> None:
    """``line`` of each value of ``key``, in the given order; an older folder ``path`` is replaced.

    All tasks make lines; the lines of one file are sorted (on disk where they don't fit) and written by one task.
    """
    spark = lines.sparkSession
    if lines.schema[key].dataType.simpleString() == "string":  # both go to one folder
        lines = lines.withColumn(key, F.nullif(key, F.lit("")))
    dealt = lines.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), key).sortWithinPartitions(key, *order)
    folder = _opened(spark, path)
    if folder is None:
        dealt.select(key, F.col("line").alias("value")).write.mode("overwrite").option("maxRecordsPerFile", 0).partitionBy(key).text(path)
        return
    if not getattr(spark, "_edgeloom_folders", False):
        spark.dataSource.register(_source())
        spark._edgeloom_folders = True
    rows = dealt.select(F.col(key).cast("string").alias("value"), F.col("line").cast("binary").alias("line"))
    rows.write.format(_FORMAT).mode("overwrite").option("key", key).save(folder)
