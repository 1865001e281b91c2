"""Intermediate tables in the folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession


#: Lists that :func:`written` notes its paths in; each thread has its own.
_noted: ContextVar[tuple[list[str], ...]] = ContextVar("noted", default=())


def workspace(spark: SparkSession) -> str:
    """The shared folder, from ``spark.checkpoint.dir``.

    Where it is unset, a session within one machine's process (``local`` or ``local[n]``) gets a temporary folder and any
    other session a folder in its warehouse; a machine-local folder is never used on a cluster.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    context = spark.sparkContext
    known = getattr(context, "_edgeloom_workspace", None)
    if known is None:
        if context.master == "local" or context.master.startswith("local["):
            known = "file://" + tempfile.mkdtemp(prefix="edgeloom-")
        else:
            known = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_edgeloom"
        context._edgeloom_workspace = known
    return known


def fresh_folder(spark: SparkSession, name: str) -> str:
    """A path in the workspace that nothing has used."""
    return f"{workspace(spark)}/edgeloom/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex[:12]}"


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table in the shared folder: cuts lineage and survives lost executors."""
    spark, path = df.sparkSession, fresh_folder(df.sparkSession, name)
    df.write.parquet(path)
    found = spark.read.schema(df.schema).parquet(path)
    found._edgeloom_path = path
    for paths in _noted.get():
        paths.append(path)
    return found


@contextmanager
def noted() -> Iterator[list[str]]:
    """The paths of the tables that :func:`written` makes inside."""
    paths: list[str] = []
    before = _noted.set((*_noted.get(), paths))
    try:
        yield paths
    finally:
        _noted.reset(before)


def _delete(spark: SparkSession, path: str) -> None:
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def forget_paths(spark: SparkSession, paths: list[str]) -> None:
    """Deletes tables by their paths; one that is gone already is no error."""
    for path in paths:
        _delete(spark, path)


def forget(*tables: DataFrame) -> None:
    """Deletes tables that :func:`written` gave and nothing reads any more."""
    for table in tables:
        _delete(table.sparkSession, table._edgeloom_path)


def clean_up(spark: SparkSession) -> None:
    """Deletes what :func:`written` left for this application; its tables can't be read afterwards."""
    _delete(spark, f"{workspace(spark)}/edgeloom/{spark.sparkContext.applicationId}")
