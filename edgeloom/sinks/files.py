"""Writers: ordered single-file TSV, chunked TSV, metadata, and plain or gzipped text."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from edgeloom.functions.scalars import date_stamp
from edgeloom.operators.slices import numbered
from edgeloom.operators.template import COLUMNS, document
from edgeloom.sinks.folders import one_file_each
from edgeloom.sources.shared import forget, workspace, written


def _fs(spark: SparkSession, path: str):
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where, where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


#: Quotes are doubled, null and empty cells are blank.
_CELLS = {"sep": "\t", "quote": '"', "escape": '"', "emptyValue": "", "nullValue": ""}


def _options(writer):
    return writer.options(**_CELLS).option("header", True)


def _cells(*values: Column) -> Column:
    """A row's line."""
    return F.to_csv(F.struct(*values), _CELLS)


def _head(columns: list[str]) -> Column:
    return _cells(*[F.lit(c).alias(f"_{i}") for i, c in enumerate(columns)])


def _checkpointed(df: DataFrame) -> tuple[DataFrame, str]:
    """``df`` with its rows on shared storage, partitions and rows in the order that they have, and where they are."""
    context = df.sparkSession.sparkContext
    if not df.sparkSession.conf.get("spark.checkpoint.dir", None):
        context.setCheckpointDir(workspace(df.sparkSession))
    held = df.checkpoint()
    return held, held._jdf.queryExecution().analyzed().rdd().getCheckpointFile().get()


def _put(spark: SparkSession, made, path: str) -> None:
    """The file ``made`` at ``path``; an older one there stays as ``path.old`` until the new one is in place."""
    target, fs = _fs(spark, path)
    old, _ = _fs(spark, path + ".old")
    if fs.exists(target):
        fs.delete(old, True)
        if not fs.rename(target, old):
            raise OSError(f"could not move the old file at {path}")
    if not fs.rename(made, target):
        raise OSError(f"could not put the file at {path}")
    fs.delete(old, True)


def _one_file(rows: DataFrame, order: tuple[str, ...], line: Column, path: str, first: str | None = None, gzip: bool = False) -> None:
    """A line for each row, in the given order, as the file ``path``, after the line ``first``.

    Rows are made once, into a table that the order's ranges are then sampled from.  All tasks sort and make lines; these go
    to shared storage in order, and the one task that writes the file only copies them.  Neither copy stays.
    """
    spark, work = rows.sparkSession, path + ".parts"
    table = written(rows, "rows") if order else rows
    held, where = _checkpointed((table.orderBy(*order) if order else table).select(line.alias("line")))
    if order:
        forget(table)
    if first is not None:
        held = spark.range(1).select(F.lit(first).alias(held.columns[0])).union(held)
    try:
        writer = held.coalesce(1).write.mode("overwrite")
        (writer.option("compression", "gzip") if gzip else writer).text(work)
    finally:
        at, fs = _fs(spark, where)
        fs.delete(at, True)
    source, fs = _fs(spark, work)
    _put(spark, next(s.getPath() for s in fs.listStatus(source) if s.getPath().getName().startswith("part-")), path)
    fs.delete(source, True)


def tsv(df: DataFrame, path: str, *order: str, drop: tuple[str, ...] = ()) -> None:
    """One file with a header, its rows in the given order; an older file is replaced at the end.

    Write :func:`tsv_folder` instead where one file isn't required.
    """
    columns = [c for c in df.columns if c not in drop]
    head = df.sparkSession.range(1).select(_head(columns).alias("line")).first()["line"]
    _one_file(df, order, _cells(*[F.col(f"`{c}`") for c in columns]), path, head)


def template_tsv(template: DataFrame, path: str, order: str) -> None:
    """A template made with an order column: the directive row first."""
    columns = [c for c in COLUMNS if c in template.columns]
    tsv(template, path, order, *columns, drop=(order,))


def tsv_folder(df: DataFrame, path: str) -> None:
    """A folder of files, each with a header, written by all tasks."""
    _options(df.write.mode("overwrite")).csv(path)


def chunked_tsv(df: DataFrame, path: str, size: int, *order: str) -> None:
    """Files of a header and ``size`` rows, in their order, in folders ``chunk=n`` under a dated folder."""
    stamp = df.sparkSession.range(1).select(date_stamp().alias("d")).first()["d"]
    chunk = F.floor(F.col("_number") / size).cast("bigint").alias("chunk")
    line = _cells(*[F.col(f"`{c}`") for c in df.columns])
    headed = F.when(F.col("_number") % size == 0, F.concat(_head(df.columns), F.lit("\n"), line)).otherwise(line)
    one_file_each(numbered(df, *order, name="_number").select(chunk, "_number", headed.alias("line")), f"{path}_{stamp}", "chunk", "_number")


def lines(df: DataFrame, path: str, gzip: bool = False) -> None:
    """A text column as lines."""
    writer = df.write.mode("overwrite")
    (writer.option("compression", "gzip") if gzip else writer).text(path)


def ontology(template_rows: DataFrame, path: str, iri: str, gzip: bool = True, prefixes: dict[str, str] | None = None) -> None:
    """Template rows as one document in functional syntax, ``path`` or with ``gzip`` ``path.gz``.

    Prefixes and the ontology's name come first, then declarations of each individual and of the property, then the
    assertions and the closing bracket.  The name follows the rule ``connectome_*.owl``.
    """
    name = path.rstrip("/").rsplit("/", 1)[-1]
    if not (name.startswith("connectome_") and name.endswith(".owl")):
        raise ValueError("an ontology's name must be connectome_*.owl")
    _one_file(document(template_rows, iri, prefixes), ("part", "value"), F.col("value"), path + ".gz" * gzip, gzip=gzip)


def metadata(spark: SparkSession, path: str, **fields: str) -> None:
    """``key: value`` lines, such as DataSet, Curator, Template and Imaging_type."""
    for key, value in fields.items():
        if "\n" in key + value:
            raise ValueError("a field is one line")
    target, fs = _fs(spark, path)
    out = fs.create(target, True)
    out.write(bytearray("".join(f"{k}: {v}\n" for k, v in fields.items()), "utf-8"))
    out.close()


def metadata_files(df: DataFrame, path: str, key: str) -> None:
    """A file of ``key: value`` lines for each row, in a folder named after its ``key`` column; null fields have no line."""
    fields = [c for c in df.columns if c != key]
    lines = F.array_compact(F.array(*[F.concat(F.lit(f"{c}: "), F.regexp_replace(F.col(f"`{c}`").cast("string"), r"\s*[\r\n]+\s*", " ")) for c in fields]))
    one_file_each(df.select(key, F.array_join(lines, "\n").alias("line")), path, key, "line")


def deletions(plan: DataFrame) -> DataFrame:
    """Folder and file name pattern to delete before files are made anew; :func:`delete_planned` carries it out."""
    return plan.filter("delete_first").select("folder", F.explode(F.array(F.lit("volume*"), F.lit("thumbnail*"))).alias("pattern"))


def delete_planned(plan: DataFrame, log: str, batch: int = 1000) -> int:
    """Deletes the files of :func:`deletions` and says how many; each is named in a file of the folder ``log``.

    Folders come to the driver in turn, never all at once.  The log of a batch is written before the next batch begins, so
    what an interrupted run has deleted is known; run again, it deletes what is left and nothing twice.  Only files right in
    a folder are deleted; a folder that isn't there is no error, and one without a name or the root of a store is.
    """
    spark, done, lines = plan.sparkSession, 0, []

    def note() -> None:
        if lines:
            target, fs = _fs(spark, f"{log}/deleted-{uuid.uuid4().hex[:12]}.txt")
            out = fs.create(target, False)
            out.write(bytearray("".join(f"{x}\n" for x in lines), "utf-8"))
            out.close()
            lines.clear()

    try:
        for row in deletions(plan).toLocalIterator():
            folder = (row["folder"] or "").rstrip("/")
            if not folder or folder.endswith(":"):
                raise ValueError("a planned deletion names no folder")
            where, fs = _fs(spark, f"{folder}/{row['pattern']}")
            for found in fs.globStatus(where) or ():
                if found.isFile() and fs.delete(found.getPath(), False):
                    lines.append(found.getPath().toString())
                    done += 1
            if len(lines) >= batch:
                note()
    finally:
        note()
    return done
