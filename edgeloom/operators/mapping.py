"""Identifier mapping."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from edgeloom.operators import graph
from edgeloom.sources.shared import written


def first_xref(xrefs: DataFrame, key: str = "accession", value: str = "vfb_id") -> DataFrame:
    """One value per key: the least.  A map with several values per key would multiply the rows that it is joined to."""
    return xrefs.filter(F.col(key).isNotNull()).groupBy(key).agg(F.min(value).alias(value))


def xrefs_of_site(rels: DataFrame, site: str) -> DataFrame:
    """accession and vfb_id of everything that a site refers to."""
    found = graph.undirected(graph.of_type(rels, *graph.XREF_TYPES), "accession").filter(F.col("there") == site)
    return found.select(graph.first_item(F.col("accession")).alias("accession"), F.col("here").alias("vfb_id")).filter("accession IS NOT NULL")


def mapped(edges: DataFrame, xrefs: DataFrame, *columns: str) -> DataFrame:
    """Columns (source and target by default) as mapped ids; what isn't mapped becomes null, and no row is lost or doubled."""
    unique = first_xref(xrefs)
    for c in columns or ("source", "target"):
        table = unique.select(F.col("accession").alias("_key"), F.col("vfb_id").alias("_value"))
        edges = edges.join(table, F.col(c).cast("string") == F.col("_key"), "left").withColumn(c, F.col("_value")).drop("_key", "_value")
    return edges


def unmapped(edges: DataFrame, xrefs: DataFrame) -> DataFrame:
    """Distinct ids of either end that have no mapping."""
    ends = edges.select(F.explode(F.array("source", "target")).alias("id")).filter("id IS NOT NULL").distinct()
    return ends.join(xrefs.select(F.col("accession").alias("_key")), F.col("id").cast("string") == F.col("_key"), "left_anti")


def current_roots(annotations: DataFrame, supervoxels: DataFrame, snapshot: str | None = None) -> DataFrame:
    """``annotations`` with ``mapped_root``, the root of their supervoxel in a snapshot; null where there is none."""
    table = supervoxels if snapshot is None else supervoxels.filter(F.col("snapshot") == snapshot)
    unique = table.groupBy(F.col("supervoxel_id").alias("_supervoxel")).agg(F.min("root_id").alias("mapped_root"))
    return annotations.join(unique, F.col("supervoxel_id") == F.col("_supervoxel"), "left").drop("_supervoxel")


def roots_as_of(annotations: DataFrame, history: DataFrame) -> DataFrame:
    """``annotations`` (``supervoxel_id``, ``at``) with ``root`` and ``since``: the newest root not after ``at`` and its time.

    ``history`` has ``supervoxel_id``, ``time`` and ``root_id``.  Of several roots at one time the least counts; a null root
    ends the one before, so that ``root`` is null and ``since`` its time; both are null where nothing is known yet, or where
    the id or the time is null.

    Both tables are sorted together by id and time in ranges, so that one id's long history is spread over tasks, and a
    range's rows look back within it.  Only a range's first id can go on from earlier ranges; what is known of it there
    comes from one row of each range.  Equal questions are asked once.
    """
    c = F.col
    known = history.filter("supervoxel_id IS NOT NULL AND time IS NOT NULL").groupBy(c("supervoxel_id").alias("key"), c("time").alias("t")).agg(F.min("root_id").alias("root"))
    asked = annotations.select(c("supervoxel_id").alias("key"), c("at").alias("t")).filter("key IS NOT NULL AND t IS NOT NULL").distinct()
    both = known.select("key", "t", F.struct(c("root"), c("t").alias("since")).alias("fact")).unionByName(asked, allowMissingColumns=True)
    n = int(annotations.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    held = written(both.repartitionByRange(n, "key", "t").withColumn("span", F.spark_partition_id()), "as-of")
    # a row for each range
    ends = held.groupBy("span").agg(F.min("key").alias("first"), F.max("key").alias("last"))
    newest = held.join(F.broadcast(ends.select("span", "last")), "span").filter((c("key") == c("last")) & c("fact").isNotNull()).groupBy("span").agg(F.max_by("fact", "t").alias("fact"))
    marks = ends.select("span", c("first").alias("key"), F.lit(0).alias("end"), F.lit(None).cast(held.schema["fact"].dataType).alias("fact")).unionByName(
        ends.join(newest, "span", "left").select("span", c("last").alias("key"), F.lit(1).alias("end"), "fact")
    )
    carried = marks.withColumn("carried", F.last("fact", True).over(Window.partitionBy("key").orderBy("span", "end"))).filter("end = 0").select("span", c("key").alias("first"), "carried")
    within = F.last("fact", True).over(Window.partitionBy("span", "key").orderBy("t", c("fact").isNull()))
    found = held.withColumn("seen", within).filter("fact IS NULL").join(F.broadcast(carried), "span")
    found = found.select("key", "t", F.coalesce("seen", F.when(c("key") == c("first"), c("carried"))).alias("fact")).select(c("key").alias("_key"), c("t").alias("_t"), c("fact.root").alias("root"), c("fact.since").alias("since"))
    return annotations.drop("root", "since").join(found, (c("supervoxel_id") == c("_key")) & (c("at") == c("_t")), "left").drop("_key", "_t")
