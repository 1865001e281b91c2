"""What changed between two versions of an edge table.

A version is stored once in buckets of its pair, sorted; comparing two of them joins bucket with bucket, so nothing is
shuffled, however often versions are compared.  Pairs are unique, so no bucket is hot.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from edgeloom.operators.edges import summed

#: Versions that are compared need the same number; a bucket is a task, so 100 GB of edges make buckets of about 100 MB.
BUCKETS = 1024


def stored(edges: DataFrame, name: str, buckets: int = BUCKETS, path: str | None = None) -> DataFrame:
    """``edges`` summed by pair as the table ``name``, one file a bucket; pairs with a null end are dropped.

    ``path`` is where its files go; the warehouse is where they go otherwise.
    """
    dealt = summed(edges).repartition(buckets, "source", "target")
    writer = dealt.write.mode("errorifexists").format("parquet").bucketBy(buckets, "source", "target").sortBy("source", "target")
    (writer.option("path", path) if path else writer).saveAsTable(name)
    return edges.sparkSession.table(name)


def changes(old: DataFrame, new: DataFrame) -> DataFrame:
    """``source``, ``target``, ``change`` (added, removed or changed), ``before`` and ``after`` of pairs whose weights differ."""
    named = lambda df, n: df.select("source", "target", F.col("weight").alias(n), F.lit(True).alias(f"_{n}"))
    both = named(old, "before").join(named(new, "after"), ["source", "target"], "full_outer")
    kind = F.when(F.col("_before").isNull(), "added").when(F.col("_after").isNull(), "removed").otherwise("changed")
    return both.filter(~F.col("before").eqNullSafe(F.col("after")) | F.col("_before").isNull() | F.col("_after").isNull()).select("source", "target", kind.alias("change"), "before", "after")


def except_pairs(old: DataFrame, new: DataFrame) -> DataFrame:
    """Edges of ``new`` whose pair ``old`` doesn't have."""
    return new.join(old.select("source", "target"), ["source", "target"], "left_anti")
