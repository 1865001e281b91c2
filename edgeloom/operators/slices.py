"""Batches, chunks and slices with a stated order.

Global numbers come from a range partitioning that is written once and from its ranges' sizes, never from one task that
sees every row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from edgeloom.sources.shared import written

#: Bits of a row's place within its range in ``monotonically_increasing_id``.
_PLACE_BITS = 33


def numbered(df: DataFrame, *order: str, name: str = "number") -> DataFrame:
    """``df`` with consecutive numbers from 0 in the given order, which should be total.

    Rows are dealt by ranges of the order, sorted, and written with their range and place; each range is moved up by the
    sizes of those before it.  Ranges differ between two plans of one sample, so both the rows and the sizes are read from
    the one written table.  Nulls come first; an empty table has no numbers.
    """
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = df.repartitionByRange(n, *order).sortWithinPartitions(*order)
    held = written(ranged.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"), F.monotonically_increasing_id().alias("at")), "numbered")
    span = F.shiftright("at", _PLACE_BITS).alias("span")
    # a row for each range
    sizes = held.groupBy(span).agg(F.count(F.lit(1)).alias("n"))
    before = sizes.select("span", (F.sum("n").over(Window.orderBy("span")) - F.col("n")).alias("before"))
    placed = held.withColumn("span", span).join(F.broadcast(before), "span", "left")
    base = F.coalesce("before", F.raise_error(F.lit("a range of rows has no size")).cast("bigint"))
    return placed.select("row.*", (base + F.col("at").bitwiseAND(F.lit((1 << _PLACE_BITS) - 1))).alias(name))


def batches(df: DataFrame, size: int, *order: str, name: str = "batch") -> DataFrame:
    """``df`` with batch numbers from 0, ``size`` rows each."""
    return numbered(df, *order, name="_number").withColumn(name, F.floor(F.col("_number") / size).cast("bigint")).drop("_number")


def chunks_per_group(df: DataFrame, group: str, size: int, *order: str, name: str = "chunk") -> DataFrame:
    """Chunk numbers from 0 within each group; null is a group.

    Numbers run over the whole table, group by group, so a group of any size is spread over tasks; each row's is counted
    from the group's least.
    """
    found = written(numbered(df, group, *order, name="_number"), "groups")
    first = found.groupBy(F.col(group).alias("_group")).agg(F.min("_number").alias("_first"))
    joined = found.join(first, found[group].eqNullSafe(first["_group"]))
    return joined.withColumn(name, F.floor((F.col("_number") - F.col("_first")) / size).cast("bigint")).drop("_number", "_group", "_first")


def rows_between(df: DataFrame, first: int, last: int, *order: str) -> DataFrame:
    """Rows ``first`` to ``last - 1`` in the given order."""
    return df.orderBy(*order).offset(first).limit(last - first)


def preview(df: DataFrame, n: int, *order: str) -> DataFrame:
    return df.orderBy(*order).limit(n)
