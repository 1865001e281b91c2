"""Shards that all have the mixture of the whole: proportional stratified interleaving, in DataFrame functions alone.

Rows are shuffled by a seeded hash and ranked within their stratum (source); rank r of n becomes the fraction
``(r + 1/2) / n``.  In the order of fractions every stretch holds each stratum in its share, so the order is cut into
shards of equal row counts: shard ``floor(place * shards / rows)``, whose rows keep the order as their slots.

No rank is counted in one task.  A stratum is cut into ranges of the hash and the order into ranges of the fraction;
each row is ranked within its range and moved up by the sizes of those before.  Ranges are made so that they hold about
``RANGE_ROWS`` rows each, and the more rows there are the more ranges (at most ``MOST_RANGES``), whatever share a
stratum has.  Texts are read once, for their size and checksum, and never shuffled.

Defined cases: null text has size ``overhead`` and the checksum of no bytes; a null stratum is a stratum; rows with equal
ids are told apart by checksum and size, and rows equal in all of these are interchangeable.  Equal texts aren't held
together: with row counts at most one apart no shard could hold a large group.  No row gives no shard.  Extra columns
are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from edgeloom.llm.common import forget, written

RANGE_ROWS = 256
MOST_RANGES = 1 << 16


def _ranges(rows: int) -> int:
    """A power of two of about a range for each ``RANGE_ROWS`` rows."""
    return min(MOST_RANGES, 1 << max(0, (rows // RANGE_ROWS).bit_length()))


def _before(sizes: DataFrame, *of: str) -> DataFrame:
    """``sizes`` (``span``, ``n``) with the rows ``before`` each span and, of each ``of``, the ``total``."""
    held = Window.partitionBy(*of)
    return sizes.withColumn("before", F.sum("n").over(held.orderBy("span")) - F.col("n")).withColumn("total", F.sum("n").over(held))


def interleave(docs: DataFrame, shards: int, seed: int = 0, stratum: str = "source", overhead: int = 16) -> DataFrame:
    """``doc_id``, ``stratum``, ``size``, ``text_crc32``, ``shard`` and ``slot`` of each row."""
    data = F.coalesce("text", F.lit("")).cast("binary")
    shuffled = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256)
    narrow = docs.select("doc_id", F.col(stratum).alias("stratum"), (F.octet_length(data) + overhead).cast("long").alias("size"), F.crc32(data).alias("text_crc32"), F.substring(shuffled, 1, 32).alias("key"))
    # a null stratum gets a key of its own, so that joins need no case for it
    narrow = written(narrow.withColumn("of", F.coalesce(F.concat(F.lit("="), F.col("stratum").cast("string")), F.lit(""))), "narrow")
    rows = narrow.count()
    ranges = _ranges(rows)
    # the first 16 bits of the shuffle, as many ranges of them as there are
    bits = F.conv(F.substring("key", 1, 4), 16, 10).cast("long")
    spans = narrow.withColumn("span", F.floor(bits * ranges / 65536).cast("long"))
    sizes = _before(spans.groupBy("of", "span").agg(F.count(F.lit(1)).alias("n")), "of")
    order = Window.partitionBy("of", "span").orderBy("key", "doc_id", "text_crc32", "size")
    ranked = spans.withColumn("rank", F.row_number().over(order)).join(sizes, ["of", "span"])
    fraction = (F.col("before") + F.col("rank") - F.lit(0.5)) / F.col("total")
    ranked = ranked.select("doc_id", "stratum", "size", "text_crc32", "of", "key", fraction.alias("fraction"))
    ranked = written(ranked.withColumn("span", F.floor(F.col("fraction") * ranges).cast("long")), "fractions")
    forget(narrow)
    # a row for each range, so at most MOST_RANGES rows
    starts = _before(ranked.groupBy("span").agg(F.count(F.lit(1)).alias("n"))).select("span", "before")
    order = Window.partitionBy("span").orderBy("fraction", "of", "key", "doc_id", "text_crc32", "size")
    placed = ranked.withColumn("rank", F.row_number().over(order)).join(F.broadcast(starts), "span").withColumn("place", F.col("before") + F.col("rank") - 1)
    shard = F.expr(f"cast(place * {shards} div {max(rows, 1)} as int)")
    first = F.expr(f"(cast(shard as bigint) * {rows} + {shards - 1}) div {shards}")
    return placed.withColumn("shard", shard).select("doc_id", "stratum", "size", "text_crc32", "shard", (F.col("place") - first).alias("slot"))
