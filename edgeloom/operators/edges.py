"""Weighted edges (source, target, weight) induced on a registry.

Semi-joins stand before aggregations, so that edges outside the registry are never shuffled for grouping.  A registry
carries no broadcast hint: Spark broadcasts it while its measured size is under the session's threshold and shuffles
both sides otherwise, splitting hub neurons' partitions at run time.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from edgeloom.sources.schemas import require

NAMES = {
    "bodyId_pre": "source",
    "bodyId_post": "target",
    "pre": "source",
    "post": "target",
    "pre_pt_root_id": "source",
    "post_pt_root_id": "target",
    "pre_root_id": "source",
    "post_root_id": "target",
    "num_synapses": "weight",
}


def renamed(edges: DataFrame, **names: str) -> DataFrame:
    """Columns under the names of the edge contract."""
    return edges.withColumnsRenamed({k: v for k, v in (NAMES | names).items() if k in edges.columns})


def within(edges: DataFrame, ids: DataFrame, *ends: str) -> DataFrame:
    """Edges whose ``ends`` (source and target by default) are all in the one-column table ``ids``."""
    key = ids.columns[0]
    for end in ends or ("source", "target"):
        inside = ids.select(F.col(key).alias("_inside")).distinct()
        edges = edges.join(inside, F.col(end) == F.col("_inside"), "left_semi")
    return edges


def over(edges: DataFrame, threshold: float | None) -> DataFrame:
    """Edges whose weight is over (not at) the threshold; null weights never are.  No threshold only drops null weights."""
    return edges.filter(F.col("weight").isNotNull() if threshold is None else F.col("weight") > threshold)


def without_background(edges: DataFrame, background: int = 0) -> DataFrame:
    """Edges that don't touch the background id."""
    return edges.filter((F.col("source") != background) & (F.col("target") != background))


def summed(edges: DataFrame) -> DataFrame:
    """Weights summed by pair; pairs with a null end are dropped and a pair of null weights sums to 0."""
    keyed = edges.filter("source IS NOT NULL AND target IS NOT NULL")
    return keyed.groupBy("source", "target").agg(F.coalesce(F.sum("weight"), F.lit(0)).cast("bigint").alias("weight"))


def counted(synapses: DataFrame) -> DataFrame:
    """Synapses counted by pair; rows with a null end are dropped."""
    keyed = synapses.filter("source IS NOT NULL AND target IS NOT NULL")
    return keyed.groupBy("source", "target").agg(F.count(F.lit(1)).alias("weight"))


def from_regions(edges: DataFrame, ids: DataFrame, threshold: int = 1) -> DataFrame:
    """Per-region edges: both ends in the registry, regions collapsed, total over the threshold."""
    require(edges, "bodyId_pre", "bodyId_post", "weight")
    return over(summed(within(renamed(edges), ids)), threshold)


def from_pairs(edges: DataFrame, ids: DataFrame, threshold: int = 0) -> DataFrame:
    """Edges of a tracing service: already by pair."""
    require(edges, "source", "target", "weight")
    return over(within(edges, ids), threshold)


def from_downstream(edges: DataFrame, ids: DataFrame, threshold: int = 0, flags: tuple[str, ...] = ()) -> DataFrame:
    """Downstream edges of the registry; ``flags`` are boolean columns that must hold (filtered, clean, proofread)."""
    for flag in flags:
        edges = edges.filter(F.col(flag))
    return over(within(renamed(edges).select("source", "target", "weight"), ids), threshold)


def from_synapses(synapses: DataFrame, ids: DataFrame, threshold: int = 0) -> DataFrame:
    """Single synapses: both ends in the registry, counted by pair, count over the threshold."""
    require(synapses, "pre_pt_root_id", "post_pt_root_id")
    return over(counted(within(renamed(synapses), ids)), threshold)


def from_file(edges: DataFrame, ids: DataFrame, threshold: int = 0, background: int | None = None) -> DataFrame:
    """A pre-aggregated edge file; the threshold only applies above 0, and reaches the Parquet scan."""
    require(edges, "pre_root_id", "post_root_id", "num_synapses")
    held = over(renamed(edges).select("source", "target", "weight"), threshold if threshold > 0 else None)
    return within(held if background is None else without_background(held, background), ids)


def strengths(edges: DataFrame) -> DataFrame:
    """node, outgoing and incoming weight, and degrees, in one aggregation over both ends of each edge."""
    ends = edges.select(
        F.explode(F.array(F.struct(F.col("source").alias("node"), F.lit(True).alias("out")), F.struct(F.col("target").alias("node"), F.lit(False).alias("out")))).alias("end"), "weight"
    ).select("end.*", "weight")
    part = lambda out: F.coalesce(F.sum(F.when(F.col("out") == out, F.col("weight"))), F.lit(0)).cast("bigint")
    return ends.filter("node IS NOT NULL").groupBy("node").agg(part(True).alias("outgoing"), part(False).alias("incoming"), F.count_if("out").alias("out_degree"), F.count_if(~F.col("out")).alias("in_degree"))


def in_volume(edges: DataFrame, volume: str) -> DataFrame:
    """Edges of one volume, summed by pair, without those that are 0."""
    return summed(edges.filter(F.col("volume") == volume)).filter("weight != 0")


def unpivoted(matrix: DataFrame, node: str = "source") -> DataFrame:
    """An adjacency matrix (a column per target) as edges; nulls are no edges, zeros are."""
    targets = [c for c in matrix.columns if c != node]
    return matrix.unpivot(node, targets, "target", "weight").filter("weight IS NOT NULL")
