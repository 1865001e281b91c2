"""Mergeable summaries of a neuron's partners and weights.

A summary is a row for each node: a HyperLogLog sketch of its partners, a KLL sketch of its weights, and exact sums.  One
is made for each snapshot or day of synapses and stored; summaries merge in any order without the edges being read again.

With ``LG_K`` of 12 a count of partners has a relative standard error of 1.6 % and is exact for small ones; with ``KLL_K`` of
200 a weight's rank is off by at most 1.33 % of all (99 times in 100) and is exact for up to 200 edges.

Where results must be exact, a summary is a table of counts instead (:func:`counted`): a row for each node, partner and
weight.  It merges in the same way, but grows with the distinct edges.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

LG_K = 12
KLL_K = 200


def summarised(edges: DataFrame, node: str = "source", partner: str = "target") -> DataFrame:
    """``node``, ``partners``, ``weights`` (sketches), ``edges`` and ``total``; rows with a null end are dropped, and null weights count as no weight."""
    held = edges.filter(F.col(node).isNotNull() & F.col(partner).isNotNull())
    return held.groupBy(F.col(node).alias("node")).agg(
        F.hll_sketch_agg(F.col(partner), LG_K).alias("partners"), F.kll_sketch_agg_bigint(F.col("weight").cast("bigint"), KLL_K).alias("weights"),
        F.count(F.lit(1)).alias("edges"), F.coalesce(F.sum("weight"), F.lit(0)).cast("bigint").alias("total"),
    )


def merged(*summaries: DataFrame) -> DataFrame:
    """One summary of several."""
    both = reduce(DataFrame.unionByName, summaries)
    return both.groupBy("node").agg(F.hll_union_agg("partners").alias("partners"), F.kll_merge_agg_bigint("weights").alias("weights"), F.sum("edges").alias("edges"), F.sum("total").cast("bigint").alias("total"))


def estimates(summary: DataFrame, ranks: tuple[float, ...] = (0.5, 0.9)) -> DataFrame:
    """``node``, ``n_partners``, ``edges``, ``total``, and for each rank the least weight that so many weights don't exceed (``weight_50``)."""
    some = F.kll_sketch_get_n_bigint("weights") > 0
    at = [F.when(some, F.kll_sketch_get_quantile_bigint("weights", F.lit(r))).alias(f"weight_{round(r * 100)}") for r in ranks]
    return summary.select("node", F.hll_sketch_estimate("partners").alias("n_partners"), "edges", "total", *at)


def counted(edges: DataFrame, node: str = "source", partner: str = "target") -> DataFrame:
    """``node``, ``partner``, ``weight`` and ``edges``, how many there are: an exact summary; rows with a null end are dropped."""
    held = edges.filter(F.col(node).isNotNull() & F.col(partner).isNotNull())
    return held.groupBy(F.col(node).alias("node"), F.col(partner).alias("partner"), F.col("weight").cast("bigint").alias("weight")).agg(F.count(F.lit(1)).alias("edges"))


def merged_counts(*summaries: DataFrame) -> DataFrame:
    """One exact summary of several."""
    return reduce(DataFrame.unionByName, summaries).groupBy("node", "partner", "weight").agg(F.sum("edges").alias("edges"))


def exact(summary: DataFrame, ranks: tuple[str, ...] = ("0.5", "0.9")) -> DataFrame:
    """What :func:`estimates` gives, exactly, from counts; ranks are decimal texts, so that no rounding moves them.

    Weights are counted up in their order, node by node: no list of a node's partners or weights is held.
    """
    c = F.col
    partners = summary.groupBy("node", "partner").agg(F.sum("edges").alias("edges"), F.sum(c("weight") * c("edges")).alias("total"))
    sums = partners.groupBy("node").agg(F.count(F.lit(1)).alias("n_partners"), F.sum("edges").alias("edges"), F.coalesce(F.sum("total"), F.lit(0)).cast("bigint").alias("total"))
    weights = summary.filter("weight IS NOT NULL").groupBy("node", "weight").agg(F.sum("edges").alias("n"))
    each = Window.partitionBy("node")
    placed = weights.select("node", "weight", F.sum("n").over(each.orderBy("weight")).alias("upto"), F.sum("n").over(each).alias("all"))
    at = lambda r: F.min(F.when(c("upto") >= F.ceil(c("all").cast("decimal(19,0)") * F.lit(r).cast("decimal(9,8)")), c("weight")))
    found = placed.groupBy(c("node").alias("_node")).agg(*[at(r).alias(f"weight_{round(float(r) * 100)}") for r in ranks])
    return sums.join(found, c("node") == c("_node"), "left").drop("_node")
