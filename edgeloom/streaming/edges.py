"""Streaming ingest: synapses to windowed counts and to bursts, and thresholded edges per batch."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from edgeloom.operators import edges as E


def windowed_counts(synapses: DataFrame, ids: DataFrame, time: str = "ts", window: str = "10 minutes", late: str = "30 minutes") -> DataFrame:
    """Synapses counted by pair and time window, within a registry; rows later than ``late`` are dropped with their state."""
    held = E.within(E.renamed(synapses.withWatermark(time, late)), ids).filter("source IS NOT NULL AND target IS NOT NULL")
    counted = held.groupBy(F.window(time, window), "source", "target").agg(F.count(F.lit(1)).alias("weight"))
    return counted.select(F.col("window.start").alias("window_start"), "source", "target", "weight")


def running_weights(edges: DataFrame, threshold: int = 0) -> DataFrame:
    """Total weight by pair so far, over a threshold (for update or complete output)."""
    return E.over(E.summed(edges), threshold)


def sessions(synapses: DataFrame, time: str = "ts", key: str = "synapse_id", gap: str = "10 minutes", late: str = "30 minutes") -> DataFrame:
    """Bursts of a pair: synapses of a source and target with less than ``gap`` between one and the next, counted.

    A synapse that comes again (same ``key``) within ``late`` counts once, and synapses may come out of order by as much; a
    burst is given when nothing can join it any more, and its state goes then.  Over a table at rest the answer is the same.
    """
    once = synapses.withWatermark(time, late)
    once = once.dropDuplicatesWithinWatermark([key]) if synapses.isStreaming else once.dropDuplicates([key])
    held = E.renamed(once).filter("source IS NOT NULL AND target IS NOT NULL")
    counted = held.groupBy(F.session_window(time, gap), "source", "target").agg(F.count(F.lit(1)).alias("weight"))
    return counted.select(F.col("session_window.start").alias("begins"), F.col("session_window.end").alias("ends"), "source", "target", "weight")


def each_batch(stream: DataFrame, ids: DataFrame, threshold: int, write: Callable[[DataFrame, int], None], checkpoint: str):
    """A running query that gives ``write`` the induced, thresholded edges of each batch."""

    def run(batch: DataFrame, number: int) -> None:
        write(E.over(E.within(E.renamed(batch), ids), threshold), number)

    return stream.writeStream.option("checkpointLocation", checkpoint).foreachBatch(run).start()
