"""Skeletons as trees: depths by pointer jumping, and samples numbered so that parents come before children.

A sample learns its ancestor 1, 2, 4, … steps up, so a tree of depth d takes log2(d) rounds, each a join and a table in the
shared folder; a long unbranched neurite is no harder than a bush.

Defined cases: a parent of -1, null, or one that isn't a sample of the neuron makes a root, so a neuron can have several; a
repeated sample number of one neuron counts once (the row that sorts first); a cycle is an error.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from edgeloom.sources.shared import forget, written

#: Rounds reach 2 ** 40 steps up, more than any skeleton has.
_ROUNDS = 40


def _parents(samples: DataFrame) -> DataFrame:
    """One row for each sample, with a null parent at roots."""
    first = F.row_number().over(Window.partitionBy("mesh", "sample").orderBy("parent", "kind", "x", "y", "z", "radius"))
    once = samples.select("mesh", "sample", "kind", "x", "y", "z", "radius", "parent").filter("mesh IS NOT NULL AND sample IS NOT NULL").withColumn("_n", first).filter("_n = 1").drop("_n")
    there = once.select("mesh", F.col("sample").alias("_there"))
    found = once.withColumnRenamed("parent", "_parent").join(there.withColumnRenamed("mesh", "_mesh"), (F.col("mesh") == F.col("_mesh")) & (F.col("_parent") == F.col("_there")), "left")
    return found.withColumn("parent", F.col("_there")).drop("_mesh", "_there", "_parent")


def depths(samples: DataFrame) -> DataFrame:
    """``samples`` once each, with ``root`` (the sample at the top) and ``depth`` (steps from it)."""
    held = written(_parents(samples), "samples")
    up = written(held.select("mesh", "sample", F.coalesce("parent", "sample").alias("root"), F.when(F.col("parent").isNull(), 0).otherwise(1).cast("bigint").alias("depth"), F.col("parent").isNull().alias("done")), "ancestors")
    for _ in range(_ROUNDS):
        if up.filter("NOT done").isEmpty():
            break
        # a finished sample needs no ancestor; the others take their ancestor's
        above = up.select(F.col("mesh").alias("_mesh"), F.col("sample").alias("_sample"), F.col("root").alias("_root"), F.col("depth").alias("_depth"), F.col("done").alias("_done"))
        jumped = up.filter("NOT done").join(above, (F.col("mesh") == F.col("_mesh")) & (F.col("root") == F.col("_sample")))
        jumped = jumped.select("mesh", "sample", F.col("_root").alias("root"), (F.col("depth") + F.col("_depth")).alias("depth"), F.col("_done").alias("done"))
        old, up = up, written(up.filter("done").unionByName(jumped), "ancestors")
        forget(old)
        # a cycle's steps double for ever
        if up.filter("NOT done AND depth > 1000000000000").limit(1).count():
            break
    if up.filter("NOT done").limit(1).count():
        raise ValueError("a skeleton has a cycle")
    return held.join(up.drop("done"), ["mesh", "sample"])


def renumbered(samples: DataFrame) -> DataFrame:
    """Samples numbered from 1 within each ``mesh``, by depth and then sample, parents under their new numbers and -1 at roots."""
    from edgeloom.operators.slices import chunks_per_group

    placed = written(chunks_per_group(depths(samples), "mesh", 1, "depth", "sample", name="_new").withColumn("_new", F.col("_new") + 1), "renumbered")
    parents = placed.select(F.col("mesh").alias("_mesh"), F.col("sample").alias("_sample"), F.col("_new").alias("_above"))
    found = placed.join(parents, (F.col("mesh") == F.col("_mesh")) & (F.col("parent") == F.col("_sample")), "left")
    return found.select("mesh", F.col("_new").alias("sample"), "kind", "x", "y", "z", "radius", F.coalesce("_above", F.lit(-1)).cast("bigint").alias("parent"), "depth")
