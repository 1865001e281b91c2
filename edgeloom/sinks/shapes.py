"""Writers of skeletons, meshes and grids: one text file for each neuron, in a folder ``mesh=<id>``.

What a failed task has written is never seen (:mod:`edgeloom.sinks.folders`).  All tasks make lines; the lines of one file
are sorted (on disk where they don't fit) and written by one task.  An older folder is replaced, and ids are texts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from edgeloom.functions.scalars import scaled
from edgeloom.operators import skeletons as trees
from edgeloom.sinks.folders import one_file_each


def meshes(vertices: DataFrame, faces: DataFrame, path: str) -> None:
    """Mesh files of ``vertices`` (``mesh``, ``vertex``, ``x``, ``y``, ``z``) and ``faces`` (``mesh``, ``face``, ``part``, ``a``, ``b``, ``c``).

    A file counts its vertices from 1 in the order of ``vertex``, whatever these numbers are, and faces name those counts.  A
    face with a corner that isn't there is left out of no file: it raises an error.
    """
    from edgeloom.operators.slices import chunks_per_group

    placed = chunks_per_group(vertices.select("mesh", "vertex", "x", "y", "z"), "mesh", 1, "vertex", name="place").withColumn("place", F.col("place") + 1)
    number = placed.select("mesh", "vertex", "place")
    corner = F.explode(F.array(*[F.struct(F.lit(k).alias("corner"), F.col(k).alias("vertex")) for k in "abc"])).alias("c")
    named = faces.select("mesh", "face", "part", corner).select("mesh", "face", "part", "c.corner", "c.vertex").join(number, ["mesh", "vertex"], "left")
    missing = F.raise_error(F.lit("a face has a corner that is no vertex")).cast("bigint")
    at = [F.max(F.when(F.col("corner") == k, F.coalesce("place", missing))).cast("string").alias(k) for k in "abc"]
    sides = named.groupBy("mesh", "face", "part").agg(*at)
    lines = placed.select("mesh", F.lit(0).alias("kind"), F.col("place").alias("n"), F.lit(0).alias("part"), F.concat_ws(" ", F.lit("v"), "x", "y", "z").alias("line")).unionByName(
        sides.select("mesh", F.lit(1).alias("kind"), F.col("face").cast("bigint").alias("n"), F.col("part").cast("int").alias("part"), F.concat_ws(" ", F.lit("f"), "a", "b", "c").alias("line"))
    )
    one_file_each(lines.filter("mesh IS NOT NULL"), path, "mesh", "kind", "n", "part")


def skeletons(samples: DataFrame, path: str) -> None:
    """Skeleton files of ``samples`` (``mesh``, ``sample``, ``kind``, ``x``, ``y``, ``z``, ``radius``, ``parent``), parents before children."""
    ordered = trees.renumbered(samples)
    one_file_each(ordered.filter("mesh IS NOT NULL").select("mesh", F.col("sample").alias("n"), F.concat_ws(" ", "sample", "kind", "x", "y", "z", "radius", "parent").alias("line")), path, "mesh", "n")


def _row(filled: Column, width: int, value: Column) -> Column:
    """A grid's row as text: the value at each filled place, which are sorted, and 0 elsewhere."""
    gap = lambda x, n: F.concat(F.repeat(F.lit("0 "), x - F.coalesce(F.get(filled, n - 1), F.lit(-1)) - 1), value, F.lit(" "))
    last = F.coalesce(F.get(filled, F.size(filled) - 1), F.lit(-1))
    return F.rtrim(F.concat(F.array_join(F.transform(filled, gap), ""), F.repeat(F.lit("0 "), F.lit(width - 1) - last)))


def grids(voxels: DataFrame, path: str, size: tuple[int, int, int], pitch: tuple[float, float, float]) -> None:
    """Grid files (text encoding, unsigned bytes, x fastest) of distinct ``mesh``, ``i``, ``j``, ``k``: 255 where there is a voxel."""
    value = F.lit(1)
    held = voxels.groupBy("mesh", "j", "k").agg(F.sort_array(F.collect_set("i")).alias("filled"))
    names = voxels.select("mesh").distinct()
    every = names.select("mesh", F.explode(F.sequence(F.lit(0), F.lit(size[2] - 1))).alias("k")).select("mesh", "k", F.explode(F.sequence(F.lit(0), F.lit(size[1] - 1))).alias("j"))
    rows = every.join(held, ["mesh", "j", "k"], "left").select("mesh", F.col("k").alias("n"), "j", _row(F.coalesce("filled", F.array().cast("array<int>")), size[0], scaled(value).cast("string")).alias("line"))
    fields = ["NRRD0004", "type: uint8", "dimension: 3", "sizes: " + " ".join(map(str, size)), "encoding: text", "spacings: " + " ".join(map(repr, pitch)), ""]
    head = names.select("mesh", F.lit(-1).alias("n"), F.posexplode(F.array(*map(F.lit, fields))).alias("j", "line"))
    one_file_each(rows.unionByName(head).filter("mesh IS NOT NULL"), path, "mesh", "n", "j")
