"""What to make or delete for each neuron's files, and point occupancy of a grid."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from edgeloom.functions.scalars import folder, in_folder, prefix_swap, to_id

#: File names, and the pitch and extent of the template grid.
FILES = {"swc": "volume.swc", "obj": "volume_man.obj", "nrrd": "volume.nrrd"}
PITCH = (0.5189161, 0.5189161, 1.0)
EXTENT = (627.3695649, 293.1875965, 173.0)


def local_folders(images: DataFrame, url: str, root: str) -> DataFrame:
    """body_id and folder: integer ids only, web addresses as local folders, and the path of each file."""
    where = folder(prefix_swap(F.col("folder"), url, root))
    held = images.select(to_id(F.col("body_id")).alias("body_id"), where.alias("folder")).filter("body_id IS NOT NULL")
    return held.select("*", *[in_folder(F.col("folder"), name).alias(f"{kind}_path") for kind, name in FILES.items()])


def state(wanted: DataFrame, files: DataFrame) -> DataFrame:
    """``wanted`` (root_id, folder) with whether each file is there; ``files`` is an inventory (folder, name)."""
    there = files.filter(F.col("name").isin(*FILES.values())).groupBy("folder").agg(*[F.bool_or(F.col("name") == name).alias(f"has_{kind}") for kind, name in FILES.items()])
    return wanted.join(there, "folder", "left").select("root_id", "folder", *[F.coalesce(f"has_{k}", F.lit(False)).alias(f"has_{k}") for k in FILES])


def plan(state: DataFrame) -> DataFrame:
    """root_id, folder, make_swc, make_obj, make_nrrd and delete_first; rows with nothing to do are left out.

    Complete files are made anew only on ``redo``.  On ``redo`` files are deleted if the skeleton or the mesh is there;
    then everything is made, and else what is missing.  Ids that are no integers are left out.
    """
    c = F.col
    complete = c("has_swc") & c("has_obj") & c("has_nrrd")
    redo = F.coalesce(c("redo"), F.lit(False)) if "redo" in state.columns else F.lit(False)
    delete = redo & (c("has_swc") | c("has_obj"))
    held = state.withColumn("root_id", to_id(c("root_id"))).filter("root_id IS NOT NULL").filter(~complete | redo)
    return held.select("root_id", "folder", *[(delete | ~c(f"has_{k}")).alias(f"make_{k}") for k in FILES], delete.alias("delete_first"))


def occupancy(points: DataFrame, pitch: tuple[float, float, float] = PITCH, extent: tuple[float, float, float] = EXTENT) -> DataFrame:
    """Distinct voxels that hold a point, with value 255; points outside the extent are left out."""
    inside = F.lit(True)
    for axis, most in zip("xyz", extent, strict=True):
        inside = inside & F.col(axis).between(0, most)
    voxel = [F.floor(F.col(axis) / step).cast("int").alias(f"{axis}_voxel") for axis, step in zip("xyz", pitch, strict=True)]
    return points.filter(inside).select(*voxel).distinct().withColumn("value", F.lit(255).cast("smallint"))
