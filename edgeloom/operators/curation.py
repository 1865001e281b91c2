"""Curation tables: neuron metadata projections with exact text formulas."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from edgeloom.functions.scalars import joined, matches, or_none, text, title_bool
from edgeloom.operators.mapping import current_roots
from edgeloom.operators.quality import drop_ambiguous
from edgeloom.sources.schemas import require

# The texts of the curation tables, and the words of type names that mark a neuron as not yet settled.
ADULT = "adult neuron"
WHOLE_SYSTEM = {"part_of": "adult brain|adult ventral nerve cord", "label": "BANC:", "comment": "BANC connectome neuron", "dbxrefs": "flywire_banc"}
NERVE_CORD = {
    "part_of": "male organism|adult ventral nerve cord",
    "label": " (MANC:",
    "comment": ("tracing status-", ", cropped-", ", MANC classification: class-", ", subclass-", ", systematic type-"),
    "dbxrefs": "neuprint_JRC_Manc",
}
OPTIC_LOBE = {
    "part_of": "male organism",
    "label": " (JRC_OpticLobe:",
    "comment": ("status-", ", status label-", ", Optic Lobe classification: type-"),
    "dbxrefs": "neuprint_JRC_OpticLobe_v1_0",
    "unsettled": r"unclear|TBD|\(",
}
ANNOTATED = {
    "anat_id": "VFB_",
    "part_of": "female organism|adult brain",
    "label": "FlyWire:",
    "status": "status-",
    "comment": ("FlyWire classification: flow-", ", superclass-", ", class-", ", subclass-", ", cell type-", ", hemibrain type-", ". FBbt_id annotation-", ". supervoxel id-"),
    "dbxrefs": ("flywire783", "|flywire_supervoxel:"),
}
MINIMAL = {"is_a": "neuron", "part_of": "female organism|adult brain", "label": " - ", "comment": ("tracing status-", ", cropped-"), "dbxrefs": "neuprint_JRC_Hemibrain_1point1"}


def from_ids(ids: DataFrame, prefix: str = WHOLE_SYSTEM["dbxrefs"]) -> DataFrame:
    """Whole-nervous-system neurons known by id alone (column ``filename``)."""
    name, fixed = F.col("filename"), WHOLE_SYSTEM
    return require(ids, "filename").select(
        "filename",
        F.lit(ADULT).alias("is_a"),
        F.lit(fixed["part_of"]).alias("part_of"),
        joined(fixed["label"], name).alias("label"),
        F.lit(fixed["comment"]).alias("comment"),
        joined(prefix + ":", name).alias("dbxrefs"),
    )


def nerve_cord(neurons: DataFrame, prefix: str = NERVE_CORD["dbxrefs"]) -> DataFrame:
    """Nerve cord neurons that have an id in the knowledge base.

    A null status makes the whole comment null; other missing classifications read ``None``.
    """
    c, fixed = F.col, NERVE_CORD
    before, cropped, *classes = fixed["comment"]
    status = joined(before, c("statusLabel"))
    traced = F.when(c("cropped").isNull(), status).otherwise(F.concat(status, F.lit(cropped), title_bool(c("cropped"))))
    classified = [x for name, column in zip(classes, ("class", "subclass", "systematicType"), strict=True) for x in (F.lit(name), or_none(c(column)))]
    return neurons.filter("vfbId IS NOT NULL").select(
        c("vfbId").alias("anat_id"),
        c("bodyId").alias("filename"),
        F.lit(ADULT).alias("is_a"),
        F.lit(fixed["part_of"]).alias("part_of"),
        joined(c("instance"), fixed["label"], c("bodyId"), ")").alias("label"),
        F.concat(traced, *classified).alias("comment"),
        joined(prefix + ":", c("bodyId")).alias("dbxrefs"),
    )


def optic_lobe(neurons: DataFrame, prefix: str = OPTIC_LOBE["dbxrefs"]) -> DataFrame:
    """Optic lobe neurons with a settled type and an instance name; a null type counts as settled."""
    c, fixed = F.col, OPTIC_LOBE
    settled = neurons.filter(~matches(c("type"), fixed["unsettled"])).filter("instance IS NOT NULL")
    comment = [x for name, column in zip(fixed["comment"], ("status", "statusLabel", "type"), strict=True) for x in (name, c(column))]
    return settled.select(
        c("bodyId").alias("filename"),
        F.lit(ADULT).alias("is_a"),
        F.lit(fixed["part_of"]).alias("part_of"),
        joined(c("instance"), fixed["label"], c("bodyId"), ")").alias("label"),
        joined(*comment).alias("comment"),
        joined(prefix + ":", c("bodyId")).alias("dbxrefs"),
    )


def annotated_roots(annotations: DataFrame, supervoxels: DataFrame, snapshot: str | None = None, prefix: str = ANNOTATED["dbxrefs"][0]) -> DataFrame:
    """Annotated whole-brain neurons, on the roots of a snapshot; a root that several annotations share is left out."""
    c, fixed = F.col, ANNOTATED
    found = drop_ambiguous(current_roots(annotations.filter("vfb_id IS NOT NULL"), supervoxels, snapshot), "mapped_root")
    columns = ("flow", "super_class", "cell_class", "cell_sub_class", "cell_type", "hemibrain_type", "fbbt_id", "supervoxel_id")
    status = F.when(c("status").isNull(), F.lit("")).otherwise(joined(fixed["status"], c("status")))
    return found.select(
        joined(fixed["anat_id"], c("vfb_id")).alias("anat_id"),
        c("mapped_root").alias("filename"),
        F.lit(ADULT).alias("is_a"),
        F.lit(fixed["part_of"]).alias("part_of"),
        joined(fixed["label"], c("root_id")).alias("label"),
        F.concat(status, *[x for name, column in zip(fixed["comment"], columns, strict=True) for x in (F.lit(name), or_none(c(column)))]).alias("comment"),
        F.concat(F.lit(prefix + ":"), or_none(c("mapped_root")), F.lit(fixed["dbxrefs"][1]), or_none(c("supervoxel_id"))).alias("dbxrefs"),
    )


def hemibrain_minimal(neurons: DataFrame, prefix: str = MINIMAL["dbxrefs"]) -> DataFrame:
    """Least metadata of neurons with a type."""
    c, fixed = F.col, MINIMAL
    before, cropped = fixed["comment"]
    return neurons.filter("type IS NOT NULL").select(
        text(c("bodyId")).alias("filename"),
        joined(c("instance"), fixed["label"], c("bodyId")).alias("label"),
        F.lit(fixed["is_a"]).alias("is_a"),
        F.lit(fixed["part_of"]).alias("part_of"),
        joined(prefix + ":", c("bodyId")).alias("dbxrefs"),
        F.concat(joined(before, c("statusLabel"), cropped), title_bool(c("cropped"))).alias("comment"),
    )
