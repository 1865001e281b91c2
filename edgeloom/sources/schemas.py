"""Explicit schemas of every input and output; ids are 64-bit integers and never pass through a double."""

from __future__ import annotations

from pyspark.sql import DataFrame

NODES = "short_form STRING, label STRING, labels ARRAY<STRING>"
RELS = "src STRING, dst STRING, type STRING, accession ARRAY<STRING>, filename ARRAY<STRING>, folder ARRAY<STRING>"
ENVELOPE = "results ARRAY<STRUCT<data: ARRAY<STRUCT<row: ARRAY<STRING>>>>>"
REGISTRY = "accession STRING, neuron_id STRING, neuron_label STRING"
EDGES = "source BIGINT, target BIGINT, weight BIGINT"
EDGES_BY_REGION = "bodyId_pre BIGINT, bodyId_post BIGINT, roi STRING, weight BIGINT"
EDGES_BY_BATCH = "pre BIGINT, post BIGINT, weight BIGINT"
SYNAPSES = "pre_pt_root_id BIGINT, post_pt_root_id BIGINT"
EDGE_FILE = "pre_root_id BIGINT, post_root_id BIGINT, num_synapses BIGINT"
XREFS = "accession STRING, vfb_id STRING"
NERVE_CORD_NEURONS = "bodyId BIGINT, vfbId STRING, instance STRING, statusLabel STRING, cropped BOOLEAN, class STRING, subclass STRING, systematicType STRING"
OPTIC_LOBE_NEURONS = "bodyId BIGINT, type STRING, instance STRING, status STRING, statusLabel STRING"
ANNOTATIONS = "vfb_id STRING, supervoxel_id BIGINT, root_id BIGINT, status STRING, flow STRING, super_class STRING, cell_class STRING, cell_sub_class STRING, cell_type STRING, hemibrain_type STRING, fbbt_id STRING"
SUPERVOXELS = "supervoxel_id BIGINT, root_id BIGINT, snapshot STRING"
ARTIFACTS = "root_id STRING, folder STRING, has_swc BOOLEAN, has_obj BOOLEAN, has_nrrd BOOLEAN, redo BOOLEAN"
TEMPLATE = "ID STRING, TYPE STRING, FACT STRING, Weight STRING"


class MissingColumns(ValueError):
    """An input lacks columns that its operator reads."""


def require(df: DataFrame, *columns: str) -> DataFrame:
    """``df``, or an error that names the columns it lacks."""
    lacking = [c for c in columns if c not in df.columns]
    if lacking:
        raise MissingColumns(f"lacking {', '.join(lacking)}; there are {', '.join(df.columns)}")
    return df


def columns_of(schema: str) -> list[str]:
    return [part.split()[0] for part in schema.replace("ARRAY<STRUCT<data: ARRAY<STRUCT<row: ARRAY<STRING>>>>>", "X").split(", ")]
