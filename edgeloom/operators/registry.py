"""Checks that turn a registry answer into the ids that edges are restricted to."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from edgeloom.functions.scalars import or_default, to_id


class EmptyRegistry(ValueError):
    """No neuron was found."""


class BadAccession(ValueError):
    """An accession isn't a 64-bit integer."""


def missing(registry: DataFrame) -> DataFrame:
    """Neurons without an accession, with stand-ins for missing names."""
    return registry.filter("accession IS NULL").select(or_default(F.col("neuron_id"), "UNKNOWN").alias("neuron_id"), or_default(F.col("neuron_label"), "No label").alias("neuron_label"))


def _tallies() -> list[Column]:
    bad = F.col("accession").isNotNull() & to_id(F.col("accession")).isNull()
    return [F.count(F.lit(1)).alias("total"), F.count_if(F.col("accession").isNull()).alias("missing"), F.count_if(bad).alias("malformed")]


def summary(registry: DataFrame) -> DataFrame:
    """One row: total, missing and malformed accessions."""
    return registry.agg(*_tallies())


def outcomes(registry: DataFrame, by: str) -> DataFrame:
    """What the checks would say of each group of neurons: no accession, malformed or usable."""
    said = F.when(F.col("total") == F.col("missing"), "no accession").when(F.col("malformed") > 0, "malformed").otherwise("usable")
    return registry.groupBy(by).agg(*_tallies()).select(by, said.alias("outcome"))


def malformed(registry: DataFrame) -> DataFrame:
    return registry.filter(F.col("accession").isNotNull() & to_id(F.col("accession")).isNull())


def to_ids(registry: DataFrame) -> DataFrame:
    """Distinct ids; missing and malformed accessions are left out (see the reports above)."""
    return registry.select(to_id(F.col("accession")).alias("accession")).filter("accession IS NOT NULL").distinct()


def checked_ids(registry: DataFrame) -> DataFrame:
    """Distinct ids, all or nothing: a malformed accession, or no accession at all, is an error."""
    found = summary(registry).first()
    if found["total"] == 0 or found["total"] == found["missing"]:
        raise EmptyRegistry(f"{found['total']} neurons found, {found['missing']} of them without an accession")
    if found["malformed"]:
        examples = [r["accession"] for r in malformed(registry).limit(10).collect()]
        raise BadAccession(f"{found['malformed']} accessions are no integers, such as {examples}")
    return to_ids(registry)
