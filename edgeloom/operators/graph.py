"""Graph patterns as joins over node and relationship tables.

``nodes``: short_form, label, labels.  ``rels``: src, dst, type, and list properties.  Names are typed parameters and
column expressions, never text spliced into a query.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from edgeloom.functions.scalars import first_item
from edgeloom.sources.schemas import require

#: Relationship types of the knowledge base.
SOURCE_TYPE = "has_source"
XREF_TYPES = ("database_cross_reference", "hasDbXref")


def of_type(rels: DataFrame, *types: str) -> DataFrame:
    """Relationships of any of the types."""
    return rels.filter(F.col("type").isin(*types))


def with_label(nodes: DataFrame, label: str, short_form: str | None = None) -> DataFrame:
    """Nodes with a label, and with a short form if one is given."""
    found = nodes.filter(F.array_contains("labels", label))
    return found if short_form is None else found.filter(F.col("short_form") == short_form)


def undirected(rels: DataFrame, *properties: str) -> DataFrame:
    """Each relationship from both of its ends: ``here``, ``there`` and the properties."""
    require(rels, "src", "dst", *properties)
    forth = rels.select(F.col("src").alias("here"), F.col("dst").alias("there"), *properties)
    return forth.union(rels.select(F.col("dst").alias("here"), F.col("src").alias("there"), *properties).filter("here != there"))


def registry(nodes: DataFrame, rels: DataFrame, dataset: str | None = None, site: str | None = None) -> DataFrame:
    """Distinct (accession, neuron_id, neuron_label) of the neurons of a data set, a site, or both.

    A data set alone takes cross-references to any site.  A neuron with an empty accession list has a null accession.
    """
    if dataset is None and site is None:
        raise ValueError("a dataset, a site or both must be given")
    xrefs = undirected(of_type(rels, *XREF_TYPES), "accession").select(F.col("here").alias("n"), F.col("there").alias("s"), first_item(F.col("accession")).alias("accession"))
    sites = with_label(nodes, "Site", site).select(F.col("short_form").alias("s"))
    found = xrefs.join(sites, "s", "left_semi")
    if dataset is not None:
        members = undirected(of_type(rels, SOURCE_TYPE)).filter(F.col("there") == dataset).select(F.col("here").alias("n"))
        found = found.join(members, "n", "left_semi")
    named = nodes.select(F.col("short_form").alias("n"), F.col("label").alias("neuron_label"))
    return found.join(named, "n").select("accession", F.col("n").alias("neuron_id"), "neuron_label").distinct()


def registry_ids(nodes: DataFrame, rels: DataFrame, dataset: str, site: str) -> DataFrame:
    """The distinct accessions alone."""
    return registry(nodes, rels, dataset, site).select("accession").distinct()


def path(start: DataFrame, *steps: tuple[DataFrame, str, str]) -> DataFrame:
    """A chain of inner joins; duplicates stay, since a pattern returns a bag.

    ``start`` has a column ``at``; each step is (table, its column that meets ``at``, its column that is ``at`` next).
    Other columns of every table stay.
    """
    found = start
    for table, meets, goes in steps:
        step = table.withColumn("_meets", F.col(meets)).withColumn("_goes", F.col(goes))
        found = found.join(step, F.col("at") == F.col("_meets")).drop("at", "_meets").withColumnRenamed("_goes", "at")
    return found


def registered_images(nodes: DataFrame, rels: DataFrame, dataset: str, site: str | None = None, template: str | None = None) -> DataFrame:
    """body_id and folder of images: DataSet <- has_source - Individual <- depicts - Individual - in_register_with -> Template.

    With a site, ids come from its cross-references; without one, from the file name of the registration.
    """
    individuals = with_label(nodes, "Individual").select(F.col("short_form").alias("n"))
    members = of_type(rels, SOURCE_TYPE).filter(F.col("dst") == dataset).join(with_label(nodes, "DataSet", dataset), F.col("dst") == F.col("short_form"), "left_semi")
    neurons = members.select(F.col("src").alias("n")).join(individuals, "n", "left_semi")
    channels = of_type(rels, "depicts").select(F.col("src").alias("c"), F.col("dst").alias("n")).join(individuals.withColumnRenamed("n", "c"), "c", "left_semi")
    places = of_type(rels, "in_register_with").join(with_label(nodes, "Template", template).select(F.col("short_form").alias("dst")), "dst", "left_semi")
    found = neurons.join(channels, "n").join(places.select(F.col("src").alias("c"), "filename", "folder"), "c")
    if site is None:
        return found.select(first_item(F.col("filename")).alias("body_id"), first_item(F.col("folder")).alias("folder"))
    xrefs = of_type(rels, *XREF_TYPES).filter(F.col("dst") == site).select(F.col("src").alias("n"), first_item(F.col("accession")).alias("body_id"))
    return found.join(xrefs, "n").select("body_id", first_item(F.col("folder")).alias("folder"))


def nodes_where(nodes: DataFrame, label: str, *conditions: Column, order: Sequence[str] = (), limit: int | None = None) -> DataFrame:
    """Nodes with a label that meet every condition; a limit is taken in the given order, which makes it repeatable."""
    found = with_label(nodes, label)
    for condition in conditions:
        found = found.filter(condition)
    if order:
        found = found.orderBy(*order)
    return found if limit is None else found.limit(limit)


def rows_of_envelope(envelope: DataFrame, *columns: str) -> DataFrame:
    """Rows of a nested query answer (``results``: results of data of row arrays), by position; missing fields are null."""
    row = envelope.select(F.explode("results").alias("result")).select(F.explode("result.data").alias("d")).select(F.col("d.row").alias("row"))
    return row.select(*[F.get("row", F.lit(i)).alias(c) for i, c in enumerate(columns)])
