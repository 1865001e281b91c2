"""Ontology template rows: mapped edges under a directive row."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from edgeloom.functions.scalars import curie
from edgeloom.operators.mapping import mapped
from edgeloom.sources.schemas import TEMPLATE, columns_of

#: The directive row and the type of every other row.
DIRECTIVES = ("ID", "TYPE", "I 'synapsed to'", ">AT n2o:weight^^xsd:integer")
ROW_TYPE = "owl:NamedIndividual"
COLUMNS = columns_of(TEMPLATE)
#: The property of the facts, and the prefixes that every ontology of them needs; those of the ids are the caller's.
PROPERTY = "obo:RO_0002120"
PREFIXES = {
    "owl": "http://www.w3.org/2002/07/owl#",
    "xsd": "http://www.w3.org/2001/XMLSchema#",
    "obo": "http://purl.obolibrary.org/obo/",
    "n2o": "http://neo2owl/custom/",
}


def rows(edges: DataFrame, xrefs: DataFrame, strict: bool = False, keep_extra: bool = False) -> DataFrame:
    """ID, TYPE, FACT and Weight of each edge, all text.

    An unmapped end stays as null; ``strict`` drops such edges.  ``keep_extra`` keeps further columns of the edges.
    """
    found = mapped(edges.filter("weight IS NOT NULL"), xrefs)
    if strict:
        found = found.filter("source IS NOT NULL AND target IS NOT NULL")
    extra = [F.col(c).cast("string").alias(c) for c in edges.columns if c not in ("source", "target", "weight")] if keep_extra else []
    return found.select(curie(F.col("source")).alias("ID"), F.lit(ROW_TYPE).alias("TYPE"), curie(F.col("target")).alias("FACT"), F.col("weight").cast("bigint").cast("string").alias("Weight"), *extra)


def with_directives(body: DataFrame, order: str | None = None) -> DataFrame:
    """The directive row and the rows below it; ``order`` names a column that is 0 for the directive row and 1 for others."""
    head = body.sparkSession.range(1).select(*[F.lit(v).alias(c) for c, v in zip(COLUMNS, DIRECTIVES, strict=True)])
    if order:
        head, body = head.withColumn(order, F.lit(0)), body.withColumn(order, F.lit(1))
    return head.unionByName(body, allowMissingColumns=True)


def template(edges: DataFrame, xrefs: DataFrame, strict: bool = False, keep_extra: bool = False, order: str | None = None) -> DataFrame:
    return with_directives(rows(edges, xrefs, strict, keep_extra), order)


def assertions(body: DataFrame, fact: str = "'synapsed to'") -> DataFrame:
    """One functional-syntax line per template row with both ends: the fact, by label or name, with its weight as an annotation."""
    found = body.filter("ID IS NOT NULL AND FACT IS NOT NULL")
    return found.select(
        F.concat(F.lit('ObjectPropertyAssertion(Annotation(n2o:weight "'), "Weight", F.lit(f'"^^xsd:integer) {fact} '), "ID", F.lit(" "), "FACT", F.lit(")")).alias("value")
    )


def document(body: DataFrame, iri: str, prefixes: dict[str, str] | None = None) -> DataFrame:
    """The lines of an ontology: ``part`` (their order: head, declarations, assertions, end) and ``value``; ``prefixes`` are those of the ids."""
    spark = body.sparkSession
    head = [*(f"Prefix({k}:=<{v}>)" for k, v in (PREFIXES | (prefixes or {})).items()), f"Ontology(<{iri}>"]
    fixed = spark.createDataFrame([*((i, line) for i, line in enumerate(head)), (len(head), f"Declaration(ObjectProperty({PROPERTY}))"), (len(head), "Declaration(AnnotationProperty(n2o:weight))"), (len(head) + 3, ")")], "part int, value string")
    held = body.filter("ID IS NOT NULL AND FACT IS NOT NULL")
    individuals = held.select(F.explode(F.array("ID", "FACT")).alias("id")).distinct().select(F.lit(len(head) + 1).alias("part"), F.concat(F.lit("Declaration(NamedIndividual("), "id", F.lit("))")).alias("value"))
    return fixed.union(individuals).union(assertions(held, PROPERTY).select(F.lit(len(head) + 2).alias("part"), "value"))
