"""The edge, registry and template operators as SQL table functions over named tables or views.

:func:`register` makes temporary functions of a session: ``SELECT * FROM edges_within(5)``.  They are SQL themselves, so their
columns are known when a query is analysed, filters and columns reach the scans through them, and no row leaves the JVM.
Each gives what the DataFrame operator of its comment gives.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from edgeloom.operators.template import COLUMNS


def register(spark: SparkSession, edges: str = "edges", ids: str = "ids", xrefs: str = "xrefs", prefix: str = "") -> list[str]:
    """Functions over the tables ``edges`` (source, target, weight), ``ids`` (id) and ``xrefs`` (accession, vfb_id); gives their names.

    ``prefix`` goes before each name, where several sets of tables are in use.
    """
    pair = "source BIGINT, target BIGINT, weight BIGINT"
    over = "weight > threshold"
    inside = "source IN (SELECT id FROM {ids}) AND target IN (SELECT id FROM {ids})"
    mapped = "SELECT accession, min(vfb_id) AS vfb_id FROM {xrefs} WHERE accession IS NOT NULL GROUP BY accession"
    bodies = {
        # edges.over
        f"edges_over(threshold BIGINT) RETURNS TABLE({pair})": f"SELECT source, target, weight FROM {{edges}} WHERE {over}",
        # edges.over of edges.within
        f"edges_within(threshold BIGINT) RETURNS TABLE({pair})": f"SELECT source, target, weight FROM {{edges}} WHERE {over} AND {inside}",
        # edges.from_regions
        f"edges_summed(threshold BIGINT) RETURNS TABLE({pair})": f"SELECT * FROM (SELECT source, target, coalesce(sum(weight), 0) AS weight FROM {{edges}} WHERE {inside} GROUP BY source, target) WHERE {over}",
        # edges.strengths
        "node_strengths() RETURNS TABLE(node BIGINT, outgoing BIGINT, incoming BIGINT, out_degree BIGINT, in_degree BIGINT)": """
            SELECT node, coalesce(sum(weight) FILTER (WHERE out), 0), coalesce(sum(weight) FILTER (WHERE NOT out), 0), count_if(out), count_if(NOT out)
            FROM (SELECT inline(array(struct(source AS node, true AS out), struct(target AS node, false AS out))), weight FROM {edges}) WHERE node IS NOT NULL GROUP BY node""",
        # mapping.unmapped
        "unmapped_ids() RETURNS TABLE(id BIGINT)": "SELECT DISTINCT id FROM (SELECT explode(array(source, target)) AS id FROM {edges}) i LEFT ANTI JOIN {xrefs} x ON CAST(i.id AS STRING) = x.accession WHERE id IS NOT NULL",
        # template.rows, without the directive row
        f"template_facts(threshold BIGINT) RETURNS TABLE({', '.join(f'`{c}` STRING' for c in COLUMNS)})": f"""
            SELECT replace(a.vfb_id, '_', ':'), 'owl:NamedIndividual', replace(b.vfb_id, '_', ':'), CAST(weight AS STRING) FROM {{edges}} e
            LEFT JOIN ({mapped}) a ON CAST(e.source AS STRING) = a.accession LEFT JOIN ({mapped}) b ON CAST(e.target AS STRING) = b.accession WHERE {over}""",
    }
    for head, body in bodies.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {prefix}{head} RETURN {body.format(edges=edges, ids=ids, xrefs=xrefs)}")
    return [prefix + head.split("(")[0] for head in bodies]
