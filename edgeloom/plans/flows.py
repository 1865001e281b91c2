"""End-to-end dataflows: a registry and edges in, a template out, as one lazy plan."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Observation

from edgeloom.operators import edges, graph, mapping, quality, registry, template

#: Edge operators by kind of source, each with its usual threshold.
SOURCES: dict[str, tuple[Callable[..., DataFrame], int]] = {
    "regions": (edges.from_regions, 1),
    "pairs": (edges.from_pairs, 0),
    "downstream": (edges.from_downstream, 0),
    "synapses": (edges.from_synapses, 0),
    "file": (edges.from_file, 0),
}


def induced_template(
    kind: str, edge_table: DataFrame, nodes: DataFrame, rels: DataFrame, dataset: str | None, site: str, threshold: int | None = None, strict: bool = False, order: str | None = None, counts: dict[str, Observation] | None = None
) -> DataFrame:
    """The template of one import: registry, checks, edges of a kind, threshold, mapping to the site's ids.

    ``counts`` may hold observations named read and kept; they give the edges at either end once the result is used.  To
    count what is read, every row must be read: the threshold then doesn't reach the scan.
    """
    operator, usual = SOURCES[kind]
    seen = lambda df, name: quality.watched(df, counts[name]) if counts and name in counts else df
    ids = registry.checked_ids(graph.registry(nodes, rels, dataset, site))
    found = operator(seen(edge_table, "read"), ids, usual if threshold is None else threshold)
    return template.template(seen(found, "kept"), mapping.xrefs_of_site(rels, site), strict=strict, order=order)
