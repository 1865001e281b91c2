"""``python -m edgeloom.cli``: imports edges and writes a template or a curation table."""

from __future__ import annotations

import argparse
import logging
import sys

from pyspark.sql import DataFrame, Observation, SparkSession

from edgeloom.operators import curation, graph, registry
from edgeloom.operators.registry import BadAccession, EmptyRegistry
from edgeloom.plans.flows import SOURCES, induced_template
from edgeloom.sinks import files
from edgeloom.sources import readers, schemas

_SCHEMAS = {"regions": schemas.EDGES_BY_REGION, "pairs": schemas.EDGES, "downstream": schemas.EDGES_BY_BATCH, "synapses": schemas.SYNAPSES, "file": schemas.EDGE_FILE}
_CURATIONS = {"ids": (curation.from_ids, "filename BIGINT"), "nerve-cord": (curation.nerve_cord, schemas.NERVE_CORD_NEURONS), "optic-lobe": (curation.optic_lobe, schemas.OPTIC_LOBE_NEURONS)}
log = logging.getLogger("edgeloom")


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="edgeloom", description=__doc__)
    kinds = top.add_subparsers(dest="command", required=True)
    edges = kinds.add_parser("edges", help="edges of a registry as a template")
    edges.add_argument("--kind", choices=sorted(SOURCES), default="file")
    edges.add_argument("-d", "--dataset", help="data set whose neurons count; any if left out")
    edges.add_argument("--db", default="BANC626", help="site whose cross-references count")
    edges.add_argument("-t", "--threshold", type=int, help="edges must weigh more than this; the kind's usual one by default")
    edges.add_argument("--edges", "--connectivity-file", required=True, help="edge table (Parquet)")
    edges.add_argument("--nodes", required=True, help="nodes of the knowledge base (Parquet)")
    edges.add_argument("--rels", required=True, help="relationships of the knowledge base (Parquet)")
    edges.add_argument("--strict", action="store_true", help="drop edges with an unmapped end")
    edges.add_argument("-o", "--output", required=True)
    edges.add_argument("--count-read", action="store_true", help="also count the edges read, for which all rows must be read")
    edges.add_argument("--ontology", help="also write an ontology, named connectome_*.owl, here")
    edges.add_argument("--iri", default="urn:edgeloom:connectome", help="the ontology's name")
    edges.add_argument("--prefix", action="append", default=[], metavar="NAME=IRI", help="a prefix of the ids in the ontology; may be repeated")
    edges.add_argument("--missing", help="also write the neurons without an accession here (TSV)")
    tables = kinds.add_parser("curation", help="a curation table")
    tables.add_argument("--kind", choices=[*sorted(_CURATIONS), "annotations"], required=True)
    tables.add_argument("--input", required=True, help="neurons (Parquet), or annotations (TSV)")
    tables.add_argument("--supervoxels", help="supervoxel map (Parquet), for annotations")
    tables.add_argument("--snapshot", default="mat_783")
    tables.add_argument("-o", "--output", required=True)
    return top


def report_missing(neurons: DataFrame, path: str | None) -> None:
    """Says how many neurons lack an accession, names the first, and writes all of them where a path is given."""
    found = registry.summary(neurons).first()
    log.info("%d neurons found, %d without an accession", found["total"], found["missing"])
    if found["missing"]:
        lacking = registry.missing(neurons)
        for row in lacking.orderBy("neuron_id").limit(10).collect():
            log.warning("without an accession: %s (%s)", row["neuron_id"], row["neuron_label"])
        if path:
            files.tsv(lacking, path, "neuron_id", "neuron_label")


def run(spark: SparkSession, args: argparse.Namespace) -> None:
    if args.command == "edges":
        nodes, rels = readers.graph(spark, args.nodes, args.rels)
        table = readers.parquet(spark, args.edges, _SCHEMAS[args.kind])
        report_missing(graph.registry(nodes, rels, args.dataset, args.db), args.missing)
        counts: dict[str, Observation] = {name: Observation(name) for name in ("read",) * args.count_read + ("kept",)}
        found = induced_template(args.kind, table, nodes, rels, args.dataset, args.db, args.threshold, args.strict, order="_order", counts=counts)
        files.template_tsv(found, args.output, "_order")
        for name, count in counts.items():
            log.info("%s edges: %d", name, count.get["rows"])
        if args.ontology:
            plain = induced_template(args.kind, table, nodes, rels, args.dataset, args.db, args.threshold, args.strict, order="_order").filter("_order = 1").drop("_order")
            files.ontology(plain, args.ontology, args.iri, prefixes=dict(p.split("=", 1) for p in args.prefix))
    elif args.kind == "annotations":
        if not args.supervoxels:
            raise SystemExit("annotations need --supervoxels")
        found = curation.annotated_roots(readers.annotations(spark, args.input), readers.parquet(spark, args.supervoxels, schemas.SUPERVOXELS), args.snapshot)
        files.tsv(found, args.output, "filename")
    else:
        operator, schema = _CURATIONS[args.kind]
        files.tsv(operator(readers.parquet(spark, args.input, schema)), args.output, "filename")
    log.info("written to %s", args.output)


def main(argv: list[str] | None = None) -> int:
    args = parser().parse_args(argv)
    logging.basicConfig(level=logging.INFO)
    spark = SparkSession.builder.appName("edgeloom").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    try:
        run(spark, args)
    except (EmptyRegistry, BadAccession) as error:
        log.error("%s", error)
        return 1
    return 0


if __name__ == "__main__":
    sys.exit(main())
