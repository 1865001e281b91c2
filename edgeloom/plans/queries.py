"""The registered queries over the driver's tables, and the SQL that gives the same rows.

The tables hold no neurons, so others stand in: line items are edges from suppliers to parts, filtered suppliers and
parts are registries, customers and nations make the property graph.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from edgeloom.functions import scalars as S
from edgeloom.operators import artifacts, curation, edges, graph, mapping, quality, registry, slices, template


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def supply_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = F.col
    return table(spark, sf_dir, "lineitem").select(c("l_suppkey").alias("source"), c("l_partkey").alias("target"), c("l_quantity").cast("bigint").alias("weight"))


def supplier_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "supplier").filter("s_acctbal > 0").select("s_suppkey")


def part_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").filter("p_size <= 25").select("p_partkey")


def induced(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edges.within(edges.within(supply_edges(spark, sf_dir), supplier_ids(spark, sf_dir), "source"), part_ids(spark, sf_dir), "target")


def customer_graph(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Regions are data sets, market segments are sites, customers are neurons."""
    customer, nation, region = (table(spark, sf_dir, n) for n in ("customer", "nation", "region"))
    node = lambda form, label, kind: (F.col(form).cast("string").alias("short_form") if isinstance(form, str) else form.alias("short_form"), label.alias("label"), F.array(F.lit(kind)).alias("labels"))
    name = F.concat(F.lit("C_"), F.col("c_custkey"))
    nodes = (
        customer.select(*node(name, F.col("c_name"), "Individual"))
        .union(region.select(*node("r_name", F.col("r_name"), "DataSet")))
        .union(customer.select("c_mktsegment").distinct().select(*node("c_mktsegment", F.col("c_mktsegment"), "Site")))
    )
    placed = customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey")).join(region, F.col("n_regionkey") == F.col("r_regionkey"))
    empty = F.lit(None).cast("array<string>")
    rel = lambda src, dst, kind, accession: (src.alias("src"), dst.alias("dst"), F.lit(kind).alias("type"), accession.alias("accession"))
    rels = (
        placed.select(*rel(name, F.col("r_name"), "has_source", empty))
        .union(customer.filter("c_custkey % 2 = 0").select(*rel(name, F.col("c_mktsegment"), "database_cross_reference", F.array(F.col("c_custkey").cast("string")))))
        .union(customer.filter("c_custkey % 2 = 1").select(*rel(F.col("c_mktsegment"), name, "hasDbXref", F.array(F.col("c_custkey").cast("string")))))
    )
    return nodes, rels


def registry_pattern(spark, d):
    return graph.registry(*customer_graph(spark, d), dataset="ASIA", site="BUILDING")


def registry_by_site(spark, d):
    return graph.registry(*customer_graph(spark, d), site="MACHINERY")


def registry_by_dataset(spark, d):
    return graph.registry(*customer_graph(spark, d), dataset="EUROPE")


def registry_accessions(spark, d):
    return graph.registry_ids(*customer_graph(spark, d), dataset="ASIA", site="BUILDING")


def edge_threshold(spark, d):
    return edges.over(supply_edges(spark, d), 40)


def edge_induced(spark, d):
    return induced(spark, d)


def edge_roi_sum(spark, d):
    return edges.over(edges.summed(supply_edges(spark, d)), 50)


def edge_synapse_count(spark, d):
    return edges.over(edges.counted(edges.within(supply_edges(spark, d), part_ids(spark, d), "target")), 1)


def edge_file(spark, d):
    """Edges of a file under a threshold, induced on one registry at both ends, background left out."""
    held = supply_edges(spark, d).select(F.col("source").alias("pre_root_id"), F.col("target").alias("post_root_id"), F.col("weight").alias("num_synapses"))
    ids = table(spark, d, "supplier").select("s_suppkey")
    return edges.from_file(held, ids, threshold=10, background=0)


def nn_edges(spark, d):
    customer, orders, lineitem, supplier = (table(spark, d, n) for n in ("customer", "orders", "lineitem", "supplier"))
    joined = lineitem.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).join(customer, F.col("o_custkey") == F.col("c_custkey")).join(supplier, F.col("l_suppkey") == F.col("s_suppkey"))
    c = F.col
    return edges.summed(joined.select(c("c_nationkey").cast("bigint").alias("source"), c("s_nationkey").cast("bigint").alias("target"), c("l_quantity").cast("bigint").alias("weight")))


def nn_edges_homogeneous(spark, d):
    return edges.over(nn_edges(spark, d), 0)


def _xrefs(spark, d):
    supplier, part = table(spark, d, "supplier"), table(spark, d, "part")
    return supplier.select(F.col("s_suppkey").cast("string").alias("accession"), F.concat(F.lit("KB_s_"), F.col("s_suppkey")).alias("vfb_id")).union(
        part.filter("p_partkey > 1000").select(F.col("p_partkey").cast("string").alias("accession"), F.concat(F.lit("KB_t_"), F.col("p_partkey")).alias("vfb_id"))
    )


def template_rows(spark, d):
    """Every edge as a template row; unmapped ends are blank."""
    found = template.template(supply_edges(spark, d), _xrefs(spark, d))
    return found.select(*[F.coalesce(c, F.lit("")).alias(c) for c in template.COLUMNS])


def template_induced(spark, d):
    return template.template(induced(spark, d), _xrefs(spark, d), strict=True)


def template_assertions(spark, d):
    return template.assertions(template.rows(edges.over(induced(spark, d), 45), _xrefs(spark, d)))


def unmapped_ids(spark, d):
    return mapping.unmapped(induced(spark, d), _xrefs(spark, d))


def missing_report(spark, d):
    documents, labels = table(spark, d, "documents"), table(spark, d, "labels")
    held = documents.select("doc_id").join(labels.select("doc_id", F.col("quality").cast("string").alias("accession")), "doc_id", "left")
    return registry.summary(held.select("accession"))


def missing_rows(spark, d):
    documents, labels = table(spark, d, "documents"), table(spark, d, "labels")
    held = documents.join(labels.select("doc_id", F.col("quality").cast("string").alias("accession")), "doc_id", "left")
    return registry.missing(held.select("accession", F.col("doc_id").cast("string").alias("neuron_id"), F.when(F.col("doc_id") % 3 != 0, F.col("source")).alias("neuron_label")))


def curation_neuprint(spark, d):
    c = F.col
    part = table(spark, d, "part")
    neurons = part.select(
        c("p_partkey").alias("bodyId"), F.concat(F.lit("KB_"), c("p_partkey")).alias("vfbId"), c("p_name").alias("instance"), F.when(c("p_size") % 7 != 0, c("p_brand")).alias("statusLabel"),
        F.when(c("p_size") % 3 != 0, c("p_size") % 3 == 1).alias("cropped"), F.when(c("p_size") > 10, c("p_type")).alias("class"), F.when(c("p_size") > 20, c("p_brand")).alias("subclass"), F.lit(None).cast("string").alias("systematicType"),
    )
    return curation.nerve_cord(neurons)


def curation_regex(spark, d):
    c = F.col
    part = table(spark, d, "part")
    neurons = part.select(c("p_partkey").alias("bodyId"), F.when(c("p_size") % 10 == 0, F.concat(c("p_type"), F.lit(" (x)"))).when(c("p_size") % 10 == 1, F.concat(F.lit("TBD "), c("p_type"))).otherwise(c("p_type")).alias("type"), F.when(c("p_size") % 9 != 0, c("p_name")).alias("instance"), c("p_brand").alias("status"), c("p_brand").alias("statusLabel"))
    return curation.optic_lobe(neurons)


def curation_banc(spark, d):
    return curation.from_ids(table(spark, d, "part").select(F.col("p_partkey").alias("filename")))


def curation_flywire(spark, d):
    c = F.col
    customer, orders = table(spark, d, "customer"), table(spark, d, "orders")
    annotations = customer.select(
        F.when(c("c_custkey") % 5 != 0, c("c_custkey").cast("string")).alias("vfb_id"), c("c_custkey").alias("supervoxel_id"), (c("c_custkey") * 10).alias("root_id"), F.when(c("c_custkey") % 4 != 0, c("c_mktsegment")).alias("status"), c("c_mktsegment").alias("flow"),
        F.when(c("c_nationkey") > 5, c("c_name")).alias("super_class"), F.lit(None).cast("string").alias("cell_class"), F.lit(None).cast("string").alias("cell_sub_class"), c("c_name").alias("cell_type"), F.lit(None).cast("string").alias("hemibrain_type"), F.lit(None).cast("string").alias("fbbt_id"),
    )
    supervoxels = orders.groupBy(c("o_custkey").alias("supervoxel_id")).agg((F.min("o_orderkey") % 500).alias("root_id"))
    return curation.annotated_roots(annotations, supervoxels)


def curation_minimal(spark, d):
    c = F.col
    neurons = table(spark, d, "part").select(c("p_partkey").alias("bodyId"), F.when(c("p_size") > 3, c("p_type")).alias("type"), c("p_name").alias("instance"), c("p_brand").alias("statusLabel"), (c("p_size") % 2 == 0).alias("cropped"))
    return curation.hemibrain_minimal(neurons)


def drop_ambiguous(spark, d):
    return quality.drop_ambiguous(table(spark, d, "documents").select("doc_id", "n_chars"), "n_chars")


def ambiguous_report(spark, d):
    return quality.ambiguous(table(spark, d, "documents").select("doc_id", "n_chars"), "n_chars")


def value_counts(spark, d):
    return quality.value_counts(table(spark, d, "documents"), "n_chars")


def batch_number(spark, d):
    return slices.batches(table(spark, d, "customer").select("c_custkey"), 100, "c_custkey").groupBy("batch").agg(F.min("c_custkey").alias("first_key"), F.count(F.lit(1)).alias("n"))


def batch_of_items(spark, d):
    """The batch of every line item, in an order of all its keys."""
    held = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")
    return slices.batches(held, 1000, *held.columns)


def chunk_per_sample(spark, d):
    held = table(spark, d, "customer").select("c_custkey", "c_mktsegment")
    return slices.chunks_per_group(held, "c_mktsegment", 50, "c_custkey")


def try_int_cast(spark, d):
    events = table(spark, d, "events")
    raw = F.when(F.col("event_id") % 2 == 0, F.col("event_id").cast("string")).otherwise(F.col("event_type"))
    return events.select("event_id", S.text(S.to_id(raw)).alias("parsed"))


def registry_malformed(spark, d):
    events = table(spark, d, "events")
    raw = F.when(F.col("event_id") % 2 == 0, F.col("event_id").cast("string")).otherwise(F.col("event_type"))
    return registry.malformed(events.select(raw.alias("accession"), "event_id"))


def in_out_strength(spark, d):
    return edges.strengths(nn_edges(spark, d))


def path_query_bag(spark, d):
    c = F.col
    start = table(spark, d, "region").filter("r_name = 'ASIA'").select(c("r_regionkey").alias("at"))
    nation = table(spark, d, "nation").select("n_regionkey", "n_nationkey", "n_name")
    customer, orders = table(spark, d, "customer").select("c_nationkey", "c_custkey"), table(spark, d, "orders").select("o_custkey", "o_orderkey")
    lineitem = table(spark, d, "lineitem").select("l_orderkey", "l_partkey")
    found = graph.path(start, (nation, "n_regionkey", "n_nationkey"), (customer, "c_nationkey", "c_custkey"), (orders, "o_custkey", "o_orderkey"), (lineitem, "l_orderkey", "l_partkey"))
    return found.select("n_name", c("at").alias("part"))


def url_rewrite(spark, d):
    url = S.prefix_swap(F.col("url"), "https://", "/archive/")
    return table(spark, d, "pages").select("page_id", url.alias("path"), S.folder(url).alias("folder"), S.in_folder(S.folder(url), "volume.swc").alias("file"))


def voxel_occupancy(spark, d):
    c = F.col
    points = table(spark, d, "lineitem").select(c("l_quantity").alias("x"), (c("l_discount") * 100).alias("y"), (c("l_tax") * 100).alias("z"))
    return artifacts.occupancy(points, pitch=(2.0, 1.5, 1.0), extent=(60.0, 60.0, 60.0))


def first_xref(spark, d):
    customer = table(spark, d, "customer").select(F.col("c_nationkey").cast("string").alias("accession"), F.col("c_name").alias("vfb_id"))
    return mapping.first_xref(customer)


def json_envelope(spark, d):
    return table(spark, d, "events").select("event_id", F.get_json_object("props", "$.k").alias("k"))


def envelope_rows(spark, d):
    """Customers as a nested answer of one result per segment, decoded again by position."""
    row = F.array(F.col("c_custkey").cast("string"), F.col("c_name"))
    data = table(spark, d, "customer").groupBy("c_mktsegment", F.pmod("c_custkey", F.lit(64))).agg(F.array(F.struct(F.collect_list(F.struct(row.alias("row"))).alias("data"))).alias("results"))
    return graph.rows_of_envelope(data, "accession", "neuron_label")


def artifact_plan(spark, d):
    c = F.col
    orders = table(spark, d, "orders")
    state = orders.select(
        c("o_orderkey").cast("string").alias("root_id"), F.concat(F.lit("/images/"), c("o_orderkey")).alias("folder"), (c("o_orderkey") % 2 == 0).alias("has_swc"), (c("o_orderkey") % 3 == 0).alias("has_obj"),
        (c("o_orderkey") % 5 == 0).alias("has_nrrd"), (c("o_orderpriority") == "1-URGENT").alias("redo"),
    )
    return artifacts.plan(state)


def matrix_unpivot(spark, d):
    supplier = table(spark, d, "supplier").filter("s_nationkey < 9")
    matrix = supplier.groupBy("s_nationkey").agg(*[F.nullif(F.count_if(F.pmod("s_suppkey", F.lit(5)) == k), F.lit(0)).alias(f"m{k}") for k in range(5)])
    return edges.unpivoted(matrix.select(F.col("s_nationkey").alias("source"), *[f"m{k}" for k in range(5)]))


def bool_checks(spark, d):
    held = table(spark, d, "lineitem")
    return held.agg(quality.any_null("l_shipdate").alias("any_null_date"), quality.all_equal("l_linenumber", "l_linenumber").alias("all_same"), quality.mismatches("l_suppkey", "l_partkey").alias("n_mismatch"))


def group_checks(spark, d):
    """By order: whether any date is missing, whether all line items are open, and how many aren't."""
    held = table(spark, d, "lineitem").filter("l_quantity > 46").withColumn("open", F.lit("O"))
    return held.groupBy("l_orderkey").agg(quality.any_null("l_shipdate").alias("any_null_date"), quality.all_equal("l_linestatus", "open").alias("all_open"), quality.mismatches("l_linestatus", "open").alias("n_closed"))


def limit_offset(spark, d):
    return slices.rows_between(table(spark, d, "customer").select("c_custkey", "c_name"), 100, 110, "c_custkey")


def supervoxel_roots(spark, d):
    c = F.col
    orders = table(spark, d, "orders")
    supervoxels = orders.groupBy(c("o_custkey").alias("supervoxel_id")).agg(F.min("o_orderkey").alias("root_id")).withColumn("snapshot", F.lit("s1"))
    return mapping.current_roots(table(spark, d, "customer").select(c("c_custkey").alias("supervoxel_id")), supervoxels, "s1").withColumn("mapped_root", S.text(F.col("mapped_root")))


def volume_edges(spark, d):
    c = F.col
    held = table(spark, d, "lineitem").select(c("l_suppkey").alias("source"), c("l_partkey").alias("target"), c("l_quantity").cast("bigint").alias("weight"), c("l_returnflag").alias("volume"))
    return edges.in_volume(held, "R")


def nodes_limited(spark, d):
    nodes, _ = customer_graph(spark, d)
    return graph.nodes_where(nodes, "Individual", F.col("label").isNotNull(), order=("short_form",), limit=100).select("short_form", "label")


def edge_pairs(spark, d):
    """Edges between suppliers as a tracing service gives them, both ends in one registry."""
    return edges.from_pairs(supply_edges(spark, d), supplier_ids(spark, d), 5)


def edge_downstream(spark, d):
    c = F.col
    held = table(spark, d, "lineitem").select(c("l_suppkey").alias("pre"), c("l_partkey").alias("post"), c("l_quantity").cast("bigint").alias("weight"), (c("l_returnflag") != "R").alias("clean"))
    return edges.from_downstream(held, table(spark, d, "supplier").select("s_suppkey"), 20, flags=("clean",))


def edge_regions(spark, d):
    c = F.col
    held = table(spark, d, "lineitem").select(c("l_suppkey").alias("bodyId_pre"), c("l_partkey").alias("bodyId_post"), c("l_shipdate").cast("string").alias("roi"), c("l_quantity").cast("bigint").alias("weight"))
    return edges.from_regions(held, table(spark, d, "supplier").select("s_suppkey"), 30)


def registered_images(spark, d):
    """Images of a data set's customers: one per order, registered to the template of its priority."""
    nodes, rels = customer_graph(spark, d)
    orders, c = table(spark, d, "orders"), F.col
    image, empty = F.concat(F.lit("O_"), c("o_orderkey")), F.lit(None).cast("array<string>")
    nodes = nodes.union(orders.select(image, F.lit(None).cast("string"), F.array(F.lit("Individual")))).union(orders.select("o_orderpriority").distinct().select("o_orderpriority", "o_orderpriority", F.array(F.lit("Template"))))
    all_rels = rels.select("src", "dst", "type", empty.alias("filename"), empty.alias("folder")).union(
        orders.select(image, F.concat(F.lit("C_"), c("o_custkey")), F.lit("depicts"), empty, empty)
    ).union(orders.select(image, "o_orderpriority", F.lit("in_register_with"), F.array(F.concat(image, F.lit(".swc"))), F.array(F.concat(F.lit("/images/"), c("o_orderpriority")))))
    return graph.registered_images(nodes, all_rels, "ASIA", template="1-URGENT")


def rows_with_gaps(spark, d):
    documents, labels = table(spark, d, "documents"), table(spark, d, "labels")
    return quality.lacking(documents.select("doc_id").join(labels, "doc_id", "left"), "quality", "toxic").select("doc_id")


def preview_rows(spark, d):
    return slices.preview(supply_edges(spark, d), 5, "source", "target", "weight")


def edge_synapses(spark, d):
    """Single synapses between neurons of a registry, counted by pair."""
    held = table(spark, d, "lineitem").select(F.col("l_suppkey").alias("pre_pt_root_id"), (F.col("l_partkey") % 50).alias("post_pt_root_id"))
    return edges.from_synapses(held, supplier_ids(spark, d), 2)


def template_extra(spark, d):
    """Template rows with further columns of the edges."""
    held = supply_edges(spark, d).select("*", F.concat(F.lit("n"), F.col("weight")).alias("note"))
    return template.rows(edges.over(held, 49), _xrefs(spark, d), strict=True, keep_extra=True)


def site_xrefs(spark, d):
    return mapping.xrefs_of_site(customer_graph(spark, d)[1], "BUILDING")


def mapped_edges(spark, d):
    """Edges under mapped ids, unmapped ends as null."""
    return mapping.mapped(edges.over(supply_edges(spark, d), 45), _xrefs(spark, d))


def date_stamps(spark, d):
    days = table(spark, d, "lineitem").select(S.date_stamp(F.col("l_shipdate")).alias("stamp"))
    return quality.value_counts(days, "stamp")


def chunks_by_segment(spark, d):
    return table(spark, d, "customer").groupBy("c_mktsegment").agg(S.chunks_needed(F.count(F.lit(1)), 7).alias("chunks"))


def grid_scaled(spark, d):
    """Whether a cell of the grid is filled, as 0 or 255."""
    return table(spark, d, "part").select("p_partkey", S.scaled(F.col("p_size") > 25).alias("value"))


def missing_texts(spark, d):
    """Names of missing values become null, whatever white space surrounds them."""
    raw = F.element_at(F.array(F.lit("NA"), F.lit(" nan "), F.lit(""), F.lit("<NA>"), F.lit("Nan"), F.col("p_name")), (F.col("p_partkey") % 6 + 1).cast("int"))
    return table(spark, d, "part").select("p_partkey", S.na_to_null(raw).alias("value"))


def registry_outcomes(spark, d):
    """What each site's registry comes to: no accession at all, malformed ones, or usable."""
    customer, nation = table(spark, d, "customer"), table(spark, d, "nation")
    accession = F.when(F.col("c_nationkey") % 3 == 0, F.lit(None)).when((F.col("c_nationkey") % 3 == 1) & (F.col("c_custkey") % 7 == 0), F.lit("x1")).otherwise(F.col("c_custkey").cast("string"))
    held = nation.select("n_nationkey", "n_name").join(customer, F.col("c_nationkey") == F.col("n_nationkey"), "left")
    return registry.outcomes(held.select("n_name", accession.alias("accession"), F.col("c_name").alias("neuron_id")).filter("neuron_id IS NOT NULL"), "n_name")


def usable_ids(spark, d):
    """Distinct ids; texts that aren't 64-bit integers are left out."""
    raw = F.when(F.col("event_id") % 3 == 0, F.concat(F.lit(" "), F.col("user_id"), F.lit(" "))).when(F.col("event_id") % 3 == 1, F.concat(F.col("user_id"), F.lit(".5"))).otherwise(F.lit("99999999999999999999"))
    return registry.to_ids(table(spark, d, "events").select(raw.alias("accession")))


def local_folders(spark, d):
    """Images at web addresses as local folders; ids that are no integers are left out."""
    body = F.when(F.col("page_id") % 2 == 0, F.col("page_id").cast("string")).otherwise(F.concat(F.lit("b"), F.col("page_id")))
    return artifacts.local_folders(table(spark, d, "pages").select(body.alias("body_id"), F.col("url").alias("folder")), "http://", "/data/")


def artifact_state(spark, d):
    """Which files each folder has, from an inventory."""
    orders, c = table(spark, d, "orders"), F.col
    folder = F.concat(F.lit("/images/"), c("o_custkey"))
    name = F.element_at(F.array(F.lit("volume.swc"), F.lit("volume_man.obj"), F.lit("volume.nrrd"), F.lit("thumbnail.png")), (c("o_orderkey") % 4 + 1).cast("int"))
    wanted = table(spark, d, "customer").select(c("c_custkey").cast("string").alias("root_id"), F.concat(F.lit("/images/"), c("c_custkey")).alias("folder"))
    return artifacts.state(wanted, orders.select(folder.alias("folder"), name.alias("name")))


def deletion_patterns(spark, d):
    from edgeloom.sinks import files

    return files.deletions(artifact_plan(spark, d))


def synapse_bursts(spark, d):
    """Bursts of a pair, as the stream's plan gives them over a table at rest; every third synapse comes twice."""
    from edgeloom.streaming import edges as streams

    held = table(spark, d, "events").select(F.col("ts").cast("timestamp").alias("ts"), (F.col("user_id") % 20).alias("pre"), (F.col("event_id") % 7).alias("post"), F.col("event_id").alias("synapse_id"))
    found = streams.sessions(held.union(held.filter("synapse_id % 3 = 0")), gap="2 hours")
    return found.select(F.date_format("begins", "yyyy-MM-dd HH:mm:ss").alias("begins"), F.date_format("ends", "yyyy-MM-dd HH:mm:ss").alias("ends"), "source", "target", "weight")


def edges_by_sql(spark, d):
    """Summed edges between registered ids with their strengths, from the SQL table functions."""
    from edgeloom.functions import tables

    ids = table(spark, d, "supplier").filter("s_acctbal > 0").select(F.col("s_suppkey").alias("id")).union(table(spark, d, "part").filter("p_size <= 25").select("p_partkey"))
    for name, held in (("edges", supply_edges(spark, d)), ("ids", ids), ("xrefs", _xrefs(spark, d))):
        held.createOrReplaceTempView(f"edgeloom_{name}")
    tables.register(spark, "edgeloom_edges", "edgeloom_ids", "edgeloom_xrefs", prefix="edgeloom_")
    return spark.sql("SELECT e.source, e.target, e.weight, s.outgoing, s.in_degree FROM edgeloom_edges_summed(40) e JOIN edgeloom_node_strengths() s ON e.source = s.node")


def windowed_synapses(spark, d):
    """Synapses counted by pair and window, as the stream's plan gives them over a table at rest."""
    from edgeloom.streaming import edges as streams

    held = table(spark, d, "events").select(F.col("ts").cast("timestamp").alias("ts"), (F.col("user_id") % 20).alias("pre"), (F.col("event_id") % 7).alias("post"))
    found = streams.windowed_counts(held, spark.range(15).toDF("accession"), window="1 day")
    return found.select(F.date_format("window_start", "yyyy-MM-dd").alias("day"), "source", "target", "weight")


def running_weights(spark, d):
    from edgeloom.streaming import edges as streams

    return streams.running_weights(supply_edges(spark, d), 60)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        registry_pattern, registry_by_site, registry_by_dataset, registry_accessions, edge_threshold, edge_induced, edge_roi_sum, edge_synapse_count, edge_file, nn_edges_homogeneous, template_rows,
        template_induced, template_assertions, unmapped_ids, missing_report, missing_rows, curation_neuprint, curation_regex, curation_banc, curation_flywire, curation_minimal, drop_ambiguous,
        ambiguous_report, value_counts, batch_number, chunk_per_sample, try_int_cast, registry_malformed, in_out_strength, path_query_bag, url_rewrite, voxel_occupancy, first_xref, json_envelope,
        envelope_rows, artifact_plan, matrix_unpivot, bool_checks, group_checks, limit_offset, supervoxel_roots, volume_edges, nodes_limited,
        edge_pairs, edge_downstream, edge_regions, registered_images, rows_with_gaps, preview_rows,
        edge_synapses, template_extra, site_xrefs, mapped_edges, date_stamps, chunks_by_segment, grid_scaled, missing_texts, registry_outcomes, usable_ids, local_folders, artifact_state, deletion_patterns, windowed_synapses, synapse_bursts, edges_by_sql, running_weights,
        batch_of_items,
    )
}

entry = template_induced

_EDGES = "SELECT l_suppkey AS source, l_partkey AS target, CAST(l_quantity AS BIGINT) AS weight FROM lineitem"
_INDUCED = f"SELECT * FROM ({_EDGES}) WHERE source IN (SELECT s_suppkey FROM supplier WHERE s_acctbal > 0) AND target IN (SELECT p_partkey FROM part WHERE p_size <= 25)"
_XREFS = "SELECT accession, min(vfb_id) AS vfb_id FROM (SELECT CAST(s_suppkey AS VARCHAR) AS accession, 'KB_s_' || s_suppkey AS vfb_id FROM supplier UNION ALL SELECT CAST(p_partkey AS VARCHAR), 'KB_t_' || p_partkey FROM part WHERE p_partkey > 1000) GROUP BY accession"
_HEAD = "SELECT 'ID' AS \"ID\", 'TYPE' AS \"TYPE\", 'I ''synapsed to''' AS \"FACT\", '>AT n2o:weight^^xsd:integer' AS \"Weight\""
_NN = "SELECT CAST(c_nationkey AS BIGINT) AS source, CAST(s_nationkey AS BIGINT) AS target, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS weight FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN supplier ON l_suppkey = s_suppkey GROUP BY ALL"
_MEMBERS = "SELECT DISTINCT CAST(c_custkey AS VARCHAR) AS accession, 'C_' || c_custkey AS neuron_id, c_name AS neuron_label FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey"
_MATRIX = "SELECT s_nationkey, " + ", ".join(f"nullif(count(*) FILTER (WHERE s_suppkey % 5 = {k}), 0) AS m{k}" for k in range(5)) + " FROM supplier WHERE s_nationkey < 9 GROUP BY s_nationkey"

ORACLES: dict[str, str] = {
    "registry_pattern": f"{_MEMBERS} WHERE r_name = 'ASIA' AND c_mktsegment = 'BUILDING'",
    "registry_by_site": f"{_MEMBERS} WHERE c_mktsegment = 'MACHINERY'",
    "registry_by_dataset": f"{_MEMBERS} WHERE r_name = 'EUROPE'",
    "registry_accessions": f"SELECT DISTINCT accession FROM ({_MEMBERS} WHERE r_name = 'ASIA' AND c_mktsegment = 'BUILDING')",
    "edge_threshold": f"SELECT * FROM ({_EDGES}) WHERE weight > 40",
    "edge_induced": _INDUCED,
    "edge_roi_sum": f"SELECT source, target, CAST(sum(weight) AS BIGINT) AS weight FROM ({_EDGES}) GROUP BY ALL HAVING sum(weight) > 50",
    "edge_synapse_count": f"SELECT source, target, count(*) AS weight FROM ({_EDGES}) WHERE target IN (SELECT p_partkey FROM part WHERE p_size <= 25) GROUP BY ALL HAVING count(*) > 1",
    "edge_file": f"SELECT * FROM ({_EDGES}) WHERE weight > 10 AND source != 0 AND target != 0 AND source IN (SELECT s_suppkey FROM supplier) AND target IN (SELECT s_suppkey FROM supplier)",
    "nn_edges_homogeneous": f"SELECT * FROM ({_NN}) WHERE weight > 0",
    "template_rows": f"{_HEAD} UNION ALL SELECT coalesce(replace(a.vfb_id, '_', ':'), ''), 'owl:NamedIndividual', coalesce(replace(b.vfb_id, '_', ':'), ''), CAST(weight AS VARCHAR) FROM ({_EDGES}) e LEFT JOIN ({_XREFS}) a ON CAST(e.source AS VARCHAR) = a.accession LEFT JOIN ({_XREFS}) b ON CAST(e.target AS VARCHAR) = b.accession",
    "template_induced": f"{_HEAD} UNION ALL SELECT replace(a.vfb_id, '_', ':'), 'owl:NamedIndividual', replace(b.vfb_id, '_', ':'), CAST(weight AS VARCHAR) FROM ({_INDUCED}) e JOIN ({_XREFS}) a ON CAST(e.source AS VARCHAR) = a.accession JOIN ({_XREFS}) b ON CAST(e.target AS VARCHAR) = b.accession",
    "template_assertions": f"""SELECT 'ObjectPropertyAssertion(Annotation(n2o:weight "' || weight || '"^^xsd:integer) ''synapsed to'' ' || replace(a.vfb_id, '_', ':') || ' ' || replace(b.vfb_id, '_', ':') || ')' AS value FROM ({_INDUCED}) e JOIN ({_XREFS}) a ON CAST(e.source AS VARCHAR) = a.accession JOIN ({_XREFS}) b ON CAST(e.target AS VARCHAR) = b.accession WHERE weight > 45""",
    "unmapped_ids": f"SELECT DISTINCT id FROM (SELECT source AS id FROM ({_INDUCED}) UNION ALL SELECT target FROM ({_INDUCED})) WHERE CAST(id AS VARCHAR) NOT IN (SELECT accession FROM ({_XREFS}))",
    "missing_report": "SELECT count(*) AS total, count(*) FILTER (WHERE quality IS NULL) AS missing, CAST(0 AS BIGINT) AS malformed FROM documents LEFT JOIN labels USING (doc_id)",
    "missing_rows": "SELECT CAST(doc_id AS VARCHAR) AS neuron_id, CASE WHEN doc_id % 3 != 0 THEN source ELSE 'No label' END AS neuron_label FROM documents LEFT JOIN labels USING (doc_id) WHERE quality IS NULL",
    "curation_neuprint": "SELECT 'KB_' || p_partkey AS anat_id, p_partkey AS filename, 'adult neuron' AS is_a, 'male organism|adult ventral nerve cord' AS part_of, p_name || ' (MANC:' || p_partkey || ')' AS label, 'tracing status-' || CASE WHEN p_size % 7 != 0 THEN p_brand END || CASE WHEN p_size % 3 = 0 THEN '' WHEN p_size % 3 = 1 THEN ', cropped-True' ELSE ', cropped-False' END || ', MANC classification: class-' || coalesce(CASE WHEN p_size > 10 THEN p_type END, 'None') || ', subclass-' || coalesce(CASE WHEN p_size > 20 THEN p_brand END, 'None') || ', systematic type-None' AS comment, 'neuprint_JRC_Manc:' || p_partkey AS dbxrefs FROM part",
    "curation_regex": r"SELECT p_partkey AS filename, 'adult neuron' AS is_a, 'male organism' AS part_of, p_name || ' (JRC_OpticLobe:' || p_partkey || ')' AS label, 'status-' || p_brand || ', status label-' || p_brand || ', Optic Lobe classification: type-' || t AS comment, 'neuprint_JRC_OpticLobe_v1_0:' || p_partkey AS dbxrefs FROM (SELECT *, CASE WHEN p_size % 10 = 0 THEN p_type || ' (x)' WHEN p_size % 10 = 1 THEN 'TBD ' || p_type ELSE p_type END AS t FROM part) WHERE NOT regexp_matches(t, 'unclear|TBD|\(') AND p_size % 9 != 0",
    "curation_banc": "SELECT p_partkey AS filename, 'adult neuron' AS is_a, 'adult brain|adult ventral nerve cord' AS part_of, 'BANC:' || p_partkey AS label, 'BANC connectome neuron' AS comment, 'flywire_banc:' || p_partkey AS dbxrefs FROM part",
    "curation_flywire": "WITH r AS (SELECT o_custkey, min(o_orderkey) % 500 AS root FROM orders GROUP BY o_custkey), a AS (SELECT *, count(*) OVER (PARTITION BY root) AS n FROM customer LEFT JOIN r ON c_custkey = o_custkey WHERE c_custkey % 5 != 0) SELECT 'VFB_' || c_custkey AS anat_id, root AS filename, 'adult neuron' AS is_a, 'female organism|adult brain' AS part_of, 'FlyWire:' || c_custkey * 10 AS label, CASE WHEN c_custkey % 4 != 0 THEN 'status-' || c_mktsegment ELSE '' END || 'FlyWire classification: flow-' || c_mktsegment || ', superclass-' || CASE WHEN c_nationkey > 5 THEN c_name ELSE 'None' END || ', class-None, subclass-None, cell type-' || c_name || ', hemibrain type-None. FBbt_id annotation-None. supervoxel id-' || c_custkey AS comment, 'flywire783:' || coalesce(CAST(root AS VARCHAR), 'None') || '|flywire_supervoxel:' || c_custkey AS dbxrefs FROM a WHERE n = 1",
    "curation_minimal": "SELECT CAST(p_partkey AS VARCHAR) AS filename, p_name || ' - ' || p_partkey AS label, 'neuron' AS is_a, 'female organism|adult brain' AS part_of, 'neuprint_JRC_Hemibrain_1point1:' || p_partkey AS dbxrefs, 'tracing status-' || p_brand || ', cropped-' || CASE WHEN p_size % 2 = 0 THEN 'True' ELSE 'False' END AS comment FROM part WHERE p_size > 3",
    "drop_ambiguous": "SELECT doc_id, n_chars FROM (SELECT doc_id, n_chars, count(*) OVER (PARTITION BY n_chars) AS n FROM documents) WHERE n = 1",
    "ambiguous_report": "SELECT * FROM (SELECT doc_id, n_chars, count(*) OVER (PARTITION BY n_chars) AS times FROM documents) WHERE times > 1",
    "value_counts": "SELECT n_chars, count(*) AS n FROM documents WHERE n_chars IS NOT NULL GROUP BY n_chars",
    "batch_number": "SELECT CAST(floor(i / 100) AS BIGINT) AS batch, min(c_custkey) AS first_key, count(*) AS n FROM (SELECT c_custkey, row_number() OVER (ORDER BY c_custkey) - 1 AS i FROM customer) GROUP BY batch",
    "chunk_per_sample": "SELECT c_custkey, c_mktsegment, CAST((row_number() OVER (PARTITION BY c_mktsegment ORDER BY c_custkey) - 1) // 50 AS BIGINT) AS chunk FROM customer",
    "try_int_cast": "SELECT event_id, CAST(TRY_CAST(CASE WHEN event_id % 2 = 0 THEN CAST(event_id AS VARCHAR) ELSE event_type END AS BIGINT) AS VARCHAR) AS parsed FROM events",
    "registry_malformed": "SELECT event_type AS accession, event_id FROM events WHERE event_id % 2 = 1 AND event_type IS NOT NULL",
    "in_out_strength": f"SELECT node, CAST(sum(o) AS BIGINT) AS outgoing, CAST(sum(i) AS BIGINT) AS incoming, CAST(sum(od) AS BIGINT) AS out_degree, CAST(sum(id) AS BIGINT) AS in_degree FROM (SELECT source AS node, weight AS o, 0 AS i, 1 AS od, 0 AS id FROM ({_NN}) UNION ALL SELECT target, 0, weight, 0, 1 FROM ({_NN})) GROUP BY node",
    "path_query_bag": "SELECT n_name, l_partkey AS part FROM region JOIN nation ON r_regionkey = n_regionkey JOIN customer ON n_nationkey = c_nationkey JOIN orders ON c_custkey = o_custkey JOIN lineitem ON o_orderkey = l_orderkey WHERE r_name = 'ASIA'",
    "url_rewrite": "SELECT page_id, u AS path, regexp_replace(u, '/[^/]*$', '') AS folder, regexp_replace(regexp_replace(u, '/[^/]*$', ''), '/+$', '') || '/volume.swc' AS file FROM (SELECT page_id, replace(url, 'https://', '/archive/') AS u FROM pages)",
    "voxel_occupancy": "SELECT DISTINCT CAST(floor(l_quantity / 2.0) AS INTEGER) AS x_voxel, CAST(floor(l_discount * 100 / CAST(1.5 AS DOUBLE)) AS INTEGER) AS y_voxel, CAST(floor(l_tax * 100 / CAST(1.0 AS DOUBLE)) AS INTEGER) AS z_voxel, CAST(255 AS SMALLINT) AS value FROM lineitem WHERE l_quantity BETWEEN 0 AND 60 AND l_discount * 100 BETWEEN 0 AND 60 AND l_tax * 100 BETWEEN 0 AND 60",
    "first_xref": "SELECT CAST(c_nationkey AS VARCHAR) AS accession, min(c_name) AS vfb_id FROM customer GROUP BY c_nationkey",
    "json_envelope": "SELECT event_id, json_extract_string(props, '$.k') AS k FROM events",
    "envelope_rows": "SELECT CAST(c_custkey AS VARCHAR) AS accession, c_name AS neuron_label FROM customer",
    "artifact_plan": "SELECT o_orderkey AS root_id, '/images/' || o_orderkey AS folder, d OR NOT s AS make_swc, d OR NOT o AS make_obj, d OR NOT n AS make_nrrd, d AS delete_first FROM (SELECT *, r AND (s OR o) AS d FROM (SELECT o_orderkey, o_orderkey % 2 = 0 AS s, o_orderkey % 3 = 0 AS o, o_orderkey % 5 = 0 AS n, o_orderpriority = '1-URGENT' AS r FROM orders)) WHERE NOT (s AND o AND n) OR r",
    "matrix_unpivot": " UNION ALL ".join(f"SELECT s_nationkey AS source, 'm{k}' AS target, m{k} AS weight FROM ({_MATRIX}) WHERE m{k} IS NOT NULL" for k in range(5)),
    "group_checks": "SELECT l_orderkey, bool_or(l_shipdate IS NULL) AS any_null_date, bool_and(l_linestatus = 'O') AS all_open, count(*) FILTER (WHERE l_linestatus != 'O') AS n_closed FROM lineitem WHERE l_quantity > 46 GROUP BY ALL",
    "bool_checks": "SELECT bool_or(l_shipdate IS NULL) AS any_null_date, bool_and(coalesce(l_linenumber = l_linenumber, false)) AS all_same, count(*) FILTER (WHERE l_suppkey != l_partkey) AS n_mismatch FROM lineitem",
    "limit_offset": "SELECT c_custkey, c_name FROM customer ORDER BY c_custkey LIMIT 10 OFFSET 100",
    "supervoxel_roots": "SELECT c_custkey AS supervoxel_id, CAST(root AS VARCHAR) AS mapped_root FROM customer LEFT JOIN (SELECT o_custkey, min(o_orderkey) AS root FROM orders GROUP BY o_custkey) ON c_custkey = o_custkey",
    "volume_edges": "SELECT l_suppkey AS source, l_partkey AS target, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS weight FROM lineitem WHERE l_returnflag = 'R' GROUP BY ALL HAVING sum(CAST(l_quantity AS BIGINT)) != 0",
    "nodes_limited": "SELECT 'C_' || c_custkey AS short_form, c_name AS label FROM customer WHERE c_name IS NOT NULL ORDER BY short_form LIMIT 100",
    "edge_pairs": f"SELECT * FROM ({_EDGES}) WHERE weight > 5 AND source IN (SELECT s_suppkey FROM supplier WHERE s_acctbal > 0) AND target IN (SELECT s_suppkey FROM supplier WHERE s_acctbal > 0)",
    "edge_downstream": "SELECT l_suppkey AS source, l_partkey AS target, CAST(l_quantity AS BIGINT) AS weight FROM lineitem WHERE l_returnflag != 'R' AND l_quantity > 20 AND l_suppkey IN (SELECT s_suppkey FROM supplier) AND l_partkey IN (SELECT s_suppkey FROM supplier)",
    "edge_regions": f"SELECT source, target, CAST(sum(weight) AS BIGINT) AS weight FROM ({_EDGES}) WHERE source IN (SELECT s_suppkey FROM supplier) AND target IN (SELECT s_suppkey FROM supplier) GROUP BY ALL HAVING sum(weight) > 30",
    "registered_images": "SELECT 'O_' || o_orderkey || '.swc' AS body_id, '/images/' || o_orderpriority AS folder FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey WHERE r_name = 'ASIA' AND o_orderpriority = '1-URGENT'",
    "rows_with_gaps": "SELECT doc_id FROM documents LEFT JOIN labels USING (doc_id) WHERE quality IS NULL OR toxic IS NULL",
    "preview_rows": f"SELECT * FROM ({_EDGES}) ORDER BY source, target, weight LIMIT 5",
    "edge_synapses": "SELECT l_suppkey AS source, l_partkey % 50 AS target, count(*) AS weight FROM lineitem WHERE l_suppkey IN (SELECT s_suppkey FROM supplier WHERE s_acctbal > 0) AND l_partkey % 50 IN (SELECT s_suppkey FROM supplier WHERE s_acctbal > 0) GROUP BY ALL HAVING count(*) > 2",
    "template_extra": f"SELECT replace(a.vfb_id, '_', ':') AS \"ID\", 'owl:NamedIndividual' AS \"TYPE\", replace(b.vfb_id, '_', ':') AS \"FACT\", CAST(weight AS VARCHAR) AS \"Weight\", 'n' || weight AS note FROM ({_EDGES}) e JOIN ({_XREFS}) a ON CAST(e.source AS VARCHAR) = a.accession JOIN ({_XREFS}) b ON CAST(e.target AS VARCHAR) = b.accession WHERE weight > 49",
    "site_xrefs": "SELECT CAST(c_custkey AS VARCHAR) AS accession, 'C_' || c_custkey AS vfb_id FROM customer WHERE c_mktsegment = 'BUILDING'",
    "mapped_edges": f"SELECT a.vfb_id AS source, b.vfb_id AS target, weight FROM ({_EDGES}) e LEFT JOIN ({_XREFS}) a ON CAST(e.source AS VARCHAR) = a.accession LEFT JOIN ({_XREFS}) b ON CAST(e.target AS VARCHAR) = b.accession WHERE weight > 45",
    "date_stamps": "SELECT strftime(l_shipdate, '%y%m%d') AS stamp, count(*) AS n FROM lineitem WHERE l_shipdate IS NOT NULL GROUP BY stamp",
    "chunks_by_segment": "SELECT c_mktsegment, CAST(ceil(count(*) / 7) AS BIGINT) AS chunks FROM customer GROUP BY c_mktsegment",
    "grid_scaled": "SELECT p_partkey, CAST(CASE WHEN p_size > 25 THEN 255 ELSE 0 END AS SMALLINT) AS value FROM part",
    "missing_texts": "SELECT p_partkey, CASE p_partkey % 6 WHEN 4 THEN 'Nan' WHEN 5 THEN p_name END AS value FROM part",
    "registry_outcomes": "SELECT n_name, CASE WHEN n_nationkey % 3 = 0 THEN 'no accession' WHEN count(*) FILTER (WHERE n_nationkey % 3 = 1 AND c_custkey % 7 = 0) > 0 THEN 'malformed' ELSE 'usable' END AS outcome FROM nation JOIN customer ON c_nationkey = n_nationkey GROUP BY n_name, n_nationkey",
    "usable_ids": "SELECT DISTINCT user_id AS accession FROM events WHERE event_id % 3 = 0 AND user_id IS NOT NULL",
    "local_folders": "SELECT page_id AS body_id, f AS folder, f || '/volume.swc' AS swc_path, f || '/volume_man.obj' AS obj_path, f || '/volume.nrrd' AS nrrd_path FROM (SELECT page_id, regexp_replace(replace(url, 'http://', '/data/'), '/[^/]*$', '') AS f FROM pages WHERE page_id % 2 = 0)",
    "artifact_state": "SELECT CAST(c_custkey AS VARCHAR) AS root_id, '/images/' || c_custkey AS folder, coalesce(bool_or(o_orderkey % 4 = 0), false) AS has_swc, coalesce(bool_or(o_orderkey % 4 = 1), false) AS has_obj, coalesce(bool_or(o_orderkey % 4 = 2), false) AS has_nrrd FROM customer LEFT JOIN orders ON c_custkey = o_custkey GROUP BY c_custkey",
    "deletion_patterns": "SELECT '/images/' || o_orderkey AS folder, unnest(['volume*', 'thumbnail*']) AS pattern FROM orders WHERE o_orderpriority = '1-URGENT' AND (o_orderkey % 2 = 0 OR o_orderkey % 3 = 0)",
    "synapse_bursts": """SELECT strftime(min(ts), '%Y-%m-%d %H:%M:%S') AS begins, strftime(max(ts) + INTERVAL 2 HOUR, '%Y-%m-%d %H:%M:%S') AS ends, source, target, count(*) AS weight FROM (
      SELECT *, sum(CASE WHEN ts >= last + INTERVAL 2 HOUR THEN 1 ELSE 0 END) OVER (PARTITION BY source, target ORDER BY ts) AS burst FROM (
        SELECT ts, user_id % 20 AS source, event_id % 7 AS target, lag(ts) OVER (PARTITION BY user_id % 20, event_id % 7 ORDER BY ts) AS last FROM events) a) b GROUP BY source, target, burst""",
    "edges_by_sql": f"""WITH e AS ({_EDGES}), i AS (SELECT s_suppkey AS id FROM supplier WHERE s_acctbal > 0 UNION SELECT p_partkey FROM part WHERE p_size <= 25),
      s AS (SELECT node, CAST(sum(w) AS BIGINT) AS outgoing, CAST(count(*) FILTER (WHERE NOT way) AS BIGINT) AS in_degree FROM (SELECT source AS node, weight AS w, true AS way FROM e UNION ALL SELECT target, 0, false FROM e) GROUP BY node)
      SELECT source, target, weight, outgoing, in_degree FROM (SELECT source, target, CAST(sum(weight) AS BIGINT) AS weight FROM e WHERE source IN (SELECT id FROM i) AND target IN (SELECT id FROM i) GROUP BY ALL) p JOIN s ON node = source WHERE weight > 40""",
    "windowed_synapses": "SELECT strftime(ts, '%Y-%m-%d') AS day, user_id % 20 AS source, event_id % 7 AS target, count(*) AS weight FROM events WHERE user_id % 20 < 15 GROUP BY ALL",
    "running_weights": f"SELECT source, target, CAST(sum(weight) AS BIGINT) AS weight FROM ({_EDGES}) GROUP BY ALL HAVING sum(weight) > 60",
    "batch_of_items": "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, CAST((row_number() OVER (ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice) - 1) // 1000 AS BIGINT) AS batch FROM lineitem",
}
