"""Null, type and order rules of the operators on literal rows."""

import datetime
import gzip

import pytest
from pyspark.sql import functions as F

from edgeloom.functions import scalars as S
from edgeloom.operators import artifacts, curation, edges, graph, mapping, quality, registry, slices, template
from edgeloom.plans.flows import induced_template
from edgeloom.sinks import files
from edgeloom.sources import readers, schemas


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.fixture(scope="module")
def kb(spark):
    nodes = spark.createDataFrame(
        [("n1", "one", ["Individual"]), ("n2", None, ["Individual"]), ("n3", "three", ["Individual"]), ("n4", "no site", ["Individual"]), ("c1", "image", ["Individual"]), ("D", "data", ["DataSet"]), ("S", "site", ["Site"]), ("S2", "other", ["Site"]), ("T", "template", ["Template"])],
        schemas.NODES,
    )
    rel = lambda src, dst, kind, acc=None, file=None, folder=None: (src, dst, kind, acc, file, folder)
    rels = spark.createDataFrame(
        [
            rel("n1", "D", "has_source"), rel("D", "n2", "has_source"), rel("n4", "D", "has_source"), rel("n1", "S", "database_cross_reference", ["11", "x"]), rel("S", "n2", "hasDbXref", ["22"]), rel("n3", "S", "hasDbXref", []),
            rel("n1", "S2", "hasDbXref", ["bad"]), rel("c1", "n1", "depicts"), rel("c1", "T", "in_register_with", None, ["11.swc"], ["http://x/data/1/"]), rel("c1", "T", "in_register_with", None, ["11.swc"], ["http://x/data/1/"]),
        ],
        schemas.RELS,
    )
    return nodes, rels


def test_registry_patterns(kb):
    nodes, rels = kb
    assert rows(graph.registry(nodes, rels, "D", "S")) == [("11", "n1", "one"), ("22", "n2", None)]
    assert rows(graph.registry(nodes, rels, site="S")) == [("11", "n1", "one"), ("22", "n2", None), (None, "n3", "three")]
    assert rows(graph.registry(nodes, rels, "D")) == [("11", "n1", "one"), ("22", "n2", None), ("bad", "n1", "one")]
    assert rows(graph.registry_ids(nodes, rels, "D", "S")) == [("11",), ("22",)]
    with pytest.raises(ValueError):
        graph.registry(nodes, rels)


def test_image_paths_are_bags(kb):
    nodes, rels = kb
    assert rows(graph.registered_images(nodes, rels, "D")) == [("11.swc", "http://x/data/1/")] * 2
    assert rows(graph.registered_images(nodes, rels, "D", "S", "T")) == [("11", "http://x/data/1/")] * 2


def test_checked_ids(spark, kb):
    nodes, rels = kb
    assert rows(registry.checked_ids(graph.registry(nodes, rels, site="S"))) == [(11,), (22,)]
    with pytest.raises(registry.BadAccession):
        registry.checked_ids(graph.registry(nodes, rels, "D"))
    with pytest.raises(registry.EmptyRegistry):
        registry.checked_ids(graph.registry(nodes, rels, "none"))
    with pytest.raises(registry.EmptyRegistry):
        registry.checked_ids(spark.createDataFrame([(None, "n", "l")], schemas.REGISTRY))
    odd = spark.createDataFrame([(" 12 ", "a", None), ("1_000", "b", "x"), ("1.9", "c", "x"), (None, None, None), ("99999999999999999999", "d", "x")], schemas.REGISTRY)
    assert rows(registry.to_ids(odd)) == [(12,)]
    assert rows(registry.missing(odd)) == [("UNKNOWN", "No label")]
    assert rows(registry.summary(odd)) == [(5, 1, 3)]


def test_edge_sources(spark):
    ids = spark.createDataFrame([(1,), (2,), (2,), (3,)], "accession bigint")
    regions = spark.createDataFrame([(1, 2, "a", 1), (1, 2, "b", 1), (2, 3, "a", None), (2, 3, "b", None), (None, 2, "a", 9), (1, 9, "a", 9), (3, 3, "a", 2)], schemas.EDGES_BY_REGION)
    assert rows(edges.from_regions(regions, ids, 1)) == [(1, 2, 2), (3, 3, 2)]
    assert rows(edges.from_regions(regions, ids, 2)) == []
    assert rows(edges.from_regions(regions, ids, -1)) == [(1, 2, 2), (2, 3, 0), (3, 3, 2)]
    synapses = spark.createDataFrame([(1, 2)] * 3 + [(1, 9), (None, 2), (2, 1)], schemas.SYNAPSES)
    assert rows(edges.from_synapses(synapses, ids, 1)) == [(1, 2, 3)]
    held = spark.createDataFrame([(0, 1, 50), (1, 2, 3), (1, 3, 10), (2, 3, 11), (1, 9, 99), (3, 1, None)], schemas.EDGE_FILE)
    assert rows(edges.from_file(held, ids, 10)) == [(2, 3, 11)]
    assert rows(edges.from_file(held, ids, 0)) == [(1, 2, 3), (1, 3, 10), (2, 3, 11)]
    zero = spark.createDataFrame([(0,), (1,)], "accession bigint")
    assert rows(edges.from_file(held, zero, 0)) == [(0, 1, 50)] and rows(edges.from_file(held, zero, 0, background=0)) == []
    down = spark.createDataFrame([(1, 2, 5, True, "x"), (1, 2, 7, False, "y"), (2, 2, 0, True, "z")], "pre bigint, post bigint, weight bigint, clean boolean, note string")
    assert rows(edges.from_downstream(down, ids)) == [(1, 2, 5), (1, 2, 7)]
    assert rows(edges.from_downstream(down, ids, flags=("clean",))) == [(1, 2, 5)]
    with pytest.raises(schemas.MissingColumns):
        edges.from_pairs(down, ids)


def test_induced_properties(spark):
    import random

    rng = random.Random(1)
    table = spark.createDataFrame([(rng.randint(1, 30), rng.randint(1, 30), rng.randint(1, 9)) for _ in range(400)], schemas.EDGES)
    ids = spark.createDataFrame([(i,) for i in range(1, 20)], "accession bigint")
    inside = edges.within(table, ids)
    assert rows(edges.within(inside, ids)) == rows(inside)
    assert set(rows(inside)) <= set(rows(table))
    assert set(rows(edges.over(table, 5))) <= set(rows(edges.over(table, 3)))
    total = lambda df, c: df.agg(F.sum(c)).first()[0]
    assert total(edges.summed(table), "weight") == total(table, "weight")
    strengths = edges.strengths(table)
    assert total(strengths, "incoming") == total(strengths, "outgoing") == total(table, "weight")


def test_mapping_keeps_rows(spark):
    table = spark.createDataFrame([(1, 2, 3), (1, 4, 5), (7, 7, 1)], schemas.EDGES)
    xrefs = spark.createDataFrame([("1", "KB_b"), ("1", "KB_a"), ("2", "KB_fw_2"), (None, "KB_x")], schemas.XREFS)
    assert rows(mapping.mapped(table, xrefs)) == sorted([("KB_a", "KB_fw_2", 3), ("KB_a", None, 5), (None, None, 1)], key=repr)
    assert rows(mapping.unmapped(table, xrefs)) == [(4,), (7,)]


def test_template_bytes(spark, tmp_path):
    table = spark.createDataFrame([(1, 2, 3), (1, 4, 5)], schemas.EDGES)
    xrefs = spark.createDataFrame([("1", "KB_fw_01"), ("2", 'KB_"q'), ("4", None)], schemas.XREFS)
    head = "ID\tTYPE\tFACT\tWeight\nID\tTYPE\tI 'synapsed to'\t>AT n2o:weight^^xsd:integer\n"
    files.template_tsv(template.template(table, xrefs, order="_o"), f"{tmp_path}/t.tsv", "_o")
    assert (tmp_path / "t.tsv").read_text() == head + 'KB:fw:01\towl:NamedIndividual\t\t5\nKB:fw:01\towl:NamedIndividual\t"KB:""q"\t3\n'
    files.template_tsv(template.template(table.limit(0), xrefs, order="_o"), f"{tmp_path}/e.tsv", "_o")
    assert (tmp_path / "e.tsv").read_text() == head
    assert template.template(table, xrefs, strict=True).count() == 2
    extra = template.rows(table.withColumn("note", F.lit("x")), xrefs, keep_extra=True)
    assert extra.columns == ["ID", "TYPE", "FACT", "Weight", "note"]


def test_curation_text_rules(spark):
    neurons = spark.createDataFrame([(1, "a", "i", "ok", True, "c", None, "s"), (2, "b", None, None, False, None, None, None), (3, "c", "k", "ok", None, None, "d", None), (4, None, "x", "ok", True, "c", "c", "c")], schemas.NERVE_CORD_NEURONS)
    found = {r["filename"]: r for r in curation.nerve_cord(neurons).collect()}
    assert sorted(found) == [1, 2, 3]
    assert found[1]["comment"] == "tracing status-ok, cropped-True, MANC classification: class-c, subclass-None, systematic type-s"
    assert found[2]["comment"] is None and found[2]["label"] is None
    assert found[3]["comment"] == "tracing status-ok, MANC classification: class-None, subclass-d, systematic type-None" and found[3]["label"] == "k (MANC:3)"
    lobe = spark.createDataFrame([(1, "unclear", "i", "s", "t"), (2, "Unclear", "i", "s", "t"), (3, "A(b", "i", "s", "t"), (4, "TBD1", "i", "s", "t"), (5, "ok", None, "s", "t"), (6, None, "i", "s", "t")], schemas.OPTIC_LOBE_NEURONS)
    assert [r[0] for r in rows(curation.optic_lobe(lobe).select("filename"))] == [2, 6]
    assert curation.optic_lobe(lobe).columns[0] == "filename"


def test_annotated_roots(spark, tmp_path):
    big = 720575940621280688
    (tmp_path / "a.tsv").write_text(
        "vfb_id\tsupervoxel_id\troot_id\tstatus\tflow\tsuper_class\tcell_class\tcell_sub_class\tcell_type\themibrain_type\tfbbt_id\textra\n"
        f"0001\t10\t{big}\tok\tintrinsic\tNA\tNone\tn/a\tt\t\tFBbt_1\tz\n0002\t11\t\t\tf\ts\tc\tu\tt\th\tb\tz\n\t12\t5\tok\tf\ts\tc\tu\tt\th\tb\tz\n0004\t13\t6\tok\tf\ts\tc\tu\tt\th\tb\tz\n0005\t14\t7\tok\tf\ts\tc\tu\tt\th\tb\tz\n"
    )
    table = readers.annotations(spark, str(tmp_path / "a.tsv"))
    assert table.filter("vfb_id = '0001'").first()["root_id"] == big
    supervoxels = spark.createDataFrame([(10, big + 1, "m"), (11, 77, "m"), (13, 88, "m"), (14, 88, "m"), (10, 1, "old")], schemas.SUPERVOXELS)
    found = {r["anat_id"]: r for r in curation.annotated_roots(table, supervoxels, "m").collect()}
    assert sorted(found) == ["VFB_0001", "VFB_0002"]
    one = found["VFB_0001"]
    assert one["label"] == f"FlyWire:{big}" and one["filename"] == big + 1 and one["dbxrefs"] == f"flywire783:{big + 1}|flywire_supervoxel:10"
    assert one["comment"] == "status-okFlyWire classification: flow-intrinsic, superclass-None, class-None, subclass-None, cell type-t, hemibrain type-None. FBbt_id annotation-FBbt_1. supervoxel id-10"
    assert found["VFB_0002"]["label"] is None and found["VFB_0002"]["comment"].startswith("FlyWire classification: flow-f")


def test_scalars(spark):
    one = lambda *c: tuple(spark.range(1).select(*c).first())
    assert one(S.curie(F.lit("A_b_c")), S.joined("x", F.lit(None)), S.title_bool(F.lit(True)), S.or_none(F.lit(None))) == ("A:b:c", None, "True", "None")
    assert one(S.to_id(F.lit(" 12 ")), S.to_id(F.lit("1.9")), S.matches(F.lit(None).cast("string"), "x"), S.na_to_null(F.lit("n/a"))) == (12, None, False, None)
    assert one(S.folder(F.lit("/a/b/c.swc")), S.in_folder(F.lit("/a/b/"), "v"), S.date_stamp(F.lit(datetime.date(2024, 3, 9)))) == ("/a/b", "/a/b/v", "240309")
    assert one(S.piped(F.lit("a"), F.lit(1)), S.chunks_needed(F.lit(41), 20), S.scaled(F.lit(1)), S.first_item(F.array().cast("array<string>"))) == ("a|1", 3, 255, None)


def test_artifact_plan(spark):
    import itertools

    state = [(str(i), f"/f{i}", *flags) for i, flags in enumerate(itertools.product([False, True], repeat=4))]
    plan = {r["root_id"]: r for r in artifacts.plan(spark.createDataFrame([*state, ("x1", "/bad", False, False, False, False)], schemas.ARTIFACTS)).collect()}
    for i, (_, _, swc, obj, nrrd, redo) in enumerate(state):
        if swc and obj and nrrd and not redo:
            assert i not in plan
            continue
        delete = redo and (swc or obj)
        assert (plan[i]["make_swc"], plan[i]["make_obj"], plan[i]["make_nrrd"], plan[i]["delete_first"]) == (delete or not swc, delete or not obj, delete or not nrrd, delete)
    assert len(plan) == 15
    inventory = spark.createDataFrame([("/f", "volume.swc"), ("/f", "volume.nrrd"), ("/g", "thumbnail.png")], "folder string, name string")
    wanted = spark.createDataFrame([("1", "/f"), ("2", "/g")], "root_id string, folder string")
    assert rows(artifacts.state(wanted, inventory)) == [("1", "/f", True, False, True), ("2", "/g", False, False, False)]
    images = spark.createDataFrame([("12", "http://x/data/a/b/"), ("x", "http://x/data/c/")], "body_id string, folder string")
    assert rows(artifacts.local_folders(images, "http://x/data/", "/out/")) == [(12, "/out/a/b", "/out/a/b/volume.swc", "/out/a/b/volume_man.obj", "/out/a/b/volume.nrrd")]
    points = spark.createDataFrame([(0.1, 0.1, 0.5), (0.2, 0.3, 0.9), (700.0, 1.0, 1.0)], "x double, y double, z double")
    assert rows(artifacts.occupancy(points)) == [(0, 0, 0, 255)]


def test_quality_nulls(spark):
    table = spark.createDataFrame([(1, "a"), (2, "a"), (3, None), (4, None), (5, "b")], "i int, k string")
    assert rows(quality.drop_ambiguous(table, "k")) == [(5, "b")]
    assert len(rows(quality.ambiguous(table, "k"))) == 4
    assert rows(quality.value_counts(table, "k")) == [("a", 2), ("b", 1)]
    assert rows(quality.lacking(table, "k").select("i")) == [(3,), (4,)]


def test_numbers_are_consecutive(spark):
    table = spark.range(1000).select((F.col("id") * 7 % 1000).alias("k")).repartition(5)
    found = {r["k"]: r["number"] for r in slices.numbered(table, "k").collect()}
    assert found == {k: k for k in range(1000)}
    assert rows(slices.batches(table, 300, "k").groupBy("batch").count()) == [(0, 300), (1, 300), (2, 300), (3, 100)]
    assert slices.numbered(table.limit(0), "k").columns == ["k", "number"] and slices.numbered(table.limit(0), "k").count() == 0


def test_two_million_rows_keep_their_numbers(spark, tmp_path):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    try:
        n = 2_000_000
        table = spark.range(n).select((F.col("id") * 7919 % n).alias("k"), F.sha2(F.col("id").cast("string"), 256).alias("payload"))
        found = slices.numbered(table, "k")
        assert tuple(found.agg(F.count("payload"), F.count_if(F.col("k") != F.col("number")), F.countDistinct("number")).first()) == (n, 0, n)
        files.chunked_tsv(table.limit(300_000), f"{tmp_path}/chunks", 50_000, "k")
        back = spark.read.option("sep", "\t").option("header", True).csv(str(next(tmp_path.glob("chunks_*"))))
        assert rows(back.groupBy("chunk").count()) == [(i, 50_000) for i in range(6)]
        assert back.select("payload").distinct().count() == 300_000
        grouped = slices.chunks_per_group(table.withColumn("g", F.when(F.col("k") % 3 == 0, "hot").when(F.col("k") < 1000, "few")), "g", 1000, "k")
        sizes = grouped.groupBy("g", "chunk").count().groupBy("g").agg(F.count("chunk"), F.max("count"), F.min("chunk"), F.max("chunk"))
        assert rows(sizes) == sorted([("hot", 667, 1000, 0, 666), ("few", 1, 666, 0, 0), (None, 1333, 1000, 0, 1332)], key=repr)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_envelope_and_unpivot(spark, tmp_path):
    (tmp_path / "e.json").write_text('{"results": [{"data": [{"row": ["1", "a"]}, {"row": [null]}]}, {"data": []}]}\n')
    assert rows(graph.rows_of_envelope(readers.envelope(spark, str(tmp_path / "e.json")), "x", "y")) == [("1", "a"), (None, None)]
    matrix = spark.createDataFrame([("p", 1, None), ("q", 0, 2)], "source string, a int, b int")
    assert rows(edges.unpivoted(matrix)) == [("p", "a", 1), ("q", "a", 0), ("q", "b", 2)]


def test_files(spark, tmp_path):
    table = spark.range(45).select(F.col("id").alias("filename"), F.lit("x").alias("v"))
    files.chunked_tsv(table, f"{tmp_path}/anat", 20, "filename")
    made = sorted(p.name for p in next(tmp_path.glob("anat_*")).glob("chunk=*"))
    assert made == ["chunk=0", "chunk=1", "chunk=2"]
    files.metadata(spark, f"{tmp_path}/m.yaml", DataSet="D", Curator="me")
    assert (tmp_path / "m.yaml").read_text() == "DataSet: D\nCurator: me\n"
    body = spark.createDataFrame([("KB:1", "owl:NamedIndividual", "KB:2", "3")], schemas.TEMPLATE)
    made = [
        *(f"Prefix({k}:=<{v}>)" for k, v in sorted(template.PREFIXES.items(), key=lambda x: list(template.PREFIXES).index(x[0]))), "Ontology(<http://x/o.owl>", "Declaration(AnnotationProperty(n2o:weight))", "Declaration(ObjectProperty(obo:RO_0002120))",
        "Declaration(NamedIndividual(KB:1))", "Declaration(NamedIndividual(KB:2))", 'ObjectPropertyAssertion(Annotation(n2o:weight "3"^^xsd:integer) obo:RO_0002120 KB:1 KB:2)', ")",
    ]
    for _ in range(2):  # the second replaces the first
        files.ontology(body, f"{tmp_path}/connectome_x.owl", "http://x/o.owl")
        assert gzip.open(tmp_path / "connectome_x.owl.gz", "rt").read().splitlines() == made
    files.ontology(body, f"{tmp_path}/connectome_y.owl", "http://x/o.owl", gzip=False)
    assert (tmp_path / "connectome_y.owl").read_text().splitlines() == made
    assert not list(tmp_path.glob("*.old")) and not list(tmp_path.glob("*.parts"))
    with pytest.raises(ValueError):
        files.ontology(body, f"{tmp_path}/x.owl", "http://x/o.owl")
    (tmp_path / "s.swc").write_text("# skeleton\n1 0 1.5 2 3 0.1 -1\n2 0 1 2 3 0.1 1\n")
    assert [r["parent"] for r in readers.skeletons(spark, f"{tmp_path}/s.swc").orderBy("sample").collect()] == [-1, 1]
    assert "s.swc" in {r["name"] for r in readers.artifacts(spark, str(tmp_path)).collect()}
    assert readers.stored(spark, f"{tmp_path}/s.swc", "gs://there") == f"{tmp_path}/s.swc" and readers.stored(spark, f"{tmp_path}/none", "gs://there") == "gs://there"


def test_flow(spark, kb):
    nodes, rels = kb
    table = spark.createDataFrame([(11, 22, 5), (11, 33, 9), (22, 11, 0)], schemas.EDGE_FILE)
    found = rows(induced_template("file", table, nodes, rels, "D", "S"))
    assert ("n1", "owl:NamedIndividual", "n2", "5") in found and len(found) == 3
