"""Physical plans, the command line, the service source and streams."""

import contextlib
import gzip
import io

from pyspark.sql import functions as F

from edgeloom import cli
from edgeloom.operators import edges
from edgeloom.plans import queries as Q
from edgeloom.sources import schemas, service
from edgeloom.streaming import edges as streams

SF = "/root/testdata/sf0.001"


def plan(df):
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()


def test_threshold_reaches_the_scan(spark, tmp_path):
    table = spark.createDataFrame([(1, 2, 3)], schemas.EDGE_FILE).withColumn("other", F.lit("x"))
    table.write.parquet(f"{tmp_path}/e")
    text = plan(edges.from_file(spark.read.parquet(f"{tmp_path}/e"), spark.range(5).toDF("a"), 10))
    assert "GreaterThan(num_synapses,10)" in text and "other" not in text


def test_small_registry_is_broadcast_and_large_is_not(spark):
    text = plan(Q.edge_induced(spark, SF))
    assert text.count("BroadcastHashJoin LeftSemi") >= 2 and "SortMergeJoin" not in text
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        assert "BroadcastHashJoin" not in plan(Q.edge_induced(spark, SF))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_one_exchange_for_a_sum(spark):
    text = plan(Q.edge_roi_sum(spark, SF))
    tree = text.split("\n\n")[0]
    assert tree.count("Exchange") == 1 and tree.count("HashAggregate") == 2


def test_semi_join_stands_below_the_count(spark):
    tree = plan(Q.edge_synapse_count(spark, SF)).split("\n\n")[0]
    assert tree.index("HashAggregate") < tree.index("LeftSemi")


def test_no_python_in_graph_queries(spark):
    for name in ("template_induced", "registry_pattern", "curation_flywire", "artifact_plan", "json_envelope"):
        text = plan(Q.QUERIES[name](spark, SF))
        assert "Python" not in text and "Arrow" not in text


def test_command_line(spark, tmp_path, caplog):
    nodes = spark.createDataFrame([("n1", "a", ["Individual"]), ("n2", "b", ["Individual"]), ("D", "d", ["DataSet"]), ("S", "s", ["Site"])], schemas.NODES)
    rels = spark.createDataFrame([(n, "D", "has_source", None, None, None) for n in ("n1", "n2")] + [("n1", "S", "hasDbXref", ["1"], None, None), ("n2", "S", "hasDbXref", ["2"], None, None)], schemas.RELS)
    nodes.write.parquet(f"{tmp_path}/nodes")
    rels.write.parquet(f"{tmp_path}/rels")
    spark.createDataFrame([(1, 2, 8), (2, 1, 3)], schemas.EDGE_FILE).write.parquet(f"{tmp_path}/edges")
    args = ["edges", "-d", "D", "--db", "S", "-t", "5", "--edges", f"{tmp_path}/edges", "--nodes", f"{tmp_path}/nodes", "--rels", f"{tmp_path}/rels", "-o", f"{tmp_path}/out.tsv"]
    assert cli.main(args) == 0
    assert (tmp_path / "out.tsv").read_text().splitlines()[2:] == ["n1\towl:NamedIndividual\tn2\t8"]
    again = [*args, "--count-read", "--ontology", f"{tmp_path}/connectome_t.owl", "--prefix", "KB=http://x/y=", "--missing", f"{tmp_path}/missing.tsv"]
    spark.createDataFrame([("n3", "c", ["Individual"])], schemas.NODES).write.mode("append").parquet(f"{tmp_path}/nodes")
    spark.createDataFrame([("n3", "D", "has_source", None, None, None), ("n3", "S", "hasDbXref", [], None, None)], schemas.RELS).write.mode("append").parquet(f"{tmp_path}/rels")
    with caplog.at_level("INFO", "edgeloom"):
        assert cli.main(again) == 0
    assert "3 neurons found, 1 without an accession" in caplog.text and "n3 (c)" in caplog.text
    assert "read edges: 2" in caplog.text and "kept edges: 1" in caplog.text
    assert (tmp_path / "missing.tsv").read_text() == "neuron_id\tneuron_label\nn3\tc\n"
    assert "Prefix(KB:=<http://x/y=>)" in gzip.open(tmp_path / "connectome_t.owl.gz", "rt").read() and (tmp_path / "out.tsv").read_text().splitlines()[2:] == ["n1\towl:NamedIndividual\tn2\t8"]
    args[2] = "none"
    assert cli.main(args) == 1
    spark.createDataFrame([(5,), (4,)], "filename bigint").write.parquet(f"{tmp_path}/ids")
    assert cli.main(["curation", "--kind", "ids", "--input", f"{tmp_path}/ids", "-o", f"{tmp_path}/c.tsv"]) == 0
    assert (tmp_path / "c.tsv").read_text().splitlines()[1].startswith("4\tadult neuron\tadult brain|adult ventral nerve cord\tBANC:4")


def test_windowed_stream(spark, tmp_path):
    schema = "ts timestamp, pre_pt_root_id bigint, post_pt_root_id bigint"
    spark.sql("SELECT timestamp'2024-01-01 00:01:00' AS ts, 1L AS pre_pt_root_id, 2L AS post_pt_root_id UNION ALL SELECT timestamp'2024-01-01 00:02:00', 1L, 2L UNION ALL SELECT timestamp'2024-01-01 03:00:00', 1L, 9L UNION ALL SELECT timestamp'2024-01-01 05:00:00', 2L, 1L").coalesce(1).write.parquet(f"{tmp_path}/in")
    ids = spark.createDataFrame([(1,), (2,)], "a bigint")
    stream = streams.windowed_counts(spark.readStream.schema(schema).parquet(f"{tmp_path}/in"), ids)
    query = stream.writeStream.format("memory").queryName("windowed").outputMode("append").option("checkpointLocation", f"{tmp_path}/ck").start()
    query.processAllAvailable()
    query.stop()
    assert [tuple(r)[1:] for r in spark.table("windowed").collect()] == [(1, 2, 2)]


def test_batches_of_a_stream(spark, tmp_path):
    spark.createDataFrame([(1, 2, 5), (1, 9, 5), (2, 1, 1)], schemas.EDGE_FILE).coalesce(1).write.parquet(f"{tmp_path}/in")
    got = []
    stream = spark.readStream.schema(schemas.EDGE_FILE).parquet(f"{tmp_path}/in")
    query = streams.each_batch(stream, spark.createDataFrame([(1,), (2,)], "a bigint"), 2, lambda df, n: got.extend(map(tuple, df.collect())), f"{tmp_path}/ck")
    query.processAllAvailable()
    query.stop()
    assert got == [(1, 2, 5)]


def fetch_some(first, last, endpoint):
    assert endpoint == "offline"
    return [(i, i + 1, 3) for i in range(first, last + 1)]


def test_service_source(spark, tmp_path):
    reader = service.EdgeServiceReader({"fetch": "tests.test_plans:fetch_some", "batches": "4", "lowest": "10", "highest": "16", "endpoint": "offline", "schema": "x"})
    found = [row for p in reader.partitions() for row in reader.read(p)]
    assert found == [(i, i + 1, 3) for i in range(10, 17)] and len(reader.partitions()) == 4
    assert len(service.EdgeServiceReader({"batches": "9", "lowest": "1", "highest": "2"}).partitions()) == 2
    assert service.EdgeService({}).schema().startswith("source")
    (tmp_path / "a.json").write_text('{"results": [{"data": [{"row": [1, 2, 5]}, {"row": [7, 2, null]}, {"row": [null, 2, 5]}]}]}')
    (tmp_path / "b.json").write_text('{"results": [{"data": [{"row": ["3", "1", "4"]}]}, {"data": []}]}')
    service.register(spark)
    table = spark.read.format("edge_service").options(fetch="edgeloom.sources.service:saved_answers", folder=str(tmp_path), batches=3, lowest=1, highest=9).load()
    assert sorted(map(tuple, table.collect()), key=repr) == [(1, 2, 5), (3, 1, 4), (7, 2, None)]


def test_the_package_names_its_python(tmp_path):
    import tomllib
    from pathlib import Path

    project = tomllib.loads((Path(__file__).parent.parent / "pyproject.toml").read_text())["project"]
    assert project["requires-python"] == ">=3.10" and project["scripts"]["edgeloom"] == "edgeloom.cli:main"


def test_optional_part_is_guarded():
    import __spark_entry__ as entry

    assert set(Q.QUERIES) <= set(entry.queries()) and set(Q.ORACLES) <= set(entry.oracle_sql())
