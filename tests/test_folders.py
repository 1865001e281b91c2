"""Many files in folders of their keys."""

import pytest
from pyspark.sql import DataFrameReader
from pyspark.sql import functions as F

from edgeloom.plans import round_trips
from edgeloom.sinks import files, folders, shapes


def contents(root):
    assert not [p for p in root.parent.iterdir() if p.name.startswith("_")]
    found = {}
    for p in root.glob("*/part-*"):
        assert p.parent.name not in found
        found[p.parent.name] = p.read_text()
    return found


def test_files_are_the_same_however_they_are_written(spark, tmp_path, monkeypatch):
    keys = ["plain", "a/b:c", "100%", "x=[1]{2}^", "ein Wort", "äα", "q'\"#*?\\", "tab\tnew\nline", "", None]
    rows = [(k, n, f"{k} é {n}") for n in range(30) for k in keys] + [("long", n, "x" * 50) for n in range(25_000)] + [("plain", 99, "two\nlines"), ("plain", 100, None)]
    lines = spark.createDataFrame(rows, "key string, n int, line string").repartition(5)
    folders.one_file_each(lines, str(tmp_path / "own" / "out"), "key", "n")
    # Hadoop's files have checksums beside them, and a process was started for each
    assert not list(tmp_path.rglob(".*.crc"))
    own = contents(tmp_path / "own" / "out")
    assert len(own) == 10 and own["key=long"] == ("x" * 50 + "\n") * 25_000
    assert own["key=plain"] == "".join(f"plain é {n}\n" for n in range(30)) + "two\nlines\n\n"
    monkeypatch.setattr(folders, "_opened", lambda *_: None)
    folders.one_file_each(lines, str(tmp_path / "sparks" / "out"), "key", "n")
    assert contents(tmp_path / "sparks" / "out") == own
    back = spark.read.option("recursiveFileLookup", True).text(f"file://{tmp_path}/own/out")
    assert back.count() == 30 * (len(keys) + 1) + 25_003  # one key has two lines
    assert {r["key"] for r in spark.read.text(f"file://{tmp_path}/own/out").select("key").distinct().collect()} == set(keys) - {""} | {"long"}


def test_an_older_folder_stays_until_the_new_one_is_whole(spark, tmp_path):
    out = tmp_path / "out"
    lines = spark.range(40).select((F.col("id") % 4).alias("key"), F.col("id").cast("string").alias("line"))
    folders.one_file_each(lines, f"file://{out}", "key", "line")
    old = contents(out)
    assert sorted(old) == [f"key={i}" for i in range(4)]
    bad = lines.withColumn("line", F.when(F.col("key") == 3, F.raise_error(F.lit("no line"))).otherwise("new"))
    with pytest.raises(Exception, match="no line"):
        folders.one_file_each(bad, str(out), "key")
    assert contents(out) == old
    folders.one_file_each(lines.filter("key = 1"), str(out), "key", "line")
    assert contents(out) == {"key=1": old["key=1"]}
    folders.one_file_each(lines.limit(0), str(out), "key")
    assert contents(out) == {} and out.is_dir()


def test_meshes_are_written_without_a_process_for_each_file(spark, tmp_path):
    vertices = spark.range(300).select((F.col("id") / 3).cast("int").alias("mesh"), (F.col("id") % 3).alias("vertex"), F.lit(0.5).alias("x"), F.col("id").cast("double").alias("y"), F.lit(1.0).alias("z"))
    faces = spark.range(100).select(F.col("id").cast("int").alias("mesh"), F.lit(0).alias("face"), F.lit(0).alias("part"), *[F.lit(i).alias(n) for i, n in enumerate("abc")])
    shapes.meshes(vertices, faces, str(tmp_path / "m"))
    made = contents(tmp_path / "m")
    assert made["mesh=7"] == "v 0.5 21.0 1.0\nv 0.5 22.0 1.0\nv 0.5 23.0 1.0\nf 1 2 3\n" and len(made) == 100
    assert not list((tmp_path / "m").rglob(".*.crc"))


def test_chunks_have_headers_and_their_rows_in_order(spark, tmp_path):
    table = spark.range(1050).select((F.col("id") * 37 % 1050).alias("k"), F.when(F.col("id") % 3 == 0, 'a "b"\tc').when(F.col("id") % 3 == 1, "").alias("v \t1")).repartition(7)
    files.chunked_tsv(table, str(tmp_path / "c"), 100, "k")
    (out,) = tmp_path.glob("c_*")
    made = contents(out)
    assert sorted(made) == sorted(f"chunk={i}" for i in range(11)) and not list(out.rglob(".*.crc"))
    value = {(i * 37) % 1050: '"a ""b""\tc"' if i % 3 == 0 else "" for i in range(1050)}
    for i in range(11):
        assert made[f"chunk={i}"] == 'k\t"v \t1"\n' + "".join(f"{k}\t{value[k]}\n" for k in range(100 * i, min(100 * i + 100, 1050)))
    back = spark.read.options(sep="\t", header=True, escape='"').csv(str(out))
    assert back.columns == ["k", "v \t1", "chunk"] and back.count() == 1050


def test_chunked_files_open_no_file_for_its_header(spark, tmp_path, monkeypatch):
    spark.range(1200).select(*[F.col("id").alias(c) for c in ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")]).write.parquet(str(tmp_path / "lineitem.parquet"))
    given = []
    monkeypatch.setattr(DataFrameReader, "schema", lambda self, schema, was=DataFrameReader.schema: given.append(schema) or was(self, schema))
    found = round_trips.chunked_files(spark, str(tmp_path))
    assert any("l_extendedprice string" in str(x) for x in given)
    assert [tuple(r) for r in found.orderBy("chunk").collect()] == [(0, 1000, 0, 499500), (1, 200, 1000, 219900)]


def test_metadata_files_share_the_writer(spark, tmp_path):
    files.metadata_files(spark.createDataFrame([(1, "a\n b", None), (2, "c", "d"), (None, "e", "f")], "id int, x string, y string"), str(tmp_path / "m"), "id")
    assert contents(tmp_path / "m") == {"id=1": "x: a b\n", "id=2": "x: c\ny: d\n", "id=__HIVE_DEFAULT_PARTITION__": "x: e\ny: f\n"}
    assert not list((tmp_path / "m").rglob(".*.crc"))
