"""Mesh, grid and skeleton files: read as other programs write them, written, and read back."""

import gzip
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from edgeloom.operators import skeletons, volumes
from edgeloom.sinks import shapes
from edgeloom.sources import readers


def by_mesh(df, *columns):
    found = {}
    for r in df.collect():
        found.setdefault(r["mesh"].rsplit("/", 1)[-1], []).append(tuple(r[c] for c in columns))
    return {k: sorted(v, key=repr) for k, v in found.items()}


def test_mesh_files_keep_their_numbers(spark, tmp_path):
    (tmp_path / "a.obj").write_text("# a mesh\no thing\nv 0 0 0\nv 1 0 0 0.5\r\n  v 0 1e0 0\nvn 0 0 1\nvt 1 1\nf 1/1/1 2//1 3\nv 0 0 1\nf -1 -2 -3\nf 1 2\nv x 1 1\nusemtl none\nf 1 2 3 4 5\n")
    (tmp_path / "empty.obj").write_text("# nothing\n")
    (tmp_path / "sub").mkdir()
    (tmp_path / "sub" / "b.obj").write_text("f 1 2 3\nv 3 3 3\nv 4 4 4\nv 5 5 5\n")
    vertices, faces = readers.meshes(spark, str(tmp_path))
    assert by_mesh(vertices, "vertex", "x", "y", "z") == {"a.obj": [(1, 0.0, 0.0, 0.0), (2, 1.0, 0.0, 0.0), (3, 0.0, 1.0, 0.0), (4, 0.0, 0.0, 1.0), (5, None, 1.0, 1.0)], "b.obj": [(1, 3.0, 3.0, 3.0), (2, 4.0, 4.0, 4.0), (3, 5.0, 5.0, 5.0)]}
    assert by_mesh(faces, "face", "part", "a", "b", "c") == {"a.obj": [(1, 0, 1, 2, 3), (2, 0, 4, 3, 2), (4, 0, 1, 2, 3), (4, 1, 1, 3, 4), (4, 2, 1, 4, 5)], "b.obj": [(1, 0, 1, 2, 3)]}


def test_mesh_files_in_many_blocks(spark, tmp_path):
    rng = random.Random(1)
    lines, n, want, faces = [], 0, [], []
    for _ in range(3000):
        if rng.random() < 0.6 or n < 3:
            n += 1
            want.append((n, float(n), 0.5, 0.25))
            lines.append(f"v {n} 0.5 0.25")
        else:
            faces.append((len(faces) + 1, 0, n, 1, n - 1))
            lines.append(f"f -1 1 {n - 1}")
    (tmp_path / "long.obj").write_text("\n".join(lines))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "3000")
    try:
        vertices, found = readers.meshes(spark, str(tmp_path))
        assert by_mesh(vertices, "vertex", "x", "y", "z")["long.obj"] == sorted(want, key=repr)
        assert by_mesh(found, "face", "part", "a", "b", "c")["long.obj"] == sorted(faces, key=repr)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_meshes_come_back_as_they_were_written(spark, tmp_path):
    vertices = spark.createDataFrame([("m1", 10 * i, float(i), 0.1 * i, -1e-7 * i) for i in range(5)] + [("m2", i, 1.0, 2.0, float(i)) for i in range(4)], "mesh string, vertex int, x double, y double, z double")
    faces = spark.createDataFrame([("m1", 7, 0, 0, 20, 40), ("m1", 9, 0, 10, 20, 30), ("m2", 1, 0, 0, 1, 2), ("m2", 1, 1, 0, 2, 3)], "mesh string, face int, part int, a int, b int, c int")
    shapes.meshes(vertices, faces, str(tmp_path / "out"))
    assert len(list((tmp_path / "out").glob("mesh=m1/part-*"))) == 1
    back, sides = readers.meshes(spark, str(tmp_path / "out"), "part-*")
    place = lambda df: by_mesh(df.withColumn("mesh", F.regexp_extract("mesh", r"mesh=(\w+)", 1)), *[c for c in df.columns if c != "mesh"])
    assert place(back) == {"m1": [(i + 1, float(i), 0.1 * i, -1e-7 * i) for i in range(5)], "m2": [(i + 1, 1.0, 2.0, float(i)) for i in range(4)]}
    assert place(sides) == {"m1": [(1, 0, 1, 3, 5), (2, 0, 2, 3, 4)], "m2": [(1, 0, 1, 2, 3), (2, 0, 1, 3, 4)]}
    with pytest.raises(Exception, match="corner that is no vertex"):
        shapes.meshes(vertices, spark.createDataFrame([("m1", 1, 0, 0, 10, 11)], faces.schema), str(tmp_path / "bad"))


def grid_file(path, kind, sizes, encoding, data, extra=""):
    path.write_bytes(f"NRRD0004\n# made here\ntype: {kind}\ndimension: {len(sizes)}\nsizes: {' '.join(map(str, sizes))}\nencoding: {encoding}\nkey:=value\n{extra}\n".encode() + data)


@pytest.mark.parametrize("slab", [1 << 20, 7])
def test_grid_files_of_every_encoding(spark, tmp_path, monkeypatch, slab):
    monkeypatch.setattr(readers, "SLAB", slab)
    rng = np.random.default_rng(4)
    grid = (rng.random((4, 5, 6)) < 0.2) * rng.integers(1, 100, (4, 5, 6))  # k, j, i
    grid_file(tmp_path / "raw.nrrd", "uint8", (6, 5, 4), "raw", grid.astype("u1").tobytes())
    grid_file(tmp_path / "zip.nrrd", "short", (6, 5, 4), "gzip", gzip.compress(grid.astype(">i2").tobytes(), 9), "endian: big\n")
    whole = grid.astype("<f8").tobytes()
    grid_file(tmp_path / "two.nrrd", "double", (6, 5, 4), "gz", gzip.compress(whole[:101]) + gzip.compress(whole[101:]) + b"\n", "endian: little\n")
    grid_file(tmp_path / "text.nrrd", "float", (6, 5, 4), "text", "\n".join(" ".join(map(str, row)) for row in grid.reshape(-1, 6)).encode())
    want = sorted(((int(i), int(j), int(k), float(grid[k, j, i])) for k, j, i in zip(*np.nonzero(grid), strict=True)), key=repr)
    assert by_mesh(readers.grids(spark, str(tmp_path)), "i", "j", "k", "value") == dict.fromkeys(("raw.nrrd", "zip.nrrd", "two.nrrd", "text.nrrd"), want)
    assert readers.grids(spark, str(tmp_path), "raw*", background=None).count() == 120


@pytest.mark.parametrize("case", ["short", "detached", "bzip2", "block", "none"])
def test_broken_grid_files_are_errors(spark, tmp_path, case):
    grid_file(tmp_path / "a.nrrd", "block" if case == "block" else "uint8", (2, 2), "bzip2" if case == "bzip2" else "raw", b"abc" if case == "short" else b"abcd", "data file: a.raw\n" if case == "detached" else "")
    if case == "none":
        (tmp_path / "a.nrrd").write_bytes(b"hello")
    match = {"short": "3 instead of 4 voxels|0 instead of 4 voxels", "detached": "detached", "bzip2": "no encoding", "block": "no type", "none": "no header"}[case]
    with pytest.raises(Exception, match=match):
        readers.grids(spark, str(tmp_path)).collect()


def test_voxels_come_back_from_grid_files(spark, tmp_path):
    rng = random.Random(6)
    held = sorted({(f"m{rng.randint(0, 2)}", rng.randint(0, 6), rng.randint(0, 4), rng.randint(0, 3)) for _ in range(90)})
    shapes.grids(spark.createDataFrame(held, "mesh string, i int, j int, k int"), str(tmp_path / "g"), (7, 5, 4), (0.5, 0.5, 1.0))
    back = readers.grids(spark, str(tmp_path / "g"), "part-*").collect()
    assert sorted((r["mesh"].split("mesh=")[1].split("/")[0], r["i"], r["j"], r["k"]) for r in back) == held and {r["value"] for r in back} == {255.0}
    assert readers.grids(spark, str(tmp_path / "g"), "part-*", background=None).count() == 3 * 140


def test_skeletons_come_back_with_parents_first(spark, tmp_path):
    rng = random.Random(8)
    rows, above = [], {}
    for mesh, n in (("one", 200), ("two", 1), ("line", 130)):
        names = rng.sample(range(1000), n)
        for at, name in enumerate(names):
            parent = names[at - 1] if mesh == "line" and at else -1 if not at else names[rng.randrange(at)]
            above[mesh, name] = parent
            rows.append((mesh, name, rng.randint(0, 3), float(name), rng.random(), 0.5, 0.1, parent))
    rows += [("one", 5000, 0, 5000.0, 0.0, 0.0, 0.1, 77777), rows[0], (None, 1, 0, 1.0, 0.0, 0.0, 0.1, -1)]  # its parent isn't there
    above["one", 5000] = -1
    schema = "mesh string, sample bigint, kind int, x double, y double, z double, radius double, parent bigint"
    df = spark.createDataFrame(rows, schema)
    found = {(r["mesh"], r["sample"]): (r["root"], r["depth"]) for r in skeletons.depths(df).collect()}

    def up(mesh, name):
        steps = 0
        while above[mesh, name] != -1:
            name, steps = above[mesh, name], steps + 1
        return name, steps

    assert found == {k: up(*k) for k in above}
    shapes.skeletons(df, str(tmp_path / "s"))
    back = readers.skeletons(spark, str(tmp_path / "s") + "/*/*").collect()
    assert len(back) == len(above)
    by = {}
    for r in back:
        by.setdefault(r["path"].split("mesh=")[1].split("/")[0], {})[r["sample"]] = r
    for mesh, held in by.items():
        assert sorted(held) == list(range(1, len(held) + 1))
        for r in held.values():
            assert r["parent"] < r["sample"]
            assert above[mesh, int(r["x"])] == (-1 if r["parent"] == -1 else int(held[r["parent"]]["x"]))
    for folder in (tmp_path / "s").glob("mesh=*"):
        samples = [int(x.split()[0]) for f in folder.glob("part-*") for x in f.read_text().splitlines()]
        assert samples == sorted(samples)


def test_skeletons_with_a_cycle_are_errors(spark):
    df = spark.createDataFrame([("m", 1, 0, 0.0, 0.0, 0.0, 0.1, 2), ("m", 2, 0, 0.0, 0.0, 0.0, 0.1, 1)], "mesh string, sample bigint, kind int, x double, y double, z double, radius double, parent bigint")
    with pytest.raises(ValueError, match="cycle"):
        skeletons.depths(df)
    assert skeletons.renumbered(df.limit(0)).collect() == []


def test_meshes_from_files_are_solids(spark, tmp_path):
    (tmp_path / "t.obj").write_text("v 0 0 0\nv 4 0 0\nv 0 4 0\nv 0 0 4\nf 1 3 2\nf 1 2 4\nf 2 3 4\nf 1 4 3\n")
    vertices, faces = readers.meshes(spark, str(tmp_path))
    assert volumes.open_edges(faces).collect() == []
    found = volumes.voxels(volumes.triangles(vertices, faces), (1, 1, 1), (4, 4, 4)).count()
    assert found == sum(i + j + k <= 4 for i in range(4) for j in range(4) for k in range(4))


def test_planned_deletions_are_carried_out_once(spark, tmp_path):
    from edgeloom.operators import artifacts
    from edgeloom.sinks import files

    for name in ("a", "b", "c"):
        (tmp_path / name).mkdir()
        for file in ("volume.swc", "volume_man.obj", "thumbnail.png", "keep.txt"):
            (tmp_path / name / file).write_text("x")
    (tmp_path / "a" / "volume_dir").mkdir()
    rows = [(1, f"{tmp_path}/a", True, True, True, True), (2, f"{tmp_path}/b/", True, True, True, False), (3, f"{tmp_path}/c", False, True, False, True), (4, f"{tmp_path}/gone", True, True, True, True)]
    plan = artifacts.plan(spark.createDataFrame(rows, "root_id int, folder string, has_swc boolean, has_obj boolean, has_nrrd boolean, redo boolean"))
    assert files.delete_planned(plan, f"{tmp_path}/log", batch=2) == 6
    logged = sorted(x.removeprefix("file:") for f in (tmp_path / "log").glob("deleted-*") for x in f.read_text().splitlines())
    assert logged == sorted(f"{tmp_path}/{n}/{f}" for n in "ac" for f in ("volume.swc", "volume_man.obj", "thumbnail.png"))
    left = sorted(str(p.relative_to(tmp_path)) for n in "abc" for p in (tmp_path / n).iterdir())
    assert left == ["a/keep.txt", "a/volume_dir", "b/keep.txt", "b/thumbnail.png", "b/volume.swc", "b/volume_man.obj", "c/keep.txt"]
    assert files.delete_planned(plan, f"{tmp_path}/log") == 0
    with pytest.raises(ValueError, match="no folder"):
        files.delete_planned(spark.createDataFrame([("/", True)], "folder string, delete_first boolean"), f"{tmp_path}/log")
