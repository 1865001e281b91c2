"""Meshes, voxels and snapshots against plain versions."""

import itertools
import math
import random
from collections import Counter

import pytest

from edgeloom.operators import mapping, volumes

TETRA = [(0, 2, 1), (0, 1, 3), (1, 2, 3), (0, 3, 2)]
MESH = "mesh string, face int, " + ", ".join(f"{n} double" for n in volumes.CORNERS)


def solid(name, corners, faces):
    return [(name, i, *[float(x) for v in f for x in corners[v]]) for i, f in enumerate(faces)]


def sphere(name, centre, radius, steps=8):
    """A closed ball of triangles between rings."""
    ring = lambda k: [(centre[0] + radius * math.sin(math.pi * k / steps) * math.cos(2 * math.pi * i / steps), centre[1] + radius * math.sin(math.pi * k / steps) * math.sin(2 * math.pi * i / steps), centre[2] + radius * math.cos(math.pi * k / steps)) for i in range(steps)]
    corners, faces = [(centre[0], centre[1], centre[2] + radius)], []
    for k in range(1, steps):
        corners += ring(k)
    corners.append((centre[0], centre[1], centre[2] - radius))
    at = lambda k, i: 1 + (k - 1) * steps + i % steps
    for i in range(steps):
        faces += [(0, at(1, i), at(1, i + 1)), (len(corners) - 1, at(steps - 1, i + 1), at(steps - 1, i))]
        for k in range(1, steps - 1):
            faces += [(at(k, i), at(k + 1, i), at(k, i + 1)), (at(k, i + 1), at(k + 1, i), at(k + 1, i + 1))]
    return corners, faces


def turned(p, q, r, s):
    """Six times the volume of a tetrahedron, signed."""
    a, b, c = ([y[i] - p[i] for i in range(3)] for y in (q, r, s))
    return a[0] * (b[1] * c[2] - b[2] * c[1]) - a[1] * (b[0] * c[2] - b[2] * c[0]) + a[2] * (b[0] * c[1] - b[1] * c[0])


def winds(p, rows):
    """Whether the solid angle of the triangles around p is a full one: inside, for points off the surface."""
    total = 0.0
    for r in rows:
        a, b, c = ([r[2 + 3 * k + i] - p[i] for i in range(3)] for k in range(3))
        la, lb, lc = (math.hypot(*v) for v in (a, b, c))
        dot = lambda u, v: sum(x * y for x, y in zip(u, v, strict=True))
        bottom = la * lb * lc + dot(a, b) * lc + dot(b, c) * la + dot(c, a) * lb
        total += 2 * math.atan2(turned((0, 0, 0), a, b, c), bottom)
    return abs(total) > 6


def meshes():
    rng = random.Random(2)
    ball, faces = sphere("ball", (5.3, 4.1, 6.7), 3.9)
    rows = solid("ball", ball, faces)
    rows += solid("tiny", *sphere("tiny", (1.02, 1.01, 1.03), 0.011, 6))
    rows += solid("huge", [(-900, -800, -700), (2000, -10, 3), (-20, 1700, -5), (1, 7, 1500)], TETRA)
    for k in range(3):
        rows += solid(f"t{k}", [[rng.uniform(0, 9) for _ in range(3)] for _ in range(4)], TETRA)
    return rows


def held(df):
    return sorted((r["n"], r["mesh"]) for r in df.collect())


def test_points_inside_match_solid_angles(spark):
    rows, rng = meshes(), random.Random(3)
    points = [tuple(rng.uniform(-1, 11) for _ in range(3)) for _ in range(400)] + [(1.02 + rng.uniform(-0.02, 0.02), 1.01, 1.03) for _ in range(30)]
    points += points[:5]
    given = [(i, *p, "old") for i, p in enumerate(points)] + [(900, None, 1.0, 1.0, "old"), (901, math.nan, 5.0, 5.0, "old"), (902, 5.0, math.inf, 5.0, "old")]
    found = volumes.inside(spark.createDataFrame(given, "n int, x double, y double, z double, mesh string"), spark.createDataFrame([(*r, "clash") for r in rows], MESH + ", level string"))
    by = {}
    for r in rows:
        by.setdefault(r[0], []).append(r)
    want = sorted((i, name) for i, p in enumerate(points) for name, tri in by.items() if winds(p, tri))
    assert held(found) == want and {"ball", "tiny", "huge"} <= {m for _, m in want}


def test_points_on_borders_of_cells_shared_edges_and_corners(spark):
    """A box of twelve triangles, whose diagonals and corners rays go through; a point on its surface isn't both in and out."""
    corners = list(itertools.product((0, 4), (0, 4), (0, 4)))
    quads = [(0, 1, 3, 2), (4, 6, 7, 5), (0, 4, 5, 1), (2, 3, 7, 6), (0, 2, 6, 4), (1, 5, 7, 3)]
    faces = [t for a, b, c, d in quads for t in ((a, b, c), (a, c, d))]
    right = [(x + 4, y, z) for x, y, z in corners]
    df = spark.createDataFrame(solid("left", corners, faces) + solid("right", right, faces), MESH)
    points = [(i, float(x), float(y), float(z)) for i, (x, y, z) in enumerate(itertools.product(range(-1, 10), range(-1, 6), range(-1, 6)))]
    found = held(volumes.inside(spark.createDataFrame(points, "n int, x double, y double, z double"), df))
    assert len(found) == len(set(found))
    of = {i: {m for n, m in found if n == i} for i, *_ in points}
    for i, x, y, z in points:
        assert of[i] == {n for n, at in (("left", 0), ("right", 4)) if at <= x < at + 4 and 0 <= y < 4 and 0 <= z < 4}, (x, y, z)


def test_no_points_no_meshes_and_broken_ones(spark):
    points = spark.createDataFrame([(1, 0.1, 0.1, 0.1)], "n int, x double, y double, z double")
    none = spark.createDataFrame([], MESH)
    assert volumes.inside(points, none).collect() == [] and volumes.voxels(none, (1, 1, 1), (5, 5, 5)).collect() == []
    assert volumes.inside(points.limit(0), spark.createDataFrame(solid("t", [(0, 0, 0), (1, 0, 0), (0, 1, 0), (0, 0, 1)], TETRA), MESH)).collect() == []
    flat = spark.createDataFrame(solid("flat", [(0, 0, 0), (1, 1, 1), (2, 2, 2), (3, 3, 3)], TETRA), MESH)
    assert volumes.inside(points, flat).collect() == []
    for bad in (None, math.nan, math.inf):
        broken = spark.createDataFrame([("b", 0, bad, *[0.0] * 8)], MESH)
        with pytest.raises(Exception, match="missing or non-finite corner"):
            volumes.inside(points, broken).collect()


def test_synapses_in_volumes_match_loops(spark):
    rng = random.Random(5)
    rows = meshes()
    by = {}
    for r in rows:
        by.setdefault(r[0], []).append(r)
    synapses = [(rng.choice([1, 2, 3, 4, None]), rng.choice([1, 2, 5]), *[rng.uniform(0, 9) for _ in range(3)]) for _ in range(300)]
    synapses += synapses[:40]
    df = spark.createDataFrame(synapses, "pre_root_id bigint, post_root_id bigint, x double, y double, z double")
    ids = spark.createDataFrame([(i,) for i in (1, 2, 3)], "id bigint")
    want = Counter((m, a, b) for a, b, *p in synapses for m, tri in by.items() if a in (1, 2, 3) and b in (1, 2, 3) and winds(p, tri))
    found = volumes.from_synapses(df, ids, spark.createDataFrame(rows, MESH), threshold=2)
    assert {(r["mesh"], r["source"], r["target"]): r["weight"] for r in found.collect()} == {k: n for k, n in want.items() if n > 2}
    out, into = Counter(), Counter()
    for (m, a, b), n in want.items():
        out[m, a] += n
        into[m, b] += n
    strengths = volumes.region_strengths(volumes.from_synapses(df, ids, spark.createDataFrame(rows, MESH)))
    assert {(r["mesh"], r["node"]): (r["outgoing"], r["incoming"]) for r in strengths.collect()} == {k: (out[k], into[k]) for k in out | into}


def test_no_join_is_a_cross_join(spark):
    df = spark.createDataFrame(meshes(), MESH)
    points = spark.range(50).selectExpr("id AS n", "id * 0.2 AS x", "id * 0.1 AS y", "id * 0.15 AS z")
    plan = volumes.inside(points, df)._jdf.queryExecution().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan and "Python" not in plan


def test_a_line_of_points_meets_triangles_once(spark):
    box = solid("tet", [(0, 0, 0), (8, 0, 0), (0, 8, 0), (0, 0, 8)], TETRA) + [("open", 0, 3.0, 0.0, 0.0, 3.0, 8.0, 0.0, 3.0, 0.0, 8.0)]
    points = spark.createDataFrame([(i, i * 0.25 - 2, 1.0, 1.0) for i in range(40)], "n int, x double, y double, z double")
    parts = volumes._inner(points.select("y", "z").distinct(), spark.createDataFrame(box, MESH))
    assert sorted((r["mesh"], r["low"], r["high"]) for r in parts.collect()) == [("open", None, 3.0), ("tet", 0.0, 6.0)]
    found = {(r["mesh"], r["x"]) for r in volumes.inside(points, spark.createDataFrame(box, MESH)).collect()}
    xs = [i * 0.25 - 2 for i in range(40)]
    assert found == {("tet", x) for x in xs if 0 <= x < 6} | {("open", x) for x in xs if x < 3}


def test_pairs_of_one_synapse_are_not_grouped(spark):
    df = spark.createDataFrame([(1, 2, 1.0, 1.0, 1.0), (1, 3, 1.0, 1.0, 1.0), (1, 3, 1.5, 1.0, 1.0), (2, 3, 9.0, 9.0, 9.0)], "pre_root_id bigint, post_root_id bigint, x double, y double, z double")
    mesh = spark.createDataFrame(solid("tet", [(0, 0, 0), (8, 0, 0), (0, 8, 0), (0, 0, 8)], TETRA), MESH)
    found = volumes.from_synapses(df, None, mesh)
    assert sorted((r["source"], r["target"], r["weight"]) for r in found.collect()) == [(1, 2, 1), (1, 3, 2)]
    assert "Union" in found._jdf.queryExecution().optimizedPlan().toString()


def shuffled(spark, run):
    """What ``run`` gives, and how many rows its stages wrote to shuffles."""
    store, java = spark.sparkContext._jsc.sc().statusStore(), spark.sparkContext._gateway
    stages = lambda: store.stageList(java.jvm.java.util.ArrayList(), False, False, java.new_array(java.jvm.double, 0), java.jvm.java.util.ArrayList())
    before = {(x.stageId(), x.attemptId()) for found in [stages()] for x in (found.apply(i) for i in range(found.size()))}
    got = run()
    found = stages()
    return got, sum(x.shuffleWriteRecords() for x in (found.apply(i) for i in range(found.size())) if (x.stageId(), x.attemptId()) not in before)


def nested(spark, n):
    """Solids around one point, and points in most of them: pairs of two synapses each."""
    solids = [r for k in range(n) for r in solid(f"s{k}", [(-k - 9, -k - 9, -k - 9), (3 * k + 50, 0, 0), (0, 3 * k + 50, 0), (0, 0, 3 * k + 50)], TETRA)]
    rng = random.Random(8)
    synapses = [(i // 2, 1000 + i // 20, rng.randint(0, 5), rng.randint(0, 5), rng.randint(0, 5)) for i in range(600)]
    return spark.createDataFrame(solids, MESH), spark.createDataFrame(synapses, "pre_root_id bigint, post_root_id bigint, x int, y int, z int"), solids, synapses


def test_strengths_shuffle_no_row_for_each_point_and_mesh(spark):
    meshes, df, solids, synapses = nested(spark, 60)
    found, rows = shuffled(spark, lambda: volumes.strengths_from_synapses(df, None, meshes).collect())
    want = Counter()
    for a, b, *_ in synapses:
        for k in range(60):
            want[f"s{k}", a, "outgoing"] += 1
            want[f"s{k}", b, "incoming"] += 1
    assert {(r["mesh"], r["node"], n): r[n] for r in found for n in ("outgoing", "incoming") if r[n]} == want
    assert rows < 60 * len(synapses) / 10


@pytest.mark.parametrize("sizes", [(7, 5, 40), (40, 9, 7), (2000, 50, 1000)])
def test_strengths_in_blocks_match_loops(spark, monkeypatch, sizes):
    """Blocks, steps and meshes are cut anywhere; one node has half of all synapses."""
    for name, n in zip(("POINTS", "TRIANGLES", "STEP"), sizes, strict=True):
        monkeypatch.setattr(volumes.tallies, name, n)
    rng, rows = random.Random(6), meshes()
    by = {}
    for r in rows:
        by.setdefault(r[0], []).append(r)
    synapses = [(7 if rng.random() < 0.5 else rng.choice([1, 2, 3, None]), rng.choice([1, 2, 7]), *[rng.uniform(0, 9) for _ in range(3)]) for _ in range(150)]
    synapses += synapses[:20] + [(1, 2, math.nan, 1.0, 1.0), (1, 2, 1.0, math.inf, 1.0), (1, 2, 1.0, 1.0, None)]
    df = spark.createDataFrame(synapses, "pre_root_id bigint, post_root_id bigint, x double, y double, z double")
    want = {}
    for a, b, *p in synapses:
        for m, tri in by.items():
            if a is not None and None not in p and all(map(math.isfinite, p)) and winds(p, tri):
                want.setdefault((m, a), [0, 0])[0] += 1
                want.setdefault((m, b), [0, 0])[1] += 1
    found = volumes.strengths_from_synapses(df, None, spark.createDataFrame(rows, MESH)).collect()
    assert len(found) == len(want) and {(r["mesh"], r["node"]): [r["outgoing"], r["incoming"]] for r in found} == want
    pairs = volumes.from_synapses(df, None, spark.createDataFrame(rows, MESH))
    assert {tuple(r) for r in volumes.region_strengths(pairs).select("mesh", "node", "outgoing", "incoming").collect()} == {(*k, *n) for k, n in want.items()}


def test_blocks_agree_with_the_join_on_borders_and_open_meshes(spark):
    """Points on surfaces, edges and corners, solids that share faces, a lone triangle and a null mesh."""
    corners = list(itertools.product((0, 4), (0, 4), (0, 4)))
    quads = [(0, 1, 3, 2), (4, 6, 7, 5), (0, 4, 5, 1), (2, 3, 7, 6), (0, 2, 6, 4), (1, 5, 7, 3)]
    faces = [t for a, b, c, d in quads for t in ((a, b, c), (a, c, d))]
    df = spark.createDataFrame(solid("left", corners, faces) + solid(None, [(x + 4, y, z) for x, y, z in corners], faces) + [("open", 0, 3.0, 0.0, 0.0, 3.0, 8.0, 0.0, 3.0, 0.0, 8.0)] + solid("flat", [(0, 0, 0), (1, 1, 1), (2, 2, 2), (3, 3, 3)], TETRA), MESH)
    points = [(i, -i, float(x), float(y), float(z)) for i, (x, y, z) in enumerate(itertools.product(range(-1, 10), range(-1, 6), range(-1, 6)))]
    table = spark.createDataFrame(points, "pre_root_id bigint, post_root_id bigint, x double, y double, z double")
    found = volumes.from_synapses(table, None, df).collect()
    want = volumes.inside(table.withColumnRenamed("pre_root_id", "n"), df).collect()
    assert sorted((r["source"], str(r["mesh"])) for r in found) == sorted((r["n"], str(r["mesh"])) for r in want) and {None, "open", "left"} == {r["mesh"] for r in found}
    none = spark.createDataFrame([], MESH)
    assert volumes.from_synapses(table, None, none).collect() == [] and volumes.from_synapses(table.limit(0), None, df).collect() == []
    with pytest.raises(Exception, match="missing or non-finite corner"):
        volumes.from_synapses(table, None, spark.createDataFrame([("b", 0, math.nan, *[0.0] * 8)], MESH)).collect()


def test_edges_of_synapses_shuffle_no_row_for_each_point_and_mesh(spark):
    meshes, df, solids, synapses = nested(spark, 60)
    found, rows = shuffled(spark, lambda: volumes.from_synapses(df, None, meshes).collect())
    assert {(r["mesh"], r["source"], r["target"]): r["weight"] for r in found} == Counter((f"s{k}", a, b) for a, b, *_ in synapses for k in range(60))
    assert rows < 60 * len(synapses) / 10


def test_solids_of_the_same_triangles_are_packed_once_and_counted_for_each_name(spark, monkeypatch):
    """Three names for one solid, its triangles in another order, and one that differs in a corner."""
    monkeypatch.setattr(volumes.tallies, "STEP", 5)
    corners = [(0, 0, 0), (8, 0, 0), (0, 8, 0), (0, 0, 8)]
    solids = solid("a", corners, TETRA) + solid("b", corners, TETRA[::-1]) + solid("c", corners, TETRA) + solid("d", [*corners[:3], (0, 0, 9)], TETRA)
    df = spark.createDataFrame([(i % 4, i % 6, 1.0 + i % 2, 1.0, 1.0 + i % 3) for i in range(48)], "pre_root_id bigint, post_root_id bigint, x double, y double, z double")
    tables, kept = [], volumes.tallies.written
    monkeypatch.setattr(volumes.tallies, "written", lambda *given: tables.append(kept(*given)) or tables[-1])
    found = volumes.from_synapses(df, None, spark.createDataFrame(solids, MESH)).collect()
    want = Counter((m, i % 4, i % 6) for i in range(48) for m in "abcd")
    assert {(r["mesh"], r["source"], r["target"]): r["weight"] for r in found} == want and len(found) == len(want)
    assert sorted(sorted(m) for r in tables[1].collect() for m in r["meshes"]) == [["a", "b", "c"], ["d"]]


# voxels


def clipped(tri, low, high):
    """What is left of a triangle in a box: empty where they share no point."""
    shape = [tri[0:3], tri[3:6], tri[6:9]]
    for axis in range(3):
        for sign, bound in ((1, low[axis]), (-1, -high[axis])):
            out = []
            for p, q in zip(shape, shape[1:] + shape[:1], strict=True):
                a, b = sign * p[axis] - bound, sign * q[axis] - bound
                if a >= 0:
                    out.append(p)
                if a * b < 0:
                    t = a / (a - b)
                    out.append(tuple(x + t * (y - x) for x, y in zip(p, q, strict=True)))
            shape = out
            if not shape:
                return False
    return True


@pytest.mark.parametrize("block", [16, 2])
def test_voxels_match_clipping_and_solid_angles(spark, monkeypatch, block):
    monkeypatch.setattr(volumes, "BLOCK", block)
    rows, pitch, extent = meshes(), (0.9, 1.1, 1.3), (9.0, 7.7, 9.1)
    size = volumes.grid_size(pitch, extent)
    assert size == (10, 7, 7)
    found = {(r["mesh"], r["i"], r["j"], r["k"]): r["on_surface"] for r in volumes.voxels(spark.createDataFrame(rows, MESH), pitch, extent).collect()}
    by = {}
    for r in rows:
        by.setdefault(r[0], []).append(r)
    want = {}
    for name, tri in by.items():
        for at in itertools.product(*map(range, size)):
            low, high = [i * p for i, p in zip(at, pitch, strict=True)], [(i + 1) * p for i, p in zip(at, pitch, strict=True)]
            if any(clipped(t[2:], low, high) for t in tri):
                want[name, *at] = True
            elif winds([(a + b) / 2 for a, b in zip(low, high, strict=True)], tri):
                want[name, *at] = False
    assert found == want and {True, False} == set(want.values())


def test_voxels_that_are_only_touched(spark):
    tri = spark.createDataFrame([("t", 0, 2.0, 2.0, 2.0, 4.0, 2.0, 2.0, 2.0, 4.0, 2.0)], MESH)
    found = {(r["i"], r["j"], r["k"]) for r in volumes.surface(tri, (6, 6, 6), (1, 1, 1)).collect()}
    assert {k for *_, k in found} == {1, 2}
    assert {(i, j) for i, j, _ in found} == {(i, j) for i in range(1, 5) for j in range(1, 5) if max(i, 2) + max(j, 2) <= 6}


def test_grid_of_the_template():
    assert volumes.grid_size(volumes.PITCH, volumes.EXTENT) == (1209, 565, 173)


def test_open_edges_tell_what_is_missing(spark):
    faces = [("whole", i, *f) for i, f in enumerate(TETRA)] + [("open", i, *f) for i, f in enumerate(TETRA[1:])]
    found = volumes.open_edges(spark.createDataFrame(faces, "mesh string, face int, a int, b int, c int"))
    assert sorted(map(tuple, found.collect())) == [("open", 0, 1, 1), ("open", 0, 2, 1), ("open", 1, 2, 1)]


# snapshots


@pytest.mark.parametrize("parts", [1, 7])
def test_roots_as_of_match_loops(spark, parts):
    rng = random.Random(parts)
    key = lambda: None if rng.random() < 0.05 else "hot" if rng.random() < 0.4 else rng.choice("abcdefgh")
    time = lambda: None if rng.random() < 0.05 else rng.randint(0, 60)
    history = [(key(), time(), rng.choice([None, *range(9)])) for _ in range(400)]
    asked = [(i, key(), time(), 5) for i in range(300)]
    asked += asked[:30]
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    try:
        found = mapping.roots_as_of(spark.createDataFrame(asked, "n int, supervoxel_id string, at int, root int"), spark.createDataFrame(history, "supervoxel_id string, time int, root_id int")).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    want = []
    for n, k, at, _ in asked:
        times = [t for h, t, _ in history if h == k and k is not None and at is not None and t is not None and t <= at]
        since = max(times, default=None)
        want.append((n, k, at, min((r for h, t, r in history if h == k and t == since and r is not None), default=None) if times else None, since))
    assert sorted(map(repr, ((r["n"], r["supervoxel_id"], r["at"], r["root"], r["since"]) for r in found))) == sorted(map(repr, want))


def test_roots_as_of_nothing(spark):
    asked = spark.createDataFrame([(1, "a", 5)], "n int, supervoxel_id string, at int")
    history = spark.createDataFrame([("a", 9, 1)], "supervoxel_id string, time int, root_id int")
    assert [(r["root"], r["since"]) for r in mapping.roots_as_of(asked, history).collect()] == [(None, None)]
    assert [(r["root"], r["since"]) for r in mapping.roots_as_of(asked, history.limit(0)).collect()] == [(None, None)]
    assert mapping.roots_as_of(asked.limit(0), history).collect() == []


def test_voxels_are_grouped_in_pieces_of_bounded_size(spark, monkeypatch):
    df = spark.createDataFrame(solid("tet", [(0, 0, 0), (12, 0, 0), (0, 12, 0), (0, 0, 12)], TETRA), MESH)
    whole = {tuple(r) for r in volumes.voxels(df, (1, 1, 1), (20, 20, 20)).collect()}
    monkeypatch.setattr(volumes, "PIECE_ROWS", 50)
    pieces = volumes.voxels(df, (1, 1, 1), (20, 20, 20))
    assert {tuple(r) for r in pieces.collect()} == whole
    assert pieces.rdd.getNumPartitions() > len(whole) // 50
