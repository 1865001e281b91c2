"""Registered queries on meshes, voxels and snapshots, and the SQL that gives the same rows.

Suppliers are solids (octahedra, of which distances in SQL tell inside from outside), line items are synapses.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from edgeloom.operators import mapping, spaces, volumes
from edgeloom.plans.queries import table
from edgeloom.sinks import shapes
from edgeloom.sources import readers
from edgeloom.sources.shared import fresh_folder


#: Corners of an octahedron as (axis, sign), and its faces by the corners' places.
_OCTAHEDRON = [(axis, sign) for axis in "xyz" for sign in (1, -1)]
_FACES = [(x, y, z) for x in (1, 2) for y in (3, 4) for z in (5, 6)]


def supplier_solids(spark, d, least: int, step: int):
    """A closed mesh for each supplier: an octahedron, as the vertices and faces of a mesh file."""
    c = F.col
    centre = {"x": c("s_suppkey") * 37 % 400, "y": c("s_suppkey") * 53 % 300, "z": c("s_nationkey") * 8}
    radius = least + c("s_suppkey") % step + F.lit(0.5)
    corner = lambda i, axis, sign: F.struct(F.lit(i).alias("vertex"), *[(centre[a] + (radius * sign if a == axis else 0.0)).alias(a) for a in "xyz"])
    vertices = table(spark, d, "supplier").select(c("s_suppkey").alias("mesh"), F.explode(F.array(*[corner(i + 1, *x) for i, x in enumerate(_OCTAHEDRON)])).alias("v")).select("mesh", "v.*")
    face = lambda i, abc: F.struct(F.lit(i).alias("face"), F.lit(0).alias("part"), *[F.lit(v).alias(n) for n, v in zip("abc", abc, strict=True)])
    faces = table(spark, d, "supplier").select(c("s_suppkey").alias("mesh"), F.explode(F.array(*[face(i, x) for i, x in enumerate(_FACES)])).alias("f")).select("mesh", "f.*")
    return vertices, faces


def placed_synapses(spark, d):
    """Line items as synapses at points of a grid."""
    c = F.col
    return table(spark, d, "lineitem").select(c("l_suppkey").alias("pre_pt_root_id"), c("l_partkey").alias("post_pt_root_id"), (c("l_partkey") % 400).alias("x"), (c("l_orderkey") * 7 % 300).alias("y"), (c("l_quantity") * 4).alias("z"))


def volume_synapses(spark, d):
    """Edges of the synapses inside each solid, both ends in a registry of the even ids."""
    ids = table(spark, d, "part").select(F.col("p_partkey").alias("id")).union(table(spark, d, "supplier").select("s_suppkey")).filter("id % 2 = 0")
    return volumes.from_synapses(placed_synapses(spark, d), ids, volumes.triangles(*supplier_solids(spark, d, 20, 30)), threshold=0)


def volume_strengths(spark, d):
    """Incoming and outgoing synapses of each neuron in each solid."""
    return volumes.strengths_from_synapses(placed_synapses(spark, d), None, volumes.triangles(*supplier_solids(spark, d, 20, 30)))


def mesh_voxels(spark, d):
    """Voxels that each solid fills or touches; those beyond the extent are cut off."""
    return volumes.voxels(volumes.triangles(*supplier_solids(spark, d, 1, 9)), pitch=(1.0, 0.5, 2.0), extent=(390.0, 280.0, 180.0))


def mesh_open_edges(spark, d):
    """Edges that the faces of a solid leave open where one or two of them are missing."""
    _, faces = supplier_solids(spark, d, 1, 9)
    return volumes.open_edges(faces.filter("mesh % 3 = 0 OR face >= mesh % 3"))


def roots_as_of(spark, d):
    """Line items with the newest order that a customer had made by their date."""
    c = F.col
    history = table(spark, d, "orders").select(c("o_custkey").alias("supervoxel_id"), c("o_orderdate").alias("time"), F.when(c("o_orderkey") % 11 != 0, c("o_orderkey").cast("string")).alias("root_id"))
    asked = table(spark, d, "lineitem").select(c("l_orderkey").alias("line"), "l_linenumber", (c("l_partkey") % 1700).alias("supervoxel_id"), F.when(c("l_suppkey") % 17 != 0, c("l_shipdate")).alias("at"))
    return mapping.roots_as_of(asked, history)


def _of_file(column: str = "mesh"):
    return F.regexp_extract(column, "mesh=([0-9]+)/", 1).cast("bigint")


def mesh_files(spark, d):
    """The solids through mesh files: triangles of what is read back."""
    path = fresh_folder(spark, "meshes")
    shapes.meshes(*supplier_solids(spark, d, 20, 30), path)
    return volumes.triangles(*readers.meshes(spark, path)).withColumn("mesh", _of_file())


def grid_files(spark, d):
    """Cells that a supplier's line items occupy, through grid files."""
    c = F.col
    path = fresh_folder(spark, "grids")
    held = table(spark, d, "lineitem").select((c("l_suppkey") % 40).alias("mesh"), (c("l_quantity") - 1).cast("int").alias("i"), F.round(c("l_discount") * 100).cast("int").alias("j"), F.round(c("l_tax") * 100).cast("int").alias("k"))
    shapes.grids(held.filter("i % 3 = 0"), path, (50, 11, 9), (2.0, 1.0, 1.0))
    return readers.grids(spark, path, "part-*").withColumn("mesh", _of_file())


def skeleton_files(spark, d):
    """Parts as trees, whose files have parents before children."""
    c = F.col
    path = fresh_folder(spark, "skeletons")
    place = F.floor(c("p_partkey") / 7)
    parent = F.when(place > 0, F.floor((place - 1) / 2) * 7 + c("p_partkey") % 7).otherwise(-1)
    samples = table(spark, d, "part").select((c("p_partkey") % 7).alias("mesh"), c("p_partkey").alias("sample"), (c("p_size") % 8).alias("kind"), c("p_partkey").cast("double").alias("x"), (c("p_size") / 4).alias("y"), F.lit(0.5).alias("z"), F.lit(0.25).alias("radius"), parent.cast("bigint").alias("parent"))
    shapes.skeletons(samples, path)
    return readers.skeletons(spark, path + "/*/*").withColumn("mesh", _of_file("path")).drop("path")


def bridged_points(spark, d):
    """Line items as points through an affine bridge and a field whose nodes are parts; those outside it have no place."""
    c = F.col
    node = lambda k: ((c("p_partkey") * k % 11 - 5) / 8).cast("double")
    nodes = table(spark, d, "part").select((c("p_partkey") % 5).alias("i"), F.floor(c("p_partkey") / 5).cast("bigint").alias("j"), F.lit(0).alias("k"), node(7).alias("dx"), node(3).alias("dy"), node(4).alias("dz"))
    nodes = nodes.union(nodes.withColumn("k", F.lit(1)).withColumn("dx", -c("dx")))
    field = spaces.field_of(nodes.filter("i < 4 OR j < 30"), (0.0, 0.0, 0.0), (4.0, 4.0, 32.0))
    bridges = spaces.Spaces().affine("RAW", "MID", [[0.25, 0, 0, 0], [0, 1, 0, 2], [0, 0, 0.5, 0]]).displacement("MID", "TEMPLATE", field)
    points = table(spark, d, "lineitem").select("l_partkey", "l_suppkey", "l_quantity").distinct().select("l_partkey", "l_suppkey", "l_quantity", (c("l_partkey") % 72).alias("x"), (c("l_suppkey") * 5 % 160).alias("y"), c("l_quantity").alias("z"))
    return bridges.transform(points, "RAW", "TEMPLATE", via="MID")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (volume_synapses, volume_strengths, mesh_voxels, mesh_open_edges, roots_as_of, mesh_files, grid_files, skeleton_files, bridged_points)}

_SOLIDS = "SELECT s_suppkey AS mesh, s_suppkey * 37 % 400 AS cx, s_suppkey * 53 % 300 AS cy, s_nationkey * 8 AS cz, s_suppkey % {step} + {least} + 0.5 AS r FROM supplier"
_SYNAPSES = "SELECT l_suppkey AS source, l_partkey AS target, l_partkey % 400 AS x, l_orderkey * 7 % 300 AS y, l_quantity * 4 AS z FROM lineitem"
_INSIDE = f"SELECT mesh, source, target, count(*) AS weight FROM ({_SOLIDS.format(step=30, least=20)}) v JOIN ({_SYNAPSES}) p ON abs(x - cx) + abs(y - cy) + abs(z - cz) < r {{0}} GROUP BY ALL"


def _reach(most: bool, *axes: tuple[str, str, float]) -> str:
    """The least or most sum of distances along the axes from a centre to a voxel."""
    low, high = (lambda n, p: f"{n} * {p}"), (lambda n, p: f"({n} + 1) * {p}")
    if most:
        return " + ".join(f"greatest(abs({low(n, p)} - {c}), abs({high(n, p)} - {c}))" for n, c, p in axes)
    return " + ".join(f"greatest(0, {low(n, p)} - {c}, {c} - {high(n, p)})" for n, c, p in axes)


_AXES = (("i", "cx", 1.0), ("j", "cy", 0.5), ("k", "cz", 2.0))

ORACLES: dict[str, str] = {
    "volume_synapses": _INSIDE.format("WHERE source % 2 = 0 AND target % 2 = 0 AND (source IN (SELECT p_partkey FROM part UNION ALL SELECT s_suppkey FROM supplier)) AND (target IN (SELECT p_partkey FROM part UNION ALL SELECT s_suppkey FROM supplier))"),
    "volume_strengths": f"SELECT mesh, node, CAST(sum(CASE WHEN way THEN weight ELSE 0 END) AS BIGINT) AS outgoing, CAST(sum(CASE WHEN way THEN 0 ELSE weight END) AS BIGINT) AS incoming FROM (SELECT mesh, source AS node, weight, true AS way FROM ({_INSIDE.format('')}) UNION ALL SELECT mesh, target, weight, false FROM ({_INSIDE.format('')})) GROUP BY ALL",
    "mesh_voxels": f"""SELECT mesh, CAST(i AS INTEGER) AS i, CAST(j AS INTEGER) AS j, CAST(k AS INTEGER) AS k, {_reach(True, *_AXES)} >= r AS on_surface, CAST(255 AS SMALLINT) AS value
      FROM (SELECT *, unnest(range(CAST(greatest(0, floor(cz - r) / 2 - 2) AS BIGINT), CAST(least(90, (cz + r) / 2 + 2) AS BIGINT))) AS k
      FROM (SELECT *, unnest(range(CAST(greatest(0, floor(cy - r) * 2 - 2) AS BIGINT), CAST(least(560, (cy + r) * 2 + 2) AS BIGINT))) AS j
      FROM (SELECT *, unnest(range(CAST(greatest(0, floor(cx - r) - 2) AS BIGINT), CAST(least(390, cx + r + 2) AS BIGINT))) AS i FROM ({_SOLIDS.format(step=9, least=1)}) s) t) u) w WHERE {_reach(False, *_AXES)} <= r""",
    "mesh_open_edges": """SELECT mesh, v, w, count(*) AS faces FROM (
      SELECT mesh, unnest([{'v': x, 'w': y}, {'v': y, 'w': z}, {'v': x, 'w': z}], recursive := true) FROM (
        SELECT s_suppkey AS mesh, x, y, z, (x - 1) * 4 + (y - 3) * 2 + z - 5 AS face FROM supplier, (VALUES (1), (2)) AS a(x), (VALUES (3), (4)) AS b(y), (VALUES (5), (6)) AS c(z))
      WHERE mesh % 3 = 0 OR face >= mesh % 3) GROUP BY ALL HAVING count(*) % 2 = 1""",
    "roots_as_of": """SELECT q.*, h.root, h.since FROM (SELECT l_orderkey AS line, l_linenumber, l_partkey % 1700 AS supervoxel_id, CASE WHEN l_suppkey % 17 != 0 THEN l_shipdate END AS at FROM lineitem) q
      ASOF LEFT JOIN (SELECT o_custkey AS key, o_orderdate AS since, min(CASE WHEN o_orderkey % 11 != 0 THEN CAST(o_orderkey AS VARCHAR) END) AS root FROM orders GROUP BY ALL) h ON q.supervoxel_id = h.key AND q.at >= h.since""",
    "mesh_files": f"""SELECT s.mesh, CAST((x.n - 1) * 4 + (y.n - 3) * 2 + z.n - 5 + 1 AS BIGINT) AS face, 0 AS part, cx + r * x.side AS ax, CAST(cy AS DOUBLE) AS ay, CAST(cz AS DOUBLE) AS az,
      CAST(cx AS DOUBLE) AS bx, cy + r * y.side AS by, CAST(cz AS DOUBLE) AS bz, CAST(cx AS DOUBLE) AS cx, CAST(cy AS DOUBLE) AS cy, cz + r * z.side AS cz
      FROM ({_SOLIDS.format(step=30, least=20)}) s, (VALUES (1, 1), (2, -1)) AS x(n, side), (VALUES (3, 1), (4, -1)) AS y(n, side), (VALUES (5, 1), (6, -1)) AS z(n, side)""",
    "grid_files": "SELECT DISTINCT l_suppkey % 40 AS mesh, CAST(l_quantity - 1 AS INTEGER) AS i, CAST(round(l_discount * 100) AS INTEGER) AS j, CAST(round(l_tax * 100) AS INTEGER) AS k, CAST(255 AS DOUBLE) AS value FROM lineitem WHERE CAST(l_quantity - 1 AS INTEGER) % 3 = 0",
    "skeleton_files": """WITH p AS (SELECT p_partkey % 7 AS mesh, p_partkey // 7 AS place, p_partkey AS old, row_number() OVER (PARTITION BY p_partkey % 7 ORDER BY p_partkey) AS sample, p_size FROM part)
      SELECT p.mesh, p.sample, p_size % 8 AS kind, CAST(old AS DOUBLE) AS x, p_size / 4 AS y, CAST(0.5 AS DOUBLE) AS z, CAST(0.25 AS DOUBLE) AS radius, coalesce(q.sample, -1) AS parent
      FROM p LEFT JOIN (SELECT mesh AS m, place AS q, sample FROM p) q ON m = p.mesh AND p.place > 0 AND q.q = (p.place - 1) // 2""",
    "bridged_points": """WITH n AS (SELECT p_partkey % 5 AS i, p_partkey // 5 AS j, k, (p_partkey * 7 % 11 - 5) / 8 * CASE WHEN k = 1 THEN -1 ELSE 1 END AS dx, (p_partkey * 3 % 11 - 5) / 8 AS dy, (p_partkey * 4 % 11 - 5) / 8 AS dz
        FROM part, (VALUES (0), (1)) AS t(k) WHERE p_partkey % 5 < 4 OR p_partkey // 5 < 30),
      m AS (SELECT max(i) AS mi, max(j) AS mj FROM n),
      p AS (SELECT DISTINCT l_partkey, l_suppkey, l_quantity, (l_partkey % 72) * 0.25 AS x, (l_suppkey * 5 % 160) + 2 AS y, CAST(l_quantity AS DOUBLE) * 0.5 AS z FROM lineitem),
      u AS (SELECT *, CAST(least(floor(x / 4), mi - 1) AS BIGINT) AS ci, CAST(least(floor(y / 4), mj - 1) AS BIGINT) AS cj FROM p, m),
      w AS (SELECT l_partkey, l_suppkey, l_quantity, count(*) AS corners, sum(f * dx) AS dx, sum(f * dy) AS dy, sum(f * dz) AS dz FROM (
        SELECT u.l_partkey, u.l_suppkey, u.l_quantity, n.dx, n.dy, n.dz, (1 - abs(x / 4 - n.i)) * (1 - abs(y / 4 - n.j)) * (1 - abs(z / 32 - n.k)) AS f
        FROM u JOIN n ON n.i IN (ci, ci + 1) AND n.j IN (cj, cj + 1) AND x / 4 <= mi AND y / 4 <= mj) c GROUP BY ALL HAVING count(*) = 8)
      SELECT p.l_partkey, p.l_suppkey, p.l_quantity, CAST(x + dx AS DOUBLE) AS x, CAST(y + dy AS DOUBLE) AS y, CAST(z + dz AS DOUBLE) AS z FROM p LEFT JOIN w USING (l_partkey, l_suppkey, l_quantity)""",
}
