"""Closed triangle meshes: points inside them, edges of the synapses inside, and their voxels.

A mesh is rows of triangles: ``mesh``, ``face`` and the corners ``ax ay az bx by bz cx cy cz``.  Whether a point lies inside
is the parity of the triangles that a ray along x crosses.  Lines along x that have points meet triangles in the cells of a
grid over (y, z), never all with all, and points then meet only the parts of their lines that are inside.  A triangle is
filed under the cell size that suits its own extent (a power of four), where it lies in at most four cells, and a line looks
into one cell of each size in use, so that neither large triangles nor small cells multiply rows.

Crossings are half-open: a ray through an edge or corner shared by triangles counts once, and either triangle computes the
edge's side from the same numbers in the same order, so that rounding opens no gap.  Of points on the surface, those are
inside whose crossings strictly beyond them are odd.

Defined cases: points with a null, NaN or infinite coordinate are in no mesh; repeated points each keep their rows; a point
in several meshes has a row for each; a triangle with a missing or non-finite corner is an error, since parity would be
wrong; triangles without area cross nothing; meshes that aren't closed are told by :func:`open_edges`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from edgeloom.operators import edges, tallies
from edgeloom.operators.artifacts import EXTENT, PITCH
from edgeloom.sources.shared import written

CORNERS = tuple(c + axis for c in "abc" for axis in "xyz")
#: Voxels of a block's edge: triangles find their blocks first, and their voxels only there.
BLOCK = 16
#: Rows that one task groups into voxels, about.
PIECE_ROWS = 500_000
#: The level of what has no end.
_OPEN = 1024
_CROSSED = (("x", "y", "z"), ("y", "z", "x"), ("z", "x", "y"))


def triangles(vertices: DataFrame, faces: DataFrame) -> DataFrame:
    """Faces (``mesh``, ``face``, ``part``, ``a``, ``b``, ``c``) with the coordinates of their ``vertices`` (``mesh``, ``vertex``, ``x``, ``y``, ``z``)."""
    corner = F.explode(F.array(*[F.struct(F.lit(k).alias("corner"), F.col(k).alias("vertex")) for k in "abc"])).alias("c")
    named = faces.select("mesh", "face", "part", corner).select("mesh", "face", "part", "c.corner", "c.vertex")
    placed = named.join(vertices.select("mesh", "vertex", "x", "y", "z"), ["mesh", "vertex"], "left")
    at = [F.max(F.when(F.col("corner") == n[0], F.col(n[1]))).alias(n) for n in CORNERS]
    return placed.groupBy("mesh", "face", "part").agg(*at)


def open_edges(faces: DataFrame) -> DataFrame:
    """Edges (``mesh``, ``v``, ``w``, ``faces``) that an odd number of faces share; a closed mesh has none."""
    side = F.explode(F.array(*[F.struct(F.least(p, q).alias("v"), F.greatest(p, q).alias("w")) for p, q in ("ab", "bc", "ca")])).alias("e")
    return faces.select("mesh", side).groupBy("mesh", "e.v", "e.w").agg(F.count(F.lit(1)).alias("faces")).filter("faces % 2 = 1")


def _finite(name: str) -> Column:
    return F.abs(F.col(name)) < float("inf")  # NaN is greater than any number


def _once(held: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """``held`` with more columns, each made once: a generator's output isn't repeated wherever later steps name it."""
    return held.select("*", F.inline(F.array(F.struct(*[x.alias(n) for n, x in columns.items()]))))


def _whole(mesh: DataFrame, prefix: str = "") -> DataFrame:
    """Corners as doubles; any use of a triangle that lacks one is an error."""
    names = [prefix + n for n in CORNERS]
    held = mesh.select("mesh", *[F.col(n).cast("double").alias(n) for n in names])
    whole = F.lit(True)
    for n in names:
        whole = whole & F.coalesce(_finite(n), F.lit(False))
    bad = F.raise_error(F.lit("a triangle has a missing or non-finite corner")).cast("double")
    return held.withColumn("_whole", whole).select("mesh", *[F.when(F.col("_whole"), F.col(n)).otherwise(bad).alias(n) for n in names])


def _crossed(y: Column, z: Column) -> Column:
    """Whether (y, z) lies in the triangle's shadow: an odd number of its sides lie to the right of the point."""
    right = F.lit(0)
    for p, q in ("ab", "bc", "ca"):
        py, pz, qy, qz = (F.col(c + axis) for c in (p, q) for axis in "yz")
        # the lower end of a side comes first, whichever triangle it is seen from
        up = pz < qz
        ly, lz, hy, hz = F.when(up, py).otherwise(qy), F.when(up, pz).otherwise(qz), F.when(up, qy).otherwise(py), F.when(up, qz).otherwise(pz)
        right = right + F.when(((lz <= z) & (z < hz)) & ((y - ly) * (hz - lz) < (hy - ly) * (z - lz)), 1).otherwise(0)
    return right % 2 == 1


def _normal() -> tuple[Column, Column, Column]:
    u, v = ([F.col(q + axis) - F.col("a" + axis) for axis in "xyz"] for q in "bc")
    return u[1] * v[2] - u[2] * v[1], u[2] * v[0] - u[0] * v[2], u[0] * v[1] - u[1] * v[0]


def _span(axis: str) -> tuple[Column, Column]:
    of = [F.col(c + axis) for c in "abc"]
    return F.least(*of), F.greatest(*of)


def _cell(x: Column, level: Column) -> Column:
    return F.floor(x / F.pow(F.lit(4.0), level)).cast("bigint")


def _level(extent: Column) -> Column:
    """The power of four that is no less than ``extent``."""
    return F.ceil(F.log2(extent) / 2).cast("int")


def _filed(held: DataFrame, low: Column, high: Column, name: str) -> DataFrame:
    return held.select("*", F.explode(F.sequence(_cell(low, F.col("level")), _cell(high, F.col("level")))).alias(name))


def _levels(held: DataFrame) -> Column:
    """The levels in use; cell sizes are powers of four of a double, so there are few."""
    found = sorted(r["level"] for r in held.select("level").distinct().collect())
    return F.explode(F.array(*map(F.lit, found)).cast("array<int>")).alias("level")


def _inner(lines: DataFrame, meshes: DataFrame) -> DataFrame:
    """``mesh``, ``low``, ``high``: the parts of each line along x (distinct ``y``, ``z``) that lie in a mesh, ``low`` itself included.

    Crossings are sorted along a line; between the last and the last but one, the third and the fourth last, and so on it is
    inside.  ``low`` is null where an open mesh leaves an odd number of crossings.
    """
    c = F.col
    (y0, y1), (z0, z1) = _span("y"), _span("z")
    extent = F.greatest(y1 - y0, z1 - z0)
    filed = _whole(meshes).withColumn("level", F.when(extent > 0, _level(extent))).filter("level IS NOT NULL")
    levels = _levels(filed)
    filed = _filed(_filed(filed, y0, y1, "row"), z0, z1, "column")
    seen = lines.select("*", levels).select("*", _cell(c("y"), c("level")).alias("row"), _cell(c("z"), c("level")).alias("column"))
    nx, ny, nz = _normal()
    at = c("ax") + (ny * (c("ay") - c("y")) + nz * (c("az") - c("z"))) / nx
    met = seen.join(filed, ["level", "row", "column"]).filter(_crossed(c("y"), c("z")) & (nx != 0)).select("mesh", "y", "z", at.alias("high"))
    along = Window.partitionBy("mesh", "y", "z").orderBy(F.desc("high"))
    parts = met.select("*", F.row_number().over(along).alias("n"), F.lead("high").over(along).alias("low"))
    return parts.filter("n % 2 = 1 AND (low IS NULL OR low < high)").drop("n")


def inside(points: DataFrame, meshes: DataFrame) -> DataFrame:
    """``points`` (``x``, ``y``, ``z`` and whatever else) with each ``mesh`` that holds them; an older ``mesh`` column is replaced.

    Triangles meet the lines along x that have points, each once, and points then the parts of their lines that are inside.
    A part is filed under the power of four that suits its length, in at most two cells along x; one without a low end, of a
    mesh that isn't closed, is in a cell that every point looks into.
    """
    c = F.col
    held = points.drop("mesh")
    held = held.select(F.struct(*[F.col(f"`{n}`") for n in held.columns]).alias("row"), *[c(n).cast("double").alias(n) for n in "xyz"])
    held = held.filter(_finite("x") & _finite("y") & _finite("z"))
    parts = _inner(held.select("y", "z").distinct(), meshes).withColumn("level", F.coalesce(_level(c("high") - c("low")), F.lit(_OPEN)))
    parts = written(parts, "inner-parts")
    levels = _levels(parts)
    open_end = c("level") == _OPEN
    filed = _filed(parts, F.when(~open_end, c("low")).otherwise(0.0), F.when(~open_end, c("high")).otherwise(0.0), "cell")
    seen = held.select("*", levels).select("*", F.when(~open_end, _cell(c("x"), c("level"))).otherwise(0).alias("cell"))
    met = seen.join(filed, ["y", "z", "level", "cell"]).filter((c("x") < c("high")) & (c("low").isNull() | (c("x") >= c("low"))))
    return met.select("row.*", "mesh")


def memberships(points: DataFrame, meshes: DataFrame) -> DataFrame:
    """Distinct ``x``, ``y``, ``z`` of ``points`` with each ``mesh`` that holds them."""
    return inside(points.select(*[F.col(n).cast("double").alias(n) for n in "xyz"]).distinct(), meshes)


def from_synapses(synapses: DataFrame, ids: DataFrame | None, meshes: DataFrame, threshold: int = 0) -> DataFrame:
    """``mesh``, ``source``, ``target`` and ``weight``: synapses inside each mesh counted by pair, counts over the threshold.

    Synapses have ``x``, ``y``, ``z`` and ends under any of the known names; both ends must be in ``ids`` if given.
    Pairs with no more synapses than the threshold meet no mesh.  Synapses of a pair meet a mesh in one task, so that none of
    the many rows of pairs and meshes is shuffled.
    """
    held = _synapses(synapses, ids)
    if threshold > 0:
        pair = F.count(F.lit(1)).over(Window.partitionBy("source", "target"))
        held = written(held.withColumn("of_pair", pair).filter(F.col("of_pair") > threshold).drop("of_pair"), "synapses")
    return edges.over(tallies.counted(held.withColumn("kind", F.lit(0)), _whole(meshes), ("weight",)), threshold)


def strengths_from_synapses(synapses: DataFrame, ids: DataFrame | None, meshes: DataFrame) -> DataFrame:
    """The rows of :func:`region_strengths` for all edges of :func:`from_synapses`, whose many rows aren't made."""
    held = _synapses(synapses, ids)
    end = F.inline(F.array(*[F.struct(F.col(k).alias("node"), F.lit(i).alias("kind")) for i, k in enumerate(("source", "target"))]))
    return tallies.counted(held.select(end, "x", "y", "z"), _whole(meshes), ("outgoing", "incoming"))


def _synapses(synapses: DataFrame, ids: DataFrame | None) -> DataFrame:
    """Synapses with both ends, and those in ``ids`` if given, at a place that can be in a mesh."""
    held = edges.renamed(synapses).select("source", "target", *[F.col(n).cast("double").alias(n) for n in "xyz"])
    held = held.filter("source IS NOT NULL AND target IS NOT NULL").filter(_finite("x") & _finite("y") & _finite("z"))
    return held if ids is None else written(edges.within(held, ids), "synapses")


def region_strengths(volume_edges: DataFrame) -> DataFrame:
    """``mesh``, ``node`` and its outgoing and incoming weight there; nodes in neither direction have no row."""
    ends = volume_edges.select("mesh", "weight", F.explode(F.array(*[F.struct(F.col(k).alias("node"), F.lit(k == "source").alias("out")) for k in ("source", "target")])).alias("end"))
    part = lambda out: F.coalesce(F.sum(F.when(F.col("end.out") == out, F.col("weight"))), F.lit(0)).cast("bigint")
    return ends.groupBy("mesh", F.col("end.node").alias("node")).agg(part(True).alias("outgoing"), part(False).alias("incoming")).filter("outgoing != 0 OR incoming != 0")


# voxels


def _in_voxels(meshes: DataFrame, pitch: tuple[float, float, float]) -> DataFrame:
    """Corners in units of voxels."""
    held = _whole(meshes.select("mesh", *[F.col(n).alias(f"_{n}") for n in CORNERS]), "_")
    return _once(held, {n: F.col(f"_{n}") / pitch["xyz".index(n[1])] for n in CORNERS}).select("mesh", *CORNERS)


def grid_size(pitch: tuple[float, float, float], extent: tuple[float, float, float]) -> tuple[int, int, int]:
    """Voxels along each axis: as many as begin before the extent ends; a rounding error begins none."""
    return tuple(max(0, -int(-(e / p - 1e-6) // 1)) for p, e in zip(pitch, extent, strict=True))


def _with_axes(held: DataFrame) -> DataFrame:
    """What the separating-axis test needs of each triangle: for each axis its direction and the triangle's span along it."""
    sides = {f"e{k}{axis}": F.col(q + axis) - F.col(p + axis) for k, (p, q) in enumerate(("ab", "bc", "ca")) for axis in "xyz"}
    held = _once(held, sides | dict(zip(("nx", "ny", "nz"), _normal(), strict=True)))
    spans = {"nd": F.col("nx") * F.col("ax") + F.col("ny") * F.col("ay") + F.col("nz") * F.col("az")}
    for k in range(3):
        # a side crossed with an axis of the grid has two components
        for axis, u, v in _CROSSED:
            along = [F.col(f"e{k}{u}") * F.col(c + v) - F.col(f"e{k}{v}") * F.col(c + u) for c in "abc"]
            spans |= {f"lo{k}{axis}": F.least(*along), f"hi{k}{axis}": F.greatest(*along)}
    return _once(held, spans)


def _touches(centre: dict[str, Column], half: float) -> Column:
    """Whether the triangle and a cube share a point, given that its bounding box and the cube do."""
    c = F.col
    reach = half * (F.abs(c("nx")) + F.abs(c("ny")) + F.abs(c("nz")))
    held = F.abs(c("nx") * centre["x"] + c("ny") * centre["y"] + c("nz") * centre["z"] - c("nd")) <= reach
    for k in range(3):
        for axis, u, v in _CROSSED:
            eu, ev = c(f"e{k}{u}"), c(f"e{k}{v}")
            at, reach = eu * centre[v] - ev * centre[u], half * (F.abs(eu) + F.abs(ev))
            held = held & (at + reach >= c(f"lo{k}{axis}")) & (at - reach <= c(f"hi{k}{axis}"))
    return held


def _exploded(held: DataFrame, ranges: dict[str, tuple[Column, Column]]) -> DataFrame:
    """A row for each whole number of each range; none where a range is empty."""
    for name, (first, last) in ranges.items():
        held = held.withColumn(name, F.explode(F.when(first <= last, F.sequence(first.cast("int"), last.cast("int")))))
    return held


def _touched(meshes: DataFrame, size: tuple[int, int, int], pitch: tuple[float, float, float]) -> DataFrame:
    """``mesh``, ``i``, ``j``, ``k`` of the voxels of :func:`surface`, once for each triangle."""
    c = F.col
    held, bounds = _in_voxels(meshes, pitch), {}
    # first and last voxel that the bounding box touches
    for axis, most in zip("xyz", size, strict=True):
        low, high = _span(axis)
        bounds |= {f"f{axis}": F.greatest(F.ceil(low) - 1, F.lit(0)), f"l{axis}": F.least(F.floor(high), F.lit(most - 1))}
    held = _with_axes(_once(held, bounds).filter("fx <= lx AND fy <= ly AND fz <= lz"))
    held = _exploded(held, {f"b{axis}": (F.floor(c(f"f{axis}") / BLOCK), F.floor(c(f"l{axis}") / BLOCK)) for axis in "xyz"})
    held = held.filter(_touches({axis: (c(f"b{axis}") + 0.5) * BLOCK for axis in "xyz"}, BLOCK / 2))
    held = _exploded(held, {n: (F.greatest(c(f"f{axis}"), c(f"b{axis}") * BLOCK), F.least(c(f"l{axis}"), c(f"b{axis}") * BLOCK + BLOCK - 1)) for n, axis in zip("ijk", "xyz", strict=True)})
    return held.filter(_touches({axis: c(n) + 0.5 for n, axis in zip("ijk", "xyz", strict=True)}, 0.5)).select("mesh", "i", "j", "k")


def surface(meshes: DataFrame, size: tuple[int, int, int], pitch: tuple[float, float, float] = PITCH) -> DataFrame:
    """Distinct ``mesh``, ``i``, ``j``, ``k`` of the voxels (closed boxes) that share a point with a triangle."""
    return _touched(meshes, size, pitch).distinct()


def interior(meshes: DataFrame, size: tuple[int, int, int], pitch: tuple[float, float, float] = PITCH) -> DataFrame:
    """``mesh``, ``i``, ``j``, ``k`` of the voxels whose centres lie inside, filled along x between crossings."""
    c = F.col
    held, span = _in_voxels(meshes, pitch), {}
    for n, axis, most in zip("jk", "yz", size[1:], strict=True):
        low, high = _span(axis)
        span[n] = (F.greatest(F.ceil(low - 0.5), F.lit(0)), F.least(F.floor(high - 0.5), F.lit(most - 1)))
    held = _exploded(held, span)
    y, z = c("j") + 0.5, c("k") + 0.5
    nx, ny, nz = _normal()
    held = held.filter(_crossed(y, z) & (nx != 0)).select("mesh", "j", "k", (c("ax") - (ny * (y - c("ay")) + nz * (z - c("az"))) / nx).alias("at"))
    along = Window.partitionBy("mesh", "j", "k").orderBy("at")
    held = held.select("*", F.row_number().over(along).alias("n"), F.lead("at").over(along).alias("to")).filter("n % 2 = 1 AND to IS NOT NULL")
    return _exploded(held, {"i": (F.greatest(F.ceil(c("at") - 0.5), F.lit(0)), F.least(F.floor(c("to") - 0.5), F.lit(size[0] - 1)))}).select("mesh", "i", "j", "k")


def voxels(meshes: DataFrame, pitch: tuple[float, float, float] = PITCH, extent: tuple[float, float, float] = EXTENT) -> DataFrame:
    """``mesh``, ``i``, ``j``, ``k``, ``on_surface`` and ``value`` (255) of every voxel that a solid fills or touches.

    Voxels outside the extent are left out; a solid that reaches beyond it is cut there.  A small table of triangles makes a
    large one of voxels: triangles are spread over all tasks, voxels leave these ungrouped, and are counted before they are
    grouped in tasks of ``PIECE_ROWS`` each, so that no task's memory grows with the meshes.
    """
    size, keys = grid_size(pitch, extent), ("mesh", "i", "j", "k")
    spread = meshes.select("mesh", *CORNERS).repartition(int(meshes.sparkSession.conf.get("spark.sql.shuffle.partitions")), "mesh", *CORNERS)
    both = _touched(spread, size, pitch).withColumn("on", F.lit(True)).unionByName(interior(spread, size, pitch).withColumn("on", F.lit(False)))
    both = written(both, "voxels")
    both = both.repartition(both.count() // PIECE_ROWS + 1, *keys)
    return both.groupBy("mesh", "i", "j", "k").agg(F.bool_or("on").alias("on_surface")).withColumn("value", F.lit(255).cast("smallint"))
