"""Points from one registered coordinate space to another.

Spaces are the nodes of a small graph and transforms its edges: affine matrices, and displacement fields given as grids of
vectors.  A path between two spaces is the cheapest one (through a third space if asked for); affine steps in a row are one
matrix, and everything is columns of the points' own rows but for fields: a field is a table of cells with the vectors of
their eight corners, which points meet by their cell's key, and trilinear weights are columns again.

Defined cases: a point with a null, NaN or infinite coordinate has null coordinates in any other space, and so has one
outside a field on its way; no row is lost or doubled, and other columns stay.  A field's own border is inside.  A cell that
lacks a corner is outside.  No path is an error, as is a matrix that can't be turned round when it must be.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from edgeloom.sources.shared import written

AXES = ("x", "y", "z")
#: A step back through a field is a search, each round of which meets the field again.
_COSTS = {"affine": 1, "field": 2, "field back": 8}
ROUNDS = 12
#: Corners that one task puts together into cells, about.
PIECE_ROWS = 500_000


@dataclass(frozen=True)
class Field:
    """Displacements at grid nodes: ``cells`` has ``ci cj ck`` and ``d000 … d111`` (vectors at the corners), ``most`` the last node of each axis."""

    cells: DataFrame
    origin: tuple[float, float, float]
    spacing: tuple[float, float, float]
    most: tuple[int, int, int]


def field_of(nodes: DataFrame, origin: tuple[float, float, float], spacing: tuple[float, float, float]) -> Field:
    """A field from its ``nodes`` (``i``, ``j``, ``k``, ``dx``, ``dy``, ``dz``); of a repeated node the least vector counts.

    A node is a corner of up to eight cells; cells are put together once and kept in the shared folder.
    """
    corners = [(a, b, c) for a in (0, 1) for b in (0, 1) for c in (0, 1)]
    held = nodes.select(*[F.col(n).cast("bigint").alias(n) for n in "ijk"], F.struct(*[F.col(f"d{a}").cast("double").alias(a) for a in AXES]).alias("d"))
    of = F.explode(F.array(*[F.struct(F.lit("".join(map(str, k))).alias("corner"), *[(F.col(n) - o).alias(f"c{n}") for n, o in zip("ijk", k, strict=True)]) for k in corners])).alias("at")
    vectors = [F.min(F.when(F.col("at.corner") == "".join(map(str, k)), F.col("d"))).alias("d" + "".join(map(str, k))) for k in corners]
    # dealt by cell before they are sorted into cells, so that no task's memory grows with the field
    dealt = held.select("d", of).repartition(nodes.count() * len(corners) // PIECE_ROWS + 1, "at.ci", "at.cj", "at.ck")
    cells = dealt.groupBy("at.ci", "at.cj", "at.ck").agg(*vectors)
    whole = written(cells.dropna(subset=["d" + "".join(map(str, k)) for k in corners]), "field-cells")
    most = whole.agg(*[F.max(f"c{n}").alias(n) for n in "ijk"]).first()
    return Field(whole, tuple(map(float, origin)), tuple(map(float, spacing)), tuple(-1 if m is None else m + 1 for m in most))


def _finite(columns) -> Column:
    held = F.lit(True)
    for c in columns:
        held = held & F.coalesce(F.abs(c) < float("inf"), F.lit(False))  # NaN is greater than any number
    return held


def _moved(points: DataFrame, matrix: np.ndarray) -> DataFrame:
    """``_x``, ``_y``, ``_z`` through a matrix of three rows of four."""
    c = [F.col(f"_{a}") for a in AXES]

    def row(r):
        terms = [x if m == 1 else x * float(m) for x, m in zip(c, r, strict=False) if m] + ([F.lit(float(r[3]))] if r[3] else [])
        total = terms[0] if terms else c[0] * 0.0
        for t in terms[1:]:
            total = total + t
        # a coordinate that no term names still has to be null where the point is
        return F.when(c[0].isNotNull() & c[1].isNotNull() & c[2].isNotNull(), total)

    return points.withColumns({f"_{a}": row(r) for a, r in zip(AXES, matrix, strict=True)})


def _displaced(points: DataFrame, at: tuple[str, ...], f: Field) -> DataFrame:
    """``points`` with ``_dx``, ``_dy``, ``_dz``: the field's vector at the columns ``at``, null outside."""
    unit = [(F.col(n) - o) / s for n, o, s in zip(at, f.origin, f.spacing, strict=True)]
    inside = _finite([F.col(n) for n in at])
    for u, m in zip(unit, f.most, strict=True):
        inside = inside & (u >= 0) & (u <= m)
    # the last node belongs to the cell before it
    cell = {f"_c{n}": F.when(inside, F.least(F.floor(u), F.lit(m - 1)).cast("bigint")) for n, u, m in zip("ijk", unit, f.most, strict=True)}
    keyed = points.withColumns(cell)
    same = [F.col(f"_c{n}") == F.col(f"c{n}") for n in "ijk"]
    met = keyed.join(f.cells, same[0] & same[1] & same[2], "left")
    weight = [u - F.col(f"_c{n}") for n, u in zip("ijk", unit, strict=True)]

    def along(axis):
        value = lambda *k: F.col("d" + "".join(map(str, k)))[axis]
        mix = lambda a, b, w: a + (b - a) * w
        planes = [[mix(value(a, b, 0), value(a, b, 1), weight[2]) for b in (0, 1)] for a in (0, 1)]
        return mix(*[mix(*p, weight[1]) for p in planes], weight[0])

    found = met.withColumns({f"_d{a}": along(a) for a in AXES})
    return found.drop("_ci", "_cj", "_ck", *f.cells.columns)


def _forth(points: DataFrame, f: Field) -> DataFrame:
    found = _displaced(points, tuple(f"_{a}" for a in AXES), f)
    return found.withColumns({f"_{a}": F.col(f"_{a}") + F.col(f"_d{a}") for a in AXES}).drop(*[f"_d{a}" for a in AXES])


def _back(points: DataFrame, f: Field, rounds: int) -> DataFrame:
    """Where the field takes to the point: each round corrects the last guess by what it misses, which converges for fields that bend less than they move."""
    guess = points.withColumns({f"_g{a}": F.col(f"_{a}") for a in AXES})
    for n in range(rounds):
        found = _displaced(guess, tuple(f"_g{a}" for a in AXES), f)
        guess = found.withColumns({f"_g{a}": F.col(f"_{a}") - F.col(f"_d{a}") for a in AXES}).drop(*[f"_d{a}" for a in AXES])
        if n % 4 == 3:
            guess = written(guess, "guesses")  # else the plan grows with the rounds
    return guess.withColumns({f"_{a}": F.col(f"_g{a}") for a in AXES}).drop(*[f"_g{a}" for a in AXES])


def _inverse(matrix: np.ndarray) -> np.ndarray:
    whole = np.vstack([matrix, [0, 0, 0, 1]])
    if abs(np.linalg.det(whole[:3, :3])) < 1e-300:
        raise ValueError("a matrix that can't be turned round")
    return np.linalg.inv(whole)[:3]


@dataclass
class Spaces:
    """The registered spaces and the transforms between them."""

    steps: dict[str, list[tuple[str, str, object]]] = field(default_factory=dict)

    def affine(self, source: str, target: str, matrix) -> Spaces:
        """Three rows of four: a linear part and a shift.  Registered for both directions."""
        m = np.asarray(matrix, dtype=float)
        if m.shape != (3, 4) or not np.isfinite(m).all():
            raise ValueError("three rows of four finite numbers")
        self.steps.setdefault(source, []).append((target, "affine", m))
        self.steps.setdefault(target, []).append((source, "affine back", m))
        return self

    def displacement(self, source: str, target: str, f: Field) -> Spaces:
        """Points of ``source`` move by the field's vectors; the other direction is searched for."""
        self.steps.setdefault(source, []).append((target, "field", f))
        self.steps.setdefault(target, []).append((source, "field back", f))
        return self

    def path(self, source: str, target: str, via: str | None = None) -> list[tuple[str, object]]:
        """The cheapest steps from one space to the other, fewest transforms of fields first."""
        if via is not None:
            return self.path(source, via) + self.path(via, target)
        best, queue, n = {}, [(0, 0, source, [])], 0
        while queue:
            cost, _, at, steps = heapq.heappop(queue)
            if at == target:
                return steps
            if at in best:
                continue
            best[at] = cost
            for to, kind, what in self.steps.get(at, ()):
                n += 1
                heapq.heappush(queue, (cost + _COSTS.get(kind, 1), n, to, [*steps, (kind, what)]))
        raise ValueError(f"no path from {source} to {target}")

    def transform(self, points: DataFrame, source: str, target: str, via: str | None = None, rounds: int = ROUNDS) -> DataFrame:
        """``points`` with ``x``, ``y``, ``z`` in the target space; null where a field on the way doesn't reach."""
        held = {a: F.col(a).cast("double") for a in AXES}
        row = F.struct(*[F.col(f"`{c}`") for c in points.columns]).alias("_row")
        found = points.select(row, *[F.when(_finite(held.values()), x).alias(f"_{a}") for a, x in held.items()])
        matrix = None
        for kind, what in [*self.path(source, target, via), ("end", None)]:
            if kind.startswith("affine"):
                step = what if kind == "affine" else _inverse(what)
                matrix = step if matrix is None else step @ np.vstack([matrix, [0, 0, 0, 1]])
                continue
            if matrix is not None:
                found, matrix = _moved(found, matrix), None
            if kind == "field":
                found = _forth(found, what)
            elif kind == "field back":
                found = _back(found, what, rounds)
        return found.select(*[F.col(f"_{c}" if c in AXES else f"_row.`{c}`").alias(c) for c in points.columns])
