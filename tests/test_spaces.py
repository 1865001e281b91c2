"""Coordinate spaces against numpy."""

import itertools
import math
import random

import numpy as np
import pytest

from edgeloom.operators import spaces

POINTS = "n int, x double, y double, z double, _x string"
SCALE = [[0.5, 0, 0, 1], [0, 2, 0, -3], [0, 0, 1, 0.25]]
TURN = [[0, -1, 0, 5], [1, 0, 0, 0], [0.1, 0, 1, 0]]


def points(spark, n=200, seed=1, span=8.0):
    rng = random.Random(seed)
    rows = [(i, *[rng.uniform(0, span) for _ in range(3)], "kept") for i in range(n)]
    return rows, spark.createDataFrame(rows, POINTS)


def coordinates(df):
    return {r["n"]: (r["x"], r["y"], r["z"]) for r in df.collect()}


def near(found, want, within=1e-9):
    assert found.keys() == want.keys()
    for n, p in want.items():
        if p is None:
            assert found[n] == (None, None, None), (n, found[n])
        else:
            assert max(abs(a - b) for a, b in zip(found[n], p, strict=True)) <= within, (n, found[n], p)


def nodes(spark, size=(5, 5, 5), seed=3, strength=0.4, leave=()):
    rng = random.Random(seed)
    held = {k: [rng.uniform(-strength, strength) for _ in range(3)] for k in itertools.product(*map(range, size))}
    return held, spark.createDataFrame([(*k, *map(float, d)) for k, d in held.items() if k not in leave], "i int, j int, k int, dx double, dy double, dz double")


def plain_field(held, p, origin=(0, 0, 0), spacing=(2, 2, 2), size=(5, 5, 5), leave=()):
    u = [(x - o) / s for x, o, s in zip(p, origin, spacing, strict=True)]
    if not all(0 <= a <= n - 1 for a, n in zip(u, size, strict=True)):
        return None
    cell = [min(int(a), n - 2) for a, n in zip(u, size, strict=True)]
    total = np.zeros(3)
    for k in itertools.product((0, 1), repeat=3):
        at = tuple(c + o for c, o in zip(cell, k, strict=True))
        if at in leave:
            return None
        total += np.array(held[at]) * np.prod([a - c if o else 1 - a + c for a, c, o in zip(u, cell, k, strict=True)])
    return tuple(np.array(p) + total)


def test_identity_inverse_and_two_affine_steps(spark):
    rows, df = points(spark)
    s = spaces.Spaces().affine("A", "B", SCALE).affine("B", "C", TURN)
    whole = lambda m, p: np.array(m)[:, :3] @ p + np.array(m)[:, 3]
    want = {i: tuple(whole(TURN, whole(SCALE, np.array(p)))) for i, *p, _ in rows}
    near(coordinates(s.transform(df, "A", "A")), {i: tuple(p) for i, *p, _ in rows}, 0)
    near(coordinates(s.transform(df, "A", "C")), want)
    near(coordinates(s.transform(s.transform(df, "A", "C"), "C", "A")), {i: tuple(p) for i, *p, _ in rows}, 1e-6)
    back = s.transform(df, "A", "C")
    assert back.columns == df.columns and {r["_x"] for r in back.collect()} == {"kept"}


def test_fields_interpolate_and_end_at_their_border(spark):
    leave = {(4, 4, 4)}
    held, df = nodes(spark, leave=leave)
    rows, _ = points(spark, span=8.6)
    rows += [(900 + n, *map(float, p), "kept") for n, p in enumerate(itertools.product((0, 8, 4.0), repeat=3))] + [(990, None, 1.0, 1.0, "kept"), (991, math.nan, 1.0, 1.0, "kept"), (992, math.inf, 1.0, 1.0, "kept"), (993, -0.001, 1.0, 1.0, "kept")]
    s = spaces.Spaces().displacement("A", "B", spaces.field_of(df.union(df), (0, 0, 0), (2, 2, 2)))
    want = {i: plain_field(held, p, leave=leave) if all(x is not None and math.isfinite(x) for x in p) else None for i, *p, _ in rows}
    assert None in want.values()
    near(coordinates(s.transform(spark.createDataFrame(rows, POINTS), "A", "B")), want)


def test_a_field_there_and_back(spark):
    held, df = nodes(spark, strength=0.15)
    rng = random.Random(7)
    rows = [(i, *[rng.uniform(1, 7) for _ in range(3)], "kept") for i in range(60)]
    s = spaces.Spaces().affine("O", "A", [[1, 0, 0, 0.5], [0, 1, 0, 0], [0, 0, 1, 0]]).displacement("A", "B", spaces.field_of(df, (0, 0, 0), (2, 2, 2)))
    there = s.transform(spark.createDataFrame(rows, POINTS), "O", "B")
    near(coordinates(s.transform(there, "B", "O")), {i: tuple(p) for i, *p, _ in rows}, 1e-6)


def test_paths_are_the_cheapest_and_go_through_what_is_asked(spark):
    held, df = nodes(spark, (2, 2, 2))
    f = spaces.field_of(df, (0, 0, 0), (1, 1, 1))
    s = spaces.Spaces().displacement("A", "D", f).affine("A", "B", SCALE).affine("B", "C", SCALE).displacement("C", "D", f)
    assert [k for k, _ in s.path("A", "C")] == ["affine", "affine"]
    assert [k for k, _ in s.path("A", "D")] == ["field"]
    assert [k for k, _ in s.path("D", "A")] == ["field back"]
    assert [k for k, _ in s.path("A", "D", via="C")] == ["affine", "affine", "field"]
    assert s.path("A", "A") == []
    with pytest.raises(ValueError, match="no path"):
        s.path("A", "Z")
    with pytest.raises(ValueError, match="turned round"):
        spaces.Spaces().affine("A", "B", [[1, 0, 0, 0], [2, 0, 0, 0], [0, 0, 1, 0]]).transform(points(spark)[1], "B", "A")
    with pytest.raises(ValueError, match="three rows"):
        s.affine("A", "E", [[1, 0, 0, 0]])


def test_an_empty_field_and_no_points(spark):
    held, df = nodes(spark, (2, 2, 2))
    none = spaces.Spaces().displacement("A", "B", spaces.field_of(df.limit(0), (0, 0, 0), (1, 1, 1)))
    rows, held = points(spark, 5)
    near(coordinates(none.transform(held, "A", "B")), {i: None for i in range(5)})
    assert none.transform(held.limit(0), "A", "B").collect() == []


def test_cells_are_put_together_in_pieces(spark, monkeypatch):
    from edgeloom.operators import spaces

    nodes = spark.range(4 * 4 * 4).selectExpr("id % 4 AS i", "id div 4 % 4 AS j", "id div 16 AS k", "id * 0.5 AS dx", "id * 0.25 AS dy", "-id AS dz")
    whole = spaces.field_of(nodes, (0, 0, 0), (1, 1, 1))
    monkeypatch.setattr(spaces, "PIECE_ROWS", 64)
    dealt, old = [], type(nodes).repartition
    monkeypatch.setattr(type(nodes), "repartition", lambda self, n, *c: dealt.append(n) or old(self, n, *c))
    pieces = spaces.field_of(nodes, (0, 0, 0), (1, 1, 1))
    assert dealt == [9] and pieces.most == whole.most == (3, 3, 3)
    assert sorted(map(repr, pieces.cells.collect())) == sorted(map(repr, whole.cells.collect())) and pieces.cells.count() == 27
