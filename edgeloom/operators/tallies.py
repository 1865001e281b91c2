"""Points counted by key in each mesh, without a row for each point and mesh that leaves its task.

The result has about as many rows as there are points times meshes that hold them, so rows of the two are never shuffled to
be grouped.  Points are sorted by key and packed into blocks, meshes into blocks of whole meshes, and each pair of blocks is
one step of a product: it holds every point of its keys and every triangle of its meshes, so its counts are final.  What is
written and shuffled is the points and the triangles, once; blocks bound what a task holds.  Only the keys at either end of
a block, which the next block may hold too, are summed afterwards, so that a key with any number of points is spread.  Meshes
of the same triangles under several names meet points once; their rows get each name on the way out.

Within a pair, the rules are those of :mod:`edgeloom.operators.volumes`: the same crossings, by the same arithmetic.  Where a
triangle crosses a line matters only by its rank among the points' ``x``, so crossings are sorted as whole numbers.  A mesh's
triangles (76 bytes each) are in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from edgeloom.sources.shared import written

#: Points of a block, and triangles after which a block of meshes ends.
POINTS = 2_000_000
TRIANGLES = 50_000
#: Rows that a step of a product holds at once, about.
STEP = 1_000_000
_PARTS = ("lines", "begins", "values", "ranks", "codes", "kinds")


# Functions for executors are made inside others, so that the package need not be installed there.


def _first_rows():
    def first_rows(columns):
        """Which rows of sorted columns differ from the row before; nulls are alike."""
        import numpy as np
        import pyarrow.compute as pc

        first = np.zeros(len(columns[0]), bool)
        first[:1] = True
        for column in columns:
            a, b = column[1:], column[:-1]
            same = pc.or_(pc.fill_null(pc.equal(a, b), False), pc.and_(pc.is_null(a), pc.is_null(b)))
            first[1:] |= ~same.to_numpy(zero_copy_only=False)
        return first

    return first_rows


def _point_packer(keys: list[str]):
    """Sorted points as blocks: keys once, points by line along x and rank of ``x``; keys at the ends of a block stand apart."""
    most, parts, first_rows = POINTS, _PARTS, _first_rows()

    def pack(batches):
        import numpy as np
        import pyarrow as pa

        def packed(columns, first, whole):
            """A row for the points of some keys; ``first`` marks each key's first point."""
            x, y, z, kind = (columns[n].to_numpy() for n in ("x", "y", "z", "kind"))
            values, rank = np.unique(x, return_inverse=True)
            order = np.lexsort((rank, z, y))
            y, z = y[order], z[order]
            begins = np.flatnonzero(np.r_[True, (y[1:] != y[:-1]) | (z[1:] != z[:-1])])
            held = np.stack([y[begins], z[begins]]), np.r_[begins, len(y)], values, rank[order].astype(np.int32), (np.cumsum(first) - 1)[order].astype(np.int32), kind[order].astype(np.int8)
            names = [columns[k].filter(pa.array(first)) for k in keys]
            lists = [pa.ListArray.from_arrays(pa.array([0, len(n)], pa.int32()), n) for n in names]
            return pa.RecordBatch.from_arrays([pa.array([whole]), *lists, *[pa.array([v.tobytes()], pa.binary()) for v in held]], names=["whole", *keys, *parts])

        def blocks(held):
            columns = {n: pa.concat_arrays([b.column(n) for b in held]) for n in held[0].schema.names}
            held.clear()
            first = first_rows([columns[k] for k in keys])
            begins = [*np.flatnonzero(first), len(first)]
            second, last = begins[1], begins[-2]
            for a, b, whole in ((0, second, False), (second, last, True), (max(second, last), len(first), False)):
                if a < b:
                    yield packed({n: v[a:b] for n, v in columns.items()}, first[a:b], whole)

        held, rows = [], 0
        for batch in batches:
            held.append(batch)
            rows += batch.num_rows
            if rows >= most:
                yield from blocks(held)
                rows = 0
        if rows:
            yield from blocks(held)

    return pack


def _mesh_packer():
    """Meshes' names and triangles as blocks of whole meshes."""
    most = TRIANGLES

    def pack(batches):
        import numpy as np
        import pyarrow as pa

        def block(held):
            names, shapes = (pa.concat_arrays([b.column(n) for b in held]) for n in ("meshes", "shape"))
            corners = shapes.flatten().flatten().to_numpy().reshape(-1, 9).T
            of = np.repeat(np.arange(len(shapes), dtype=np.int32), shapes.value_lengths().to_numpy())
            return pa.RecordBatch.from_arrays([pa.ListArray.from_arrays(pa.array([0, len(names)], pa.int32()), names), *[pa.array([v.tobytes()], pa.binary()) for v in (corners, of)]], names=["meshes", "corners", "of"])

        held, rows = [], 0
        for batch in batches:
            held.append(batch)
            rows += len(batch.column("shape").flatten())
            if rows >= most:
                yield block(held)
                held, rows = [], 0
        if rows:
            yield block(held)

    return pack


def _counter(keys: list[str], names: list[str]):
    """Pairs of blocks as ``meshes`` of the same triangles, keys and a count for each kind of point, where any of them is over 0."""
    step = STEP

    def count(batches):
        import numpy as np
        import pyarrow as pa

        def spread(low, high):
            """Each range's number, and the whole numbers of all ranges."""
            n = high - low
            at = np.repeat(np.arange(len(n)), n)
            return at, np.arange(len(at)) + np.repeat(low - (np.cumsum(n) - n), n)

        def cuts(sizes, apart):
            """Ranges of rows whose sizes sum up to a step, about, that begin where ``apart`` says they may."""
            done = np.cumsum(sizes) // step
            begins = np.flatnonzero(apart)
            begins = begins[np.r_[True, np.diff(done[begins]) > 0][: len(begins)]]
            return zip(begins, [*begins, len(sizes)][1:], strict=True)

        def crossings(corners, of, y, z, values):
            """Where meshes' triangles cross lines, a step at a time, as sorted whole numbers of mesh, line and rank from above.

            Lines are met in strips of z, in the order of y.
            """
            ax, ay, az, bx, by, bz, cx, cy, cz = corners
            low_y, high_y, low_z, high_z = np.minimum(np.minimum(ay, by), cy), np.maximum(np.maximum(ay, by), cy), np.minimum(np.minimum(az, bz), cz), np.maximum(np.maximum(az, bz), cz)
            room = 1e-9 * (np.abs(low_y) + np.abs(high_y))
            height = (high_z - low_z).mean() / 4 or 1.0
            strip, which = np.unique(np.floor(z / height), return_inverse=True)
            some_y, rank_y = np.unique(y, return_inverse=True)
            place = which * (len(some_y) + 1) + rank_y
            order = np.argsort(place)
            place = place[order]
            tri, at = spread(np.searchsorted(strip, np.floor(low_z / height)), np.searchsorted(strip, np.floor(high_z / height), "right"))
            at *= len(some_y) + 1
            first = np.searchsorted(place, at + np.searchsorted(some_y, low_y - room)[tri])
            last = np.searchsorted(place, at + np.searchsorted(some_y, high_y + room, "right")[tri])
            sides = []
            for py, pz, qy, qz in ((ay, az, by, bz), (by, bz, cy, cz), (cy, cz, ay, az)):
                # the lower end of a side comes first, whichever triangle it is seen from
                up = pz < qz
                ly, lz, hy, hz = np.where(up, py, qy), np.where(up, pz, qz), np.where(up, qy, py), np.where(up, qz, pz)
                sides.append((ly, lz, hz, hy - ly, hz - lz))
            ux, uy, uz, vx, vy, vz = bx - ax, by - ay, bz - az, cx - ax, cy - ay, cz - az
            nx, ny, nz = uy * vz - uz * vy, uz * vx - ux * vz, ux * vy - uy * vx
            rest = np.zeros(0, np.int64)
            for a, b in cuts(last - first, np.ones(len(tri), bool)):
                t, at = spread(first[a:b], last[a:b])
                t, line = tri[a:b][t], order[at]
                ty, tz = y[line], z[line]
                some = (low_z[t] <= tz) & (tz < high_z[t]) & (nx[t] != 0)
                t, line, ty, tz = t[some], line[some], ty[some], tz[some]
                odd = np.zeros(len(t), bool)
                for ly, lz, hz, dy, dz in sides:
                    lz = lz[t]
                    odd ^= (lz <= tz) & (tz < hz[t]) & ((ty - ly[t]) * dz[t] < dy[t] * (tz - lz))
                t, line, ty, tz = t[odd], line[odd], ty[odd], tz[odd]
                x = ax[t] + (ny[t] * (ay[t] - ty) + nz[t] * (az[t] - tz)) / nx[t]
                rank = len(values) - np.searchsorted(values, x)
                rest = np.concatenate([rest, (of[t].astype(np.int64) * len(y) + line) * (len(values) + 1) + rank])
                rest.sort()
                # the mesh that the next range begins with may go on
                whole = len(rest) if b == len(tri) else np.searchsorted(rest, int(of[tri[b]]) * len(y) * (len(values) + 1))
                yield rest[:whole]
                rest = rest[whole:]

        def held_in(lines, begins, values, ranks, found):
            """Each mesh's number with the first and last of the points that are inside on a line: between crossings, two by two from above."""
            ranks_of = len(values) + 1
            of_line = found // ranks_of
            begin = np.flatnonzero(np.r_[True, of_line[1:] != of_line[:-1]])
            n = np.arange(len(found)) - np.repeat(begin, np.diff(np.r_[begin, len(found)]))
            upper = np.flatnonzero(n % 2 == 0)
            high = len(values) - found[upper] % ranks_of
            after = np.minimum(upper + 1, len(found) - 1)
            low = np.where((upper + 1 < len(found)) & (of_line[after] == of_line[upper]), len(values) - found[after] % ranks_of, 0)
            mesh, line = np.divmod(of_line[upper], lines.shape[1])
            return mesh, line * ranks_of + low, line * ranks_of + high

        def product(row):
            lines, begins, values, ranks, codes, kinds = (np.frombuffer(row[n].as_buffer(), kind) for n, kind in (("lines", "f8"), ("begins", "i8"), ("values", "f8"), ("ranks", "i4"), ("codes", "i4"), ("kinds", "i1")))
            corners, of = np.frombuffer(row["corners"].as_buffer(), "f8").reshape(9, -1), np.frombuffer(row["of"].as_buffer(), "i4")
            lines, meshes, held = lines.reshape(2, -1), row["meshes"].values, [row[k].values for k in keys]
            place = np.repeat(np.arange(lines.shape[1]), np.diff(begins)) * (len(values) + 1) + ranks
            most, cell = lines.shape[1] * (len(values) + 1), codes.astype(np.int64) * len(names) + kinds
            # how many points stand before each place, if there are few places
            before = np.r_[0, np.cumsum(np.bincount(place, minlength=most), dtype=np.int32)] if most <= 4 * len(place) else None
            alone = (np.bincount(codes, minlength=len(held[0])) == 1)[codes]
            for found in crossings(corners, of, *lines, values):
                if not len(found):
                    continue
                mesh, *ends = held_in(lines, begins, values, ranks, found)
                low, high = (np.searchsorted(place, e) if before is None else before[e] for e in ends)
                some = low < high
                mesh, low, high = mesh[some], low[some], high[some]
                for a, b in cuts(high - low, np.r_[True, mesh[1:] != mesh[:-1]][: len(mesh)]):
                    at, point = spread(low[a:b], high[a:b])
                    of_mesh = mesh[a:b][at]
                    key = (of_mesh - mesh[a]) * (len(held[0]) * len(names)) + cell[point]
                    single = alone[point]
                    yield from tallied(key[single], None, mesh[a], meshes, held)
                    key = key[~single]
                    key = np.sort(key.astype(np.int32) if len(key) and key.max() < 2**31 else key)
                    begin = np.flatnonzero(np.r_[True, key[1:] != key[:-1]][: len(key)])
                    yield from tallied(key[begin].astype(np.int64), np.diff(np.r_[begin, len(key)]), mesh[a], meshes, held)

        def tallied(key, n, mesh, meshes, held):
            """Rows for sorted or single cells of mesh, key and kind, and how many points each has."""
            if not len(key):
                return
            pair, kind = np.divmod(key, len(names))
            begin = np.r_[True, pair[1:] != pair[:-1]]
            counts = np.zeros((len(names), begin.sum()), np.int64)
            counts[kind, np.cumsum(begin) - 1] = 1 if n is None else n
            of_mesh, of_key = np.divmod(pair[begin], len(held[0]))
            rows = max(1, step // int(meshes.value_lengths().to_numpy().max()))
            for i in range(0, len(of_mesh), rows):
                some = slice(i, i + rows)
                yield pa.RecordBatch.from_arrays([meshes.take(pa.array(of_mesh[some] + mesh)), *[k.take(pa.array(of_key[some])) for k in held], *map(pa.array, counts[:, some])], names=["meshes", *keys, *names])

        for batch in batches:
            for i in range(batch.num_rows):
                yield from product({n: batch.column(n)[i] for n in batch.schema.names})

    return count


def counted(points: DataFrame, meshes: DataFrame, kinds: tuple[str, ...]) -> DataFrame:
    """``mesh``, the points' keys and a column for each of ``kinds``: the points of that kind inside, where there are any.

    ``points`` have finite doubles ``x``, ``y``, ``z``, the number of their ``kind``, and keys that are all other columns;
    ``meshes`` are triangles with finite doubles for corners.
    """
    spark = points.sparkSession
    keys, names = [f"key_{i}" for i in range(len(points.columns) - 4)], [f"n_{i}" for i in range(len(kinds))]
    called = [n for n in points.columns if n not in ("x", "y", "z", "kind")]
    corners = [n for n in meshes.columns if n != "mesh"]
    at_once = spark.sparkContext.defaultParallelism
    held = points.select(*[F.col(f"`{n}`").alias(k) for n, k in zip(called, keys, strict=True)], "x", "y", "z", F.col("kind").cast("int").alias("kind"))
    fields = [T.StructField(k, T.ArrayType(held.schema[k].dataType)) for k in keys]
    binary = lambda some: [T.StructField(n, T.BinaryType()) for n in some]
    blocks = held.repartitionByRange(max(held.count() // POINTS + 1, at_once), *keys, "x", "y", "z").sortWithinPartitions(*keys)
    blocks = written(blocks.mapInArrow(_point_packer(keys), T.StructType([T.StructField("whole", T.BooleanType()), *fields, *binary(_PARTS)])), "blocks-of-points")
    kind = T.ArrayType(meshes.schema["mesh"].dataType)
    shapes = meshes.groupBy("mesh").agg(F.sort_array(F.collect_list(F.array(*corners))).alias("shape")).repartition(max(meshes.count() // TRIANGLES + 1, at_once), "shape")
    shapes = shapes.groupBy("shape").agg(F.collect_list(F.struct("mesh")).alias("same")).select(F.col("same.mesh").alias("meshes"), "shape")
    solids = written(shapes.mapInArrow(_mesh_packer(), T.StructType([T.StructField("meshes", T.ArrayType(kind)), *binary(("corners", "of"))])), "blocks-of-meshes")
    schema = T.StructType([T.StructField("meshes", kind), *[T.StructField(k, held.schema[k].dataType) for k in keys], *[T.StructField(n, T.LongType()) for n in names]])
    # without the hint, a small side would be broadcast and only blocks of the other be dealt to tasks
    product = lambda some: blocks.filter(some).hint("shuffle_replicate_nl").crossJoin(solids).mapInArrow(_counter(keys, names), schema)
    parts = product("NOT whole").groupBy("meshes", *keys).agg(*[F.sum(n).alias(n) for n in names])
    return product("whole").union(parts).select(F.explode("meshes"), *keys, *names).toDF("mesh", *called, *kinds)
