"""Exact k-means on whole-number vectors by exponion search.

A vector keeps its cluster, an upper bound of the distance to that centroid and a lower bound of the distance to every
other one.  When centroids move, bounds move with them.  A vector whose upper bound stays under its lower bound, or under
half the distance from its centroid to the nearest other one, keeps its cluster unseen.  For the others the bound is made
exact, and if that does not settle it, only centroids are scanned that lie within ``2 * upper + nearest`` of the current
one: the nearest and the second nearest lie in that ball.  The balls are prefixes of lists of centroids sorted by their
distance to each centroid.  Comparisons of bounds are strict and the ball includes its rim, so ties are always seen, and
they go to the smaller number.

Distances that decide are whole numbers and exact; bounds are doubles, widened by more than their rounding.  Each round
is one pass without a shuffle, written to the shared folder; the driver gets one row of sums for each centroid.

Defined cases: a vector is kept if it has exactly ``dims`` components, none null or non-finite; others have no result
row.  Repeated rows each count and each get a row.  A null id counts as the empty text where starting centroids are
chosen; equal ids are told apart by their components.  With fewer vectors than ``k`` each is a centroid; with none there
is no row.  An empty centroid stays where it is.  Components of :func:`limit` or more raise an error, since a
squared distance would not fit 64 bits.  Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from edgeloom.llm.common import forget, map_batches, written

#: Up to this, sums of products are exact in doubles, and matrix products can be used.
_EXACT = 1 << 21
#: Sorted lists hold the square of this many entries (2 x 32 MB), which every task gets.
MOST_CENTROIDS = 2048
_SLACK = 1e-9
_BLOCK = 4096


def limit(dims: int) -> int:
    """Components under this have squared distances that fit 64 bits."""
    return math.isqrt(((1 << 63) - 1) // dims) // 2


class Centroids:
    """Centroids with, for each, all of them in the order of their distance to it."""

    def __init__(self, at: np.ndarray, moved: np.ndarray | None = None):
        self.at, n = at, len(at)
        squared = squared_distances(at, at)
        self.order = np.argsort(squared, axis=1, kind="stable").astype(np.int32)
        self.sorted = np.sqrt(np.take_along_axis(squared, self.order, 1).astype(np.float64))
        # the first of the list is the centroid itself, or one in the same place
        self.nearest = self.sorted[:, 1] if n > 1 else np.full(n, np.inf)
        self.moved = np.zeros(n) if moved is None else moved
        far = np.argsort(-self.moved, kind="stable")
        #: the farthest that any other centroid has moved
        self.others_moved = np.where(np.arange(n) == far[0], self.moved[far[1]] if n > 1 else 0.0, self.moved[far[0]])

    def next(self, at: np.ndarray) -> Centroids:
        step = at - self.at
        return Centroids(at, np.sqrt((step * step).sum(1).astype(np.float64)) * (1 + _SLACK))


def squared_distances(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Exact squared distances of all rows of ``x`` to all of ``c``."""
    if max(np.abs(x).max(initial=0), np.abs(c).max(initial=0)) <= _EXACT and x.shape[1] <= 256:
        a, b = x.astype(np.float64), c.astype(np.float64)
        return ((a * a).sum(1)[:, None] - 2 * (a @ b.T) + (b * b).sum(1)[None, :]).astype(np.int64)
    return np.stack([((x - row) ** 2).sum(1) for row in c], axis=1) if len(c) else np.zeros((len(x), 0), np.int64)


def own_distance(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    step = x - c
    return (step * step).sum(1)


def _two_least(squared: np.ndarray, names: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each row the centroid of the least distance (the smaller name of equal ones), that distance and the next."""
    by_name = np.argsort(names, kind="stable")
    squared = squared[:, by_name]
    first = squared.argmin(1)
    rows = np.arange(len(squared))
    least = squared[rows, first]
    if squared.shape[1] == 1:
        return names[by_name[first]], least, np.full(len(least), np.inf)
    rest = squared.astype(np.float64)
    rest[rows, first] = np.inf
    return names[by_name[first]], least, rest.min(1)


def assign(x: np.ndarray, c: Centroids, cluster: np.ndarray | None = None, upper: np.ndarray | None = None, lower: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """Cluster, upper and lower bound of each row of ``x``, and how many distances were taken; without bounds all are."""
    if cluster is None:
        name, least, second = _two_least(squared_distances(x, c.at), np.arange(len(c.at)))
        return name.astype(np.int32), np.sqrt(least.astype(np.float64)) * (1 + _SLACK), np.sqrt(second) * (1 - _SLACK), x.shape[0] * len(c.at)
    cluster, upper = cluster.copy(), (upper + c.moved[cluster]) * (1 + _SLACK)
    lower = np.maximum(lower - c.others_moved[cluster], 0.0) * (1 - _SLACK)
    safe = np.maximum(lower, c.nearest[cluster] / 2 * (1 - _SLACK))
    open_ = np.flatnonzero(~(upper < safe))
    upper[open_] = np.sqrt(own_distance(x[open_], c.at[cluster[open_]]).astype(np.float64)) * (1 + _SLACK)
    taken = len(open_)
    open_ = open_[~(upper[open_] < safe[open_])]
    if len(c.at) == 1 or not len(open_):
        return cluster, upper, lower, taken
    radius = (2 * upper[open_] + c.nearest[cluster[open_]]) * (1 + _SLACK)
    reach = np.zeros(len(open_), dtype=np.int64)
    for name in np.unique(cluster[open_]):
        of = cluster[open_] == name
        reach[of] = np.searchsorted(c.sorted[name], radius[of], side="right")
    # balls of like size go together: a prefix is scanned to the next power of two
    reach = np.minimum(1 << np.ceil(np.log2(np.maximum(reach, 2))).astype(np.int64), len(c.at))
    groups, group = np.unique(np.stack([cluster[open_], reach], axis=1), axis=0, return_inverse=True)
    for g, (name, size) in enumerate(groups):
        rows = open_[group.ravel() == g]
        scanned = c.order[name, :size]
        new, least, second = _two_least(squared_distances(x[rows], c.at[scanned]), scanned)
        cluster[rows] = new
        upper[rows] = np.sqrt(least.astype(np.float64)) * (1 + _SLACK)
        lower[rows] = np.sqrt(second) * (1 - _SLACK)
        taken += len(rows) * size
    return cluster, upper, lower, taken


def whole_vectors(vectors: DataFrame, dims: int, scale: int, id_name: str = "vec_id", name: str = "embedding") -> DataFrame:
    """``id`` and ``v`` (``floor(scale * x)`` of each component x as double) of the vectors that are kept."""
    kept = vectors.select(F.col(id_name).alias("id"), F.col(name).cast("array<double>").alias("x")).filter(F.size("x") == dims)
    # NaN is greater than any number, and a null makes the answer null
    kept = kept.filter(F.coalesce(F.forall("x", lambda x: x.isNotNull() & (F.abs(x) < float("inf"))), F.lit(False)))
    wide = F.raise_error(F.lit(f"a component times {scale} is {limit(dims)} or more")).cast("int")
    return kept.select("id", F.transform("x", lambda x: F.when(F.abs(x * scale) < limit(dims), F.floor(x * scale).cast("int")).otherwise(wide)).alias("v"))


def _matrix(column) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(column), -1)


def _pass(rows: DataFrame, c: Centroids, id_type: str, first: bool, last: bool) -> DataFrame:
    """One assignment of all rows; the last one gives exact distances instead of bounds."""

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            for at in range(0, batch.num_rows, _BLOCK):
                part = batch.slice(at, _BLOCK)
                x = _matrix(part.column("v"))
                known = () if first else [part.column(n).to_numpy(zero_copy_only=False) for n in ("cluster", "upper", "lower")]
                cluster, upper, lower, _ = assign(x, c, *known)
                own = pa.array(own_distance(x, c.at[cluster])) if last else part.column("v")
                tail = [] if last else [pa.array(upper), pa.array(lower)]
                yield pa.RecordBatch.from_arrays([part.column("id"), own, pa.array(cluster), *tail], names=["id", "distance" if last else "v", "cluster", *([] if last else ["upper", "lower"])])

    return map_batches(rows, run, f"id {id_type}, " + ("distance long, cluster int" if last else "v array<int>, cluster int, upper double, lower double"))


def kmeans(vectors: DataFrame, k: int, rounds: int, dims: int, scale: int = 64, seed: int = 1, id_name: str = "vec_id", name: str = "embedding") -> tuple[DataFrame, np.ndarray]:
    """``id``, ``cluster``, ``distance`` (squared), ``cluster_inertia`` and ``inertia`` (decimals) of each kept vector, and the centroids.

    The ``k`` vectors with the least sha256 of ``seed:id`` start; each round assigns all and moves centroids to the
    floors of their vectors' means; then all are assigned once more.
    """
    if not 0 < k <= MOST_CENTROIDS:
        raise ValueError(f"1 to {MOST_CENTROIDS} centroids")
    rows = whole_vectors(vectors, dims, scale, id_name, name)
    id_type = rows.schema["id"].dataType.simpleString()
    key = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("id").cast("string"), F.lit(""))), 256)
    start = [r["v"] for r in rows.select("v", key.alias("key")).orderBy("key", "v").limit(k).collect()]
    if not start:
        return rows.select("id", *[F.lit(None).cast(t).alias(n) for n, t in (("cluster", "int"), ("distance", "long"), ("cluster_inertia", "decimal(38,0)"), ("inertia", "decimal(38,0)"))]).limit(0), np.zeros((0, dims), np.int64)
    c, held = Centroids(np.array(start, dtype=np.int64)), None
    for at in range(rounds):
        new = written(_pass(rows, c, id_type, first=at == 0, last=False), "assigned")
        if held is not None:
            forget(held)
        held = rows = new
        sums = held.groupBy("cluster").agg(F.count(F.lit(1)).alias("n"), *[F.sum(F.col("v")[i].cast("long")).alias(f"s{i}") for i in range(dims)]).collect()
        means = c.at.copy()
        for row in sums:
            means[row["cluster"]] = [row[f"s{i}"] // row["n"] for i in range(dims)]
        c = c.next(means)
    found = written(_pass(rows, c, id_type, first=rounds == 0, last=True), "distances")
    if held is not None:
        forget(held)
    # a row for each centroid
    sums = found.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).cast("decimal(38,0)").alias("cluster_inertia"))
    sums = sums.withColumn("inertia", F.sum("cluster_inertia").over(Window.partitionBy()).cast("decimal(38,0)"))
    return found.join(F.broadcast(sums), "cluster").select("id", "cluster", "distance", "cluster_inertia", "inertia"), c.at


def digest(centroid: np.ndarray) -> str:
    """sha256 of the components as decimal integers with commas between."""
    return hashlib.sha256(",".join(str(int(x)) for x in centroid).encode()).hexdigest()
