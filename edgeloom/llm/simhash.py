"""SimHash near-duplicates: fingerprints in 64 bits, compared exactly in tiles.

Fingerprints are deduplicated first, so a group of exact copies of any size is one fingerprint.  A tile holds
distinct fingerprints with the same population counts in their four 16-bit parts.  Two fingerprints that differ
in at most ``radius`` bits have counts that differ by at most ``radius`` in sum, so a tile meets only the tiles
within that distance; every other tile pair is skipped without loss.  Within a tile pair all fingerprints are
compared with numpy's exclusive-or and bit counts.  Of the links found there a spanning forest leaves the task,
so that a group never emits all its pairs.  Components come from alternating star contractions over tables in the
shared folder.

Defined cases: null text and text without words have fingerprint zero; with fewer words than a shingle has,
the whole sequence is the one shingle; repeated rows each get a result row; rows with null ids are linked like any
other but never name a component (a component of null ids only has a null id); extra columns are ignored.

:func:`similar` is for near copies in the sense of a Jaccard similarity of five-word shingles: texts whose sets share a key
meet in groups, in which four fingerprints a text find candidates in a radius wide enough for 0.8, and exact similarities
decide.
"""

from __future__ import annotations

from itertools import product

import numpy as np
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from edgeloom.llm.common import forget, map_batches, written

SEED = 42
PARTS = 4
TILE_ROWS = 2048
_SHIFT = 6  # bits per part in a tile key; room for a part's count (0..16) moved by the radius either way


def text_fingerprint(text: str | None, shingle: int = 3, seed: int = SEED) -> int:
    """The unsigned fingerprint of one text."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    digest = xxhash.xxh64_intdigest
    if len(words) < shingle:
        return digest(b" ".join(words), seed)
    counts, block, n = np.zeros(64, dtype=np.int64), 1 << 16, len(words) - shingle + 1
    for at in range(0, n, block):
        part = words[at : min(at + block, n) + shingle - 1]
        hashes = np.array([digest(s, seed) for s in map(b" ".join, zip(*(part[k:] for k in range(shingle)), strict=False))], dtype="<u8")
        counts += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * counts > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = 3, seed: int = SEED) -> DataFrame:
    """``doc_id``, ``text_key`` (a hash of the text) and ``fp`` (the fingerprint's bits as a long) of each row of ``docs``."""

    def scan(batches):
        import pyarrow as pa

        for batch in batches:
            fps = np.fromiter((text_fingerprint(t, shingle, seed) for t in (x.as_py() for x in batch.column(1))), dtype="<u8", count=batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(fps.view("<i8"))], names=["doc_id", "text_key", "fp"])

    id_type = docs.schema["doc_id"].dataType.simpleString()
    return map_batches(docs.select("doc_id", "text", F.xxhash64("text").alias("text_key")), scan, f"doc_id {id_type}, text_key long, fp long")


def _near_keys(radius: int) -> list[int]:
    """Differences of tile keys within the radius, one of each pair of opposite ones."""
    steps = [d for d in product(range(-radius, radius + 1), repeat=PARTS) if sum(map(abs, d)) <= radius and d >= (0,) * PARTS]
    return [sum(x << (_SHIFT * i) for i, x in enumerate(d)) for d in steps]


def _forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links with the same components as the links (a[i], b[i]): each node to the least node it reaches."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    left, right = at[: len(a)], at[len(a) :]
    label = np.arange(len(nodes))
    while True:
        least = np.minimum(label[left], label[right])
        new = label.copy()
        np.minimum.at(new, left, least)
        np.minimum.at(new, right, least)
        new = new[new]
        if (new == label).all():
            break
        label = new
    moved = np.flatnonzero(label != np.arange(len(nodes)))
    return nodes[moved], nodes[label[moved]]


def tile_links(a: np.ndarray, b: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Fingerprints of tile ``a`` and of tile ``b`` within the radius, as a spanning forest of their links."""
    found, bits_a, bits_b = [], a.view(np.uint64), b.view(np.uint64)  # of a signed number, the absolute value's bits would count
    for at in range(0, len(a), 512):
        x, y = np.nonzero(np.bitwise_count(bits_a[at : at + 512, None] ^ bits_b[None, :]) <= radius)
        u, v = a[at + x], b[y]
        keep = u != v
        found.append((u[keep], v[keep]))
    u, v = (np.concatenate(x) for x in zip(*found, strict=True))
    return _forest(u, v) if len(u) > len(a) + len(b) else (u, v)


def links(distinct: DataFrame, radius: int = 3, tile_rows: int = TILE_ROWS) -> DataFrame:
    """Links ``u < v`` between distinct fingerprints (column ``fp``), with the components of all links within ``radius``."""
    part = [F.bit_count(F.shiftrightunsigned("fp", 16 * i).bitwiseAND(F.lit(0xFFFF))).cast("long") for i in range(PARTS)]
    keyed = distinct.select("fp", sum((F.shiftleft(p + radius, _SHIFT * i) for i, p in enumerate(part)), F.lit(0).cast("long")).alias("tile"))
    # at most 17 ** 4 tile keys exist, whatever the data, so their counts may be broadcast
    counts = keyed.groupBy("tile").agg(F.ceil(F.count(F.lit(1)) / tile_rows).alias("subs"))
    counts = written(counts, "simhash-counts")
    tiles = (
        keyed.join(F.broadcast(counts), "tile")
        .withColumn("sub", F.pmod(F.xxhash64("fp"), F.col("subs")))
        .groupBy("tile", "sub")
        .agg(F.collect_list("fp").alias("fps"))
    )
    tiles = written(tiles, "simhash-tiles")
    left = tiles.select("tile", F.col("sub").alias("sub_a"), F.col("fps").alias("a"))
    near = F.array(*[F.lit(k).cast("long") for k in _near_keys(radius)])
    # a tile goes only to neighbours that exist, once for each of their parts: no key holds more than one part's pairs
    sent = tiles.select(F.col("sub").alias("sub_b"), F.col("fps").alias("b"), F.explode(near).alias("step"), "tile").withColumn("tile", F.col("tile") + F.col("step"))
    sent = sent.join(F.broadcast(counts), "tile").select("tile", "sub_b", "b", "step", F.explode(F.sequence(F.lit(0).cast("long"), F.col("subs") - 1)).alias("sub_a"))
    right = sent.filter((F.col("step") != 0) | (F.col("sub_a") <= F.col("sub_b")))
    pairs = left.join(right, ["tile", "sub_a"]).select("a", "b")

    def compare(batches):
        import pyarrow as pa

        for batch in batches:
            us, vs = [], []
            for a, b in zip(batch.column(0), batch.column(1), strict=True):
                u, v = tile_links(a.values.to_numpy(zero_copy_only=False), b.values.to_numpy(zero_copy_only=False), radius)
                us.append(np.minimum(u, v))
                vs.append(np.maximum(u, v))
            if us:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(us)), pa.array(np.concatenate(vs))], names=["u", "v"])

    return map_batches(pairs, compare, "u long, v long")


def connected(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """``node`` and ``root`` (the least node reachable) of every node of ``edges`` (``u``, ``v``).

    Large-star and small-star rounds, each a table in the shared folder, until the edges stay the same; an error after ``rounds`` without that.
    """
    edges = written(edges.filter("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "links")
    sign, before = [F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))], None
    for _ in range(rounds):
        now = tuple(edges.agg(*sign).first())
        if now == before or not now[0]:
            break
        before = now
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u != v").distinct()
        large = written(large, "large-star")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u != v").union(least.select("u", F.col("m").alias("v")))
        old, edges = edges, written(small.distinct(), "small-star")
        forget(old, large)
    else:
        raise RuntimeError(f"the components are not complete after {rounds} rounds")
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))


def components(docs: DataFrame, shingle: int = 3, radius: int = 3, seed: int = SEED) -> DataFrame:
    """``doc_id``, ``text_key``, ``fp``, ``root`` and ``component_id`` of each row.

    ``root`` is the same within a component; ``component_id`` is the smallest id reachable over links, its own included.
    """
    fps = written(fingerprints(docs, shingle, seed), "fingerprints")
    distinct = written(fps.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "distinct-fingerprints")
    roots = connected(links(distinct.select("fp"), radius))
    named = distinct.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select("fp", "first_id", F.coalesce("root", "fp").alias("root"))
    named = written(named, "roots")
    named = named.join(named.groupBy("root").agg(F.min("first_id").alias("component_id")), "root").select("fp", "root", "component_id")
    return fps.join(named, "fp").select("doc_id", "text_key", "fp", "root", "component_id")


def keep_one(docs: DataFrame, shingle: int = 3, radius: int = 3) -> DataFrame:
    """``docs`` with one row of each component: the one with the smallest id, null ids last, then by the text's hash."""
    return _first_of_each(docs, components(docs, shingle, radius))


def _row_keys(doc_id, text_key) -> list:
    """Columns ``row_id`` and ``row_key`` that are equal just where ids (null is an id) and text hashes are."""
    return [F.concat(F.when(doc_id.isNull(), "none").otherwise("id "), F.coalesce(doc_id.cast("string"), F.lit(""))).alias("row_id"), text_key.alias("row_key")]


def _first_of_each(docs: DataFrame, marked: DataFrame) -> DataFrame:
    """The row of ``docs`` with the smallest id, then text hash, of each ``root`` of ``marked``; of rows equal in both, one."""
    first = marked.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_key")).alias("first"))
    keys = first.select(*_row_keys(F.col("first.doc_id"), F.col("first.text_key")))
    held = docs.select(*_row_keys(F.col("doc_id"), F.xxhash64("text")), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    # both steps are on the same keys, so texts are shuffled once
    return held.join(keys, ["row_id", "row_key"], "left_semi").groupBy("row_id", "row_key").agg(F.first("row").alias("row")).select("row.*")


#: Bits in which wide fingerprints of texts with a Jaccard similarity of 0.8 may differ: 39 of 256 are expected, 48 for sets
#: of four or five shingles, with a deviation of about six.
WIDE_RADIUS = 75
_WIDE_HALF = 48  # the same for the first 128 bits: 19 to 24 expected, with a deviation of about four
WIDE_TILE_ROWS = 16_384
#: Least hashes of a shingle set in a key, and keys: of 10 million pairs at 0.8 about one has no key in common.
KEY_HASHES, KEYS = 5, 40
#: Shingles of the texts that one verification holds on either side, about; each text counts as 200 more.
VERIFIED_SHINGLES = 200_000
_MIXES = [np.uint64(k) for k in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93)]


def shingle_set(text: str | None, shingle: int = 5, seed: int = SEED) -> np.ndarray:
    """The sorted distinct 64-bit hashes of a text's shingles; none without words."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    spelled = map(b" ".join, zip(*(words[k:] for k in range(shingle)), strict=False)) if len(words) >= shingle else [b" ".join(words)]
    digest = xxhash.xxh64_intdigest
    return np.array(sorted({digest(s, seed) for s in spelled}), np.uint64)


def wide_fingerprint(hashes: np.ndarray) -> np.ndarray:
    """Four fingerprints of 64 bits of a shingle set, each over its own mix of the hashes."""
    words = np.zeros(4, np.uint64)
    for k, mix in enumerate(_MIXES if len(hashes) else []):
        counts = np.zeros(64, np.int64)
        for at in range(0, len(hashes), 1 << 16):
            h = (hashes[at : at + (1 << 16)] ^ mix) * np.uint64(0xBF58476D1CE4E5B9)
            h = (h ^ (h >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
            h ^= h >> np.uint64(32)
            counts += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
        words[k] = np.packbits(2 * counts > len(hashes), bitorder="little").view("<u8")[0]
    return words


def set_keys(hashes: np.ndarray) -> np.ndarray:
    """``KEYS`` numbers; two sets share each with the probability of their similarity to the power of ``KEY_HASHES``."""
    n = KEYS * KEY_HASHES
    factors = (np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)
    least = np.full(n, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(hashes), 1024):
        mixed = hashes[at : at + 1024, None] * factors
        mixed ^= mixed >> np.uint64(32)
        mixed *= np.uint64(0xD6E8FEB86659FD93)
        np.minimum(least, mixed.min(0), out=least)
    keys = np.zeros(KEYS, np.uint64)
    for part in least.reshape(KEYS, KEY_HASHES).T:
        keys = (keys ^ part) * np.uint64(0xBF58476D1CE4E5B9)
        keys ^= keys >> np.uint64(31)
    return keys ^ np.arange(KEYS, dtype=np.uint64) * np.uint64(0x94D049BB133111EB)


def _merged(label: np.ndarray, p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Labels of places (the least place of each component) after the links (p[i], q[i])."""
    while True:
        left, right = label[p], label[q]
        least = np.minimum(left, right)
        new = label.copy()
        np.minimum.at(new, left, least)
        np.minimum.at(new, right, least)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def wide_links(a: np.ndarray, b: np.ndarray, radius: int = WIDE_RADIUS) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of the links between rows of ``a`` and of ``b`` (a node and four words each) within the radius.

    Pairs are looked at a strip at a time, and those whose ends are joined already are dropped there: no more than a strip's
    pairs are held, however many near copies a group has.
    """
    nodes, at = np.unique(np.concatenate([a[:, 0], b[:, 0]]), return_inverse=True)
    in_a, in_b, label = at[: len(a)], at[len(a) :], np.arange(len(nodes))
    words_a, words_b = (np.ascontiguousarray(x[:, 1:]).view(np.uint64) for x in (a, b))
    b0, b1 = np.ascontiguousarray(words_b[:, 0]), np.ascontiguousarray(words_b[:, 1])
    step = max(1, (1 << 18) // max(1, len(b)))
    for k in range(0, len(a), step):
        part, places = words_a[k : k + step], in_a[k : k + step]
        half = np.bitwise_count(part[:, :1] ^ b0) + np.bitwise_count(part[:, 1:2] ^ b1)
        x, y = np.nonzero(half <= _WIDE_HALF)
        apart = label[places[x]] != label[in_b[y]]
        x, y = x[apart], y[apart]
        near = np.bitwise_count(part[x] ^ words_b[y]).sum(1, dtype=np.int64) <= radius
        if near.any():
            label = _merged(label, places[x[near]], in_b[y[near]])
    moved = np.flatnonzero(label != np.arange(len(nodes)))
    return nodes[label[moved]], nodes[moved]


def similar_links(sets: list[np.ndarray], similarity: float) -> list[tuple[int, int]]:
    """Pairs of the sets with the components of all pairs of at least this Jaccard similarity: a spanning forest."""
    root, found = list(range(len(sets))), []

    def top(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    order = sorted(range(len(sets)), key=lambda i: len(sets[i]))
    for p, i in enumerate(order):
        for j in order[p + 1 :]:
            n, m = len(sets[i]), len(sets[j])
            if n < similarity * m:
                break  # the sets after j are larger still
            if top(i) == top(j):
                continue
            both = n + m - len(np.union1d(sets[i], sets[j]))
            if both >= similarity * (n + m - both) - 1e-9:
                root[top(j)] = top(i)
                found.append((i, j))
        if len(found) == len(sets) - 1:
            break
    return found


def _set_rows(docs: DataFrame, shingle: int) -> DataFrame:
    """doc_id, text_key, node (a hash of the shingle set), n (its size), f0 to f3 and keys of each row."""

    def scan(batches):
        import pyarrow as pa

        for batch in batches:
            nodes, sizes, words, keys = [], [], np.zeros((batch.num_rows, 4), np.uint64), np.zeros((batch.num_rows, KEYS), np.uint64)
            for i, text in enumerate(batch.column(1)):
                hashes = shingle_set(text.as_py(), shingle)
                nodes.append(xxhash.xxh64_intdigest(hashes.tobytes(), SEED))
                sizes.append(len(hashes))
                words[i], keys[i] = wide_fingerprint(hashes), set_keys(hashes)
            columns = [np.array(nodes, np.uint64).view(np.int64), np.array(sizes, np.int64), *(np.ascontiguousarray(words[:, k]).view(np.int64) for k in range(4))]
            lists = pa.ListArray.from_arrays(np.arange(0, batch.num_rows * KEYS + 1, KEYS, dtype=np.int32), pa.array(keys.view(np.int64).ravel()))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), *map(pa.array, columns), lists], names=["doc_id", "text_key", "node", "n", "f0", "f1", "f2", "f3", "keys"])

    id_type = docs.schema["doc_id"].dataType.simpleString()
    return map_batches(docs.select("doc_id", "text", F.xxhash64("text").alias("text_key")), scan, f"doc_id {id_type}, text_key long, node long, n long, f0 long, f1 long, f2 long, f3 long, keys array<bigint>")


def _with_roots(roots: DataFrame) -> DataFrame:
    """``node`` and ``root`` of all nodes that have links, roots included."""
    return roots.union(roots.select(F.col("root").alias("node"), "root")).distinct()


def _groups_by_keys(nodes: DataFrame) -> DataFrame:
    """Links ``u``, ``v`` from each node to the least one that shares a key with it."""
    keyed = nodes.select("node", F.explode("keys").alias("key"))
    least = keyed.groupBy("key").agg(F.min("node").alias("v"), F.max("node").alias("most")).filter("v != most").select("key", "v")
    return keyed.join(least, "key").select(F.col("node").alias("u"), "v")


def _paired(placed: DataFrame, held: str) -> DataFrame:
    """The values of ``held`` of each pair of blocks of a root (i <= j), as one list; ``placed`` has root, block and blocks."""
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("other")
    pairs = placed.select("root", "block", held, other).select("root", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), held)
    return pairs.groupBy("root", "i", "j").agg(F.collect_list(held).alias(held)).select(held)


def _candidate_links(nodes: DataFrame, members: DataFrame, tile_rows: int) -> DataFrame:
    """Links ``u < v`` with the components of all links within the wide radius, inside the groups of ``members`` (node, root).

    A group is cut into tiles, and every two of its tiles are compared.
    """
    held = members.join(nodes.select("node", "f0", "f1", "f2", "f3"), "node")
    blocks = held.groupBy("root").agg(F.ceil(F.count(F.lit(1)) / tile_rows).cast("long").alias("blocks"))
    placed = held.join(blocks, "root").withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")))
    tiles = placed.groupBy("root", "block", "blocks").agg(F.flatten(F.collect_list(F.array("node", "f0", "f1", "f2", "f3"))).alias("rows"))
    pairs = _paired(written(tiles, "wide-tiles"), "rows")

    def compare(batches):
        import pyarrow as pa

        for batch in batches:
            us, vs = [], []
            for sides in batch.column(0):
                sides = [x.values.to_numpy(zero_copy_only=False).reshape(-1, 5) for x in sides.values]
                u, v = wide_links(sides[0], sides[-1])
                us.append(u)
                vs.append(v)
            if us:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(us)), pa.array(np.concatenate(vs))], names=["u", "v"])

    return map_batches(pairs, compare, "u long, v long")


def _verified_links(docs: DataFrame, nodes: DataFrame, members: DataFrame, shingle: int, similarity: float, most: int) -> DataFrame:
    """Links with the components of all pairs of at least this similarity, within the groups of ``members`` (node, root)."""
    held = members.join(nodes, "node").select("node", "root", "n", "text_key")
    blocks = held.groupBy("root").agg(F.ceil(F.sum(F.col("n") + 200) / most).cast("long").alias("blocks"))
    wanted = held.join(blocks, "root").select("text_key", "root", "node", F.greatest("blocks", F.lit(1)).alias("blocks"))
    # copies of a text are one before the shuffle
    texts = docs.groupBy(F.xxhash64("text").alias("text_key")).agg(F.first("text").alias("text"))
    placed = texts.join(wanted, "text_key").select("root", "node", "blocks", "text")

    def spell(batches):
        import pyarrow as pa

        for batch in batches:
            sets = pa.array([shingle_set(t.as_py(), shingle).tobytes() for t in batch.column(3)], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), batch.column(2), sets], names=["root", "node", "blocks", "hashes"])

    spelled = map_batches(placed, spell, "root long, node long, blocks long, hashes binary")
    pairs = _paired(spelled.select("root", "blocks", F.pmod(F.xxhash64("node"), F.col("blocks")).alias("block"), F.struct("node", "hashes").alias("held")), "held")

    def verify(batches):
        import pyarrow as pa

        for batch in batches:
            us, vs = [], []
            for held in batch.column(0):
                rows = held.as_py()
                sets = [np.frombuffer(r["hashes"], np.uint64) for r in rows]
                for i, j in similar_links(sets, similarity):
                    us.append(min(rows[i]["node"], rows[j]["node"]))
                    vs.append(max(rows[i]["node"], rows[j]["node"]))
            yield pa.RecordBatch.from_arrays([pa.array(us, pa.int64()), pa.array(vs, pa.int64())], names=["u", "v"])

    return map_batches(pairs, verify, "u long, v long")


def similar(docs: DataFrame, shingle: int = 5, similarity: float = 0.8, tile_rows: int = WIDE_TILE_ROWS, most: int = VERIFIED_SHINGLES) -> DataFrame:
    """``doc_id``, ``text_key`` and ``root`` of each row: the same root where a chain of texts of at least this Jaccard similarity links them.

    Texts meet in groups of sets that share a key, which grow with the copies and not with the square of all texts; in a
    group, fingerprints are compared in tiles, candidates being the pairs within ``WIDE_RADIUS`` bits of 256; exact
    similarities of their shingle sets decide.  Texts without words are alike; with fewer words than a shingle has, the
    whole sequence is the one shingle.
    """
    if similarity < 0.8:
        raise ValueError("the radius is made for similarities of at least 0.8")
    rows = written(_set_rows(docs, shingle), "shingle-sets")
    nodes = rows.groupBy("node").agg(F.min("text_key").alias("text_key"), *[F.first(c).alias(c) for c in ("n", "f0", "f1", "f2", "f3", "keys")])
    nodes = written(nodes, "distinct-sets")
    members = written(_with_roots(connected(_groups_by_keys(nodes))), "groups")
    near = written(_with_roots(connected(_candidate_links(nodes, members, tile_rows))), "near-members")
    roots = connected(_verified_links(docs, nodes.select("node", "n", "text_key"), near, shingle, similarity, most))
    # the keys, most of these tables' bytes, have done their work
    whole, rows = rows, written(rows.select("doc_id", "text_key", "node"), "nodes")
    forget(whole, nodes, members, near)
    return rows.join(roots, "node", "left").select("doc_id", "text_key", F.coalesce("root", "node").alias("root"))


def keep_one_similar(docs: DataFrame, shingle: int = 5, similarity: float = 0.8) -> DataFrame:
    """``docs`` with one row of each group of :func:`similar`, chosen as :func:`keep_one` does."""
    return _first_of_each(docs, similar(docs, shingle, similarity))
