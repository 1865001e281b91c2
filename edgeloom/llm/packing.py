"""Best-fit-decreasing packing of tokenised documents into sequences of at most ``window`` tokens.

Documents are tokenised once.  An overlong one is first cut into full windows; what remains, and every other
document, is a piece of 1 to ``window`` tokens.  Best-fit decreasing only looks at lengths: it takes the pieces
from long to short and puts each into the open sequence with the tightest remaining room.  So the plan is made on
the counts of pieces by length, of which there are at most ``window``: sequences with the same room are one run, a
segment tree indexed by remaining capacity finds the tightest run that fits, and a whole run is filled at a time.
The plan, whose size depends on ``window`` and not on the data, says for the ``rank``-th piece of a length which
sequence and offset it gets.  Ranks of frequent lengths are counted in buckets, so a length that a third of all pieces
share is spread over many tasks; pieces are dealt to buckets by a number of their own, so repeated rows are spread too.

A sequence is padded to ``window`` unless its length is a power of two.

Defined cases: null text is empty; an empty text is the end id alone; repeated rows and null ids are documents like
any other; extra columns are ignored; an empty table gives no pieces.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from edgeloom.llm.common import map_batches, written

#: Pieces of one length in a bucket, about, and buckets beyond one for each length, at most.
BUCKET_ROWS, MOST_BUCKETS = 500, 8192


class CapacityTree:
    """A segment tree over remaining capacities: which have open runs, and the least of them that is large enough."""

    def __init__(self, capacity: int):
        self.leaves = 1 << capacity.bit_length()
        self.open = [0] * (2 * self.leaves)

    def add(self, room: int, runs: int) -> None:
        node = self.leaves + room
        while node:
            self.open[node] += runs
            node >>= 1

    def tightest(self, need: int) -> int | None:
        """The least room >= need with an open run."""
        node = self.leaves + need
        if self.open[node]:
            return need
        while node > 1:
            if node % 2 == 0 and self.open[node + 1]:
                node += 1
                while node < self.leaves:
                    node = 2 * node if self.open[2 * node] else 2 * node + 1
                return node - self.leaves
            node >>= 1
        return None


def plan_lengths(counts: dict[int, int], window: int) -> tuple[list[tuple], int]:
    """The plan for ``counts`` pieces by length, and the number of sequences.

    Rows are (length, rank_from, rank_to, sequence_from, each, offset): the piece of rank r, rank_from <= r <
    rank_to, is the k-th (k = r - rank_from) of them, in sequence ``sequence_from + k // each`` at ``offset + k %
    each * length``.  The result is what placing the pieces one by one by best-fit decreasing gives, up to the names
    of sequences with equal room.
    """
    tree, runs, rows, sequences = CapacityTree(window), {}, [], 0

    def put(first: int, n: int, room: int) -> None:
        if n and room:
            runs.setdefault(room, []).append((first, n))
            tree.add(room, 1)

    for length in sorted((k for k, n in counts.items() if n), reverse=True):
        left, rank = counts[length], 0
        while left:
            room = tree.tightest(length)
            if room is None:
                first, n, room = sequences, -(-left // (window // length)), window
                sequences += n
            else:
                first, n = runs[room].pop()
                tree.add(room, -1)
            each = room // length
            full = min(n, left // each)
            if full:
                rows.append((length, rank, rank + full * each, first, each, window - room))
                put(first, full, room - each * length)
                left, rank = left - full * each, rank + full * each
            if full < n and left:  # fewer than ``each`` remain: the tightest sequence takes them all
                rows.append((length, rank, rank + left, first + full, each, window - room))
                put(first + full, 1, room - left * length)
                full, left = full + 1, 0
            put(first + full, n - full, room)
    return rows, sequences


def pieces(docs: DataFrame, tokenizer_path: str, end_id: int = 1, window: int = 2048, keep_ids: bool = False) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, and with ``keep_ids`` the ids as bytes."""

    def cut(batches):
        import pyarrow as pa

        from edgeloom.llm.tokens import encoder

        enc, end = encoder(tokenizer_path), end_id.to_bytes(4, "little")
        for batch in batches:
            at, start, length, crc, total, kept = [], [], [], [], [], []
            for i, text in enumerate(batch.column(1)):
                data = enc.ids(text.as_py()) + end
                n = len(data) // 4
                for s in range(0, n, window):
                    piece = data[4 * s : 4 * (s + window)]
                    at.append(i)
                    start.append(s)
                    length.append(len(piece) // 4)
                    crc.append(zlib.crc32(piece))
                    total.append(n)
                    if keep_ids:
                        kept.append(piece)
            long = lambda x: pa.array(x, pa.int64())
            columns = [batch.column(0).take(pa.array(at, pa.int32())), long(start), long(length), long(crc), long(total)]
            names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
            yield pa.RecordBatch.from_arrays(columns + [pa.array(kept, pa.binary())] * keep_ids, names=names + ["ids"] * keep_ids)

    id_type = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {id_type}, start long, length long, ids_crc32 long, doc_tokens long" + ", ids binary" * keep_ids
    return map_batches(docs.select("doc_id", "text"), cut, schema)


def pack(docs: DataFrame, tokenizer_path: str, end_id: int = 1, window: int = 2048, keep_ids: bool = False, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """The pieces of ``docs`` with ``sequence_id``, ``offset`` and with ``keep_ids`` the ids."""
    spark = docs.sparkSession
    cut = written(pieces(docs, tokenizer_path, end_id, window, keep_ids).withColumn("spread", F.monotonically_increasing_id()), "pieces")
    counts = {r["length"]: r["n"] for r in cut.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}  # window rows at most
    # only frequent lengths are cut into buckets: window + MOST_BUCKETS rows at most, whatever the data
    each = max(bucket_rows, -(-sum(counts.values()) // MOST_BUCKETS))
    buckets = spark.createDataFrame([(k, -(-n // each)) for k, n in counts.items()], "length long, buckets long")
    salt = F.pmod(F.xxhash64("spread"), F.col("buckets"))
    salted = cut.join(F.broadcast(buckets), "length").withColumn("bucket", salt).drop("buckets")
    sizes = written(salted.groupBy("length", "bucket").agg(F.count(F.lit(1)).alias("n")), "piece-counts")
    rows, _ = plan_lengths(counts, window)
    by_length: dict[int, list[tuple]] = {}
    for row in rows:
        by_length.setdefault(row[0], []).append(row)

    def place(batches):
        import numpy as np
        import pyarrow as pa

        plans = {k: ([r[1] for r in v], v) for k, v in by_length.items()}
        for batch in batches:
            lengths, ranks = (batch.column(batch.schema.get_field_index(n)).to_pylist() for n in ("length", "rank"))
            sequence, offset = np.empty(len(ranks), np.int64), np.empty(len(ranks), np.int64)
            for i, (length, rank) in enumerate(zip(lengths, ranks, strict=True)):
                starts, plan = plans[length]
                _, first, _, seq, each, base = plan[bisect_left(starts, rank + 1) - 1]
                sequence[i], offset[i] = seq + (rank - first) // each, base + (rank - first) % each * length
            keep = [i for i, n in enumerate(batch.schema.names) if n != "rank"]
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in keep), pa.array(sequence), pa.array(offset)], names=[*(batch.schema.names[i] for i in keep), "sequence_id", "offset"])

    order = Window.partitionBy("length", "bucket").orderBy("spread")
    running = F.sum("n").over(Window.partitionBy("length").orderBy("bucket"))
    base = F.broadcast(sizes.select("length", "bucket", (running - F.col("n")).alias("base")))
    ranked = salted.withColumn("nth", F.row_number().over(order) - 1).join(base, ["length", "bucket"]).withColumn("rank", F.col("base") + F.col("nth"))
    names = [c for c in cut.columns if c != "spread"]
    ranked = ranked.select(*names, "rank")
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in ranked.schema if f.name != "rank") + ", sequence_id long, offset long"
    return map_batches(ranked, place, schema)


def sequences(packed: DataFrame, window: int = 2048, pad_id: int = 0) -> DataFrame:
    """The sequences of a packing made with ``keep_ids``: sequence_id, n_tokens, padded ids (little-endian unsigned 32 bit) and pieces.

    ``pieces`` says what each part is: offset, length, doc_id and start.  A sequence has at most ``window`` pieces, so each
    group is bounded.
    """
    part = F.struct("offset", "length", "doc_id", "start", "ids")
    whole = packed.groupBy("sequence_id").agg(F.array_sort(F.collect_list(part)).alias("parts"), F.sum("length").alias("n_tokens"))
    data = F.aggregate("parts", F.lit(b""), lambda done, x: F.concat(done, x["ids"]))
    full = F.when(F.expr("bit_count(n_tokens)") == 1, 0).otherwise(window - F.col("n_tokens")).cast("int")
    pad = F.unhex(F.repeat(F.lit(pad_id.to_bytes(4, "little").hex()), full))
    named = F.transform("parts", lambda x: F.struct(x["offset"].alias("offset"), x["length"].alias("length"), x["doc_id"].alias("doc_id"), x["start"].alias("start")))
    return whole.select("sequence_id", "n_tokens", F.concat(data, pad).alias("ids"), named.alias("pieces"))
