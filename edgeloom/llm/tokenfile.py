"""Token ids in patched frame-of-reference blocks.

A file is a Parquet table of chunks, so that Spark's commit protocol and any store hold it.  A chunk's payload is
self-contained bytes:

    magic "PFR1" | n_docs u32 | n_ids u64 | n_blocks u32
    n_docs lengths of documents, u32 each (the end id counts)
    n_blocks + 1 block starts, u32 each, from the beginning of the block area: the index
    the block area

A block holds up to 512 ids: count u16 | width u8 | n_exceptions u8 | minimum u32 | the low ``width`` bits of each
id less the minimum, packed | exception positions u16 each | the exceptions' high parts, u32 each.  The width is the
least that holds a given percentile of the block's values; the rest are exceptions.

Chunks lie in ascending doc_id order: rows of ``shard`` (the range partition) and ``chunk``, with the ids before
the chunk in its shard.  Defined cases: null text is empty and holds the end id alone; null ids come first; repeated
rows are all stored, those of one id ordered by the hash of their text; an empty table is an empty file; extra columns are ignored.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from edgeloom.llm.common import fresh_folder, map_batches

MAGIC = b"PFR1"
BLOCK = 512
PERCENTILE = 0.9
CHUNK_IDS = 1 << 17


def _widths(values: np.ndarray) -> np.ndarray:
    """Bits that each value needs."""
    return np.ceil(np.log2(values.astype(np.float64) + 1)).astype(np.int64)


def encode_blocks(ids: np.ndarray, percentile: float = PERCENTILE) -> tuple[bytes, np.ndarray]:
    """The block area of ``ids`` and the blocks' starts in it (one more than blocks, the last being the size)."""
    n = len(ids)
    n_blocks = -(-n // BLOCK)
    if not n:
        return b"", np.zeros(1, np.uint32)
    padded = np.full(n_blocks * BLOCK, ids[-1], np.uint32)
    padded[:n] = ids
    grid = padded.reshape(n_blocks, BLOCK)
    least = grid.min(1)
    rest = grid - least[:, None]
    bits = _widths(rest)
    sizes = np.full(n_blocks, BLOCK)
    sizes[-1] = n - (n_blocks - 1) * BLOCK
    width = np.sort(bits, axis=1)[:, int(np.ceil(percentile * BLOCK)) - 1]
    over = (bits > width[:, None]) & (np.arange(BLOCK)[None, :] < sizes[:, None])
    parts: list[bytes | None] = [None] * n_blocks
    where, which = np.nonzero(over)
    first = np.searchsorted(where, np.arange(n_blocks + 1))
    high = (rest[where, which] >> width[where].astype(np.uint32)).astype("<u4")
    which = which.astype("<u2")
    for w in np.unique(width):
        mine, w = np.flatnonzero(width == w), int(w)
        flags = np.unpackbits(rest[mine].astype("<u4").view(np.uint8).reshape(len(mine), BLOCK, 4), axis=2, bitorder="little")[:, :, :w]
        packed = np.packbits(flags.reshape(len(mine), BLOCK * w), axis=1, bitorder="little")
        for row, b in zip(packed, mine.tolist(), strict=True):
            size, lo, hi = int(sizes[b]), int(first[b]), int(first[b + 1])
            parts[b] = struct.pack("<HBBI", size, w, hi - lo, int(least[b])) + row[: (size * w + 7) // 8].tobytes() + which[lo:hi].tobytes() + high[lo:hi].tobytes()
    starts = np.zeros(n_blocks + 1, "<u4")
    np.cumsum([len(p) for p in parts], out=starts[1:])
    return b"".join(parts), starts


def decode_block(area: bytes, start: int) -> np.ndarray:
    size, width, n_over, least = struct.unpack_from("<HBBI", area, start)
    at = start + 8
    n_packed = (size * width + 7) // 8
    if width:
        flags = np.unpackbits(np.frombuffer(area, np.uint8, n_packed, at), bitorder="little")[: size * width]
        values = flags.reshape(size, width).astype(np.uint32) @ (np.uint32(1) << np.arange(width, dtype=np.uint32))
    else:
        values = np.zeros(size, np.uint32)
    if n_over:
        where = np.frombuffer(area, "<u2", n_over, at + n_packed)
        values[where] |= np.frombuffer(area, "<u4", n_over, at + n_packed + 2 * n_over) << np.uint32(width)
    return values + np.uint32(least)


def decode_blocks(area: bytes, starts: np.ndarray) -> np.ndarray:
    """All ids of a block area; blocks of one width and size are unpacked together."""
    n_blocks = len(starts) - 1
    if not n_blocks:
        return np.zeros(0, np.uint32)
    raw, first = np.frombuffer(area, np.uint8), starts[:-1].astype(np.int64)
    size, width, n_over = raw[first].astype(np.int64) + 256 * raw[first + 1].astype(np.int64), raw[first + 2].astype(np.int64), raw[first + 3]
    least = raw[first[:, None] + np.arange(4, 8)].view("<u4").ravel()
    out = np.zeros((n_blocks, BLOCK), np.uint32)
    for w in np.unique(width[size == BLOCK]):
        mine, w = np.flatnonzero((width == w) & (size == BLOCK)), int(w)
        if w:
            packed = raw[(first[mine] + 8)[:, None] + np.arange(BLOCK * w // 8)]
            flags = np.unpackbits(packed, axis=1, bitorder="little").reshape(len(mine) * BLOCK, w)
            wide = np.zeros((len(flags), 32), np.uint8)
            wide[:, :w] = flags
            out[mine] = np.packbits(wide, axis=1, bitorder="little").view("<u4").reshape(len(mine), BLOCK)
    for b in np.flatnonzero((n_over > 0) & (size == BLOCK)):
        at, w, k = int(first[b]) + 8 + BLOCK * int(width[b]) // 8, int(width[b]), int(n_over[b])
        out[b, np.frombuffer(area, "<u2", k, at)] |= np.frombuffer(area, "<u4", k, at + 2 * k) << np.uint32(w)
    out += least[:, None]
    flat = out.ravel()
    if size[-1] == BLOCK:
        return flat
    return np.concatenate([flat[: (n_blocks - 1) * BLOCK], decode_block(area, int(first[-1]))])


def encode_chunk(docs: list[bytes]) -> bytes:
    """A payload of documents' ids, each little-endian unsigned 32 bit."""
    area, starts = encode_blocks(np.frombuffer(b"".join(docs), "<u4"))
    lengths = np.array([len(d) // 4 for d in docs], "<u4")
    return MAGIC + struct.pack("<IQI", len(docs), int(lengths.sum()), len(starts) - 1) + lengths.tobytes() + starts.astype("<u4").tobytes() + area


def decode_chunk(payload: bytes) -> list[np.ndarray]:
    """The ids of each document of a payload."""
    if payload[:4] != MAGIC:
        raise ValueError("not a chunk of token ids")
    n_docs, n_ids, n_blocks = struct.unpack_from("<IQI", payload, 4)
    lengths = np.frombuffer(payload, "<u4", n_docs, 20)
    starts = np.frombuffer(payload, "<u4", n_blocks + 1, 20 + 4 * n_docs)
    ids = decode_blocks(payload[20 + 4 * n_docs + 4 * (n_blocks + 1) :], starts)
    if len(ids) != n_ids:
        raise ValueError("a chunk of token ids is damaged")
    return np.split(ids, np.cumsum(lengths)[:-1])


def write(docs: DataFrame, path: str, tokenizer_path: str, end_id: int = 0, chunk_ids: int = CHUNK_IDS) -> None:
    """Tokenises ``docs`` and writes their ids in ascending doc_id order."""

    def encode(batches):
        import pyarrow as pa
        from pyspark import TaskContext

        from edgeloom.llm.tokens import encoder

        enc, end, shard = encoder(tokenizer_path), end_id.to_bytes(4, "little"), TaskContext.get().partitionId()
        names, held, size, chunk, before = [], [], 0, 0, 0

        def row():
            arrays = [pa.array([shard], pa.int32()), pa.array([chunk], pa.int32()), pa.array([before], pa.int64()), pa.array([size], pa.int64()), pa.array([names], pa.list_(id_kind)), pa.array([encode_chunk(held)], pa.binary())]
            return pa.RecordBatch.from_arrays(arrays, names=["shard", "chunk", "before", "n_ids", "doc_ids", "payload"])

        id_kind = None
        for batch in batches:
            id_kind = batch.schema.field(0).type
            for doc_id, text in zip(batch.column(0), batch.column(1), strict=True):
                data = enc.ids(text.as_py()) + end
                names.append(doc_id.as_py())
                held.append(data)
                size += len(data) // 4
                if size >= chunk_ids:
                    yield row()
                    names, held, chunk, before, size = [], [], chunk + 1, before + size, 0
        if held:
            yield row()

    id_type = docs.schema["doc_id"].dataType.simpleString()
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # rows of one id are spread by their texts' hashes, and equal rows, whose order says nothing, by their numbers
    order = ["doc_id", "text_key", "spread"]
    keyed = docs.select("doc_id", "text", F.xxhash64("text").alias("text_key"), F.monotonically_increasing_id().alias("spread"))
    ranged = keyed.repartitionByRange(n, *order).sortWithinPartitions(*order).select("doc_id", "text")
    map_batches(ranged, encode, f"shard int, chunk int, before long, n_ids long, doc_ids array<{id_type}>, payload binary").write.parquet(path)


def read(spark: SparkSession, path: str, keep_ids: bool = False) -> DataFrame:
    """One row per stored document: doc_id, start, n_tokens, ids_crc32, and with ``keep_ids`` its ids as bytes."""
    chunks = spark.read.parquet(path)
    id_type = chunks.schema["doc_ids"].dataType.elementType.simpleString()
    # a row for each range partition; nothing here grows with the documents
    shards = chunks.groupBy("shard").agg(F.sum("n_ids").alias("ids"))
    bases = shards.select("shard", (F.sum("ids").over(Window.orderBy("shard")) - F.col("ids")).alias("base"))

    def decode(batches):
        import pyarrow as pa

        for batch in batches:
            for base, names, payload in zip(*(batch.column(i) for i in range(3)), strict=True):
                docs = decode_chunk(payload.as_py())
                lengths = np.array([len(d) for d in docs], np.int64)
                data = [d.astype("<u4").tobytes() for d in docs]
                arrays = [names.values, pa.array(base.as_py() + np.cumsum(lengths) - lengths), pa.array(lengths), pa.array([zlib.crc32(d) for d in data], pa.int64())]
                fields = ["doc_id", "start", "n_tokens", "ids_crc32"]
                yield pa.RecordBatch.from_arrays(arrays + [pa.array(data, pa.binary())] * keep_ids, names=fields + ["ids"] * keep_ids)

    rows = chunks.join(F.broadcast(bases), "shard").select((F.col("base") + F.col("before")).alias("base"), "doc_ids", "payload")
    return map_batches(rows, decode, f"doc_id {id_type}, start long, n_tokens long, ids_crc32 long" + ", ids binary" * keep_ids)


def round_trip(docs: DataFrame, tokenizer_path: str, end_id: int = 0) -> DataFrame:
    """Writes ``docs`` to a fresh file in the shared folder and reads it back."""
    path = fresh_folder(docs.sparkSession, "token-ids")
    write(docs, path, tokenizer_path, end_id)
    return read(docs.sparkSession, path)
