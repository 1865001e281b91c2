"""Long repeats by enhanced suffix arrays, over whole texts as UTF-8 bytes.

A repeat is a string of ``least`` bytes or more that starts in more than one place.  To bring equal strings together
without one giant array, each window of ``least`` bytes is filed under its anchor, the leftmost least of the hashes of
its k-grams.  Equal windows have equal anchors at equal offsets, so all that can match meets under one anchor hash.
Neighbouring windows share an anchor; such a run of windows is a context, the bytes that they cover.

1. Contexts that are equal as a whole are counted with map-side combining, so copies of any number are one context;
   one that occurs twice or more is a repeat in full.
2. Where an anchor hash has several different contexts, one copy of each goes to the suffix-array step: an enhanced
   suffix array (prefix doubling, longest common prefixes from the doubling's ranks) over the contexts, then a stack
   scan over its common-prefix intervals.  An interval is a maximal repeat if it is at least ``least`` long and its
   occurrences are preceded by different bytes; all of its occurrences are its group.
3. Anchor hashes with over ``MOST_CONTEXTS`` different contexts would make one task too large.  Their windows are
   compared in aggregations instead, by ranges of the window's distance from the anchor: a range whose windows' common
   bytes are nobody else's holds no repeat, one whose bytes all occur elsewhere is a repeat as a whole, and what is
   neither goes on in narrower ranges, down to single windows.  Bytes are compared by 128-bit digests, which is exact
   but for collisions (odds 2 ** -128).

The spans of all maximal repeats of a document, joined, are what every window that occurs elsewhere covers.
:func:`groups` gives the repeats themselves: each group with all of its occurrences.

Texts are sequences of symbols.  Two kinds are here: ``BYTES``, whose repeats are removed, and ``WORDS``, in which
passages that several documents share are found however short their words are.  Words are told apart by 64-bit hashes.

Defined cases: null text is empty; texts shorter than ``least`` have no repeats; a text that repeats itself counts, as
do overlapping occurrences; repeated rows are documents like any other and so repeat each other; documents of one id
with different texts are told apart; extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from edgeloom.llm.common import forget, map_batches, written

LEAST, LEAST_WORDS = 400, 50
#: Different contexts of one anchor hash that go into one suffix array.
MOST_CONTEXTS = 1024
#: Windows in a range, round by round, where there are more.
RANGES = (32, 6, 1)
#: Window starts that are hashed at a time, and symbols of contexts that share a suffix array.
SEGMENT, ARRAY_SYMBOLS = 1 << 20, 1 << 17
#: Symbols of short texts that are hashed together.
_TOGETHER = 1 << 15
_MULTIPLY, _ROTATE = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
_PLACE = np.uint64((1 << 24) - 1)


@dataclass(frozen=True)
class Symbols:
    """What texts are sequences of: their type, and the symbols (a power of two) of the grams that anchors are chosen from."""

    kind: str
    gram: int

    def of(self, text: str | None) -> np.ndarray:
        raw = (text or "").encode("utf-8", "surrogatepass")
        if self.kind == "u1":
            return np.frombuffer(raw, np.uint8)
        words = raw.split()
        return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))

    def read(self, data: bytes) -> np.ndarray:
        return np.frombuffer(data, np.dtype(self.kind))


BYTES, WORDS = Symbols("u1", 64), Symbols("u8", 8)


def gram_hashes(data: np.ndarray, gram: int) -> np.ndarray:
    """A 64-bit hash of the ``gram`` symbols from each position, by doubling."""
    h, width = (data.astype(np.uint64) + np.uint64(1)) * _MULTIPLY, 1
    while width < gram:
        h = (h[:-width] * _ROTATE) ^ (h[width:] + (h[width:] >> np.uint64(29)))
        h *= _MULTIPLY
        width *= 2
    return h ^ (h >> np.uint64(32))


def sliding_least(keys: np.ndarray, width: int) -> np.ndarray:
    """The least of each ``width`` neighbours."""
    m, have = keys, 1
    while 2 * have <= width:
        m = np.minimum(m[:-have], m[have:])
        have *= 2
    return np.minimum(m[: len(keys) - width + 1], m[width - have : width - have + len(keys) - width + 1]) if have < width else m


def contexts(data: np.ndarray, least: int, gram: int) -> list[tuple[int, int, int, int]]:
    """(anchor hash, context digest, first window, windows) of each run of windows, signed 64-bit hashes."""
    n = len(data) - least + 1
    if n < 1:
        return []
    out, width, raw, size = [], least - gram + 1, memoryview(data.view(np.uint8)), data.itemsize
    for base in range(0, n, SEGMENT):
        windows = min(SEGMENT, n - base)
        h = gram_hashes(data[base : base + windows + least - 1], gram)
        keys = (h & ~_PLACE) | np.arange(len(h), dtype=np.uint64)
        at = (sliding_least(keys, width) & _PLACE).astype(np.int64)
        starts = np.concatenate([[0], np.flatnonzero(at[1:] != at[:-1]) + 1])
        ends = np.append(starts[1:], windows)
        hashes = h[at[starts]].view(np.int64).tolist()
        for fp, s, e in zip(hashes, (starts + base).tolist(), (ends + base).tolist(), strict=True):
            out.append((fp, xxhash.xxh3_64_intdigest(raw[size * s : size * (e + least - 1)]) - (1 << 63), s, e - s))
    return out


def contexts_of(texts: list[np.ndarray], least: int, gram: int) -> tuple[np.ndarray, ...]:
    """Text, anchor hash, context digest, first window and windows of the contexts of all texts, as :func:`contexts` gives them.

    Short texts are hashed together, since a call of numpy costs more than the work that it does for one.
    """
    found: list[tuple[np.ndarray, ...]] = []
    held: list[tuple[int, np.ndarray]] = []

    def flush() -> None:
        if not held:
            return
        data = np.concatenate([t for _, t in held])
        lengths = np.array([len(t) for _, t in held])
        begins = np.cumsum(lengths) - lengths
        ends = begins + lengths - least + 1  # behind the last window
        h = gram_hashes(data, gram)
        keys = (h & ~_PLACE) | np.arange(len(h), dtype=np.uint64)
        at = (sliding_least(keys, least - gram + 1) & _PLACE).astype(np.int64)
        new = np.concatenate([[True], at[1:] != at[:-1]])
        new[begins] = True
        starts = np.flatnonzero(new)
        of = np.searchsorted(begins, starts, side="right") - 1
        inside = starts < ends[of]
        stops = np.minimum(np.append(starts[1:], len(at)), ends[of])[inside]
        starts, of = starts[inside], of[inside]
        raw, size = memoryview(data.view(np.uint8)), data.itemsize
        digests = np.fromiter((xxhash.xxh3_64_intdigest(raw[size * s : size * (e + least - 1)]) for s, e in zip(starts.tolist(), stops.tolist(), strict=True)), np.uint64, len(starts))
        which = np.array([i for i, _ in held])
        found.append((which[of], h[at[starts]].view(np.int64), (digests ^ np.uint64(1 << 63)).view(np.int64), starts - begins[of], stops - starts))
        held.clear()

    symbols = 0
    for i, text in enumerate(texts):
        if len(text) >= _TOGETHER:
            rows = contexts(text, least, gram)
            columns = list(zip(*rows, strict=True)) if rows else [()] * 4
            found.append((np.full(len(rows), i), *(np.array(c, np.int64) for c in columns)))
        elif len(text) >= least:
            held.append((i, text))
            symbols += len(text)
        if symbols >= _TOGETHER:
            flush()
            symbols = 0
    flush()
    return tuple(np.concatenate(c).astype(np.int64) for c in zip(*found, strict=True)) if found else (np.zeros(0, np.int64),) * 5


def join_spans(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Sorted disjoint spans; touching ones are joined."""
    out: list[tuple[int, int]] = []
    for s, e in sorted(spans):
        if out and s <= out[-1][1]:
            out[-1] = (out[-1][0], max(e, out[-1][1]))
        else:
            out.append((s, e))
    return out


def suffix_array(texts: list[np.ndarray], depth: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Suffix array and common prefixes of the texts, each ended by a sign of its own, and each position's preceding code.

    Common prefixes are those with the suffix before, and counted up to the first power of two that is ``depth`` or more.
    """
    ends = np.cumsum([len(t) + 1 for t in texts]) - 1
    body = np.empty(int(ends[-1]) + 1, np.int64)
    inner = np.ones(len(body), bool)
    inner[ends] = False
    body[inner] = np.unique(np.concatenate(texts), return_inverse=True)[1]
    kinds = int(body[inner].max(initial=0)) + 1
    body[ends] = kinds + np.arange(len(texts))
    before = np.empty(len(body), np.int64)
    before[1:] = body[:-1]
    before[0] = kinds + len(texts)
    # equal symbols, pairs and, where they fit a number, fours are told apart by their codes; ranks are first sorted out then
    ranks, width, top = [body], 1, kinds + len(texts) + 1
    while width < depth:
        r, shifted = ranks[-1], np.zeros(len(body), np.int64)
        shifted[:-width] = r[width:].astype(np.int64) + 1
        codes = r.astype(np.int64) * (top + 1) + shifted
        width *= 2
        top = (top + 1) * (top + 1)
        if width < 4 and top < 1 << 31 and width < depth:
            ranks.append(codes)
            continue
        ranks.append(np.unique(codes, return_inverse=True)[1].astype(np.int32))
        top = int(ranks[-1].max()) + 1
        if top == len(body):
            break
    if ranks[-1] is body or ranks[-1].dtype != np.int32:
        ranks[-1] = np.unique(ranks[-1], return_inverse=True)[1].astype(np.int32)
    sa = np.argsort(ranks[-1], kind="stable")
    lcp, i, j = np.zeros(len(sa), np.int64), sa[1:].copy(), sa[:-1].copy()
    for level in range(len(ranks) - 1, -1, -1):
        inside = (i < len(body)) & (j < len(body))
        same = np.zeros(len(i), bool)
        same[inside] = ranks[level][i[inside]] == ranks[level][j[inside]]
        lcp[1:] += same.astype(np.int64) << level
        i, j = i + (same.astype(np.int64) << level), j + (same.astype(np.int64) << level)
    return sa, lcp, before


def maximal_intervals(sa: np.ndarray, lcp: np.ndarray, before: np.ndarray, least: int, owner: np.ndarray | None = None):
    """(from, to, length) of each common-prefix interval that is a maximal repeat, inner ones first.

    With ``owner`` (of each position), only of those that belong to several.  A stack scan; blocks without any left
    diversity are passed over as a whole.
    """
    high = np.concatenate([[False], lcp[1:] >= least, [False]])
    first = np.flatnonzero(~high[:-1] & high[1:])
    last = np.flatnonzero(high[:-1] & ~high[1:])
    codes = before[sa]
    changes = np.concatenate([[0], np.cumsum(codes[1:] != codes[:-1])])
    owned = changes if owner is None else np.concatenate([[0], np.cumsum(owner[sa][1:] != owner[sa][:-1])])
    for lo, hi in zip(first.tolist(), last.tolist(), strict=True):
        if changes[hi] == changes[lo] or owned[hi] == owned[lo]:
            continue
        stack: list[list[int]] = []
        for k, depth in enumerate(lcp[lo + 1 : hi + 1].tolist() + [0], lo + 1):
            left = k - 1
            while stack and stack[-1][0] > depth:
                length, left = stack.pop()
                if changes[k - 1] != changes[left] and owned[k - 1] != owned[left]:
                    yield left, k - 1, length
            if depth and (not stack or stack[-1][0] < depth):
                stack.append([depth, left])


def maximal_repeats(texts: list[np.ndarray], least: int, owners: list[int] | None = None) -> list[tuple[int, list[tuple[int, int]]]]:
    """(length, occurrences as (text, start)) of each maximal repeat group of the texts, with all occurrences."""
    if not texts:
        return []
    sa, lcp, before = suffix_array(texts, max(map(len, texts)) + 1)
    sizes = np.array([len(t) + 1 for t in texts])
    base, out = np.concatenate([[0], np.cumsum(sizes)]), []
    for lo, hi, length in maximal_intervals(sa, lcp, before, least, None if owners is None else np.repeat(owners, sizes)):
        places = np.sort(sa[lo : hi + 1])
        which = np.searchsorted(base, places, side="right") - 1
        out.append((length, list(zip(which.tolist(), (places - base[which]).tolist(), strict=True))))
    return out


def repeated_spans(texts: list[np.ndarray], least: int, owners: list[int] | None = None) -> list[list[tuple[int, int]]]:
    """For each text, the joined spans of its maximal repeats; each start is given its longest one."""
    sa, lcp, before = suffix_array(texts, max(map(len, texts)) + 1)
    sizes = np.array([len(t) + 1 for t in texts])
    base = np.concatenate([[0], np.cumsum(sizes)])
    free: dict[int, int] = {}  # the next place of the array without a repeat yet
    found: list[list[tuple[int, int]]] = [[] for _ in texts]

    def next_free(k: int) -> int:
        path = []
        while k in free:
            path.append(k)
            k = free[k]
        for x in path:
            free[x] = k
        return k

    for lo, hi, length in maximal_intervals(sa, lcp, before, least, None if owners is None else np.repeat(owners, sizes)):
        k = next_free(lo)
        while k <= hi:
            which = int(np.searchsorted(base, sa[k], side="right")) - 1
            start = int(sa[k] - base[which])
            found[which].append((start, start + length))
            free[k] = k + 1
            k = next_free(k)
    return [join_spans(x) for x in found]


def _occurrences(docs: DataFrame, least: int, symbols: Symbols) -> DataFrame:
    """A row for each context of each row of ``docs``: it begins at ``at`` and holds ``runs`` windows."""

    def scan(batches):
        import pyarrow as pa

        for batch in batches:
            i, fp, digest, at, runs = contexts_of([symbols.of(t.as_py()) for t in batch.column(2)], least, symbols.gram)
            take = pa.array(i.astype(np.int32))
            arrays = [batch.column(0).take(take), batch.column(1).take(take), pa.array(fp), pa.array(digest), pa.array(at), pa.array(runs.astype(np.int32))]
            yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "text_key", "fp", "digest", "at", "runs"])

    id_type = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", F.xxhash64("text").alias("text_key"), "text")
    return map_batches(rows, scan, f"doc_id {id_type}, text_key long, fp long, digest long, at long, runs int")


def _same(a: DataFrame, b: DataFrame):
    return a["doc_id"].eqNullSafe(b["doc_id"]) & a["text_key"].eqNullSafe(b["text_key"])


def _cut_out(docs: DataFrame, wanted: DataFrame, least: int, symbols: Symbols) -> DataFrame:
    """The symbols of the contexts in ``wanted`` (fp, digest, doc_id, text_key, at, runs, hot, owner)."""
    lists = wanted.groupBy("doc_id", "text_key").agg(F.collect_list(F.struct("fp", "digest", "at", "runs", "hot", "owner")).alias("wanted"))
    keyed = docs.select("doc_id", F.xxhash64("text").alias("text_key"), "text")
    joined = keyed.join(lists, _same(keyed, lists)).select("text", "wanted")

    def cut(batches):
        import pyarrow as pa

        for batch in batches:
            rows = []
            for text, wants in zip(batch.column(0), batch.column(1), strict=True):
                data = symbols.of(text.as_py())
                rows += [(x["fp"], x["digest"], x["hot"], x["owner"], data[x["at"] : x["at"] + x["runs"] + least - 1].tobytes()) for x in wants.as_py()]
            kinds = (pa.int64(), pa.int64(), pa.bool_(), pa.int64(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names=["fp", "digest", "hot", "owner", "data"])

    # repeated rows bring the same context twice
    return map_batches(joined, cut, "fp long, digest long, hot boolean, owner long, data binary").dropDuplicates(["fp", "digest"])


def _arrays(cut: DataFrame, least: int, symbols: Symbols, rows_of, schema: str) -> DataFrame:
    """What ``rows_of`` makes of the contexts (fp, digest, owner, symbols) that share a suffix array: all of an anchor hash, and several hashes' while they are small."""
    names = [x.split()[0] for x in schema.split(", ")]

    def scan(batches):
        import pyarrow as pa

        kinds = [pa.list_(pa.int64()) if "array" in x else pa.int64() for x in schema.split(", ")]
        held: list[tuple] = []
        size, last = 0, None

        def flush():
            rows = rows_of(held, least) if held else []
            return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names=names)

        for batch in batches:
            for fp, digest, owner, data in zip(*(batch.column(i).to_pylist() for i in range(3)), batch.column(3), strict=True):
                if size > ARRAY_SYMBOLS and fp != last:
                    yield flush()
                    held.clear()
                    size = 0
                held.append((fp, digest, owner, symbols.read(data.as_py())))
                size, last = size + len(held[-1][3]), fp
        yield flush()

    n = int(cut.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = cut.filter("NOT hot").select("fp", "digest", "owner", "data").repartition(n, "fp").sortWithinPartitions("fp", "digest")
    return map_batches(dealt, scan, schema)


def _span_rows(held: list[tuple], least: int) -> list[tuple]:
    spans = repeated_spans([h[3] for h in held], least, [h[2] for h in held])
    return [(h[0], h[1], [x for p in s for x in p]) for h, s in zip(held, spans, strict=True) if s]


def _group_rows(held: list[tuple], least: int) -> list[tuple]:
    rows = []
    for length, places in maximal_repeats([h[3] for h in held], least, [h[2] for h in held]):
        i, p = places[0]
        group = xxhash.xxh3_64_intdigest(held[i][3][p : p + length].tobytes()) - (1 << 63)
        rows += [(held[i][0], held[i][1], group, length, p) for i, p in places]
    return rows


def ranges(data: np.ndarray, width: int, least: int, gram: int, inside: list[int] | None = None) -> list[tuple[int, bytes, bytes, int, int]]:
    """(range, digest of its windows' common symbols, digest of all symbols of the own windows in it, first window, last) of a context.

    Range r holds the windows that start r * width to r * width + width - 1 symbols before the anchor.  With ``inside``,
    only for those windows (flat first and last numbers).
    """
    runs = len(data) - least + 1
    h = gram_hashes(data[:least], gram)
    anchor = int(((h & ~_PLACE) | np.arange(len(h), dtype=np.uint64)).min() & _PLACE)
    out = []
    for lo, hi in zip(inside[::2], inside[1::2], strict=True) if inside is not None else [(0, runs - 1)]:
        for r in range((anchor - hi) // width, (anchor - lo) // width + 1):
            first, last = max(lo, anchor - (r * width + width - 1)), min(hi, anchor - r * width)
            begin = max(0, anchor - r * width)
            common = data[begin : max(begin, anchor - (r * width + width - 1) + least)]  # nothing where ranges are wider than windows
            out.append((r, xxhash.xxh3_128_digest(common.tobytes()), xxhash.xxh3_128_digest(data[first : last + least].tobytes()), first, last))
    return out


def _by_ranges(cut: DataFrame, least: int, symbols: Symbols) -> DataFrame:
    """fp, digest and spans (flat starts and ends) of repeats in contexts of crowded anchor hashes: by ranges of windows, ever narrower."""
    crowd = cut.filter("hot").select("fp", "digest", "owner", "data", F.lit(None).cast("array<bigint>").alias("inside"))
    found = None
    for width in RANGES:

        def split(batches, width=width):
            import pyarrow as pa

            for batch in batches:
                rows = [(fp, digest, owner, *x) for fp, digest, owner, data, inside in zip(*(c.to_pylist() for c in batch.columns), strict=True) for x in ranges(symbols.read(data), width, least, symbols.gram, inside)]
                kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.int64(), pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names=["fp", "digest", "owner", "range", "common", "all", "first", "last"])

        rows = written(map_batches(crowd, split, "fp long, digest long, owner long, range long, common binary, all binary, first long, last long"), "ranges")
        same = ["fp", "range", "common"]
        kinds = rows.groupBy(*same, "all").agg(F.min("owner").alias("least_owner"), F.max("owner").alias("most_owner"), F.min("digest").alias("one"))
        several = kinds.groupBy(*same).agg(F.count(F.lit(1)).alias("kinds")).filter("kinds > 1")
        twice = rows.join(kinds.filter("least_owner != most_owner").select(*same, "all"), [*same, "all"], "left_semi").select("fp", "digest", F.array("first", F.col("last") + least).alias("spans"))
        found = twice if found is None else found.union(twice)
        # what meets others in part goes on, one context for each kind
        ones = kinds.join(several, same).select(*same, "all", F.col("one").alias("digest"))
        left = rows.join(ones, [*same, "all", "digest"], "left_semi").groupBy("fp", "digest").agg(F.flatten(F.collect_list(F.array("first", "last"))).alias("inside"))
        if width > 1:
            crowd = cut.filter("hot").select("fp", "digest", "owner", "data").join(left, ["fp", "digest"])
    return found


def _prepared(docs: DataFrame, least: int, most_contexts: int, symbols: Symbols, across: bool) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Tables of the contexts of all rows, of their kinds (``whole`` if they repeat as such), and of the symbols of those that must be compared.

    With ``across``, repeats within one document (id and text) don't count: a context of one document alone is owned by it.
    """
    found = written(_occurrences(docs, least, symbols), "contexts")
    row = F.xxhash64(F.col("doc_id").cast("string"), "text_key")
    kinds = found.groupBy("fp", "digest").agg(F.count(F.lit(1)).alias("n"), F.min(row).alias("least_row"), F.max(row).alias("most_row"), F.min(F.struct("doc_id", "text_key", "at", "runs")).alias("one"))
    single = F.col("least_row") == F.col("most_row") if across else F.col("n") == 1
    kinds = written(kinds.select("fp", "digest", "one", (~single).alias("whole"), F.when(F.lit(across) & single, F.col("least_row")).otherwise(F.xxhash64("fp", "digest")).alias("owner")), "context-kinds")
    several = kinds.groupBy("fp").agg(F.count(F.lit(1)).alias("kinds")).filter("kinds > 1")
    wanted = kinds.join(several, "fp").select("fp", "digest", "one.*", (F.col("kinds") > most_contexts).alias("hot"), "owner")
    cut = written(_cut_out(docs, wanted, least, symbols), "context-symbols")
    return found, kinds, cut


def repeats(docs: DataFrame, least: int = LEAST, most_contexts: int = MOST_CONTEXTS, symbols: Symbols = BYTES, across: bool = False) -> DataFrame:
    """A table of doc_id, text_key and spans (flat starts and ends, not joined) of each distinct row of ``docs`` that holds repeats."""
    found, kinds, cut = _prepared(docs, least, most_contexts, symbols, across)
    crowded = _by_ranges(cut, least, symbols).groupBy("fp", "digest").agg(F.flatten(F.collect_list("spans")).alias("spans"))
    parts = written(_arrays(cut, least, symbols, _span_rows, "fp long, digest long, spans array<bigint>").union(crowded), "context-repeats")
    forget(cut)
    marks = kinds.filter("whole").select("fp", "digest", "whole").join(parts, ["fp", "digest"], "full_outer").select("fp", "digest", "whole", "spans")
    absolute = F.when(F.col("whole"), F.array(F.col("at"), F.col("at") + F.col("runs") + least - 1)).otherwise(F.transform("spans", lambda x: x + F.col("at")))
    rows = found.join(marks, ["fp", "digest"]).select("doc_id", "text_key", absolute.alias("spans"))
    # equal rows have equal spans, so a set holds no more than one row's
    spans = written(rows.groupBy("doc_id", "text_key").agg(F.flatten(F.collect_set("spans")).alias("spans")), "repeat-spans")
    forget(found, kinds, parts)
    return spans


def groups(docs: DataFrame, least: int = LEAST, most_contexts: int = MOST_CONTEXTS, symbols: Symbols = BYTES, across: bool = False) -> DataFrame:
    """group_id, length, doc_id, text_key and start of every occurrence of every repeat group.

    A group is a maximal repeat among the contexts of one anchor: a string that starts in several places and can't be made
    longer at either end, within those contexts, without losing one.  Groups of crowded anchors are the ranges that
    several contexts share.
    """
    found, kinds, cut = _prepared(docs, least, most_contexts, symbols, across)
    crowded = _by_ranges(cut, least, symbols).select("fp", "digest", F.col("spans")[0].alias("start"), (F.col("spans")[1] - F.col("spans")[0]).alias("length"))
    named = crowded.join(cut.select("fp", "digest", "data"), ["fp", "digest"])
    size = int(symbols.kind[1])
    part = F.expr(f"substring(data, CAST(start * {size} + 1 AS INT), CAST(length * {size} AS INT))")
    named = named.select("fp", "digest", F.xxhash64(part).alias("group_id"), "length", "start")
    parts = written(_arrays(cut, least, symbols, _group_rows, "fp long, digest long, group_id long, length long, start long").union(named), "context-groups")
    held = found.select("doc_id", "text_key", "fp", "digest", "at", "runs")
    # a context that others hold in full is in a group with them already
    alone = held.join(kinds.filter("whole").select("fp", "digest"), ["fp", "digest"]).withColumn("length", (F.col("runs") + least - 1).cast("long")).join(parts.filter("start = 0").select("fp", "digest", "length"), ["fp", "digest", "length"], "left_anti")
    all_of = alone.select(F.xxhash64("fp", "digest").alias("group_id"), "length", "doc_id", "text_key", F.col("at").alias("start"))
    some_of = held.join(parts, ["fp", "digest"]).select("group_id", "length", "doc_id", "text_key", (F.col("at") + F.col("start")).alias("start"))
    return all_of.union(some_of)


def _joined(flat) -> list[tuple[int, int]]:
    flat = flat.as_py() or []
    return join_spans(list(zip(flat[::2], flat[1::2], strict=True)))


def remove_repeats(docs: DataFrame, least: int = LEAST, most_contexts: int = MOST_CONTEXTS, keep_bytes: bool = False, least_words: int | None = None) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 and spans of each row, and with ``keep_bytes`` the bytes that stay.

    With ``least_words`` also n_passages and n_passage_words: passages of so many words or more that another document holds
    too, and the words in them, whatever their bytes; nothing is removed for them.
    """
    spans = repeats(docs, least, most_contexts)
    keyed = docs.select("doc_id", F.xxhash64("text").alias("text_key"), "text")
    if least_words:
        shared = repeats(docs, least_words, most_contexts, WORDS, across=True).withColumnRenamed("spans", "shared")
        both = spans.join(shared, _same(spans, shared), "full_outer").select(F.coalesce(spans["doc_id"], shared["doc_id"]).alias("doc_id"), F.coalesce(spans["text_key"], shared["text_key"]).alias("text_key"), "spans", "shared")
    else:
        both = spans.withColumn("shared", F.lit(None).cast("array<bigint>"))
    joined = keyed.join(both, _same(keyed, both), "left").select(keyed["doc_id"], "text", "spans", "shared")

    def cut(batches):
        import pyarrow as pa

        for batch in batches:
            rows = []
            for text, flat, shared in zip(batch.column(1), batch.column(2), batch.column(3), strict=True):
                raw, gone, passages = (text.as_py() or "").encode("utf-8", "surrogatepass"), _joined(flat), _joined(shared)
                kept = b"".join(raw[a:b] for a, b in zip([0, *(e for _, e in gone)], [*(s for s, _ in gone), len(raw)], strict=True))
                rows.append((len(raw), len(raw) - len(kept), len(gone), hashlib.sha256(kept).hexdigest(), [x for s in gone for x in s], len(passages), sum(e - s for s, e in passages), kept))
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.list_(pa.int64()), pa.int64(), pa.int64(), pa.binary())
            columns = [pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds[: 7 + keep_bytes])]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans", "n_passages", "n_passage_words", *["kept"] * keep_bytes])

    id_type = docs.schema["doc_id"].dataType.simpleString()
    found = map_batches(joined, cut, f"doc_id {id_type}, n_bytes long, n_removed long, n_spans long, kept_sha256 string, spans array<bigint>, n_passages long, n_passage_words long" + ", kept binary" * keep_bytes)
    return found if least_words else found.drop("n_passages", "n_passage_words")
