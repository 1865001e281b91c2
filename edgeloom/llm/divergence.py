"""How a language's sources differ in their terms: summed differences of every pair of sources, and each source's own terms.

Terms are counted by language and source, and those in at least ``least_docs`` documents of the language are kept.  A
term's column is its counts in the sources that hold it.  Many terms have the same column (most are rare), so columns are
deduplicated: a pair of sources is evaluated once for each distinct column, times the number of its terms.  Sources that a
column leaves out have the share of a zero count, so only pairs with a source that it names are visited; all others are
one product.  Terms are ranked by their columns' values; the terms of a column follow in their own order.

All arithmetic is in whole numbers: a share is ``1 + floor(SCALE * (count + PRIOR) / (N + PRIOR * V))``.

Words are counted on executors in slices of texts and then summed by Spark, so that of a frequent word or a large source
one row for each slice meets, not one for each occurrence.  What tasks get of the sources is one row for each (language, source),
at most ``MOST_GROUPS``; the result has a row for each pair of sources of a language anyway.

Defined cases: null text, language and source count as empty; an empty language is a language; a source without a kept
term has a share for each term like any other; a language without kept terms has pairs of value 0.  Repeated rows count
each.  Words of any length are whole.  No document gives no row.  Extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from edgeloom.llm.common import map_batches, written

SCALE = 1_000_000_000
PRIOR = 5
MOST_GROUPS = 1 << 16
#: Bytes of texts whose words a task counts at a time, and sums of pairs that it holds before it passes them on.
_SLICE_BYTES, _PAIR_CELLS = 8 << 20, 1 << 21
#: Everything but letters as a space; A-Z in lower case; bytes of non-ASCII letters as they are.
_LETTERS = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def _blanked(text):
    """The texts of an Arrow array with nothing but words, in lower case, and spaces; null is empty."""
    import pyarrow as pa

    text = text.fill_null("")
    valid, offsets, data = text.buffers()
    return text if data is None else pa.Array.from_buffers(text.type, len(text), [None, offsets, pa.py_buffer(data.to_pybytes().translate(_LETTERS))], offset=text.offset)


def _runs(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order, and how often each occurs."""
    keys = np.sort(keys)
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    return keys[first], np.diff(first, append=len(keys))


def _counted(blanked, group: np.ndarray) -> tuple:
    """``group``, term, occurrences and documents of each term of each group in these texts."""
    import pyarrow.compute as pc

    split = pc.ascii_split_whitespace(blanked)
    coded = split.flatten().dictionary_encode()
    terms, codes = coded.dictionary, coded.indices.to_numpy().astype(np.int64)
    doc = np.repeat(np.arange(len(split)), np.diff(split.offsets.to_numpy()))
    named = np.flatnonzero(pc.not_equal(terms, "").to_numpy(zero_copy_only=False)[codes]) if len(codes) else codes  # at either end of a text
    codes, doc, n = codes[named], doc[named], len(terms)
    keys, times = _runs(group[doc] * n + codes)
    once, _ = _runs(doc * n + codes)
    _, docs = _runs(group[once // n] * n + once % n) if len(once) else (once, once)
    return keys // max(n, 1), terms.take(keys % max(n, 1)), times, docs


def counts(docs: DataFrame) -> DataFrame:
    """``lang``, ``source``, ``term``, ``n`` (occurrences) and ``docs`` (documents that hold it)."""
    empty = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c)

    def scan(batches):
        import pyarrow as pa

        for batch in batches:
            text, (lang, source) = _blanked(batch.column(0)), (c.dictionary_encode() for c in batch.columns[1:])
            width = len(source.dictionary)
            group = lang.indices.to_numpy().astype(np.int64) * width + source.indices.to_numpy()
            ends, at = np.cumsum(np.diff(np.frombuffer(text.buffers()[1], np.int32)[text.offset : text.offset + len(text) + 1].astype(np.int64))), 0
            while at < len(text):
                until = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + _SLICE_BYTES, side="right")))
                of, term, n, held = _counted(text.slice(at, until - at), group[at:until])
                if len(of):
                    yield pa.RecordBatch.from_arrays([lang.dictionary.take(pa.array(of // width)), source.dictionary.take(pa.array(of % width)), term, pa.array(n), pa.array(held)], names=["lang", "source", "term", "n", "docs"])
                at = until

    found = map_batches(docs.select("text", empty("lang"), empty("source")), scan, "lang string, source string, term string, n long, docs long")
    return found.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def columns(terms: DataFrame, least_docs: int) -> DataFrame:
    """``lang``, ``term`` and ``col`` (source and count, in the order of sources) of the kept terms."""
    found = terms.groupBy("lang", "term").agg(F.sum("docs").alias("docs"), F.sort_array(F.collect_list(F.struct("source", "n"))).alias("col"))
    return found.filter(F.col("docs") >= least_docs).select("lang", "term", "col")


def shares(n: np.ndarray, total: np.ndarray) -> np.ndarray:
    """``1 + floor(SCALE * (n + PRIOR) / total)``; ``n`` is under eight billion, or goes through whole numbers of any size."""
    if n.size and int(n.max()) + PRIOR > (1 << 63) // SCALE - 1:
        return (1 + (n.astype(object) + PRIOR) * SCALE // total.astype(object)).astype(np.int64)
    return 1 + (n + PRIOR) * SCALE // total


class Sources:
    """The sources of one language in order, and what a share is divided by."""

    def __init__(self, names: list[str], totals: list[int], terms: int):
        self.names, self.place = names, {s: i for i, s in enumerate(names)}
        self.bottom = np.array(totals, dtype=np.int64) + PRIOR * terms
        self.zero = shares(np.zeros(len(names), np.int64), self.bottom) if terms else np.zeros(len(names), np.int64)


def pair_sums(cols: list[list[tuple[int, int]]], times: np.ndarray, sources: Sources) -> dict[int, np.ndarray]:
    """By source: twice the sums over columns of ``|p - q| - |p0 - q0|``, where p0 and q0 are shares of zero counts.

    A pair is visited from each source that the column names; where it names both, either visit counts half.
    """
    sums: dict[int, np.ndarray] = {}
    n = len(sources.names)
    per_block = max(1, (1 << 20) // n)
    for at in range(0, len(cols), per_block):
        block = cols[at : at + per_block]
        row = np.repeat(np.arange(len(block)), [len(c) for c in block])
        place, count = (np.array([e[i] for c in block for e in c], dtype=np.int64) for i in (0, 1))
        share = np.tile(sources.zero, (len(block), 1))
        share[row, place] = shares(count, sources.bottom[place])
        named = np.zeros(share.shape, dtype=bool)
        named[row, place] = True
        weight = times[at : at + per_block]
        for g in np.unique(place):
            of = row[place == g]
            more = np.abs(share[of, g, None] - share[of]) - np.abs(sources.zero[g] - sources.zero)
            sums[int(g)] = sums.get(int(g), 0) + (more * np.where(named[of], 1, 2) * weight[of, None]).sum(0)
    return sums


def pairs(distinct: DataFrame, sources: dict[str, Sources]) -> DataFrame:
    """``lang``, ``a``, ``b`` and ``twice``: parts of the sums that :func:`pair_sums` gives, from either end of each pair."""

    def scan(batches):
        import pyarrow as pa

        held: dict[str, dict[int, np.ndarray]] = {}

        def out():
            for lang, sums in held.items():
                names = sources[lang].names
                for g, values in sums.items():
                    some = np.flatnonzero(values)
                    yield pa.RecordBatch.from_arrays([pa.array([lang] * len(some), pa.string()), pa.array([names[g]] * len(some), pa.string()), pa.array([names[i] for i in some], pa.string()), pa.array(values[some])], names=["lang", "a", "b", "twice"])
            held.clear()

        for batch in batches:
            langs, times = batch.column(0).to_pylist(), batch.column(2).to_numpy(zero_copy_only=False)
            cols = batch.column(1).to_pylist()
            for lang in dict.fromkeys(langs):
                at = [i for i, x in enumerate(langs) if x == lang]
                s = sources[lang]
                sums = held.setdefault(lang, {})
                for g, values in pair_sums([[(s.place[e["source"]], e["n"]) for e in cols[i]] for i in at], times[at], s).items():
                    sums[g] = sums.get(g, 0) + values
            if sum(len(sums) * len(sources[lang].names) for lang, sums in held.items()) > _PAIR_CELLS:
                yield from out()
        yield from out()

    return map_batches(distinct.select("lang", "col", "times"), scan, "lang string, a string, b string, twice long")


def audit(docs: DataFrame, least_docs: int = 30, top: int = 50) -> DataFrame:
    """``lang``, ``source``, ``part``, ``item``, ``value`` and ``rank``.

    Part ``pair``: every other source of the language by its summed difference.  Part ``term``: the ``top`` terms that the
    source uses more than its language does, by the difference of their shares.
    """
    key = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c)
    groups = docs.select(key("lang"), key("source")).distinct()
    cols = written(columns(counts(docs), least_docs), "columns")
    distinct = written(cols.groupBy("lang", "col").agg(F.count(F.lit(1)).alias("times")), "distinct-columns")
    entries = distinct.select("lang", "times", "col", F.explode("col").alias("e")).select("lang", "times", "col", "e.source", "e.n")
    totals = entries.groupBy("lang", "source").agg(F.sum(F.col("n") * F.col("times")).alias("total"))
    kept = distinct.groupBy("lang").agg(F.sum("times").alias("terms"))
    groups = written(groups.join(totals, ["lang", "source"], "left").join(kept, "lang", "left").select("lang", "source", F.coalesce("total", F.lit(0)).cast("long").alias("total"), F.coalesce("terms", F.lit(0)).cast("long").alias("terms")), "groups")
    found = groups.limit(MOST_GROUPS + 1).collect()
    if len(found) > MOST_GROUPS:
        raise ValueError(f"over {MOST_GROUPS} pairs of a language and a source")
    by_lang: dict[str, list] = {}
    for r in sorted(found):
        by_lang.setdefault(r["lang"], []).append(r)
    sources = {lang: Sources([r["source"] for r in rows], [r["total"] for r in rows], rows[0]["terms"]) for lang, rows in by_lang.items()}
    return _pair_part(distinct, groups, sources).unionByName(_term_part(cols, entries, groups, top))


def _share(n, total, terms):
    """The share as a column; decimals hold any count."""
    wide = lambda c: c.cast("decimal(20,0)")
    return F.call_function("div", wide(n + PRIOR) * F.lit(SCALE).cast("decimal(10,0)"), wide(total + PRIOR * terms)) + 1


def _pair_part(distinct: DataFrame, groups: DataFrame, sources: dict[str, Sources]) -> DataFrame:
    parts = pairs(distinct, sources)
    both = parts.unionByName(parts.select("lang", F.col("b").alias("a"), F.col("a").alias("b"), "twice"))
    sums = both.groupBy("lang", "a", "b").agg(F.sum("twice").alias("twice"))
    zero = F.when(F.col("terms") > 0, _share(F.lit(0), F.col("total"), F.col("terms"))).otherwise(0)
    left = groups.select("lang", F.col("source").alias("a"), zero.alias("p"), "terms")
    right = groups.select("lang", F.col("source").alias("b"), zero.alias("q"))
    # the result's own rows: every other source of the language
    every = left.join(right, "lang").filter("a != b").join(sums, ["lang", "a", "b"], "left")
    value = F.abs(F.col("p") - F.col("q")) * F.col("terms") + F.expr("coalesce(twice, 0) div 2")
    rank = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item"))
    return every.select("lang", F.col("a").alias("source"), F.lit("pair").alias("part"), F.col("b").alias("item"), value.cast("long").alias("value")).withColumn("rank", rank)


def _term_part(cols: DataFrame, entries: DataFrame, groups: DataFrame, top: int) -> DataFrame:
    known = groups.select("lang", "source", "total", "terms")
    of_lang = groups.groupBy("lang").agg(F.sum("total").alias("lang_total"))
    in_lang = F.aggregate("col", F.lit(0).cast("long"), lambda s, e: s + e["n"])
    valued = entries.withColumn("in_lang", in_lang).join(F.broadcast(known), ["lang", "source"]).join(F.broadcast(of_lang), "lang")
    value = _share(F.col("n"), F.col("total"), F.col("terms")) - _share(F.col("in_lang"), F.col("lang_total"), F.col("terms"))
    valued = valued.select("lang", "source", "col", value.cast("long").alias("value")).filter("value > 0")
    # a column's terms share its value, so columns of rank beyond the top hold none of the top terms
    best = valued.withColumn("place", F.rank().over(Window.partitionBy("lang", "source").orderBy(F.desc("value")))).filter(F.col("place") <= top).drop("place")
    # and of one column only the first terms can be among them
    first = cols.withColumn("place", F.row_number().over(Window.partitionBy("lang", "col").orderBy("term"))).filter(F.col("place") <= top)
    rank = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item"))
    found = best.join(first, ["lang", "col"]).select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), "value")
    return found.withColumn("rank", rank).filter(F.col("rank") <= top)
