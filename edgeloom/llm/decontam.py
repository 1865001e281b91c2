"""Benchmark decontamination with DataFrame expressions alone.

Words are runs of characters other than ASCII separators, with A-Z lower-cased.  A window is ``width`` consecutive
words of a benchmark item; an item of fewer words is one window.  Every place of every document gives the hash of the
words from there on, for each length that windows have; a place is a candidate if its hash is that of a window, which a
join against the set of the windows' hashes tells.  Candidates are verified by a join on the spelled window, so hashes
decide nothing.

The hash set (8 bytes a window) is broadcast while it has at most ``MOST_BROADCAST`` entries, counted before; beyond that
the same join is left to Spark, which shuffles it.  Only candidates are ever spelled out or kept.

Defined cases: null text has no words; an item without words never occurs; items with null ids are ignored; repeated
rows each get a result; documents of one id with different texts are told apart; an empty benchmark hits nothing;
extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from edgeloom.llm.common import forget, written

WIDTH = 10
#: Hashes of windows that are broadcast, about 50 bytes each in memory.
MOST_BROADCAST = 2_000_000
_UPPER, _LOWER = "".join(map(chr, range(65, 91))), "".join(map(chr, range(97, 123)))
_SEPARATOR = "\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F"
#: The same before letters are lower-cased.
_RAW_SEPARATOR = "\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F"


def words(text: Column) -> Column:
    """The lower-cased words of a text; none for null."""
    return F.array_remove(F.split(F.coalesce(F.translate(text, _UPPER, _LOWER), F.lit("")), f"[{_SEPARATOR}]+"), "")


def windows(benchmark: DataFrame, width: int = WIDTH) -> DataFrame:
    """The distinct windows of the benchmark: gram, n (its words), item (the id as text) and mark (a hash of the words)."""
    spelled = benchmark.filter("item_id is not null").select(F.col("item_id").cast("string").alias("item"), words(F.col("text")).alias("w")).filter("size(w) > 0")
    starts = spelled.select("item", "w", F.least(F.size("w"), F.lit(width)).alias("n"), F.explode(F.sequence(F.lit(0), F.greatest(F.size("w") - width, F.lit(0)))).alias("at"))
    cut = starts.select("item", "n", F.slice("w", F.col("at") + 1, F.col("n")).alias("g")).distinct()
    # the hash of an array is that of its elements in turn, so that of the same words as columns
    return cut.select(F.array_join("g", " ").alias("gram"), "n", "item", F.xxhash64("n", "g").alias("mark"))


def places(docs: DataFrame, lengths: list[int]) -> DataFrame:
    """doc_id, text_key, at, n, mark and x (the words from there on) of each place of each document and length that fits."""
    longest = max(lengths)
    spelled = docs.select("doc_id", F.xxhash64("text").alias("text_key"), words(F.col("text")).alias("w")).filter(F.size("w") >= min(lengths))
    following = F.arrays_zip(*[F.slice("w", k + 1, F.size("w")).alias(f"w{k}") for k in range(longest)])
    spots = spelled.select("doc_id", "text_key", F.posexplode(following).alias("at", "x"))
    word = lambda k: F.col("x").getField(f"w{k}")
    marks = {n: F.xxhash64(F.lit(n), *[word(k) for k in range(n)]) for n in lengths}
    if len(lengths) == 1:
        return spots.filter(word(longest - 1).isNotNull()).select("doc_id", "text_key", "at", F.lit(longest).alias("n"), marks[longest].alias("mark"), "x")
    fitting = F.array_compact(F.array(*[F.when(word(n - 1).isNotNull(), F.struct(F.lit(n).alias("n"), m.alias("mark"))) for n, m in marks.items()]))
    return spots.select("doc_id", "text_key", "at", "x", F.explode(fitting).alias("m")).select("doc_id", "text_key", "at", "m.n", "m.mark", "x")


def hits(docs: DataFrame, benchmark: DataFrame, width: int = WIDTH, most_broadcast: int = MOST_BROADCAST) -> DataFrame:
    """The verified windows, as a table: doc_id, text_key, at, n and item."""
    test = written(windows(benchmark, width), "test-windows")
    lengths = [r["n"] for r in test.select("n").distinct().orderBy("n").collect()]  # width at most
    if not lengths:
        return docs.limit(0).select("doc_id", F.xxhash64("text").alias("text_key"), F.lit(0).alias("at"), F.lit(0).alias("n"), F.lit("").alias("item"))
    marks = test.select("mark").distinct()
    if marks.count() <= most_broadcast:
        marks = F.broadcast(marks)
    found = places(docs, lengths).join(marks, "mark", "left_semi")
    gram = F.array_join(F.slice(F.array(*[F.col("x").getField(f"w{k}") for k in range(max(lengths))]), F.lit(1), F.col("n")), " ")
    candidates = written(found.select("doc_id", "text_key", "at", "n", gram.alias("gram")), "test-candidates")
    verified = written(candidates.join(test.select("gram", "item"), "gram").select("doc_id", "text_key", "at", "n", "item"), "test-hits")
    forget(test, candidates)
    return verified


def _same(a: DataFrame, b: DataFrame) -> Column:
    return a["doc_id"].eqNullSafe(b["doc_id"]) & a["text_key"].eqNullSafe(b["text_key"])


def _covered(found: DataFrame) -> DataFrame:
    """doc_id, text_key and p of each word inside a verified window."""
    return found.select("doc_id", "text_key", F.explode(F.expr("sequence(at, at + n - 1)")).alias("p")).distinct()


def contamination(docs: DataFrame, benchmark: DataFrame, width: int = WIDTH, most_broadcast: int = MOST_BROADCAST) -> DataFrame:
    """doc_id, text_key, n_words, n_hit (words inside windows that occur) and items (sorted ids as text) for each row."""
    found = hits(docs, benchmark, width, most_broadcast)
    rows = docs.select("doc_id", F.xxhash64("text").alias("text_key"), F.size(words(F.col("text"))).cast("long").alias("n_words"))
    covered = _covered(found).groupBy("doc_id", "text_key").agg(F.count(F.lit(1)).alias("hit"))
    named = found.groupBy("doc_id", "text_key").agg(F.array_sort(F.collect_set("item")).alias("items"))
    marked = covered.join(named, _same(covered, named)).select(covered["doc_id"], covered["text_key"], "hit", "items")
    return rows.join(marked, _same(rows, marked), "left").select(
        rows["doc_id"], rows["text_key"], "n_words", F.coalesce("hit", F.lit(0)).alias("n_hit"), F.coalesce("items", F.array().cast("array<string>")).alias("items")
    )


def _held(docs: DataFrame) -> DataFrame:
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), "doc_id", F.xxhash64("text").alias("text_key"), "text")


def keep_clean(docs: DataFrame, benchmark: DataFrame, width: int = WIDTH) -> DataFrame:
    """The rows of ``docs`` without any occurring window."""
    held, hit = _held(docs).drop("text"), hits(docs, benchmark, width).select("doc_id", "text_key").distinct()
    return held.join(hit, _same(held, hit), "left_anti").select("row.*")


def cut_spans(docs: DataFrame, benchmark: DataFrame, width: int = WIDTH) -> DataFrame:
    """``docs`` with every occurring window cut out of ``text``; what separates its words goes too, and ``n_chars`` follows.

    Where a window covers little of a long document this keeps the rest.
    """
    nth = F.row_number().over(Window.partitionBy("doc_id", "text_key").orderBy("p"))
    runs = _covered(hits(docs, benchmark, width)).withColumn("run", F.col("p") - nth).groupBy("doc_id", "text_key", "run").agg(F.min("p").alias("first"), F.max("p").alias("last"))
    runs = runs.groupBy("doc_id", "text_key").agg(F.collect_list(F.struct("first", "last")).alias("runs"))
    held = _held(docs)
    joined = held.join(runs, _same(held, runs), "left").select("row", "text", "runs")
    # words and separators in turn: word i is at i, what follows it at i + 0.5
    sign = _RAW_SEPARATOR.replace("\\", "\\\\")
    parts, lead = f"regexp_extract_all(text, '[{sign}]+|[^{sign}]+', 0)", f"IF(text RLIKE '^[{sign}]', 1, 0)"
    kept = F.expr(f"array_join(filter({parts}, (t, j) -> NOT exists(runs, r -> (j - {lead}) / 2D BETWEEN r.first AND r.last)), '')")
    clean = F.when(F.col("runs").isNull(), F.col("text")).otherwise(kept)
    changed = {"text": clean, "n_chars": F.when(F.col("runs").isNull(), F.col("row.n_chars")).otherwise(F.length(clean).cast("long")) if "n_chars" in docs.columns else None}
    return joined.select(*[changed[c].alias(c) if c in changed else F.col(f"row.`{c}`").alias(c) for c in docs.columns])
