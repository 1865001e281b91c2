"""Quality rules with risk-controlled cutoffs.

Each rule is a share of a document (symbols, repeated lines, ...) with a cutoff; a document is rejected where a share is
over its cutoff.  The cutoffs are chosen on labelled documents so that, in every stratum, all rules together falsely
reject at most ``alpha`` of the good documents, in all strata at once with probability ``1 - delta``:

1. The labelled texts are split in two by their hashes; a text counts once, however many rows hold it.
2. The first half gives each stratum a ladder of rule sets from mild to strict.  A rung allows each rule a share of good
   documents to reject, and gives it the cutoff that rejects most bad documents for it (less ``cost`` a good one).
3. On the second half the rungs are tested from mild to strict.  The null hypothesis of a rung is "its rules together
   reject over ``alpha`` of the stratum's good documents"; its p-value is the exact binomial probability of as few
   rejected good documents as seen, or fewer (the Clopper-Pearson bound is at most ``alpha`` just where that is at most
   the level).  Testing stops at the first rung that isn't rejected (fixed sequence), at level ``delta / strata``
   (Bonferroni over the strata).  Of the rungs that pass, the one with the most rejected bad documents less ``cost`` a
   good one is taken, the mildest of equals.

The rungs depend on the first half alone, so the tests on the second half are exact.  Near copies are not told apart and
count as texts of their own.  A stratum with too few labels gets no cutoff and loses nothing.

Defined cases: null text has no words and fails the base rules, as does empty text; a null stratum is a stratum; rows
without a label only get decisions; of conflicting labels of an id, or of rows of one text, the least counts; repeated
rows each get a decision; extra columns are ignored; without labels or rows there are no cutoffs.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from edgeloom.llm.common import forget, map_batches, ship, written

SYMBOLS = b"#*$%&|<>"
RULES = ("symbols", "dup_lines", "repeat_words", "shouting", "exclaiming", "stutter", "brevity")
#: What each rule divides.
_SHARES = (("n_symbols", "word_chars"), ("n_dup_lines", "n_lines"), ("n_repeat_words", "n_words"), ("n_upper", "word_chars"), ("n_exclaim", "word_chars"), ("n_stutter", "n_words"), ("n_lacking", "20"))
#: Cutoffs from mild to strict.
GRID = (*(round(0.95 - 0.05 * i, 2) for i in range(19)), 0.04, 0.03, 0.025, 0.02, 0.015, 0.01, 0.0075, 0.005)
ALPHA, DELTA, COST = 0.01, 0.1, 10.0
#: Good documents that a rung allows one rule to reject, as shares of ``alpha``.
RUNGS = (0.0, *(round(0.05 * i, 2) for i in range(1, 21)))
#: A cutoff that nothing is over.
_NEVER = 2.0
_UPPER = bytes(range(65, 91))
_COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_exclaim", "n_stutter", "n_lacking")


def repeated_windows(ids: np.ndarray, width: int = 8) -> int:
    """Positions of ``ids`` in windows of ``width`` (a power of two) that occur twice or more; exact."""
    n = len(ids) - width + 1
    if n < 2:
        return 0
    x, step = ids.astype(np.int64), 1
    while step < width:
        kinds = int(x.max()) + 1
        if kinds == len(x):  # all differ, so all longer windows do
            return 0
        _, x = np.unique(x[:-step] * kinds + x[step:], return_inverse=True)
        step *= 2
    twice = np.bincount(x)[x] > 1
    if not twice.any():
        return 0
    edge = np.zeros(len(ids) + 1, np.int64)
    edge[:n] += twice
    edge[width : width + n] -= twice
    return int((np.cumsum(edge[:-1]) > 0).sum())


def text_counts(text: str | None) -> tuple[int, ...]:
    """The numbers that the rules use, in the order of ``_COUNTS``."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    words = raw.split()
    n = len(words)
    if not n:
        return (0, 0, _count_symbols(raw), 0, 0, 0, 0, 0, 0, 20)
    joined = b"".join(words)
    chars = len(joined) if joined.isascii() else len(joined.decode("utf-8", "surrogatepass"))
    seen: dict[bytes, int] = {}
    ids = np.fromiter((seen.setdefault(w, len(seen)) for w in words), dtype=np.int64, count=n)
    lines = [x for x in raw.split(b"\n") if x.strip()]
    shouted = len(joined) - len(joined.translate(None, _UPPER))
    return (n, chars, _count_symbols(raw), len(lines) - len(set(lines)), repeated_windows(ids), len(lines), shouted, joined.count(b"!"), int((ids[1:] == ids[:-1]).sum()), max(0, 20 - n))


def _count_symbols(raw: bytes) -> int:
    return len(raw) - len(raw.translate(None, SYMBOLS))


def counted(docs: DataFrame, stratum: str | None = "lang", keep: bool = False) -> DataFrame:
    """doc_id, text_key (a hash of the text), stratum and the numbers of :data:`_COUNTS` for each row, and with ``keep`` the row itself."""

    def scan(batches):
        import pyarrow as pa

        for batch in batches:
            found = np.array([text_counts(t.as_py()) for t in batch.column(3)], np.int64).reshape(batch.num_rows, len(_COUNTS))
            held = [batch.column(i) for i in (0, 1, 2, *([4] if keep else []))]
            yield pa.RecordBatch.from_arrays([*held, *(pa.array(found[:, i]) for i in range(len(_COUNTS)))], names=["doc_id", "text_key", "stratum", *["row"] * keep, *_COUNTS])

    group = F.col(stratum).cast("string") if stratum else F.lit("all")
    row = [F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")] if keep else []
    rows = docs.select("doc_id", F.xxhash64("text").alias("text_key"), F.coalesce(group, F.lit("(none)")).alias("stratum"), "text", *row)
    schema = [f"doc_id {rows.schema['doc_id'].dataType.simpleString()}", "text_key long", "stratum string", *([f"row {rows.schema['row'].dataType.simpleString()}"] if keep else []), *(f"{c} long" for c in _COUNTS)]
    return map_batches(rows, scan, ", ".join(schema))


def shares() -> dict[str, F.Column]:
    """Each rule's share, from the columns of :func:`counts`; 0 where there is nothing to share."""
    of = lambda a, b: F.coalesce(F.col(a) / F.expr(f"nullif({b}, 0)"), F.lit(0.0))
    return {rule: of(*pair) for rule, pair in zip(RULES, _SHARES, strict=True)}


def base_failed() -> F.Column:
    return (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))


def binomial_tail(k: int, n: int, p: float) -> float:
    """P(X <= k) for X ~ Binomial(n, p), exact up to rounding."""
    if k >= n:
        return 1.0
    log_p, log_q = math.log(p), math.log1p(-p)
    top = math.lgamma(n + 1)
    return min(1.0, math.fsum(math.exp(top - math.lgamma(i + 1) - math.lgamma(n - i + 1) + i * log_p + (n - i) * log_q) for i in range(k + 1)))


def ladder(cells: dict[str, list[tuple[int, int]]], alpha: float = ALPHA, cost: float = COST) -> list[list[float]]:
    """The cutoffs of each rung, by rule; ``cells`` has each rule's good and bad documents of the first half by grid interval.

    Interval 0 is over the mildest cutoff, the last one under the strictest.
    """
    rungs = []
    for allowed in RUNGS:
        cutoffs = []
        for rule in RULES:
            tally = cells.get(rule, [])
            n_good, good, bad, best, at = sum(g for g, _ in tally), 0, 0, 0.0, _NEVER
            for cutoff, (g, b) in zip(GRID, tally, strict=False):
                good, bad = good + g, bad + b
                if good > allowed * alpha * n_good:
                    break
                if bad - cost * good > best:
                    best, at = bad - cost * good, cutoff
            cutoffs.append(min(at, rungs[-1][len(cutoffs)]) if rungs else at)
        rungs.append(cutoffs)
    return rungs


def choose_rung(tally: list[tuple[int, int]], strata: int, alpha: float = ALPHA, delta: float = DELTA, cost: float = COST) -> int | None:
    """The rung that is taken, or None; ``tally`` has the good and bad documents of the second half by the first rung that rejects them, and those that none does."""
    n_good, good, bad, best, at = sum(g for g, _ in tally), 0, 0, 0.0, None
    for rung, (g, b) in enumerate(tally[:-1]):
        good, bad = good + g, bad + b
        if good > alpha * n_good or binomial_tail(good, n_good, alpha) > delta / max(1, strata):
            break
        if bad - cost * good > best:
            best, at = bad - cost * good, rung
    return at


def fit_cutoffs(found: DataFrame, labels: DataFrame, alpha: float = ALPHA, delta: float = DELTA, cost: float = COST, base: bool = True) -> DataFrame:
    """``stratum`` and ``cutoffs`` (by rule) of each stratum that has any, from all labelled texts, with ``base`` of those that pass the base rules."""
    marks = labels.select(F.col("doc_id").alias("label_id"), F.col("quality").cast("int").alias("quality")).filter("quality in (0, 1)").groupBy("label_id").agg(F.min("quality").alias("quality"))
    share = F.array(*[x.alias(r) for r, x in shares().items()])
    rows = (found.filter(~base_failed()) if base else found).select("doc_id", "text_key", "stratum", share.alias("shares")).join(marks, F.col("doc_id") == F.col("label_id"))
    # shares follow from the text, so any row's will do
    texts = rows.groupBy("stratum", "text_key").agg(F.min("quality").alias("quality"), F.first("shares").alias("shares"))
    texts = written(texts.withColumn("half", F.pmod(F.xxhash64(F.lit("half"), "text_key"), F.lit(2))), "labelled-texts")
    strata = texts.select("stratum").distinct().count()
    tallied = [F.count_if(F.col("quality") == 1).alias("good"), F.count_if(F.col("quality") == 0).alias("bad")]
    under = lambda x: F.aggregate(F.array(*map(F.lit, GRID)), F.lit(0), lambda n, cut: n + (x <= cut).cast("int"))
    cells = F.transform("shares", lambda x, i: F.struct(i.alias("rule"), under(x).alias("cell")))
    first = texts.filter("half = 0").select("stratum", "quality", F.inline(cells)).groupBy("stratum", "rule", "cell").agg(*tallied)
    ship(found.sparkSession)

    def climb(key, frame):
        import pandas as pd

        tallies: dict[str, list[tuple[int, int]]] = {}
        for r in frame.itertuples():  # rules * intervals at most
            tallies.setdefault(RULES[r.rule], [(0, 0)] * (len(GRID) + 1))[r.cell] = (r.good, r.bad)
        return pd.DataFrame([(key[0], ladder(tallies, alpha, cost))], columns=["stratum", "rungs"])

    rungs = written(first.groupBy("stratum").applyInPandas(climb, "stratum string, rungs array<array<double>>"), "rungs")
    rejects = lambda cuts: F.exists(F.arrays_zip(F.col("shares").alias("share"), cuts.alias("cut")), lambda x: x["share"] > x["cut"])
    milder = F.size(F.filter("rungs", lambda cuts: ~rejects(cuts)))  # rungs only get stricter
    second = texts.filter("half = 1").join(rungs, "stratum").select("stratum", "quality", milder.alias("rung")).groupBy("stratum", "rung").agg(*tallied)

    def choose(key, left, right):
        import pandas as pd

        tally = [(0, 0)] * (len(RUNGS) + 1)
        for r in left.itertuples():
            tally[r.rung] = (r.good, r.bad)
        at = choose_rung(tally, strata, alpha, delta, cost)
        return pd.DataFrame([] if at is None else [(key[0], list(right["rungs"].iloc[0][at]))], columns=["stratum", "cutoffs"])

    chosen = second.groupBy("stratum").cogroup(rungs.groupBy("stratum")).applyInPandas(choose, "stratum string, cutoffs array<double>")
    return written(chosen, "cutoffs")


def _judged(found: DataFrame, cutoffs: DataFrame, base: bool = True) -> DataFrame:
    """``found`` with base_failed, rejected_by (rules) and kept."""
    cuts = cutoffs.select(F.col("stratum").alias("cut_stratum"), "cutoffs")
    over = [F.when(x > F.get("cutoffs", F.lit(i)), F.lit(rule)) for i, (rule, x) in enumerate(shares().items())]
    joined = found.join(cuts, F.col("stratum") == F.col("cut_stratum"), "left").withColumn("base_failed", base_failed() if base else F.lit(False)).withColumn("rejected_by", F.array_compact(F.array(*over)))
    return joined.withColumn("kept", ~F.col("base_failed") & (F.size("rejected_by") == 0)).drop("cut_stratum", "cutoffs")


def verdicts(docs: DataFrame, labels: DataFrame, stratum: str | None = "lang", alpha: float = ALPHA, delta: float = DELTA, cost: float = COST) -> DataFrame:
    """doc_id, stratum, the numbers of :data:`_COUNTS`, base_failed, kept, and the rules that rejected the document, for each row."""
    found = written(counted(docs, stratum), "rule-counts")
    return _judged(found, fit_cutoffs(found, labels, alpha, delta, cost)).select("doc_id", "stratum", *_COUNTS, "base_failed", "rejected_by", "kept")


def keep_good(docs: DataFrame, labels: DataFrame, stratum: str | None = "lang", alpha: float = ALPHA, delta: float = DELTA, cost: float = COST, base: bool = True) -> DataFrame:
    """The rows of ``docs`` that the rules keep; each row is judged by itself.

    Texts are counted for the cutoffs, and again on their way through, so that none is shuffled or written: counting twice
    costs less than moving all texts to the labels of some.  Without ``base`` the base rules, which no label bounds, don't
    decide: shortness and repetition are then only what the rules of that name make of them, under the same bound on false
    rejections as all others.
    """
    counts = written(counted(docs, stratum), "rule-counts")
    cutoffs = fit_cutoffs(counts, labels, alpha, delta, cost, base)
    forget(counts)
    return _judged(counted(docs, stratum, keep=True), cutoffs, base).filter("kept").select("row.*")
