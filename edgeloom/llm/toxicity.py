"""Toxicity by weak supervision.

Voters: lexicons and patterns that each fire on a text or don't.  Some lexicons are fixed (insults by language);
others are mined from labelled documents as words and word beginnings that stand out in toxic ones, dealt over
several voters so that they can be compared.  Patterns look at address ("you" near an insult), shouting, and how many
words of the text are in any lexicon, alone and for its length.

Label model: a two-class generative model of which voters fire, fitted by expectation maximisation on the votes of
all documents.  Given the class, each voter depends on one other: the likelihood is that of the tree of voters with the
most mutual information (given the class), found anew in each round.  So the model estimates each voter's rates of
firing in either class (its accuracy) and the correlations that voters have beyond the class, and voters that say the
same thing count once.  There are at most 16 voters, so the votes of any number of documents are at most 65,536 counts
of patterns.  Documents with a known label keep it while the model is fitted.

Classifier: a linear model over hashed words, word beginnings and counts of listed words, fitted by
follow-the-regularised-leader on the label model's posteriors of a bounded sample of documents, and run over every whole
text.  Words and features are made on executors; the driver gets units that stand out, least hashes and feature numbers
of bounded samples, never texts.

Defined cases: null and empty texts have no features and get the bias alone; a null id has no label and is scored like
any other; without labels the mined lexicons are empty and the fixed ones decide; with conflicting labels of one id the
least counts; repeated rows each vote and get a score; extra columns are ignored.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from edgeloom.llm.common import map_batches, written
from edgeloom.llm.ftrl import fit, sigmoid
from edgeloom.llm.quality import labelled_sample
from edgeloom.llm.rules import binomial_tail

#: Labelled documents that lexicons are mined from, of either label, at most.
MINE_ROWS = 2500
#: Documents that the classifier is fitted on, on either side of an even posterior, at most.
FIT_ROWS = 2000
SIZE = 1 << 18
_WORDS = re.compile(r"\w+")
_CACHE_WORDS = 300_000
_ADDRESS = frozenset("you your youre du dich dein tu te ton vous votre usted eres".split())
_FIXED = {
    "insults_en": "idiot moron stupid loser pathetic worthless scum trash disgusting clown dumb imbecile fool jerk filthy vermin",
    "insults_de": "idiot dumm trottel abschaum versager ekelhaft arschloch dreckig nutzlos",
    "insults_romance": "imbécile crétin connard stupide nul ordure dégoûtant estúpido tonto basura inútil asqueroso escoria",
}
#: Voters of mined words, and as many of mined beginnings: two for units that are less sure, two for the surest.
MINED = 4
PREFIXES = (4, 5, 6, 7)
VOTERS = (*_FIXED, *(f"mined_words_{i}" for i in range(MINED)), *(f"mined_stems_{i}" for i in range(MINED)), "addressed", "several", "dense")
_BIT = {name: 1 << i for i, name in enumerate(VOTERS)}
#: Distinct listed words, and words of a text for each of them, that features tell apart; the voters take one of either.
LISTED, SPREAD = (2, 3, 5), (200, 100, 50)
SEVERAL, DENSE = 3, 120


def least_hashes(words: set[str]) -> list[int]:
    """Eight least hashes of a set of words."""
    codes = np.array([zlib.crc32(w.encode("utf-8", "surrogatepass")) for w in words], np.uint64)
    return [int((codes * np.uint64(2 * k + 3) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(20)).min()) for k in range(8)] if len(codes) else [0] * 8


def distinct_texts(least: list[list[int]]) -> list[int]:
    """Positions of texts, by their least hashes, that are no near copy of an earlier one: under 4 of 8 agree with any."""
    seen: dict[tuple[int, int], list[int]] = {}
    kept = []
    for i, hashes in enumerate(least):
        shared = Counter(j for k, v in enumerate(hashes) for j in seen.get((k, v), ()))
        if max(shared.values(), default=0) < 4:
            kept.append(i)
            for k, v in enumerate(hashes):
                seen.setdefault((k, v), []).append(i)
    return kept


def text_units(words: set[str]) -> list[tuple[str, str]]:
    """The words and their beginnings (ending in ``*``), each with the word."""
    return [(w, w) for w in words] + [(w[:k] + "*", w) for w in words for k in PREFIXES if len(w) > k]


def _sample_words(sample: DataFrame) -> DataFrame:
    """label_id, label, least hashes and distinct words of each row of a labelled sample."""

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            words = [sorted(set(_WORDS.findall((t.as_py() or "").lower()))) for t in batch.column(2)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array([least_hashes(set(w)) for w in words], pa.list_(pa.int64())), pa.array(words, pa.list_(pa.string()))], names=["label_id", "label", "least", "words"])

    return map_batches(sample.select("label_id", "label", "text"), run, f"label_id {sample.schema['label_id'].dataType.simpleString()}, label int, least array<bigint>, words array<string>")


def mine(sample: DataFrame, chance: float = 0.01) -> dict[str, int]:
    """Words and beginnings that stand out in the toxic documents of a labelled sample, with the voter bit of each.

    Near copies count once.  A unit stands out if it is in 8 times the share of toxic documents that it has of clean
    ones, and so many toxic documents are improbable (exact binomial, at ``chance`` over all units together).  A
    beginning is only taken where several words share it.  Units of 60 times the share and others are dealt to voters
    of their own, so that the label model can tell how far to believe either.
    """
    words = written(_sample_words(sample), "mined-words")
    rows = words.select("label_id", "label", "least").orderBy(F.desc("label"), "label_id").collect()
    rows = [rows[i] for i in distinct_texts([r["least"] for r in rows])]
    total = Counter(r["label"] for r in rows)
    if not total[0] or not total[1]:
        return {}
    kept = words.sparkSession.createDataFrame([(r["label_id"],) for r in rows], f"kept_id {words.schema['label_id'].dataType.simpleString()}")
    held = words.join(F.broadcast(kept), F.col("label_id") == F.col("kept_id")).select("label_id", "label", "words")

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            for label, found in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                units: dict[str, list[str]] = {}
                for unit, word in text_units(set(found)):
                    units.setdefault(unit, []).append(word)
                yield pa.RecordBatch.from_arrays([pa.array(list(units), pa.string()), pa.array([label] * len(units), pa.int32()), pa.array([sorted(v)[:3] for v in units.values()], pa.list_(pa.string()))], names=["unit", "label", "forms"])

    units = map_batches(held, run, "unit string, label int, forms array<string>")
    toxic, clean = F.count_if(F.col("label") == 1).alias("a"), F.count_if(F.col("label") == 0).alias("b")
    tallies = units.groupBy("unit").agg(toxic, clean, F.size(F.array_distinct(F.flatten(F.collect_set(F.when(F.col("label") == 1, F.col("forms")))))).alias("n_forms"))
    tallies = written(tallies, "mined-units")
    kinds = tallies.count()
    # that many toxic documents are at least three
    likely = tallies.filter((F.col("a") >= 3) & (F.col("a") * total[0] >= 8 * F.col("b") * total[1]) & (~F.col("unit").endswith("*") | (F.col("n_forms") >= 3))).orderBy("unit").collect()
    share, found = total[0] / (total[0] + total[1]), {}
    for unit, a, b, _ in likely:
        if binomial_tail(b, a + b, share) < chance / kinds:
            pure = a * total[0] >= 60 * b * total[1]
            found[unit] = _BIT[f"{'mined_stems' if unit[-1] == '*' else 'mined_words'}_{zlib.crc32(unit.encode('utf-8', 'surrogatepass')) % 2 + 2 * pure}"]
    return found


class Votes:
    """The voters that fire on a text, as bits."""

    def __init__(self, mined: dict[str, int]):
        self.units = dict(mined)
        for name, words in _FIXED.items():
            for w in words.split():
                self.units[w] = self.units.get(w, 0) | _BIT[name]
        outer = self

        class Masks(dict):
            def __missing__(self, word: str) -> int:
                mask = outer.units.get(word, 0)
                for k in PREFIXES:
                    if len(word) > k:
                        mask |= outer.units.get(word[:k] + "*", 0)
                if len(self) >= _CACHE_WORDS:
                    self.clear()
                self[word] = mask
                return mask

        self.masks = Masks()

    def __call__(self, text: str | None) -> int:
        if not text:
            return 0
        words = _WORDS.findall(text.lower())
        masks = list(map(self.masks.__getitem__, words))
        hits = [i for i, m in enumerate(masks) if m]
        votes = 0
        for i in hits:
            votes |= masks[i]
            if not votes & _BIT["addressed"] and any(w in _ADDRESS for w in words[max(0, i - 4) : i + 4]):
                votes |= _BIT["addressed"]
        listed = len({words[i] for i in hits})
        if listed >= SEVERAL:
            votes |= _BIT["several"]
        if listed >= 2 and len(hits) * DENSE >= len(words):
            votes |= _BIT["dense"]
        return votes


def votes(docs: DataFrame, mined: dict[str, int]) -> DataFrame:
    """doc_id and votes of each row."""

    def run(batches):
        import pyarrow as pa

        cast = Votes(mined)
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([cast(t.as_py()) for t in batch.column(1)], pa.int32())], names=["doc_id", "votes"])

    return map_batches(docs.select("doc_id", "text"), run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, votes int")


class LabelModel:
    """Class prior, each voter's firing rates by class, its correlations given the class, and the tree that the likelihood follows."""

    def __init__(self, prior: float, rates: np.ndarray, correlation: np.ndarray, parent: list[int], given: np.ndarray):
        self.prior, self.rates, self.correlation, self.parent, self.given = prior, rates, correlation, parent, given

    def posterior(self, fired: np.ndarray) -> np.ndarray:
        """P(class 1) for rows of 0/1 votes; ``given[c, b, i]`` is how often voter i fires in class c if its parent's vote is b."""
        evidence = np.full(len(fired), math.log(self.prior / (1 - self.prior)))
        for i, p in enumerate(self.parent):
            before = fired[:, p].astype(np.int64) if p >= 0 else np.zeros(len(fired), np.int64)
            on = self.given[:, before, i]
            chance = np.where(fired[:, i] > 0, on, 1 - on)
            evidence += np.log(chance[1]) - np.log(chance[0])
        return sigmoid(evidence)


def unpack(patterns: np.ndarray) -> np.ndarray:
    return (np.asarray(patterns, np.int64)[:, None] >> np.arange(len(VOTERS)) & 1).astype(np.float64)


def information(both: np.ndarray, rates: np.ndarray) -> np.ndarray:
    """Mutual information of each pair of voters from how often both fire and how often each does."""
    total = np.zeros_like(both)
    for a in (0, 1):
        for b in (0, 1):
            x, y = (rates if a else 1 - rates)[:, None], (rates if b else 1 - rates)[None, :]
            joint = both if a and b else rates[:, None] - both if a else rates[None, :] - both if b else 1 - rates[:, None] - rates[None, :] + both
            joint = np.clip(joint, 1e-12, 1)
            total += joint * np.log(joint / np.clip(x * y, 1e-12, 1))
    return total


def spanning_tree(weight: np.ndarray) -> list[int]:
    """The parent of each voter in the tree of most weight, -1 for the root."""
    n = len(weight)
    parent, best, by = [-1] * n, weight[0].copy(), np.zeros(n, np.int64)
    left = set(range(1, n))
    while left:
        i = max(left, key=lambda k: (best[k], -k))
        parent[i] = int(by[i])
        left.remove(i)
        nearer = weight[i] > best
        best, by = np.where(nearer, weight[i], best), np.where(nearer, i, by)
    return parent


def fit_label_model(patterns: np.ndarray, n: np.ndarray, known: np.ndarray | None = None, rounds: int = 40) -> LabelModel:
    """Expectation maximisation over counts ``n`` of vote patterns; ``known`` has the class of labelled ones, else -1."""
    fired, n, k = unpack(patterns), n.astype(np.float64), len(VOTERS)
    known = np.full(len(n), -1) if known is None else known
    p = np.where(known >= 0, known, np.where(fired.any(1), 0.9, 0.02)).astype(np.float64)
    model = None
    for _ in range(rounds):
        mass = np.stack([n * (1 - p), n * p])
        total = mass.sum(1)
        # one pseudo-document that fires at 1 in 1,000 if clean, at 1 in 20 if toxic
        rates = np.clip((mass @ fired + np.array([[0.001], [0.05]])) / (total[:, None] + 1), 1e-5, 1 - 1e-5)
        prior = float(np.clip(total[1] / total.sum(), 1e-4, 1 - 1e-4)) if total.sum() else 0.1
        correlation, weight, joint = np.zeros((2, k, k)), np.zeros((k, k)), np.zeros((2, k, k))
        for c in (0, 1):
            both = (fired * mass[c][:, None]).T @ fired
            joint[c] = both
            expected = np.outer(rates[c], rates[c])
            both = np.clip((both + expected) / (total[c] + 1), 0, np.minimum.outer(rates[c], rates[c]))
            sd = np.sqrt(rates[c] * (1 - rates[c]))
            correlation[c] = (both - expected) / np.outer(sd, sd)
            weight += total[c] / max(total.sum(), 1e-9) * information(both, rates[c])
        np.fill_diagonal(weight, 0)
        parent = spanning_tree(weight)
        given = np.empty((2, 2, k))
        for c in (0, 1):
            votes = mass[c] @ fired
            for i, q in enumerate(parent):
                # five pseudo-documents hold a rate given the parent near the voter's own
                on, fired_too = (votes[q], joint[c, q, i]) if q >= 0 else (0.0, 0.0)
                given[c, 1, i] = (fired_too + 5 * rates[c, i]) / (on + 5)
                given[c, 0, i] = (votes[i] - fired_too + 5 * rates[c, i]) / (total[c] - on + 5)
        model = LabelModel(prior, rates, correlation, parent, np.clip(given, 1e-5, 1 - 1e-5))
        new = np.where(known >= 0, known, model.posterior(fired))
        if np.abs(new - p).max(initial=0) < 1e-6:
            break
        p = new
    return model


def word_features(word: str, mask: int = 0, size: int = SIZE) -> tuple[int, ...]:
    """Hashes of a word, its beginnings, and the lexicons (bits of ``mask``) that it is in."""
    units = [word, *(word[:k] + "*" for k in PREFIXES if len(word) > k), *(f"\x00{name}" for name in VOTERS if mask & _BIT[name])]
    if mask:
        units.append("\x00any")
    return tuple(zlib.crc32(u.encode("utf-8", "surrogatepass")) % size for u in units)


def _unit(name: str, size: int) -> int:
    return zlib.crc32(f"\x00{name}".encode()) % size


def count_features(listed: int, hits: int, n_words: int, size: int) -> set[int]:
    """Features of how many distinct words, and how many of all words, are in any lexicon."""
    return {_unit(f"listed {k}", size) for k in LISTED if listed >= k} | {_unit(f"spread {k}", size) for k in SPREAD if listed >= 2 and hits * k >= n_words}


def features(text: str | None, masks, size: int = SIZE) -> np.ndarray:
    """Distinct hashed words, beginnings and lexicons, and the counts of listed words; ``masks`` has the lexicons of a word."""
    every = _WORDS.findall((text or "").lower())
    words = set(every)
    found = {f for w in words for f in word_features(w, masks[w], size)}
    listed = {w for w in words if masks[w]}
    found |= count_features(len(listed), sum(w in listed for w in every), len(every), size)
    return np.array(sorted(found), np.int64)


def score(docs: DataFrame, mined: dict[str, int], weights: tuple[np.ndarray, np.ndarray, float], size: int = SIZE) -> DataFrame:
    """doc_id and score of each row: the logistic function of the sparse dot product with the weights."""
    table, bias = dict(zip(weights[0].tolist(), weights[1].tolist(), strict=True)), weights[2]

    def run(batches):
        import pyarrow as pa

        masks, any_list = Votes(mined).masks, _unit("any", size)

        class Weighed(dict):
            """The features of a word that have a weight, and the mark of words in any lexicon."""

            def __missing__(self, word: str) -> tuple[int, ...]:
                out = tuple(f for f in word_features(word, masks[word], size) if f in table or (f == any_list and masks[word]))
                if len(self) >= _CACHE_WORDS:
                    self.clear()
                self[word] = out
                return out

        weighed = Weighed()
        for batch in batches:
            out = np.empty(batch.num_rows)
            for i, text in enumerate(batch.column(1)):
                every = _WORDS.findall((text.as_py() or "").lower())
                found, listed = set(), set()
                for word in set(every):
                    some = weighed[word]
                    if some:
                        found.update(some)
                        if any_list in some:
                            listed.add(word)
                if len(listed) >= 2:
                    found |= count_features(len(listed), sum(w in listed for w in every), len(every), size)
                out[i] = bias + sum(table.get(f, 0.0) for f in sorted(found))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sigmoid(out))], names=["doc_id", "score"])

    return map_batches(docs.select("doc_id", "text"), run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, score double")


def train(docs: DataFrame, labels: DataFrame, allowed: Column, label: str = "toxic") -> tuple[dict[str, int], LabelModel, tuple[np.ndarray, np.ndarray, float]]:
    """The mined lexicons, the label model of all documents' votes, and the classifier's weights."""
    spark = docs.sparkSession
    both = [labelled_sample(docs, labels, label, allowed & (F.col(label) == y), MINE_ROWS) for y in (1, 0)]
    mined = mine(both[0].union(both[1]))
    cast = written(votes(docs, mined), "votes")
    known = labels.filter(allowed & F.col(label).isin(0, 1)).groupBy(F.col("doc_id").alias("label_id")).agg(F.min(label).cast("int").alias("known"))
    counted = cast.join(known, F.col("doc_id") == F.col("label_id"), "left").groupBy("votes", F.coalesce("known", F.lit(-1)).alias("known")).agg(F.count(F.lit(1)).alias("n"))
    rows = counted.collect()  # 3 * 2 ** 16 at most
    patterns, marks, n = (np.array([r[c] for r in rows], np.int64) for c in ("votes", "known", "n"))
    model = fit_label_model(patterns, n, marks)
    seen = np.unique(patterns)
    posterior = spark.createDataFrame([(int(v), float(p)) for v, p in zip(seen, model.posterior(unpack(seen)), strict=True)], "votes int, posterior double")  # 2 ** 16 rows at most
    marked = cast.filter("doc_id IS NOT NULL").join(F.broadcast(posterior), "votes")
    sides = [marked.filter(side).orderBy(F.xxhash64("doc_id"), "doc_id", "votes").limit(FIT_ROWS) for side in ("posterior >= 0.5", "posterior < 0.5")]
    chosen = sides[0].union(sides[1]).groupBy(F.col("doc_id").alias("label_id")).agg(F.min("posterior").alias("posterior"))
    picked = docs.select("doc_id", "text").join(F.broadcast(chosen), F.col("doc_id") == F.col("label_id"))
    sample = picked.groupBy("label_id").agg(F.min("text").alias("text"), F.min("posterior").alias("posterior"))
    return mined, model, fit_classifier(sample_features(sample, mined).orderBy("label_id").collect())


def sample_features(sample: DataFrame, mined: dict[str, int]) -> DataFrame:
    """label_id, posterior, least hashes and features of each row (label_id, posterior, text)."""

    def run(batches):
        import pyarrow as pa

        masks = Votes(mined).masks
        for batch in batches:
            texts = batch.column(2).to_pylist()
            least = [least_hashes(set(_WORDS.findall((t or "").lower()))) for t in texts]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(least, pa.list_(pa.int64())), pa.array([features(t, masks) for t in texts], pa.list_(pa.int64()))], names=["label_id", "posterior", "least", "at"])

    id_type = sample.schema["label_id"].dataType.simpleString()
    return map_batches(sample.select("label_id", "posterior", "text"), run, f"label_id {id_type}, posterior double, least array<bigint>, at array<bigint>")


def fit_classifier(rows: list) -> tuple[np.ndarray, np.ndarray, float]:
    """Weights from rows of :func:`sample_features`; near copies count once."""
    examples = []
    for i in distinct_texts([r["least"] for r in rows]):
        at, chance = np.array(rows[i]["at"], np.int64), rows[i]["posterior"]
        for y, weight in ((1.0, chance), (0.0, 1 - chance)):
            if weight > 0.01:
                examples.append((at, np.ones(len(at)), y, weight))
    return fit(examples, SIZE, epochs=4, alpha=0.5, l1=4.0, l2=1.0)


def classify(docs: DataFrame, labels: DataFrame, allowed: Column, label: str = "toxic", threshold: float = 0.5) -> DataFrame:
    """doc_id, score and predicted (1 if score >= threshold) of each row, learned from the ids that ``allowed`` allows."""
    mined, _, weights = train(docs, labels, allowed, label)
    return score(docs, mined, weights).withColumn("predicted", (F.col("score") >= threshold).cast("int"))
