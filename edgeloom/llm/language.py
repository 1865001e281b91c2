"""Language identification by segmentation-marginalised unigrams.

The pieces are those of a fixed public vocabulary; each language has a probability for each piece.  A word (with the
vocabulary's word mark before it) may be cut into pieces in many ways; a forward pass sums the probabilities of all of
them.  A text's log-likelihood in a language is the sum over its words, and the posterior over languages is the score.
Probabilities are fitted by expectation maximisation: a forward-backward pass counts each piece by the share of
segmentations that use it.

Words of equal length go through the passes together as arrays, and a worker keeps the words it has seen (bounded).
Runs of over ``TOGETHER`` letters, as scripts without blanks have, go one by one through the same passes in logarithms, so
that no product of probabilities is too small; no run is cut, whatever its length.  Fitting takes at most ``FIT_DOCS``
texts per language, those with the least hashes, as counts of words made on executors; prediction reads every whole text.

Defined cases: null text and text without a letter are ``und`` with score 0; rows with null language teach nothing;
without any language to learn every text is ``und``; a null id is predicted like any other; repeated rows teach once and
each get a prediction; extra columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from edgeloom.llm.common import map_batches

#: Texts per language that probabilities are fitted on, at most.
FIT_DOCS = 250
ROUNDS = 3
#: Letters of the longest words that go through the passes together, few enough for products of probabilities.
TOGETHER = 40
#: Places of a long run whose pieces are looked up at a time.
_PLACES = 1 << 14
MARK = "▁"
_LETTERS = re.compile(r"[^\W\d_]+")
_CACHE_WORDS = 300_000
_PART_CHARS = 2_000_000


def vocabulary(model_path: str) -> list[str]:
    """The pieces of a sentencepiece model that are text."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=model_path)
    ids = (i for i in range(model.get_piece_size()) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i)))
    return sorted({p for p in map(model.id_to_piece, ids) if p.lower() == p})


def text_words(text: str | None) -> list[str]:
    """Runs of letters, lower-cased."""
    return _LETTERS.findall((text or "").lower())


class Pieces:
    """Finds vocabulary pieces in many words at once, in a hash table of the pieces and all their beginnings.

    Spans are told apart by 64-bit hashes of their code points; a false match has odds of about 2 ** -47 per span.
    """

    BASE, SLOTS = np.uint64(0x9E3779B97F4A7C15), 1 << 20

    def __init__(self, pieces: list[str]):
        self.n, self.longest = len(pieces), max(map(len, pieces), default=1)
        known: dict[int, int] = {}
        mask, base = 0xFFFFFFFFFFFFFFFF, int(self.BASE)
        for i, p in enumerate(pieces):
            h = 0
            for k, c in enumerate(p):
                h = ((h + ord(c) + 1) * base) & mask
                if k + 1 == len(p):
                    if known.get(h, self.n) != self.n:
                        raise ValueError("two pieces share a hash")
                    known[h] = i
                else:
                    known.setdefault(h, self.n)
        self.codes = np.fromiter(known, np.uint64, len(known))
        self.ids = np.fromiter(known.values(), np.int64, len(known))
        self.slots = np.full(self.SLOTS + 64, -1, np.int32)
        self.probes = 1
        for e, at in enumerate((self.codes >> np.uint64(44)).tolist()):
            start = at
            while self.slots[at] >= 0:
                at += 1
            self.slots[at] = e
            self.probes = max(self.probes, at - start + 1)

    def find(self, h: np.ndarray) -> np.ndarray:
        """The entry of each hash, or -1."""
        at = (h >> np.uint64(44)).astype(np.int64)
        out = self.slots[at]
        out = np.where(self.codes[out] == h, out, -1)
        for k in range(1, self.probes):
            left = np.flatnonzero(out < 0)
            entry = self.slots[at[left] + k]
            hit = (entry >= 0) & (self.codes[entry] == h[left])
            out[left[hit]] = entry[hit]
        return out

    def lattice(self, words: list[str]) -> list[tuple[int, int, np.ndarray, np.ndarray]]:
        """For words of one length: (start, end, which words, piece numbers) of each span; ``n + 1`` is an unknown letter."""
        length = len(words[0]) + 1
        points = np.frombuffer("".join(MARK + w for w in words).encode("utf-32-le", "surrogatepass"), "<u4").reshape(-1, length).T.astype(np.uint64) + np.uint64(1)
        spans, everyone = [], np.arange(len(words))
        for start in range(length):
            rows, h = everyone, np.zeros(len(words), np.uint64)
            for end in range(start + 1, length + 1):
                h = (h + points[end - 1, rows]) * self.BASE
                entry = self.find(h)
                ids = np.where(entry >= 0, self.ids[entry], self.n)
                if end == start + 1:
                    spans.append((start, end, rows, np.where(ids == self.n, self.n + 1, ids)))
                elif (hit := ids != self.n).any():
                    spans.append((start, end, rows[hit], ids[hit]))
                alive = entry >= 0
                if not alive.all():
                    rows, h = rows[alive], h[alive]
                if not len(rows):
                    break
        return spans


    def places(self, word: str):
        """For blocks of places of a word: the first place, and the piece number of each span by place and length (``n`` for none, ``n + 1`` for an unknown letter)."""
        points = np.frombuffer((MARK + word).encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64) + np.uint64(1)
        for base in range(0, len(points), _PLACES):
            rows = np.arange(base, min(base + _PLACES, len(points)))
            ids, h, first = np.full((len(rows), self.longest), self.n, np.int64), np.zeros(len(rows), np.uint64), base
            for k in range(self.longest):
                inside = rows + k < len(points)
                rows, h = rows[inside], h[inside]
                if not len(rows):
                    break
                h = (h + points[rows + k]) * self.BASE
                entry = self.find(h)
                found = np.where(entry >= 0, self.ids[entry], self.n)
                ids[rows - first, k] = np.where(found == self.n, self.n + 1, found) if k == 0 else found
                rows, h = rows[entry >= 0], h[entry >= 0]
            yield base, ids


def by_length(words) -> list[list[str]]:
    groups: dict[int, list[str]] = {}
    for w in words:
        groups.setdefault(len(w), []).append(w)
    return list(groups.values())


def forward(spans, length: int, n: int, table: np.ndarray) -> np.ndarray:
    """alpha[t]: the summed probability of all segmentations of the first t letters; ``table`` is pieces by languages."""
    alpha = np.zeros((length + 1, n, table.shape[1]))
    alpha[0] = 1.0
    for start, end, rows, ids in spans:
        if len(rows) == n:
            alpha[end] += alpha[start] * table[ids]
        else:
            alpha[end][rows] += alpha[start][rows] * table[ids]
    return alpha


def expected_counts(spans, length: int, counts: np.ndarray, table: np.ndarray) -> np.ndarray:
    """How often each piece is used, over all segmentations, for one language (``table`` has one column)."""
    alpha = forward(spans, length, len(counts), table)[:, :, 0]
    beta = np.zeros_like(alpha)
    beta[length] = 1.0
    p = table[:, 0]
    for start, end, rows, ids in reversed(spans):
        beta[start][rows] += p[ids] * beta[end][rows]
    used = np.zeros(len(p))
    scale = counts / np.maximum(alpha[length], 1e-300)
    for start, end, rows, ids in spans:
        used += np.bincount(ids, alpha[start][rows] * p[ids] * beta[end][rows] * scale[rows], len(p))
    return used


def log_forward(word: str, pieces: Pieces, logs: np.ndarray) -> np.ndarray:
    """Logarithms of :func:`forward`'s last row, for one word of any length; ``logs`` is that of the table."""
    pending = np.full((pieces.longest + 1, logs.shape[1]), -np.inf)  # sums that reach the places after this one
    pending[0] = 0.0
    for _, ids in pieces.places(word):
        for row in ids:
            spans = np.flatnonzero(row != pieces.n)
            here = pending[0]
            pending = np.concatenate([pending[1:], np.full((1, logs.shape[1]), -np.inf)])
            pending[spans] = np.logaddexp(pending[spans], here + logs[row[spans]])
    return pending[0]


def log_expected_counts(word: str, count: float, pieces: Pieces, logs: np.ndarray) -> np.ndarray:
    """:func:`expected_counts` of one word of any length; ``logs`` has one column."""
    ids = np.concatenate([x for _, x in pieces.places(word)])
    n, p, longest = len(ids), logs[:, 0], pieces.longest
    alpha, beta = np.full(n + longest + 1, -np.inf), np.full(n + longest + 1, -np.inf)
    alpha[0], beta[n] = 0.0, 0.0
    spans = [np.flatnonzero(row != pieces.n) for row in ids]
    for t in range(n):
        ends = t + 1 + spans[t]
        alpha[ends] = np.logaddexp(alpha[ends], alpha[t] + p[ids[t, spans[t]]])
    for t in range(n - 1, -1, -1):
        beta[t] = np.logaddexp.reduce(p[ids[t, spans[t]]] + beta[t + 1 + spans[t]])
    starts = np.repeat(np.arange(n), [len(x) for x in spans])
    lengths = np.concatenate(spans)
    used = ids[starts, lengths]
    return np.bincount(used, count * np.exp(alpha[starts] + p[used] + beta[starts + 1 + lengths] - alpha[n]), len(p))


def fit(words: dict[str, dict[str, int]], pieces: Pieces, rounds: int = ROUNDS) -> tuple[list[str], np.ndarray]:
    """The languages, and the probability of each piece (and of an unknown letter) in each, from counts of words."""
    languages = sorted(words)
    table = np.zeros((pieces.n + 2, len(languages)))
    for k, language in enumerate(languages):
        counted = words[language]
        long = sorted(w for w in counted if len(w) > TOGETHER)
        groups = [(pieces.lattice(g), len(g[0]) + 1, np.array([counted[w] for w in g], np.float64)) for g in by_length(w for w in counted if len(w) <= TOGETHER)]
        p = np.full((pieces.n + 2, 1), 1.0 / (pieces.n + 2))
        p[pieces.n] = 0
        for _ in range(rounds):
            used = sum((expected_counts(*g, p) for g in groups), np.zeros(pieces.n + 2))
            with np.errstate(divide="ignore"):
                logs = np.log(p)
            for w in long:
                used += log_expected_counts(w, counted[w], pieces, logs)
            used[pieces.n] = 0
            p[:, 0] = (used + 0.05) / (used.sum() + 0.05 * (pieces.n + 1))
            p[pieces.n] = 0
        table[:, k] = p[:, 0]
    return languages, table


class Scorer:
    """Log-likelihoods of words by language, kept between texts."""

    def __init__(self, pieces: Pieces, table: np.ndarray):
        self.pieces, self.table = pieces, table
        with np.errstate(divide="ignore"):
            self.logs = np.log(table)
        self.forget()

    def forget(self) -> None:
        self.at: dict[str, int] = {}
        self.rows = [np.zeros((0, self.table.shape[1]))]

    def learn(self, words: set[str]) -> None:
        if len(self.at) > _CACHE_WORDS:
            self.forget()
        for group in by_length(words - self.at.keys()):
            for i in range(0, len(group), 4096):
                part = group[i : i + 4096]
                length = len(part[0]) + 1
                total = forward(self.pieces.lattice(part), length, len(part), self.table)[length]
                for w in part:
                    self.at[w] = len(self.at)
                self.rows.append(np.log(np.maximum(total, 1e-300)))
        if len(self.rows) > 1:
            self.rows = [np.concatenate(self.rows)]

    def texts(self, texts: list[list[str]]) -> list[np.ndarray]:
        """The log-likelihoods of each text's words, by language."""
        self.learn({w for words in texts for w in words if len(w) <= TOGETHER})
        rows, find, out = self.rows[0], self.at.__getitem__, []
        for words in texts:
            short = [w for w in words if len(w) <= TOGETHER]
            total = rows[np.fromiter(map(find, short), np.int64, len(short))].sum(0)
            for w, n in Counter(w for w in words if len(w) > TOGETHER).items() if len(short) < len(words) else ():
                total = total + n * log_forward(w, self.pieces, self.logs)
            out.append(total)
        return out


def predict(docs: DataFrame, model_path: str, languages: list[str], table: np.ndarray) -> DataFrame:
    """doc_id, lang_pred and score of each row."""

    def run(batches):
        import pyarrow as pa

        scorer = Scorer(Pieces(vocabulary(model_path)), table) if languages else None
        for batch in batches:
            names, scores, held, size = [], [], [], 0

            def flush():
                for words, total in zip(held, scorer.texts(held) if scorer else held, strict=True):
                    if scorer is None or not any(c.isalpha() for w in words for c in w):  # number signs such as ½ count as words
                        names.append("und")
                        scores.append(0.0)
                        continue
                    total = total * min(1.0, 30.0 / len(words))
                    p = np.exp(total - total.max())
                    names.append(languages[int(p.argmax())])
                    scores.append(float(p.max() / p.sum()))
                held.clear()

            for text in batch.column(1):
                text = text.as_py()
                held.append(text_words(text))
                size += len(text or "")
                if size > _PART_CHARS:
                    flush()
                    size = 0
            flush()
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(names, pa.string()), pa.array(scores, pa.float64())], names=["doc_id", "lang_pred", "score"])

    return map_batches(docs.select("doc_id", "text"), run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, lang_pred string, score double")


def _word_counts(texts: DataFrame) -> DataFrame:
    """language, word and how often it occurs."""

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            for language, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                found = Counter(text_words(text))
                yield pa.RecordBatch.from_arrays([pa.array([language] * len(found), pa.string()), pa.array(list(found), pa.string()), pa.array(list(found.values()), pa.int64())], names=["language", "word", "n"])

    return map_batches(texts.select("language", "text"), run, "language string, word string, n long").groupBy("language", "word").agg(F.sum("n").alias("n"))


def train(docs: DataFrame, model_path: str, allowed: Column, per_language: int = FIT_DOCS) -> tuple[list[str], np.ndarray]:
    """Fits on rows that ``allowed`` allows: at most ``per_language`` texts of each language, those with the least hashes; copies are one text."""
    usable = docs.select("doc_id", "text", F.col("lang").cast("string").alias("language"), F.xxhash64("text").alias("text_key")).filter(allowed & F.col("language").isNotNull() & F.col("text").isNotNull())
    first = Window.partitionBy("language").orderBy(F.xxhash64("text_key"))
    keys = usable.select("language", "text_key").distinct().withColumn("nth", F.row_number().over(first)).filter(F.col("nth") <= per_language)
    chosen = keys.select(F.col("language").alias("chosen_language"), F.col("text_key").alias("chosen_key"))
    texts = usable.join(chosen, (F.col("language") == F.col("chosen_language")) & (F.col("text_key") == F.col("chosen_key"))).groupBy("language", "text_key").agg(F.first("text").alias("text"))
    pieces, words = Pieces(vocabulary(model_path)), {}
    for r in _word_counts(texts).orderBy("language", "word").collect():
        words.setdefault(r["language"], {})[r["word"]] = r["n"]
    return fit(words, pieces) if words else ([], np.zeros((pieces.n + 2, 0)))


def identify(docs: DataFrame, model_path: str, allowed: Column) -> DataFrame:
    """doc_id, lang_pred and score of each row, learned from the rows that ``allowed`` allows."""
    languages, table = train(docs, model_path, allowed)
    return predict(docs, model_path, languages, table)
