"""A quality classifier: hashed word n-grams, logistic regression by follow-the-regularised-leader updates.

A text's words are its runs of letters and digits, lower-cased, and its runs of other signs.  Its features are
hashed counts of words and word pairs, and of three stand-in words: one for a word in capitals, one for a word that
repeats the one before, one for a line break.  Counts are scaled to unit length, and a score is the logistic function
of their sparse dot product with the weights.

The weights are fitted on the driver from at most ``FIT_ROWS`` labelled documents, those with the least hashes of
their ids; executors make the features, so no text goes to the driver.  Every document is scored by its whole text.
Defined cases: null and empty text have no features and get the bias alone; a null id has no label and is scored like
any other; without labels every score is 0.5; with conflicting labels of one id the least counts; repeated rows each get
a score; extra columns are ignored.
"""

from __future__ import annotations

import re
import zlib

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from edgeloom.llm.common import map_batches
from edgeloom.llm.ftrl import dense, fit, sigmoid

SIZE = 1 << 20
#: Labelled documents that the classifier is fitted on, at most.
FIT_ROWS = 4000
_WORDS = re.compile(r"\w+|[^\w\s]+|\n")
_MIX = np.uint64(0x9E3779B97F4A7C15)
_CACHE_WORDS = 300_000


class _Hashes(dict):
    """Hash of a word as it counts, with the lowest bit set for a word in capitals."""

    def __missing__(self, word: str) -> int:
        low = word.lower()
        code = (zlib.crc32(low.encode("utf-8", "surrogatepass")) << 1) | (len(word) > 2 and word != low and word == word.upper())
        if len(self) >= _CACHE_WORDS:
            self.clear()
        self[word] = code
        return code


_hashes = _Hashes()
_STAND_INS = {name: np.uint64(zlib.crc32(f"\x00{name}".encode())) for name in ("capitals", "again")}


def features(text: str | None, size: int = SIZE) -> tuple[np.ndarray, np.ndarray]:
    """Distinct feature numbers and values of unit length."""
    found = _WORDS.findall(text or "")
    if not found:
        return np.zeros(0, np.int64), np.zeros(0)
    codes = np.fromiter(map(_hashes.__getitem__, found), dtype=np.uint64, count=len(found))
    h = codes >> np.uint64(1)
    capitals, again = int((codes & np.uint64(1)).sum()), int((h[1:] == h[:-1]).sum())
    pairs = (h[:-1] * _MIX + h[1:]) * _MIX >> np.uint64(24)
    extra = np.array([_STAND_INS["capitals"]] * capitals + [_STAND_INS["again"]] * again, np.uint64)
    at, n = np.unique(np.concatenate([h, pairs, extra]) % np.uint64(size), return_counts=True)
    return at.astype(np.int64), n / np.sqrt((n.astype(np.float64) ** 2).sum())


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, allowed: Column, most: int) -> DataFrame:
    """label_id, label and text of at most ``most`` labelled ids, those with the least hashes; ``allowed`` is over ``doc_id``."""
    ids = labels.filter(allowed & F.col(label).isin(0, 1)).groupBy("doc_id").agg(F.min(label).cast("int").alias("label")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
    chosen = ids.select(F.col("doc_id").alias("label_id"), "label")
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), F.col("doc_id") == F.col("label_id"))  # ``most`` rows at most
    # repeated rows of an id would lift the bound, so one of each id is taken
    return rows.groupBy("label_id").agg(F.min("text").alias("text"), F.min("label").alias("label"))


def sample_features(sample: DataFrame, size: int = SIZE) -> DataFrame:
    """label_id, label, at and x of each row of a labelled sample."""

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            found = [features(t.as_py(), size) for t in batch.column(2)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array([a for a, _ in found], pa.list_(pa.int64())), pa.array([x for _, x in found], pa.list_(pa.float64()))], names=["label_id", "label", "at", "x"])

    return map_batches(sample.select("label_id", "label", "text"), run, f"label_id {sample.schema['label_id'].dataType.simpleString()}, label int, at array<bigint>, x array<double>")


def score(docs: DataFrame, weights: tuple[np.ndarray, np.ndarray, float], size: int = SIZE) -> DataFrame:
    """doc_id and score of each row."""
    at, w, bias = weights

    def run(batches):
        import pyarrow as pa

        table = dense(at, w, size)
        for batch in batches:
            out = np.empty(batch.num_rows)
            for i, text in enumerate(batch.column(1)):
                where, x = features(text.as_py(), size)
                out[i] = table[where] @ x + bias
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sigmoid(out))], names=["doc_id", "score"])

    return map_batches(docs.select("doc_id", "text"), run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, score double")


def train(docs: DataFrame, labels: DataFrame, allowed: Column, label: str = "quality", most: int = FIT_ROWS, size: int = SIZE) -> tuple[np.ndarray, np.ndarray, float]:
    rows = sample_features(labelled_sample(docs, labels, label, allowed, most), size).orderBy("label_id").collect()
    examples = [(np.array(r["at"], np.int64), np.array(r["x"], np.float64), float(r["label"]), 1.0) for r in rows]
    return fit(examples, size, epochs=3, alpha=0.8, l1=0.2, l2=0.1)


def classify(docs: DataFrame, labels: DataFrame, allowed: Column, label: str = "quality", threshold: float = 0.3) -> DataFrame:
    """doc_id, score and predicted (1 if score >= threshold) of each row, learned from the ids that ``allowed`` allows."""
    return score(docs, train(docs, labels, allowed, label)).withColumn("predicted", (F.col("score") >= threshold).cast("int"))
