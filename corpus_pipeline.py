"""From raw documents to packed sequences: each stage's result is written as Parquet and read by the next.

A run deletes what it has made once nothing of it reads that any more: a stage's intermediate tables when its result is
written, and that result when the next one is.  What the last stage's result reads stays with it, and one run knows nothing
of another.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from edgeloom.llm import decontam, packing, rules, secrets, simhash
from edgeloom.llm.common import table, written
from edgeloom.llm.queries import byte_vocabulary
from edgeloom.sources.shared import forget_paths, noted


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rules whose false rejections are bounded; the base rules have no bound (they reject 3 % of good documents at sf0.1)."""
    return rules.keep_good(docs, table(spark, sf_dir, "labels"), base=False)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of five-word-shingle similarity of 0.8 or more: the smallest id; null is an id and comes last."""
    return simhash.keep_one_similar(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no window of the benchmark; null text holds none."""
    return decontam.keep_clean(docs, table(spark, sf_dir, "benchmark"))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, secrets in its text replaced; null and empty texts stay as they are."""
    return secrets.redact(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The training sequences: sequence_id, n_tokens, ids (padded to 2048 with id 0, except at a power of two) and where each piece comes from."""
    packed = packing.pack(docs, byte_vocabulary(), end_id=1, window=2048, keep_ids=True)
    return packing.sequences(packed, window=2048, pad_id=0)


STAGES = [
    ("quality rules", quality),
    ("SimHash near-dedup", near_duplicates),
    ("benchmark decontamination", decontaminate),
    ("secret scans", redact_secrets),
    ("packing", pack),
]

#: No stage but decontamination can be said in SQL (tokenizer, exact binomial cutoffs, XXH64, a trained forest).
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, before = table(spark, sf_dir, "documents"), []
    for name, stage in STAGES[:-1]:
        with noted() as made:
            docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-").lower())
        forget_paths(spark, before + made[:-1])
        before = made[-1:]
    return STAGES[-1][1](spark, docs, sf_dir)
