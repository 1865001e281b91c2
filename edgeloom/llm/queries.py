"""The queries of this subpackage, with production parameters over whole tables, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from edgeloom.llm.common import crc_fold, table


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents; where a few files would leave most cores idle, their rows are dealt over all cores in turn."""
    docs, cores = table(spark, sf_dir, "documents"), spark.sparkContext.defaultParallelism
    return docs if docs.rdd.getNumPartitions() * 2 > cores else docs.repartition(cores)


def byte_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def piece_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from edgeloom.llm import toxicity

    fold = crc_fold(F.col("doc_id"), 5)
    found = toxicity.classify(documents(spark, sf_dir), table(spark, sf_dir, "labels"), fold != 0)
    return found.select("doc_id", (fold == 0).alias("held_out"), "score", "predicted")


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from edgeloom.llm import quality

    fold = crc_fold(F.col("doc_id"), 5)
    found = quality.classify(documents(spark, sf_dir), table(spark, sf_dir, "labels"), fold != 0)
    return found.select("doc_id", (fold == 0).alias("held_out"), "score", "predicted")


def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    from edgeloom.llm import decontam

    found = decontam.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated")
    )


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    from edgeloom.llm import rules

    found = rules.verdicts(documents(spark, sf_dir), table(spark, sf_dir, "labels"))
    return found.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from edgeloom.llm import packing

    found = packing.pack(documents(spark, sf_dir), byte_vocabulary(), end_id=1, window=2048)
    return found.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


def op6_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    from edgeloom.llm import language

    fold = crc_fold(F.col("doc_id"), 4)
    found = language.identify(documents(spark, sf_dir), piece_vocabulary(), fold != 2)
    return found.select("doc_id", (fold == 2).alias("held_out"), "lang_pred", "score")


def op7_token_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    from edgeloom.llm import tokenfile

    return tokenfile.round_trip(table(spark, sf_dir, "documents"), byte_vocabulary(), end_id=0)


def op8_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    from edgeloom.llm import suffix

    found = suffix.remove_repeats(documents(spark, sf_dir), least=400, least_words=50)
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "n_passages", "n_passage_words")


def op9_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per candidate, with the value as a digest."""
    from edgeloom.llm import secrets

    found = secrets.findings(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.col("at").cast("long").alias("word_index"), F.sha2("value", 256).alias("value_sha256"), F.length("value").cast("long").alias("value_length"), "score", "is_secret")


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    from edgeloom.llm import simhash

    found = simhash.components(documents(spark, sf_dir), shingle=3, radius=3)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op11_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    from edgeloom.llm import clusters

    found, centroids = clusters.kmeans(table(spark, sf_dir, "embeddings"), k=16, rounds=3, dims=64)
    digests = F.array(*[F.lit(clusters.digest(c)) for c in centroids]).cast("array<string>")
    return found.select(F.col("id").alias("vec_id"), "cluster", "distance", F.col("cluster_inertia").cast("long").alias("cluster_inertia"), F.col("inertia").cast("long").alias("inertia"), F.get(digests, F.col("cluster")).alias("centroid_sha256"))


def op12_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    from edgeloom.llm import sharding

    found = sharding.interleave(table(spark, sf_dir, "documents"), shards=40)
    return found.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op13_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    from edgeloom.llm import divergence

    return divergence.audit(documents(spark, sf_dir), least_docs=30, top=50)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_toxicity": op1_toxicity,
    "op2_quality": op2_quality,
    "op3_decontaminate": op3_decontaminate,
    "op4_quality_rules": op4_quality_rules,
    "op5_packing": op5_packing,
    "op6_language": op6_language,
    "op7_token_file": op7_token_file,
    "op8_repeats": op8_repeats,
    "op9_secrets": op9_secrets,
    "op10_simhash": op10_simhash,
    "op11_clusters": op11_clusters,
    "op12_sharding": op12_sharding,
    "op13_divergence": op13_divergence,
}

def _clusters_sql() -> str:
    """Three rounds of plain assignment and means, and a last assignment."""
    parts = [
        """v AS (SELECT row_number() OVER () AS r, vec_id, v FROM (
      SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
      WHERE len(embedding) = 64 AND list_bool_and(list_transform(embedding, lambda x: x IS NOT NULL AND isfinite(x)))))""",
        "x AS (SELECT r, unnest(v) AS x, unnest(range(64)) AS i FROM v)",
        """c0 AS (SELECT c, unnest(v) AS x, unnest(range(64)) AS i FROM (
      SELECT row_number() OVER (ORDER BY sha256('1:' || coalesce(CAST(vec_id AS VARCHAR), '')), v) - 1 AS c, v FROM v) WHERE c < 16)""",
    ]
    for k in range(4):
        parts.append(f"a{k} AS (SELECT r, min(d * 16 + c) AS best FROM (SELECT r, c, CAST(sum((x.x - c{k}.x) * (x.x - c{k}.x)) AS BIGINT) AS d FROM x JOIN c{k} ON x.i = c{k}.i GROUP BY r, c) GROUP BY r)")
        if k < 3:
            parts.append(f"""c{k + 1} AS (SELECT c{k}.c, c{k}.i, coalesce((s - ((s % n) + n) % n) // n, c{k}.x) AS x FROM c{k} LEFT JOIN (
      SELECT best % 16 AS c, i, CAST(sum(x) AS BIGINT) AS s, count(*) AS n FROM a{k} JOIN x ON a{k}.r = x.r GROUP BY best % 16, i) m ON m.c = c{k}.c AND m.i = c{k}.i)""")
    return f"""WITH {", ".join(parts)},
d AS (SELECT c, sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY i)) AS digest FROM c3 GROUP BY c)
SELECT vec_id, CAST(best % 16 AS INTEGER) AS cluster, best // 16 AS distance, CAST(sum(best // 16) OVER (PARTITION BY best % 16) AS BIGINT) AS cluster_inertia,
       CAST(sum(best // 16) OVER () AS BIGINT) AS inertia, digest AS centroid_sha256
FROM a3 JOIN v ON a3.r = v.r JOIN d ON d.c = a3.best % 16"""


_DIVERGENCE_SQL = r"""
WITH d AS (
  SELECT doc_id, row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w
  FROM documents
), t AS (
  SELECT lang, source, r, w, count(*) AS n FROM (SELECT lang, source, r, unnest(w) AS w FROM d) GROUP BY ALL
), kept AS (
  SELECT lang, w FROM t GROUP BY lang, w HAVING count(DISTINCT r) >= 30
), g AS (
  SELECT DISTINCT lang, source FROM d
), c AS (
  SELECT g.lang, g.source, kept.w, CAST(coalesce(sum(t.n), 0) AS HUGEINT) AS n
  FROM g JOIN kept ON g.lang = kept.lang LEFT JOIN t ON t.lang = g.lang AND t.source = g.source AND t.w = kept.w GROUP BY ALL
), l AS (
  SELECT lang, w, CAST(sum(n) AS HUGEINT) AS n FROM c GROUP BY ALL
), p AS (
  SELECT lang, source, w, n, 1 + (1000000000 * (n + 5)) // (CAST(sum(n) OVER (PARTITION BY lang, source) AS HUGEINT) + 5 * count(*) OVER (PARTITION BY lang, source)) AS p FROM c
), q AS (
  SELECT lang, w, 1 + (1000000000 * (n + 5)) // (CAST(sum(n) OVER (PARTITION BY lang) AS HUGEINT) + 5 * count(*) OVER (PARTITION BY lang)) AS q FROM l
), f AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, CAST(coalesce(sum(abs(x.p - y.p)), 0) AS BIGINT) AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source != b.source
  LEFT JOIN p x ON x.lang = a.lang AND x.source = a.source LEFT JOIN p y ON y.lang = b.lang AND y.source = b.source AND y.w = x.w GROUP BY a.lang, a.source, b.source
  UNION ALL
  SELECT p.lang, p.source, 'term', p.w, CAST(p.p - q.q AS BIGINT) FROM p JOIN q ON p.lang = q.lang AND p.w = q.w WHERE p.n > 0 AND p.p > q.q
)
SELECT lang, source, part, item, value, CAST(rank AS INTEGER) AS rank
FROM (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM f) WHERE part = 'pair' OR rank <= 50
"""

#: The checksum goes over bytes with a table made here.
_SHARDING_SQL = r"""
WITH k AS (SELECT list_reduce([CAST(i AS BIGINT), 0, 0, 0, 0, 0, 0, 0, 0], lambda c, j: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END) AS c, i FROM range(256) AS t(i)),
h AS (SELECT list(c ORDER BY i) AS h FROM k),
d AS (
  SELECT doc_id, source, octet_length(encode(coalesce(text, ''))) + 16 AS size, hex(encode(coalesce(text, ''))) AS x, substr(sha256('0:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 32) AS key, h
  FROM documents, h
), s AS (
  SELECT doc_id, source, size, key, xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(regexp_extract_all(x, '..'), lambda b: CAST('0x' || b AS BIGINT))), lambda c, b: xor(c // 256, h[1 + xor(c % 256, b)])), 4294967295) AS text_crc32 FROM d
), r AS (
  SELECT *, (row_number() OVER (PARTITION BY source ORDER BY key, doc_id, text_crc32, size) - CAST(0.5 AS DOUBLE)) / count(*) OVER (PARTITION BY source) AS f FROM s
), o AS (
  SELECT *, row_number() OVER (ORDER BY f, coalesce('=' || source, ''), key, doc_id, text_crc32, size) - 1 AS place, count(*) OVER () AS n FROM r
)
SELECT doc_id, CAST(size AS BIGINT) AS size, text_crc32, 'rows' AS law, CAST(place * 40 // n AS INTEGER) AS shard, CAST(place - (place * 40 // n * n + 39) // 40 AS BIGINT) AS slot, CAST(NULL AS INTEGER) AS grown_shard FROM o
"""

ORACLES: dict[str, str] = {
    "op3_decontaminate": r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents
), b AS (
  SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark
), g AS (
  SELECT DISTINCT item, least(len(w), 10) AS n, array_to_string(w[i + 1 : i + least(len(w), 10)], ' ') AS gram
  FROM (SELECT item, w, unnest(range(0, greatest(len(w) - 10, 0) + 1)) AS i FROM b WHERE len(w) > 0)
), p AS (
  SELECT doc_id, n, i, array_to_string(w[i + 1 : i + n], ' ') AS gram
  FROM (SELECT doc_id, w, n, unnest(range(0, len(w) - n + 1)) AS i FROM d, (SELECT DISTINCT n FROM g) WHERE len(w) >= n)
), h AS (
  SELECT p.doc_id, p.i, p.n, g.item FROM p JOIN g ON p.gram = g.gram
), c AS (
  SELECT doc_id, count(DISTINCT k) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS k FROM h) GROUP BY doc_id
), t AS (
  SELECT doc_id, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS items FROM h GROUP BY doc_id
)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(c.n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(t.n_items, 0) AS BIGINT) AS n_items,
       sha256(coalesce(t.items, '')) AS items_sha256, coalesce(c.n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN c ON d.doc_id = c.doc_id LEFT JOIN t ON d.doc_id = t.doc_id
""",
    "op11_clusters": _clusters_sql(),
    "op12_sharding": _SHARDING_SQL,
    "op13_divergence": _DIVERGENCE_SQL,
}
