"""Operators 11 to 13 against plain versions, on awkward tables."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from edgeloom.llm import clusters, divergence, queries, sharding
from tests.compare import connection, same
from tests.llm import cases

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", ["op11_clusters", "op12_sharding", "op13_divergence"])
def test_queries_match_sql(spark, name):
    same(queries.QUERIES[name](spark, SF).toPandas(), connection(SF).sql(queries.ORACLES[name]).df())


# clusters


def plain_kmeans(rows, k, rounds, dims, scale=64, seed=1):
    kept = [(i, tuple(math.floor(scale * x) for x in v)) for i, v in rows if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v)]
    start = sorted((hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest(), v) for i, v in kept)
    centroids = [v for _, v in start[:k]]

    def nearest():
        return [min((sum((a - b) ** 2 for a, b in zip(v, c, strict=True)), j) for j, c in enumerate(centroids)) for _, v in kept]

    for _ in range(rounds):
        found = nearest()
        for j in range(len(centroids)):
            of = [v for (_, v), (_, c) in zip(kept, found, strict=True) if c == j]
            if of:
                centroids[j] = tuple(sum(x) // len(of) for x in zip(*of, strict=True))
    found = nearest()
    by = Counter()
    for d, j in found:
        by[j] += d
    return sorted(((i, j, d, by[j], sum(by.values())) for (i, _), (d, j) in zip(kept, found, strict=True)), key=repr), centroids


def vectors(kind):
    rng = random.Random(kind)
    if kind == "ties":  # few places, each many times, and ids twice
        rows = [(i // 2, [rng.choice([-1.0, 0.0, 0.5]) for _ in range(3)]) for i in range(200)]
    elif kind == "few":
        rows = [(1, [1.0, 2.0, 3.0]), (None, [1.0, 2.0, 3.0]), (3, [-1.5, 2.0, 3.0])]
    elif kind == "wide":  # too wide for products of doubles to be exact
        rows = [(i, [rng.uniform(-(2.0**23), 2.0**23) for _ in range(3)]) for i in range(150)]
    else:
        rows = [(i, [rng.gauss(3 * (i % 7), 0.4) for _ in range(3)]) for i in range(400)]
    return rows + [(900, None), (901, []), (902, [1.0, 2.0]), (903, [1.0, None, 2.0]), (904, [math.nan, 0.0, 0.0]), (905, [math.inf, 0.0, 0.0]), (906, [0.0, -math.inf, 0.0])]


@pytest.mark.parametrize("kind", ["ties", "few", "wide", "clusters"])
@pytest.mark.parametrize("k", [1, 9])
def test_clusters_match_plain_rounds(spark, kind, k):
    rows = vectors(kind)
    df = spark.createDataFrame([(i, v, "clash", "clash", "clash") for i, v in rows], "vec_id bigint, embedding array<double>, cluster string, upper string, v string")
    found, centroids = clusters.kmeans(df, k=k, rounds=4, dims=3)
    want, at = plain_kmeans(rows, k, 4, 3)
    assert sorted((tuple(r) for r in found.collect()), key=repr) == want
    assert [tuple(map(int, c)) for c in centroids] == at


def test_clusters_of_nothing_and_of_too_much(spark):
    schema = "vec_id bigint, embedding array<float>"
    found, centroids = clusters.kmeans(spark.createDataFrame([(1, None)], schema), k=4, rounds=2, dims=3)
    assert found.collect() == [] and len(centroids) == 0
    with pytest.raises(Exception, match="or more"):
        clusters.kmeans(spark.createDataFrame([(1, [1e30, 0.0, 0.0])], schema), k=4, rounds=2, dims=3)


def test_bounds_settle_most_and_balls_leave_centroids_out():
    rng = np.random.default_rng(3)
    c = clusters.Centroids(rng.integers(-3000, 3000, (200, 4)))
    x = c.at[rng.integers(0, 200, 5000)] + rng.integers(-60, 60, (5000, 4))
    cluster, upper, lower, taken = clusters.assign(x, c)
    assert taken == 5000 * 200
    c = c.next(c.at + rng.integers(-40, 40, c.at.shape))
    found, upper, lower, taken = clusters.assign(x, c, cluster, upper, lower)
    squared = clusters.squared_distances(x, c.at)
    assert (found == squared.argmin(1)).all()
    assert (upper**2 >= squared.min(1)).all() and (lower <= np.sqrt(np.sort(squared, 1)[:, 1])).all()
    assert taken < 5000 * 10


# shards


def shards_of(found):
    by = defaultdict(list)
    for r in found:
        by[r["shard"]].append(r)
    return by


@pytest.mark.parametrize("ranges", [256, 3])
def test_shards_hold_the_mixture(spark, monkeypatch, ranges):
    monkeypatch.setattr(sharding, "RANGE_ROWS", ranges)
    rng = random.Random(4)
    rows = [(i if i % 10 else None, rng.choice([None, "", "é" * 3, "same", f"text {i}"]), None, "hot" if i % 3 == 0 else rng.choice(["a", "b", "", None]), 1) for i in range(2003)]
    found = sharding.interleave(spark.createDataFrame([(*r, "x", "x") for r in rows], "doc_id bigint, text string, lang string, source string, n_chars int, shard string, span string"), 40, seed=7).collect()
    assert sorted((repr((r["doc_id"], r["stratum"], r["size"], r["text_crc32"])) for r in found)) == sorted(repr((i, s, 16 + len((t or "").encode()), zlib.crc32((t or "").encode()))) for i, t, _, s, _ in rows)
    by = shards_of(found)
    assert sorted(by) == list(range(40)) and {len(v) for v in by.values()} <= {50, 51}
    whole = Counter(r["stratum"] for r in found)
    for held in by.values():
        assert sorted(r["slot"] for r in held) == list(range(len(held)))
        for stratum, n in Counter(r["stratum"] for r in held).items():
            assert abs(n - whole[stratum] / 40) <= len(whole)
    again = sharding.interleave(spark.createDataFrame(rows[::-1], "doc_id bigint, text string, lang string, source string, n_chars int").repartition(7), 40, seed=7).collect()
    assert sorted(map(repr, map(tuple, again))) == sorted(map(repr, map(tuple, found)))
    other = sharding.interleave(spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars int"), 40, seed=8).collect()
    assert sorted(map(repr, map(tuple, other))) != sorted(map(repr, map(tuple, found)))


def test_shards_of_awkward_documents(spark):
    found = sharding.interleave(cases.documents(spark), 3).collect()
    assert Counter(len(v) for v in shards_of(found).values()) == Counter(len(found) // 3 + (i < len(found) % 3) for i in range(3))
    assert sharding.interleave(cases.empty(spark), 3).collect() == []
    few = sharding.interleave(cases.documents(spark, rows=[(1, "a", None, "s", 1), (1, "a", None, "s", 1)], extra=False), 40).collect()
    assert sorted(r["shard"] for r in few) == [0, 20] and {r["slot"] for r in few} == {0}


# divergence


def plain_audit(rows, least_docs, top):
    split = lambda t: re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    n, held, groups = defaultdict(Counter), defaultdict(Counter), set()
    for _, text, lang, source, *_ in rows:
        lang, source, w = lang or "", source or "", split(text)
        groups.add((lang, source))
        n[lang, source].update(w)
        held[lang].update(set(w))
    out = []
    for lang in {g[0] for g in groups}:
        kept = [t for t, d in held[lang].items() if d >= least_docs]
        names = sorted(s for x, s in groups if x == lang)
        whole = sum((n[lang, s] for s in names), Counter())
        share = lambda c: {t: 1 + 10**9 * (c[t] + 5) // (sum(c[u] for u in kept) + 5 * len(kept)) for t in kept}
        p, q = {s: share(n[lang, s]) for s in names}, share(whole)
        for s in names:
            pair = sorted((-sum(abs(p[s][t] - p[h][t]) for t in kept), h.encode()) for h in names if h != s)
            term = sorted((q[t] - p[s][t], t.encode()) for t in kept if n[lang, s][t] and p[s][t] > q[t])[:top]
            out += [(lang, s, part, item.decode(), -v, i + 1) for part, found in (("pair", pair), ("term", term)) for i, (v, item) in enumerate(found)]
    return sorted(out)


def audited(df, **given):
    return sorted(tuple(r) for r in divergence.audit(df, **given).select("lang", "source", "part", "item", "value", "rank").collect())


def corpus(n=400):
    rng = random.Random(9)
    common, rare = [f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(60)], ["éé", "日本", "Big", "x" * 5000]
    rows = []
    for i in range(n):
        source = "hot" if i % 3 == 0 else rng.choice(["a", "b", "c", None, ""])
        lean = common[: 30 + 10 * (hash_of(source) % 3)]
        words = [rng.choice(lean) for _ in range(rng.randint(0, 30))] + [w for w in rare if rng.random() < 0.1]
        rows.append((i, rng.choice([None, "", " ", "-".join(words)]) if i % 9 == 0 else "; ".join(words).title(), rng.choice(["en", "de", None, ""]) if i % 5 else "tiny", source, 0))
    return rows + rows[:20] + [(None, "only here", "alone", "one", 0), (None, None, "mute", "one", 0), (None, "", "mute", "two", 0)]


def hash_of(s):
    return zlib.crc32((s or "").encode())


@pytest.mark.parametrize("least,top", [(1, 5), (12, 50), (10_000, 3)])
def test_audit_matches_plain_counts(spark, least, top):
    rows = corpus()
    df = spark.createDataFrame([(*r, "x", 1, "y") for r in rows], "doc_id bigint, text string, lang string, source string, n_chars int, term string, value int, col string")
    assert audited(df, least_docs=least, top=top) == plain_audit(rows, least, top)


def test_audit_in_small_slices(spark, monkeypatch):
    monkeypatch.setattr(divergence, "_SLICE_BYTES", 100)
    monkeypatch.setattr(divergence, "_PAIR_CELLS", 4)
    rows = corpus(150)
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars int")
    assert audited(df, least_docs=2, top=9) == plain_audit(rows, 2, 9)


def test_audit_of_awkward_documents(spark):
    df = cases.documents(spark)
    rows = [(r["doc_id"], r["text"], r["lang"], r["source"]) for r in df.collect()]
    assert audited(df, least_docs=2, top=50) == plain_audit(rows, 2, 50)
    assert audited(cases.empty(spark), least_docs=2) == []


def test_shares_of_counts_beyond_doubles():
    n, bottom = np.array([0, 3, 2**40, 2**52 + 1], dtype=np.int64), np.array([2**53 + 7] * 4, dtype=np.int64)
    assert divergence.shares(n, bottom).tolist() == [1 + (int(x) + 5) * 10**9 // (2**53 + 7) for x in n]
