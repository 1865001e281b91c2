"""Each stage of the pipeline against brute force, on the awkward rows, one after the other as they run."""

from collections import Counter

import pytest

pytest.importorskip("edgeloom.llm")
from edgeloom.llm import tokens  # noqa: E402
from edgeloom.llm.queries import byte_vocabulary  # noqa: E402
from tests.llm import cases  # noqa: E402


@pytest.fixture(scope="module")
def pipeline():
    import corpus_pipeline

    return corpus_pipeline


def _tables(spark, folder, docs):
    docs.write.parquet(f"{folder}/documents.parquet")
    cases.labels(spark).write.parquet(f"{folder}/labels.parquet")
    cases.benchmark(spark).write.parquet(f"{folder}/benchmark.parquet")
    return str(folder)


def _shingles(text):
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    return frozenset(tuple(words[i : i + 5]) for i in range(len(words) - 4)) if len(words) >= 5 else frozenset([tuple(words)] if words else [])


def _near_groups(texts):
    """The group of each text: chains of a similarity of 0.8 or more."""
    sets, root = [_shingles(t) for t in texts], list(range(len(texts)))

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if a == b or (a | b and len(a & b) >= 0.8 * len(a | b)):
                root[top(i)] = top(j)
    return [top(i) for i in range(len(texts))]


def test_stages_one_by_one(spark, tmp_path, pipeline):
    from pyspark.sql import functions as F

    prose = cases.prose(80, 60)
    near = prose.split()
    near[40] = "changed"
    more = spark.createDataFrame([(i, t, "en", "s", 0, *["clash"] * len(cases.CLASHES)) for i, t in ((100, prose), (101, " ".join(near)), (102, prose + " a b"), (103, cases.prose(20_000, 61)), (104, "x" * 1_500_000))], cases.SCHEMA)
    docs = cases.documents(spark).union(more).repartition(4)
    folder = _tables(spark, tmp_path, docs)
    assert [name for name, _ in pipeline.STAGES] == ["quality rules", "SimHash near-dedup", "benchmark decontamination", "secret scans", "packing"]
    rows, held = [tuple(r) for r in docs.collect()], docs
    names, (id_at, text_at) = docs.columns, (0, 1)
    keys = {r["text"]: r["k"] for r in docs.select("text", F.xxhash64("text").alias("k")).collect()}
    order = lambda r: (r[id_at] is None, r[id_at] or 0, keys[r[text_at]])
    for name, stage in pipeline.STAGES[:-1]:
        found = stage(spark, held, folder)
        assert found.columns == names and [f.dataType for f in found.schema] == [f.dataType for f in docs.schema]
        found.write.parquet(f"{tmp_path}/{name}")
        held = spark.read.parquet(f"{tmp_path}/{name}")
        if name == "SimHash near-dedup":
            best = {}
            for r, g in zip(rows, _near_groups([r[text_at] for r in rows]), strict=True):
                best[g] = min(best.get(g, r), r, key=order)
            rows = list(best.values())
            assert sum(r[id_at] in (100, 101, 102) for r in rows) == 1
        elif name == "benchmark decontamination":
            items = {r["item_id"]: r["text"] for r in cases.benchmark(spark).collect() if r["item_id"] is not None}
            rows = [r for r in rows if not cases.contaminated(r[text_at], items)[1]]
        elif name == "secret scans":
            secret = [v for t in cases.texts() for v in ("ce0d4d24e1d5c8b317", "1beb58b8af68854f0e01b4ad40cdbb6ae7f578ae") if t and v in t]
            assert secret
            changed = []
            for r in rows:
                clean = r[text_at]
                for v in secret:
                    clean = clean.replace(v, "[SECRET]") if clean else clean
                changed.append((r[id_at], clean, *r[2:4], None if clean is None else len(clean), *r[5:]))
            rows = changed
        # too few labels for any cutoff: the quality stage keeps every row
        assert Counter(map(tuple, held.collect())) == Counter(rows), name
    enc, want = tokens.encoder(byte_vocabulary()), Counter()
    for r in rows:
        want[r[id_at], enc.ids(r[text_at]) + (1).to_bytes(4, "little")] += 1
    whole = Counter(pipeline.run(spark, folder).agg(F.sum("n_tokens")).first())
    assert whole == Counter([sum(len(k[1]) // 4 * n for k, n in want.items())])
    got = {}
    for r in pipeline.pack(spark, held, folder).collect():
        assert r["n_tokens"] <= 2048 and len(r["ids"]) == 4 * (r["n_tokens"] if r["n_tokens"].bit_count() == 1 else 2048)
        for x in r["pieces"]:
            got.setdefault(x["doc_id"], []).append((x["start"], bytes(r["ids"])[4 * x["offset"] : 4 * (x["offset"] + x["length"])]))
    for doc_id in {k[0] for k in want} - {None}:
        assert b"".join(piece for _, piece in sorted(got[doc_id])) == next(k[1] for k in want if k[0] == doc_id)
    assert sum(len(p) for v in got.values() for _, p in v) == sum(len(k[1]) * n for k, n in want.items())


def test_quality_stage_rejects_and_keeps(spark, tmp_path, pipeline):
    """Where labels are many, junk goes, and of good documents (short ones too) the bound's share at most."""
    rows = [(i, cases.prose(4 + i % 60, i) + (" ### $$$ !!!" * 9 if i % 4 == 0 else ""), "en", "s", 0) for i in range(4000)]
    docs = cases.documents(spark, rows=rows)
    spark.createDataFrame([(i, int(i % 4 != 0), 0) for i in range(4000)], "doc_id bigint, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    kept = {r["doc_id"] for r in pipeline.quality(spark, docs, str(tmp_path)).collect()}
    assert sum(i % 4 == 0 for i in kept) == 0 and sum(i % 4 != 0 for i in kept) >= 0.99 * 3000


def test_empty_documents(spark, tmp_path, pipeline):
    assert pipeline.run(spark, _tables(spark, tmp_path, cases.empty(spark))).count() == 0


def _sorted(df):
    return sorted((r["n_tokens"], bytes(r["ids"])) for r in df.collect())


def test_runs_leave_each_other_alone(spark, tmp_path, pipeline):
    """Two runs, read in either order, then two at once: each result is whole and the same."""
    from concurrent.futures import ThreadPoolExecutor

    folder = _tables(spark, tmp_path, cases.documents(spark))
    first, second = pipeline.run(spark, folder), pipeline.run(spark, folder)
    found = _sorted(first)
    assert found and found == _sorted(second)
    third, fourth = pipeline.run(spark, folder), pipeline.run(spark, folder)
    assert _sorted(fourth) == found == _sorted(third)
    with ThreadPoolExecutor(2) as pool:
        results = list(pool.map(lambda _: _sorted(pipeline.run(spark, folder)), range(2)))
    assert results == [found, found]


def test_a_stage_leaves_another_use_of_it_alone(spark, tmp_path, pipeline):
    folder = _tables(spark, tmp_path, cases.documents(spark))
    for _, stage in pipeline.STAGES:
        one = stage(spark, cases.documents(spark), folder)
        other = stage(spark, cases.documents(spark, rows=[(1, cases.prose(40, 3), "en", "s", 0)]), folder)
        assert other.count() == 1 and one.count() > 1
