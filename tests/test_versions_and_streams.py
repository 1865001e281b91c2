"""Edge versions, mergeable summaries, and bursts of synapses as streams give them."""

import random
from datetime import datetime, timedelta

from edgeloom.operators import summaries, versions
from edgeloom.streaming import edges as streams

EDGES = "source bigint, target bigint, weight bigint"


def test_versions_compare_without_a_shuffle(spark, tmp_path):
    rng = random.Random(1)
    make = lambda n: [(rng.choice([*range(9), None]), rng.randrange(40), rng.choice([None, *range(5)])) for _ in range(n)]
    rows = {"old": make(300), "new": make(300)}
    held = {n: versions.stored(spark.createDataFrame(r, EDGES), f"v_{n}", 4, str(tmp_path / n)) for n, r in rows.items()}
    try:
        sums = {}
        for n, r in rows.items():
            sums[n] = {}
            for s, t, w in r:
                if s is not None:
                    sums[n][s, t] = sums[n].get((s, t), 0) + (w or 0)
        want = {k: ("added" if k not in sums["old"] else "removed" if k not in sums["new"] else "changed", sums["old"].get(k), sums["new"].get(k)) for k in sums["old"] | sums["new"] if sums["old"].get(k) != sums["new"].get(k)}
        found = versions.changes(held["old"], held["new"])
        assert {(r["source"], r["target"]): tuple(r)[2:] for r in found.collect()} == want and {x[0] for x in want.values()} == {"added", "removed", "changed"}
        assert {(r["source"], r["target"]) for r in versions.except_pairs(held["old"], held["new"]).collect()} == sums["new"].keys() - sums["old"].keys()
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        for df in (found, versions.except_pairs(held["old"], held["new"])):
            assert "Exchange" not in df._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        for n in rows:
            spark.sql(f"DROP TABLE v_{n}")


def test_summaries_merge_in_any_order_within_their_bounds(spark):
    rng = random.Random(2)
    rows = [(s, rng.randrange(20_000), rng.choice([None, rng.randrange(1000)])) for s, n in ((1, 30_000), (2, 40), (None, 5)) for _ in range(n)]
    parts = [summaries.summarised(spark.createDataFrame(rows[i::3], EDGES)) for i in range(3)]
    every = [{r["node"]: r for r in summaries.estimates(summaries.merged(*order), (0.1, 0.5, 0.9)).collect()} for order in (parts, parts[::-1], [summaries.merged(*parts[:2]), parts[2]])]
    for found in every:
        assert found.keys() == {1, 2}
        for node, r in found.items():
            of = [(t, w) for s, t, w in rows if s == node]
            exact, weights = len({t for t, _ in of}), sorted(w for _, w in of if w is not None)
            assert (r["edges"], r["total"]) == (len(of), sum(weights))
            assert abs(r["n_partners"] - exact) <= (0 if node == 2 else 3 * 0.016 * exact)
            for rank in (10, 50, 90):
                place = sum(w <= r[f"weight_{rank}"] for w in weights) / len(weights)
                assert abs(place - rank / 100) <= (0.0133 * 2 if node == 1 else 1 / len(weights))
    assert len({r["n_partners"] for found in every for n, r in found.items() if n == 1}) == 1
    none = summaries.estimates(summaries.summarised(spark.createDataFrame([(1, 2, None)], EDGES))).collect()
    assert [tuple(r) for r in none] == [(1, 1, 1, 0, None, None)]


SYNAPSES = "synapse_id bigint, pre bigint, post bigint, ts timestamp"


def bursts(rows, gap):
    once = {r[0]: r for r in rows}
    by = {}
    for _, a, b, t in once.values():
        if a is not None and b is not None:
            by.setdefault((a, b), []).append(t)
    out = []
    for (a, b), times in by.items():
        times.sort()
        run = [times[0]]
        for t in times[1:]:
            if t - run[-1] >= gap:
                out.append((run[0], run[-1] + gap, a, b, len(run)))
                run = []
            run.append(t)
        out.append((run[0], run[-1] + gap, a, b, len(run)))
    return sorted(out)


def test_bursts_of_a_stream_are_those_of_a_table(spark, tmp_path):
    """Repeated, out-of-order and late rows; the stream is stopped and goes on in between."""
    rng, start = random.Random(4), datetime(2024, 1, 1)
    rows, at = [], 0.0
    for i in range(400):
        at += rng.choice([0.3, 1, 2, 4, 30])
        rows.append((i, rng.choice([1, 2, None]), rng.choice([1, 2]), start + timedelta(minutes=at, seconds=rng.random())))
    sent = sorted(rows, key=lambda r: r[3] + timedelta(minutes=rng.uniform(0, 20)))  # out of order by less than is waited for
    sent += [r for r in rows[380:]]
    sent = [x for r in sent for x in ([r, r] if r[0] % 7 == 0 else [r])]
    far = [(10_000 + i, 9, 9, start + timedelta(days=40 + i)) for i in range(2)]  # lets all bursts end
    late = [(20_000, 1, 1, start)]  # comes when its time has gone
    folder = tmp_path / "in"

    def write(part, n):
        spark.createDataFrame(part, SYNAPSES).coalesce(1).write.mode("append").parquet(str(folder))

    def run():
        stream = spark.readStream.schema(SYNAPSES).option("maxFilesPerTrigger", 1).parquet(str(folder))
        found = streams.sessions(stream, gap="3 minutes", late="30 minutes")
        query = found.writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "at")).outputMode("append").start(str(tmp_path / "out"))
        try:
            query.processAllAvailable()
        finally:
            query.stop()

    n = len(sent)
    for k in range(2):
        write(sent[n * k // 4 : n * (k + 1) // 4], k)
    run()
    for k in range(2, 4):
        write(sent[n * k // 4 : n * (k + 1) // 4], k)
        run()
    write(far[:1], 5)
    run()
    write(late + far[1:], 6)
    run()
    found = sorted((r["begins"], r["ends"], r["source"], r["target"], r["weight"]) for r in spark.read.parquet(str(tmp_path / "out")).collect())
    want = bursts(rows, timedelta(minutes=3))
    assert [f for f in found if f[2] != 9] == want
    rest = streams.sessions(spark.createDataFrame(sent, SYNAPSES), gap="3 minutes")
    assert sorted((r["begins"], r["ends"], r["source"], r["target"], r["weight"]) for r in rest.collect()) == want


def test_counts_merge_to_exact_partners_and_weights(spark):
    rng = random.Random(8)
    rows = [(1, i % 9000, rng.randrange(5000)) for i in range(12000)] + [(2, 7, None), (3, 7, 4), (3, 7, 4), (3, 8, None), (None, 1, 1)]
    parts = [summaries.counted(spark.createDataFrame(rows[i::3], EDGES)) for i in range(3)]
    found = {r["node"]: tuple(r)[1:] for r in summaries.exact(summaries.merged_counts(*parts)).collect()}
    ordered = sorted(w for s, _, w in rows if s == 1)
    assert found[1] == (9000, 12000, sum(ordered), ordered[5999], ordered[10799])
    assert found[2] == (1, 1, 0, None, None) and found[3] == (2, 3, 8, 4, 4) and len(found) == 3
