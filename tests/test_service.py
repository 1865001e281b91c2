"""The service source: batches, filters that reach the fetch function, retries, and streams of snapshots."""

import json
import random
from pathlib import Path

import pytest

from edgeloom.sources import service

ROWS = [(i, i % 7, i % 50) for i in range(0, 4000, 3)]


def _note(log, **what):
    with open(log, "a", encoding="utf-8") as out:
        out.write(json.dumps(what) + "\n")


def _noted(log):
    return [json.loads(x) for x in log.read_text().splitlines()] if log.exists() else []


def fetch(first, last, log, over=None, snapshot=None, weight_column="yes"):
    _note(log, first=first, last=last, over=over, snapshot=snapshot)
    for s, t, w in ROWS:
        if first <= s <= last and (over is None or w > over):
            yield (s, t, w) if snapshot is None else (s, t, w + snapshot)


def fetch_plain(first, last, log):
    _note(log, first=first, last=last)
    yield from ((s, t, w) for s, t, w in ROWS if first <= s <= last)


def fetch_failing_once(first, last, log):
    with open(log, "a+", encoding="utf-8") as held:
        held.seek(0)
        seen = f"{first}\n" in held.read()
        held.write(f"{first}\n")
    yield from ((s, t, w) for s, t, w in ROWS if first <= s <= (first + last) // 2)
    if not seen and first > 2000:
        raise ConnectionError("interrupted")
    yield from ((s, t, w) for s, t, w in ROWS if (first + last) // 2 < s <= last)


def newest(log, **_):
    with open(log + ".newest", encoding="utf-8") as held:
        return int(held.read())


@pytest.fixture
def source(spark, tmp_path):
    service.register(spark)
    log = tmp_path / "log"
    load = lambda function="fetch", **more: spark.read.format("edge_service").options(**{"fetch": f"tests.test_service:{function}", "log": str(log), "batches": 5, "lowest": 0, "highest": 3999} | more).load()
    return load, log


@pytest.mark.parametrize("function", ["fetch", "fetch_plain"])
@pytest.mark.parametrize(
    "where,over,first,last",
    [
        ("true", None, 0, 3999), ("source >= 1000 AND source < 1300", None, 1000, 1299), ("source > 1000 AND source <= 1300 AND weight > 40", 40, 1001, 1300), ("source = 999", None, 999, 999),
        ("source IN (3, 30, 3000) AND weight >= 3", 2, 3, 3000), ("weight > 10 AND weight > 20 AND target = 3", 20, 0, 3999), ("source > 3 AND source < 2", None, 0, -1), ("source = 5 OR weight > 48", None, 0, 3999),
    ],
)
def test_filters_reach_the_fetch_function(source, function, where, over, first, last):
    load, log = source
    found = load(function).filter(where).collect()
    local = [(s, t, w) for s, t, w in ROWS if eval(where.replace(" AND ", " and ").replace(" OR ", " or ").replace(" = ", " == ").replace("IN", "in").replace("true", "True"), {"source": s, "target": t, "weight": w})]
    assert sorted(map(tuple, found)) == local
    asked = _noted(log)
    assert all(first <= x["first"] and x["last"] <= last for x in asked) and all(x.get("over") == (over if function == "fetch" else None) for x in asked)
    covered = [i for x in asked for i in range(x["first"], x["last"] + 1)]
    assert len(covered) == len(set(covered)) and {s for s, *_ in local} <= set(covered)
    if "IN" in where:
        assert len(asked) == 2  # the batches between them hold none of the ids


def test_batches_hold_as_many_ids_each(spark, source):
    load, log = source
    rng = random.Random(1)
    ids = [720575940600000000 + rng.randrange(50) for _ in range(200)] + [720575940900000000 + i for i in range(450)] + [None]
    starts = service.batch_starts(spark.createDataFrame([(i,) for i in ids], "filename bigint"), 100)
    whole = sorted(set(ids) - {None})
    assert starts == ",".join(str(x) for x in whole[::100])
    reader = service.EdgeServiceReader({"starts": starts, "highest": str(whole[-1])})
    held = [sum(p.first <= i <= p.last for i in whole) for p in reader.partitions()]
    assert held == [100] * (len(whole) // 100) + [len(whole) % 100]
    assert sorted(map(tuple, load(starts="0,900,1800", highest=3999).collect())) == ROWS
    assert [(x["first"], x["last"]) for x in sorted(_noted(log), key=lambda x: x["first"])] == [(0, 899), (900, 1799), (1800, 3999)]


def test_an_interrupted_batch_is_asked_again(tmp_path):
    """Spark's retry: the rows of the failed attempt don't count."""
    import subprocess
    import sys

    code = f"""
from pyspark.sql import SparkSession
from edgeloom.sources import service
spark = SparkSession.builder.master("local[2, 3]").config("spark.ui.enabled", "false").getOrCreate()
service.register(spark)
rows = spark.read.format("edge_service").options(fetch="tests.test_service:fetch_failing_once", log={str(tmp_path / "tries")!r}, batches=4, lowest=0, highest=3999).load().collect()
from tests.test_service import ROWS
assert sorted(map(tuple, rows)) == ROWS
print("whole")
"""
    done = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=300, cwd=Path(__file__).parent.parent)
    assert "whole" in done.stdout, done.stderr[-2000:]
    assert sorted(map(int, (tmp_path / "tries").read_text().split())) == [0, 1000, 2000, 3000, 3000]


def test_a_restarted_stream_repeats_nothing(spark, tmp_path):
    service.register(spark)
    log, newest_file = tmp_path / "log", tmp_path / "log.newest"
    newest_file.write_text("3")

    def run(until):
        newest_file.write_text(str(until))
        stream = spark.readStream.format("edge_service").options(fetch="tests.test_service:fetch", latest="tests.test_service:newest", log=str(log), batches=2, lowest=0, highest=99, since=1).load()
        query = stream.writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "at")).start(str(tmp_path / "out"))
        try:
            query.processAllAvailable()
        finally:
            query.stop()
        return sorted(map(tuple, spark.read.parquet(str(tmp_path / "out")).collect()))

    of = lambda *snapshots: sorted((s, t, w + n) for n in snapshots for s, t, w in ROWS if s <= 99)
    assert run(3) == of(2, 3)
    assert run(3) == of(2, 3)
    assert run(5) == of(2, 3, 4, 5)
    asked = [(x["snapshot"], x["first"]) for x in _noted(log)]
    assert sorted(asked) == [(n, f) for n in (2, 3, 4, 5) for f in (0, 50)]


def test_saved_answers_of_other_ranges_are_not_read(spark, tmp_path):
    answer = lambda *rows: json.dumps({"results": [{"data": [{"row": r} for r in rows]}]})
    (tmp_path / "a_1-9.json").write_text(answer([1, 2, 5], [7, 2, None], [None, 2, 5]))
    (tmp_path / "a_10-19.json").write_text("not read")
    (tmp_path / "rest.json").write_text(answer([15, 1, 1], ["3", "1", "4"]))
    service.register(spark)
    table = spark.read.format("edge_service").options(fetch="edgeloom.sources.service:saved_answers", folder=str(tmp_path), batches=3, lowest=1, highest=9).load()
    assert sorted(map(tuple, table.collect()), key=repr) == [(1, 2, 5), (3, 1, 4), (7, 2, None)]
    assert sorted(map(tuple, table.filter("weight > 4").collect())) == [(1, 2, 5)]
