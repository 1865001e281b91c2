"""A data source for services that answer a request with rows, read at once or as a stream of snapshots.

``spark.read.format("edge_service").options(...)`` calls a fetch function, split by source ids: each partition asks for one
range of ids, so batches are partitions and an interrupted one is asked again by Spark's own retry.  Functions are named as
``module:function`` and get the range's first and last id.  Options other than those below go to the function, so endpoints
are parameters, and credentials come from the caller's secret store.

* ``starts``: the first ids of the batches in order, from :func:`batch_starts`, which gives each batch as many ids of a
  registry as any other; without it ``batches`` ranges of equal width from ``lowest`` to ``highest``.  With it, ``lowest``
  is the first start unless given, and ``highest`` must be given.
* ``schema``: the columns, edges by default.
* ``latest`` and ``since``, for ``readStream``: a function that says which snapshot is the newest, and the snapshot that the
  stream begins after.  Each snapshot is asked for once, and the fetch function gets its number as ``snapshot``.

Where ``spark.sql.python.filterPushdown.enabled`` is set (:func:`register` does), filters narrow what is asked: those on
``source`` cut the ranges and leave out batches that hold none of the ids, and a least weight goes to functions that take
``over``, as the number that weights must exceed.  Spark checks every filter again, so a function may answer with more.

:func:`saved_answers` is a fetch function that reads answers kept in a shared folder.
"""

from __future__ import annotations

import importlib
import inspect
import json
import math
import re
from collections.abc import Callable, Iterator
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, EqualTo, GreaterThan, GreaterThanOrEqual, In, InputPartition, LessThan, LessThanOrEqual

_OWN = ("fetch", "batches", "lowest", "highest", "starts", "schema", "latest", "since", "path")


class Batch(InputPartition):
    """Source ids from ``first`` to ``last``, of one snapshot in a stream."""

    def __init__(self, first: int, last: int, snapshot: int | None = None):
        self.first, self.last, self.snapshot = first, last, snapshot


def _named(function: str) -> Callable:
    module, _, name = function.partition(":")
    return getattr(importlib.import_module(module), name)


def _takes(function: Callable, name: str) -> bool:
    parameters = inspect.signature(function).parameters.values()
    return any(p.name == name or p.kind is p.VAR_KEYWORD for p in parameters)


class _Asked:
    """What the options and the filters ask for."""

    def __init__(self, options: dict[str, str]):
        self.settings, self.least, self.most, self.ids, self.over = options, -math.inf, math.inf, None, None

    def narrow(self, filters) -> None:
        for f in filters:
            name, value = getattr(f, "attribute", None), getattr(f, "value", None)
            if name == ("source",) and isinstance(f, In):
                values = {int(v) for v in f.value if v is not None}
                self.ids = values if self.ids is None else self.ids & values
            elif name == ("source",) and isinstance(value, int):
                if isinstance(f, (EqualTo, GreaterThan, GreaterThanOrEqual)):
                    self.least = max(self.least, value + isinstance(f, GreaterThan))
                if isinstance(f, (EqualTo, LessThan, LessThanOrEqual)):
                    self.most = min(self.most, value - isinstance(f, LessThan))
            elif name == ("weight",) and isinstance(value, (int, float)) and isinstance(f, (GreaterThan, GreaterThanOrEqual)):
                bound = value if isinstance(f, GreaterThan) else math.ceil(value) - 1 if isinstance(value, int) else math.nextafter(value, -math.inf)
                self.over = bound if self.over is None else max(self.over, bound)

    def ranges(self) -> list[tuple[int, int]]:
        """Batches that hold any id that is asked for; all of them together hold each such id once."""
        if "starts" in self.settings:
            starts = sorted({int(x) for x in self.settings["starts"].split(",") if x.strip()})
            if "lowest" in self.settings and starts:
                starts[0] = min(starts[0], int(self.settings["lowest"]))
            ends = [x - 1 for x in starts[1:]] + [int(self.settings["highest"])]
            whole = list(zip(starts, ends, strict=False))
        else:
            n, lowest, highest = (int(self.settings[k]) for k in ("batches", "lowest", "highest"))
            width = highest - lowest + 1
            whole = [(lowest + width * i // n, lowest + width * (i + 1) // n - 1) for i in range(n)]
        ids, found = None if self.ids is None else sorted(i for i in self.ids if self.least <= i <= self.most), []
        for first, last in whole:
            first, last = max(first, self.least), min(last, self.most)
            if ids is not None:
                held = [i for i in ids if first <= i <= last]
                first, last = (held[0], held[-1]) if held else (0, -1)
            if first <= last:
                found.append((int(first), int(last)))
        return found

    def rows(self, batch: Batch) -> Iterator[tuple]:
        fetch = _named(self.settings["fetch"])
        given = {k: v for k, v in self.settings.items() if k not in _OWN}
        if self.over is not None and _takes(fetch, "over"):
            given["over"] = self.over
        if batch.snapshot is not None:
            given["snapshot"] = batch.snapshot
        yield from (tuple(row) for row in fetch(batch.first, batch.last, **given))


class EdgeService(DataSource):
    @classmethod
    def name(cls) -> str:
        return "edge_service"

    def schema(self) -> str:
        return self.options.get("schema", "source bigint, target bigint, weight bigint")

    def reader(self, schema) -> EdgeServiceReader:
        return EdgeServiceReader(dict(self.options))

    def streamReader(self, schema) -> EdgeServiceStream:
        return EdgeServiceStream(dict(self.options))


class EdgeServiceReader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.asked = _Asked(options)

    def pushFilters(self, filters):
        self.asked.narrow(filters)
        return filters

    def partitions(self) -> list[Batch]:
        return [Batch(*r) for r in self.asked.ranges()] or [Batch(0, -1)]

    def read(self, partition: Batch):
        return self.asked.rows(partition) if partition.first <= partition.last else iter(())


class EdgeServiceStream(DataSourceStreamReader):
    """Offsets are snapshots: a restarted stream goes on after the last one that it finished."""

    def __init__(self, options: dict[str, str]):
        self.asked = _Asked(options)

    def initialOffset(self) -> dict:
        return {"snapshot": int(self.asked.settings.get("since", 0))}

    def latestOffset(self) -> dict:
        given = {k: v for k, v in self.asked.settings.items() if k not in _OWN}
        return {"snapshot": int(_named(self.asked.settings["latest"])(**given))}

    def partitions(self, start: dict, end: dict) -> list[Batch]:
        return [Batch(*r, snapshot=s) for s in range(start["snapshot"] + 1, end["snapshot"] + 1) for r in self.asked.ranges()]

    def read(self, partition: Batch):
        return self.asked.rows(partition)


def batch_starts(ids: DataFrame, size: int) -> str:
    """The ``starts`` option: the least of every ``size`` distinct ids of a one-column table, in order; one number for each batch."""
    from edgeloom.operators.slices import batches

    name = ids.columns[0]
    held = ids.select(F.col(name).cast("bigint").alias("id")).filter("id IS NOT NULL").distinct()
    starts = batches(held, size, "id").groupBy("batch").agg(F.min("id").alias("first"))
    return ",".join(str(r["first"]) for r in starts.orderBy("first").collect())


def saved_answers(first: int, last: int, folder: str, over: float | None = None) -> Iterator[tuple]:
    """Rows of the range from answers saved as JSON (``results``: results of data of row arrays) in a folder that executors share.

    A file whose name ends in the first and last id that it holds (``…_1-99.json``) is only read for ranges that it meets.
    """
    for path in sorted(Path(folder).glob("*.json")):
        held = re.search(r"(\d+)-(\d+)\.json$", path.name)
        if held and (int(held[2]) < first or int(held[1]) > last):
            continue
        for result in json.loads(path.read_text(encoding="utf-8"))["results"]:
            for data in result["data"]:
                source, *rest = data["row"]
                if source is not None and first <= int(source) <= last:
                    row = (int(source), *(None if x is None else int(x) for x in rest))
                    if over is None or (row[-1] is not None and row[-1] > over):
                        yield row


def register(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(EdgeService)
