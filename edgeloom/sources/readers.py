"""Readers: files in any store that Spark reaches, with schemas given rather than inferred."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from edgeloom.functions.scalars import na_to_null
from edgeloom.sources import schemas
from edgeloom.sources.shared import written

#: Voxels of a grid file that are decoded at a time.
SLAB = 1 << 20


def parquet(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A Parquet table with the columns of ``schema``; others are never read."""
    columns = T.StructType.fromDDL(schema)
    held = schemas.require(spark.read.parquet(path), *columns.names)
    return held.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in columns])


def edge_file(spark: SparkSession, path: str) -> DataFrame:
    return parquet(spark, path, schemas.EDGE_FILE)


def tsv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A tab-separated file with a header.

    Everything is read as text, so that an 18-digit id in a column with gaps is never a double; missing-value texts
    become null, and then columns get the types of ``schema``.
    """
    columns = T.StructType.fromDDL(schema)
    raw = spark.read.option("sep", "\t").option("header", True).option("inferSchema", False).option("quote", '"').option("escape", '"').csv(path)
    schemas.require(raw, *columns.names)
    return raw.select(*[na_to_null(F.col(f.name)).cast(f.dataType).alias(f.name) for f in columns])


def annotations(spark: SparkSession, path: str) -> DataFrame:
    return tsv(spark, path, schemas.ANNOTATIONS)


def graph(spark: SparkSession, nodes_path: str, rels_path: str) -> tuple[DataFrame, DataFrame]:
    """Nodes and relationships of an exported property graph."""
    return parquet(spark, nodes_path, schemas.NODES), parquet(spark, rels_path, schemas.RELS)


def envelope(spark: SparkSession, path: str) -> DataFrame:
    """Saved query answers, one JSON document per file or line."""
    return spark.read.schema(schemas.ENVELOPE).option("multiLine", False).json(path)


def ids(spark: SparkSession, values: Iterable[int], name: str = "filename") -> DataFrame:
    """A one-column table of ids given in memory."""
    return spark.createDataFrame([(int(v),) for v in values], f"{name} bigint")


def stored(spark: SparkSession, local: str, remote: str) -> str:
    """``local`` if it exists, else ``remote``: Spark reads object stores itself, so nothing is copied."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(local)
    there = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path)
    return local if there else remote


def artifacts(spark: SparkSession, root: str, glob: str = "*") -> DataFrame:
    """path, folder, name, size and time of the files under ``root``; their contents are never read."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", glob).load(root)
    return found.select("path", F.regexp_replace("path", "/[^/]*$", "").alias("folder"), F.regexp_extract("path", "[^/]*$", 0).alias("name"), F.col("length").alias("size"), F.col("modificationTime").alias("modified"))


def skeletons(spark: SparkSession, path: str) -> DataFrame:
    """Skeleton files as one row per sample: path, sample, kind, x, y, z, radius, parent; comments are left out."""
    lines = spark.read.text(path).select(F.input_file_name().alias("path"), F.trim("value").alias("line"))
    parts = F.split("line", r"\s+")
    kinds = (("sample", "bigint"), ("kind", "int"), ("x", "double"), ("y", "double"), ("z", "double"), ("radius", "double"), ("parent", "bigint"))
    kept = lines.filter((F.col("line") != "") & ~F.col("line").startswith("#"))
    return kept.select("path", *[F.get(parts, F.lit(i)).try_cast(kind).alias(name) for i, (name, kind) in enumerate(kinds)])


def payloads(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """Mesh and grid files as bytes, for code outside the relational part."""
    return spark.read.format("binaryFile").option("pathGlobFilter", glob).load(path).select("path", "length", "content")


def meshes(spark: SparkSession, path: str, glob: str = "*") -> tuple[DataFrame, DataFrame]:
    """Mesh files as ``vertices`` (``mesh``, ``vertex``, ``x``, ``y``, ``z``) and ``faces`` (``mesh``, ``face``, ``part``, ``a``, ``b``, ``c``).

    ``mesh`` is the file's path.  Vertices and faces count from 1 in the file's order, whatever blocks it is read in: each
    block's lines are counted in their order, and moved up by the counts of the blocks before it.  A face of more than three
    corners becomes a fan of parts; corners may name textures and normals, which are left out, and may count backwards from
    the last vertex before the face.  A number that isn't one becomes null; other lines, and faces of fewer than three
    corners, have no row.
    """
    c = F.col
    raw = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", glob).text(path).select(c("_metadata.file_path").alias("mesh"), c("_metadata.file_block_start").alias("block"), F.split(F.trim("value"), r"\s+").alias("words"))
    kept = raw.withColumn("kind", F.get("words", F.lit(0))).filter(c("kind").isin("v", "f"))
    held = written(kept.withColumn("at", F.monotonically_increasing_id()), "mesh-lines")
    # a row for each block
    sizes = held.groupBy("mesh", "block").agg(F.count_if(c("kind") == "v").alias("vs"), F.count_if(c("kind") == "f").alias("fs"))
    along = Window.partitionBy("mesh").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    before = sizes.select("mesh", "block", *[F.coalesce(F.sum(n).over(along), F.lit(0)).alias(n) for n in ("vs", "fs")])
    within = Window.partitionBy("mesh", "block").orderBy("at")
    placed = held.select("*", *[F.count_if(c("kind") == k).over(within).alias(n) for k, n in (("v", "v"), ("f", "f"))]).join(before, ["mesh", "block"])
    placed = placed.select("mesh", "kind", "words", (c("v") + c("vs")).alias("v"), (c("f") + c("fs")).alias("f"))
    number = lambda i: F.get("words", F.lit(i)).try_cast("double")
    vertices = placed.filter("kind = 'v'").select("mesh", c("v").alias("vertex"), *[number(i + 1).alias(n) for i, n in enumerate("xyz")])
    named = F.transform(F.slice("words", 2, F.size("words") - 1), lambda w: F.split_part(w, F.lit("/"), F.lit(1)).try_cast("bigint"))
    faces = placed.filter("kind = 'f'").select("mesh", c("f").alias("face"), "v", named.alias("corners")).filter(F.size("corners") >= 3)
    faces = faces.select("mesh", "face", F.transform("corners", lambda n: F.when(n < 0, c("v") + 1 + n).otherwise(n)).alias("corners"))
    faces = faces.select("mesh", "face", "corners", F.explode(F.sequence(F.lit(0), F.size("corners") - 3)).alias("part"))
    return vertices, faces.select("mesh", "face", "part", F.get("corners", F.lit(0)).alias("a"), F.get("corners", c("part") + 1).alias("b"), F.get("corners", c("part") + 2).alias("c"))


def grids(spark: SparkSession, path: str, glob: str = "*.nrrd", background: float | None = 0) -> DataFrame:
    """Grid files as ``mesh`` (the path), ``i``, ``j``, ``k`` and ``value`` of each voxel that isn't ``background``; None keeps all.

    The header says how the voxels are kept: raw, gzip or text, in any of the whole or floating types and either byte order,
    first axis fastest, up to three axes.  A file is decoded slab by slab, so a task never holds a grid that is larger than
    its file; no slab holds over ``SLAB`` voxels.  A file cut short, another encoding or a detached one is an error.
    """
    found = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", glob).load(path).select("path", "content")
    slab = SLAB

    def decode(batches):
        import re
        import zlib

        import numpy as np
        import pyarrow as pa

        # fixed values: names of types in headers, and their codes here
        codes = {"int8": "i1", "signed char": "i1", "uint8": "u1", "uchar": "u1", "unsigned char": "u1", "int16": "i2", "short": "i2", "uint16": "u2", "ushort": "u2", "int32": "i4", "int": "i4", "uint32": "u4", "uint": "u4", "int64": "i8", "uint64": "u8", "float": "f4", "double": "f8"}

        def header(data):
            match = re.search(rb"\r?\n\r?\n", data)
            if not data.startswith(b"NRRD") or match is None:
                raise ValueError("no header of a grid file")
            lines = [x for x in data[: match.start()].decode("utf-8").splitlines()[1:] if not x.startswith("#")]
            return {k.strip().lower(): v.strip() for k, mark, v in (x.partition(":") for x in lines) if mark and not v.startswith("=")}, match.end()

        def pieces(data, at, encoding, width):
            """The voxels' bytes in pieces of whole voxels."""
            step = slab * width
            if encoding == "raw":
                for i in range(at, len(data), step):
                    yield data[i : i + step]
                return
            left, opened, rest = b"", zlib.decompressobj(31), data[at:]
            while True:
                got = opened.decompress(rest, step)
                left, rest = left + got, opened.unconsumed_tail
                whole = len(left) // width * width
                yield left[:whole]
                left = left[whole:]
                if opened.eof:  # a file may be several streams on end
                    rest = opened.unused_data.lstrip(b"\0\r\n")
                    if not rest:
                        return
                    opened = zlib.decompressobj(31)
                elif not got and not rest:
                    return

        def spelled(data):
            """Numbers in words, so many at a time."""
            words = re.finditer(rb"[^\s]+", data)
            while some := [float(w.group()) for _, w in zip(range(slab), words, strict=False)]:
                yield np.array(some)

        def values(data):
            fields, at = header(data)
            if "data file" in fields or "datafile" in fields:
                raise ValueError("a detached grid file")
            sizes = [int(x) for x in fields["sizes"].split()]
            if len(sizes) > 3:
                raise ValueError("a grid of over three axes")
            if fields["type"].lower() not in codes:
                raise ValueError(f"no type of voxels: {fields['type']}")
            kind = np.dtype((">" if fields.get("endian", "little") == "big" else "<") + codes[fields["type"].lower()])
            encoding = fields.get("encoding", "raw").lower()
            nx, ny, nz = sizes + [1] * (3 - len(sizes))
            need, first = nx * ny * nz, 0
            if encoding in ("text", "txt", "ascii"):
                parts = spelled(data[at:])
            elif encoding in ("raw", "gzip", "gz"):
                parts = (np.frombuffer(x, kind) for x in pieces(data, at, "raw" if encoding == "raw" else "gzip", kind.itemsize) if len(x) % kind.itemsize == 0)
            else:
                raise ValueError(f"no encoding of voxels: {encoding}")
            for part in parts:
                if first >= need:
                    break
                part = part[: need - first]
                at = first + (np.arange(len(part)) if background is None else np.flatnonzero(part != background))
                yield at % nx, at // nx % ny, at // (nx * ny), part[at - first].astype(np.float64)
                first += len(part)
            if first < need:
                raise ValueError(f"a grid file of {first} instead of {need} voxels")

        for batch in batches:
            for path, content in zip(*batch.columns, strict=True):
                for *at, value in values(content.as_py()):
                    yield pa.RecordBatch.from_arrays([pa.array([path.as_py()] * len(value), pa.string()), *[pa.array(x.astype(np.int32)) for x in at], pa.array(value)], names=["mesh", "i", "j", "k", "value"])

    return found.mapInArrow(decode, "mesh string, i int, j int, k int, value double")
