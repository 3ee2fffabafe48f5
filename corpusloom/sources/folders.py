"""Folders of many small files in a shared folder, listed and read by tasks.

Spark's own readers hold a status of every file on the driver and deal files to tasks as if each had 4 MB: millions of
files fill the driver and become a hundred thousand tasks. Here the driver sees folders only, tasks list them, and files
are dealt by their real sizes, also those of one folder.
"""

from __future__ import annotations

import fnmatch
import json
import os
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.functions.shared import shared_folder, stored
from corpusloom.functions.shipping import BATCH_BYTES, ship

#: Folders that one task lists, and what one task reads: bytes, and files, as each costs something however short.
LIST_FOLDERS, READ_BYTES, READ_FILES = 500, 32 << 20, 10_000
#: Files that are handed on at once.
BATCH_FILES = 4096
LISTED, READ = "path string, name string, length long, modified timestamp", "path string, name string, modified timestamp, text string"


def hidden(name: str) -> bool:
    """Names that Spark's readers pass over, too."""
    return name.startswith(".") or name.startswith("_") and "=" not in name or name.endswith("._COPYING_")


def entries(folder: str) -> Iterator[os.DirEntry]:
    with os.scandir(folder) as found:
        yield from (e for e in found if not hidden(e.name))


def folders(root: str, wanted: int) -> list[tuple[str, bool]]:
    """Folders to list, some by themselves and others with all below them: down to the level that has as many as ``wanted``, or the last."""
    own, level = [], [root]
    while level and len(level) < wanted:
        own += level
        level = [e.path for f in level for e in entries(f) if e.is_dir()]
    return [(f, False) for f in own] + [(f, True) for f in level]


def files_of(folder: str, below: bool) -> Iterator[os.DirEntry]:
    for e in entries(folder):
        if not e.is_dir():
            yield e
        elif below:
            yield from files_of(e.path, True)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], f.type) for i, f in enumerate(schema)], schema=schema)


def _schema(last: tuple[str, pa.DataType], *more: tuple[str, pa.DataType]) -> pa.Schema:
    return pa.schema([("path", pa.string()), ("name", pa.string()), last, *more])


MODIFIED = ("modified", pa.timestamp("us", "UTC"))


def listed(spark: SparkSession, path: str, pattern: str = "*", recursive: bool = True) -> DataFrame:
    """(path, name, length, modified): the files below ``path`` whose name is of the ``pattern``; of a path that is no shared folder, as Spark's reader lists them."""
    root = shared_folder(spark, path)
    if root is None:
        found = spark.read.format("binaryFile").option("recursiveFileLookup", str(recursive).lower()).option("pathGlobFilter", pattern).load(path)
        return found.select("path", F.element_at(F.split("path", "/"), -1).alias("name"), "length", F.col("modificationTime").alias("modified"))
    ship(spark)
    cores = spark.sparkContext.defaultParallelism
    places = folders(root, 4 * cores) if recursive else [(root, False)]
    parts = max(1, min(len(places), max(cores, -(-len(places) // LIST_FOLDERS))))
    schema = _schema(("length", pa.int64()), MODIFIED)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = []
        for batch in batches:
            for folder, below in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                for e in files_of(folder, below):
                    if fnmatch.fnmatchcase(e.name, pattern):
                        held.append((e.path, e.name, e.stat().st_size, int(e.stat().st_mtime * 1e6)))
                        if len(held) == BATCH_FILES:
                            yield _batch(held, schema)
                            held = []
        yield _batch(held, schema)

    return spark.createDataFrame(spark.sparkContext.parallelize(places, parts), "folder string, below boolean").mapInArrow(run, LISTED)


def decoded(content: bytes) -> str | None:
    """JSON as text, from any of its encodings; None if it is in none of them."""
    try:
        return content.decode(json.detect_encoding(content))
    except UnicodeDecodeError:
        return None


def read_json_texts(spark: SparkSession, path: str, pattern: str, recursive: bool = True) -> DataFrame:
    """(path, name, modified, text): the JSON files below a shared folder, whole; those without text are left out."""
    found = stored(listed(spark, path, pattern, recursive).where("length > 0"), "listed")
    size = found.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("length"), F.lit(0)).alias("bytes")).first()
    parts = max(1, min(size["n"], max(spark.sparkContext.defaultParallelism, -(-size["bytes"] // READ_BYTES), -(-size["n"] // READ_FILES))))
    schema = _schema(MODIFIED, ("text", pa.string()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, held_bytes = [], 0
        for batch in batches:
            for file, name, modified in zip(*(batch.column(n).to_pylist() for n in ("path", "name", "modified")), strict=True):
                with open(file, "rb") as f:
                    content = f.read()
                text = decoded(content)
                if text is None or text.strip():
                    held.append((file, name, modified, text))
                    held_bytes += len(content)
                if held_bytes > BATCH_BYTES or len(held) == BATCH_FILES:
                    yield _batch(held, schema)
                    held, held_bytes = [], 0
        yield _batch(held, schema)

    return found.repartition(parts, "path").mapInArrow(run, READ)
