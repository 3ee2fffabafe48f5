"""Sources: compressed comment archives, JSON document directories, name lists, tables."""

from __future__ import annotations

import io
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom.functions import records
from corpusloom.functions import text as X
from corpusloom.functions.shared import shared_folder
from corpusloom.functions.shipping import ship
from corpusloom.operators.threads import of_threads
from corpusloom.schema import COMMENT, COMMENT_FIELDS
from corpusloom.sources.folders import read_json_texts
from corpusloom.sources.frames import frame_lines

def archive_lines(spark: SparkSession, path: str, long_window: bool = False) -> DataFrame:
    """(source, ord, value): the lines of NDJSON archives (.zst, .gz or plain), in file order within a source.

    A .zst file is one task's to read here. ``long_window`` reads frames beyond the JVM reader's window: in a shared folder
    by ranges of frames, each a task's (:func:`~corpusloom.sources.frames.frame_lines`); elsewhere file by file, of 2 GB at most.
    """
    if long_window:
        one = spark.read.format("binaryFile").load(path).select("path").first()
        return frame_lines(spark, path) if one is not None and one["path"].startswith("file:") else _long_window(spark, path)
    return spark.read.text(path).select(F.col("_metadata.file_path").alias("source"), F.monotonically_increasing_id().alias("ord"), "value")


def _long_window(spark: SparkSession, path: str) -> DataFrame:
    ship(spark)
    files = spark.read.format("binaryFile").load(path).select("path", "content")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        for batch in batches:
            for name, content in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                reader = zstandard.ZstdDecompressor(max_window_size=2**31).stream_reader(io.BytesIO(content), read_across_frames=True)
                lines, n = [], 0
                for line in io.TextIOWrapper(reader, encoding="utf-8", errors="replace", newline="\n"):
                    lines.append(line.rstrip("\n"))
                    if len(lines) == 4096:
                        yield _lines(name, n, lines)
                        lines, n = [], n + len(lines)
                yield _lines(name, n, lines)

    return files.mapInArrow(run, "source string, ord long, value string")


def _lines(name: str, first: int, lines: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([name] * len(lines), pa.string()), pa.array(range(first, first + len(lines)), pa.int64()), pa.array(lines, pa.string())], ["source", "ord", "value"])


def parsed(lines: DataFrame, raw_inline: bool = False) -> DataFrame:
    """Comments of the lines: the fields the stages need as text, all ``fields`` of the record, and ``corrupt`` for lines that are no JSON object. ``raw_inline`` strips inline marks before parsing."""
    records.keep_last_of_repeated(lines.sparkSession)
    value = X.inline_formatting(F.col("value")) if raw_inline else F.col("value")
    rows = lines.select("source", "ord", "value", F.explode_outer(F.array(records.fields(value))).alias("fields"))
    return rows.select("source", "ord", *(records.text(F.col("fields"), n).alias(n) for n in COMMENT_FIELDS), F.col("fields").isNull().alias("corrupt"), "value", "fields")


def read_archive(spark: SparkSession, path: str, raw_inline: bool = False, long_window: bool = False, wanted: DataFrame | None = None) -> DataFrame:
    """Well-formed comments of archives: source, ord, the comment fields, and ``fields``, the whole record. ``wanted`` (``link_id``) leaves out other threads before parsing."""
    lines = archive_lines(spark, path, long_window)
    return parsed(lines if wanted is None else of_threads(lines, wanted), raw_inline).where("not corrupt").drop("corrupt", "value")


def quarantine(spark: SparkSession, path: str, raw_inline: bool = False) -> DataFrame:
    """The lines of archives that are no JSON object."""
    return parsed(archive_lines(spark, path), raw_inline).where(F.col("corrupt") & ~X.is_blank(F.col("value"))).select("source", "ord", "value")


def community(source: DataFrame) -> DataFrame:
    """Adds ``community``, the archive's name without its path and ending."""
    return source.withColumn("community", F.regexp_extract("source", r"([^/]+?)(?:_comments)?(?:\.\w+)*$", 1))


def file_keys(name: Column) -> tuple[Column, Column]:
    """Thread and comment of a file's name, ``thread_comment.json``; empty for other names."""
    pattern = r"^([^_]+)_([^_]+)\.json$"
    return F.regexp_extract(name, pattern, 1), F.regexp_extract(name, pattern, 2)


def json_rows(spark: SparkSession, path: str, recursive: bool = True) -> DataFrame:
    """The comment fields, path, file_name, modified and n, the place: rows of JSON-array files. In a shared folder tasks list and read them (:mod:`~corpusloom.sources.folders`); elsewhere Spark's reader does."""
    if shared_folder(spark, path) is None:
        reader = spark.read.option("multiLine", "true").option("recursiveFileLookup", str(recursive).lower()).option("pathGlobFilter", "*.json").schema(COMMENT)
        return reader.json(path).select("*", F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_name").alias("file_name"), F.col("_metadata.file_modification_time").alias("modified"), F.monotonically_increasing_id().alias("n"))
    files = read_json_texts(spark, path, "*.json", recursive)
    # a file that is no JSON is one row of nulls, as Spark's reader has it
    found = F.coalesce(F.from_json("text", T.ArrayType(COMMENT)), F.array(F.lit(None).cast(COMMENT)))
    rows = files.select("path", F.col("name").alias("file_name"), "modified", F.posexplode(found).alias("n", "c"))
    return rows.select("c.*", "path", "file_name", "modified", F.col("n").cast("long").alias("n"))


def read_json_documents(spark: SparkSession, path: str, recursive: bool = True) -> DataFrame:
    """Comments of JSON-array files, with the thread and comment of the file's name, and its date as the last resort for downloads.

    All files below ``path`` are one source, so comments of one thread belong together whatever files they are in; their
    order is that of file names, then of places in a file. A comment without thread or id has those of its file's name.
    """
    rows = json_rows(spark, path, recursive)
    link, comment = file_keys(F.regexp_replace("file_name", r"_flat\.json$", "_.json"))
    rows = rows.withColumns({"file_link": F.nullif(F.coalesce(F.nullif(link, F.lit("")), F.regexp_extract("file_name", r"^([^_]+)_flat\.json$", 1)), F.lit("")), "file_comment": F.nullif(comment, F.lit(""))})
    rows = rows.withColumns({"link_id": F.coalesce("link_id", F.concat(F.lit("t3_"), "file_link")), "id": F.coalesce("id", "file_comment")})
    return rows.select(F.lit(path).alias("source"), F.struct("file_name", "path", "n").alias("ord"), *COMMENT_FIELDS, "file_name", "file_link", "file_comment", F.date_format("modified", "yyyy-MM-dd").alias("file_date"))


def count_lines(spark: SparkSession, path: str) -> DataFrame:
    """One row, ``n``: the lines of an archive that aren't blank."""
    return spark.read.text(path).where(~X.is_blank(F.col("value"))).agg(F.count(F.lit(1)).alias("n"))


def count_objects(spark: SparkSession, path: str) -> DataFrame:
    """One row, ``n``: the comments in the JSON files below a folder."""
    return json_rows(spark, path).agg(F.count(F.lit(1)).alias("n"))


def read_names(spark: SparkSession, path: str) -> DataFrame:
    """A list of names, one a line: stripped, lower-cased, without blanks and repeats."""
    name = F.lower(X.py_strip(F.col("value")))
    return spark.read.text(path).select(name.alias("name")).where("name != ''").distinct()


def read_threads(spark: SparkSession, path: str) -> DataFrame:
    """A list of threads, one a line, with or without the prefix of submissions: ``link_id``, without blanks and repeats."""
    name = X.py_strip(F.col("value"))
    return spark.read.text(path).select(F.when(name.startswith("t3_"), name).otherwise(F.concat(F.lit("t3_"), name)).alias("link_id")).where("link_id != 't3_'").distinct()


def names(spark: SparkSession, listed: list[str]) -> DataFrame:
    """A list that the program holds. As one literal its size is known, so a join broadcasts it; of rows that come from Python Spark knows none, and shuffles the other side."""
    held = sorted({n.strip().lower() for n in listed if n.strip()})
    return spark.range(1).select(F.explode(F.split(F.lit("\n".join(held)), "\n")).alias("name")).where("name != ''")
