"""Sinks: one file a document in numbered directories, filtered archives, tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.operators.threads import record_json, with_shard
from corpusloom.sources.sink import last_place, local, put

#: Folder of the names written so far, for runs that go on; readers pass over names that begin so.
MANIFEST = "_manifest"


def write_files(docs: DataFrame, path: str, content_col: str, name_col: str = "file_name", per_shard: int = 1000, mode: str = "errorifexists") -> DataFrame:
    """``path``/shard/name for every document; ``path`` must be a folder that all executors share. Returns (shard, name, path).

    Two documents of one name are an error, and nothing is written then. All of a run's files appear or none (see
    :mod:`~corpusloom.sources.sink`). ``mode`` ``append`` goes on behind the highest numbered folder, after the free places in
    it; names that earlier runs wrote are refused by a join with the manifest they left.
    """
    spark = docs.sparkSession
    number, held = last_place(path) if mode == "append" else (0, 0)
    named = docs.select(F.replace(F.col(name_col), F.lit("/"), F.lit("_")).alias("name"), F.col(content_col).alias("content"))
    # numbers follow from the names, so the uses below agree; only the one that writes files reads the contents
    rows = with_shard(named, "name", per_shard, first=max(0, number - 1) * per_shard + min(held, per_shard))
    names = rows.select("name")
    if number:
        names = names.unionByName(spark.read.schema("name string").parquet(f"file://{local(path)}/{MANIFEST}").join(names, "name", "left_semi"))
    twice = names.groupBy("name").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("name").limit(5).collect()
    if twice:
        raise ValueError(f"several documents are named {', '.join(str(r['name']) for r in twice)}")
    put(rows, path, "files", mode)
    rows.select("name", "shard").write.mode("append").parquet(f"file://{local(path)}/{MANIFEST}")
    return rows.select("shard", "name", F.concat(F.lit(local(path) + "/"), "shard", F.lit("/"), "name").alias("path"))


def write_archive(df: DataFrame, path: str, fields: list[str], level: int = 15, mode: str = "errorifexists", frame_lines: int = 50_000) -> None:
    """NDJSON as one ``part-N.zst`` a partition in ``path``, a folder that all executors share: whole records where rows carry them, else ``fields``. A frame ends every ``frame_lines``, so :mod:`~corpusloom.sources.frames` can split a file."""
    put(df.select(record_json(df, tuple(fields)).alias("line")), path, "lines", mode, level, frame_lines)


def write_table(df: DataFrame, path: str, by: str | None = None, form: str = "parquet", mode: str = "errorifexists") -> None:
    """Parquet, ORC or compressed JSON; ``by`` partitions the output."""
    writer = df.write.mode(mode).format(form)
    if form == "json":
        writer = writer.option("compression", "gzip")
    (writer.partitionBy(by) if by else writer).save(path)
