"""What a task reads, and how often a text is written or read, does not grow faster than the table."""

import glob
import json
import pathlib

import pytest
from pyspark.sql import functions as F

from corpusloom.functions import shared
from corpusloom.operators import threads
from corpusloom.plans import catalogue, catalogue_records, pipeline
from corpusloom.sources import writers
from corpusloom.streaming import arrivals


@pytest.fixture
def table(spark, tmp_path):
    spark.range(0, 600, numPartitions=6).selectExpr("id AS doc_id", "'some text' AS text", "'en' AS lang", "'src2' AS source").write.parquet(f"{tmp_path}/documents.parquet")
    return str(tmp_path)


def test_a_second_run_has_more_than_two_tasks(spark, table, monkeypatch):
    seen, write = [], writers.write_archive
    monkeypatch.setattr(writers, "write_archive", lambda df, *a, **k: seen.append(df.rdd.getNumPartitions()) or write(df, *a, **k))
    monkeypatch.setattr(catalogue_records, "stored", lambda df, what: shared.stored(df.repartition(12), what))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8k")
    try:
        catalogue_records.rerun_replaces(spark, table)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert seen[0] > 5 and 2 < seen[1] < seen[0]


def test_a_stream_takes_few_batches_however_many_files(spark, table, monkeypatch):
    folders = []
    monkeypatch.setattr(catalogue, "work", lambda s, what: folders.append(f"{table}/{what}") or f"file://{table}/{what}")
    monkeypatch.setattr(catalogue, "comment_view", lambda s, d, real=catalogue.comment_view: real(s, d).repartition(24))
    assert catalogue.stream_clean(spark, table).count() > 0
    assert 2 <= len([f for f in glob.glob(f"{folders[0]}/log/commits/*") if f.rsplit("/", 1)[1].isdigit()]) <= 3


def test_counts_clean_once(spark, table, monkeypatch):
    seen, real = [], catalogue.tagged
    monkeypatch.setattr(catalogue, "tagged", lambda s, d: seen.append(d) or real(s, d))
    assert catalogue.count_reconcile(spark, table).first()["filtered_n"] > 0 and len(seen) == 1


def test_lost_records_read_small_files_once(spark, tmp_path):
    line = json.dumps({"id": "a", "link_id": "t3_p", "author": "x", "body": "one", "created_utc": 1, "permalink": None})
    (tmp_path / "A_comments.ndjson").write_text(line)
    pipeline.run_archive(spark, str(tmp_path / "A_comments.ndjson"), str(tmp_path / "out"))
    plan = pipeline.lost_records(spark, str(tmp_path / "out"))._jdf.queryExecution().sparkPlan().toString()
    assert "FileScan json" not in plan


def test_contents_are_stored_once_before_they_become_files(spark, tmp_path, monkeypatch):
    seen, real = [], shared.shared_dir
    monkeypatch.setattr(shared, "shared_dir", lambda s, what: seen.append(what) or real(s, what))
    docs = spark.range(50).select(F.concat("id", F.lit(".xml")).alias("file_name"), F.lit("x").alias("tei"))
    made = writers.write_files(docs, str(tmp_path / "x"), "tei", per_shard=10)
    assert seen == ["sharded"]
    listed = sorted(p[len(str(tmp_path)) + 1 :] for p in glob.glob(f"{tmp_path}/x/*/*.xml"))
    assert sorted(r["path"][len(str(tmp_path)) + 1 :] for r in made.collect()) == listed and len(listed) == 50


def test_arriving_threads_leave_their_texts_on_disk_once(spark, tmp_path, monkeypatch):
    words = F.concat_ws(" ", F.transform(F.sequence(F.lit(1), F.lit(60)), lambda i: F.sha2(F.concat("id", F.lit(" "), i).cast("string"), 256)))
    spark.range(0, 400, numPartitions=4).select(F.col("id").alias("doc_id"), words.alias("text"), F.lit("en").alias("lang"), F.lit("src2").alias("source")).write.parquet(f"{tmp_path}/documents.parquet")
    folders = []
    monkeypatch.setattr(catalogue_records, "work", lambda s, what: folders.append(f"{tmp_path}/{what}") or f"file://{tmp_path}/{what}")
    got = {r["file_name"]: r["tei"] for r in catalogue_records.stream_threads(spark, str(tmp_path)).collect()}
    held = sum(f.stat().st_size for f in pathlib.Path(folders[0]).rglob("*") if f.is_file())
    assert held < 2 * 400 * 60 * 65  # arrivals, changes, state and versions once had them all again
    assert got == {r["file_name"]: r["tei"] for r in catalogue.tei_grouped(spark, str(tmp_path)).collect()} and len(got) == 50


def test_texts_that_lie_apart_meet_their_own_rows(spark, tmp_path):
    """Also where rows share their id and place: metadata and text are of one row."""
    row = lambda i, o, t, b: ("s", o, i, f"t3_{t}", b, b, None)
    names = ("source", "ord", "id", "link_id", "author", "body", "permalink")
    rows = spark.createDataFrame([row("a", 1, "p", "one"), row("a", 1, "p", "two"), row("b", 2, "p", "[deleted]"), row("c", 3, "q", "")], ", ".join(f"{n} {'long' if n == 'ord' else 'string'}" for n in names))
    rows = rows.select(*(F.col("body" if n == "text" else n).alias(n) if n in (*names, "text") else F.lit(None).cast("string").alias(n) for n in arrivals.KEPT))
    sent = arrivals.apart(rows, f"{tmp_path}/texts")
    assert {r["body"] for r in sent.collect()} == {"", "[deleted]"} and len({r["text"] for r in sent.collect()}) == 4
    items = F.array_sort(F.collect_list(F.struct(*(n for n in arrivals.KEPT if n != "source"))))
    firsts = sent.dropDuplicates(["source", "id"])
    versions = firsts.groupBy("source", threads.thread_id(F.col("link_id")).alias("thread_id")).agg(items.alias("items")).select("source", "thread_id", F.lit("open").alias("state"), "items", F.lit(3).alias("epoch"))
    versions = versions.unionByName(versions.limit(1).select("source", F.lit("z").alias("thread_id"), "state", F.slice("items", 1, 0).alias("items"), "epoch"))
    got = {r["thread_id"]: r["items"] for r in arrivals.with_texts(versions, spark.read.parquet(f"{tmp_path}/texts"), 3).collect()}
    assert [(i["id"], i["text"] == (i["author"] if i["id"] != "b" else "[deleted]")) for i in got["p"]] == [("a", True), ("b", True)]
    assert [(i["id"], i["text"]) for i in got["q"]] == [("c", "")] and got["z"] == []
