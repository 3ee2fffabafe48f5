"""Folders of many small files: the driver sees folders, tasks list and read the files."""

import json
import os

import pytest
from pyspark.sql import functions as F

from corpusloom.plans import catalogue, catalogue_records
from corpusloom.schema import COMMENT
from corpusloom.sources import folders, readers


@pytest.fixture
def table(spark, tmp_path):
    spark.range(0, 300, numPartitions=3).selectExpr("id AS doc_id", "'some text' AS text", "'en' AS lang", "'src2' AS source").write.parquet(f"{tmp_path}/documents.parquet")
    return str(tmp_path)


def plan(df):
    return df._jdf.queryExecution().sparkPlan().toString()


def test_single_comments_are_not_listed_on_the_driver(spark, table):
    docs = catalogue.json_reentry(spark, table)
    assert "FileScan json" not in plan(docs) and "MapInArrow" in plan(docs)
    assert docs.agg(F.sum("n_items")).first()[0] == catalogue.tei_nogroup(spark, table).count()


def put(root, name, content):
    os.makedirs(os.path.dirname(f"{root}/{name}"), exist_ok=True)
    with open(f"{root}/{name}", "wb") as f:
        f.write(content)


def test_files_are_read_as_spark_reads_them(spark, tmp_path, monkeypatch):
    good = '[{"id":"a","link_id":"t3_p","body":"é","created_utc":1.0},{"id":null,"body":5,"subreddit":{"x":1}}]'
    files = {"00001/p_a.json": good.encode(), "00001/p_b.json": good.encode("utf-8-sig"), "00001/p_c.json": b'[{"id":"\xff\xfe","body":"x"}]', "00002/p_d.json": b'{"id":"o","body":"one"}', "00002/p_e.json": b"", "00002/p_f.json": b" \n"}
    files |= {f"00002/p_{n}.json": c for n, c in zip("ghijklmn", [b"[]", b'[{"id":"x"},{"id":', b"5", b"null", b'[{"id":"x"}] end', b"[{}]", b'[{"id":"x"},5]', b'[{"id":"x","body":"a\nb"}]'], strict=True)}
    files |= {"00001/p_s.json": b'[{"id":"1"}]', "00003/p_s.json": b'[{"id":"2"},{"id":"3"}]', "00003/a/b/q_x_y.json": good.encode(), "top_x.json": good.encode(), "00003/x_flat.json": good.encode()}
    files |= {"_manifest/p_z.json": good.encode(), "00003/.p_z.json": good.encode(), "00003/p_z.txt": b"x"}
    for name, content in files.items():
        put(tmp_path, name, content)
    columns = [*COMMENT.names, "file_name", "file_link", "file_comment", "file_date"]
    got, counted = [], []
    for _ in range(2):
        got.append([sorted(map(str, readers.read_json_documents(spark, f"file://{tmp_path}", deep).select(*columns).collect())) for deep in (True, False)])
        counted.append(readers.count_objects(spark, str(tmp_path)).first().n)
        monkeypatch.setattr(readers, "shared_folder", lambda *a: None)
    assert got[0] == got[1] and counted[0] == counted[1] == len(got[0][0]) and len(got[0][1]) == 2


def test_files_in_utf_16_are_read_whole(spark, tmp_path):
    put(tmp_path, "p_a.json", '[{"id":"a","created_utc":1.0,"body":5}]'.encode("utf-16"))
    assert [(r["id"], r["created_utc"], r["body"]) for r in readers.read_json_documents(spark, str(tmp_path)).collect()] == [("a", "1.0", "5")]


def test_files_of_one_folder_are_many_tasks_to_read_and_few_where_there_are_many(spark, tmp_path, monkeypatch):
    for i in range(200):
        put(tmp_path, f"flat/p_{i}.json", json.dumps([{"id": f"c{i}"}]).encode())
    rows = readers.read_json_documents(spark, f"{tmp_path}/flat")
    assert rows.rdd.getNumPartitions() == 4 and len({r["id"] for r in rows.select("id").collect()}) == 200  # 32 files a task once, whatever their size
    monkeypatch.setattr(folders, "READ_FILES", 20)
    assert readers.read_json_documents(spark, f"{tmp_path}/flat").rdd.getNumPartitions() == 10
    monkeypatch.setattr(folders, "READ_BYTES", 100)
    assert readers.read_json_documents(spark, f"{tmp_path}/flat").rdd.getNumPartitions() > 20


def test_the_driver_goes_down_to_where_folders_are_many(tmp_path):
    for i in range(9):
        put(tmp_path, f"a/b/{i}/c/x.json", b"[]")
    put(tmp_path, "a/y.json", b"[]")
    root, many = str(tmp_path), sorted(f"{tmp_path}/a/b/{i}" for i in range(9))
    found = folders.folders(root, 5)
    assert sorted(f for f, below in found if below) == many and [f for f, below in found if not below] == [root, f"{root}/a", f"{root}/a/b"]
    for wanted in (1, 5, 100):
        files = [e.path for f, below in folders.folders(root, wanted) for e in folders.files_of(f, below)]
        assert len(files) == len(set(files)) == 10


def test_an_empty_folder_has_no_files(spark, tmp_path):
    assert folders.listed(spark, str(tmp_path)).count() == 0 and readers.read_json_documents(spark, str(tmp_path)).count() == 0


def test_written_files_are_listed_by_tasks(spark, table):
    files = catalogue.written_files(spark, table)
    assert "binaryFile" not in plan(files) and "MapInArrow" in plan(files)
    assert files.count() == catalogue.tei_nogroup(spark, table).count() > 200
    assert files.groupBy("shard").count().agg(F.max("count")).first()[0] == 50


def test_folders_that_go_on_are_listed_by_tasks(spark, table):
    shards = catalogue_records.shards_go_on(spark, table)
    assert "binaryFile" not in plan(shards) and "MapInArrow" in plan(shards)
    assert shards.agg(F.sum("files")).first()[0] == catalogue.tei_nogroup(spark, table).count()
