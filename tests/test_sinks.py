"""Whole records from scan to sink, and sinks that appear whole or not at all."""

import glob
import json
import os

import pyarrow as pa
import pytest
import zstandard
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from corpusloom.functions import records
from corpusloom.functions.shipping import BATCH_BYTES
from corpusloom.operators import tei
from corpusloom.plans import pipeline
from corpusloom.schema import DROPPED_FIELDS
from corpusloom.sources import readers, sink, writers

LINES = [
    '{"id":"a1","link_id":"t3_p","author":"x","body":"one","created_utc":1697128377.0,"subreddit":"s","score":5,"quarantined":false,"new_field":{"z":[1,2.50,{"q":null,"r":[]}],"a":1e3},"n":null}',
    '{"id":"a2","link_id":"t3_p","author":"x","body":"two 1.0, \\"2.0\\" \\\\ end","created_utc":1697128378,"edited":1.5,"big":123456789012345678901234567890,"neg":-0.0,"s":"1.0","é":"\\u00e9\\ud83d\\ude00"}',
    '{"id":"a3","id":"a4","link_id":"t3_p","author":null,"body":"three","created_utc":"1697128379","deep":[[[[1.0]]]],"empty":{},"long":"' + "\\n" * 30_000 + '"}',
    "[1]", "5", "{broken", "", '{"id": 1.0.0}',
]


def lines_of(folder):
    out = []
    for f in sorted(glob.glob(f"{folder}/*.zst")):
        with open(f, "rb") as raw:
            out += zstandard.ZstdDecompressor().stream_reader(raw).read().decode().splitlines()
    return out


def test_records_come_back_equal(spark, tmp_path):
    (tmp_path / "A_comments.ndjson").write_text("\n".join(LINES))
    wanted = [json.loads(x) for x in LINES[:3]]
    for turn in range(2):  # the second run replaces the first
        result = pipeline.run_archive(spark, str(tmp_path / "A_comments.ndjson"), str(tmp_path / "out"), grouped=bool(turn))
        got = {r["id"]: r for r in map(json.loads, lines_of(tmp_path / "out/filtered"))}
        assert got == {r["id"]: r for r in wanted}
        assert all(json.dumps(got[r["id"]], sort_keys=True) == json.dumps(r, sort_keys=True) for r in wanted)  # 1.0 and 1 are different
        assert [tuple(r) for r in result.reconciled.collect()] == [(3, 3, True)]
    files = [json.load(open(f)) for f in glob.glob(f"{tmp_path}/out/json/*/*.json")]
    pruned = [{k: v for k, v in r.items() if k not in DROPPED_FIELDS} for r in wanted]
    assert json.dumps(files, sort_keys=True) == json.dumps([pruned], sort_keys=True)
    assert "quarantined" in pruned[0] and "score" not in pruned[0]
    with pytest.raises(FileExistsError):
        pipeline.run_archive(spark, str(tmp_path / "A_comments.ndjson"), str(tmp_path / "out"), mode="errorifexists")


def test_lines_that_are_no_records(spark):
    rows = readers.parsed(spark.createDataFrame([("a", i, x) for i, x in enumerate(LINES)], "source string, ord long, value string"))
    assert [r["ord"] for r in rows.where("corrupt").orderBy("ord").collect()] == [3, 4, 5, 6, 7]
    assert [r["created_utc"] for r in rows.where("not corrupt").orderBy("ord").collect()] == ["1697128377.0", "1697128378", "1697128379"]


def test_numbers_keep_their_form(spark):
    numbers = ["0", "-1", "1.0", "1.50", "-0.0", "1e5", "1E-7", "12345678901234567890123", "123456789012345678", "1234567890123456789", "0.1e+3"]
    line = '{"a":[' + ",".join(numbers) + '],"b":"' + " ".join(numbers) + '"}'
    row = spark.createDataFrame([(line,)], "value string").select(records.to_json(records.fields(F.col("value"))).alias("x")).first()
    assert row["x"] == line


def docs(spark, names):
    return spark.createDataFrame([(n, f"text of {n}") for n in names], "file_name string, tei string")


def held(path):
    return {os.path.relpath(f, path): open(f).read() for f in glob.glob(f"{path}/*/*.xml")}


def test_runs_go_on_behind_each_other(spark, tmp_path):
    path = f"file://{tmp_path}/xml"
    writers.write_files(docs(spark, [f"a{i}.xml" for i in range(25)]), path, "tei", per_shard=10, mode="append")
    first = held(tmp_path / "xml")
    assert sink.last_place(path) == (3, 5)
    writers.write_files(docs(spark, [f"b{i}.xml" for i in range(17)]), path, "tei", per_shard=10, mode="append")
    both = held(tmp_path / "xml")
    assert len(both) == 42 and first.items() <= both.items() and sink.last_place(path) == (5, 2)
    assert max(len(os.listdir(tmp_path / "xml" / f"{i:05d}")) for i in range(1, 6)) == 10
    with pytest.raises(ValueError, match="b3.xml"):
        writers.write_files(docs(spark, ["c.xml", "b3.xml"]), path, "tei", per_shard=10, mode="append")
    with pytest.raises(FileExistsError):
        writers.write_files(docs(spark, ["c.xml"]), path, "tei")
    assert held(tmp_path / "xml") == both
    writers.write_files(docs(spark, ["c.xml"]), path, "tei", mode="overwrite")
    assert held(tmp_path / "xml") == {"00001/c.xml": "text of c.xml"}


@pytest.mark.parametrize("mode", ["overwrite", "append"])
def test_a_failed_task_leaves_what_was_there(spark, tmp_path, mode):
    path = str(tmp_path / "xml")
    writers.write_files(docs(spark, ["a.xml"]), path, "tei")
    rows = spark.range(200).repartition(4).select(F.lit("00002").alias("shard"), F.concat(F.lit("f"), F.col("id").cast("string")).alias("name"), F.when(F.col("id") == 77, F.raise_error(F.lit("no"))).otherwise("x").cast("string").alias("content"))
    with pytest.raises(PySparkException):
        sink.put(rows, path, "files", mode)
    assert held(path) == {"00001/a.xml": "text of a.xml"} and os.listdir(tmp_path) == ["xml"]


def test_other_schemes_are_refused(spark):
    for path in ("s3a://bucket/x", "hdfs:///x", "viewfs://store/x"):
        with pytest.raises(ValueError):
            writers.write_files(docs(spark, ["a.xml"]), path, "tei")
    assert sink.local("file:/a") == sink.local("file:///a") == sink.local("/a") == "/a"


def test_nothing_to_write(spark, tmp_path):
    writers.write_files(docs(spark, []), str(tmp_path / "x"), "tei")
    writers.write_archive(spark.createDataFrame([], "id string"), str(tmp_path / "y"), ["id"])
    assert held(tmp_path / "x") == {} and lines_of(tmp_path / "y") == []


def test_a_list_of_threads(spark, tmp_path):
    lines = [json.dumps({"id": f"c{i}", "link_id": f"t3_p{i % 7}", "author": "x", "body": f"text {i}", "created_utc": i}) for i in range(70)] + ['{"id":"x","link_id":null,"body":"y"}', "{broken"]
    (tmp_path / "A_comments.ndjson").write_text("\n".join(lines))
    (tmp_path / "list.txt").write_text("t3_p3\n p5 \n\nt3_p3\nnone\n")
    result = pipeline.run_archive(spark, str(tmp_path / "A_comments.ndjson"), str(tmp_path / "out"), only=str(tmp_path / "list.txt"))
    assert sorted(json.loads(x)["id"] for x in lines_of(tmp_path / "out/filtered")) == sorted(f"c{i}" for i in range(70) if i % 7 in (3, 5))
    assert result.documents.count() == 2
    lost = pipeline.lost_records(spark, str(tmp_path / "out"))
    assert lost.count() == 0


def test_lost_records_have_their_reasons(spark, tmp_path):
    body = lambda i, link, text: json.dumps({"id": i, "link_id": link, "author": "x", "body": text, "created_utc": 1, "permalink": None})
    lines = [body("a", "t3_p", "one"), body("a", "t3_p", "again"), body("a", "t3_q", "elsewhere"), body("b", "t1_a", "an answer"), body("c", "t3_q", "two"), body("d", "t3_r", "three")]
    (tmp_path / "A_comments.ndjson").write_text("\n".join(lines))
    pipeline.run_archive(spark, str(tmp_path / "A_comments.ndjson"), str(tmp_path / "out"))
    os.remove(next(f for f in glob.glob(f"{tmp_path}/out/json/*/*.json") if f.endswith("r_flat.json")))
    got = {(r["id"], r["link_id"], r["reason"], r["n"]) for r in pipeline.lost_records(spark, str(tmp_path / "out")).collect()}
    assert got == {("a", "t3_p", "repeat", 1), ("a", "t3_q", "repeat", 1), ("b", "t1_a", "no_submission", 1), ("d", "t3_r", "missing", 1)}


def test_whole_texts_go_to_python_in_small_batches(spark):
    """Long texts are split into batches by their bytes, not by 10,000 rows."""
    rows = spark.range(0, 400, numPartitions=1).select(F.expr("repeat('x', 50000)").alias("body"))
    tei.prepared(rows)

    def sizes(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.nbytes])], ["n"])

    held = [r["n"] for r in rows.mapInArrow(sizes, "n long").collect()]
    assert len(held) > 5 and max(held) < 2 * BATCH_BYTES
