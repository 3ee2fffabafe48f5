"""Threads that grow from arrivals: corrections across threads, closing by timer, late comments, restarts."""

import os

from pyspark.sql import functions as F

from corpusloom.plans import catalogue_records
from corpusloom.streaming import arrivals

NAMES = arrivals.KEPT


def arrive(spark, folder, rows):
    """Append one file of (ord, id, link, body)."""
    none = dict.fromkeys(NAMES)
    full = [tuple({**none, "source": "s", "ord": o, "id": i, "link_id": f"t3_{t}", "body": b, "text": b, "author": "x", "created_utc": "1"}[n] for n in NAMES) for o, i, t, b in rows]
    schema = ", ".join(f"{n} {'long' if n == 'ord' else 'string'}" for n in NAMES)
    spark.createDataFrame(full, schema).coalesce(1).write.mode("append").parquet(f"{folder}/in")
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{folder}/in")


def step(spark, folder, rows, idle_ms=None):
    arrivals.run(arrivals.first_rows(arrive(spark, folder, rows)), f"{folder}/changes", f"{folder}/first")
    changes = spark.readStream.schema(arrivals.CHANGE).parquet(f"{folder}/changes/*")
    arrivals.run(arrivals.growing_threads(changes, idle_ms), f"{folder}/threads", f"{folder}/state")


def now(spark, folder):
    last = arrivals.latest(spark.read.parquet(f"{folder}/threads"), "source", "thread_id")
    return {r.thread_id: (r.state, [(i.ord, i.id, i.body) for i in r["items"]]) for r in last.collect()}


def test_an_earlier_row_moves_its_id_to_another_thread(spark, tmp_path):
    folder = f"file://{tmp_path}"
    step(spark, folder, [(10, "a", "p", "ten"), (11, "b", "p", "eleven"), (12, "a", "q", "later repeat")])
    assert now(spark, folder) == {"p": ("open", [(10, "a", "ten"), (11, "b", "eleven")])}
    step(spark, folder, [(5, "a", "q", "five"), (6, "a", "p", "six"), (20, "c", "p", "twenty")])
    assert now(spark, folder) == {"p": ("open", [(11, "b", "eleven"), (20, "c", "twenty")]), "q": ("open", [(5, "a", "five")])}
    step(spark, folder, [(1, "b", "q", "one"), (2, "c", "q", "two")])
    assert now(spark, folder) == {"p": ("open", []), "q": ("open", [(1, "b", "one"), (2, "c", "two"), (5, "a", "five")])}
    docs = arrivals.documents(spark.read.parquet(f"{folder}/threads").where(F.col("epoch") == 2)).collect()
    assert {r.thread_id: r.n_items for r in docs} == {"p": None, "q": 3}


def test_an_idle_thread_is_closed_and_takes_nothing_more(spark, tmp_path):
    folder = f"file://{tmp_path}"
    step(spark, folder, [(1, "a", "p", "one")], idle_ms=1)
    step(spark, folder, [(2, "b", "q", "two")], idle_ms=1)
    step(spark, folder, [(3, "c", "p", "three")], idle_ms=1)
    got = now(spark, folder)
    assert got["p"] == ("closed", [(1, "a", "one")]) and got["q"][1] == [(2, "b", "two")]
    late = spark.read.parquet(f"{folder}/threads").where("state = 'late'").collect()
    assert [(r.thread_id, [i.id for i in r["items"]]) for r in late] == [("p", ["c"])]


def test_a_turn_is_dealt_over_many_files(spark):
    rows = spark.range(0, 4000, numPartitions=4).select(F.lit("s").alias("source"), F.col("id").alias("ord"), F.col("id").cast("string").alias("id"), *(F.lit(None).cast("string").alias(n) for n in NAMES if n not in ("source", "ord", "id", "text")))
    seen = []

    def batches(stream, folder):
        arrivals.run(stream, f"{folder}/out-{len(seen)}", f"{folder}/log")
        held = spark.read.parquet(f"{folder}/out-{len(seen)}")
        seen.append((held.select("epoch").distinct().count(), held.count()))

    folder = catalogue_records.arriving(spark, "", rows, "test")(batches)
    assert [n for n, _ in seen] == [3, 2] and sum(n for _, n in seen) == 4000
    files = spark.read.parquet(f"{folder}/in").groupBy(F.input_file_name()).count()
    assert files.agg(F.max("count")).first()[0] < 4000 / 5 / 2  # a single task once wrote and read a whole turn


def test_parts_of_state_grow_with_the_input(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(arrivals, "PART_BYTES", 100)
    folder = f"file://{tmp_path}"
    stream = arrive(spark, folder, [(1, "a", "p", "one"), (2, "b", "q", "two")])
    size = sum(f.stat().st_size for f in (tmp_path / "in").glob("*.parquet"))
    parts = arrivals.parts_for(spark, f"{folder}/in")
    assert parts == -(-size // 100) > int(spark.conf.get("spark.sql.shuffle.partitions"))
    arrivals.run(arrivals.first_rows(stream), f"{folder}/changes", f"{folder}/first", parts=parts)
    assert len([n for n in os.listdir(tmp_path / "first/state/0") if n.isdigit()]) == parts
    assert spark.conf.get("spark.sql.shuffle.partitions") == "4"
    again = arrivals.latest(spark.read.parquet(f"{folder}/changes"), "source", "id", parts=parts)
    assert again.rdd.getNumPartitions() == parts and again.count() == 2


def test_a_batch_becomes_documents_without_reading_its_state_twice(spark):
    schema = arrivals.THREAD
    item = lambda n, b: (n, f"c{n}", "t3_p", "x", "1", None, None, None, None, b, b)
    made = arrivals.documents(spark.createDataFrame([("s", "p", "open", [item(1, "one")]), ("s", "q", "open", []), ("s", "r", "closed", [item(2, "[deleted]")]), (None, "p", "open", [item(3, "x")])], schema))
    assert "Join" not in made._jdf.queryExecution().optimizedPlan().toString()
    assert {(r.source, r.thread_id): (r.n_items, r.tei is None, r.file_name, r.xml_ok) for r in made.collect()} == {("s", "p"): (1, False, "p.xml", True), ("s", "q"): (None, True, None, None), ("s", "r"): (None, True, None, None), (None, "p"): (1, False, "p.xml", True)}
