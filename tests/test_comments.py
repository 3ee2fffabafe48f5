"""The cleaning stage, extraction, threads and documents on small made-up rows."""

import os
import json
import random

import pytest
import zstandard

from corpusloom.functions import text as X
from corpusloom.operators import comments, tei, threads, validate
from corpusloom.plans import pipeline
from corpusloom.schema import COMMENT, COMMENT_FIELDS
from corpusloom.sources import readers, writers
from corpusloom.streaming import clean as streaming
from pyspark.sql import functions as F
from pyspark.sql import types as T

SCHEMA = T.StructType([T.StructField("source", T.StringType()), T.StructField("ord", T.LongType()), *COMMENT.fields])


def rows(spark, *given):
    """(ord, id, link, author, body, created) and what else a test names."""
    out = []
    for i, g in enumerate(given):
        d = {"source": "s", "ord": i, "link_id": "t3_t", "author": "ann", "created_utc": "1688823816", "subreddit": "Sub"} | g
        out.append(tuple(d.get(f) for f in SCHEMA.names))
    return spark.createDataFrame(out, SCHEMA)


def test_reasons_and_counters(spark):
    df = rows(
        spark,
        {"id": "a", "author": "BotA", "body": "[deleted]"},
        {"id": "b", "body": " [removed] "},
        {"id": "c", "body": "https://a.b/c"},
        {"id": "d", "body": "look https://a.b"},
        {"id": "e", "body": "[www.x.y](http://z.z)"},
        {"id": "f", "body": "!remindme 2"},
        {"id": "g", "body": "> q"},
        {"id": "h", "body": "[URL]"},
        {"id": "i", "body": None, "author": None},
        {"id": "j", "body": "  padded > x  "},
        {"id": "k", "body": "> q\nreply"},
    )
    tagged = comments.tag(df, readers.names(spark, ["bota ", ""]))
    got = {r.id: (r.drop_reason, r.body) for r in tagged.collect()}
    assert {k: v[0] for k, v in got.items()} == {"a": "bot", "b": "deleted", "c": "url_only", "d": None, "e": "url_marks", "f": "reminder", "g": "empty", "h": None, "i": "empty", "j": None, "k": None}
    assert got["d"][1] == "look [URL]" and got["j"][1] == "  padded > x  " and got["k"][1] == "reply"
    assert comments.counters(tagged).first().asDict() == {"bots": 1, "deleted": 1, "quotes": 2, "reminders": 1, "urls": 3, "url_only": 1}
    assert {r.id for r in comments.audit(tagged).collect()} == {"b", "c", "d", "e", "f", "g", "i", "k"}
    assert comments.bot_counts(tagged).collect()[0].asDict() == {"author": "bota", "n": 1}
    assert comments.tag(df.limit(0)).count() == 0


def test_flags_off_keep_rows(spark):
    df = rows(spark, {"id": "a", "body": "[deleted]"}, {"id": "b", "body": "http://a.b > x"}, {"id": "c", "body": "!remindme x"})
    off = comments.Config(deleted=False, quotes=False, reminders=False, urls=False)
    assert comments.kept(comments.tag(df, None, off)).count() == 3
    assert comments.kept(comments.tag(df, None, comments.Config(inline=True))).count() == 1


def test_first_of_id_and_prune(spark):
    df = rows(spark, {"id": "a", "body": "1"}, {"id": "a", "body": "2"}, {"id": "b", "body": "3", "link_id": "t1_x"})
    assert [r.body for r in threads.first_of_id(threads.extract(df)).collect()] == ["1"]
    fields = spark.range(1).select(threads.prune(F.from_json(F.lit('{"id": "x", "score": 3, "quarantined": false, "_meta": {}}'), "map<string,string>")).alias("m")).first().m
    assert set(fields) == {"id", "quarantined"}


def grouped(df, **options):
    return tei.grouped(threads.threads(tei.prepared(df, strict=options.get("strict", False))), **options)


def test_grouped_header_and_body(spark):
    link = "/r/Gardens/comments/q7x/first_tomatoes_of_the_year/"
    common = {"link_id": "t3_q7x", "subreddit": "Gardens", "retrieved_on": "1700100000"}
    df = rows(
        spark,
        common | {"id": "k1", "permalink": link + "k1/", "body": "one & <two>\nhi /u/mira", "created_utc": "1700000000"},
        common | {"id": "k2", "permalink": link + "k2/", "body": "&amp;gt; ok\x0b", "author": "j<o", "created_utc": "1700086400"},
        common | {"id": "k3", "permalink": link + "k3/", "body": "[deleted]", "created_utc": "1700086401"},
    )
    doc = grouped(df).first()
    assert doc.file_name == "q7x.xml" and doc.n_items == 2 and doc.xml_ok and validate.problem(doc.tei) is None
    assert "<bibl>Reddit/Gardens: first_tomatoes_of_the_year, 2023-11-15</bibl>" in doc.tei
    assert '            <ptr type="URL" target="https://www.reddit.com/r/Gardens/comments/q7x/"/>\n            <date type="last_comment">2023-11-15</date>' in doc.tei
    assert '<item source="https://www.reddit.com/r/Gardens/comments/q7x/comment/k1/">one &amp; &lt;two&gt;<lb/>hi mira<date>2023-11-14</date> <name>ann</name> </item>' in doc.tei
    assert "&gt; ok <date>" in doc.tei and "<name>j&lt;o</name>" in doc.tei
    assert grouped(df, strict=True).count() == 0


def test_single_header(spark):
    df = rows(spark, {"id": "k9", "link_id": "t3_q8y", "author": "mira", "subreddit": "Gardens", "permalink": "/r/Gardens/comments/q8y/when_to_sow/k9/", "body": "x", "created_utc": "1700000000.0", "retrieved_utc": "1700000010"})
    doc = tei.single(threads.single_comments(df)).first()
    assert doc.file_name == "q8y_k9.xml" and validate.problem(doc.tei) is None
    for part in ('<title type="main" level="a">when_to_sow</title>\n            <author>mira</author>', '<ptr type="comment" target="https://www.reddit.com/r/Gardens/comments/q8y/comment/k9/"/>', '<title type="sub" level="m">Gardens</title>', '<date type="download">2023-11-14</date>'):
        assert part in doc.tei


def test_thread_of_deleted_comments_has_no_document(spark):
    assert grouped(rows(spark, {"id": "a", "body": "[deleted]"})).count() == 0


@pytest.mark.parametrize("xml", [None, "", "<TEI>", "<TEI/>", tei.START + tei.END, tei.START.replace("\n", "") + "<text><body><div><list/></div></body></text></TEI>"])
def test_invalid_documents(xml):
    assert validate.problem(xml)


def test_shards_and_reconcile(spark):
    df = spark.range(2501).select(F.concat(F.lit("f"), F.col("id")).alias("name"))
    found = {r["shard"]: r["count"] for r in threads.with_shard(df, "name").groupBy("shard").count().collect()}
    assert found == {"00001": 1000, "00002": 1000, "00003": 501}
    assert threads.reconcile(df, df.limit(5)).first().asDict() == {"filtered_n": 2501, "emitted_n": 5, "matches": False}


def test_dtd(spark, tmp_path):
    dtd = validate.Dtd('<!ENTITY % inner "b | i"><!ELEMENT a (c, (%inner;)*)><!ELEMENT b (#PCDATA)><!ELEMENT i EMPTY><!ELEMENT c ANY><!ATTLIST a k (x|y) "x" id ID #REQUIRED>')
    good = ['<a id="1"><c>t<b>z</b></c><b>q</b><i/></a>', '<a id="1" k="y"><c/></a>']
    bad = {'<a><c/></a>': "missing", '<a id="1"><b/></a>': "model", '<a id="1" k="z"><c/></a>': "can't be z", '<a id="1"><c/>t</a>': "text in a", '<a id="1"><c/><i>t</i></a>': "text in i", '<a id="1" z=""><c/></a>': "declared", '<x/>': "declared"}
    assert [dtd.problem(x) for x in good] == [None, None] and all(what in dtd.problem(x) for x, what in bad.items())
    (tmp_path / "a.dtd").write_text("<!ELEMENT a EMPTY>")
    docs = spark.createDataFrame([("1", "<a/>"), ("2", "<a>x</a>"), ("3", None)], "file_name string, tei string")
    assert [r.valid for r in validate.validate(docs, dtd=validate.read_dtd(spark, str(tmp_path / "a.dtd"))).orderBy("file_name").collect()] == [True, False, False]


def test_files_of_one_name_are_refused(spark, tmp_path):
    docs = spark.createDataFrame([("a/b", "x"), ("a_b", "y")], "file_name string, tei string")
    with pytest.raises(ValueError, match="a_b"):
        writers.write_files(docs, str(tmp_path / "out"), "tei")
    assert not (tmp_path / "out").exists()


def test_a_thread_over_several_files_is_one_document(spark, tmp_path):
    one = {"link_id": "t3_q7", "author": "Mira", "created_utc": 1700000000, "subreddit": "Gardens"}
    for folder, name, comments_ in (("00001", "q7_k1.json", [one | {"id": "k1", "body": "first"}]), ("00002", "q7_k2.json", [one | {"id": "k2", "body": "second"}]), ("00002", "q9_k5.json", [{"author": "Jo", "body": "no keys", "created_utc": "x"}])):
        (tmp_path / "in" / folder).mkdir(parents=True, exist_ok=True)
        (tmp_path / "in" / folder / name).write_text(json.dumps(comments_, indent=4))
        os.utime(tmp_path / "in" / folder / name, (1690000000, 1690000000))
    docs = {r.file_name: r for r in pipeline.run_json(spark, str(tmp_path / "in")).collect()}
    assert set(docs) == {"q7.xml", "q9.xml"} and docs["q7.xml"].n_items == 2
    assert docs["q7.xml"].tei.index("first") < docs["q7.xml"].tei.index("second") and '<date type="download">2023-07-22</date>' in docs["q7.xml"].tei
    assert "comment/k5/" in docs["q9.xml"].tei
    assert pipeline.run_json(spark, str(tmp_path / "in"), grouped=False).count() == 3
    assert pipeline.run_json(spark, str(tmp_path / "in/00001"), recursive=False).count() == 1


def test_cli_and_demo(spark, tmp_path, capsys):
    from examples import demo

    folder = demo.main(str(tmp_path))
    assert sorted(os.listdir(f"{folder}/Gardens_grouped/xml/00001")) == ["q7.xml", "q9.xml"]
    assert sorted(os.listdir(f"{folder}/Gardens_nogroup/xml/00001")) == ["q7_k1.xml", "q7_k3.xml", "q9_k5.xml"]
    assert sorted(os.listdir(f"{folder}/again/json_xml/00001")) == ["q7.xml", "q9.xml"]
    assert "true" in capsys.readouterr().out
    assert readers.count_lines(spark, f"{folder}/Gardens_grouped/filtered").first().n == 3 == readers.count_objects(spark, f"{folder}/Gardens_grouped/json").first().n


def test_a_cluster_needs_a_shared_folder(spark, monkeypatch):
    from types import SimpleNamespace

    from corpusloom.functions import shared

    context = SimpleNamespace(master="spark://there:7077", getConf=lambda: SimpleNamespace(get=lambda *a: None))
    with pytest.raises(RuntimeError, match="checkpoint"):
        shared.shared_dir(SimpleNamespace(sparkContext=context, conf=SimpleNamespace(get=lambda *a: None)), "x")


def archive(path, lines, **options):
    with open(path, "wb") as f:
        f.write(zstandard.ZstdCompressor(**options).compress("\n".join(lines).encode()))


def test_archive_round_trip(spark, tmp_path):
    one = {"id": "a", "link_id": "t3_t", "author": "Ann", "body": "hello *there*\nyou", "created_utc": 1688823816.0, "subreddit": "Sub", "edited": False, "gildings": {}}
    lines = [json.dumps(one), "{broken", json.dumps(one | {"body": "again"}), json.dumps(one | {"id": "b", "link_id": "t1_q"}), json.dumps(one | {"id": "c", "body": "~~x~~", "author": None})]
    archive(tmp_path / "Sub_comments.zst", lines)
    path = str(tmp_path / "Sub_comments.zst")
    read = readers.read_archive(spark, path, raw_inline=True)
    assert [r.body for r in read.orderBy("ord").collect()] == ["hello there\nyou", "again", "hello there\nyou", ""]
    assert readers.quarantine(spark, path).count() == 1
    assert readers.community(read).first().community == "Sub"
    result = pipeline.run_archive(spark, path, str(tmp_path / "out"))
    assert result.documents.count() == 1 and result.validation.where("valid").count() == 1
    assert result.reconciled.first().asDict() == {"filtered_n": 3, "emitted_n": 1, "matches": False}
    assert os.listdir(tmp_path / "out/xml/00001") == ["t.xml"] and validate.validate_directory(spark, str(tmp_path / "out/xml")).where("valid").count() == 1
    assert json.loads((tmp_path / "out/json/00001/t_flat.json").read_text())[0]["id"] == "a"
    again = pipeline.run_json(spark, str(tmp_path / "out/json"))
    assert again.select("tei").first() == result.documents.select("tei").first() or again.count() == 1
    writers.write_archive(result.extracted, str(tmp_path / "filtered"), list(COMMENT_FIELDS))
    assert readers.read_archive(spark, str(tmp_path / "filtered")).count() == 1


def test_long_window_archive(spark, tmp_path):
    params = zstandard.ZstdCompressionParameters(window_log=28, compression_level=1, enable_ldm=True)
    with open(tmp_path / "x.zst", "wb") as f:
        f.write(zstandard.ZstdCompressor(compression_params=params).compress(b'{"id": "a"}\n{"id": "b"}'))
    assert [r.id for r in readers.read_archive(spark, str(tmp_path / "x.zst"), long_window=True).orderBy("ord").collect()] == ["a", "b"]


def test_names(spark, tmp_path):
    (tmp_path / "bots.txt").write_text("AutoMod \n\n  x\nX\n")
    assert sorted(r.name for r in readers.read_names(spark, str(tmp_path / "bots.txt")).collect()) == ["automod", "x"]


def test_stream_takes_up_where_it_stopped(spark, tmp_path):
    df = rows(spark, {"id": "a", "body": "[deleted]"}, {"id": "b", "body": "fine"})
    for turn in (1, 2):
        df.write.mode("append").parquet(str(tmp_path / "in"))
        stream = streaming.read_stream(spark, str(tmp_path / "in"), df.schema, files_per_batch=1)
        streaming.run_available(streaming.clean(stream), str(tmp_path / "out"), str(tmp_path / "log"))
        assert spark.read.parquet(str(tmp_path / "out")).count() == turn


def test_a_list_of_names_does_not_shuffle_the_comments(spark):
    """The list's size is known before anything runs, so it is broadcast; texts were shuffled by author, of whom there are few."""
    given = rows(spark, {"id": "a", "author": "Bot", "body": "x"}, {"id": "b", "author": "ann", "body": "y"})
    tagged = comments.tag(given, readers.names(spark, [" BOT ", "bot", "", "other"]))
    plan = tagged._jdf.queryExecution().sparkPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    assert [r["id"] for r in comments.kept(tagged).collect()] == ["b"]
    assert readers.names(spark, []).count() == 0


@pytest.mark.parametrize("name", ["py_strip", "plain_urls", "markdown_urls", "inline_formatting", "escaped_quotes", "modern_quotes", "zero_width_marks", "newlines", "mentions", "separators"])
def test_a_look_before_a_change_misses_nothing(spark, name):
    """Texts glued together of what the patterns are about: the same with the look and without it."""
    random.seed(name)
    parts = ["a", "é", " ", "\u2003", "\n", "\n\n", "\x1c", "\x1e", "\x00", "&gt;", ">", "*", "**", "~~", "/u/", "www.a.b", "WwW.x.y", "HTTPS://a.b/c", "http\u017f://a", "[", "](", ")", "]", "\ue000", "\ue001", "&amp;#x200B;", "&#x200B;", "\\u200B"]
    texts = ["".join(random.choices(parts, k=random.randrange(9))) for _ in range(3000)] + [*parts, "", None]
    df = spark.createDataFrame([(t,) for t in texts], "c string")
    made = getattr(X, name)
    with pytest.MonkeyPatch.context() as m:
        m.setattr(X, "_where", lambda found, changed, c: changed)
        always = made(F.col("c"))
    assert df.where(~made(F.col("c")).eqNullSafe(always)).collect() == []
