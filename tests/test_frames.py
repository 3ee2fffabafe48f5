"""Frames of archives: where they end, lines across them, cut and foreign files."""

import io
import os
import random

import pytest
import zstandard
from pyspark.errors import PySparkException

from corpusloom.plans import catalogue_records
from corpusloom.sources import frames


def made(parts, **more):
    return b"".join(zstandard.ZstdCompressor(**more).compress(p) for p in parts)


@pytest.mark.parametrize("more", [{}, {"write_checksum": True}, {"write_content_size": False}, {"level": 19}])
def test_where_frames_end(more):
    random.seed(1)
    parts = [b"", b"x", b"a" * 300_000, random.randbytes(400_000), b"line\n" * 70_000]
    whole = [made([p], **more) for p in parts]
    skipped = b"\x50\x2a\x4d\x18" + (5).to_bytes(4, "little") + b"hello"
    data = whole[0] + whole[1] + skipped + b"".join(whole[2:])
    found = frames.frames(io.BytesIO(data), len(data))
    assert [data[a:b] for a, b in found] == whole[1:]  # the first holds nothing


def test_lines_across_frames(spark, tmp_path):
    random.seed(2)
    text = "".join(random.choice(["a", "é", "line ", "\n", "\r\n", "x" * 50]) for _ in range(6000))
    raw = text.encode() + b"\xff\nlast"
    cuts = sorted(random.sample(range(len(raw)), 40))
    parts = [raw[a:b] for a, b in zip([0, *cuts], [*cuts, len(raw)], strict=True)]
    (tmp_path / "A.zst").write_bytes(made(parts))
    (tmp_path / "B.zst").write_bytes(made([b"one\ntwo\n"]))
    (tmp_path / "C.zst").write_bytes(made([b"no newline", b"", b" in the frame", b"", b"", b" before\nnext", b""]))
    (tmp_path / "D.zst").write_bytes(b"")
    rows = frames.frame_lines(spark, str(tmp_path / "*.zst"), range_bytes=1)
    assert rows.rdd.getNumPartitions() > 20
    got = {}
    for r in sorted(rows.collect(), key=lambda r: (r.source, r.ord)):
        got.setdefault(os.path.basename(r.source), []).append(r.value)
    assert got == {"A.zst": raw.decode("utf-8", "replace").split("\n"), "B.zst": ["one", "two"], "C.zst": ["no newline in the frame before", "next"]}


def test_long_window_and_cut_files(spark, tmp_path):
    more = {"compression_params": zstandard.ZstdCompressionParameters(window_log=27)}
    (tmp_path / "A.zst").write_bytes(made([b"a\n" * 1000, b"b\n" * 10], **more))
    assert frames.frame_lines(spark, str(tmp_path / "A.zst"), range_bytes=1).count() == 1010
    data = made([b"a\n" * 1000, random.randbytes(5000)])
    (tmp_path / "A.zst").write_bytes(data[:-100])
    with pytest.raises(PySparkException):
        frames.frame_lines(spark, str(tmp_path / "A.zst"), range_bytes=1).count()


def test_the_query_writes_with_many_tasks(spark, tmp_path, monkeypatch):
    spark.range(0, 2000, numPartitions=4).selectExpr("id AS doc_id", "concat_ws(' ', transform(sequence(1, 60), i -> hex(xxhash64(id, i)))) AS text", "'en' AS lang", "'src1' AS source").write.parquet(f"{tmp_path}/documents.parquet")
    folders = []
    monkeypatch.setattr(catalogue_records, "work", lambda s, what: folders.append(tmp_path / what) or f"file://{tmp_path / what}")
    rows = catalogue_records.frames_scan(spark, str(tmp_path)).agg({"n": "sum", "in_order": "min"}).first()
    written = os.listdir(folders[0])
    assert len(written) > 1 and rows["min(in_order)"]  # one task once wrote it all
    assert rows["sum(n)"] == catalogue_records.comment_view(spark, str(tmp_path)).count()
