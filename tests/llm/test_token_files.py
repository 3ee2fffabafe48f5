"""Token lists in Parquet: ids against the library, the layout of the files, order and starts, odd rows."""

import glob
import random
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from tokenizers import Tokenizer

from corpusloom.llm import queries, token_files
from corpusloom.llm.common import shared_dir, table

from .conftest import ODD

PATH = queries.tokenizer("word_bpe_49k.json")
SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def plain(library, text):
    return [*library.encode(text or "", add_special_tokens=False).ids, 1]


def test_words_against_library(library):
    random.seed(3)
    bits = ["a", "It's", "we'LL", "don't", "'", "é", "é", "̈", "Σς", "İ", " ", "  ", "\n", "\t", "\r\n", "\x0b", "\x1c", "\x85", "\xa0", " ", "　", "12", "½", "<|endoftext|>", "<|startoftext|>x", "</w>", "日本", "😀", "\x00", "...", "-", "ab" * 40]
    texts = ["".join(random.choices(bits, k=random.randrange(12))) for _ in range(3000)]
    lists = token_files.token_lists(pa.array([*texts, None]), token_files.WordEncoder(PATH), 1).to_pylist()
    assert lists == [plain(library, t) for t in [*texts, None]]


def test_stretches_and_memory(library, monkeypatch):
    monkeypatch.setattr(token_files, "STRETCH", 50)
    monkeypatch.setattr(token_files, "REMEMBERED", 20)
    coder = token_files.WordEncoder(PATH)
    texts = ["word other " * 200, "x" * 300, "", "it 's " * 40 + "y" * 90, "end"]
    for _ in range(3):
        assert token_files.token_lists(pa.array(texts), coder, 1).to_pylist() == [plain(library, t) for t in texts]
    many = [f"w{i}" for i in range(300)] * 2
    assert token_files.token_lists(pa.array(many), coder, 1).to_pylist() == [plain(library, t) for t in many]
    assert [token_files.token_lists(pa.array([t]), coder, 1).to_pylist() for t in many] == [[plain(library, t)] for t in many]
    assert len(coder.parts.young) <= 21 and len(coder.parts.old) <= 700


def check(rows, got, library):
    """Rows of (id, text): ascending ids, starts without gaps, the crc of each."""
    assert len(got) == len(rows)
    got = sorted(got, key=lambda r: r["start"])
    key = lambda i: (i is None, i)
    assert [r["doc_id"] for r in got] == sorted((i for i, _ in rows), key=key)
    assert [r["start"] for r in got] == [0, *np.cumsum([r["n_tokens"] for r in got])[:-1]][: len(got)]
    crc = lambda ids: zlib.crc32(np.array(ids, "<u4").tobytes())
    wanted = sorted((str(i), len(ids := plain(library, t)), crc(ids)) for i, t in rows)
    assert sorted((str(r["doc_id"]), r["n_tokens"], r["ids_crc32"]) for r in got) == wanted


def test_query(spark, library):
    docs = table(spark, SF, "documents").select("doc_id", "text").collect()
    check([tuple(r) for r in docs], queries.op11_token_lists(spark, SF).collect(), library)


@pytest.mark.parametrize("encoding", ["dictionary", "delta"])
def test_odd_rows_and_layout(spark, library, make, encoding):
    rows = [*ODD, *[(77, "hot text", "en", "s")] * 500, (None, "no id", None, None), (None, "", None, None)]
    path = shared_dir(spark, "tokens")
    token_files.write(make(rows), path, PATH, encoding=encoding, page_rows=20, row_group_bytes=4096)
    got = token_files.with_global_start(spark, token_files.with_crc(token_files.read(spark, path)), path)
    check([r[:2] for r in rows], got.select("doc_id", "start", "n_tokens", "ids_crc32").collect(), library)
    seen, groups = set(), 0
    for f in glob.glob(f"{path.removeprefix('file://')}/tokens/*.parquet"):
        meta = pq.ParquetFile(f).metadata
        for g in range(meta.num_row_groups):
            groups += 1
            for c in range(meta.num_columns):
                column = meta.row_group(g).column(c)
                assert column.has_offset_index and column.has_column_index
                seen.add((column.path_in_schema, *(e for e in column.encodings if "DICT" in e or "DELTA" in e)))
    assert ("doc_id", "DELTA_BINARY_PACKED") in seen and ("start", "DELTA_BINARY_PACKED") in seen
    assert any(s[0] == "ids.list.element" and any(("DICT" if encoding == "dictionary" else "DELTA") in e for e in s[1:]) for s in seen)
    parts = spark.read.parquet(f"{path}/parts").orderBy("part").collect()
    assert sum(p["rows"] for p in parts) == len(rows) and [p["before"] for p in parts] == [0, *np.cumsum([p["n_tokens"] for p in parts])[:-1]]
    if spark.conf.get("spark.sql.adaptive.enabled") == "true" and len(parts) > 1:
        assert max(p["rows"] for p in parts) < len(rows)
    one = token_files.read(spark, path, ids=(77, 77))
    assert one.count() == 500 and {tuple(r["ids"]) for r in one.collect()} == {tuple(plain(library, "hot text"))}
    plan = token_files.read(spark, path, tokens=False, ids=(5, 9))._jdf.queryExecution().toString()
    assert "GreaterThanOrEqual(doc_id,5)" in plan.split("PushedFilters")[-1] and "ids" not in plan.split("ReadSchema")[-1]


def test_no_rows_and_bad_arguments(spark, none):
    path = shared_dir(spark, "tokens")
    token_files.write(none, path, PATH)
    assert token_files.with_global_start(spark, token_files.with_crc(token_files.read(spark, path)), path).count() == 0
    with pytest.raises(ValueError):
        token_files.layout("doc_id", "plain", 1, 1)
    with pytest.raises(ValueError):
        token_files.WordEncoder(queries.tokenizer("byte_bpe_50k.json"))
