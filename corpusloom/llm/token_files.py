"""Token ids as Parquet lists in id order, with chosen encodings, row groups and page indexes.

Documents are dealt into ranges of their id and sorted there, encoded, and written as one row each: id, place of its first
token within its file's part, number of tokens, ids. Token ids are dictionary-encoded (their vocabulary fits one page) or
delta-encoded; ids and places ascend, so they are delta-encoded. Row groups and pages are cut by parameters, and the column
and offset indexes let a reader skip pages: :func:`read` prunes columns (metadata without tokens) and pushes a range of ids
down to row groups and pages. A small table beside the files has the count of each part and the tokens of all parts before.

The tokenizer drops white space and never lets a pre-token cross it, so a text's ids are those of its words; each batch
encodes a distinct word once, and ids of words and pre-tokens are remembered, up to a bound.

Null and empty texts have the end id only. Rows without id come last; rows of one id are ordered by a hash of their text, so
equal rows only change places among themselves, and a hot id is spread over ranges. Very long texts are encoded in stretches.
Other columns aren't read; a table without rows gives files without rows.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Callable, Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

from .common import ship
from .workers import tidied

#: Words, and pre-tokens, of each of two generations whose ids a worker remembers, and how long these are at most.
REMEMBERED, SHORT = 200_000, 48
#: Characters that are encoded at once.
STRETCH = 1 << 21
#: Fixed value: the tokenizer's pre-tokens, for lower-case ASCII without white space.
PART = r"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^a-z0-9]+"
#: Parts whose counts are summed together before the sums of such groups are.
PARTS = 1024


class Remembered:
    """Ids of words (as bytes of int32) in two generations: the older goes when the younger is full, what is used comes back."""

    def __init__(self, make: Callable[[list[str]], list[bytes]]):
        self.make, self.young, self.old = make, {}, {}

    def get(self, words: list[str]) -> list[bytes]:
        """The ids of distinct words."""
        young, old = self.young, self.old
        out = [young.get(w) for w in words]
        if None in out:
            missing = []
            for i, found in enumerate(out):
                if found is None:
                    out[i] = old.get(words[i])
                    if out[i] is None:
                        missing.append(i)
                    else:
                        young[words[i]] = out[i]
            fresh = self.make([words[i] for i in missing]) if missing else []
            for i, found in zip(missing, fresh, strict=True):
                out[i] = found
                if len(words[i]) <= SHORT:
                    young[words[i]] = found
            if len(young) > REMEMBERED:
                self.young, self.old = {}, young
        return out


class WordEncoder:
    """Ids of texts by words, for tokenizers that drop white space, lower-case, and keep words apart.

    An ASCII word is cut into pre-tokens here, as many words share them. The library gets pre-tokens it hasn't had in long
    lines, whose ids are cut where a pre-token ends, and other words in lines with zeros between them.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        if self._lines(["a b\nC  d's"])[0] != list(chain.from_iterable(self._lines(["a", "b", "c", "d", "'s"]))):
            raise ValueError("this tokenizer keeps white space")
        self.ends = np.zeros(self.library.get_vocab_size(), bool)
        self.ends[[i for token, i in self.library.get_vocab().items() if token.endswith("</w>")]] = True
        self.zero = np.zeros(len(self.ends), bool)
        self.zero[self._lines(["0"])[0]] = True
        self.words, self.parts = Remembered(self._words), Remembered(self._parts)

    def _lines(self, lines: list[str]) -> list[list[int]]:
        return [e.ids for e in self.library.encode_batch_fast(lines, add_special_tokens=False)]

    def _cut(self, words: list[str], between: str, ends: np.ndarray, keep: int) -> list[bytes]:
        """Ids of words that the library gets in lines, ``between`` them; they are cut behind ids that are ``ends``, of which ``keep`` belong to the word."""
        out: list[bytes] = []
        lines = [words[i : i + 256] for i in range(0, len(words), 256)]
        for line, found in zip(lines, self._lines([between.join(x) + between for x in lines]), strict=True):
            ids = np.array(found, np.int32)
            cuts = np.flatnonzero(ends[ids]).tolist()
            if len(cuts) == len(line):
                raw = ids.tobytes()
                out += [raw[4 * a : 4 * (b + keep)] for a, b in zip([0, *(c + 1 for c in cuts)], cuts, strict=False)]
            else:  # a pre-token whose end has no id
                out += [np.array(x, np.int32).tobytes() for x in self._lines(line)]
        return out

    def _parts(self, parts: list[str]) -> list[bytes]:
        """Ids of ASCII pre-tokens."""
        return self._cut(parts, " ", self.ends, 1)

    def _words(self, words: list[str]) -> list[bytes]:
        """Ids of any words; a digit is a pre-token of its own, so zeros can stand between words without one."""
        plain = [w for w in words if "0" not in w and "<|" not in w]
        out = dict(zip(plain, self._cut(plain, " 0 ", self.zero, 0), strict=True))
        odd = [w for w in words if w not in out]
        out.update((w, np.array(ids, np.int32).tobytes()) for w, ids in zip(odd, self._lines(odd), strict=True))
        return [out[w] for w in words]

    def _distinct(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of distinct words all ids in a row, how many each has, and the place of each among them."""
        ours = pc.and_(pc.string_is_ascii(words), pc.invert(pc.match_substring(words, "<|")))
        parts = pc.split_pattern(pc.replace_substring_regex(pc.ascii_lower(words.filter(ours)), PART, r"\0 "), " ")
        offsets, parts = parts.offsets.to_numpy() - parts.offsets[0].as_py(), parts.flatten().dictionary_encode()
        flat, size = joined(self.parts.get(strings(parts.dictionary)))
        flat, size = gathered(flat, size, np.arange(len(size)), parts.indices.to_numpy())
        ends = np.concatenate([np.zeros(1, np.int64), np.cumsum(size)])
        more, n = joined(self.words.get(strings(words.filter(pc.invert(ours)))))
        mine = ours.to_numpy(zero_copy_only=False)
        return np.concatenate([flat, more]), np.concatenate([np.diff(ends[offsets]), n]), np.argsort(np.argsort(~mine, kind="stable"), kind="stable")

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids in a row, and how many each text has."""
        column = pa.array(texts, pa.large_string())
        for blank in "\t\n\x0b\x0c\r":
            column = pc.replace_substring(column, blank, " ")
        split = pc.split_pattern(column, " ")
        offsets = split.offsets.to_numpy() - split.offsets[0].as_py()
        words = split.flatten().dictionary_encode()
        ids, each = gathered(*self._distinct(words.dictionary), words.indices.to_numpy())
        return ids, np.diff(np.concatenate([np.zeros(1, np.int64), np.cumsum(each)])[offsets])


def strings(words: pa.Array) -> list[str]:
    return words.to_numpy(zero_copy_only=False).tolist()


def joined(ids: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    return np.frombuffer(b"".join(ids), np.int32), np.array([len(x) for x in ids], np.int64) // 4


def gathered(flat: np.ndarray, size: np.ndarray, place: np.ndarray, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The runs of ``flat`` that ``which`` asks for, by way of ``place``, in a row, and the size of each."""
    which = place[which]
    each = size[which]
    ends = np.cumsum(each)
    found = flat[np.repeat((np.cumsum(size) - size)[which] - ends + each, each) + np.arange(ends[-1] if len(ends) else 0)]
    return found, each


@lru_cache(maxsize=2)
def encoder(path: str) -> WordEncoder:
    """One encoder for each worker process and tokenizer."""
    return WordEncoder(path)


def _cut(text: str) -> Iterator[str]:
    """Stretches of a text, cut at spaces."""
    at = 0
    while len(text) - at > STRETCH and (space := text.find(" ", at + STRETCH)) >= 0:
        yield text[at:space]
        at = space
    yield text[at:]


def _groups(texts: list[str | None]) -> Iterator[tuple[list[str], list[int]]]:
    """Stretches and the text of each, together no more than STRETCH characters or one stretch."""
    parts, rows, size = [], [], 0
    for row, text in enumerate(texts):
        for part in _cut(text or ""):
            if parts and size + len(part) > STRETCH:
                yield parts, rows
                parts, rows, size = [], [], 0
            parts.append(part)
            rows.append(row)
            size += len(part)
    if parts:
        yield parts, rows


def token_lists(texts: pa.Array, coder: WordEncoder, end_id: int) -> pa.ListArray:
    """A list of ids for each text, each with the end id."""
    sizes, all_ids = np.zeros(len(texts), np.int64), []
    for parts, rows in _groups(texts.to_pylist()):
        ids, n = coder.encode(parts)
        np.add.at(sizes, rows, n)
        all_ids.append(ids)
    ids = np.insert(np.concatenate([*all_ids, np.zeros(0, np.int32)]), np.cumsum(sizes), end_id)
    offsets = np.concatenate([np.zeros(1, np.int64), np.cumsum(sizes + 1)])
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(ids, pa.int32()))


def layout(id_name: str, encoding: str, row_group_bytes: int, page_rows: int) -> dict[str, str]:
    """Writer options: ``encoding`` of the ids is ``dictionary`` or ``delta``."""
    if encoding not in ("dictionary", "delta"):
        raise ValueError("encoding is dictionary or delta")
    options = {"parquet.writer.version": "v2", "parquet.block.size": str(row_group_bytes), "parquet.page.row.count.limit": str(page_rows), "parquet.enable.dictionary": "false"}
    options |= {"parquet.enable.dictionary#ids.list.element": str(encoding == "dictionary").lower(), "parquet.enable.dictionary#part": "true"}
    return options


def write(docs: DataFrame, path: str, tokenizer_path: str, end_id: int = 1, id_col: str = "doc_id", text_col: str = "text", encoding: str = "dictionary", row_group_bytes: int = 16 << 20, page_rows: int = 2_000, compression: str = "zstd") -> None:
    """``path``/tokens (part, id, start, n_tokens, ids) in ascending order of id over the parts, and ``path``/parts (part, rows, n_tokens, before)."""
    spark = docs.sparkSession
    ship(spark)
    kind = docs.schema[id_col].dataType
    schema = T.StructType([T.StructField("doc_id", kind), T.StructField("start", T.LongType()), T.StructField("n_tokens", T.IntegerType()), T.StructField("ids", T.ArrayType(T.IntegerType()))])

    @tidied
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, place = encoder(tokenizer_path), 0
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                lists = token_lists(part.column(1), coder, end_id)
                n = np.diff(lists.offsets.to_numpy()).astype(np.int64)
                starts = place + np.cumsum(n) - n
                place += int(n.sum())
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(starts), pa.array(n, pa.int32()), lists], schema.names)

    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    order = F.asc_nulls_last("doc_id"), F.col("hash"), F.col("place")
    dealt = rows.select("*", F.xxhash64("text").alias("hash"), F.monotonically_increasing_id().alias("place")).repartitionByRange(*order).sortWithinPartitions(*order)
    made = dealt.select("doc_id", "text").mapInArrow(run, schema).select(F.spark_partition_id().alias("part"), "*")
    made.write.options(**layout("doc_id", encoding, row_group_bytes, page_rows)).parquet(f"{path}/tokens", compression=compression)
    counted = read(spark, path, tokens=False).groupBy("part").agg(F.count(F.lit(1)).alias("rows"), F.sum("n_tokens").alias("n_tokens"))
    counted = counted.withColumn("group", F.floor(F.col("part") / PARTS))
    groups = counted.groupBy("group").agg(F.sum("n_tokens").alias("n"))
    groups = groups.select("group", (F.sum("n").over(W.partitionBy(F.lit(0)).orderBy("group")) - F.col("n")).alias("base"))
    before = F.sum("n_tokens").over(W.partitionBy("group").orderBy("part")) - F.col("n_tokens") + F.col("base")
    counted.join(groups, "group").select("part", "rows", "n_tokens", before.alias("before")).write.parquet(f"{path}/parts")


def read(spark: SparkSession, path: str, tokens: bool = True, ids: tuple | None = None) -> DataFrame:
    """The rows of ``path``: without ``tokens`` the lists aren't read; ``ids`` = (first, last) skips row groups and pages of others."""
    rows = spark.read.parquet(f"{path}/tokens")
    rows = rows if tokens else rows.drop("ids")
    return rows if ids is None else rows.where(F.col("doc_id").between(*ids))


def with_global_start(spark: SparkSession, rows: DataFrame, path: str) -> DataFrame:
    """``start`` over all parts in place of the one within a part; Spark broadcasts the table of parts if its size is under the session's limit."""
    before = spark.read.parquet(f"{path}/parts").select(F.col("part").alias("__part"), "before")
    return rows.join(before, F.col("part") == F.col("__part")).withColumn("start", F.col("start") + F.col("before")).drop("part", "__part", "before")


def with_crc(rows: DataFrame) -> DataFrame:
    """``ids_crc32`` in place of ``ids``: of their little-endian unsigned 32-bit form."""
    ship(rows.sparkSession)
    held = [f for f in rows.schema.fields if f.name != "ids"]
    schema = T.StructType([*held, T.StructField("ids_crc32", T.LongType())])

    @tidied
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(batch.num_columns - 1)
            raw, ends = lists.flatten().to_numpy(zero_copy_only=False).astype("<u4", copy=False), lists.offsets.to_numpy()
            ends = ends - ends[0]
            crc = [zlib.crc32(raw[a:b]) for a, b in zip(ends[:-1], ends[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(crc, pa.int64())], schema.names)

    return rows.select(*(f.name for f in held), "ids").mapInArrow(run, schema)
