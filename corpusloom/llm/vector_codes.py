"""Vectors to short codes: a codebook for each part, in integers, with a partial-distance search for the nearest entry.

Components become ``floor(4096 * x)``, vectors are cut into parts, and each part position has a codebook of a few entries.
The search takes the dimensions of a part in descending variance of its codebook. The entry that leads after some of them
is measured in full; masks over all (vector, entry) pairs of a block drop those whose accumulated distance strictly exceeds
the best complete distance so far. Integers make every distance exact, so ties are ties, and go to the lower index.

A round reads the table and sums parts by entry within each task; what is shuffled is one row per task, part and entry, and
what comes to the driver is the codebooks, whose size depends on the dimension only.

Dropped are vectors that are null, hold null or non-finite components, have another length than most (ties: the shorter), or
have a component so large that distances would not fit in 64 bits (beyond +-16,384 for 384 dimensions, more for fewer).
Rows that share an id are rows of their own; as first entries the least vector of an id counts, ids without value last. With
fewer ids than entries codebooks are smaller. Lengths that the parts don't divide are filled up with zeros. Other columns
don't matter, and a table of which nothing is kept gives no rows.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import join_hot, ship, source_key, stored
from .workers import tidied

SCALE, PARTS, ENTRIES, ROUNDS = 4096, 8, 16, 6
#: Vectors that are searched at once, so that a block's pairs stay small.
BLOCK = 4096


@dataclass(frozen=True)
class Codebooks:
    """``entries`` is (part, entry, position within part) of int64; ``length`` the vectors' own length before filling up."""

    entries: np.ndarray
    length: int

    def digest(self) -> str:
        return hashlib.sha256(",".join(map(str, self.entries.ravel().tolist())).encode()).hexdigest()


def limit(length: int) -> int:
    """Components at or below this give squared distances that fit in 64 bits."""
    return math.isqrt((2**63 - 1) // (4 * max(length, 1)))


def scaled(vectors: pa.Array, length: int, parts: int = PARTS, scale: int = SCALE) -> tuple[np.ndarray, np.ndarray]:
    """Which vectors are kept, and their integers as (vector, part, position)."""
    sizes = pc.list_value_length(vectors).fill_null(-1).to_numpy(zero_copy_only=False)
    right = sizes == length
    flat = vectors.filter(pa.array(right)).flatten().cast(pa.float64()).to_numpy(zero_copy_only=False).reshape(int(right.sum()), length)
    with np.errstate(invalid="ignore", over="ignore"):
        whole = np.floor(flat * scale)
        good = (np.abs(whole) <= limit(length)).all(axis=1)  # false for NaN and infinite ones, too
    kept = np.zeros(len(sizes), bool)
    kept[np.flatnonzero(right)[good]] = True
    ints = whole[good].astype(np.int64)
    if length % parts:
        ints = np.pad(ints, ((0, 0), (0, parts - length % parts)))
    return kept, ints.reshape(len(ints), parts, ints.shape[1] // parts if ints.shape[1] else 0)


def _leaders(row: np.ndarray, acc: np.ndarray, n: int) -> np.ndarray:
    """Of pairs in the order of (row, entry), the place of each row's first least distance."""
    least = np.minimum.reduceat(acc, np.searchsorted(row, np.arange(n)))
    hits = np.flatnonzero(acc == least[row])
    return hits[np.searchsorted(row[hits], np.arange(n))]


def variance_order(book: np.ndarray) -> np.ndarray:
    """Dimensions in descending variance over the entries; ties in their own order."""
    spread = len(book) * (book.astype(object) ** 2).sum(axis=0) - book.astype(object).sum(axis=0) ** 2
    return np.array(sorted(range(book.shape[1]), key=lambda i: -spread[i]), dtype=np.int64)


def nearest(x: np.ndarray, book: np.ndarray, order: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index of the nearest entry and the squared distance, for each row of ``x``."""
    n, size = x.shape
    if not n or not size:
        return np.zeros(n, np.int64), np.zeros(n, np.int64)
    x, book = np.ascontiguousarray(x[:, order].T), book[:, order]
    row, entry = np.repeat(np.arange(n), len(book)), np.tile(np.arange(len(book)), n)
    acc = np.zeros(len(row), np.int64)
    best = np.full(n, np.iinfo(np.int64).max)
    turns = {max(1, size // 4), max(1, size // 2)}
    for j in range(size):
        if j in turns:
            lead = entry[_leaders(row, acc, n)]
            np.minimum(best, ((x - book[lead].T) ** 2).sum(axis=0), out=best)
            live = acc <= best[row]
            row, entry, acc = row[live], entry[live], acc[live]
        acc += (x[j][row] - book[entry, j]) ** 2
        if j >= min(turns):
            live = acc <= best[row]
            if not live.all():
                row, entry, acc = row[live], entry[live], acc[live]
    found = _leaders(row, acc, n)
    return entry[found], acc[found]


def assigned(ints: np.ndarray, books: Codebooks) -> tuple[np.ndarray, np.ndarray]:
    """(vector, part) codes, and distances summed over parts."""
    n, parts = ints.shape[:2]
    codes, error = np.empty((n, parts), np.int64), np.zeros(n, np.int64)
    for p in range(parts):
        order = variance_order(books.entries[p])
        for a in range(0, n, BLOCK):
            codes[a : a + BLOCK, p], found = nearest(ints[a : a + BLOCK, p], books.entries[p], order)
            error[a : a + BLOCK] += found
    return codes, error


def _sums(vectors: DataFrame, column: str, books: Codebooks) -> DataFrame:
    """(part, entry, n, sums): the vectors of each entry, counted and summed within each task."""
    parts, entries, size = books.entries.shape

    @tidied
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums = np.zeros((parts, entries), np.int64), np.zeros((parts, entries, size), np.int64)
        for batch in batches:
            _, ints = scaled(batch.column(0), books.length)
            codes, _ = assigned(ints, books)
            for p in range(parts):
                n[p] += np.bincount(codes[:, p], minlength=entries)
                np.add.at(sums[p], codes[:, p], ints[:, p])
        part, entry = np.nonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(part), pa.array(entry), pa.array(n[part, entry]), pa.array(list(sums[part, entry]), pa.list_(pa.int64()))], ["part", "entry", "n", "sums"])

    return vectors.select(column).mapInArrow(run, "part long, entry long, n long, sums array<long>")


def updated(vectors: DataFrame, column: str, books: Codebooks) -> Codebooks:
    """One round: each entry becomes the floor of its parts' mean; unused entries stay."""
    size = books.entries.shape[2]
    total = _sums(vectors, column, books).groupBy("part", "entry").agg(F.sum("n").alias("n"), F.array(*(F.sum(F.get("sums", F.lit(i))) for i in range(size))).alias("sums"))
    entries = books.entries.copy()
    for r in total.collect():  # a row for each entry of the codebooks
        entries[r["part"], r["entry"]] = np.array(r["sums"], np.int64) // r["n"]
    return Codebooks(entries, books.length)


def first_codebooks(vectors: DataFrame, id_col: str, vector_col: str, parts: int = PARTS, entries: int = ENTRIES) -> Codebooks | None:
    """The vectors of the smallest ids as first entries; None if nothing is kept."""
    vector = F.col(vector_col).cast("array<double>")
    rows = vectors.select(F.col(id_col).alias("id"), vector.alias("v")).where(F.col("v").isNotNull() & ~F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf")))))
    length = rows.groupBy(F.size("v").alias("length")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "length").first()
    if length is None:
        return None
    most, scale = float(limit(length[0])), F.lit(float(SCALE))
    rows = rows.where((F.size("v") == length[0]) & F.forall("v", lambda x: (x * scale >= -most) & (x * scale < most + 1)))
    ids = [r[0] for r in rows.select("id").distinct().orderBy(F.asc_nulls_last("id")).limit(entries).collect()]
    wanted = F.col("id").isin([i for i in ids if i is not None]) | (F.col("id").isNull() if None in ids else F.lit(False))
    seeds = rows.where(wanted).groupBy("id").agg(F.min("v").alias("v")).orderBy(F.asc_nulls_last("id")).collect()  # one for each entry
    if not seeds:
        return None
    _, ints = scaled(pa.array([r["v"] for r in seeds], pa.list_(pa.float64())), length[0], parts)
    return Codebooks(np.ascontiguousarray(ints.transpose(1, 0, 2)), length[0])


def train(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", rounds: int = ROUNDS) -> Codebooks | None:
    ship(vectors.sparkSession)
    books = first_codebooks(vectors, id_col, vector_col)
    for _ in range(rounds if books else 0):
        books = updated(vectors, vector_col, books)
    return books


def encode(vectors: DataFrame, books: Codebooks | None, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """(id, label, code, error) of every vector that is kept: indexes in part order as two hex digits each."""
    ship(vectors.sparkSession)
    rows = vectors.select(id_col, label_col, vector_col)
    schema = T.StructType([*rows.schema.fields[:2], T.StructField("code", T.StringType()), T.StructField("error", T.LongType())])
    if books is None:
        return vectors.sparkSession.createDataFrame([], schema)
    width = 2 * len(books.entries)

    @tidied
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept, ints = scaled(batch.column(2), books.length)
            codes, error = assigned(ints, books)
            text = codes.astype(np.uint8).tobytes().hex()
            made = pa.array([text[i : i + width] for i in range(0, len(text), width)], pa.string())
            mask = pa.array(kept)
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(mask), batch.column(1).filter(mask), made, pa.array(error)], schema.names)

    return rows.mapInArrow(run, schema)


def with_label_error(codes: DataFrame, label_col: str = "label") -> DataFrame:
    """Adds ``label_error``, the errors summed over equal labels (nulls together); hot labels are not shuffled."""
    rows = stored(codes.withColumn("__label", source_key(F.col(label_col).cast("string"))), "codes")
    sums = stored(rows.groupBy("__label").agg(F.sum("error").alias("label_error"), F.count(F.lit(1)).alias("__n")), "labels")
    return join_hot(rows, sums, ["__label"], "__n").drop("__label", "__n")


def compress(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", rounds: int = ROUNDS) -> DataFrame:
    """(vec_id, label, code, error, label_error, codebooks_sha256) of every vector that is kept."""
    books = train(vectors, id_col, vector_col, rounds)
    out = with_label_error(encode(vectors, books, id_col, vector_col, label_col), label_col)
    return out.withColumn("codebooks_sha256", F.lit(books.digest() if books else ""))
