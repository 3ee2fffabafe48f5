"""A training corpus from raw documents, in five stages.

Each stage takes (spark, docs, sf_dir), works on every row it gets and returns the rows it leaves,
all but the last with the columns of ``documents``; :func:`run` writes each result to the shared
folder as Parquet and gives it, read again, to the next stage.

Every stage takes tables without rows and further columns of any name, which it passes on. Rows that
repeat an id stay or go together in the two stages of duplicates. What a stage makes of nulls, empty
texts and repeated rows is said with it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from corpusloom.functions.key_filter import with_chance
from corpusloom.llm import exact_dedup, language, mixing, near_dedup, pieces
from corpusloom.llm.common import buckets_for, prefix_sums, source_key, stored, table
from corpusloom.llm.queries import tokenizer

#: Documents whose language is less sure than this go; text with letters of one language is far above it.
LEAST_SCORE = 0.5


#: Rows that go to Python at once in the stages that send whole texts: with the session's usual 10,000 an executor's memory has no room to spare.
BATCH_ROWS = 1024


def _small_batches(spark: SparkSession) -> None:
    """For the session, as a stage's result is made after the stage returns."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)


def _plain(docs: DataFrame) -> tuple[DataFrame, dict[str, str], list[Column]]:
    """``docs`` under column names that clash with no other, the new name of each, and what gives the old names back."""
    names = docs.columns
    plain = docs.toDF(*(f"__{i}" for i in range(len(names))))
    return plain, {n: f"__{i}" for i, n in enumerate(names)}, [F.col(f"__{i}").alias(n) for i, n in enumerate(names)]


def _without(docs: DataFrame, gone: DataFrame) -> DataFrame:
    """Rows of ``docs`` whose id isn't among the ids of ``gone``, a written table.

    Rows that a filter sized to these ids tells apart stay where they are; only the others are joined.
    """
    plain, at, back = _plain(docs)
    key = F.col(at["doc_id"])
    gone = gone.select(F.col("doc_id").alias("gone")).distinct()
    rows = with_chance(plain, key, gone, F.col("gone"))
    left = rows.where("__maybe").join(gone, key.eqNullSafe(F.col("gone")), "left_anti")
    return rows.where("not __maybe").select(*back).unionByName(left.select(*back))


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects text that is in no language (null, empty, or without a letter) or between languages.

    Rows without id or language are judged like any other; repeated rows get one judgement.
    """
    _small_batches(spark)
    model = language.Model(language.sample(docs))
    plain, at, back = _plain(docs)
    found = language.identify(plain, model, at["doc_id"], at["text"], keep=tuple(plain.columns))
    return found.where((F.col("lang_pred") != "und") & (F.col("score") >= LEAST_SCORE)).select(*back)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one row of each group of texts that are equal without white space: the longest, then the smallest id.

    Null and empty texts are one group. An id stays if any row of it is one to keep; rows without id stay together if
    one of them is.
    """
    found = stored(exact_dedup.dedup(docs).select("doc_id", "kept"), "kept")
    return _without(docs, stored(found.groupBy("doc_id").agg(F.bool_or("kept").alias("kept")).where("not kept").select("doc_id"), "gone"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the first document of each component of near duplicates. Texts without words, and rows without id, all stay."""
    found = near_dedup.near_groups(docs).where("doc_id != component_id").select("doc_id")
    return _without(docs, stored(found, "gone"))


def rounded(shares: DataFrame) -> DataFrame:
    """From (doc_id, source_key, words, share): how often each document comes, ``times``, 0 or more.

    The whole part of a share counts in full. One copy more goes to documents in the order of their fraction less a
    seeded number, so the chance of it grows with the fraction, until the words of a source's copies meet the words of
    its shares; they miss them by half a document at most. The order is found from bucket counts, never in one task.
    """
    part = F.col("share") - F.floor("share")
    chance = F.pmod(F.xxhash64(F.lit("times"), "doc_id", "source_key"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    rows = stored(shares.withColumn("part", part).withColumn("turn", 1 - F.col("part") + chance), "shares")
    open_ = rows.where("part > 0")
    sources = open_.groupBy("source_key").agg(F.sum(F.col("part") * F.col("words")).alias("need"), F.count(F.lit(1)).alias("n"))
    buckets = buckets_for(sources.agg(F.max("n")).first()[0] or 0)
    open_ = open_.withColumn("b", F.floor(F.col("turn") / 2 * buckets).cast("long"))
    before = prefix_sums(open_, ["source_key"], "b", {"words": F.sum("words")}).join(sources.drop("n"), "source_key")
    before = stored(before.select("source_key", "b", "words_before", "need"), "before")
    upto = W.partitionBy("source_key", "b").orderBy("turn", "doc_id").rowsBetween(W.unboundedPreceding, 0)
    laid = open_.join(before, ["source_key", "b"]).withColumn("start", F.col("words_before") + F.sum("words").over(upto) - F.col("words"))
    more = laid.select("doc_id", "source_key", F.floor("share").alias("whole"), (F.col("start") + F.col("words") / 2 <= F.col("need")).cast("long").alias("more"))
    whole = rows.where("part = 0").select("doc_id", "source_key", F.floor("share").alias("whole"), F.lit(0).cast("long").alias("more"))
    return more.unionByName(whole).select("doc_id", "source_key", (F.col("whole") + F.col("more")).alias("times"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it: its words in the mix over its words, rounded so that sources meet their targets.

    A document with a share of 1.3 comes once or twice, one with 0.3 once or not at all; see :func:`rounded`. Rows of one
    id and source share their words and come equally often. A document of no words goes. Reruns agree.
    """
    plain, at, back = _plain(docs)
    got = mixing.counted(docs).where("size > 0").groupBy("doc_id", "source_key").agg(F.sum("taken").alias("taken"), F.sum("size").alias("words"))
    times = rounded(got.select("doc_id", "source_key", "words", (F.col("taken") / F.col("words")).alias("share"))).where("times > 0")
    words = F.coalesce(F.regexp_like(F.col(at["text"]), F.lit(mixing.WORD)), F.lit(False))
    key = source_key(F.col(at["source"]))
    rows = plain.where(words).join(times, F.col(at["doc_id"]).eqNullSafe(F.col("doc_id")) & (key == F.col("source_key")))
    return rows.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("times")))).select(*back)


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, source, n_tokens and the ids of every row; null and empty texts have the end id only."""
    _small_batches(spark)
    out = pieces.encode(docs.select("doc_id", "source", "text"), tokenizer("piece_bpe_32k.model"), keep=("source",))
    return out.select("doc_id", "source", F.size("ids").cast("long").alias("n_tokens"), "ids")


STAGES = [
    ("language ID", identify_language),
    ("exact dedup", drop_copies),
    ("near dedup", drop_near_copies),
    ("mixing", mix_sources),
    ("encoding", encode_pieces),
]
#: Neither the context trees nor the tokenizer can be said in SQL; tests hold the pipeline against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
