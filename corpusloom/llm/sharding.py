"""Proportional stratified interleaving: every output shard gets the mixture of the whole.

Rows are put in a seeded order within their source, rank r of n becomes the fraction
(2r - 1) / 2n, all rows are sorted by that fraction, and the sorted sequence is cut into shards of
equal counts. A source with a third of the rows thus supplies a third of any stretch.

Both rankings are global without a global sort in one task: rows fall into buckets that follow the
sort order, a small table of counts for each bucket gives the offset, and ``row_number`` runs
inside a bucket only. Bucket counts follow the row count, so a hot source is spread like any other.

Defined cases: a null source is a source of its own; null text has size 1 and the CRC of nothing;
equal rows are interchangeable and any tie ends by (key, id, size, CRC); an empty table gives an
empty result; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from .common import buckets_for, hex_bucket, prefix_sums, shuffle_key, source_key, stored


def interleave(docs: DataFrame, n_shards: int = 16, seed: str = "interleave", id_col: str = "doc_id", source_col: str = "source", text_col: str = "text", rows_per_bucket: int = 20_000) -> DataFrame:
    """One row per document: doc_id, source_key, size, text_crc32, fraction, shard, slot.

    ``slot`` runs from 0 without gaps in each shard; shard counts differ by one at most.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(
        F.col(id_col).alias("doc_id"),
        source_key(F.col(source_col)).alias("source_key"),
        (F.octet_length(text).cast("long") + 1).alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        shuffle_key(seed, F.col(id_col)).alias("h"),
    )
    per_source = docs.groupBy(F.col(source_col).alias("s")).count().agg(F.max("count").alias("most"), F.sum("count").alias("all")).first()
    most, total = per_source["most"] or 0, per_source["all"] or 0
    rows = rows.withColumn("b", hex_bucket(F.col("h"), buckets_for(most, rows_per_bucket)))
    ids = docs.select(source_key(F.col(source_col)).alias("source_key"), hex_bucket(shuffle_key(seed, F.col(id_col)), buckets_for(most, rows_per_bucket)).alias("b"))
    before = prefix_sums(ids, ["source_key"], "b", {"n": F.count(F.lit(1))})
    inside = W.partitionBy("source_key", "b").orderBy("h", "doc_id", "size", "text_crc32")
    ranked = (
        rows.join(before, ["source_key", "b"])
        .withColumn("r", F.row_number().over(inside) + F.col("n_before"))
        .withColumn("fraction", (2 * F.col("r") - 1).cast("double") / (2 * F.col("n_all")).cast("double"))
        .select("doc_id", "source_key", "size", "text_crc32", "r", "fraction")
    )
    n_cuts = buckets_for(total, rows_per_bucket)
    ranked = stored(ranked.withColumn("g", F.floor(F.col("fraction") * n_cuts)), "ranks")
    cuts = prefix_sums(ranked.withColumn("one", F.lit(0)), ["one"], "g", {"n": F.count(F.lit(1))})
    sorted_in = W.partitionBy("g").orderBy("fraction", "source_key", "r")
    placed = ranked.join(cuts.select("g", "n_before"), "g").withColumn("p", F.row_number().over(sorted_in) - 1 + F.col("n_before"))
    shard = F.expr(f"p * {n_shards} div {max(total, 1)}")
    return placed.withColumn("shard", shard.cast("int")).select(
        "doc_id",
        "source_key",
        "size",
        "text_crc32",
        "fraction",
        "shard",
        F.expr(f"p - (shard * cast({total} as bigint) + {n_shards - 1}) div {n_shards}").alias("slot"),
    )
