"""Helpers the training-data operators share: table access, seeded ranks, joins that a hot key can't stall."""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from corpusloom.functions.key_filter import narrowed, with_chance  # noqa: F401
from corpusloom.functions.shared import discard, observed, remove_at_exit, shared_dir, stored  # noqa: F401
from corpusloom.functions.shipping import ship  # noqa: F401

#: The white space of every contract: space and the six ASCII controls 0x09-0x0D without 0x0E on.
SPACE = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"
#: A key with more than one in so many rows is hot, so there are fewer hot keys than this; and never below LEAST_HOT rows.
HOT_KEYS, LEAST_HOT = 8192, 64


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@contextmanager
def settings(spark: SparkSession, wanted: dict[str, str]):
    """Session settings for what runs inside."""
    old = {k: spark.conf.get(k, None) for k in wanted}
    try:
        for k, v in wanted.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def source_key(col: Column) -> Column:
    """A never-null grouping key: '=' + the name, and '~' (sorts after) for null."""
    return F.when(col.isNull(), F.lit("~")).otherwise(F.concat(F.lit("="), col))


def shuffle_key(seed: str, *cols: Column) -> Column:
    """A seeded hash that any SQL engine has; null counts as an empty string."""
    return F.md5(F.concat_ws(":", F.lit(seed), *(F.coalesce(c.cast("string"), F.lit("")) for c in cols)).cast("binary"))


def hex_bucket(key: Column, buckets: int | Column) -> Column:
    """0 to ``buckets`` - 1 from the first 32 bits of a hex key, in the order of the key."""
    first = F.conv(F.substring(key, 1, 8), 16, 10).cast("long")
    return F.shiftright(first * buckets, 32)


def buckets_for(rows: int, rows_per_bucket: int = 20_000, least: int = 1024) -> int:
    """So many buckets that one holds about ``rows_per_bucket`` rows; never so few that a hot group stays in one task."""
    return min(2**30, max(least, -(-rows // rows_per_bucket)))


def prefix_sums(df: DataFrame, keys: list[str], bucket: str, sums: dict[str, Column]) -> DataFrame:
    """Per (keys, bucket): each sum over earlier buckets of the keys as ``<name>_before`` and over all as ``<name>_all``.

    The aggregate runs map-side first, so what the windows see is a row for each bucket, not for each input row.
    """
    sized = df.groupBy(*keys, bucket).agg(*(c.alias(k) for k, c in sums.items()))
    part = W.partitionBy(*keys)
    upto = part.orderBy(bucket).rowsBetween(W.unboundedPreceding, -1)
    return sized.select(
        *keys,
        bucket,
        *(F.coalesce(F.sum(k).over(upto), F.lit(0).cast("long")).alias(f"{k}_before") for k in sums),
        *(F.sum(k).over(part).alias(f"{k}_all") for k in sums),
    )


def join_hot(rows: DataFrame, per_key: DataFrame, on: list[str], count: str, total: int | None = None, most: int | None = None) -> DataFrame:
    """``rows`` joined with ``per_key``, which has one row for each key and in ``count`` how many of ``rows`` have it.

    Keys with more than one in HOT_KEYS of the rows are fewer than HOT_KEYS whatever the input, so their side is broadcast
    and their rows stay where they are; all other keys are too small to stall a task and are shuffled.
    ``per_key`` is read three times and ``rows`` twice: give tables, or what is cheap to make again. ``total`` is a number
    of rows that ``rows`` don't exceed and ``most`` the largest of ``count``, where the caller has them; else they are
    looked up. Without a hot key it is a plain join.
    """
    counted = None
    if total is None or most is None:
        counted, most = per_key.agg(F.sum(count), F.max(count)).first()
    least = max(LEAST_HOT, (counted or 0 if total is None else total) // HOT_KEYS)
    if (most or 0) <= least:
        return rows.join(per_key, on)
    hot = per_key.where(F.col(count) > least)
    cold = rows.join(F.broadcast(hot.select(*on)), on, "left_anti").join(per_key.where(F.col(count) <= least), on)
    return rows.join(F.broadcast(hot), on).unionByName(cold)
