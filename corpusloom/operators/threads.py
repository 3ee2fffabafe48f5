"""Extract and shape: first of each id, threads in order, the last comment's metadata, shards, counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from corpusloom.functions import records
from corpusloom.functions import text as X
from corpusloom.functions.key_filter import narrowed
from corpusloom.functions.shared import stored
from corpusloom.schema import DROPPED_FIELDS

BASE_URL = "https://www.reddit.com"


def thread_id(link_id: Column) -> Column:
    return F.replace(link_id, F.lit("t3_"), F.lit(""))


def extract(df: DataFrame, link: str | None = None) -> DataFrame:
    """Rows whose parent is a submission (of one thread, if given)."""
    rows = df.where(F.col("link_id").startswith("t3_"))
    return rows if link is None else rows.where(thread_id(F.col("link_id")) == link)


def of_threads(lines: DataFrame, wanted: DataFrame) -> DataFrame:
    """Lines of archives (source, ord, value) whose ``link_id`` is one of ``wanted`` (``link_id``, a list of any length), before they are parsed.

    One field is looked up in the line, a Bloom filter sized to the list leaves out most other lines, and a left-semi join the
    rest; only what is left is shuffled, and parsed later.
    """
    links = stored(wanted.select(F.col("link_id").alias("__wanted")).where("__wanted is not null").distinct(), "threads")
    found = lines.withColumn("__link", F.get_json_object("value", "$.link_id"))
    return narrowed(found, F.col("__link"), links, F.col("__wanted")).join(links, F.col("__link") == F.col("__wanted"), "left_semi").drop("__link")


def first_of_id(df: DataFrame) -> DataFrame:
    """The first row of each id of a source in file order; a rank limit prunes before the shuffle."""
    place = F.row_number().over(W.partitionBy("source", "id").orderBy("ord"))
    return df.withColumn("__n", place).where("__n = 1").drop("__n")


def prune(fields: Column) -> Column:
    """A map of archive fields without those that are dropped."""
    return F.map_filter(fields, lambda k, _: ~k.isin(*DROPPED_FIELDS))


def metadata(info: Column, post_id: Column, fallback_date: Column) -> dict[str, Column]:
    """Document metadata from its last comment."""
    parts = F.split(info["permalink"], "/")
    full = F.coalesce(F.size(parts) >= 6, F.lit(False))
    part = lambda i, other: F.when(full, F.get(parts, F.lit(i))).otherwise(other)
    sub, post, title = F.coalesce(part(2, info["subreddit"]), F.lit("")), part(4, post_id), part(5, post_id)
    url = F.concat(F.lit(BASE_URL + "/r/"), sub, F.lit("/comments/"), post, F.lit("/"))
    return {
        "post_id": post,
        "title": title,
        "date": X.utc_date(info["created_utc"]),
        "subreddit": sub,
        "author": F.coalesce(info["author"], F.lit("Unknown Author")),
        "thread_url": url,
        "comment_url": F.concat(url, F.lit("comment/"), info["id"], F.lit("/")),
        "download_date": F.coalesce(X.utc_date(info["retrieved_on"]), X.utc_date(info["retrieved_utc"]), fallback_date),
    }


META = ("post_id", "title", "date", "subreddit", "author", "thread_url", "comment_url", "download_date")


INFO = ("id", "link_id", "author", "created_utc", "subreddit", "permalink", "retrieved_on", "retrieved_utc")


def _fallback(df: DataFrame, fallback_date: str, info: str) -> Column:
    """The last resort for download dates: the date of the row's file, where it has one."""
    return F.coalesce(F.col(f"{info}.file_date"), F.lit(fallback_date)) if "file_date" in df.columns else F.lit(fallback_date)


def threads(df: DataFrame, fallback_date: str = "1970-01-01") -> DataFrame:
    """One row per thread: thread_id, n_comments, comments (in order) and metadata of the last one.

    A column ``text`` of ``df``, the body made ready for a document, goes with the comments. ``ord`` may be of any type with an order.
    """
    held = [c for c in ("text", "file_date") if c in df.columns]
    item = F.struct("ord", "id", "author", "body", "created_utc", *(c for c in held if c == "text"))
    last = F.max_by(F.struct(*INFO, *(c for c in held if c == "file_date")), "ord")
    rows = df.groupBy("source", thread_id(F.col("link_id")).alias("thread_id")).agg(F.count(F.lit(1)).alias("n_comments"), F.array_sort(F.collect_list(item)).alias("comments"), last.alias("info"))
    return rows.select("source", "thread_id", "n_comments", "comments", *(c.alias(n) for n, c in metadata(F.col("info"), F.col("thread_id"), _fallback(df, fallback_date, "info")).items()))


def single_comments(df: DataFrame, fallback_date: str = "1970-01-01") -> DataFrame:
    """One row per comment with its metadata; no shuffle."""
    rows = df.withColumn("__info", F.struct(*INFO, *(c for c in ("file_date",) if c in df.columns)))
    found = metadata(F.col("__info"), thread_id(F.col("link_id")), _fallback(df, fallback_date, "__info"))
    return rows.select("source", "ord", thread_id(F.col("link_id")).alias("thread_id"), F.col("id").alias("comment_id"), "body", *(c.alias(n) for n, c in found.items()))


def record_json(df: DataFrame, fields: tuple[str, ...], pruned: bool = False) -> Column:
    """A comment as a JSON object: the whole record with its clean body where the rows carry one (``fields``), without the dropped fields if ``pruned``; else the named columns."""
    if "fields" not in df.columns:
        return F.to_json(F.struct(*fields))
    record = records.with_text(F.col("fields"), "body", F.col("body"))
    return records.to_json(prune(record) if pruned else record)


def comment_json(df: DataFrame, fields: tuple[str, ...]) -> DataFrame:
    """(file_name, json): an array of the one comment."""
    name = F.concat(thread_id(F.col("link_id")), F.lit("_"), F.col("id"), F.lit(".json"))
    return df.select(name.alias("file_name"), F.concat(F.lit("["), record_json(df, fields, True), F.lit("]")).alias("json"))


def thread_json(df: DataFrame, fields: tuple[str, ...]) -> DataFrame:
    """(file_name, json): an array of a thread's comments in order."""
    item = F.struct("ord", record_json(df, fields, True).alias("c"))
    rows = df.groupBy("source", thread_id(F.col("link_id")).alias("t")).agg(F.array_sort(F.collect_list(item)).alias("cs"))
    return rows.select(F.concat("t", F.lit("_flat.json")).alias("file_name"), F.concat(F.lit("["), F.array_join(F.transform("cs", lambda x: x["c"]), ","), F.lit("]")).alias("json"))


def with_shard(df: DataFrame, key: str, per_shard: int = 1000, rows_per_bucket: int = 20_000, first: int = 0) -> DataFrame:
    """Adds ``shard``: 00001 and so on, ``per_shard`` rows each, in a hashed order of ``key``; ``first`` places are taken.

    Numbers are global, but no task sorts all rows: buckets follow the hash, a small table of their counts gives offsets.
    """
    # written once, as counts, offsets and rows are three uses of what may be a long plan
    rows = stored(df.withColumn("__h", F.md5(F.col(key).cast("binary"))), "sharded")
    buckets = max(64, -(-rows.count() // rows_per_bucket))
    rows = rows.withColumn("__b", F.shiftright(F.conv(F.substring("__h", 1, 8), 16, 10).cast("long") * buckets, 32))
    before = rows.groupBy("__b").agg(F.count(F.lit(1)).alias("__n"))
    before = before.select("__b", (F.sum("__n").over(W.partitionBy(F.lit(0)).orderBy("__b")) - F.col("__n")).alias("__before"))
    place = F.row_number().over(W.partitionBy("__b").orderBy("__h", key)) - 1 + F.col("__before") + first
    return rows.join(before, "__b").withColumn("shard", F.lpad((F.floor(place / per_shard) + 1).cast("string"), 5, "0")).drop("__h", "__b", "__before")


def reconcile(filtered: DataFrame, emitted: DataFrame) -> DataFrame:
    """One row: how many records there were after filtering and after shaping, and whether these agree."""
    count = lambda df: df.agg(F.count(F.lit(1)))
    counts = count(filtered).withColumnRenamed("count(1)", "filtered_n").select("filtered_n", count(emitted).scalar().alias("emitted_n"))
    return counts.withColumn("matches", F.col("filtered_n") == F.col("emitted_n"))
