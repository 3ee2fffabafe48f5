"""Exact deduplication as a stateful stream.

Documents arrive as a stream of (digest, id, code points, locator), in ``batches`` micro-batches or
more. A streaming aggregate keyed by digest holds, in a RocksDB state store on disk and without
watermark (so without expiry), the stable identifier of the row that stays, its content locator and
the size of the group. Later batches meet the state that earlier ones left. The store and its log
live in the shared folder, so a lost executor's state is loaded again elsewhere, and a batch that is
run twice leaves the same state.

Equal digests are only a claim. Every arrival that hits a digest already held, and the row held, are
fetched again through their locators, and their full bytes are compared: rows of a digest are
grouped by the whole normalised text (copies collapse map-side, so a group of a third of all rows
sends one row a task), and a digest that covers two different texts is taken apart by those texts.
A filter sized to the hits (:mod:`corpusloom.functions.key_filter`) keeps about 98 in 100 of the texts that
nothing hits out of the shuffle; beyond 27 million hits it is left out, and all texts are shuffled once.

Rows meet the state by digest. Digests of large groups are fewer than a fixed number, whatever the
input, and their state is broadcast; see :func:`~.common.join_hot`. Everything runs on the JVM:
DataFrame functions, no Python on the executors.

Of equal texts the row with the most code points in the original text stays, then the smallest id.
Defined cases: null counts as empty, and empty or all-white texts are equal; ids may be of any type
with an order; a null id stays only where no row of that length has one; repeated rows each count
and point at the same id; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.functions.shared import remove_at_exit

from .common import SPACE, join_hot, narrowed, settings, shared_dir, stored

#: RocksDB on disk; a store's local files go with each commit, as the shared log has all of them.
STORE = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.streaming.stateStore.unloadOnCommit": "true",
}
BATCHES = 4
#: Bytes of compressed arrivals for each part of the state, about 90,000 rows.
PART_BYTES = 4 << 20


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), SPACE + "+", "")


def sha256(text: Column) -> Column:
    """The digest as 32 bytes."""
    return F.unhex(F.sha2(text.cast("binary"), 256))


def locator(docs: DataFrame, id_col: str) -> Column:
    """File and row where the input is files, else the id."""
    place = F.concat_ws("#", F.col("_metadata.file_path"), F.col("_metadata.row_index"))
    try:
        docs.select(place.alias("locator")).columns  # noqa: B018
    except AnalysisException:
        return F.concat(F.lit("id:"), F.coalesce(F.col(id_col).cast("string"), F.lit("")))
    return place


def arrivals(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", digest=sha256) -> DataFrame:
    """(digest, doc_id, n_points, locator) of each row."""
    points = F.coalesce(F.char_length(F.col(text_col)), F.lit(0)).cast("long")
    return docs.select(digest(normalised(F.col(text_col))).alias("digest"), F.col(id_col).alias("doc_id"), points.alias("n_points"), locator(docs, id_col).alias("locator"))


def first_place() -> Column:
    """Sorts the rows of a group: the one that stays comes first."""
    return F.struct((-F.col("n_points")).alias("n"), F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id"))


def parts_for(spark: SparkSession, path: str) -> int:
    """So many parts of state as the arrivals under ``path`` fill, two a core at least: each is opened, logged and closed in every batch."""
    held = spark.read.format("binaryFile").load(path).agg(F.sum("length")).first()[0] or 0
    return max(2 * spark.sparkContext.defaultParallelism, -(-held // PART_BYTES))


def stream_state(stream: DataFrame, folder: str) -> DataFrame:
    """Run a stream of arrivals to its end; the keyed state after it: digest, keep_id, keep_locator, group_size.

    The state goes on, in as many parts, if the same ``folder`` is given again with more arrivals.
    """
    spark = stream.sparkSession
    state = stream.groupBy("digest").agg(F.min_by(F.struct("doc_id", "locator"), first_place()).alias("keep"), F.count(F.lit(1)).alias("group_size"))

    def save(batch: DataFrame, epoch: int) -> None:
        batch.write.mode("overwrite").parquet(f"{folder}/updates/epoch={epoch}")

    with settings(spark, STORE):
        run = state.writeStream.outputMode("update").foreachBatch(save).trigger(availableNow=True).option("checkpointLocation", f"{folder}/state").start()
        run.awaitTermination()
    kind = {f.name: f.dataType.simpleString() for f in stream.schema}
    schema = f"digest {kind['digest']}, keep struct<doc_id: {kind['doc_id']}, locator: string>, group_size bigint, epoch int"
    seen = spark.read.schema(schema).option("basePath", f"{folder}/updates").parquet(f"{folder}/updates")
    last = seen.groupBy("digest").agg(F.max_by(F.struct("keep", "group_size"), "epoch").alias("s"))
    return last.select("digest", F.col("s.keep.doc_id").alias("keep_id"), F.col("s.keep.locator").alias("keep_locator"), F.col("s.group_size").alias("group_size"))


def clashes(docs: DataFrame, hits: DataFrame, id_col: str = "doc_id", text_col: str = "text", digest=sha256) -> DataFrame:
    """Digests of ``hits`` (digest, locator) that cover more than one normalised text: the rows' full bytes, fetched by locator, are compared."""
    rows = docs.select(locator(docs, id_col).alias("locator"), F.col(text_col).alias("t"))
    rows = narrowed(rows, F.col("locator"), hits, F.col("locator")).select("locator", normalised(F.col("t")).alias("t"))
    # where the locator is an id that several rows have, each row counts for its own digest only
    found = rows.join(hits.distinct(), "locator").where(digest(F.col("t")) == F.col("digest"))
    return found.groupBy("digest", "t").agg(F.count(F.lit(1)).alias("n")).groupBy("digest").agg(F.count(F.lit(1)).alias("texts")).where("texts > 1").select("digest")


def dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", digest=sha256, batches: int = BATCHES) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256, keep_locator.

    ``batches`` is how many micro-batches the arrivals make, where they are so many files at least.
    """
    spark = docs.sparkSession
    folder = shared_dir(spark, "dedup")
    log = arrivals(docs, id_col, text_col, digest)
    arrived = f"{folder}/arrivals"
    log.write.parquet(arrived)
    remove_at_exit(spark, folder)
    log = spark.read.schema(log.schema).parquet(arrived)
    if len(log.inputFiles()) < batches:  # a small table: cut into as many files as there are batches
        arrived = f"{folder}/dealt"
        log.repartition(batches).write.parquet(arrived)
        log = spark.read.schema(log.schema).parquet(arrived)
    files = len(log.inputFiles())
    stream = spark.readStream.schema(log.schema).option("maxFilesPerTrigger", max(1, files // batches)).parquet(arrived)
    with settings(spark, {"spark.sql.shuffle.partitions": str(parts_for(spark, arrived))}):
        state = stream_state(stream, folder)
    state = stored(state, "state")
    met = join_hot(log, state, ["digest"], "group_size")
    columns = [F.col("doc_id"), F.col("keep_id"), F.col("group_size"), F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), F.lower(F.hex("digest")).alias("text_sha256"), F.col("keep_locator")]
    hits = stored(join_hot(log, state.where("group_size > 1").select("digest", "group_size"), ["digest"], "group_size").select("digest", "locator"), "hits")
    wrong = stored(clashes(docs, hits, id_col, text_col, digest), "clashes")
    if wrong.isEmpty():
        return met.select(*columns)
    full = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.char_length(F.col(text_col)), F.lit(0)).cast("long").alias("n_points"), locator(docs, id_col).alias("locator"), normalised(F.col(text_col)).alias("t"))
    full = full.withColumn("digest", digest(F.col("t"))).join(wrong, "digest", "left_semi")
    apart = full.groupBy("t").agg(F.min_by(F.struct("doc_id", "locator"), first_place()).alias("keep"), F.count(F.lit(1)).alias("group_size"))
    apart = full.join(apart, "t").withColumn("keep_id", F.col("keep.doc_id")).withColumn("keep_locator", F.col("keep.locator"))
    return met.join(wrong, "digest", "left_anti").select(*columns).unionByName(apart.select(*columns))
