"""Threads from comments that arrive in any order: the first row of each id, then documents that grow, each a keyed state machine.

:class:`FirstOfId` holds for each (source, id) the place of its first row so far, not the row. An earlier row that comes
late takes its place: it is emitted, and the row that it replaces is taken back. :class:`Thread` holds a thread's comments
by id, applies these changes in whatever order they come, and emits the whole thread whenever it changes; readers take the
last version (:func:`latest`). A thread in which nothing has happened for ``idle_ms`` is closed by a timer: its state goes,
and what comes for it later is emitted as ``late`` and joins no document.

Whole texts need not pass through the streams: each would lie in the arrivals, the changes, the state, its log and every
version of its thread. :func:`apart` leaves them where they are written, sends their places in the column ``text``, and
:func:`with_texts` brings them to whatever versions are wanted.

State lies in RocksDB and its log in the checkpoint folder, so a run that stops, or an executor that is lost, goes on where
it was. State of one key is one task's, as a thread is one document.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from corpusloom.functions.shipping import ship_for_texts
from corpusloom.operators import tei, threads

#: RocksDB; and no batches without data, as timers would ask for them without end. Timers act in the next batch that has some.
STATE = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.noDataMicroBatches.enabled": "false",
}
#: Bytes of compressed files for each part of the state.
PART_BYTES = 16 << 20
KEPT = ("source", "ord", *threads.INFO, "body", "text")
CHANGE = T.StructType([T.StructField("source", T.StringType()), T.StructField("ord", T.LongType()), *(T.StructField(n, T.StringType()) for n in (*threads.INFO, "body", "text")), T.StructField("gone", T.BooleanType())])


class FirstOfId(StatefulProcessor):
    """Keyed by (source, id). Emits a row that comes first so far, and the place of the one it replaces as ``gone``."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.first = handle.getValueState("first", "ord long, link_id string")

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        row = min(rows, key=lambda r: r["ord"])
        held = self.first.get()
        if held is not None and held[0] <= row["ord"]:
            return
        if held is not None:
            none = dict.fromkeys(CHANGE.names)
            yield Row(**{**none, "source": key[0], "id": key[1], "ord": held[0], "link_id": held[1], "gone": True})
        self.first.update((row["ord"], row["link_id"]))
        yield Row(**{n: row[n] for n in KEPT}, gone=False)

    def close(self) -> None:
        pass


def _item() -> T.StructType:
    return T.StructType([f for f in CHANGE.fields if f.name not in ("source", "gone")])


THREAD = T.StructType([T.StructField("source", T.StringType()), T.StructField("thread_id", T.StringType()), T.StructField("state", T.StringType()), T.StructField("items", T.ArrayType(_item()))])


class Thread(StatefulProcessor):
    """Keyed by (source, thread). Emits all its comments in order whenever they change: ``open``, ``closed``, or ``late`` ones."""

    def __init__(self, idle_ms: int | None = None):
        self.idle_ms = idle_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.items = handle.getMapState("items", "id string", _item())
        self.flags = handle.getValueState("flags", "closed boolean, timer long")

    def _row(self, key, state: str, items: list) -> Row:
        return Row(source=key[0], thread_id=key[1], state=state, items=sorted((tuple(i) for i in items), key=lambda i: i[0]))

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        closed, timer = self.flags.get() if self.flags.exists() else (False, None)
        names = _item().names
        if closed:
            late = [tuple(r[n] for n in names) for r in rows if not r["gone"]]
            if late:
                yield self._row(key, "late", late)
            return
        before = {k[0]: tuple(v) for k, v in self.items.iterator()} if self.items.exists() else {}
        items, changed = dict(before), set()
        for r in rows:
            held = items.get(r["id"])
            if r["gone"]:
                if held is not None and held[0] == r["ord"]:
                    del items[r["id"]]
                    changed.add(r["id"])
            elif held is None or r["ord"] < held[0]:
                items[r["id"]] = tuple(r[n] for n in names)
                changed.add(r["id"])
        for ident in changed:
            if ident in items:
                self.items.updateValue((ident,), items[ident])
            elif ident in before:
                self.items.removeKey((ident,))
        if self.idle_ms is not None:
            if timer is not None:
                self.handle.deleteTimer(timer)
            timer = timerValues.getCurrentProcessingTimeInMs() + self.idle_ms
            self.handle.registerTimer(timer)
            self.flags.update((False, timer))
        if changed:
            yield self._row(key, "open", list(items.values()))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        items = list(self.items.values())
        self.items.clear()
        self.flags.update((True, None))
        yield self._row(key, "closed", items)

    def close(self) -> None:
        pass


def first_rows(stream: DataFrame) -> DataFrame:
    """Changes (``CHANGE``) to the set of first rows, from a stream of comments with ``text``."""
    ship_for_texts(stream.sparkSession)
    return stream.select(*KEPT).groupBy("source", "id").transformWithState(FirstOfId(), CHANGE, "Update", "None")


def growing_threads(changes: DataFrame, idle_ms: int | None = None) -> DataFrame:
    """Versions of threads, from a stream of such changes."""
    ship_for_texts(changes.sparkSession)
    keyed = changes.withColumn("thread_id", threads.thread_id(F.col("link_id")))
    return keyed.groupBy("source", "thread_id").transformWithState(Thread(idle_ms), THREAD, "Update", "None" if idle_ms is None else "ProcessingTime")


def apart(rows: DataFrame, texts: str) -> DataFrame:
    """Rows for the streams: those of ``rows`` (``KEPT``, and any more) are written to the folder ``texts`` with a number of their own, ``place``, and come back with it as ``text``; of a body only the mark of deleted ones is left."""
    rows.withColumns({"place": F.monotonically_increasing_id().cast("string"), "body": F.when(F.col("body") == "[deleted]", F.col("body")).otherwise("")}).write.parquet(texts, compression="zstd")
    held = rows.sparkSession.read.parquet(texts)
    return held.withColumn("text", F.col("place")).select(*rows.columns)


def with_texts(versions: DataFrame, texts: DataFrame, parts: int) -> DataFrame:
    """Versions, one of each thread at most, with the texts that :func:`apart` wrote in place of their places.

    Places and texts meet by thread, so texts are shuffled once, in so many ``parts``, and the parts are the documents' too.
    """
    keys, rest = ("source", "thread_id"), [c for c in versions.columns if c not in ("source", "thread_id", "items")]
    items = versions.select(*keys, F.explode("items").alias("item"), *rest).select(*keys, F.col("item.text").alias("place"), F.struct("item", *rest).alias("held"), F.lit(None).cast("string").alias("text"))
    rows = texts.select("source", threads.thread_id(F.col("link_id")).alias("thread_id"), "place", F.lit(None).cast(items.schema["held"].dataType).alias("held"), "text")
    met = items.unionByName(rows).repartition(parts, *keys).groupBy(*keys, "place").agg(F.first("held", True).alias("held"), F.first("text", True).alias("text")).where("held is not null")
    item = F.struct(*(F.col("text") if n == "text" else F.col(f"held.item.{n}").alias(n) for n in _item().names))
    made = met.groupBy(*keys).agg(F.array_sort(F.collect_list(item)).alias("items"), *(F.first(f"held.{c}").alias(c) for c in rest))
    empty = versions.where(F.size("items") == 0)
    return made.select(*versions.columns).unionByName(empty)


def documents(versions: DataFrame, fallback_date: str = "1970-01-01") -> DataFrame:
    """source, thread_id, state and the TEI document of each version; without a document where nothing is left of it."""
    # no join, as reading a batch twice would run its state twice
    rows = versions.withColumn("info", F.try_element_at("items", F.lit(-1)))
    rows = rows.select("source", "thread_id", "state", F.col("items").alias("comments"), *(c.alias(n) for n, c in threads.metadata(F.col("info"), F.col("thread_id"), F.lit(fallback_date)).items()))
    return tei.grouped(rows, keep=("source", "thread_id", "state"), empty=True)


def parts_for(spark: SparkSession, path: str) -> int:
    """So many parts of state that each has PART_BYTES of the files under ``path`` at most, if keys are even; one for each core at least."""
    held = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).agg(F.sum("length")).first()[0] or 0
    return max(spark.sparkContext.defaultParallelism, -(-held // PART_BYTES))


def run(stream: DataFrame, out: str, checkpoint: str, change=None, parts: int | None = None) -> None:
    """All there is of a stream of state to ``out``/epoch=N, the batch's rows by ``change``; run again, it goes on.

    The state is cut into ``parts``, or as many as the session shuffles into; what a checkpoint began with stays.
    """
    spark = stream.sparkSession
    wanted = STATE | ({"spark.sql.shuffle.partitions": str(parts)} if parts else {})
    old = {k: spark.conf.get(k, None) for k in wanted}

    def save(batch: DataFrame, epoch: int) -> None:
        (change(batch) if change else batch).write.mode("overwrite").parquet(f"{out}/epoch={epoch}")

    try:
        for k, v in wanted.items():
            spark.conf.set(k, v)
        stream.writeStream.outputMode("update").foreachBatch(save).trigger(availableNow=True).option("checkpointLocation", checkpoint).start().awaitTermination()
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def latest(rows: DataFrame, *keys: str, parts: int | None = None) -> DataFrame:
    """The last version of each key of what :func:`run` wrote, met in so many ``parts``; late comments are no version."""
    rest = [c for c in rows.columns if c not in keys]
    rows = rows.where("state != 'late'") if "state" in rows.columns else rows
    rows = rows.repartition(parts, *keys) if parts else rows
    last = rows.groupBy(*keys).agg(F.max_by(F.struct(*rest), "epoch").alias("v"))
    return last.select(*keys, *(F.col(f"v.{c}").alias(c) for c in rest))
