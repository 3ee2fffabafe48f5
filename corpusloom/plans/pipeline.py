"""The whole run: archive to clean comments, threads or single comments, TEI documents, checks and counts."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.functions.shared import observed, stored
from corpusloom.operators import comments, tei, threads
from corpusloom.operators.validate import Dtd, read_dtd, validate
from corpusloom.schema import COMMENT_FIELDS
from corpusloom.sources import readers, writers


@dataclass
class Run:
    """Lazy results of a run; ``tagged`` is written to the shared folder as several of them read it."""

    tagged: DataFrame
    clean: DataFrame
    extracted: DataFrame
    documents: DataFrame
    json: DataFrame
    audit: DataFrame
    counters: DataFrame
    reconciled: DataFrame
    validation: DataFrame = field(repr=False)


def documents_of(extracted: DataFrame, grouped: bool = True, strict: bool = False, fallback_date: str = "1970-01-01") -> DataFrame:
    """TEI documents of comments, one a thread or one a comment; null bodies count as empty."""
    extracted = extracted.withColumn("body", F.coalesce("body", F.lit("")))
    if grouped:
        return tei.grouped(threads.threads(tei.prepared(extracted, strict=strict), fallback_date), strict=strict)
    return tei.single(threads.single_comments(extracted, fallback_date), strict=strict)


def run(rows: DataFrame, bots: DataFrame | None = None, grouped: bool = True, config: comments.Config = comments.Config(), strict: bool = False, fallback_date: str = "1970-01-01", dtd: Dtd | None = None) -> Run:  # noqa: B008
    tagged, seen = observed(comments.tag(rows, bots, config), "tagged", **comments.counter_columns())  # counted while it is written
    counters = rows.sparkSession.createDataFrame([tuple(seen.values())], ", ".join(f"{n} long" for n in seen))
    clean = comments.kept(tagged)
    extracted = threads.first_of_id(threads.extract(clean))
    documents = documents_of(extracted, grouped, strict, fallback_date)
    json = (threads.thread_json if grouped else threads.comment_json)(extracted, COMMENT_FIELDS)
    return Run(tagged, clean, extracted, documents, json, comments.audit(tagged), counters, threads.reconcile(clean, extracted), validate(documents, dtd=dtd))


def reconcile_written(spark: SparkSession, archive: str, folder: str) -> DataFrame:
    """One row: the records in a written archive and in the JSON files below a folder, and whether these agree."""
    counts = readers.count_lines(spark, archive).select(F.col("n").alias("filtered_n"), readers.count_objects(spark, folder).scalar().alias("emitted_n"))
    return counts.withColumn("matches", F.col("filtered_n") == F.col("emitted_n"))


def lost_records(spark: SparkSession, folder: str, grouped: bool = True) -> DataFrame:
    """(id, link_id, reason, n): the records of a run's filtered archive that are in none of its documents, from what was written.

    The archive, the JSON files and the manifest of the documents meet by id. Reasons: ``no_submission`` (its parent is no
    submission), ``repeat`` (its id came before), ``deleted`` (left out of the document), ``refused`` (its document wasn't
    written) and ``missing`` (none of these: something went wrong between the archive and the JSON files).
    """
    archive = readers.read_archive(spark, f"{folder}/filtered").groupBy("id", "link_id").agg(F.count(F.lit(1)).alias("n"))
    # the small files are read once for three uses, and of the bodies only the mark of deleted ones counts
    written = stored(readers.read_json_documents(spark, f"{folder}/json").withColumn("body", F.when(F.col("body") == "[deleted]", F.col("body"))), "written")
    names = spark.read.schema("name string").parquet(f"{folder}/xml/{writers.MANIFEST}").select(F.col("name").alias("__name"))
    if grouped:
        files = threads.threads(written).select("thread_id", F.concat("post_id", F.lit(".xml")).alias("file"))
        emitted = written.select("id", "link_id", "body", threads.thread_id(F.col("link_id")).alias("thread_id")).join(files, "thread_id", "left")
    else:
        emitted = written.select("id", "link_id", "body", F.concat(threads.thread_id(F.col("link_id")), F.lit("_"), "id", F.lit(".xml")).alias("file"))
    emitted = emitted.join(names, F.replace("file", F.lit("/"), F.lit("_")) == F.col("__name"), "left")
    emitted = emitted.select("id", F.lit(1).alias("one"), F.when(F.col("body") == "[deleted]", "deleted").when(F.col("__name").isNull(), "refused").alias("why"), F.col("link_id").alias("of"))
    met = archive.join(emitted, (archive["id"] == emitted["id"]) & (archive["link_id"] == emitted["of"]), "full_outer").drop(emitted["id"])
    first = F.when(F.col("one").isNotNull(), F.struct(F.col("why").alias("reason"), F.lit(1).cast("long").alias("n")))
    stray = F.when(~F.coalesce(F.col("link_id").startswith("t3_"), F.lit(False)), "no_submission").when(F.col("one").isNull() & ~F.col("elsewhere"), "missing").otherwise("repeat")
    # an id that came first in another thread of the source is a repeat here
    first_of = written.select("id", F.lit(True).alias("elsewhere")).distinct()
    met = met.join(first_of, "id", "left").withColumn("elsewhere", F.coalesce("elsewhere", F.lit(False)))
    rest = F.struct(stray.alias("reason"), (F.col("n") - F.when(F.col("one").isNotNull(), 1).otherwise(0)).alias("n"))
    return met.select("id", "link_id", F.explode(F.array_compact(F.array(first, rest))).alias("x")).where("x.reason is not null and x.n > 0").select("id", "link_id", "x.*")


def run_archive(spark: SparkSession, path: str, out: str, bots: str | None = None, grouped: bool = True, raw_inline: bool = True, long_window: bool = False, dtd: str | None = None, mode: str = "overwrite", only: str | None = None) -> Run:
    """Archive files to ``out``/filtered (the cleaned archive), ``out``/json, ``out``/xml and the tables ``audit``, ``counters``, ``reconciled`` and ``validation`` beside them.

    ``reconciled`` counts what was written; ``dtd`` is the file of a DTD to hold the documents against. A second run into one
    folder replaces what the first wrote (``mode`` ``overwrite``) or is refused (``errorifexists``). ``only`` is the file of a
    list of threads: comments of others are left out before they are parsed.
    """
    if mode not in ("overwrite", "errorifexists"):
        raise ValueError("mode is overwrite or errorifexists")
    rows = readers.read_archive(spark, path, raw_inline, long_window, readers.read_threads(spark, only) if only else None)
    result = run(rows, readers.read_names(spark, bots) if bots else None, grouped)
    writers.write_archive(result.clean, f"{out}/filtered", list(COMMENT_FIELDS), mode=mode)
    writers.write_files(result.json, f"{out}/json", "json", mode=mode)
    result.documents = stored(result.documents, "documents")
    writers.write_files(result.documents, f"{out}/xml", "tei", mode=mode)
    result.validation = validate(result.documents, dtd=read_dtd(spark, dtd) if dtd else None)
    result.reconciled = reconcile_written(spark, f"{out}/filtered", f"{out}/json")
    for name in ("audit", "counters", "reconciled", "validation"):
        writers.write_table(getattr(result, name), f"{out}/{name}", mode=mode)
    return result


def run_json(spark: SparkSession, path: str, grouped: bool = True, fallback_date: str = "1970-01-01", recursive: bool = True) -> DataFrame:
    """Documents again from JSON files written earlier, without the cleaning stage: one a thread, whatever files it lies in, or one a comment."""
    return documents_of(readers.read_json_documents(spark, path, recursive), grouped, fallback_date=fallback_date)
