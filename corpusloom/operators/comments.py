"""The cleaning stage: one projection that tags every comment with why it goes, or its clean body.

Steps run in a fixed order and the first reason counts: bot, deleted, url_only, url_marks,
reminder, empty. Rows kept, the audit and the counters are views of the tagged rows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.functions import text as X

REASONS = ("bot", "deleted", "url_only", "url_marks", "reminder", "empty")


@dataclass(frozen=True)
class Config:
    """What to remove. ``inline`` strips inline marks from bodies (archives can do it on raw lines)."""

    deleted: bool = True
    quotes: bool = True
    reminders: bool = True
    urls: bool = True
    inline: bool = False


def without_bots(df: DataFrame, bots: DataFrame) -> DataFrame:
    """Rows whose lower-cased author isn't listed. Spark broadcasts the list if its size is under the session's limit."""
    listed = bots.select(F.col("name").alias("__bot")).distinct()
    return df.join(listed, F.lower("author") == F.col("__bot"), "left_anti")


def _held(rows: DataFrame, names: list[str], steps: dict) -> DataFrame:
    """Adds the steps behind a generator, which filters and projections above can't copy their expressions through."""
    step = F.explode_outer(F.array(F.struct(*(c.alias(n) for n, c in steps.items())))).alias("__step")
    return rows.select(*names, step).select(*names, *(F.col("__step")[n].alias(n) for n in steps))


def tag(df: DataFrame, bots: DataFrame | None = None, config: Config = Config()) -> DataFrame:  # noqa: B008
    """Adds original, drop_reason, body (clean), quote_changed, url_changed, urls_removed. Nulls count as empty."""
    names = [c for c in df.columns if c != "body"]
    body = F.coalesce("body", F.lit(""))
    rows = df.select(*names, (X.inline_formatting(body) if config.inline else body).alias("body"))
    if bots is None:
        rows = rows.withColumn("__is_bot", F.lit(False))
    else:
        listed = bots.select(F.col("name").alias("__bot")).distinct()
        rows = rows.join(listed, F.lower(F.coalesce("author", F.lit(""))) == F.col("__bot"), "left").withColumn("__is_bot", F.col("__bot").isNotNull()).drop("__bot")
    rows = _held(rows, [*names, "body", "__is_bot"], {"original": X.py_strip(F.col("body"))})
    early = F.when(F.col("__is_bot"), "bot")
    if config.deleted:
        early = early.when(F.col("original").isin(*X.DELETED), "deleted")
    if config.urls:
        early = early.when(X.is_only_url(F.col("original")), "url_only")
    base = [*names, "body", "original"]
    rows = _held(rows, base, {"__early": early})
    base, live = [*base, "__early"], F.col("__early").isNull()
    if config.quotes:
        rows = _held(rows, base, {"__q1": F.when(live, X.escaped_quotes(F.col("original")))})
        rows = _held(rows, [*base, "__q1"], {"__q2": X.py_strip(X.modern_quotes(F.col("__q1"))), "__q1s": X.py_strip(F.col("__q1"))})
        changed = F.coalesce((F.col("__q1s") != F.col("original")) | (F.col("__q2") != F.col("__q1s")), F.lit(False))
        rows = _held(rows, base, {"quote_changed": changed, "__b2": F.when(changed, F.col("__q2")).otherwise(F.col("body"))})
    else:
        rows = rows.withColumn("quote_changed", F.lit(False)).withColumn("__b2", F.col("body"))
    base = [*base, "quote_changed", "__b2"]
    if config.urls:
        rows = _held(rows, base, {"__b3": F.when(live, X.plain_urls(X.markdown_urls(F.col("__b2"))))})
        changed = F.coalesce(F.col("__b3") != F.col("__b2"), F.lit(False))
        count = lambda c: X.count_plain_urls(F.col(c)) + X.count_markdown_urls(F.col(c))
        removed = F.when(changed, count("__b2") - count("__b3")).otherwise(0).cast("long")
        marks = changed & (X.is_blank(F.col("__b3")) | X.is_only_marks(X.py_strip(F.col("__b3"))))
    else:
        rows = rows.withColumn("__b3", F.col("__b2"))
        changed, removed, marks = F.lit(False), F.lit(0).cast("long"), F.lit(False)
    rows = _held(rows, [*base, "__b3"], {"url_changed": changed, "urls_removed": removed, "__marks": marks, "__b4": X.newlines(X.zero_width_marks(F.col("__b3")))})
    reason = F.when(~live, F.col("__early")).when(F.col("__marks"), "url_marks")
    if config.reminders:
        reason = reason.when(X.is_reminder(F.col("__b3")), "reminder")
    reason = reason.when(X.is_blank(F.col("__b4")), "empty")
    final = {"drop_reason": reason, "body": F.coalesce("__b4", "body"), "body_before": F.coalesce("__b3", "body")}
    return _held(rows, [*names, "original", "quote_changed", "url_changed", "urls_removed"], final)


HELPERS = ("original", "drop_reason", "body_before", "quote_changed", "url_changed", "urls_removed")


def kept(tagged: DataFrame) -> DataFrame:
    return tagged.where("drop_reason is null").drop(*HELPERS)


def audit(tagged: DataFrame) -> DataFrame:
    """(id, tag, original, modified) of every removal and change; bots aren't logged."""
    #: The tags of the log.
    tags = {"deleted": "deleted/removed", "url_only": "removed due to being only a URL", "url_marks": "only [URL] placeholders", "reminder": "!remindme", "empty": "empty or whitespace only"}
    name = F.create_map(*(F.lit(x) for pair in tags.items() for x in pair))
    reached = F.col("drop_reason").isNull() | (F.col("drop_reason") == "empty")
    original = F.when(F.col("drop_reason") == "reminder", F.col("body_before")).otherwise(F.col("original"))
    entry = lambda tag, modified, first: F.struct(tag.alias("tag"), first.alias("original"), modified.alias("modified"))
    nothing = F.lit(None).cast("string")
    entries = F.array(
        F.when(reached & F.col("quote_changed"), entry(F.lit("contained quotation"), F.col("body"), F.col("original"))),
        F.when(reached & F.col("url_changed"), entry(F.lit("URL (any type)"), F.col("body"), F.col("original"))),
        F.when(F.col("drop_reason").isin(*tags), entry(F.element_at(name, F.coalesce("drop_reason", F.lit("empty"))), nothing, original)),
    )
    return tagged.select("id", F.explode(F.array_compact(entries)).alias("e")).select("id", "e.*")


def counter_columns() -> dict[str, Column]:
    """The aggregates over tagged comments that say what was removed. Quotes and URLs count also where the comment goes later."""
    reason = F.col("drop_reason")
    return {
        "bots": F.count_if(reason == "bot"),
        "deleted": F.count_if(reason == "deleted"),
        "quotes": F.count_if("quote_changed"),
        "reminders": F.count_if(reason == "reminder"),
        "urls": F.coalesce(F.sum("urls_removed"), F.lit(0).cast("long")),
        "url_only": F.count_if(reason == "url_only"),
    }


def counters(tagged: DataFrame) -> DataFrame:
    """One row: what was removed."""
    return tagged.agg(*(c.alias(n) for n, c in counter_columns().items()))


def bot_counts(tagged: DataFrame) -> DataFrame:
    return tagged.where("drop_reason = 'bot'").groupBy(F.lower("author").alias("author")).agg(F.count(F.lit(1)).alias("n"))
