"""TEI documents as column expressions: header, grouped body, single-comment body."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.functions import text as X
from corpusloom.functions.python_text import unescaped
from corpusloom.functions.shipping import ship_for_texts

#: XML 1.0 has no place for these; cleaning keeps them as white space.
ILLEGAL = "\x0b\x0c\x1d\x1f"


def lines(*parts: str | Column) -> Column:
    """Concatenates text and columns; columns must be escaped."""
    return F.concat(*(F.lit(p) if isinstance(p, str) else p for p in parts))


def rendered(body: Column, python: bool = True, strict: bool = False) -> Column:
    """Comment text as XML content. ``strict`` leaves illegal characters for :func:`documents` to reject."""
    text = unescaped(body) if python else body
    text = X.separators(X.mentions(text))
    if not strict:
        text = X.translated(text, ILLEGAL)
    return X.line_breaks(X.xml_text(text))


def header(grouped: bool) -> Column:
    """The header from the metadata columns; what is missing is empty."""
    t, a = (lambda n: X.xml_text(F.coalesce(n, F.lit("")))), (lambda n: X.xml_attribute(F.coalesce(n, F.lit(""))))
    top = lines(
        "  <teiHeader>\n    <fileDesc>\n      <titleStmt>\n        <title type=\"main\">", t("title"), "</title>\n      </titleStmt>\n      <publicationStmt>\n        <p/>\n      </publicationStmt>\n      <sourceDesc>\n        <bibl>Reddit/",
        t("subreddit"), ": ", t("title"), ", ", t("date"), "</bibl>\n        <biblFull>\n          <titleStmt>\n",
    )
    if grouped:
        mid = lines(
            "            <title type=\"main\">Reddit/", t("subreddit"), "</title>\n          </titleStmt>\n          <publicationStmt>\n            <publisher/>\n            <ptr type=\"URL\" target=\"", a("thread_url"),
            "\"/>\n            <date type=\"last_comment\">", t("date"), "</date>\n          </publicationStmt>\n",
        )
    else:
        mid = lines(
            "            <title type=\"main\" level=\"a\">", t("title"), "</title>\n            <author>", t("author"), "</author>\n          </titleStmt>\n          <publicationStmt>\n            <publisher/>\n            <ptr type=\"thread\" target=\"",
            a("thread_url"), "\"/>\n            <ptr type=\"comment\" target=\"", a("comment_url"), "\"/>\n            <date>", t("date"),
            "</date>\n          </publicationStmt>\n          <seriesStmt>\n            <title type=\"main\" level=\"m\">Reddit</title>\n            <title type=\"sub\" level=\"m\">", t("subreddit"), "</title>\n          </seriesStmt>\n",
        )
    end = lines("        </biblFull>\n      </sourceDesc>\n    </fileDesc>\n    <profileDesc>\n      <creation>\n        <date type=\"download\">", t("download_date"), "</date>\n      </creation>\n    </profileDesc>\n  </teiHeader>\n")
    return F.concat(top, mid, end)


START, END = '<TEI xmlns="http://www.tei-c.org/ns/1.0">\n', "</TEI>\n"


def _checked(docs: DataFrame, strict: bool) -> DataFrame:
    bad = F.col("tei").rlike(r"[\x00-\x08\x0b\x0c\x0e-\x1f\uFFFE\uFFFF]")
    docs = docs.withColumn("xml_ok", ~bad).withColumn("xml_error", F.when(bad, "a character that XML doesn't allow"))
    return docs.where("xml_ok") if strict else docs


def prepared(comments: DataFrame, python: bool = True, strict: bool = False) -> DataFrame:
    """Comments with ``text``, the body as XML content: to be made before comments are grouped, as the Python function takes columns, not arrays."""
    ship_for_texts(comments.sparkSession)
    return comments.withColumn("text", rendered(F.col("body"), python, strict))


def grouped(threads: DataFrame, filtered: bool = True, strict: bool = False, keep: tuple[str, ...] = (), empty: bool = False) -> DataFrame:
    """One document per thread of :func:`prepared` comments: the columns of ``keep``, file_name, tei, n_items, xml_ok, xml_error. A thread of which nothing is left has none; with ``empty`` it has a row of nulls beside ``keep``."""
    items = F.filter("comments", lambda c: c["body"] != "[deleted]") if filtered else F.col("comments")
    rows, some = threads.withColumn("__items", items), F.size("__items") > 0
    rows, made = (rows, lambda c: F.when(some, c)) if empty else (rows.where(some), lambda c: c)
    item = lambda c: lines(
        '          <item source="', X.xml_attribute(F.concat(F.col("thread_url"), F.lit("comment/"), c["id"], F.lit("/"))), '">', c["text"], "<date>", F.coalesce(X.utc_date(c["created_utc"]), F.lit("")), "</date> <name>",
        X.xml_text(F.coalesce(c["author"], F.lit(""))), "</name> </item>\n",
    )
    body = lines('  <text>\n    <body>\n      <div type="comments">\n        <list>\n', F.array_join(F.transform("__items", item), ""), "        </list>\n      </div>\n    </body>\n  </text>\n")
    docs = rows.select(*keep, made(F.concat("post_id", F.lit(".xml"))).alias("file_name"), made(F.concat(F.lit(START), header(True), body, F.lit(END))).alias("tei"), made(F.size("__items").cast("long")).alias("n_items"))
    return _checked(docs, strict)


def single(comments: DataFrame, filtered: bool = True, python: bool = True, strict: bool = False) -> DataFrame:
    """One document per comment: file_name, tei, n_items, xml_ok, xml_error."""
    ship_for_texts(comments.sparkSession)
    rows = comments.where(F.col("body") != "[deleted]") if filtered else comments
    body = lines("  <text>\n    <body>\n      <p>", rendered(F.col("body"), python, strict), "</p>\n    </body>\n  </text>\n")
    name = F.concat("thread_id", F.lit("_"), "comment_id", F.lit(".xml"))
    docs = rows.select(name.alias("file_name"), F.concat(F.lit(START), header(False), body, F.lit(END)).alias("tei"), F.lit(1).cast("long").alias("n_items"))
    return _checked(docs, strict)
