"""Every query of the engine by name, with the SQL that says the same.

The tables at hand hold prose that seldom needs cleaning, so the queries run over comments derived
from ``documents`` by a fixed rule that makes every operator act (:func:`comment_view`): every
document's own whole text is a comment, for some with a mark before or behind it, and short cases
come as further comments.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.functions import text as X
from corpusloom.functions.python_text import unescaped
from corpusloom.functions.shared import remove_at_exit, shared_dir, stored
from corpusloom.functions.shipping import ship_for_texts
from corpusloom.operators import comments, tei, threads, validate
from corpusloom.plans import pipeline
from corpusloom.schema import COMMENT_FIELDS, DROPPED_FIELDS
from corpusloom.sources import readers, writers
from corpusloom.sources.folders import listed
from corpusloom.streaming import clean as streaming

BOTS = ["SRC1", "src7 ", "AutoHelper"]
FALLBACK = "2024-01-01"


def spread(df: DataFrame) -> DataFrame:
    """Over all cores, where a table has fewer parts than there are: its texts cost far more than their shuffle."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def comment_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """source, ord and the comment fields: every document's text, short cases, and a later copy of every 50th with another body."""
    d = spread(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang", F.col("source").alias("src")))
    text, nl = F.col("text"), "\n"
    num = F.col("doc_id").cast("string")
    around = {
        3: F.concat(F.lit(f"&gt; quoted{nl}"), text), 4: F.concat(text, F.lit(f"{nl}> quoted{nl}>{nl}tail")), 5: F.concat(F.lit("[site](https://a.example/x) "), text), 7: F.concat(F.lit("see www.a.example/p). "), text),
        10: F.concat(F.lit("**b** *i* ~~s~~ "), text), 11: F.concat(F.lit(f"a{nl} {nl}{nl}"), text), 13: F.concat(F.lit("hi /u/some_user "), text), 14: F.concat(text, F.lit(" \x1c")),
    }
    short = {
        0: F.lit("[deleted]"), 1: F.lit(" [removed] "), 2: F.concat(F.lit("https://example.org/x/"), num), 6: F.lit("[www.a.example](https://b.example)"), 8: F.lit("!remindme 2 days"), 9: F.lit("RemindMe! 2 days"), 12: F.lit("&#x200B;"), 14: F.lit("   "),
        15: F.concat(F.lit("line\rone\x1etwo "), num),
    }
    body, case = text, F.lit(None).cast("string")
    for k, v in around.items():
        body = F.when(F.col("doc_id") % 16 == k, v).otherwise(body)
    for k, v in short.items():
        case = F.when(F.col("doc_id") % 16 == k, v).otherwise(case)
    one = lambda i, ord_, value: F.struct(i.alias("id"), ord_.alias("ord"), value.alias("body"))
    main, more = one(F.concat(F.lit("c"), num), F.col("doc_id"), body), one(F.concat(F.lit("k"), num), F.col("doc_id") + 2000000000, case)
    both = d.select("*", F.explode(F.when(case.isNull(), F.array(main)).otherwise(F.array(main, more))).alias("m"))
    ident = F.col("m.id")
    link = F.when(F.col("doc_id") % 37 == 0, F.lit("t1_x")).otherwise(F.concat(F.lit("t3_p"), F.floor(F.col("doc_id") / 8).cast("string")))
    created = F.lit(1700000000) + F.col("doc_id") * 3601
    path = F.concat(F.lit("/r/"), F.col("lang"), F.lit("/comments/p"), F.floor(F.col("doc_id") / 8).cast("string"), F.lit("/slug_"), F.col("src"), F.lit("/"), ident, F.lit("/"))
    rows = both.select(
        F.lit("documents").alias("source"), F.col("m.ord").alias("ord"), ident.alias("id"), link.alias("link_id"), F.when(F.col("doc_id") % 41 == 0, F.lit(None)).when(F.col("doc_id") % 2 == 1, F.upper("src")).otherwise(F.col("src")).alias("author"), F.col("m.body").alias("body"),
        F.when(F.col("doc_id") % 2 == 1, F.concat(created.cast("string"), F.lit(".0"))).otherwise(created.cast("string")).alias("created_utc"), F.col("lang").alias("subreddit"), F.when(F.col("doc_id") % 5 != 0, path).alias("permalink"),
        F.when(F.col("doc_id") % 3 == 0, (created + 100000).cast("string")).alias("retrieved_on"), F.when(F.col("doc_id") % 3 == 1, (created + 200000).cast("string")).alias("retrieved_utc"),
    )
    copies = rows.where(F.col("ord") % 50 == 0).withColumn("body", F.concat(F.lit("copy of "), "id")).withColumn("ord", F.col("ord") + 1000000000)
    return rows.unionByName(copies)


NL = "chr(10)"
VIEW_SQL = f"""base AS (
  SELECT doc_id, text, lang, source AS src, doc_id % 16 AS k, 1700000000 + doc_id * 3601 AS created FROM documents
), bodies AS (
  SELECT *, doc_id AS ord, 'c' || doc_id AS id, CASE k
      WHEN 3 THEN '&gt; quoted' || {NL} || text WHEN 4 THEN text || {NL} || '> quoted' || {NL} || '>' || {NL} || 'tail'
      WHEN 5 THEN '[site](https://a.example/x) ' || text WHEN 7 THEN 'see www.a.example/p). ' || text
      WHEN 10 THEN '**b** *i* ~~s~~ ' || text WHEN 11 THEN 'a' || {NL} || ' ' || {NL} || {NL} || text
      WHEN 13 THEN 'hi /u/some_user ' || text WHEN 14 THEN text || ' ' || chr(28) ELSE text END AS body FROM base
  UNION ALL
  SELECT *, doc_id + 2000000000, 'k' || doc_id, CASE k WHEN 0 THEN '[deleted]' WHEN 1 THEN ' [removed] ' WHEN 2 THEN 'https://example.org/x/' || doc_id
      WHEN 6 THEN '[www.a.example](https://b.example)' WHEN 8 THEN '!remindme 2 days' WHEN 9 THEN 'RemindMe! 2 days' WHEN 12 THEN '&#x200B;' WHEN 14 THEN '   '
      ELSE 'line' || chr(13) || 'one' || chr(30) || 'two ' || doc_id END FROM base WHERE k IN (0, 1, 2, 6, 8, 9, 12, 14, 15)
), one AS (
  SELECT 'documents' AS source, ord, id,
    CASE WHEN doc_id % 37 = 0 THEN 't1_x' ELSE 't3_p' || (doc_id // 8) END AS link_id,
    CASE WHEN doc_id % 41 = 0 THEN NULL WHEN doc_id % 2 = 1 THEN upper(src) ELSE src END AS author, body,
    created AS created_utc, lang AS subreddit,
    CASE WHEN doc_id % 5 <> 0 THEN '/r/' || lang || '/comments/p' || (doc_id // 8) || '/slug_' || src || '/' || id || '/' END AS permalink,
    CASE WHEN doc_id % 3 = 0 THEN created + 100000 END AS retrieved_on,
    CASE WHEN doc_id % 3 = 1 THEN created + 200000 END AS retrieved_utc
  FROM bodies
), comments AS (
  SELECT * FROM one
  UNION ALL
  SELECT source, ord + 1000000000, id, link_id, author, 'copy of ' || id, created_utc, subreddit, permalink, retrieved_on, retrieved_utc FROM one WHERE ord % 50 = 0
)"""

WS = r"[\s\x1c-\x1f]"
URL_SQL = r"(?:https?://|www\.)\S*\w/?"


def strip_sql(x: str) -> str:
    return rf"regexp_replace({x}, '^{WS}+|{WS}+$', '', 'g')"


def plain_sql(x: str) -> str:
    return rf"regexp_replace({x}, '(^|[^\]\w]){URL_SQL}', '\1[URL]', 'gi')"


def markdown_sql(x: str) -> str:
    marked = rf"regexp_replace({x}, '\[([^\]]+)\]\((?:https?://|www\.)\S+\)', chr(57344) || '\1' || chr(57345), 'g')"
    named = rf"regexp_replace({marked}, chr(57344) || '(?:https?://|www\.)[^\s' || chr(57345) || ']*\w[^' || chr(57345) || ']*' || chr(57345), '[URL]', 'gi')"
    return f"translate({named}, chr(57344) || chr(57345), '')"


def inline_sql(x: str) -> str:
    x = rf"regexp_replace({x}, '~~.*?~~', '', 'g')"
    x = rf"regexp_replace({x}, '\*\*((?:\S(?:.*?\S)??)??)\*\*', '\1', 'g')"
    return rf"regexp_replace({x}, '\*((?:\S(?:.*?\S)??)??)\*', '\1', 'g')"


def escaped_sql(x: str) -> str:
    return rf"regexp_replace({x}, '(?:\n|^)&gt;[^\n]*', '', 'g')"


def modern_sql(x: str) -> str:
    return rf"regexp_replace({x}, '(?:\n|^)>[^\n]+(?:\n>[^\n]*)*', '', 'g')"


def urls_sql(x: str) -> str:
    return rf"(len(regexp_extract_all({x}, '(?i)(?:^|[^\]\w]){URL_SQL}')) + len(regexp_extract_all({x}, '\[[^\]]+\]\((?:https?://|www\.)\S+\)')))"


def newlines_sql(x: str) -> str:
    return rf"regexp_replace({x}, '\n{WS}*\n+', chr(10), 'g')"


ZERO_SQL = r"regexp_replace({x}, '&amp;#x200B;|&#x200B;|\\u200B', '', 'g')"
DELETED_SQL = "('[removed]', '[deleted]', '[removed by reddit]')"
REMIND_SQL = rf"'(?i)^{WS}*(?:!remindme|!remind me|remindme!|remind me!)\b'"
BOTS_SQL = "('src1', 'src7', 'autohelper')"
TAGGED_SQL = f"""{VIEW_SQL}, s1 AS (
  SELECT *, {strip_sql('body')} AS original FROM comments
), s2 AS (
  SELECT *, CASE WHEN coalesce(lower(author) IN {BOTS_SQL}, false) THEN 'bot' WHEN original IN {DELETED_SQL} THEN 'deleted'
    WHEN regexp_full_match(original, '(?i){URL_SQL}') THEN 'url_only' END AS early, {escaped_sql('original')} AS q1 FROM s1
), s3 AS (
  SELECT *, {strip_sql(modern_sql('q1'))} AS q2, {strip_sql('q1')} AS q1s FROM s2
), s4 AS (
  SELECT *, early IS NULL AND (q1s <> original OR q2 <> q1s) AS quote_changed FROM s3
), s5 AS (
  SELECT *, CASE WHEN quote_changed THEN q2 ELSE body END AS b2 FROM s4
), s6 AS (
  SELECT *, CASE WHEN early IS NULL THEN {plain_sql(markdown_sql('b2'))} END AS b3 FROM s5
), s7 AS (
  SELECT *, coalesce(b3 <> b2, false) AS url_changed FROM s6
), s8 AS (
  SELECT *, CASE WHEN url_changed THEN {urls_sql('b2')} - {urls_sql('b3')} ELSE 0 END AS urls_removed,
    {newlines_sql(ZERO_SQL.format(x='b3'))} AS b4 FROM s7
), tagged AS (
  SELECT source, ord, id, link_id, author, created_utc, subreddit, permalink, retrieved_on, retrieved_utc, original, quote_changed, url_changed, urls_removed,
    coalesce(b4, body) AS body, coalesce(b3, body) AS body_before,
    CASE WHEN early IS NOT NULL THEN early
      WHEN url_changed AND ({strip_sql('b3')} = '' OR regexp_full_match({strip_sql('b3')}, '(?:\\[URL\\][!?.]*{WS}*)+')) THEN 'url_marks'
      WHEN regexp_matches(b3, {REMIND_SQL}) THEN 'reminder' WHEN {strip_sql('b4')} = '' THEN 'empty' END AS drop_reason FROM s8
)"""
EXTRACTED_SQL = f"""{TAGGED_SQL}, extracted AS (
  SELECT * FROM tagged WHERE drop_reason IS NULL AND starts_with(link_id, 't3_') QUALIFY row_number() OVER (PARTITION BY source, id ORDER BY ord) = 1
)"""


def date_sql(x: str) -> str:
    return f"strftime(make_timestamp(cast({x} AS BIGINT) * 1000000), '%Y-%m-%d')"


def xml_sql(x: str) -> str:
    return f"replace(replace(replace(replace({x}, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), chr(13), '&#13;')"


def meta_sql(prefix: str, post: str) -> str:
    p = f"{prefix}permalink"
    return f"""coalesce(split_part({p}, '/', 5), {post}) AS post_id, coalesce(split_part({p}, '/', 6), {post}) AS title, {date_sql(prefix + 'created_utc')} AS date,
      coalesce(split_part({p}, '/', 3), {prefix}subreddit) AS subreddit, coalesce({prefix}author, 'Unknown Author') AS author,
      'https://www.reddit.com/r/' || coalesce(split_part({p}, '/', 3), {prefix}subreddit) || '/comments/' || coalesce(split_part({p}, '/', 5), {post}) || '/' AS thread_url,
      'https://www.reddit.com/r/' || coalesce(split_part({p}, '/', 3), {prefix}subreddit) || '/comments/' || coalesce(split_part({p}, '/', 5), {post}) || '/comment/' || {prefix}id || '/' AS comment_url,
      coalesce({date_sql(prefix + 'retrieved_on')}, {date_sql(prefix + 'retrieved_utc')}, '{FALLBACK}') AS download_date"""


RENDER_SQL = r"replace({}, chr(10), '<lb/>')".format(xml_sql(r"translate(regexp_replace(replace(replace(body, '&gt;', '>'), '&amp;', '&'), '/u/(\w+)', '\1', 'g'), chr(28) || chr(30), '  ')"))
THREADS_SQL = f"""{EXTRACTED_SQL}, threads AS (
  SELECT source, replace(link_id, 't3_', '') AS thread_id, count(*) AS n_comments, arg_max({{'id': id, 'author': author, 'created_utc': created_utc, 'subreddit': subreddit, 'permalink': permalink, 'retrieved_on': retrieved_on, 'retrieved_utc': retrieved_utc}}, ord) AS info
  FROM extracted GROUP BY 1, 2
), meta AS (
  SELECT source, thread_id, n_comments, {meta_sql('info.', 'thread_id')} FROM threads
)"""


def header_sql(grouped: bool) -> str:
    """The header as SQL text, from a pattern with {names}."""
    pattern = """  <teiHeader>
    <fileDesc>
      <titleStmt>
        <title type="main">{title}</title>
      </titleStmt>
      <publicationStmt>
        <p/>
      </publicationStmt>
      <sourceDesc>
        <bibl>Reddit/{subreddit}: {title}, {date}</bibl>
        <biblFull>
          <titleStmt>
"""
    pattern += """            <title type="main">Reddit/{subreddit}</title>
          </titleStmt>
          <publicationStmt>
            <publisher/>
            <ptr type="URL" target="{thread_url}"/>
            <date type="last_comment">{date}</date>
          </publicationStmt>
""" if grouped else """            <title type="main" level="a">{title}</title>
            <author>{author}</author>
          </titleStmt>
          <publicationStmt>
            <publisher/>
            <ptr type="thread" target="{thread_url}"/>
            <ptr type="comment" target="{comment_url}"/>
            <date>{date}</date>
          </publicationStmt>
          <seriesStmt>
            <title type="main" level="m">Reddit</title>
            <title type="sub" level="m">{subreddit}</title>
          </seriesStmt>
"""
    pattern += """        </biblFull>
      </sourceDesc>
    </fileDesc>
    <profileDesc>
      <creation>
        <date type="download">{download_date}</date>
      </creation>
    </profileDesc>
  </teiHeader>
"""
    for name in threads.META:
        pattern = pattern.replace("{" + name + "}", f"' || {xml_sql(name)} || '")
    return f"'{pattern}'"


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


def work(spark: SparkSession, what: str) -> str:
    """A folder for what a query writes and reads back."""
    folder = shared_dir(spark, what)
    target = spark._jvm.org.apache.hadoop.fs.Path(folder)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(target)
    remove_at_exit(spark, folder)
    return folder


def bots(spark: SparkSession) -> DataFrame:
    return readers.names(spark, BOTS)


def tagged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return comments.tag(comment_view(spark, sf_dir), bots(spark))


def extracted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return threads.first_of_id(threads.extract(comments.kept(tagged(spark, sf_dir))))


def change(name: str, function: Callable[[Column], Column], sql: Callable[[str], str]) -> None:
    """A query of one text function over all comments."""
    QUERIES[name] = lambda spark, sf_dir: comment_view(spark, sf_dir).select("ord", "id", function(F.col("body")).alias("body"))
    ORACLES[name] = f"WITH {VIEW_SQL} SELECT ord, id, {sql('body')} AS body FROM comments"


def flag(name: str, function: Callable[[Column], Column], sql: Callable[[str], str]) -> None:
    """A query of the comments that pass one filter."""
    QUERIES[name] = lambda spark, sf_dir: comment_view(spark, sf_dir).where(~function(F.col("body"))).select("ord", "id", "body")
    ORACLES[name] = f"WITH {VIEW_SQL} SELECT ord, id, body FROM comments WHERE NOT ({sql('body')})"


change("html_quote_strip", X.escaped_quotes, escaped_sql)
change("modern_quote_strip", X.modern_quotes, modern_sql)
change("plain_url_replace", X.plain_urls, plain_sql)
change("markdown_url_replace", X.markdown_urls, markdown_sql)
change("zero_width_strip", X.zero_width_marks, lambda x: ZERO_SQL.format(x=x))
change("newline_collapse", X.newlines, newlines_sql)
change("inline_format_strip", X.inline_formatting, inline_sql)
change("mention_strip", X.mentions, lambda x: rf"regexp_replace({x}, '/u/(\w+)', '\1', 'g')")
change("xml_escape", X.xml_text, xml_sql)
change("line_break_markup", lambda c: X.line_breaks(X.xml_text(X.separators(c))), lambda x: f"replace({xml_sql(f'translate({x}, chr(28) || chr(30), repeat(chr(32), 2))')}, chr(10), '<lb/>')")
change("author_lower_strip", lambda c: X.py_strip(F.lower(c)), lambda x: strip_sql(f"lower({x})"))
flag("deleted_filter", lambda c: X.py_strip(c).isin(*X.DELETED), lambda x: f"{strip_sql(x)} IN {DELETED_SQL}")
flag("url_only_filter", lambda c: X.is_only_url(X.py_strip(c)), lambda x: f"regexp_full_match({strip_sql(x)}, '(?i){URL_SQL}')")
flag("remindme_filter", X.is_reminder, lambda x: f"regexp_matches({x}, {REMIND_SQL})")
flag("empty_filter", X.is_blank, lambda x: f"{strip_sql(x)} = ''")


@query(f"WITH {VIEW_SQL} SELECT ord, id, author FROM comments WHERE author IS NULL OR lower(author) NOT IN {BOTS_SQL}")
def bot_anti_join(spark, sf_dir):
    return comments.without_bots(comment_view(spark, sf_dir), bots(spark)).select("ord", "id", "author")


@query(f"WITH {VIEW_SQL} SELECT ord, id, {urls_sql('body')} AS n_urls FROM comments")
def url_counts(spark, sf_dir):
    body = F.col("body")
    return comment_view(spark, sf_dir).select("ord", "id", (X.count_plain_urls(body) + X.count_markdown_urls(body)).cast("long").alias("n_urls"))


@query(f"WITH {TAGGED_SQL} SELECT ord, id, body FROM tagged WHERE drop_reason = 'url_marks'")
def url_placeholder_drop(spark, sf_dir):
    return tagged(spark, sf_dir).where("drop_reason = 'url_marks'").select("ord", "id", "body")


@query(f"WITH {TAGGED_SQL} SELECT ord, id, quote_changed, body FROM tagged WHERE drop_reason IS NULL")
def quote_change_rule(spark, sf_dir):
    return tagged(spark, sf_dir).where("drop_reason is null").select("ord", "id", "quote_changed", "body")


@query(f"WITH {TAGGED_SQL} SELECT coalesce(drop_reason, 'kept') AS drop_reason, count(*) AS n FROM tagged GROUP BY 1")
def drop_reason_counts(spark, sf_dir):
    return tagged(spark, sf_dir).groupBy(F.coalesce("drop_reason", F.lit("kept")).alias("drop_reason")).agg(F.count(F.lit(1)).alias("n"))


COUNTERS_SQL = "count(*) FILTER (drop_reason = 'bot') AS bots, count(*) FILTER (drop_reason = 'deleted') AS deleted, count(*) FILTER (quote_changed) AS quotes, count(*) FILTER (drop_reason = 'reminder') AS reminders, coalesce(sum(urls_removed), 0)::BIGINT AS urls, count(*) FILTER (drop_reason = 'url_only') AS url_only"


@query(f"WITH {TAGGED_SQL} SELECT {COUNTERS_SQL} FROM tagged")
def filter_counters(spark, sf_dir):
    return comments.counters(tagged(spark, sf_dir))


@query(f"WITH {TAGGED_SQL} SELECT lower(author) AS author, count(*) AS n FROM tagged WHERE drop_reason = 'bot' GROUP BY 1")
def bot_author_counts(spark, sf_dir):
    return comments.bot_counts(tagged(spark, sf_dir))


@query(f"""WITH {TAGGED_SQL}
SELECT id, 'contained quotation' AS tag, original, body AS modified FROM tagged WHERE quote_changed AND (drop_reason IS NULL OR drop_reason = 'empty')
UNION ALL SELECT id, 'URL (any type)', original, body FROM tagged WHERE url_changed AND (drop_reason IS NULL OR drop_reason = 'empty')
UNION ALL SELECT id, CASE drop_reason WHEN 'deleted' THEN 'deleted/removed' WHEN 'url_only' THEN 'removed due to being only a URL' WHEN 'url_marks' THEN 'only [URL] placeholders'
  WHEN 'reminder' THEN '!remindme' ELSE 'empty or whitespace only' END, CASE drop_reason WHEN 'reminder' THEN body_before ELSE original END, NULL FROM tagged WHERE drop_reason <> 'bot'""")
def audit_log(spark, sf_dir):
    return comments.audit(tagged(spark, sf_dir))


@query(f"WITH {VIEW_SQL} SELECT ord, id, link_id FROM comments WHERE starts_with(link_id, 't3_')")
def t3_filter(spark, sf_dir):
    return threads.extract(comment_view(spark, sf_dir)).select("ord", "id", "link_id")


@query(f"WITH {VIEW_SQL} SELECT ord, id, link_id FROM comments WHERE link_id = 't3_p5'")
def link_filter(spark, sf_dir):
    return threads.extract(comment_view(spark, sf_dir), "p5").select("ord", "id", "link_id")


@query(f"WITH {VIEW_SQL} SELECT ord, id, body FROM comments QUALIFY row_number() OVER (PARTITION BY source, id ORDER BY ord) = 1")
def dedupe_keep_first(spark, sf_dir):
    return threads.first_of_id(comment_view(spark, sf_dir)).select("ord", "id", "body")


@query(f"WITH {VIEW_SQL} SELECT ord, id, 'id,link_id,quarantined' AS fields FROM comments")
def field_prune(spark, sf_dir):
    rows = comment_view(spark, sf_dir)
    value = F.to_json(F.struct("id", F.lit(1).alias("score"), "link_id", F.lit(False).alias("quarantined"), F.array().cast("array<string>").alias("awarders"), F.lit("x").alias("parent_id")))
    fields = threads.prune(F.from_json(value, "map<string,string>"))
    return rows.select("ord", "id", F.array_join(F.array_sort(F.map_keys(fields)), ",").alias("fields"))


@query(f"WITH {EXTRACTED_SQL} SELECT replace(link_id, 't3_', '') AS thread_id, count(*) AS n_comments, string_agg(id, ',' ORDER BY ord) AS ids FROM extracted GROUP BY 1")
def thread_group(spark, sf_dir):
    found = threads.threads(extracted(spark, sf_dir), FALLBACK)
    return found.select("thread_id", "n_comments", F.array_join(F.transform("comments", lambda c: c["id"]), ",").alias("ids"))


@query(f"WITH {THREADS_SQL} SELECT * EXCLUDE (source) FROM meta")
def thread_last_meta(spark, sf_dir):
    return threads.threads(extracted(spark, sf_dir), FALLBACK).drop("source", "comments")


@query(f"WITH {VIEW_SQL} SELECT ord, id, split_part(permalink, '/', 3) AS subreddit, split_part(permalink, '/', 5) AS post_id, split_part(permalink, '/', 6) AS title FROM comments WHERE permalink IS NOT NULL")
def permalink_parse(spark, sf_dir):
    found = threads.single_comments(comment_view(spark, sf_dir).where("permalink is not null"), FALLBACK)
    return found.select("ord", F.col("comment_id").alias("id"), "subreddit", "post_id", "title")


@query(f"WITH {VIEW_SQL} SELECT ord, id, {date_sql('created_utc')} AS date FROM comments")
def utc_dates(spark, sf_dir):
    return comment_view(spark, sf_dir).select("ord", "id", X.utc_date(F.col("created_utc")).alias("date"))


@query(f"WITH {VIEW_SQL} SELECT ord, id, coalesce({date_sql('retrieved_on')}, {date_sql('retrieved_utc')}, '{FALLBACK}') AS download_date FROM comments")
def download_date_coalesce(spark, sf_dir):
    return threads.single_comments(comment_view(spark, sf_dir), FALLBACK).select("ord", F.col("comment_id").alias("id"), "download_date")


@query(f"WITH {THREADS_SQL} SELECT thread_id, {header_sql(True)} AS header FROM meta")
def tei_grouped_header(spark, sf_dir):
    return threads.threads(extracted(spark, sf_dir), FALLBACK).select("thread_id", tei.header(True).alias("header"))


@query(f"""WITH {THREADS_SQL}, items AS (
  SELECT m.thread_id, count(*) AS n_items, string_agg('          <item source="' || m.thread_url || 'comment/' || e.id || '/">' || {RENDER_SQL.replace('body', 'e.body')} || '<date>' || {date_sql('e.created_utc')} || '</date> <name>' || coalesce({xml_sql('e.author')}, '') || '</name> </item>' || chr(10), '' ORDER BY e.ord) AS items
  FROM meta m JOIN extracted e ON replace(e.link_id, 't3_', '') = m.thread_id WHERE e.body <> '[deleted]' GROUP BY 1
) SELECT post_id || '.xml' AS file_name, '{tei.START}' || {header_sql(True)} || '  <text>
    <body>
      <div type="comments">
        <list>
' || items || '        </list>
      </div>
    </body>
  </text>
{tei.END}' AS tei, n_items, true AS xml_ok FROM meta JOIN items USING (thread_id)""")
def tei_grouped(spark, sf_dir):
    return tei.grouped(threads.threads(tei.prepared(extracted(spark, sf_dir)), FALLBACK)).drop("xml_error")


@query(f"WITH {VIEW_SQL} SELECT replace(link_id, 't3_', '') || '.xml' AS file_name, count(*) AS n_items FROM (SELECT * FROM comments WHERE starts_with(link_id, 't3_') QUALIFY row_number() OVER (PARTITION BY source, id ORDER BY ord) = 1) WHERE body <> '[deleted]' GROUP BY 1")
def tei_skips_deleted(spark, sf_dir):
    """Documents of comments that were not cleaned: deleted ones are left out when documents are made."""
    rows = threads.first_of_id(threads.extract(comment_view(spark, sf_dir)))
    return pipeline.documents_of(rows, fallback_date=FALLBACK).select("file_name", "n_items")


@query(f"""WITH {EXTRACTED_SQL}, singles AS (
  SELECT replace(x.link_id, 't3_', '') AS thread_id, x.id AS comment_id, x.body AS body, {meta_sql('x.', "replace(x.link_id, 't3_', '')")} FROM extracted x
) SELECT thread_id || '_' || comment_id || '.xml' AS file_name, '{tei.START}' || {header_sql(False)} || '  <text>
    <body>
      <p>' || {RENDER_SQL} || '</p>
    </body>
  </text>
{tei.END}' AS tei, 1 AS n_items, true AS xml_ok FROM singles WHERE body <> '[deleted]'""")
def tei_nogroup(spark, sf_dir):
    return tei.single(threads.single_comments(extracted(spark, sf_dir), FALLBACK)).drop("xml_error")


@query(f"WITH {EXTRACTED_SQL} SELECT id, lpad(((row_number() OVER (ORDER BY md5(id), id) - 1) // 100 + 1)::VARCHAR, 5, '0') AS shard FROM extracted")
def shard_assign(spark, sf_dir):
    return threads.with_shard(extracted(spark, sf_dir).select("id"), "id", 100)


@query(f"WITH {EXTRACTED_SQL} SELECT f.n AS filtered_n, e.n AS emitted_n, f.n = e.n AS matches FROM (SELECT count(*) AS n FROM tagged WHERE drop_reason IS NULL) f, (SELECT count(*) AS n FROM extracted) e")
def count_reconcile(spark, sf_dir):
    kept = stored(comments.kept(tagged(spark, sf_dir)).select("source", "ord", "id", "link_id"), "kept")  # cleaned once, counted twice
    return threads.reconcile(kept, threads.first_of_id(threads.extract(kept)))


@query(f"WITH {TAGGED_SQL} SELECT ord, id, link_id, author, body, created_utc::BIGINT AS created, subreddit, permalink FROM tagged WHERE drop_reason IS NULL")
def full_clean(spark, sf_dir):
    return comments.kept(tagged(spark, sf_dir)).select("ord", "id", "link_id", "author", "body", X.epoch_seconds(F.col("created_utc")).alias("created"), "subreddit", "permalink")


@query(f"WITH {EXTRACTED_SQL} SELECT replace(link_id, 't3_', '') || '_' || id || '.json' AS file_name, id, body FROM extracted")
def comment_json(spark, sf_dir):
    made = threads.comment_json(extracted(spark, sf_dir), COMMENT_FIELDS)
    back = F.get(F.from_json("json", "array<struct<id: string, body: string>>"), F.lit(0))
    return made.select("file_name", back["id"].alias("id"), back["body"].alias("body"))


@query(f"WITH {EXTRACTED_SQL} SELECT replace(link_id, 't3_', '') || '_flat.json' AS file_name, count(*) AS n, string_agg(body, '|' ORDER BY ord) AS bodies FROM extracted GROUP BY 1")
def thread_json(spark, sf_dir):
    made = threads.thread_json(extracted(spark, sf_dir), COMMENT_FIELDS)
    back = F.from_json("json", "array<struct<body: string>>")
    return made.select("file_name", F.size(back).cast("long").alias("n"), F.array_join(F.transform(back, lambda c: c["body"]), "|").alias("bodies"))


@query(f"WITH {VIEW_SQL} SELECT ord, id FROM comments WHERE ord % 4 <> 0")
def malformed_tolerance(spark, sf_dir):
    rows = comment_view(spark, sf_dir)
    line = F.to_json(F.struct("id", "body"))
    lines = rows.select("source", "ord", F.when(F.col("ord") % 4 == 0, F.concat(F.lit("{"), line)).otherwise(line).alias("value"))
    return readers.parsed(lines).where("not corrupt").select("ord", "id")


@query()
def unescape_control(spark, sf_dir):
    """Character references and unprintable characters over the pages' html; SQL has no such function."""
    ship_for_texts(spark)
    return spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", unescaped(F.col("html")).alias("text"))


@query(f"WITH {THREADS_SQL} SELECT DISTINCT m.post_id || '.xml' AS file_name, true AS valid, NULL::VARCHAR AS error FROM meta m JOIN extracted e ON replace(e.link_id, 't3_', '') = m.thread_id WHERE e.body <> '[deleted]'")
def validate_documents(spark, sf_dir):
    return validate.validate(tei_grouped(spark, sf_dir))


@query(f"WITH {TAGGED_SQL} SELECT ord, id, body FROM tagged WHERE drop_reason IS NULL")
def stream_clean(spark, sf_dir):
    """The cleaning stage as a stream that takes what there is, batch by batch."""
    folder = work(spark, "stream")
    rows = comment_view(spark, sf_dir)
    rows.write.parquet(f"{folder}/in")
    files = len(spark.read.schema(rows.schema).parquet(f"{folder}/in").inputFiles())
    # three batches: of a fixed number of files, more cores would wait and more input make more batches
    stream = streaming.read_stream(spark, f"{folder}/in", rows.schema, files_per_batch=max(1, -(-files // 3)))
    streaming.run_available(streaming.clean(stream, bots(spark)), f"{folder}/out", f"{folder}/log")
    return spark.read.parquet(f"{folder}/out").select("ord", "id", "body")


@query("SELECT unnest(" + str(sorted(DROPPED_FIELDS)).replace('"', "'") + ") AS field")
def dropped_fields(spark, sf_dir):
    """The fields that pruning removes, one a row."""
    kept = threads.prune(F.map_from_arrays(F.array(*(F.lit(f) for f in [*DROPPED_FIELDS, "id"])), F.array(*(F.lit(1) for _ in [*DROPPED_FIELDS, "id"]))))
    everything = F.array(*(F.lit(f) for f in [*DROPPED_FIELDS, "id"]))
    return spark.range(1).select(F.explode(F.array_except(everything, F.map_keys(kept))).alias("field"))


# ---- sources and sinks: written, read back, and held against the rows they were made of ----


def written_archive(spark: SparkSession, sf_dir: str) -> str:
    """An archive of all comments: zstd NDJSON."""
    folder = work(spark, "archive")
    writers.write_archive(comment_view(spark, sf_dir), folder, list(COMMENT_FIELDS))
    return folder


@query(f"WITH {VIEW_SQL} SELECT id, body, count(*) AS n FROM comments GROUP BY ALL")
def archive_scan(spark, sf_dir):
    """What was written as archive, read as such; places in files are unique."""
    rows = readers.read_archive(spark, written_archive(spark, sf_dir))
    return rows.groupBy("id", "body").agg(F.count_distinct("source", "ord").alias("n"))


@query(f"WITH {VIEW_SQL} SELECT id, count(*) AS n FROM comments GROUP BY 1")
def long_window_scan(spark, sf_dir):
    return readers.read_archive(spark, f"{written_archive(spark, sf_dir)}/*.zst", long_window=True).groupBy("id").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT doc_id, source AS community FROM documents")
def archive_community(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return readers.community(docs.select("doc_id", F.concat(F.lit("file:/archives/x.y/"), "source", F.lit("_comments.zst")).alias("source"))).select("doc_id", "community")


@query(f"WITH {VIEW_SQL} SELECT '{{broken ' || id AS value FROM comments WHERE ord % 4 = 0")
def quarantine_scan(spark, sf_dir):
    """Lines that are no JSON object, without the blank ones, of a written text archive."""
    folder = work(spark, "lines")
    line = F.to_json(F.struct("id", "body"))
    value = F.when(F.col("ord") % 4 == 0, F.concat(F.lit("{broken "), "id")).when(F.col("ord") % 4 == 1, F.lit(" \t\x1c ")).otherwise(line)
    comment_view(spark, sf_dir).select(value.alias("value")).write.mode("overwrite").option("compression", "gzip").text(folder)
    return readers.quarantine(spark, folder).select("value")


@query("SELECT DISTINCT lower(source) AS name FROM documents WHERE source IS NOT NULL")
def bot_list_scan(spark, sf_dir):
    """A list of names with repeats, blanks, white space and capitals, written and read."""
    folder = work(spark, "names")
    name = F.col("source")
    listed = F.explode(F.array(F.upper(name), F.concat(F.lit(" \t"), name, F.lit(" \x1c")), F.lit("   "), F.lit("")))
    spark.read.parquet(f"{sf_dir}/documents.parquet").select(listed.alias("value")).where("value is not null").write.mode("overwrite").text(folder)
    return readers.read_names(spark, folder)


def written_json(spark: SparkSession, sf_dir: str, grouped: bool) -> str:
    folder = work(spark, "json")
    rows = extracted(spark, sf_dir)
    writers.write_files((threads.thread_json if grouped else threads.comment_json)(rows, COMMENT_FIELDS), folder, "json", per_shard=100)
    return folder


@query(f"WITH {EXTRACTED_SQL} SELECT replace(link_id, 't3_', '') || '_flat.json' AS file_name, replace(link_id, 't3_', '') AS file_link, id, body FROM extracted")
def json_scan(spark, sf_dir):
    """Thread files in numbered folders, read with these."""
    return readers.read_json_documents(spark, written_json(spark, sf_dir, True)).select("file_name", "file_link", "id", "body")


@query(f"WITH {EXTRACTED_SQL}, named AS (SELECT DISTINCT replace(link_id, 't3_', '') || '_flat.json' AS name FROM extracted) SELECT name AS file_name FROM named QUALIFY row_number() OVER (ORDER BY md5(name), name) <= 100")
def json_scan_flat(spark, sf_dir):
    """The files of one numbered folder; the folder above them has none of its own."""
    return readers.read_json_documents(spark, f"{written_json(spark, sf_dir, True)}/00001", recursive=False).select("file_name").distinct()


@query(f"WITH {EXTRACTED_SQL} SELECT replace(link_id, 't3_', '') AS file_link, id AS file_comment FROM extracted")
def file_name_keys(spark, sf_dir):
    return readers.read_json_documents(spark, written_json(spark, sf_dir, False)).select("file_link", "file_comment")


@query(f"WITH {THREADS_SQL} SELECT m.post_id || '.xml' AS file_name, count(*) AS n_items, true AS xml_ok FROM meta m JOIN extracted e ON replace(e.link_id, 't3_', '') = m.thread_id WHERE e.body <> '[deleted]' GROUP BY m.thread_id, m.post_id")
def json_reentry(spark, sf_dir):
    """Documents made again from files of single comments: one a thread, none lost, whatever files its comments lie in."""
    docs = pipeline.run_json(spark, written_json(spark, sf_dir, False), True, FALLBACK)
    return docs.select("file_name", "n_items", "xml_ok")


@query(f"WITH {EXTRACTED_SQL} SELECT f.n AS filtered_n, e.n AS emitted_n, f.n = e.n AS matches FROM (SELECT count(*) AS n FROM tagged WHERE drop_reason IS NULL) f, (SELECT count(*) AS n FROM extracted) e")
def written_reconcile(spark, sf_dir):
    """Counts of what was written: the filtered archive, and the JSON files."""
    folder = work(spark, "filtered")
    kept = stored(comments.kept(tagged(spark, sf_dir)), "kept")
    writers.write_archive(kept, f"{folder}/archive", list(COMMENT_FIELDS))
    writers.write_files(threads.thread_json(threads.first_of_id(threads.extract(kept)), COMMENT_FIELDS), f"{folder}/json", "json")
    return pipeline.reconcile_written(spark, f"{folder}/archive", f"{folder}/json")


@query(f"WITH {THREADS_SQL} SELECT true AS valid, count(*) AS n FROM (SELECT DISTINCT m.post_id FROM meta m JOIN extracted e ON replace(e.link_id, 't3_', '') = m.thread_id WHERE e.body <> '[deleted]') GROUP BY 1 UNION ALL SELECT false, count(DISTINCT doc_id) FROM documents WHERE doc_id % 100 = 0")
def validate_written(spark, sf_dir):
    """The XML files below a folder: documents, broken files, and empty files, which don't count."""
    folder = work(spark, "xml")
    docs = tei_grouped(spark, sf_dir).select("file_name", "tei")
    broken = spark.read.parquet(f"{sf_dir}/documents.parquet").where("doc_id % 100 = 0").select("doc_id").distinct()
    name = lambda what: F.concat(F.lit(what), F.col("doc_id").cast("string"), F.lit(".xml"))
    docs = docs.unionByName(broken.select(name("broken").alias("file_name"), F.lit("<TEI>").alias("tei"))).unionByName(broken.select(name("empty").alias("file_name"), F.lit("").alias("tei")))
    writers.write_files(docs, folder, "tei", per_shard=50)
    return validate.validate_directory(spark, folder).groupBy("valid").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT doc_id, doc_id % 5 <> 1 AND doc_id % 5 <> 2 AND doc_id % 5 <> 3 AS valid FROM documents")
def validate_dtd(spark, sf_dir):
    """A DTD from a file, with entities, choices, enumerations and required attributes."""
    folder = work(spark, "dtd")
    lines = ['<!ENTITY % inline "b | i">', "<!ELEMENT doc (head, (para | list)+)>", "<!ELEMENT head (#PCDATA)>", "<!ELEMENT para (#PCDATA | %inline;)*>", "<!ELEMENT list (para+)>", "<!ELEMENT b (#PCDATA)>", "<!ELEMENT i (#PCDATA)>", '<!ATTLIST doc id CDATA #REQUIRED kind (a | z) "a">']
    spark.createDataFrame([("\n".join(lines),)], "value string").coalesce(1).write.mode("overwrite").text(folder)
    text = X.xml_text(F.regexp_replace("text", r"[\x00-\x08\x0b\x0c\x0e-\x1f\uFFFE\uFFFF]", " "))
    body = F.concat(F.lit('<doc id="1"><head>h</head><para>'), text, F.lit("<b>b</b></para></doc>"))
    case = F.col("doc_id") % 5
    made = F.when(case == 1, F.replace(body, F.lit(' id="1"'), F.lit(""))).when(case == 2, F.replace(body, F.lit("<head>h</head>"), F.lit(""))).when(case == 3, F.replace(body, F.lit('id="1"'), F.lit('id="1" kind="b"'))).otherwise(body)
    docs = spread(spark.read.parquet(f"{sf_dir}/documents.parquet")).select(F.col("doc_id").alias("file_name"), F.coalesce(made, F.lit("")).alias("tei"))
    return validate.validate(docs, dtd=validate.read_dtd(spark, folder)).select(F.col("file_name").alias("doc_id"), "valid")


#: Bodies and what decoding character references and removing unprintable characters makes of them.
GOLDEN = [
    ("a &amp;gt; b", "a > b"), ("&lt;i&gt; &quot;x&quot;", '<i> "x"'), ("caf&eacute; &#8364; &#x41;", "caf\u00e9 \u20ac A"), ("&amp;amp;", "&amp;"), ("zero\u200bwidth\u200djoin\u00adsoft\ufeff", "zerowidthjoinsoft"),
    ("tab\there\nand\u00a0there", "tab\there\nand\u00a0there"), ("bell\x07esc\x1b[0m\x7f\x90", "bellesc[0m"), ("kept\x1c\x0b\x85", "kept\x1c\x0b\x85"), ("private\ue000\U000f0000", "private"), ("no end &copy 2024 &nosuch;", "no end \u00a9 2024 &nosuch;"),
]


def _chars(text: str) -> str:
    """A text as SQL."""
    return "concat(" + ", ".join(f"chr({ord(c)})" for c in text) + ")"


@query("SELECT doc_id, CASE doc_id % 10 " + " ".join(f"WHEN {i} THEN {_chars(out)}" for i, (_, out) in enumerate(GOLDEN)) + " END || ' ' || doc_id AS text FROM documents")
def unescape_golden(spark, sf_dir):
    ship_for_texts(spark)
    body = F.element_at(F.array(*(F.lit(given) for given, _ in GOLDEN)), (F.col("doc_id") % 10 + 1).cast("int"))
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return docs.select("doc_id", unescaped(F.concat(body, F.lit(" "), F.col("doc_id").cast("string"))).alias("text"))


@query(f"WITH {VIEW_SQL} SELECT ord, id, {newlines_sql(ZERO_SQL.format(x='body'))} AS body FROM comments WHERE {strip_sql(newlines_sql(ZERO_SQL.format(x='body')))} <> ''")
def feature_flags_off(spark, sf_dir):
    """The cleaning stage with every removal switched off."""
    off = comments.Config(deleted=False, quotes=False, reminders=False, urls=False)
    return comments.kept(comments.tag(comment_view(spark, sf_dir), None, off)).select("ord", "id", "body")


@query(f"WITH {VIEW_SQL}, lines AS (SELECT ord, {inline_sql('to_json({id: id, body: body})')} AS line FROM comments) SELECT ord, line::JSON->>'$.body' AS body FROM lines WHERE json_valid(line)")
def raw_inline_strip(spark, sf_dir):
    """Inline marks stripped on raw lines, before they are parsed: a pair may reach over fields and break the line."""
    lines = comment_view(spark, sf_dir).select("source", "ord", F.to_json(F.struct("id", "body")).alias("value"))
    return readers.parsed(lines, raw_inline=True).where("not corrupt").select("ord", "body")


@query(f"WITH {EXTRACTED_SQL} SELECT replace(link_id, 't3_', '') || '_' || id || '.xml' AS name, lpad(((row_number() OVER (ORDER BY md5(replace(link_id, 't3_', '') || '_' || id || '.xml')) - 1) // 50 + 1)::VARCHAR, 5, '0') AS shard FROM extracted WHERE body <> '[deleted]'")
def written_files(spark, sf_dir):
    """Documents of single comments as files in numbered folders, listed from the folder."""
    folder = work(spark, "files")
    writers.write_files(tei_nogroup(spark, sf_dir), folder, "tei", per_shard=50)
    return listed(spark, folder).where("length > 0").select("name", F.element_at(F.split("path", "/"), -2).alias("shard"))
