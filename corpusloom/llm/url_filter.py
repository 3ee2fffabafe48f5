"""URL filter by a tree of path templates per host.

The path segments of a url become template parts: a segment that is a number, a hash, a date or a
mix of letters and digits becomes a wildcard of its class. A part whose parent has many different
children of few pages each becomes ``*`` as well. Sibling branches with labels whose share does not
differ from that of the other siblings (two-sided test of proportions, |z| below ``z``) are merged
into one branch, ``~``; branches that do differ stay apart, and those without any label are a branch
of their own, ``?``. A template is rejected when its share of blocked labels, smoothed towards the
share of its host and this towards that of all hosts, reaches ``purity``; one without labels has the
share of all hosts, as the labels of other branches say nothing about it.

Labels are the verdicts of the given rules, so every page under a rule teaches the template it
falls under. Pages are first counted by (host, template parts); the tree is grown on those counts
in rounds that follow its branchings, as deep as different paths share a template, and what is left of
a path that is alone is its own. Pages meet the tree again in one join. A host, node or template with a large part
of all rows is joined by broadcast (see :func:`~.common.join_hot`). DataFrame functions only.

Defined cases: a null url or one without ``://`` has an empty host and path, no rule and the
verdict of the empty host's template; very long and very deep urls are read whole; repeated rows are
judged alike; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import discard, join_hot, observed, stored

#: (verdict, host, path) of the fixed rules.
RULES = (("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"), ("allow", "com", "/fr/"), ("block", "com", "/de/"))
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: (pattern, wildcard): classes of variable segments, the first that fits counts.
CLASSES = ((r"^[0-9]+$", "{n}"), (r"^[0-9]+\.[A-Za-z]+$", "{n}.x"), (r"^[0-9]{4}-[0-9]{2}(-[0-9]{2})?$", "{date}"), (r"^[0-9A-Fa-f-]{16,}$", "{hex}"), (r"[0-9]", "{mix}"))


def split_url(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a url."""
    at = F.coalesce(F.locate("://", url), F.lit(0))
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), UPPER, LOWER)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return host, F.when(F.regexp_extract(rest, r"^[^/?#]*", 0) == rest, "").otherwise(path)


def rule_for(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest rule that fits, and its verdict; both null if none does."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for judged, rule_host, rule_path in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(rule_path)
        rule, verdict = F.when(fits, rule_host + rule_path).otherwise(rule), F.when(fits, judged).otherwise(verdict)
    return rule, verdict


def part(segment: Column) -> Column:
    out = segment
    for pattern, name in reversed(CLASSES):
        out = F.when(segment.rlike(pattern), name).otherwise(out)
    return out


def named(child: DataFrame, z: float, many: int, few: float) -> DataFrame:
    """From (host, t, seg, paths), the sums ``cn``, ``cs``, ``cb`` of pages, labels and blocked labels below each child, ``pn``, ``ps``, ``pb`` below its node, and ``kids``: host, t, seg, paths, name."""
    wild = (F.col("kids") > many) & (F.col("pn") < few * F.col("kids"))
    share = F.col("pb") / F.col("ps")
    spread = F.sqrt(share * (1 - share) * (1 / F.col("cs") + 1 / (F.col("ps") - F.col("cs"))))
    others = (F.col("pb") - F.col("cb")) / (F.col("ps") - F.col("cs"))
    differs = F.when((F.col("cs") == 0) | (F.col("ps") == F.col("cs")), False).when(spread == 0, False).otherwise(F.abs(F.col("cb") / F.col("cs") - others) >= z * spread)
    merged = F.when((F.col("cs") == 0) & (F.col("ps") > 0), "?").otherwise("~")
    name = F.when(F.col("seg") == "", "").when(wild, "*").when(differs, F.col("seg")).otherwise(merged)
    return child.select("host", "t", "seg", "paths", name.alias("name"))


def shared_parts(first: Column, last: Column) -> Column:
    """How many parts at the beginning all paths share that lie between these two in the order of arrays."""
    unlike = F.array_position(F.zip_with(first, last, lambda a, b: a.eqNullSafe(b)), False)
    return F.when(unlike > 0, unlike - 1).otherwise(F.size(first)).cast("int")


def grown(paths: DataFrame, z: float, many: int, few: float, total: int) -> DataFrame:
    """From (host, raw, n, seen, bad), ``total`` paths with their parts: with ``template``.

    A round takes the paths that still go on below their template (``t``, of ``at`` parts). What all paths of a template
    share next has one child at each level, so it is passed over in one step; only where they part are children counted and
    named. Rounds so follow the branchings of a tree, not its depth. A path that is alone below its template is closed as it is.
    """
    kept = ["host", "raw", "n", "seen", "bad"]
    left = lambda: F.slice("parts", F.col("at") + 1, F.size("parts"))
    level, done, used = paths.select(*kept, F.split("raw", "/").alias("parts"), F.lit("").alias("t"), F.lit(0).alias("at")), [], []
    going = total
    while going:
        nodes = level.groupBy("host", "t").agg(F.count(F.lit(1)).alias("going"), F.min(left()).alias("first"), F.max(left()).alias("last"))
        shared = F.slice("first", F.lit(1), shared_parts(F.col("first"), F.col("last")))
        jump = F.array_join(F.transform(shared, lambda s: F.when(s == "", "/").otherwise("/~")), "")
        nodes, seen = observed(nodes.select("host", "t", "going", jump.alias("jump"), F.size(shared).alias("far")), "nodes", most=F.max("going"))
        rows = join_hot(level, nodes, ["host", "t"], "going", total, seen["most"])
        alone, after = F.col("going") == 1, F.col("at") + F.col("far")
        rows = rows.select(*kept, "parts", F.when(alone, F.concat("t", F.lit("/"), F.array_join(left(), "/"))).otherwise(F.concat("t", "jump")).alias("t"), F.when(alone, F.size("parts")).otherwise(after).alias("at"))
        rows = rows.withColumn("seg", F.get("parts", F.col("at")))  # null where the path has ended
        child = rows.where("seg is not null").groupBy("host", "t", "seg").agg(F.sum("n").alias("cn"), F.sum("seen").alias("cs"), F.sum("bad").alias("cb"), F.count(F.lit(1)).alias("paths"))
        child, got = observed(child, "children", most=F.max("paths"))
        parents, above = observed(child.groupBy("host", "t").agg(F.count(F.lit(1)).alias("kids"), F.sum("cn").alias("pn"), F.sum("cs").alias("ps"), F.sum("cb").alias("pb")), "parents", most=F.max("kids"))
        names = named(join_hot(child, parents, ["host", "t"], "kids", total, above["most"] or 0), z, many, few)
        onward = join_hot(rows.where("seg is not null"), names, ["host", "t", "seg"], "paths", total, got["most"] or 0)
        step = onward.select(*kept, "parts", F.concat("t", F.lit("/"), "name").alias("t"), (F.col("at") + 1).alias("at")).unionByName(rows.where("seg is null").drop("seg"))
        ended = F.col("at") >= F.size("parts")
        step, left_over = observed(step, "paths", going=F.count_if(~ended))
        discard(nodes, child, parents)
        done.append(step.where(ended).select(*kept, F.col("t").alias("template")))
        level, going = step.where(~ended), left_over["going"]
        used.append(step)
    if not done:
        return level.select(*kept, F.col("t").alias("template"))
    tree = stored(reduce(DataFrame.unionByName, done), "templates")
    discard(*used)
    return tree


def judge(pages: DataFrame, rules=RULES, purity: float = 0.8, alpha: float = 4.0, z: float = 1.96, many: int = 16, few: float = 4.0, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """One row per page: page_id, host, path, rule, verdict, template, score (the smoothed share of blocked labels)."""
    url = F.col(url_col)
    host, path = split_url(url)
    rows = pages.select(F.col(id_col).alias("page_id"), host.alias("host"), path.alias("path"))
    rule, verdict = rule_for(F.col("host"), F.col("path"), rules)
    # a part has no slash in it, so the joined parts tell as much as the list
    raw = F.array_join(F.transform(F.split(F.regexp_replace("path", "^/", ""), "/"), part), "/")
    rows = stored(rows.withColumns({"rule": rule, "fixed": verdict, "raw": raw}), "urls")
    labelled, blocked = F.col("fixed").isNotNull(), F.col("fixed") == "block"
    paths = rows.groupBy("host", "raw").agg(F.count(F.lit(1)).alias("n"), F.count_if(labelled).alias("seen"), F.count_if(blocked).alias("bad"))
    paths, counted = observed(paths, "paths", rows=F.count(F.lit(1)), pages=F.sum("n"), most=F.max("n"))
    n_paths = counted["rows"]
    tree = grown(paths, z, many, few, n_paths)
    leaves, seen = observed(tree.groupBy("host", "template").agg(F.sum("seen").alias("seen"), F.sum("bad").alias("bad"), F.count(F.lit(1)).alias("paths")), "leaves", most=F.max("paths"))
    hosts = leaves.groupBy("host").agg(F.sum("seen").alias("hs"), F.sum("bad").alias("hb"), F.count(F.lit(1)).alias("templates"))
    whole = hosts.agg(F.coalesce(F.sum("hb") / F.nullif(F.sum("hs"), F.lit(0)), F.lit(0.0)).alias("base"))
    hosts = hosts.select("host", "hs", "hb", "templates", whole.scalar().alias("base")).withColumn("prior", (F.col("hb") + alpha * F.col("base")) / (F.col("hs") + alpha))
    leaves = join_hot(leaves, hosts, ["host"], "templates", n_paths)
    score = F.when(F.col("seen") == 0, F.col("base")).otherwise((F.col("bad") + alpha * F.col("prior")) / (F.col("seen") + alpha))
    leaves = stored(leaves.select("host", "template", "paths", score.alias("score")), "scores")
    scored = stored(join_hot(tree.select("host", "raw", "n", "template"), leaves, ["host", "template"], "paths", n_paths, seen["most"] or 0).drop("paths"), "scored")
    if counted["rows"]:
        discard(tree)
    discard(paths, leaves)
    return join_hot(rows, scored, ["host", "raw"], "n", counted["pages"] or 0, counted["most"] or 0).select(
        "page_id", "host", "path", "rule", F.coalesce("fixed", F.when(F.col("score") >= purity, "block").otherwise("allow")).alias("verdict"), "template", "score"
    )
