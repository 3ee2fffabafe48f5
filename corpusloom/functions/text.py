"""Text functions of the cleaning stage, Column to Column and on the JVM throughout.

Patterns carry ``U`` (Unicode classes) and ``d`` (only ``\\n`` ends a line). ``SPACE`` adds the four
separators that Python counts as white space and the JVM does not. Repeated groups are possessive,
as the JVM would recurse on them otherwise.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

SPACE = r"[\s\x1c-\x1f]"
#: Private-use marks around link texts while links are rewritten.
OPEN, CLOSE = "\ue000", "\ue001"
#: What counts as a URL, bare and in a markdown link, and the marks that stand for nothing.
PLAIN_URL = r"(?:https?://|www\.)\S*\w/?"
MARKDOWN_URL = r"\[([^\]]+)\]\((?:https?://|www\.)\S+\)"
ZERO_WIDTH = r"&amp;#x200B;|&#x200B;|\\u200B"
URL_MARK = "[URL]"
#: Bodies that stand for a deleted comment.
DELETED = ("[removed]", "[deleted]", "[removed by reddit]")


def _where(found: Column, changed: Column, c: Column) -> Column:
    """The changed text where a cheap look finds what the change is about, else the text as it is: most texts have none of it, and patterns and translations cost many times the look."""
    return F.when(found, changed).otherwise(c)


def _holds(c: Column, *parts: str) -> Column:
    return reduce(Column.__or__, (F.contains(c, F.lit(p)) for p in parts))


def py_strip(c: Column) -> Column:
    """White space off both ends, by the Unicode definition."""
    ends = F.concat(F.left(c, F.lit(1)), F.right(c, F.lit(1)))
    return _where(ends.rlike(rf"(?U){SPACE}"), F.regexp_replace(c, rf"(?U)^{SPACE}++|{SPACE}++\z", ""), c)


def is_blank(c: Column) -> Column:
    return ~c.rlike(r"(?U)[^\s\x1c-\x1f]")


def plain_urls(c: Column) -> Column:
    """Bare URLs to ``[URL]``, unless a ``]`` comes right before."""
    return _where(c.rlike(r"://|[wW]{3}\."), F.regexp_replace(c, rf"(?iUd)(^|[^\]\w]){PLAIN_URL}", "$1[URL]"), c)


def count_plain_urls(c: Column) -> Column:
    return F.regexp_count(c, F.lit(rf"(?iUd)(?:^|[^\]\w]){PLAIN_URL}"))


def markdown_urls(c: Column) -> Column:
    """``[text](url)`` to its text, or to ``[URL]`` where the text begins with a URL itself.

    One pass finds the links and puts marks around their texts, so links that a greedy target swallows stay swallowed.
    """
    bare = F.translate(c, OPEN + CLOSE, "")
    marked = F.regexp_replace(bare, rf"(?Ud){MARKDOWN_URL}", f"{OPEN}$1{CLOSE}")
    named = F.regexp_replace(marked, rf"(?iUd){OPEN}(?:https?://|www\.)[^\s{CLOSE}]*\w[^{CLOSE}]*{CLOSE}", URL_MARK)
    return _where(_holds(c, "](", OPEN, CLOSE), F.translate(named, OPEN + CLOSE, ""), c)


def count_markdown_urls(c: Column) -> Column:
    return F.regexp_count(c, F.lit(rf"(?Ud){MARKDOWN_URL}"))


def is_only_url(c: Column) -> Column:
    return c.rlike(rf"(?iUd)\A{PLAIN_URL}\z")


def is_only_marks(c: Column) -> Column:
    """Nothing but URL marks with ``!``, ``?``, ``.`` and white space behind them."""
    return c.rlike(rf"(?U)\A(?:\[URL\][!?.]*+{SPACE}*+)++\z")


def inline_formatting(c: Column) -> Column:
    """Struck text goes; bold and italic marks go, their text stays."""
    struck = F.regexp_replace(c, r"(?Ud)~~.*?~~", "")
    bold = F.regexp_replace(struck, r"(?Ud)\*\*((?:\S(?:.*?\S)??)??)\*\*", "$1")
    return _where(_holds(c, "~~", "*"), F.regexp_replace(bold, r"(?Ud)\*((?:\S(?:.*?\S)??)??)\*", "$1"), c)


def escaped_quotes(c: Column) -> Column:
    return _where(_holds(c, "&gt;"), F.regexp_replace(c, r"(?:\n|\A)&gt;[^\n]*+", ""), c)


def modern_quotes(c: Column) -> Column:
    return _where(_holds(c, ">"), F.regexp_replace(c, r"(?:\n|\A)>[^\n]++(?:\n>[^\n]*+)*+", ""), c)


def is_reminder(c: Column) -> Column:
    """A call of the reminder bot; after the last mark a word has to begin at once."""
    return c.rlike(rf"(?iU)\A{SPACE}*+(?:!remindme|!remind me|remindme!|remind me!)\b")


def zero_width_marks(c: Column) -> Column:
    return _where(_holds(c, "200B"), F.regexp_replace(c, ZERO_WIDTH, ""), c)


def newlines(c: Column) -> Column:
    return _where(_holds(c, "\n"), F.regexp_replace(c, rf"(?U)\n{SPACE}*\n+", "\n"), c)


def mentions(c: Column) -> Column:
    return _where(_holds(c, "/u/"), F.regexp_replace(c, r"(?U)/u/(\w+)", "$1"), c)


def translated(c: Column, chars: str) -> Column:
    """Each of some characters to a space."""
    return _where(_holds(c, *chars), F.translate(c, chars, " " * len(chars)), c)


def separators(c: Column) -> Column:
    return translated(c, "\x1c\x1e\x00")


def xml_text(c: Column) -> Column:
    for a, b in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ("\r", "&#13;")):
        c = F.replace(c, F.lit(a), F.lit(b))
    return c


def xml_attribute(c: Column) -> Column:
    for a, b in (('"', "&quot;"), ("\n", "&#10;"), ("\t", "&#9;")):
        c = F.replace(xml_text(c) if a == '"' else c, F.lit(a), F.lit(b))
    return c


def line_breaks(c: Column) -> Column:
    """Line ends of text that is escaped already to ``<lb/>``."""
    return F.replace(c, F.lit("\n"), F.lit("<lb/>"))


def epoch_seconds(c: Column) -> Column:
    """Int, float or text epochs to whole seconds; null where it is none."""
    return F.coalesce(c.try_cast("bigint"), c.try_cast("double").try_cast("bigint"))


def utc_date(c: Column) -> Column:
    """Epoch to its UTC date as text, whatever the session's time zone."""
    days = F.floor(epoch_seconds(c) / 86400).cast("int")
    return F.date_format(F.date_add(F.lit("1970-01-01").cast("date"), days), "yyyy-MM-dd")
