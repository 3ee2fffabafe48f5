"""Text functions against the known pairs and the edge cases of each rule."""

import pytest
from pyspark.sql import functions as F

from corpusloom.functions import text as X
from corpusloom.functions.python_text import clean

CASES = [
    (X.plain_urls, "http://example.io", "[URL]"),
    (X.plain_urls, "http://www.example.io", "[URL]"),
    (X.plain_urls, "text www.example.io text", "text [URL] text"),
    (X.plain_urls, "(see https://a.b/c?d=e).", "(see [URL])."),
    (X.plain_urls, "]www.a.example x", "]www.a.example x"),
    (X.plain_urls, "HTTP://A.B/ Www.c.d", "[URL] [URL]"),
    (X.plain_urls, "awww.b.c", "awww.b.c"),
    (X.markdown_urls, "[text](www.link.de)", "text"),
    (X.markdown_urls, "[www.example.com](www.link.de)", "[URL]"),
    (X.markdown_urls, "[www.example.com and more](http://link.de)", "[URL]"),
    (X.markdown_urls, "[text](no url)", "[text](no url)"),
    (X.markdown_urls, "[a](http://x)[b](http://y)", "a"),
    (X.markdown_urls, "[a](HTTP://x)", "[a](HTTP://x)"),
    (X.inline_formatting, "Als ~~Zugführer~~ Lokführer muss man", "Als  Lokführer muss man"),
    (X.inline_formatting, "Als **Zugführer** Lokführer muss man", "Als Zugführer Lokführer muss man"),
    (X.inline_formatting, "Als *Zugführer* Lokführer muss man", "Als Zugführer Lokführer muss man"),
    (X.inline_formatting, "Als **Zugführer* Lokführer muss man", "Als Zugführer* Lokführer muss man"),
    (X.inline_formatting, "Als *Zugführer* **Lokführer** muss man", "Als Zugführer Lokführer muss man"),
    (X.inline_formatting, "2*3*4 ****", "234 "),
    (X.inline_formatting, "* a * b", "* a * b"),
    (X.escaped_quotes, "&gt; a\nb\n&gt;c", "\nb"),
    (X.modern_quotes, "x\n> a\n>\nb", "x\nb"),
    (X.modern_quotes, ">!spoiler!< x\ny", "\ny"),
    (X.modern_quotes, ">\nx", ">\nx"),
    (X.zero_width_marks, "a&#x200B;b&amp;#x200B;c\\u200Bd​e", "abcd​e"),
    (X.newlines, "a\n \n\n  b", "a\n  b"),
    (X.mentions, "hi /u/Jürgen_1 u/x", "hi Jürgen_1 u/x"),
    (X.py_strip, " \x1c a ", "a"),
    (X.xml_text, "a<b>&\r", "a&lt;b&gt;&amp;&#13;"),
    (X.xml_attribute, '"<\n', "&quot;&lt;&#10;"),
    (X.separators, "a\x1cb\x1ec", "a b c"),
    (X.utc_date, "1688823816.0", "2023-07-08"),
    (X.utc_date, "1494143758", "2017-05-07"),
    (X.utc_date, "never", None),
]


def test_functions(spark):
    for function, given, wanted in CASES:
        got = spark.createDataFrame([(given,)], "x string").select(function(F.col("x"))).first()[0]
        assert got == wanted, (function.__name__, given, got)


@pytest.mark.parametrize(
    ("function", "yes", "no"),
    [
        (X.is_reminder, ["!remindme 2 days", "RemindMe!2days", "  !REMIND ME x"], ["RemindMe! 2 days", "x !remindme", ""]),
        (X.is_only_url, ["https://a.b/c", "WWW.a.b/"], ["https://a.b) ", "x https://a.b", "https://"]),
        (X.is_only_marks, ["[URL]", "[URL]!!\n[URL] ?"[:-1], "[URL]" * 20000], ["[URL] x", "", "[URL] ?"]),
        (X.is_blank, ["", " \n \x1d"], ["a", " . "]),
    ],
)
def test_filters(spark, function, yes, no):
    df = spark.createDataFrame([(s, True) for s in yes] + [(s, False) for s in no], "x string, wanted boolean")
    assert [r for r in df.select("x", "wanted", function(F.col("x")).alias("got")).collect() if r.got != r.wanted] == []


def test_long_quote_does_not_recurse(spark):
    df = spark.createDataFrame([("> x" + "\n> y" * 200_000,)], "x string")
    assert df.select(X.modern_quotes(F.col("x"))).first()[0] == ""


def test_python_cleaning():
    assert clean("&amp;gt; &lt;b&gt; a​b­c\x0b &eacute; ") == "> <b> abc\x0b é "
    assert clean(None) is None


def test_content_models_are_matched_in_linear_time():
    import time

    from corpusloom.operators import validate

    dtd = validate.Dtd("<!ELEMENT r ((a|b)*, c?)*><!ELEMENT s ((a, b?)+, (c | (a, c))?)><!ELEMENT a EMPTY><!ELEMENT b EMPTY><!ELEMENT c EMPTY><!ELEMENT d EMPTY>")
    began = time.time()
    assert validate.problem("<r>" + "<a/>" * 5000 + "<d/></r>", dtd)
    assert validate.problem("<r>" + "<a/><c/><b/>" * 2000 + "</r>", dtd) is None
    assert time.time() - began < 5
    assert validate.problem("<s><a/><b/><a/><c/></s>", dtd) is None and validate.problem("<s><b/></s>", dtd)
