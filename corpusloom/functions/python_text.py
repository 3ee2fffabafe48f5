"""The one Python function: character references and unprintable characters follow Python's own tables."""

from __future__ import annotations

import html

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F


def clean(text: str | None) -> str | None:
    if text is None:
        return None
    text = html.unescape(text).replace("&gt;", ">") if "&" in text else text
    return text if text.isprintable() else "".join([c for c in text if c.isprintable() or c.isspace()])


def unescaped(c: Column) -> Column:
    """Character references decoded once, then what is neither printable nor white space removed."""

    @F.pandas_udf("string")
    def run(s: pd.Series) -> pd.Series:
        return s.map(clean)

    return run(c)
