"""Whole records: every field of a JSON object, of any shape, from scan to sink.

A record is a map of VARIANT values, so unknown, nested and mixed fields pass through unread. A variant keeps the value of a
number but not how it is written (1697128377.0 comes back as 1697128377), so numbers with a point or an exponent, and
integers beyond 18 digits, travel as marked strings and are written as they came. Fields are written in the order of their
names; of a repeated name the last value counts.
"""

from __future__ import annotations

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

#: Stands before the digits of a number that travels as a string; a private character of Unicode.
MARK = ""
#: From where the last match ended: whole strings, short integers and all else that is no number, then the number. Possessive, so it needs no stack.
NUMBERS = r'\G((?>[^"0-9-]++|"(?>[^"\\]++|\\.)*+"|-?[0-9]{1,18}+(?![0-9.eE]))*+)(-?[0-9]++(?:\.[0-9]++)?+(?:[eE][+-]?[0-9]++)?+)'
MARKED = f'"{MARK}([-+.0-9eE]++)"'


def keep_last_of_repeated(spark: SparkSession) -> None:
    """Records that repeat a name are read, as the session would refuse them otherwise."""
    spark.conf.set("spark.sql.variant.allowDuplicateKeys", "true")


def fields(line: Column) -> Column:
    """The fields of a line as ``map<string,variant>``; null if it is no JSON object."""
    return F.try_variant_get(F.try_parse_json(F.regexp_replace(line, NUMBERS, f'$1"{MARK}$2"')), "$", "map<string,variant>")


def text(record: Column, name: str) -> Column:
    """A field as text: strings and numbers as they are written, null for null, nested or missing ones."""
    value = F.try_variant_get(F.try_element_at(record, F.lit(name)), "$", "string")
    return F.when(value.rlike(f"^{MARK}[-+.0-9eE]+\\z"), F.substring(value, F.lit(2), F.length(value))).otherwise(value)


def with_text(record: Column, name: str, value: Column) -> Column:
    """The record with another text in a field."""
    return F.map_concat(F.map_filter(record, lambda k, _: k != name), F.create_map(F.lit(name), value.cast("variant")))


def to_json(record: Column) -> Column:
    return F.regexp_replace(F.to_json(record), MARKED, "$1")
