"""Checks XML documents against a DTD: well-formed, content models, attributes.

The DTD is read by the standard library's parser, parameter entities and external subsets in one
text included, on the driver; what goes to the executors is one pattern for each element. Without a
DTD of the caller, the one of the emitted elements (:data:`EMITTED`) holds.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache
from xml.etree import ElementTree
from xml.parsers import expat

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.functions.shipping import ship_for_texts

#: The elements that documents are made of, as narrow as they are emitted.
EMITTED = """
<!ELEMENT TEI (teiHeader, text)> <!ATTLIST TEI xmlns CDATA #FIXED "http://www.tei-c.org/ns/1.0">
<!ELEMENT teiHeader (fileDesc, profileDesc?)>
<!ELEMENT fileDesc (titleStmt, publicationStmt, sourceDesc)>
<!ELEMENT titleStmt (title+, author*)>
<!ELEMENT publicationStmt (p+ | (publisher, (ptr | date)*))>
<!ELEMENT sourceDesc (p | bibl | biblFull)+>
<!ELEMENT biblFull (titleStmt, publicationStmt, seriesStmt?)>
<!ELEMENT seriesStmt (title+)>
<!ELEMENT profileDesc (creation*)>
<!ELEMENT creation (#PCDATA | date)*>
<!ELEMENT text (body)>
<!ELEMENT body (div+ | p+)>
<!ELEMENT div (list+)> <!ATTLIST div type CDATA #IMPLIED>
<!ELEMENT list (item+)>
<!ELEMENT item (#PCDATA | lb | date | name)*> <!ATTLIST item source CDATA #IMPLIED>
<!ELEMENT p (#PCDATA | lb)*>
<!ELEMENT lb EMPTY>
<!ELEMENT ptr EMPTY> <!ATTLIST ptr type CDATA #IMPLIED target CDATA #REQUIRED>
<!ELEMENT publisher (#PCDATA)> <!ELEMENT author (#PCDATA)> <!ELEMENT name (#PCDATA)> <!ELEMENT bibl (#PCDATA)>
<!ELEMENT title (#PCDATA)> <!ATTLIST title type CDATA #IMPLIED level (a | m | j | s | u) #IMPLIED>
<!ELEMENT date (#PCDATA)> <!ATTLIST date type CDATA #IMPLIED>
"""
TEXT = "#"
#: Possessive, as models are deterministic (XML asks for it): a child fits in one way only, so nothing has to be tried again.
REPEATS = {expat.model.XML_CQUANT_NONE: "", expat.model.XML_CQUANT_OPT: "?+", expat.model.XML_CQUANT_REP: "*+", expat.model.XML_CQUANT_PLUS: "++"}


def _pattern(part: tuple) -> str:
    """A content model as a pattern over child names, each followed by a space."""
    kind, repeat, name, children = part
    if kind == expat.model.XML_CTYPE_NAME:
        inner = re.escape(name) + " "
    else:
        inner = ("|" if kind == expat.model.XML_CTYPE_CHOICE else "").join(map(_pattern, children))
    return f"(?:{inner}){REPEATS[repeat]}"


class Dtd:
    """``content``: for each element None (anything), or its pattern, with a leading mark where text is allowed; ``attributes``: by element."""

    def __init__(self, text: str):
        self.content: dict[str, str | None] = {}
        self.attributes: dict[str, dict[str, tuple[frozenset[str] | None, bool, str | None]]] = {}
        reader = expat.ParserCreate()
        reader.SetParamEntityParsing(expat.XML_PARAM_ENTITY_PARSING_ALWAYS)
        reader.UseForeignDTD(True)
        reader.ElementDeclHandler, reader.AttlistDeclHandler = self._element, self._attribute

        def subset(context, base, system, public) -> int:
            inner = reader.ExternalEntityParserCreate(context)
            inner.Parse(text if system is None else "", True)
            return 1

        reader.ExternalEntityRefHandler = subset
        reader.Parse("<x/>", True)

    def _element(self, name: str, model: tuple) -> None:
        kind = model[0]
        if kind == expat.model.XML_CTYPE_ANY:
            self.content[name] = None
        elif kind == expat.model.XML_CTYPE_MIXED:
            self.content[name] = TEXT + "(?:" + "|".join(re.escape(c[2]) + " " for c in model[3]) + ")*"
        else:
            self.content[name] = "" if kind == expat.model.XML_CTYPE_EMPTY else _pattern(model)

    def _attribute(self, element: str, name: str, kind: str, default: str | None, required: int) -> None:
        options = frozenset(x.strip() for x in kind.removeprefix("NOTATION")[1:-1].split("|")) if "(" in kind else None
        fixed = default if required and default is not None else None
        self.attributes.setdefault(element, {}).setdefault(name, (options, bool(required) and default is None, fixed))

    def problem(self, xml: str | bytes | None) -> str | None:
        """What is wrong with a document, or None."""
        if not xml:
            return "empty"
        try:
            root = ElementTree.fromstring(xml)
        except ElementTree.ParseError as e:
            return f"not well-formed: {e}"
        space = root.tag[: root.tag.find("}") + 1]
        wanted = self.attributes.get(root.tag.removeprefix(space), {}).get("xmlns", (None, False, None))[2]
        if wanted is not None and space != f"{{{wanted}}}":
            return f"the root isn't of the namespace {wanted}"
        for node in root.iter():
            name = node.tag.removeprefix(space)
            if name not in self.content or not node.tag.startswith(space):
                return f"element {node.tag} isn't declared"
            allowed = self.content[name]
            if allowed is not None:
                children = "".join(c.tag.removeprefix(space) + " " for c in node)
                if not re.fullmatch(allowed.removeprefix(TEXT), children):
                    return f"content of {name} doesn't follow its model: {children.strip() or 'nothing'}"
                if not allowed.startswith(TEXT) and any((t or "").strip() for t in (node.text, *(c.tail for c in node))):
                    return f"text in {name}"
            declared = {a.rpartition(":")[2]: v for a, v in self.attributes.get(name, {}).items()}
            given = {a.rpartition("}")[2]: v for a, v in node.attrib.items()}
            if extra := set(given) - set(declared):
                return f"attribute {min(extra)} of {name} isn't declared"
            for a, (options, required, fixed) in declared.items():
                if a not in given:
                    if required:
                        return f"attribute {a} of {name} is missing"
                elif options is not None and given[a] not in options or fixed is not None and given[a] != fixed:
                    return f"attribute {a} of {name} can't be {given[a]}"
        return None


@lru_cache(maxsize=4)
def emitted() -> Dtd:
    return Dtd(EMITTED)


def read_dtd(spark: SparkSession, path: str) -> Dtd:
    """A DTD from a file that Spark can read."""
    return Dtd(spark.read.text(path, wholetext=True).first()[0])


def problem(xml: str | bytes | None, dtd: Dtd | None = None) -> str | None:
    return (dtd or emitted()).problem(xml)


def validate(docs: DataFrame, name_col: str = "file_name", xml_col: str = "tei", dtd: Dtd | None = None) -> DataFrame:
    """(file_name, valid, error) of every document."""
    ship_for_texts(docs.sparkSession)
    dtd = dtd or emitted()
    held = dtd.content, dtd.attributes

    @F.pandas_udf("string")
    def check(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        own = Dtd.__new__(Dtd)
        own.content, own.attributes = held
        for s in parts:
            yield pd.Series([own.problem(x) for x in s], dtype=object)

    rows = docs.select(F.col(name_col).alias("file_name"), check(F.col(xml_col)).alias("error"))
    return rows.select("file_name", F.col("error").isNull().alias("valid"), "error")


def validate_directory(spark: SparkSession, path: str, dtd: Dtd | None = None) -> DataFrame:
    """Every non-empty XML file below ``path``, sub-directories included."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.xml").load(path)
    return validate(files.where("length > 0"), "path", "content", dtd)
