"""XML records to attribute rows.

A record is simple when one pattern matches the whole of its text: a ``row`` element with one attribute at most, text with the five
named entities, and children with no more than an ``m`` attribute and such text. Simple records, which is nearly all, are cut into child
elements in the JVM, with any element names. The others (comments, CDATA, nested content, other attributes, empty-element tags,
numeric references, another root, malformed text) go through an Arrow function over a DOM that gives the same canonical elements,
so the plan has one scan, and Python receives nulls for records that need nothing of it. Malformed records give no rows;
``quarantined`` lists them."""

from __future__ import annotations

import xml.etree.ElementTree as ElementTree
from xml.sax.saxutils import escape

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import blank_to_null, try_compact_date, try_index

NAME_LENGTH, INDEX_LENGTH, VALUE_LENGTH = 16, 10, 4000
DATE_CODE = "c167"
_NAME = r"[A-Za-z_][\w.\-]*+"
_ENTITY = "&(?:lt|gt|amp|quot|apos);"
_TEXT = rf"(?:[^<&\x00-\x08\x0B-\x1F\uFFFE\uFFFF]++|{_ENTITY})*+"
_MARK = rf'"(?:[^<>&"\x00-\x1F\uFFFE\uFFFF]++|{_ENTITY})*+"'
_CHILD = rf"<({_NAME})(?: m={_MARK})?>{_TEXT}</\1>"
# possessive, so that a record of very many children needs no stack
_RECORD = rf"\A<row(?:\s++(?!xmlns[\s=]){_NAME}={_MARK})?+\s*+>(?:{_TEXT}{_CHILD})*+{_TEXT}</row>\s*+\z"


@F.pandas_udf(T.ArrayType(T.StringType()))
def _general(texts: pd.Series) -> pd.Series:
    """Canonical child elements by DOM; null for null, blank or malformed text, and none for another root."""

    def one(text: str | None) -> list | None:
        if text is None:
            return None
        try:
            root = ElementTree.fromstring(text)
        except ElementTree.ParseError:
            return None
        if root.tag != "row":
            return []
        marks = (f' m="{escape(e.get("m"), {chr(34): "&quot;"})}"' if e.get("m") else "" for e in root)
        return [f"<{e.tag}{m}>{escape(e.text or '')}</{e.tag}>" for e, m in zip(root, marks)]

    return texts.map(one)


def _elements(records: DataFrame) -> DataFrame:
    """recid, currency, xmlrecord and the record's child elements in canonical text."""
    xml = F.col("xmlrecord")
    # beyond its first character the root can not be taken for a child
    cut = records.select("recid", "currency", "xmlrecord", F.regexp_extract_all(F.substr(xml, F.lit(2)), F.lit(_CHILD), F.lit(0)).alias("children"))
    simple = xml.rlike(_RECORD) & ~xml.contains("]]>")
    flagged = cut.withColumn("simple", F.coalesce(simple, F.lit(False)))
    general = _general(F.when(~F.col("simple"), xml))
    return flagged.select("recid", "currency", "xmlrecord", F.when(F.col("simple"), F.col("children")).otherwise(general).alias("children"))


def _parts(element: Column) -> tuple[Column, Column, Column]:
    """Name, index text and value of a canonical element; empty text where the element has none."""

    def decoded(c: Column) -> Column:
        plain = c
        for a, b in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&apos;", "'"), ("&amp;", "&")):
            plain = F.replace(plain, F.lit(a), F.lit(b))
        return F.when(c.contains("&"), plain).otherwise(c)

    head = F.substring_index(element, ">", 1)
    name = F.substring_index(F.substr(head, F.lit(2)), " ", 1)
    index = F.substr(head, F.length(name) + 6, F.greatest(F.length(head) - F.length(name) - 6, F.lit(0)))
    value = F.substr(element, F.length(head) + 2, F.length(element) - F.length(head) - F.length(name) - 4)
    return name, decoded(index), decoded(value)


def _checked(c: Column, most: int, what: str, overlong: str) -> Column:
    if overlong == "truncate":
        return F.substring(c, 1, most)
    if overlong == "fail":
        return F.when(F.length(c) > most, F.raise_error(F.lit(f"{what} longer than {most}")).cast("string")).otherwise(c)
    return c


def shred(records: DataFrame, ingested_at: Column | None = None, overlong: str = "fail", with_date: bool = False) -> DataFrame:
    """One row per child element: recid, currency, field_index, multi_value_index, field_value, ingested_at.

    ``with_date`` adds the record's source_updated_date, from the first c167. ``overlong`` is ``fail``, ``truncate`` or
    ``keep`` for names, indices and values beyond their lengths. Null, malformed and childless records give no rows."""
    cut = _elements(records)
    if with_date:
        dates = F.expr(f"filter(children, e -> e LIKE '<{DATE_CODE}>%' OR e LIKE '<{DATE_CODE} %')")
        cut = cut.withColumn("source_updated_date", try_compact_date(_parts(F.get(dates, F.lit(0)))[2]))
    extra = ["source_updated_date"] if with_date else []
    # explode would add a filter that makes the children a second time, below
    rows = cut.select("recid", "currency", *extra, F.explode_outer("children").alias("element")).where(F.col("element").isNotNull())
    name, index, value = _parts(F.col("element"))
    return rows.select(
        "recid",
        "currency",
        _checked(name, NAME_LENGTH, "element name", overlong).alias("field_index"),
        try_index(_checked(index, INDEX_LENGTH, "index", overlong)).alias("multi_value_index"),
        blank_to_null(_checked(value, VALUE_LENGTH, "value", overlong)).alias("field_value"),
        *extra,
        (F.current_timestamp() if ingested_at is None else ingested_at).alias("ingested_at"),
    )


def quarantined(records: DataFrame) -> DataFrame:
    """recid, xmlrecord of the records that are not well-formed (null records are not)."""
    return _elements(records).where(F.col("children").isNull() & F.col("xmlrecord").isNotNull()).select("recid", "xmlrecord")


def first_value(xml: Column, code: str) -> Column:
    """The text of a field's first occurrence; null if there is none or it is empty."""
    return blank_to_null(F.xpath_string(xml, F.lit(f"/row/{code}[position()=1]")))


# Computed columns of the production extract, their field and type.
VIRTUAL = [
    ("category", "c2", "decimal(38,0)"), ("customer", "c1", "decimal(38,0)"), ("co_code", "c252", "string"), ("mnemonic", "c6", "string"),
    ("curr_no", "c248", "string"), ("posting_restrict", "c13", "string"), ("opening_date", "c78", "string"), ("int_no_booking", "c17", "string"),
]


def with_virtual_columns(records: DataFrame, columns: list[tuple[str, str, str]] = VIRTUAL) -> DataFrame:
    """The records with columns computed from first occurrences; unparsable numbers are null."""
    return records.select("*", *(first_value(F.col("xmlrecord"), code).try_cast(kind).alias(name) for name, code, kind in columns))
