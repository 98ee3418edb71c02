"""Records made from a template by rules over the new id's digits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import escape_xml
from .records import RECORD, element, serialise

FIRST_ID = 9000000120000001
# The fields of each rule.
CUSTOMER, CATEGORY, TITLE, CURRENCY, USER = ["c1"], ["c2", "c85"], ["c3", "c5"], ["c8", "c93", "c95"], ["c249", "c251"]
AMOUNT = ["c23", "c24", "c25", "c26", "c27", "c29", "c32", "c35", "c38", "c41", "c44", "c77", "c122", "c149"]
DATE = ["c28", "c31", "c34", "c37", "c40", "c43", "c46", "c47", "c48", "c49", "c50", "c78", "c79", "c121", "c167"]


def new_ids(spark: SparkSession, n: int, first: int = FIRST_ID) -> DataFrame:
    return spark.range(n).select((F.lit(first) + F.col("id")).cast("string").alias("recid"))


def currency_of(recid: Column) -> Column:
    last = F.substring(recid, -1, 1)
    return F.when(last == "1", "USD").when(last == "2", "EUR").when(last == "3", "GBP").otherwise("EGP")


def rule_values(recid: Column) -> list[tuple[list[str], Column]]:
    """For each rule its fields and the value that every occurrence gets."""
    six = F.substring(recid, 11, 6)
    two = lambda at: F.substring(recid, at, 2).cast("int")
    padded = lambda c: F.lpad(c.cast("string"), 2, "0")
    amount = ((six.cast("int") % 900000).cast("decimal(18,2)") / 100).cast("decimal(18,2)").cast("string")
    return [
        (CUSTOMER, F.concat(F.lit("90"), six)),
        (CATEGORY, F.concat(F.lit("65"), F.substring(recid, 15, 1), F.lit("0"))),
        (TITLE, F.concat(F.lit("Test account "), recid)),
        (CURRENCY, currency_of(recid)),
        (AMOUNT, amount),
        (DATE, F.concat(F.lit("2026"), padded(two(15) % 12 + 1), padded(two(13) % 28 + 1))),
        (USER, F.concat(F.lit("TEST_USER_"), six)),
    ]


def generate_records(spark: SparkSession, template: list[tuple[str, str | None, str | None]], n: int, first: int = FIRST_ID, existing: DataFrame | None = None) -> DataFrame:
    """n records with the elements (code, index, value) of the template; ids that exist already are skipped."""
    ids = new_ids(spark, n, first)
    if existing is not None:
        ids = ids.join(existing.select("recid"), "recid", "left_anti")
    recid, rules = F.col("recid"), rule_values(F.col("recid"))
    children = []
    for code, index, value in template:
        made = next((v for codes, v in rules if code in codes), F.lit(value).cast("string"))
        children.append(element(code, made, None if index is None else F.lit(index)))
    made = ids.select("recid", serialise(recid, *children).alias("xmlrecord"), currency_of(recid).alias("currency"))
    return made.select(*(c.split()[0] for c in RECORD.split(", ")))


_CDATA = r"(?:[^<]|<!\[CDATA\[.*?\]\]>)*"


def transform_documents(document: Column, recid: Column) -> Column:
    """Existing documents under new ids: the root's ``id`` is the new one, the elements of each rule get the rule's value, and everything
    else, also elements, attributes and comments that no rule knows, stays as it is."""
    literal = lambda c: F.regexp_replace(escape_xml(c), r"([\\$])", r"\\$1")
    out = F.regexp_replace(document, F.lit(r"""(<row\b[^>]*?\sid=)("[^"]*"|'[^']*')"""), F.concat(F.lit('$1"'), literal(recid), F.lit('"')))
    for codes, value in rule_values(recid):
        name = "|".join(codes)
        out = F.regexp_replace(out, F.lit(rf"(?s)<({name})(\s[^<>]*?)?/>"), F.lit("<$1$2></$1>"))
        out = F.regexp_replace(out, F.lit(rf"(?s)(<({name})(?:\s[^<>]*)?>){_CDATA}(</\2>)"), F.concat(F.lit("$1"), literal(value), F.lit("$3")))
    return out


def transformed_records(spark: SparkSession, document: str, n: int, first: int = FIRST_ID, existing: DataFrame | None = None) -> DataFrame:
    """n records made of one document by the rules; ids that exist already are skipped."""
    ids = new_ids(spark, n, first)
    if existing is not None:
        ids = ids.join(existing.select("recid"), "recid", "left_anti")
    recid = F.col("recid")
    return ids.select(recid, transform_documents(F.lit(document), recid).alias("xmlrecord"), currency_of(recid).alias("currency"))
