"""Column expressions shared by the operators. All stay in the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def blank_to_null(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def try_index(c: Column) -> Column:
    """A multi-value index from text: null for empty or unparsable text."""
    return blank_to_null(c).try_cast("int")


def try_compact_date(c: Column) -> Column:
    """A date from yyyyMMdd text: null for anything else."""
    return F.try_to_date(blank_to_null(c), "yyyyMMdd")


def utf8_from_hex(digits: str) -> Column:
    return F.decode(F.unhex(F.lit(digits)), "UTF-8")


def differs(a: Column, b: Column) -> Column:
    """SQL's IS DISTINCT FROM."""
    return ~a.eqNullSafe(b)


def index_key(c: Column) -> Column:
    """The index in a merge key: a missing one is -1, so it collides with a literal -1."""
    return F.coalesce(c, F.lit(-1))


def shown(values: Column) -> Column:
    """Text of an array that shows null elements; null for a null array."""
    return F.array_join(F.transform(values, lambda x: F.coalesce(x, F.lit("<null>"))), "|")


def escape_xml(c: Column) -> Column:
    for a, b in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
        c = F.replace(c, F.lit(a), F.lit(b))
    return c
