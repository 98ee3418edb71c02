"""Rule-based updates of attribute values, folded into one projection."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import utf8_from_hex


@dataclass(frozen=True)
class Repair:
    """Where it applies and what the value becomes; later rules see what earlier ones wrote."""

    where: Column
    value: Column


def repair(rows: DataFrame, rules: list[Repair], column: str = "field_value") -> DataFrame:
    for rule in rules:
        rows = rows.withColumn(column, F.when(rule.where, rule.value).otherwise(F.col(column)))
    return rows


def default_repairs(title_hex: str, recid: str, name_hex: str) -> list[Repair]:
    """The two usual rules: the fourth c20 of every record, and the titles of one record. Values are hex of UTF-8."""
    return [
        Repair((F.col("field_index") == "c20") & (F.col("multi_value_index") == 4), utf8_from_hex(title_hex)),
        Repair((F.col("recid") == recid) & F.col("field_index").isin("c3", "c5"), utf8_from_hex(name_hex)),
    ]
