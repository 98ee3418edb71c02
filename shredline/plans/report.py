"""The published reports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def top_accounts(wide: DataFrame, columns: list[str], n: int = 10) -> DataFrame:
    return wide.select("recid", *columns).orderBy("recid").limit(n)


def account_detail(enriched: DataFrame, recid: str) -> DataFrame:
    """Attributes of a record by code, as text, and index, missing ones last."""
    return enriched.where(F.col("recid") == recid).orderBy("field_index", F.col("multi_value_index").asc_nulls_last())


def loaded_watermark(rows: DataFrame) -> DataFrame:
    return rows.agg(F.max("source_updated_date").alias("loaded_through"))


def row_count(rows: DataFrame) -> DataFrame:
    return rows.agg(F.count(F.lit(1)).alias("row_count"))
