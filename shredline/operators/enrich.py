"""Business names for attribute rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Rows of a catalogue that are broadcast; a larger one is shuffled.
BROADCAST_ROWS = 100_000


def enrich(rows: DataFrame, catalogue: DataFrame) -> DataFrame:
    """Left join on code and index where a missing index equals a missing index."""
    names = catalogue.select(F.col("field_index").alias("k"), F.col("multi_value_index").alias("i"), "field_name")
    if names.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS:
        names = F.broadcast(names)
    met = (F.col("field_index") == F.col("k")) & F.col("multi_value_index").eqNullSafe(F.col("i"))
    return rows.join(names, met, "left").select("recid", "currency", "field_index", "multi_value_index", "field_name", "field_value", "ingested_at")


def create_view(rows: DataFrame, catalogue: DataFrame, name: str) -> None:
    enrich(rows, catalogue).createOrReplaceTempView(name)
