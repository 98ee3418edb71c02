"""Incremental loads from a stream of record files."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..plans.incremental import Load
from ..sources.records import RECORD


def start_loads(spark: SparkSession, load: Load, path: str, checkpoint: str, once: bool = False) -> StreamingQuery:
    """Loads every batch of new Parquet record files. A batch that is run again merges to the same tables."""
    stream = spark.readStream.schema(RECORD).parquet(path)
    writer = stream.writeStream.foreachBatch(lambda batch, _: load.increment(batch)).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()
