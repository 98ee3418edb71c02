"""Written stages: a stage is computed once, its run timestamp stays fixed, and a lost executor costs no more than a read."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


_OWN: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """The folder named in ``spark.checkpoint.dir``, which the driver and all executors share. Where it is not set, a session
    without executors of their own (``local[...]``, as in tests) gets a temporary one; on a cluster that is an error."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root
    context = spark.sparkContext
    if not context.master.startswith("local[") and context.master != "local":
        raise ValueError("spark.checkpoint.dir is not set; it names the folder that the driver and the executors share")
    if context.applicationId not in _OWN:
        _OWN[context.applicationId] = "file://" + tempfile.mkdtemp(prefix="shredline-")
    return _OWN[context.applicationId]


def staged(rows: DataFrame) -> DataFrame:
    """The rows, written to and read from the shared folder."""
    spark = rows.sparkSession
    path = f"{shared_folder(spark)}/stage-{uuid.uuid4().hex}"
    rows.write.parquet(path)
    return spark.read.schema(rows.schema).parquet(path)
