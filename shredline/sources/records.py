"""Sources of records (recid, xmlrecord, currency)."""

from __future__ import annotations

import os
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import escape_xml

RECORD = "recid string, xmlrecord string, currency string"


@dataclass(frozen=True)
class ParquetRecords:
    path: str

    def read(self, spark: SparkSession) -> DataFrame:
        return spark.read.parquet(self.path).select("recid", "xmlrecord", "currency")


@dataclass(frozen=True)
class RowRecords:
    rows: list[tuple[str, str | None, str | None]]

    def read(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(self.rows, RECORD)


@dataclass(frozen=True)
class JdbcRecords:
    """A query that the source database runs as it is; user and password come from the environment.

    With ``partition_column`` (a numeric or date column of the query) and its bounds the query is read by ``partitions`` connections.
    ``since`` is a condition that the database checks, such as the stored watermark on a date column."""

    url: str
    query: str
    user_variable: str = "SOURCE_DB_USER"
    password_variable: str = "SOURCE_DB_PASSWORD"
    options: dict[str, str] = field(default_factory=dict)
    partition_column: str | None = None
    bounds: tuple[str, str] | None = None
    partitions: int = 1
    since: str | None = None

    def settings(self) -> dict[str, str]:
        text = f"SELECT * FROM ({self.query}) source_rows WHERE {self.since}" if self.since else self.query
        own = {"url": self.url, "user": os.environ.get(self.user_variable, ""), "password": os.environ.get(self.password_variable, "")}
        if not self.partition_column:
            return {**own, "query": text, **self.options}
        if not self.bounds:
            raise ValueError("a partition column needs its bounds")
        low, high = self.bounds
        cut = {"partitionColumn": self.partition_column, "lowerBound": low, "upperBound": high, "numPartitions": str(self.partitions)}
        return {**own, "dbtable": f"({text}) partitioned_rows", **cut, **self.options}

    def read(self, spark: SparkSession) -> DataFrame:
        rows = spark.read.format("jdbc").options(**self.settings()).load()
        named = {c.lower(): c for c in rows.columns}
        return rows.select(*(F.col(named[c]).alias(c) for c in ("recid", "xmlrecord", "currency")))


#: Types that attribute tables hold; others are left out or converted.
SUPPORTED = ("string", "int", "bigint", "smallint", "tinyint", "double", "float", "boolean", "date", "timestamp", "timestamp_ntz", "decimal", "char", "varchar", "binary")


def supported(rows: DataFrame, unsupported: str = "ignore") -> DataFrame:
    """The columns of supported types. Others are left out (``ignore``), become JSON text (``convert``) or are an error (``fail``)."""
    odd = [c for c, kind in rows.dtypes if not kind.split("(")[0] in SUPPORTED]
    if odd and unsupported == "fail":
        raise TypeError(f"unsupported types: {', '.join(odd)}")
    if unsupported == "convert":
        return rows.select(*(F.to_json(F.struct(F.col(c).alias("value"))).alias(c) if c in odd else F.col(c) for c in rows.columns))
    return rows.drop(*odd)


class RecordKeyError(ValueError):
    """A record without an id, or two with the same."""


def check_records(records: DataFrame) -> DataFrame:
    """The records, if every one has an id and no two have the same. One aggregation by id finds both."""
    if found := records.groupBy("recid").count().where("recid IS NULL OR count > 1").head():
        raise RecordKeyError(f"{found['count']} records have the id {found.recid}")
    return records


def element(code: str | Column, value: Column, index: Column | None = None) -> Column:
    """One child element; a null value is an empty element and a null index none."""
    name = F.lit(code) if isinstance(code, str) else code
    mark = F.lit("") if index is None else F.coalesce(F.concat(F.lit(' m="'), index.cast("string"), F.lit('"')), F.lit(""))
    return F.concat(F.lit("<"), name, mark, F.lit(">"), escape_xml(F.coalesce(value, F.lit(""))), F.lit("</"), name, F.lit(">"))


def serialise(recid: Column, *children: Column) -> Column:
    return F.concat(F.lit('<row id="'), escape_xml(recid), F.lit('">'), *children, F.lit("</row>"))


def order_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One record per order of the star schema, with its lines as repeated fields c20 and c46.

    Lines are numbered by (l_linenumber, l_partkey, l_suppkey); the first has no index. Orders without lines have
    records too."""
    orders, lines = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("orders", "lineitem"))
    line = F.struct(
        "l_linenumber", "l_partkey", "l_suppkey",
        F.when(F.col("l_linenumber") != 3, F.concat("l_returnflag", "l_linestatus", F.lit("-"), "l_partkey")).alias("c20"),
        F.date_format("l_shipdate", "yyyyMMdd").alias("c46"),
    )
    repeated = lines.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.array_sort(F.collect_list(line)).alias("lines"))
    index = lambda i: F.when(i > 0, i + 1)
    each = lambda name: F.array_join(F.transform("lines", lambda x, i: element(name, x[name], index(i))), "")
    recid = F.col("o_orderkey").cast("string")
    document = serialise(
        recid,
        element("c1", F.col("o_custkey").cast("string")),
        element("c2", F.col("o_orderpriority")),
        element("c8", F.col("o_orderstatus")),
        element("c23", F.col("o_totalprice").cast("decimal(18,2)").cast("string")),
        element("c167", F.when(F.col("o_orderkey") % 13 != 0, F.date_format("o_orderdate", "yyyyMMdd"))),
        F.coalesce(each("c20"), F.lit("")),
        F.coalesce(each("c46"), F.lit("")),
        F.when(F.col("o_orderkey") % 17 == 0, element("c99", F.lit("alt"), F.lit("x"))).otherwise(F.lit("")),
        element("c100", F.lit(None).cast("string")),
    )
    made = orders.join(repeated, "o_orderkey", "left").select(recid.alias("recid"), document.alias("xmlrecord"), F.col("o_orderstatus").alias("currency"))
    # each text is made once, not in every expression that reads it, and later groups by recid need no other shuffle
    return made.repartition("recid")
