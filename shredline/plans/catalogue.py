"""Queries over the star schema's orders as XML records, and the same results as DuckDB SQL.

The second load of the merge queries changes the first by rule: orders divisible by 5 have another c2, those divisible by 7
another currency, both a later date; those divisible by 10 lose c46, and those divisible by 11 gain c3."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import shown, try_compact_date, try_index, utf8_from_hex
from ..functions.fields import C20_NAMES, NARROW, WIDE, WIDE_ARRAYS, inline_catalogue
from ..operators.enrich import create_view, enrich
from ..operators.merge import changed_records, matched, merge, watermark
from ..operators.pivot import narrow_table, ordered_values, pivot, wide_table
from ..operators.repair import default_repairs, repair
from ..operators.shred import shred, with_virtual_columns
from ..sources import generate
from ..sources.generate import currency_of, generate_records, new_ids, transformed_records
from ..sources.records import order_records
from ..sources.staging import shared_folder, staged
from ..sources.store import SnapshotStore
from .incremental import rebuilt, summary
from .report import account_detail, loaded_watermark, row_count, top_accounts

FIRST, SECOND = "2026-01-01 00:00:00", "2026-01-02 00:00:00"
TITLE_HEX, NAME_HEX, REPAIRED = "D8ADD8B3D8A7D8A8", "C389746F696C65", "33"
SCALARS = [("c1", "customer"), ("c2", "category"), ("c8", "account_currency"), ("c23", "balance"), ("c167", "date_last_update"), ("c252", "co_code")]
ARRAYS = [("c20", "c20_values"), ("c46", "cap_date_charge_values"), ("c99", "alt_acct_type_values"), ("c100", "alt_acct_id_values"), ("c249", "inputter_values")]
VIRTUAL = [("customer", "c1", "decimal(38,0)"), ("category", "c2", "decimal(38,0)"), ("updated", "c167", "string"), ("co_code", "c252", "string")]


# inputs


def attributes(spark: SparkSession, sf: str) -> DataFrame:
    """The first load: attribute rows with the record's date, stored once in a session for each folder of tables."""
    key = (spark.sparkContext.applicationId, sf)
    if key not in _STORED:
        _STORED[key] = staged(shred(order_records(spark, sf), F.lit(FIRST).cast("timestamp"), with_date=True))
    return _STORED[key]


_STORED: dict[tuple[str, str], DataFrame] = {}


def second_load(rows: DataFrame) -> DataFrame:
    n = F.col("recid").cast("long")
    touched = (n % 5 == 0) | (n % 7 == 0)
    new = rows.where((F.col("field_index") != "c46") | (n % 10 != 0))
    extra = rows.where((F.col("field_index") == "c1") & (n % 11 == 0)).withColumns({"field_index": F.lit("c3"), "field_value": F.concat(F.lit("Account "), "recid")})
    return new.unionByName(extra).withColumns(
        {
            "field_value": F.when((F.col("field_index") == "c2") & (n % 5 == 0), F.concat("field_value", F.lit("-X"))).otherwise(F.col("field_value")),
            "currency": F.when(n % 7 == 0, F.lit("Z")).otherwise(F.col("currency")),
            "source_updated_date": F.when(touched, F.lit("2030-01-01").cast("date")).otherwise(F.col("source_updated_date")),
            "ingested_at": F.lit(SECOND).cast("timestamp"),
        }
    )


def changed_source(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Target, changed recids, and the staged rows of these."""
    target = attributes(spark, sf)
    stage = second_load(target)
    changed = staged(changed_records(stage, target))
    return target, changed, stage.join(changed, "recid")


def as_text(rows: DataFrame) -> DataFrame:
    """Timestamps, dates and arrays as text."""
    forms = {"timestamp": lambda c: F.date_format(c, "yyyy-MM-dd HH:mm:ss"), "date": lambda c: F.col(c).cast("string"), "array<string>": lambda c: shown(F.col(c))}
    return rows.select(*(forms.get(kind, F.col)(c).alias(c) for c, kind in rows.dtypes))


def dated(sql: str, column: str) -> str:
    """The query with a date as text."""
    return f"SELECT * REPLACE (CAST({column} AS VARCHAR) AS {column}) FROM ({sql})"


def wide(rows: DataFrame) -> DataFrame:
    return pivot(rows, SCALARS, ARRAYS, "source_currency")


def narrow(rows: DataFrame) -> DataFrame:
    return pivot(rows, SCALARS)


# SQL of the inputs

LINES = """
lines AS (SELECT l_orderkey, c20, c46, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, c20 NULLS FIRST, c46) AS rn
  FROM (SELECT *, CASE WHEN l_linenumber <> 3 THEN l_returnflag || l_linestatus || '-' || l_partkey END AS c20, strftime(l_shipdate, '%Y%m%d') AS c46 FROM lineitem)),
"""
EAV = f"""
{LINES}
raw AS (
  SELECT o_orderkey AS k, unnest(['c1', 'c2', 'c8', 'c23', 'c167', 'c100']) AS field_index, NULL AS mvi,
         unnest([CAST(o_custkey AS VARCHAR), o_orderpriority, o_orderstatus, CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR),
                 CASE WHEN o_orderkey % 13 <> 0 THEN strftime(o_orderdate, '%Y%m%d') END, NULL]) AS field_value FROM orders
  UNION ALL SELECT o_orderkey, 'c99', NULL, 'alt' FROM orders WHERE o_orderkey % 17 = 0
  UNION ALL SELECT l_orderkey, 'c20', CASE WHEN rn > 1 THEN rn END, c20 FROM lines SEMI JOIN orders ON o_orderkey = l_orderkey
  UNION ALL SELECT l_orderkey, 'c46', CASE WHEN rn > 1 THEN rn END, c46 FROM lines SEMI JOIN orders ON o_orderkey = l_orderkey
),
eav AS MATERIALIZED (
  SELECT CAST(k AS VARCHAR) AS recid, o_orderstatus AS currency, field_index, CAST(mvi AS INTEGER) AS multi_value_index, field_value,
         CASE WHEN o_orderkey % 13 <> 0 THEN CAST(o_orderdate AS DATE) END AS source_updated_date, '{FIRST}' AS ingested_at
  FROM raw JOIN orders ON k = o_orderkey
)
"""
SECOND_LOAD = f"""
touched AS (SELECT *, CAST(recid AS BIGINT) AS n FROM eav),
stage AS MATERIALIZED (
  SELECT recid, CASE WHEN n % 7 = 0 THEN 'Z' ELSE currency END AS currency, field_index, multi_value_index,
         CASE WHEN field_index = 'c2' AND n % 5 = 0 THEN field_value || '-X' ELSE field_value END AS field_value,
         CASE WHEN n % 5 = 0 OR n % 7 = 0 THEN DATE '2030-01-01' ELSE source_updated_date END AS source_updated_date, '{SECOND}' AS ingested_at
  FROM (SELECT * FROM touched WHERE field_index <> 'c46' OR n % 10 <> 0
        UNION ALL SELECT recid, currency, 'c3', multi_value_index, 'Account ' || recid, source_updated_date, ingested_at, n FROM touched WHERE field_index = 'c1' AND n % 11 = 0)
),
since AS MATERIALIZED (SELECT coalesce(max(source_updated_date) - 1, DATE '1900-01-01')::DATE AS changed_from FROM eav),
changed AS MATERIALIZED (SELECT DISTINCT recid FROM stage, since WHERE source_updated_date >= changed_from OR source_updated_date IS NULL),
source AS MATERIALIZED (SELECT stage.* FROM stage SEMI JOIN changed USING (recid)),
pairs AS (
  SELECT t, s, CASE WHEN t IS NULL THEN 'insert' WHEN s IS NULL THEN 'keep'
    WHEN t.currency IS DISTINCT FROM s.currency OR t.field_value IS DISTINCT FROM s.field_value OR t.source_updated_date IS DISTINCT FROM s.source_updated_date THEN 'update' ELSE 'same' END AS action
  FROM (SELECT eav AS t FROM eav) FULL JOIN (SELECT source AS s FROM source)
    ON t.recid = s.recid AND t.field_index = s.field_index AND coalesce(t.multi_value_index, -1) = coalesce(s.multi_value_index, -1)
),
merged AS MATERIALIZED (
  SELECT w.recid, CASE WHEN action = 'update' THEN s.currency ELSE w.currency END AS currency, w.field_index, w.multi_value_index,
    CASE WHEN action = 'update' THEN s.field_value ELSE w.field_value END AS field_value,
    CASE WHEN action = 'update' THEN s.source_updated_date ELSE w.source_updated_date END AS source_updated_date,
    CASE WHEN action = 'update' THEN s.ingested_at ELSE w.ingested_at END AS ingested_at
  FROM (SELECT *, CASE WHEN t IS NULL THEN s ELSE t END AS w FROM pairs)
)
"""


def sql_pivot(rows: str, arrays: bool, currency: str) -> str:
    columns = [f"max(CASE WHEN field_index = '{c}' AND multi_value_index IS NULL THEN field_value END) AS {n}" for c, n in SCALARS]
    if arrays:
        columns += [
            f"array_to_string(list(coalesce(field_value, '<null>') ORDER BY coalesce(multi_value_index, 0), field_value NULLS FIRST) FILTER (field_index = '{c}'), '|') AS {n}"
            for c, n in ARRAYS
        ]
    return f"SELECT recid, arg_max_null(currency, ingested_at) AS {currency}, {', '.join(columns)}, max(ingested_at) AS ingested_at FROM {rows} GROUP BY recid"


def sql_catalogue() -> str:
    from ..functions.fields import EFFECTIVE_DATE, catalogue_rows

    rows = ", ".join(f"('{c}', {'NULL' if i is None else i}, '{n}')" for c, i, n in catalogue_rows())
    return f"SELECT field_index, CAST(mvi AS INTEGER) AS multi_value_index, field_name, DATE '{EFFECTIVE_DATE}' AS effective_date FROM (VALUES {rows}) t(field_index, mvi, field_name)"


COLUMNS = "recid, currency, field_index, multi_value_index, field_value, ingested_at"
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str) -> Callable:
    """Registers a query with its SQL."""

    def register(f: Callable[[SparkSession, str], DataFrame]) -> Callable:
        QUERIES[f.__name__] = f
        ORACLES[f.__name__] = sql
        return f

    return register


# shredding


@query(f"WITH {EAV} SELECT {COLUMNS} FROM eav")
def xml_shred_attributes(spark, sf):
    return as_text(shred(order_records(spark, sf), F.lit(FIRST).cast("timestamp")))


@query(f"WITH {EAV} SELECT field_index, count(*) AS n_rows, count(field_value) AS n_values, count(multi_value_index) AS n_indices FROM eav GROUP BY field_index")
def xml_shred_field_counts(spark, sf):
    count = lambda c: F.count(c)
    rows = shred(order_records(spark, sf), F.lit(FIRST).cast("timestamp"), with_date=True)
    return rows.groupBy("field_index").agg(count(F.lit(1)).alias("n_rows"), count("field_value").alias("n_values"), count("multi_value_index").alias("n_indices"))


@query("SELECT event_id, try_cast(nullif(m, '') AS INTEGER) AS multi_value_index FROM (SELECT event_id, CASE WHEN event_id % 3 = 0 THEN '' WHEN event_id % 3 = 1 THEN CAST(event_id AS VARCHAR) ELSE 'x' || event_id END AS m FROM events)")
def index_try_cast(spark, sf):
    n = F.col("event_id")
    m = F.when(n % 3 == 0, "").when(n % 3 == 1, n.cast("string")).otherwise(F.concat(F.lit("x"), n.cast("string")))
    return spark.read.parquet(f"{sf}/events.parquet").select("event_id", try_index(m).alias("multi_value_index"))


@query("SELECT o_orderkey, CAST(CAST(try_strptime(d, '%Y%m%d') AS DATE) AS VARCHAR) AS parsed FROM (SELECT o_orderkey, CASE WHEN o_orderkey % 4 = 0 THEN '' WHEN o_orderkey % 4 = 1 THEN strftime(o_orderdate, '%Y%m') || '31' ELSE strftime(o_orderdate, '%Y%m%d') END AS d FROM orders)")
def source_date_parse(spark, sf):
    n, day = F.col("o_orderkey"), F.col("o_orderdate")
    d = F.when(n % 4 == 0, "").when(n % 4 == 1, F.concat(F.date_format(day, "yyyyMM"), F.lit("31"))).otherwise(F.date_format(day, "yyyyMMdd"))
    return spark.read.parquet(f"{sf}/orders.parquet").select("o_orderkey", try_compact_date(d).cast("string").alias("parsed"))


@query("SELECT CAST(o_orderkey AS VARCHAR) AS recid, CAST(o_custkey AS VARCHAR) AS customer, CAST(NULL AS VARCHAR) AS category, CASE WHEN o_orderkey % 13 <> 0 THEN strftime(o_orderdate, '%Y%m%d') END AS updated, CAST(NULL AS VARCHAR) AS co_code FROM orders")
def virtual_columns(spark, sf):
    made = with_virtual_columns(order_records(spark, sf), VIRTUAL)
    return made.select("recid", F.col("customer").cast("string").alias("customer"), F.col("category").cast("string").alias("category"), "updated", "co_code")


# lookup


@query(dated(sql_catalogue(), "effective_date"))
def lookup_values(spark, sf):
    return as_text(inline_catalogue(spark))


ENRICHED = f"""WITH {EAV}, names AS ({sql_catalogue()})
SELECT recid, currency, eav.field_index, eav.multi_value_index, field_name, field_value, ingested_at FROM eav
LEFT JOIN names ON eav.field_index = names.field_index AND eav.multi_value_index IS NOT DISTINCT FROM names.multi_value_index"""


@query(ENRICHED)
def enriched_attributes(spark, sf):
    return as_text(enrich(attributes(spark, sf), inline_catalogue(spark)))


@query(f"SELECT field_index, multi_value_index, count(*) AS n_rows FROM ({ENRICHED}) WHERE field_name IS NULL GROUP BY ALL")
def unmapped_field_counts(spark, sf):
    rows = enrich(attributes(spark, sf), inline_catalogue(spark))
    return rows.where(F.col("field_name").isNull()).groupBy("field_index", "multi_value_index").agg(F.count(F.lit(1)).alias("n_rows"))


# pivots


@query(f"WITH {EAV} {sql_pivot('eav', False, 'currency')}")
def flat_pivot(spark, sf):
    return as_text(narrow(attributes(spark, sf)))


@query(f"WITH {EAV} {sql_pivot('eav', True, 'source_currency')}")
def wide_pivot(spark, sf):
    return as_text(wide(attributes(spark, sf)))


@query(f"""WITH {EAV} SELECT recid, array_to_string(list(coalesce(field_value, '<null>') ORDER BY coalesce(multi_value_index, 0), field_value NULLS FIRST) FILTER (field_index = 'c20'), '|') AS c20_values,
  CAST(count(*) FILTER (field_index = 'c20') AS INTEGER) AS n_values, count(*) FILTER (field_index = 'c249') = 0 AS absent_is_null FROM eav GROUP BY recid""")
def ordered_array_nulls(spark, sf):
    made = attributes(spark, sf).groupBy("recid").agg(ordered_values("c20").alias("v"), ordered_values("c249").alias("absent"))
    return made.select("recid", shown(F.col("v")).alias("c20_values"), F.coalesce(F.size("v"), F.lit(0)).alias("n_values"), F.col("absent").isNull().alias("absent_is_null"))


@query("SELECT user_id, arg_max_null(v, k) AS latest_value, max(k) AS latest_event FROM (SELECT user_id, CASE WHEN event_id % 10 <> 0 THEN CAST(CAST(value AS DECIMAL(18,2)) AS VARCHAR) END AS v, strftime(ts, '%Y-%m-%d %H:%M:%S') || '-' || lpad(CAST(event_id AS VARCHAR), 12, '0') AS k FROM events) GROUP BY user_id")
def latest_value_by(spark, sf):
    v = F.when(F.col("event_id") % 10 != 0, F.col("value").cast("decimal(18,2)").cast("string"))
    k = F.concat(F.date_format("ts", "yyyy-MM-dd HH:mm:ss"), F.lit("-"), F.lpad(F.col("event_id").cast("string"), 12, "0"))
    rows = spark.read.parquet(f"{sf}/events.parquet").select("user_id", v.alias("v"), k.alias("k"))
    return rows.groupBy("user_id").agg(F.max_by("v", "k").alias("latest_value"), F.max("k").alias("latest_event"))


# repairs


@query(f"""WITH {EAV} SELECT recid, field_index, multi_value_index, CASE WHEN field_index = 'c20' AND multi_value_index = 4 THEN decode(unhex('{TITLE_HEX}'))
  WHEN recid = '{REPAIRED}' AND field_index IN ('c3', 'c5') THEN decode(unhex('{NAME_HEX}')) ELSE field_value END AS field_value FROM eav""")
def repair_update(spark, sf):
    made = repair(attributes(spark, sf), default_repairs(TITLE_HEX, REPAIRED, NAME_HEX))
    return made.select("recid", "field_index", "multi_value_index", "field_value")


@query("SELECT r_regionkey, decode(unhex(hex(r_name))) AS again, decode(unhex('D8ADD8B3D8A7D8A8')) AS title FROM region")
def utf8_from_hex_text(spark, sf):
    again = F.decode(F.unhex(F.hex("r_name")), "UTF-8")
    return spark.read.parquet(f"{sf}/region.parquet").select("r_regionkey", again.alias("again"), utf8_from_hex(TITLE_HEX).alias("title"))


# incremental loads


@query(dated(f"WITH {EAV}, {SECOND_LOAD} SELECT changed_from FROM since", "changed_from"))
def watermark_lower_bound(spark, sf):
    return as_text(watermark(attributes(spark, sf)))


@query(f"WITH {EAV}, {SECOND_LOAD} SELECT recid FROM changed")
def changed_account_records(spark, sf):
    return changed_source(spark, sf)[1]


@query(dated(f"WITH {EAV}, {SECOND_LOAD} SELECT {COLUMNS}, source_updated_date FROM source", "source_updated_date"))
def changed_source_rows(spark, sf):
    return as_text(changed_source(spark, sf)[2])


@query(dated(f"WITH {EAV}, {SECOND_LOAD} SELECT {COLUMNS}, source_updated_date FROM merged", "source_updated_date"))
def merge_attributes(spark, sf):
    target, _, source = changed_source(spark, sf)
    return as_text(merge(target, source.select(*target.columns)))


@query(f"WITH {EAV}, {SECOND_LOAD} SELECT action, count(*) AS n_rows FROM pairs GROUP BY action")
def merge_action_counts(spark, sf):
    target, _, source = changed_source(spark, sf)
    return matched(target, source).groupBy("action").agg(F.count(F.lit(1)).alias("n_rows"))


@query(f"WITH {EAV}, {SECOND_LOAD} SELECT recid, multi_value_index, field_value, ingested_at FROM merged WHERE field_index = 'c46' AND CAST(recid AS BIGINT) % 10 = 0")
def merge_keeps_removed_elements(spark, sf):
    target, _, source = changed_source(spark, sf)
    kept = merge(target, source.select(*target.columns)).where((F.col("field_index") == "c46") & (F.col("recid").cast("long") % 10 == 0))
    return as_text(kept.select("recid", "multi_value_index", "field_value", "ingested_at"))


def _rebuild(spark: SparkSession, sf: str, table: Callable[[DataFrame], DataFrame]) -> DataFrame:
    target, changed, source = changed_source(spark, sf)
    merged = staged(merge(target, source.select(*target.columns)))
    return as_text(rebuilt(table(target), table(merged.join(changed, "recid", "left_semi")), changed))


def _sql_rebuild(arrays: bool, currency: str) -> str:
    old, new = sql_pivot("eav", arrays, currency), sql_pivot("(SELECT merged.* FROM merged SEMI JOIN changed USING (recid))", arrays, currency)
    return f"WITH {EAV}, {SECOND_LOAD} SELECT * FROM ({old}) ANTI JOIN changed USING (recid) UNION ALL SELECT * FROM ({new})"


@query(_sql_rebuild(False, "currency"))
def rebuild_flat_changed(spark, sf):
    return _rebuild(spark, sf, narrow)


@query(_sql_rebuild(True, "source_currency"))
def rebuild_wide_changed(spark, sf):
    return _rebuild(spark, sf, wide)


@query(dated(f"WITH {EAV}, {SECOND_LOAD} SELECT (SELECT count(*) FROM changed) AS changed_account_count, (SELECT max(source_updated_date) FROM merged) AS loaded_through", "loaded_through"))
def incremental_summary(spark, sf):
    target, changed, source = changed_source(spark, sf)
    return as_text(summary(changed, merge(target, source.select(*target.columns))))


# the store


def store(spark: SparkSession) -> SnapshotStore:
    return SnapshotStore(spark, f"{shared_folder(spark)}/store-{uuid.uuid4().hex}")


def order_rows(spark: SparkSession, sf: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/orders.parquet").select("o_orderkey", "o_orderstatus", F.col("o_totalprice").cast("decimal(18,2)").cast("string").alias("price"))


ORDERS = "SELECT o_orderkey, o_orderstatus, CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) AS price FROM orders"


@query(f"WITH {EAV} SELECT recid, field_index, multi_value_index, field_value FROM eav WHERE field_index = 'c46'")
def store_partition_scan(spark, sf):
    """CREATE TABLE AS, partitioned by field and bucketed by record; the scan reads one partition."""
    made = store(spark)
    made.create("attributes", attributes(spark, sf), ["field_index"], "recid", 4)
    return made.read("attributes").where("field_index = 'c46'").select("recid", "field_index", "multi_value_index", "field_value")


@query(f"{ORDERS}")
def store_append_by_name(spark, sf):
    made, rows = store(spark), order_rows(spark, sf)
    made.create("orders", rows.where("o_orderkey % 2 = 0"), ["o_orderstatus"])
    made.append("orders", rows.where("o_orderkey % 2 = 1").select("price", "o_orderstatus", "o_orderkey"))
    return made.read("orders")


@query(f"SELECT *, CASE WHEN o_orderkey % 3 = 0 THEN o_orderstatus || '-new' END AS note FROM ({ORDERS})")
def store_add_column(spark, sf):
    """A new column is null in older files; adding it again changes nothing."""
    made, rows = store(spark), order_rows(spark, sf)
    made.create("orders", rows.where("o_orderkey % 3 <> 0"))
    for _ in range(2):
        made.add_column("orders", "note", "string")
    made.append("orders", rows.where("o_orderkey % 3 = 0").withColumn("note", F.concat("o_orderstatus", F.lit("-new"))))
    return made.read("orders")


@query(f"SELECT o_orderkey, CASE WHEN o_orderkey % 5 = 0 THEN 'U' ELSE o_orderstatus END AS o_orderstatus, price FROM ({ORDERS}) WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_linenumber = 7)")
def store_update_and_delete(spark, sf):
    made = store(spark)
    made.create("orders", order_rows(spark, sf), [], "o_orderkey", 8)
    made.update("orders", F.col("o_orderkey") % 5 == 0, {"o_orderstatus": F.lit("U")})
    gone = spark.read.parquet(f"{sf}/lineitem.parquet").where("l_linenumber = 7").select(F.col("l_orderkey").alias("o_orderkey")).distinct()
    made.delete_in("orders", gone, "o_orderkey")
    return made.read("orders")


@query("SELECT * FROM (VALUES ('kept', 0, 'r_regionkey', 'int'), ('kept', 1, 'r_name', 'string')) t(table_name, place, column_name, data_type)")
def store_drop_and_show(spark, sf):
    made, regions = store(spark), spark.read.parquet(f"{sf}/region.parquet")
    for name in ("kept", "dropped"):
        made.create(name, regions)
    for _ in range(2):
        made.drop("dropped")
    return made.schemas()


@query(f"WITH {EAV}, {SECOND_LOAD} SELECT {COLUMNS}, CAST(source_updated_date AS VARCHAR) AS source_updated_date FROM merged")
def store_merge(spark, sf):
    """MERGE into a stored table, bucket by bucket."""
    target, _, source = changed_source(spark, sf)
    made = store(spark)
    made.create("attributes", target, [], "recid", 4)
    made.merge("attributes", source.select(*target.columns))
    return as_text(made.read("attributes"))


@query(f"SELECT field_name, count(*) AS n_rows, max(field_value) AS largest FROM ({ENRICHED}) GROUP BY field_name")
def enriched_view(spark, sf):
    create_view(attributes(spark, sf), inline_catalogue(spark), "account_attributes_named")
    return spark.sql("SELECT field_name, count(*) AS n_rows, max(field_value) AS largest FROM account_attributes_named GROUP BY field_name")


# joins, generation and reports


@query("SELECT r AS recid, CASE right(r, 1) WHEN '1' THEN 'USD' WHEN '2' THEN 'EUR' WHEN '3' THEN 'GBP' ELSE 'EGP' END AS currency FROM (SELECT CAST(9000000120000001 + range AS VARCHAR) AS r FROM range(3000)) WHERE NOT EXISTS (SELECT 1 FROM customer WHERE CAST(9000000120000000 + c_custkey AS VARCHAR) = r AND c_custkey % 3 <> 0)")
def anti_join_new_ids(spark, sf):
    """Generated records whose ids no record has yet."""
    taken = spark.read.parquet(f"{sf}/customer.parquet").where("c_custkey % 3 <> 0").select((F.lit(9000000120000000) + F.col("c_custkey")).cast("string").alias("recid"))
    return generate_records(spark, TEMPLATE, 3000, existing=taken).select("recid", "currency")


@query("SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')")
def semi_join_in(spark, sf):
    customers, orders = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("customer", "orders"))
    chosen = customers.where(F.col("c_mktsegment") == "BUILDING").select(F.col("c_custkey").alias("o_custkey"))
    return orders.join(chosen, "o_custkey", "left_semi").select("o_orderkey", "o_custkey")


TEMPLATE = [("c1", None, "1"), ("c2", None, "2"), ("c3", None, "t"), ("c8", None, "EGP"), ("c23", None, "0"), ("c46", None, "20200101"), ("c46", "2", "20200102"), ("c249", None, "u"), ("c11", None, "7")]
GENERATED = 10_000


@query(f"""SELECT r AS recid, '<row id="' || r || '"><c1>90' || substr(r, 11, 6) || '</c1><c2>65' || substr(r, 15, 1) || '0</c2><c3>Test account ' || r || '</c3><c8>' || cur || '</c8><c23>' || amount
  || '</c23><c46>' || day || '</c46><c46 m="2">' || day || '</c46><c249>TEST_USER_' || substr(r, 11, 6) || '</c249><c11>7</c11></row>' AS xmlrecord, cur AS currency
FROM (SELECT r, CASE right(r, 1) WHEN '1' THEN 'USD' WHEN '2' THEN 'EUR' WHEN '3' THEN 'GBP' ELSE 'EGP' END AS cur,
  CAST(CAST((CAST(substr(r, 11, 6) AS INTEGER) % 900000) AS DECIMAL(18,2)) / 100 AS DECIMAL(18,2))::VARCHAR AS amount,
  '2026' || lpad(CAST(CAST(substr(r, 15, 2) AS INTEGER) % 12 + 1 AS VARCHAR), 2, '0') || lpad(CAST(CAST(substr(r, 13, 2) AS INTEGER) % 28 + 1 AS VARCHAR), 2, '0') AS day
  FROM (SELECT CAST(9000000120000001 + range AS VARCHAR) AS r FROM range({GENERATED})))""")
def generate_account_records(spark, sf):
    return generate_records(spark, TEMPLATE, GENERATED)


@query(f"SELECT CASE right(r, 1) WHEN '1' THEN 'USD' WHEN '2' THEN 'EUR' WHEN '3' THEN 'GBP' ELSE 'EGP' END AS currency, count(*) AS n_records, min(r) AS first_id, max(r) AS last_id FROM (SELECT CAST(9000000120000001 + range AS VARCHAR) AS r FROM range({GENERATED})) GROUP BY 1")
def generated_ids_by_currency(spark, sf):
    ids = new_ids(spark, GENERATED).withColumn("currency", currency_of(F.col("recid")))
    return ids.groupBy("currency").agg(F.count(F.lit(1)).alias("n_records"), F.min("recid").alias("first_id"), F.max("recid").alias("last_id"))


# Every code of the reporting tables; repeated fields have a first value, an empty and a third one.
FULL_TEMPLATE = [
    *((c, None, f"{c} text & more") for c in dict.fromkeys(c for c, _ in [*NARROW, *WIDE])),
    *((c, i, v) for c, _ in WIDE_ARRAYS for i, v in ((None, "first"), ("2", None), ("3", "third"))),
]
FULL = 2000


def sql_rule(code: str, literal: str | None) -> str:
    """A rule's value of a field, as SQL over the id r, else the template's."""
    amount = "CAST(CAST((CAST(substr(r, 11, 6) AS INTEGER) % 900000) AS DECIMAL(18,2)) / 100 AS DECIMAL(18,2))::VARCHAR"
    part = lambda at, n: f"lpad(CAST(CAST(substr(r, {at}, 2) AS INTEGER) % {n} + 1 AS VARCHAR), 2, '0')"
    currency = "CASE right(r, 1) WHEN '1' THEN 'USD' WHEN '2' THEN 'EUR' WHEN '3' THEN 'GBP' ELSE 'EGP' END"
    rules = [
        (generate.CUSTOMER, "'90' || substr(r, 11, 6)"), (generate.CATEGORY, "'65' || substr(r, 15, 1) || '0'"), (generate.TITLE, "'Test account ' || r"), (generate.CURRENCY, currency),
        (generate.AMOUNT, amount), (generate.DATE, f"'2026' || {part(15, 12)} || {part(13, 28)}"), (generate.USER, "'TEST_USER_' || substr(r, 11, 6)"),
    ]
    return next((sql for codes, sql in rules if code in codes), "CAST(NULL AS VARCHAR)" if literal is None else f"'{literal}'")


def sql_full(scalars: list[tuple[str, str]], arrays: list[tuple[str, str]], currency: str) -> str:
    literal = {c: v for c, i, v in FULL_TEMPLATE if i is None}
    columns = [f"{sql_rule(c, literal[c])} AS {n}" for c, n in scalars]
    columns += [" || '|' || ".join(f"coalesce({sql_rule(c, v)}, '<null>')" for v in ("first", None, "third")) + f" AS {n}" for c, n in arrays]
    return f"SELECT r AS recid, {sql_rule('c8', None)} AS {currency}, {', '.join(columns)}, '{FIRST}' AS ingested_at FROM (SELECT CAST({generate.FIRST_ID} + range AS VARCHAR) AS r FROM range({FULL}))"


def full_rows(spark: SparkSession) -> DataFrame:
    return shred(generate_records(spark, FULL_TEMPLATE, FULL), F.lit(FIRST).cast("timestamp"))


@query(sql_full(NARROW, [], "currency"))
def account_flat_full(spark, sf):
    return as_text(narrow_table(full_rows(spark)))


@query(sql_full(WIDE, WIDE_ARRAYS, "source_currency"))
def account_wide_full(spark, sf):
    return as_text(wide_table(full_rows(spark)))


#: A document with what no rule knows: comments, nested elements, attributes and CDATA.
DOCUMENT = """<?xml version="1.0"?>
<row a="1" id='9' z="$1 \\ &amp;">
  <!-- <c2>kept</c2> --><c1 m="4" other="x">old</c1><c2/><c3 k="$2"><![CDATA[<old>]]></c3><c8></c8><c11>kept</c11><c20 m="2">ke<b>p</b>t</c20>
  <c46>a</c46><c46 m="2">b</c46><zz><c23>7</c23></zz>
</row>"""


@query("SELECT r AS recid, '<?xml version=\"1.0\"?>\n<row a=\"1\" id=\"' || r || '\" z=\"$1 \\ &amp;\">\n  <!-- <c2>' || " + sql_rule("c2", None) + " || '</c2> --><c1 m=\"4\" other=\"x\">' || " + sql_rule("c1", None)
       + " || '</c1><c2>' || " + sql_rule("c2", None) + " || '</c2><c3 k=\"$2\">' || " + sql_rule("c3", None) + " || '</c3><c8>' || " + sql_rule("c8", None)
       + " || '</c8><c11>kept</c11><c20 m=\"2\">ke<b>p</b>t</c20>\n  <c46>' || " + sql_rule("c46", None) + " || '</c46><c46 m=\"2\">' || " + sql_rule("c46", None)
       + " || '</c46><zz><c23>' || " + sql_rule("c23", None) + f" || '</c23></zz>\n</row>' AS xmlrecord, " + sql_rule("c8", None) + f" AS currency FROM (SELECT CAST(9000000120000001 + range AS VARCHAR) AS r FROM range({FULL}))")
def transformed_documents(spark, sf):
    return transformed_records(spark, DOCUMENT, FULL)


@query(f"WITH {EAV} SELECT recid, customer, category, c20_values FROM ({sql_pivot('eav', True, 'source_currency')}) ORDER BY recid LIMIT 10")
def top_accounts_report(spark, sf):
    """The least ids are found first, and only their records are pivoted."""
    rows = attributes(spark, sf)
    first = F.broadcast(rows.select("recid").distinct().orderBy("recid").limit(10))
    return as_text(top_accounts(wide(rows.join(first, "recid", "left_semi")), ["customer", "category", "c20_values"]))


DETAIL = "33"


@query(f"SELECT field_index, multi_value_index, field_name, field_value, row_number() OVER (ORDER BY field_index, multi_value_index NULLS LAST) AS place FROM ({ENRICHED}) WHERE recid = '{DETAIL}'")
def account_detail_sorted(spark, sf):
    rows = enrich(attributes(spark, sf).where(F.col("recid") == DETAIL), inline_catalogue(spark))
    ordered = account_detail(rows, DETAIL).agg(F.collect_list(F.struct("field_index", "multi_value_index", "field_name", "field_value")).alias("r"))
    placed = ordered.select(F.posexplode("r").alias("at", "x"))
    return placed.select("x.field_index", "x.multi_value_index", "x.field_name", "x.field_value", (F.col("at") + 1).cast("long").alias("place"))


@query(dated(f"WITH {EAV} SELECT max(source_updated_date) AS loaded_through FROM eav", "loaded_through"))
def loaded_watermark_report(spark, sf):
    return as_text(loaded_watermark(attributes(spark, sf)))


@query(f"WITH {EAV} SELECT count(*) AS row_count FROM eav")
def attribute_row_count(spark, sf):
    return row_count(attributes(spark, sf))


@query(f"WITH {EAV} SELECT recid, multi_value_index, field_value FROM eav WHERE field_index = 'c20'")
def single_field_scan(spark, sf):
    """One field of all records; a stored table reads one partition for it."""
    rows = shred(order_records(spark, sf), F.lit(FIRST).cast("timestamp"))
    return rows.where(F.col("field_index") == "c20").select("recid", "multi_value_index", "field_value")


@query(f"WITH {EAV} SELECT field_index, coalesce(field_name, 'unmapped') AS field_name, count(*) AS n_rows FROM (SELECT eav.field_index, n.field_name FROM eav LEFT JOIN (SELECT unnest([{', '.join(repr(x) for x in C20_NAMES)}]) AS field_name, unnest(range(1, {len(C20_NAMES) + 1})) AS i) n ON eav.field_index = 'c20' AND eav.multi_value_index = n.i) GROUP BY ALL")
def indexed_name_counts(spark, sf):
    names = inline_catalogue(spark).where(F.col("multi_value_index").isNotNull())
    rows = enrich(attributes(spark, sf), names)
    return rows.groupBy("field_index", F.coalesce("field_name", F.lit("unmapped")).alias("field_name")).agg(F.count(F.lit(1)).alias("n_rows"))
