"""The canonical shop tables, derived by Spark from the shared test tables.

The test data directory holds TPC-H-like tables plus an event stream.  The
shop jobs need members, orders, coupons held by members, a search log and a
column of date strings; each is a projection of one given table, so every
query's work grows with the given data.  The derivation rules are fixed by
FIXTURES.md and repeated verbatim in the oracle SQL (plans/oracle.py).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shoplens.functions.dates import DATE_STYLES
from shoplens.sources.readers import read_parquet_table

# Members: one Spark SQL statement over the customer table.  The registration
# day follows from the key alone, spread over 2404 days from 1995-01-01 (1601
# has no factor in common with 2404); 'null' text, SQL NULL or a value are the
# three states the jobs see in mp_open_id and phone.
_MEMBER_SQL = """
SELECT c_custkey + 1 AS id,
       c_nationkey % 3 AS sex,
       CAST(CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 1 WHEN 'BUILDING' THEN 2
            WHEN 'FURNITURE' THEN 3 WHEN 'HOUSEHOLD' THEN 4 ELSE 5 END AS INT) AS member_channel,
       CASE WHEN c_nationkey % 4 = 0 THEN 'null' WHEN c_nationkey % 4 = 1 THEN NULL
            ELSE concat('mp_', CAST(c_custkey AS STRING)) END AS mp_open_id,
       CASE WHEN c_nationkey % 5 = 0 THEN 'null' WHEN c_nationkey % 5 = 1 THEN NULL
            ELSE concat('1', CAST(c_custkey AS STRING)) END AS phone,
       TIMESTAMP_NTZ '1995-01-01 00:00:00'
         + make_dt_interval(CAST((c_custkey * 1601) % 2404 AS INT),
                            CAST(c_custkey % 24 AS INT)) AS create_time
FROM {customer}
"""

# Each column is one SQL expression (one call to build, not dozens).
_ORDER_COLUMNS = (
    "o_orderkey AS order_id",
    "o_custkey + 1 AS member_id",
    "CAST(CASE o_orderstatus WHEN 'F' THEN 2 WHEN 'O' THEN 1 ELSE 0 END AS INT) AS order_status",
    "o_totalprice AS origin_price",
    "o_orderdate AS create_time",
)

_COUPON_COLUMNS = (
    "user_id + 1 AS member_id",
    "1 + event_id % 3 AS coupon_id",
    "1 + event_id % 2 AS coupon_channel",
    "ts AS create_time",
)

_SEARCH_LINE = (
    "concat_ws('\\t', CAST(event_id AS STRING), CAST(user_id AS STRING),"
    " concat(event_type, '_', get_json_object(props, '$.k')), CAST(value AS STRING)) AS value"
)


def members(spark: SparkSession, base_dir: str) -> DataFrame:
    customer = read_parquet_table(spark, base_dir, "customer")
    return spark.sql(_MEMBER_SQL, customer=customer)


def orders(spark: SparkSession, base_dir: str) -> DataFrame:
    return read_parquet_table(spark, base_dir, "orders").selectExpr(*_ORDER_COLUMNS)


def coupon_members(spark: SparkSession, base_dir: str) -> DataFrame:
    ev = read_parquet_table(spark, base_dir, "events")
    return ev.filter("event_type IN ('purchase', 'signup')").selectExpr(*_COUPON_COLUMNS)


def search_log(spark: SparkSession, base_dir: str) -> DataFrame:
    """Tab-separated lines: event id, user id, query word, value."""
    return read_parquet_table(spark, base_dir, "events").selectExpr(_SEARCH_LINE)


def date_strings(spark: SparkSession, base_dir: str) -> DataFrame:
    """Event times printed in style number ``event_id % 24`` (23 = junk)."""
    ev = read_parquet_table(spark, base_dir, "events")
    arms = " ".join(
        f"WHEN {i} THEN date_format(ts, '{pattern}')" for i, (_, pattern) in enumerate(DATE_STYLES)
    )
    text = F.expr(f"CASE event_id % {len(DATE_STYLES) + 1} {arms} ELSE 'n/a' END")
    return ev.select("event_id", text.alias("ds"))
