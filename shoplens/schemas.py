"""Declared schemas of the canonical input tables.

The jobs address four tables: members, orders, coupons held by members and a
raw search log.  A source with extra columns or wider types is narrowed to
these with :func:`conform`, which selects by name so only these columns are
read from a columnar source.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

MEMBER = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("sex", T.IntegerType()),
        T.StructField("member_channel", T.IntegerType()),
        # the literal text 'null' means "not subscribed"
        T.StructField("mp_open_id", T.StringType()),
        # the literal text 'null' means "no phone given"
        T.StructField("phone", T.StringType()),
        T.StructField("create_time", T.TimestampNTZType()),
    ]
)

ORDER = T.StructType(
    [
        T.StructField("order_id", T.LongType()),
        T.StructField("member_id", T.LongType()),
        # 2 = completed purchase; the only value the funnel looks at
        T.StructField("order_status", T.IntegerType()),
        T.StructField("origin_price", T.DoubleType()),
        T.StructField("create_time", T.TimestampNTZType()),
    ]
)

COUPON_MEMBER = T.StructType(
    [
        T.StructField("member_id", T.LongType()),
        # 1 = the free coupon, anything else is paid
        T.StructField("coupon_id", T.LongType()),
        # 1 = bought, 2 = handed out
        T.StructField("coupon_channel", T.LongType()),
        T.StructField("create_time", T.TimestampNTZType()),
    ]
)

SEARCH_LOG = T.StructType([T.StructField("value", T.StringType())])


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Select the schema's columns by name, in the declared types.

    A column already of its declared type is passed through; any other is
    converted with ``try_cast`` (e.g. a text ``create_time``), so a malformed
    value becomes NULL instead of failing a job over the whole table.
    """
    have = {f.name: f.dataType for f in df.schema.fields}
    return df.select(
        *[
            (F.col(f.name) if have.get(f.name) == f.dataType else F.col(f.name).try_cast(f.dataType)).alias(
                f.name
            )
            for f in schema.fields
        ]
    )


def rejected_values(df: DataFrame, schema: T.StructType) -> DataFrame:
    """``column, rejected``: values that :func:`conform` turns into NULL, per
    converted column (one aggregate over the stored table)."""
    have = {f.name: f.dataType for f in df.schema.fields}
    changed = [f for f in schema.fields if have.get(f.name) != f.dataType]
    lost = [
        F.count(F.when(F.col(f.name).isNotNull() & F.col(f.name).try_cast(f.dataType).isNull(), True)).alias(f.name)
        for f in changed
    ]
    if not lost:
        return df.sparkSession.createDataFrame([], "column string, rejected bigint")
    pairs = F.array(*[F.struct(F.lit(f.name).alias("column"), F.col(f.name).alias("rejected")) for f in changed])
    return df.agg(*lost).select(F.inline(pairs))


def conform_counted(df: DataFrame, schema: T.StructType) -> tuple[DataFrame, Observation | None]:
    """:func:`conform`, with the values it turns into NULL counted per column
    by whatever action runs the frame: no scan of its own.

    Only converted columns are counted; without any, nothing is observed
    (None).  Counting sits between the scan and the report's filters, so use
    it where columns are converted anyway and cannot be pushed down.
    """
    have = {f.name: f.dataType for f in df.schema.fields}
    changed = [f for f in schema.fields if have.get(f.name) != f.dataType]
    if not changed:
        return conform(df, schema), None
    lost = Observation()
    counts = [
        F.count(F.when(F.col(f.name).isNotNull() & F.col(f.name).try_cast(f.dataType).isNull(), True)).alias(f.name)
        for f in changed
    ]
    return conform(df.observe(lost, *counts), schema), lost


# Declared schemas of the given test tables the canonical tables derive from.
# Reading with a declared schema skips footer inference at planning time.
SOURCE_TABLES: dict[str, T.StructType] = {
    "customer": T.StructType(
        [
            T.StructField("c_custkey", T.LongType()),
            T.StructField("c_name", T.StringType()),
            T.StructField("c_nationkey", T.IntegerType()),
            T.StructField("c_acctbal", T.DoubleType()),
            T.StructField("c_mktsegment", T.StringType()),
        ]
    ),
    "orders": T.StructType(
        [
            T.StructField("o_orderkey", T.LongType()),
            T.StructField("o_custkey", T.LongType()),
            T.StructField("o_orderstatus", T.StringType()),
            T.StructField("o_totalprice", T.DoubleType()),
            T.StructField("o_orderdate", T.TimestampNTZType()),
            T.StructField("o_orderpriority", T.StringType()),
        ]
    ),
    "events": T.StructType(
        [
            T.StructField("event_id", T.LongType()),
            T.StructField("ts", T.TimestampNTZType()),
            T.StructField("user_id", T.LongType()),
            T.StructField("event_type", T.StringType()),
            T.StructField("value", T.DoubleType()),
            T.StructField("props", T.StringType()),
        ]
    ),
}
