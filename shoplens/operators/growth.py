"""Daily growth: registrations, orders and the running transaction total.

The parity report keeps the original report's shape: per window day, new members
and the day's highest member id, the day's highest order id, and the total
amount so far; only days with both registrations and orders appear, and a
day's amount counts in later totals only if the day appears.

Both reports read each table once.  Member and order rows are unioned and
aggregated per day in a single aggregate (partial aggregation first, so a hot
day costs one row per task), giving at most one row per calendar day.  The
running total is a window over those day rows; it runs in one task over a
table bounded by the number of days in the data, not by the data volume.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shoplens.functions.timewin import (
    DayPartition,
    as_datetime,
    date_lit,
    day_key,
    day_label,
    days_before,
    is_midnight,
    money_odd,
    money_out,
    money_rows,
    money_sums,
    money_total,
    require_midnight,
    time_window,
)


def _running():
    """All day rows up to the current one.  No partitioning: the input has
    one row per calendar day, so it fits one task at any data volume."""
    return Window.orderBy("d").rowsBetween(Window.unboundedPreceding, Window.currentRow)


def growth_daily_registrations(
    members: DataFrame, *, as_of, days: int = 7, partition_day: str | DayPartition | None = None
) -> DataFrame:
    """Per day from ``as_of - days`` on: ``day, newRegCount, totalMemberCount``.

    totalMemberCount is the day's highest member id, which equals the member
    total only while ids are dense and rise with time.
    """
    start = days_before(as_of, days)
    return (
        members.filter(time_window(start, partition_day=partition_day))
        .groupBy(day_key(F.col("create_time")).alias("d"))
        .agg(F.count("id").alias("newRegCount"), F.max("id").alias("totalMemberCount"))
        .select(day_label(F.col("d")).alias("day"), "newRegCount", "totalMemberCount")
    )


def growth_daily_orders(
    orders: DataFrame, *, as_of, days: int = 7, partition_day: str | DayPartition | None = None
) -> DataFrame:
    """Per day from ``as_of - days`` on: ``day, totalOrderCount, gmv``."""
    start = days_before(as_of, days)
    kind = orders.schema["origin_price"].dataType
    return (
        orders.filter(time_window(start, partition_day=partition_day))
        .selectExpr("to_date(create_time) AS d", "order_id", *_named(money_rows(kind)))
        .groupBy("d")
        .agg(*map(F.expr, ("max(order_id) AS totalOrderCount", *_named(money_sums(kind)))))
        .select(
            day_label(F.col("d")).alias("day"),
            "totalOrderCount",
            money_out(F.expr(money_total(kind)), F.col("big_amount")).alias("gmv"),
        )
    )


def _named(columns: dict[str, str]) -> list[str]:
    return [f"{sql} AS {name}" for name, sql in columns.items()]


def growth_prior_gmv(
    orders: DataFrame, *, as_of, days: int = 7, partition_day: str | DayPartition | None = None
) -> DataFrame:
    """One row: ``totalGmv``, the amount of all orders before the window
    (NULL when there are none)."""
    start = days_before(as_of, days)
    kind = orders.schema["origin_price"].dataType
    return (
        orders.filter(time_window(upper=start, partition_day=partition_day))
        .selectExpr(*_named(money_rows(kind)))
        .agg(*map(F.expr, _named(money_sums(kind))))
        .select(money_out(F.expr(money_total(kind)), F.col("big_amount")).alias("totalGmv"))
    )


# Member and order rows in one shape, so one aggregate can take both.  SQL
# expression text: one call per column to build.  ``{d}`` is the day key.
_MEMBER_ROW = (
    "{d} AS d",
    "id AS member_id",
    "1 AS is_member",
    "CAST(NULL AS BIGINT) AS order_id",
    "CAST(NULL AS BIGINT) AS cents",
    "CAST(NULL AS {rest_type}) AS rest",
    "0 AS is_order",
)
_ORDER_ROW = (
    "{d} AS d",
    "CAST(NULL AS BIGINT) AS member_id",
    "0 AS is_member",
    "order_id",
    "{cents} AS cents",
    "{rest} AS rest",
    "1 AS is_order",
)


def _day_text(edge) -> str:
    """The day key; rows before the instant ``edge`` belong to the day before
    it, so a window may start inside a day."""
    if edge is None or is_midnight(edge):
        return "to_date(create_time)"
    at = as_datetime(edge)
    return (
        f"CASE WHEN create_time < TIMESTAMP_NTZ '{at.isoformat(sep=' ')}' "
        f"THEN least(to_date(create_time), DATE '{days_before(at, 1).date()}') ELSE to_date(create_time) END"
    )


def _tagged(rows: DataFrame, cond: Column, columns: tuple[str, ...], values: dict[str, str]) -> DataFrame:
    return rows.filter(cond).selectExpr(*[c.format(**values) for c in columns])


_DAILY_AGGS = (
    "sum(is_member) AS member_rows",
    "count(member_id) AS new_members",
    "max(member_id) AS max_member_id",
    "sum(is_order) AS order_rows",
    "count(order_id) AS orders",
    "max(order_id) AS max_order_id",
)

# Every summary column is a sum or a maximum, so summaries of disjoint row
# sets merge exactly (merge_daily).
_MERGE = {
    "member_rows": F.sum,
    "new_members": F.sum,
    "max_member_id": F.max,
    "order_rows": F.sum,
    "orders": F.sum,
    "max_order_id": F.max,
    "amount": F.sum,
    "big_amount": F.sum,
    "odd_amounts": F.sum,
}


def daily_activity(
    members: DataFrame,
    orders: DataFrame,
    *,
    members_since=None,
    until=None,
    partition_day: str | DayPartition | None = None,
    edge=None,
) -> DataFrame:
    """Per-day summary of both tables, one row per calendar day ``d`` with any
    member or order row: ``member_rows, new_members (non-NULL ids),
    max_member_id, order_rows, orders (non-NULL ids), max_order_id, amount,
    big_amount, odd_amounts`` (the exact sum, the sum of amounts too large
    for it, and the number of NaN or infinite amounts, which no sum holds).

    One aggregate over the union of both tables' rows (partial aggregation
    first).  At scale, write it once partitioned by ``d``, add each new day
    with :func:`merge_daily`, and run the growth reports from it: a few
    thousand rows instead of the whole history.  ``members_since`` and
    ``until`` bound the rows read (both push into the scans; with
    ``partition_day`` they also prune day partitions).  Rows before the
    instant ``edge`` count for the day before it (reports whose window starts
    inside a day; never use it for a stored summary).
    """
    m_cond = time_window(members_since, until, partition_day=partition_day)
    o_cond = time_window(upper=until, partition_day=partition_day)
    kind = orders.schema["origin_price"].dataType
    money = money_rows(kind)
    values = money | {"d": _day_text(edge), "rest_type": orders.selectExpr(money["rest"]).schema[0].dataType.simpleString()}
    sums = _named(money_sums(kind) | {"odd_amounts": money_odd(kind)})
    return (
        _tagged(members, m_cond, _MEMBER_ROW, values)
        .unionByName(_tagged(orders, o_cond, _ORDER_ROW, values))
        .groupBy("d")
        .agg(*[F.expr(e) for e in (*_DAILY_AGGS, *sums)])
        .filter(F.col("d").isNotNull())
        .selectExpr(*[f"{money_total(kind)} AS amount" if c == "amount" else c for c in ("d", *_MERGE)])
    )


def merge_daily(*summaries: DataFrame) -> DataFrame:
    """Merge per-day summaries of disjoint row sets (e.g. the stored history
    and the rows of a new day) into one."""
    combined = summaries[0]
    for other in summaries[1:]:
        combined = combined.unionByName(other)
    return combined.groupBy("d").agg(*[f(c).alias(c) for c, f in _MERGE.items()])


def growth_report_from_daily(daily: DataFrame, *, as_of, days: int = 7) -> DataFrame:
    """:func:`growth_report` from a :func:`daily_activity` summary (``as_of``
    at midnight; a summary of whole days cannot answer other windows)."""
    require_midnight(as_of)
    return _report(daily, as_of, days)


def _running_money(window) -> tuple[Column, Column]:
    return F.sum(F.coalesce(F.col("amount"), F.lit(0))).over(window), F.sum("big_amount").over(window)


def _report(daily: DataFrame, as_of, days: int) -> DataFrame:
    in_window = F.col("d") >= date_lit(days_before(as_of, days))
    exact, big = _running_money(_running())
    kept = (
        daily.filter((F.col("order_rows") > 0) & (~in_window | (F.col("member_rows") > 0)))
        .withColumn("running", exact)
        .withColumn("running_big", big)
    )
    return (
        kept.filter(in_window)
        .orderBy("d")
        .select(
            day_label(F.col("d")).alias("day"),
            F.col("new_members").alias("newRegCount"),
            F.col("max_member_id").alias("totalMemberCount"),
            F.col("max_order_id").alias("totalOrderCount"),
            money_out(F.col("running"), F.col("running_big")).alias("gmv"),
        )
    )


def growth_report(
    members: DataFrame,
    orders: DataFrame,
    *,
    as_of,
    days: int = 7,
    partition_day: str | DayPartition | None = None,
) -> DataFrame:
    """``day, newRegCount, totalMemberCount, totalOrderCount, gmv`` for window
    days with both registrations and orders, ordered by day.

    totalMemberCount / totalOrderCount are the day's highest ids; gmv = all
    orders before the window + amounts of the listed days so far.  Members
    before the window are not read.  The window starts at the instant
    ``as_of - days``: of a day it cuts, the later part is listed and the
    earlier part is prior.
    """
    start = days_before(as_of, days)
    daily = daily_activity(members, orders, members_since=start, partition_day=partition_day, edge=start)
    return _report(daily, as_of, days)


def growth_report_complete_from_daily(daily: DataFrame, *, as_of, days: int = 7) -> DataFrame:
    """:func:`growth_report_complete` from a :func:`daily_activity` summary
    (``as_of`` at midnight)."""
    require_midnight(as_of)
    return _report_complete(daily, as_of, days)


def _report_complete(daily: DataFrame, as_of, days: int) -> DataFrame:
    """The window's days are added as marker rows with zero activity; running
    totals use a RANGE frame, so a marker row sees every row of its own day,
    and only the marker rows are kept: every window day appears once, with
    or without activity, and no second aggregate is needed.
    """
    start = days_before(as_of, days)
    spark = daily.sparkSession
    listed = days if is_midnight(as_of) else days + 1  # a cut day shows at both ends
    marks = spark.range(0, listed, 1, numPartitions=1).select(
        F.date_add(date_lit(start), F.col("id").cast("int")).alias("d"),
        F.lit(0).cast("bigint").alias("new_members"),
        F.lit(0).cast("bigint").alias("orders"),
        F.lit(None).cast(daily.schema["amount"].dataType).alias("amount"),
        F.lit(None).cast("double").alias("big_amount"),
        F.lit(True).alias("mark"),
    )
    rows = (
        daily.filter(F.col("d") < date_lit(days_before(start, -listed)))
        .select("d", "new_members", "orders", "amount", "big_amount", F.lit(False).alias("mark"))
        .unionByName(marks)
    )
    so_far = Window.orderBy("d").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    same_day = Window.orderBy("d").rangeBetween(Window.currentRow, Window.currentRow)
    exact, big = _running_money(so_far)
    return (
        rows.select(
            "d",
            "mark",
            F.sum("new_members").over(same_day).alias("reg"),
            F.sum("new_members").over(so_far).alias("members_so_far"),
            F.sum("orders").over(so_far).alias("orders_so_far"),
            exact.alias("gmv_so_far"),
            big.alias("big_so_far"),
        )
        .filter(F.col("mark"))
        .orderBy("d")
        .select(
            day_label(F.col("d")).alias("day"),
            F.col("reg").cast("bigint").alias("newRegCount"),
            F.col("members_so_far").cast("bigint").alias("totalMemberCount"),
            F.col("orders_so_far").cast("bigint").alias("totalOrderCount"),
            money_out(F.col("gmv_so_far"), F.col("big_so_far")).alias("gmv"),
        )
    )


def growth_report_complete(
    members: DataFrame,
    orders: DataFrame,
    *,
    as_of,
    days: int = 7,
    partition_day: str | DayPartition | None = None,
) -> DataFrame:
    """The corrected report: every day in ``[as_of - days, as_of)``.

    ``newRegCount`` members registered that day; ``totalMemberCount``,
    ``totalOrderCount`` and ``gmv`` count all members / orders / amounts up
    to the end of that day.  Days without activity show zeros.  Both bounds
    are instants: of a day they cut, only the part inside is counted.
    """
    daily = daily_activity(
        members, orders, until=as_of, partition_day=partition_day, edge=days_before(as_of, days)
    )
    return _report_complete(daily, as_of, days)
