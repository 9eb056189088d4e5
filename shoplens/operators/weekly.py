"""Two-week daily series for week-over-week comparison.

The window is the half-open ``[as_of - days, as_of)``; both bounds are typed
literals on the raw timestamp and reach the Parquet scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoplens.functions.timewin import (
    DayPartition,
    date_lit,
    day_key,
    day_label,
    days_before,
    require_midnight,
    time_window,
)


def _daily_count(
    df: DataFrame, key: str, out: str, as_of, days: int, partition_day: str | DayPartition | None
) -> DataFrame:
    t = F.col("create_time")
    return (
        df.filter(time_window(days_before(as_of, days), as_of, partition_day=partition_day))
        .groupBy(day_key(t).alias("d"))
        .agg(F.count(key).alias(out))
        # at most one row per window day: one partition sorts it without a range shuffle
        .coalesce(1)
        .sortWithinPartitions("d")
        .select(day_label(F.col("d")).alias("day"), out)
    )


def wow_daily_registrations(
    members: DataFrame, *, as_of, days: int = 14, partition_day: str | DayPartition | None = None
) -> DataFrame:
    """Members registered per day: ``day, regCount``, ordered by day."""
    return _daily_count(members, "id", "regCount", as_of, days, partition_day)


def wow_daily_orders(
    orders: DataFrame, *, as_of, days: int = 14, partition_day: str | DayPartition | None = None
) -> DataFrame:
    """Orders placed per day: ``day, orderCount``, ordered by day."""
    return _daily_count(orders, "order_id", "orderCount", as_of, days, partition_day)


def _from_daily(daily: DataFrame, rows: str, count: str, out: str, as_of, days: int) -> DataFrame:
    require_midnight(as_of)
    d = F.col("d")
    return (
        daily.filter((d >= date_lit(days_before(as_of, days))) & (d < date_lit(as_of)) & (F.col(rows) > 0))
        .coalesce(1)
        .sortWithinPartitions("d")
        .select(day_label(d).alias("day"), F.col(count).alias(out))
    )


def wow_daily_registrations_from_daily(daily: DataFrame, *, as_of, days: int = 14) -> DataFrame:
    """:func:`wow_daily_registrations` from a ``daily_activity`` summary."""
    return _from_daily(daily, "member_rows", "new_members", "regCount", as_of, days)


def wow_daily_orders_from_daily(daily: DataFrame, *, as_of, days: int = 14) -> DataFrame:
    """:func:`wow_daily_orders` from a ``daily_activity`` summary."""
    return _from_daily(daily, "order_rows", "orders", "orderCount", as_of, days)
