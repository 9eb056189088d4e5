"""Coupon uptake per day over the last days before ``as_of``.

The window start is strict by default (``create_time > as_of - days``) and
has no upper bound, as the marketing report defines it; ``inclusive=True``
makes the start inclusive.  Each series is one filter (pushed into the scan)
and one per-day grouped count.  For repeated runs at scale the same series
come from a stored per-day summary (:func:`daily_coupons`), which also counts
the rows at each day's first instant so the strict start stays exact.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
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

FREE_COUPON_ID = 1
CHANNEL_BOUGHT = 1
CHANNEL_HANDED_OUT = 2


def _since(as_of, days: int, inclusive: bool, partition_day: str | DayPartition | None) -> Column:
    return time_window(
        days_before(as_of, days), lower_inclusive=inclusive, partition_day=partition_day
    )


def _per_day(coupons: DataFrame, cond: Column, out: str) -> DataFrame:
    t = F.col("create_time")
    return (
        coupons.filter(cond)
        .groupBy(day_key(t).alias("d"))
        .agg(F.count("member_id").alias(out))
        .select(day_label(F.col("d")).alias("day"), out)
    )


def marketing_free_coupons(
    coupons: DataFrame,
    *,
    as_of,
    days: int = 7,
    inclusive: bool = False,
    partition_day: str | DayPartition | None = None,
) -> DataFrame:
    """Free coupons handed out per day: ``day, freeCount``."""
    cond = (
        (F.col("coupon_id") == FREE_COUPON_ID)
        & (F.col("coupon_channel") == CHANNEL_HANDED_OUT)
        & _since(as_of, days, inclusive, partition_day)
    )
    return _per_day(coupons, cond, "freeCount")


def marketing_paid_coupons(
    coupons: DataFrame,
    *,
    as_of,
    days: int = 7,
    inclusive: bool = False,
    partition_day: str | DayPartition | None = None,
) -> DataFrame:
    """Other (paid) coupons obtained per day: ``day, couponCount``."""
    cond = (F.col("coupon_id") != FREE_COUPON_ID) & _since(as_of, days, inclusive, partition_day)
    return _per_day(coupons, cond, "couponCount")


# Per-day coupon summary: every column is a count, so summaries of disjoint
# rows merge by summing (merge_daily_coupons).
_KINDS = ("free", "paid")
_COUPON_DAILY = [
    f"{kind}{suffix}" for kind in _KINDS for suffix in ("_rows", "_rows_at_start", "", "_at_start")
]


def daily_coupons(coupons: DataFrame, *, partition_day: str | DayPartition | None = None, since=None) -> DataFrame:
    """Per calendar day ``d``: for free coupons handed out and for paid
    coupons, the rows, the rows at exactly the day's first instant, and the
    same two as non-NULL member counts.

    The first-instant counts let :func:`marketing_free_coupons_from_daily`
    and :func:`marketing_paid_coupons_from_daily` apply the strict window
    start exactly.  Write it once partitioned by ``d`` and merge new days in
    with :func:`merge_daily_coupons`.
    """
    if since is not None:
        coupons = coupons.filter(time_window(since, partition_day=partition_day))
    t = F.col("create_time")
    d = day_key(t)
    at_start = t == d.cast("timestamp_ntz")
    kinds = {
        "free": (F.col("coupon_id") == FREE_COUPON_ID) & (F.col("coupon_channel") == CHANNEL_HANDED_OUT),
        "paid": F.col("coupon_id") != FREE_COUPON_ID,
    }
    aggs = []
    for kind, cond in kinds.items():
        aggs += [
            F.count(F.when(cond, True)).alias(f"{kind}_rows"),
            F.count(F.when(cond & at_start, True)).alias(f"{kind}_rows_at_start"),
            F.count(F.when(cond, F.col("member_id"))).alias(kind),
            F.count(F.when(cond & at_start, F.col("member_id"))).alias(f"{kind}_at_start"),
        ]
    return coupons.groupBy(d.alias("d")).agg(*aggs).filter(F.col("d").isNotNull())


def merge_daily_coupons(*summaries: DataFrame) -> DataFrame:
    """Merge per-day coupon summaries of disjoint row sets."""
    combined = summaries[0]
    for other in summaries[1:]:
        combined = combined.unionByName(other)
    return combined.groupBy("d").agg(*[F.sum(c).alias(c) for c in _COUPON_DAILY])


def _series_from_daily(daily: DataFrame, kind: str, out: str, as_of, days: int, inclusive: bool) -> DataFrame:
    start = days_before(as_of, days)
    require_midnight(start)
    d = F.col("d")
    first = (d == date_lit(start)) & F.lit(not inclusive)
    rows = F.when(first, F.col(f"{kind}_rows") - F.col(f"{kind}_rows_at_start")).otherwise(F.col(f"{kind}_rows"))
    count = F.when(first, F.col(kind) - F.col(f"{kind}_at_start")).otherwise(F.col(kind))
    return daily.filter((d >= date_lit(start)) & (rows > 0)).select(
        day_label(d).alias("day"), count.cast("bigint").alias(out)
    )


def marketing_free_coupons_from_daily(
    daily: DataFrame, *, as_of, days: int = 7, inclusive: bool = False
) -> DataFrame:
    """:func:`marketing_free_coupons` from a :func:`daily_coupons` summary."""
    return _series_from_daily(daily, "free", "freeCount", as_of, days, inclusive)


def marketing_paid_coupons_from_daily(
    daily: DataFrame, *, as_of, days: int = 7, inclusive: bool = False
) -> DataFrame:
    """:func:`marketing_paid_coupons` from a :func:`daily_coupons` summary."""
    return _series_from_daily(daily, "paid", "couponCount", as_of, days, inclusive)
