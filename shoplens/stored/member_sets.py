"""Sets of members by day as bitmaps: distinct counts and lists over any span of days.

Kept in a snapshot table like the other per-day summaries; a day is replaced
as a whole, so it counts once however often it is run.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shoplens.functions.bitmaps import count_ids, id_bitmaps, list_ids
from shoplens.functions.timewin import date_lit
from shoplens.operators.funnel import COMPLETED, paid_coupons
from shoplens.stored.daily import DailySummary


def daily_members(rows: DataFrame) -> DataFrame:
    """``d, bucket, bits``: the members of every calendar day (rows without a time are in no day)."""
    return id_bitmaps(rows, "member_id", F.to_date("create_time").alias("d")).filter(F.col("d").isNotNull())


class MemberSets(DailySummary):
    """The members of the rows that ``chosen`` keeps, by day."""

    def __init__(self, spark: SparkSession, path: str, chosen: Callable[[DataFrame], DataFrame] = lambda rows: rows):
        super().__init__(spark, path, lambda rows: daily_members(chosen(rows)))

    def between(self, first=None, last=None) -> DataFrame:
        """The bitmaps of the days from ``first`` to ``last`` (both optional)."""
        sets = self.read(first)
        if first is not None:
            sets = sets.filter(F.col("d") >= date_lit(first))
        return sets if last is None else sets.filter(F.col("d") <= date_lit(last))

    def count(self, first=None, last=None) -> DataFrame:
        """One row ``members``: distinct members of these days, NULL left out."""
        return count_ids(self.between(first, last), "members")

    def members(self, first=None, last=None) -> DataFrame:
        """``member_id``: the distinct members of these days, one NULL included."""
        return list_ids(self.between(first, last), "member_id")


def coupon_holders(spark: SparkSession, path: str) -> MemberSets:
    """Members holding any coupon: ``count`` is ``coupon`` of ``member_heat``."""
    return MemberSets(spark, path)


def buyers(spark: SparkSession, path: str, status: int = COMPLETED) -> MemberSets:
    """Members with a completed order: ``members`` is ``funnel_buyers``."""
    return MemberSets(spark, path, lambda orders: orders.filter(F.col("order_status") == status))


def coupon_buyers(spark: SparkSession, path: str) -> MemberSets:
    """Members that bought a paid coupon: ``members`` is ``funnel_coupon_buyers``."""
    return MemberSets(spark, path, paid_coupons)
