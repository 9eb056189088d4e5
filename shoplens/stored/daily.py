"""Per-day summaries kept in a snapshot table, one part per month.

A day is computed anew from its rows and takes the place of the stored one;
a day without rows leaves the summary.  All days of a call switch together.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shoplens.functions.timewin import DayPartition, as_datetime, date_lit, days_before, time_window
from shoplens.operators.coupons import daily_coupons
from shoplens.operators.growth import daily_activity
from shoplens.sources.snapshots import SnapshotTable, nullable

MONTH = "yyyy-MM"


def _months(first: dt.datetime, last: dt.datetime) -> list[str]:
    from_month, to_month = 12 * first.year + first.month - 1, 12 * last.year + last.month - 1
    return [f"{m // 12:04d}-{m % 12 + 1:02d}" for m in range(from_month, to_month + 1)]


class DailySummary:
    """A summary with one row per calendar day ``d``, made by ``summarise(*tables)``."""

    def __init__(self, spark: SparkSession, path: str, summarise: Callable[..., DataFrame]):
        self.table, self.summarise = SnapshotTable(spark, path), summarise

    def rebuild(self, *tables: DataFrame) -> int:
        """Compute every day; days that are stored but have no rows any more are gone."""
        return self.table.replace(self.summarise(*tables), F.date_format("d", MONTH))

    def replace_days(
        self, first, last, *tables: DataFrame, partition_day: str | DayPartition | None = None
    ) -> int:
        """Compute the days from ``first`` to ``last`` and put them in place of the stored ones."""
        first, last = as_datetime(first), as_datetime(last)
        base = self.table.manifest()
        window = time_window(first, days_before(last, -1), partition_day=partition_day)
        rows = self.summarise(*[t.filter(window) for t in tables])
        months = _months(first, last)
        if base is not None:
            d = F.col("d")
            stored = self.table.read(months, base["version"])
            rows = stored.filter(~d.between(date_lit(first), date_lit(last))).unionByName(rows)
        staged = self.table.stage(rows, F.date_format("d", MONTH))
        return self.table.commit(staged, nullable(rows.schema), months, base)

    def read(self, since=None, version: int | None = None) -> DataFrame:
        """The summary; with ``since`` only the months from that day's on are read."""
        if since is None:
            return self.table.read(version=version)
        first = as_datetime(since).strftime("%Y-%m")
        return self.table.read([p for p in self.table.parts(version) if p >= first], version)


def growth_summary(spark: SparkSession, path: str) -> DailySummary:
    """``daily_activity(members, orders)`` by day, for the growth and two-week reports."""
    return DailySummary(spark, path, daily_activity)


def coupon_summary(spark: SparkSession, path: str) -> DailySummary:
    """``daily_coupons(coupons)`` by day, for the coupon series."""
    return DailySummary(spark, path, daily_coupons)


def read_daily(spark: SparkSession, path: str, since=None) -> DataFrame:
    """A stored per-day summary: a snapshot table, or a plain Parquet folder of one."""
    kept = DailySummary(spark, path, daily_activity)
    return kept.read(since) if kept.table.exists() else spark.read.parquet(path)
