"""Every report as a named query over a directory of test tables.

Each query takes ``(spark, base_dir)`` and returns a lazy DataFrame over the
whole tables in ``base_dir``.  As-of dates are chosen inside the data's time
range: orders run 1995-01-01 to 2001-08-01, events 2024-01-01 to 2024-01-30.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from shoplens import operators as op
from shoplens.sources import canonical as src
from shoplens.sources.readers import read_parquet_table

GROWTH_AS_OF = dt.datetime(2001, 7, 25)
MARKETING_AS_OF = dt.datetime(2024, 1, 25)
CALENDAR_REFERENCE = dt.date(2024, 6, 30)
# one shift per calendar unit
ALL_SHIFTS = (
    ("next_year", "year", 1),
    ("next_month", "month", 1),
    ("week_before", "day", -7),
    ("hours_on", "hour", 36),
    ("minutes_before", "minute", -90),
    ("seconds_on", "second", 4000),
)

Query = Callable[[SparkSession, str], DataFrame]


def _members(spark, d):
    return src.members(spark, d)


def _orders(spark, d):
    return src.orders(spark, d)


def _coupons(spark, d):
    return src.coupon_members(spark, d)


def _calendar(spark, d):
    events = read_parquet_table(spark, d, "events").select("event_id", "ts")
    return op.calendar_enrich(events, "ts", reference_date=CALENDAR_REFERENCE, shifts=ALL_SHIFTS)


def _standardised(spark, d):
    return op.date_standardise(
        src.date_strings(spark, d),
        "ds",
        target_style={"ds_std": "YYYY_MM_DD_HH_MM_SS", "ds_date": "YYYY_MM_DD", "ds_time": "HH_MM_SS"},
        shift_in_style=(("ds_next_day", "day", 1), ("ds_earlier", "minute", -90)),
    )


QUERIES: dict[str, Query] = {
    "member_sex_distribution": lambda s, d: op.member_sex_distribution(_members(s, d)),
    "member_channel_distribution": lambda s, d: op.member_channel_distribution(_members(s, d)),
    "member_subscription_split": lambda s, d: op.member_subscription_split(_members(s, d)),
    "member_heat": lambda s, d: op.member_heat(_members(s, d), _orders(s, d), _coupons(s, d)),
    # the report document, as the overview job prints it
    "member_overview": lambda s, d: op.member_overview(
        _members(s, d), _orders(s, d), _coupons(s, d)
    ).select("report"),
    "growth_daily_registrations": lambda s, d: op.growth_daily_registrations(
        _members(s, d), as_of=GROWTH_AS_OF
    ),
    "growth_daily_orders": lambda s, d: op.growth_daily_orders(_orders(s, d), as_of=GROWTH_AS_OF),
    "growth_prior_gmv": lambda s, d: op.growth_prior_gmv(_orders(s, d), as_of=GROWTH_AS_OF),
    "growth_report": lambda s, d: op.growth_report(
        _members(s, d), _orders(s, d), as_of=GROWTH_AS_OF
    ),
    "growth_report_complete": lambda s, d: op.growth_report_complete(
        _members(s, d), _orders(s, d), as_of=GROWTH_AS_OF
    ),
    "wow_daily_registrations": lambda s, d: op.wow_daily_registrations(
        _members(s, d), as_of=GROWTH_AS_OF
    ),
    "wow_daily_orders": lambda s, d: op.wow_daily_orders(_orders(s, d), as_of=GROWTH_AS_OF),
    "marketing_free_coupons": lambda s, d: op.marketing_free_coupons(
        _coupons(s, d), as_of=MARKETING_AS_OF
    ),
    "marketing_paid_coupons": lambda s, d: op.marketing_paid_coupons(
        _coupons(s, d), as_of=MARKETING_AS_OF
    ),
    "funnel_buyers": lambda s, d: op.funnel_buyers(_orders(s, d)),
    "funnel_repeat_buyers": lambda s, d: op.funnel_repeat_buyers(_orders(s, d)),
    "funnel_coupon_buyers": lambda s, d: op.funnel_coupon_buyers(_coupons(s, d)),
    "funnel_repeat_and_coupon": lambda s, d: op.funnel_repeat_and_coupon(
        _orders(s, d), _coupons(s, d)
    ),
    "funnel_summary": lambda s, d: op.funnel_summary(_orders(s, d), _coupons(s, d)),
    "search_word_counts": lambda s, d: op.search_word_counts(src.search_log(s, d)),
    "search_hot_words": lambda s, d: op.search_hot_words(src.search_log(s, d), k=10),
    "date_standardise": _standardised,
    "date_quality": lambda s, d: op.date_quality(src.date_strings(s, d), "ds"),
    "calendar_enrich": _calendar,
}

# The headline queries the bench times (one per report family).
HEADLINE = (
    "member_overview",
    "growth_report",
    "growth_report_complete",
    "funnel_summary",
    "search_hot_words",
    "date_standardise",
)
