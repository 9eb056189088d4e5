"""Report operators: DataFrames in, DataFrame out, built-in expressions only."""

from shoplens.operators.activity import member_activity
from shoplens.operators.coupons import (
    daily_coupons,
    marketing_free_coupons,
    marketing_free_coupons_from_daily,
    marketing_paid_coupons,
    marketing_paid_coupons_from_daily,
    merge_daily_coupons,
)
from shoplens.operators.dates import calendar_enrich, date_quality, date_standardise
from shoplens.operators.funnel import (
    funnel_buyers,
    funnel_coupon_buyers,
    funnel_repeat_and_coupon,
    funnel_repeat_buyers,
    funnel_summary,
)
from shoplens.operators.growth import (
    daily_activity,
    growth_daily_orders,
    growth_daily_registrations,
    growth_prior_gmv,
    growth_report,
    growth_report_complete,
    growth_report_complete_from_daily,
    growth_report_from_daily,
    merge_daily,
)
from shoplens.operators.members import (
    member_channel_distribution,
    member_heat,
    member_overview,
    member_sex_distribution,
    member_subscription_split,
)
from shoplens.operators.search import search_hot_words, search_word_counts, search_words
from shoplens.operators.weekly import (
    wow_daily_orders,
    wow_daily_orders_from_daily,
    wow_daily_registrations,
    wow_daily_registrations_from_daily,
)

__all__ = [
    "calendar_enrich",
    "daily_activity",
    "daily_coupons",
    "date_quality",
    "date_standardise",
    "funnel_buyers",
    "funnel_coupon_buyers",
    "funnel_repeat_and_coupon",
    "funnel_repeat_buyers",
    "funnel_summary",
    "growth_daily_orders",
    "growth_daily_registrations",
    "growth_prior_gmv",
    "growth_report",
    "growth_report_complete",
    "growth_report_complete_from_daily",
    "growth_report_from_daily",
    "marketing_free_coupons",
    "marketing_free_coupons_from_daily",
    "marketing_paid_coupons",
    "marketing_paid_coupons_from_daily",
    "member_channel_distribution",
    "member_heat",
    "member_activity",
    "member_overview",
    "member_sex_distribution",
    "merge_daily",
    "merge_daily_coupons",
    "member_subscription_split",
    "search_hot_words",
    "search_word_counts",
    "search_words",
    "wow_daily_orders",
    "wow_daily_orders_from_daily",
    "wow_daily_registrations",
    "wow_daily_registrations_from_daily",
]
