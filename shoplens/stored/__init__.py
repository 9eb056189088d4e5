"""Stored, incrementally kept forms of the reports' inputs, each a snapshot table."""

from shoplens.stored.daily import DailySummary, coupon_summary, growth_summary, read_daily
from shoplens.stored.funnel_state import FunnelState
from shoplens.stored.member_sets import MemberSets, buyers, coupon_buyers, coupon_holders
from shoplens.stored.words import DailyWords

__all__ = [
    "DailySummary",
    "DailyWords",
    "FunnelState",
    "MemberSets",
    "buyers",
    "coupon_buyers",
    "coupon_holders",
    "coupon_summary",
    "growth_summary",
    "read_daily",
]
