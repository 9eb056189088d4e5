"""Purchase conversion funnel.

Every member list is aggregated per ``member_id`` before anything else, so a
member with a third of all orders is one row after the map-side partial
aggregate.  Lists that combine orders and coupons (repeat buyers who bought a
coupon, the summary) come from one aggregate over both tables' rows
(:func:`member_activity`): one shuffle and no join, so there is nothing to
skew, sort or broadcast.  ``bucketed=True`` (both tables stored bucketed alike
by ``member_id``) also saves that one shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoplens.operators.activity import known_coupon_holder, member_activity
from shoplens.operators.coupons import CHANNEL_BOUGHT, FREE_COUPON_ID

COMPLETED = 2  # order status of a completed purchase


def _completed(orders: DataFrame, status: int) -> DataFrame:
    return orders.filter(F.col("order_status") == status)


def _orders_per_buyer(orders: DataFrame, status: int) -> DataFrame:
    return _completed(orders, status).groupBy("member_id").agg(F.count("order_id").alias("n"))


def funnel_buyers(orders: DataFrame, *, status: int = COMPLETED) -> DataFrame:
    """Distinct ``member_id`` with a completed order (a NULL member is one row)."""
    return _completed(orders, status).select("member_id").distinct()


def funnel_repeat_buyers(
    orders: DataFrame, *, status: int = COMPLETED, min_orders: int = 2
) -> DataFrame:
    """``member_id`` with at least ``min_orders`` completed orders."""
    return (
        _orders_per_buyer(orders, status)
        .filter(F.col("n") >= min_orders)
        .select("member_id")
    )


def paid_coupons(coupons: DataFrame) -> DataFrame:
    return coupons.filter(
        (F.col("coupon_id") != FREE_COUPON_ID) & (F.col("coupon_channel") == CHANNEL_BOUGHT)
    )


def funnel_coupon_buyers(coupons: DataFrame) -> DataFrame:
    """Distinct ``member_id`` that bought a paid coupon."""
    return paid_coupons(coupons).select("member_id").distinct()


def _buyer_activity(orders: DataFrame, coupons: DataFrame, status: int, bucketed: bool) -> DataFrame:
    return member_activity(_completed(orders, status), paid_coupons(coupons), bucketed=bucketed)


def funnel_repeat_and_coupon(
    orders: DataFrame, coupons: DataFrame, *, status: int = COMPLETED, min_orders: int = 2, bucketed: bool = False
) -> DataFrame:
    """Repeat buyers who also bought a paid coupon (NULL never matches)."""
    return (
        _buyer_activity(orders, coupons, status, bucketed)
        .filter((F.col("n") >= min_orders) & known_coupon_holder())
        .select("member_id")
    )


def funnel_summary(
    orders: DataFrame,
    coupons: DataFrame,
    *,
    view: int = 1000,
    click: int = 800,
    status: int = COMPLETED,
    min_orders: int = 2,
    bucketed: bool = False,
) -> DataFrame:
    """One row: ``view, click, order, orderAgain, chargeCoupon``.

    view and click are supplied counts (the shop has no page log); the rest
    come from one plan over per-member activity: buyers (any completed order
    row, as ``funnel_buyers``; one NULL buyer counts once, as DISTINCT does), repeat buyers, and repeat buyers holding
    a paid coupon.
    """
    n = F.col("n")
    repeat = n >= min_orders
    return _buyer_activity(orders, coupons, status, bucketed).agg(
        F.lit(view).cast("bigint").alias("view"),
        F.lit(click).cast("bigint").alias("click"),
        F.count(F.when(F.col("ordered"), True)).alias("order"),
        F.count(F.when(repeat, True)).alias("orderAgain"),
        F.count(F.when(repeat & known_coupon_holder(), True)).alias("chargeCoupon"),
    )
