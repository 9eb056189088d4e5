"""Member distributions, member "heat" and the combined overview report.

Distributions group by low-cardinality codes, so the partial (map-side)
aggregate leaves at most one row per code per task before the shuffle; a code
holding a third of all members costs nothing extra.  One-row results are
combined with scalar subqueries, never with a join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shoplens.operators.activity import KNOWN_COUPON_HOLDER, member_activity

_MISSING = "null"  # the sentinel text the member table uses for "absent"


def member_sex_distribution(members: DataFrame) -> DataFrame:
    """Members per sex code: ``memberSex``, ``sexCount``."""
    return members.groupBy(F.col("sex").alias("memberSex")).agg(
        F.count("id").alias("sexCount")
    )


def member_channel_distribution(members: DataFrame) -> DataFrame:
    """Members per acquisition channel: ``memberChannel``, ``channelCount``."""
    return members.groupBy(F.col("member_channel").alias("memberChannel")).agg(
        F.count("id").alias("channelCount")
    )


def member_subscription_split(members: DataFrame) -> DataFrame:
    """One row: members subscribed to the media platform and not.

    The text ``'null'`` marks "not subscribed"; a SQL NULL counts in neither.
    """
    open_id = F.col("mp_open_id")
    return members.agg(
        F.count(F.when(open_id != _MISSING, True)).alias("subCount"),
        F.count(F.when(open_id == _MISSING, True)).alias("unSubCount"),
    )


def _registration_counts(members: DataFrame, null_as_missing: bool) -> DataFrame:
    phone = F.col("phone")
    missing = phone == _MISSING
    if null_as_missing:
        missing = missing | phone.isNull()
    return members.agg(
        F.count(F.when(missing, True)).alias("reg"),
        F.count(F.when(phone != _MISSING, True)).alias("complete"),
    )


def _activity_counts(orders: DataFrame, coupons: DataFrame, status: int | None, bucketed: bool = False) -> DataFrame:
    """One row: ``order``, ``orderAgain`` (members with exactly one / at least
    two orders) and ``coupon`` (distinct members holding a coupon)."""
    if status is not None:
        orders = orders.filter(F.col("order_status") == status)
    return member_activity(orders, coupons, bucketed=bucketed).agg(
        F.expr("count(CASE WHEN n = 1 THEN true END) AS `order`"),
        F.expr("count(CASE WHEN n >= 2 THEN true END) AS orderAgain"),
        F.expr(f"count(CASE WHEN {KNOWN_COUPON_HOLDER} THEN true END) AS coupon"),
    )


def _one_row(df: DataFrame) -> Column:
    """A one-row DataFrame as a scalar struct column."""
    return df.select(F.struct(*[F.col(c) for c in df.columns])).scalar()


def member_heat(
    members: DataFrame,
    orders: DataFrame,
    coupons: DataFrame,
    *,
    status: int | None = None,
    null_as_missing: bool = False,
    bucketed: bool = False,
) -> DataFrame:
    """One row: ``coupon, reg, complete, order, orderAgain``.

    - coupon: distinct members holding any coupon;
    - reg / complete: members without / with a phone (``'null'`` = without);
    - order / orderAgain: members with exactly one / at least two orders
      (any status unless ``status`` is given).

    ``bucketed``: orders and coupons are stored bucketed alike by
    ``member_id``, so nothing is shuffled by member.
    """
    rc = _registration_counts(members, null_as_missing)
    act = _one_row(_activity_counts(orders, coupons, status, bucketed))
    # the activity struct is one subquery, referenced once, then unpacked
    return rc.select("reg", "complete", act.alias("a")).select(
        "a.coupon", "reg", "complete", "a.order", "a.orderAgain"
    )


def member_overview(
    members: DataFrame,
    orders: DataFrame,
    coupons: DataFrame,
    **heat_options,
) -> DataFrame:
    """The four member reports as one row, plus the row as JSON text.

    Columns: ``memberSexs`` and ``memberChannels`` (arrays of structs sorted
    by code), ``memberMpSubs`` (array of one struct), ``memberHeat`` (struct)
    and ``report`` (the same as one JSON document).

    The member table is scanned once: grouping sets compute the per-sex and
    per-channel counts and the table-wide counts in one aggregate, whose
    result has one row per distinct code.  The arrays are built from that
    small result, so ``collect_list`` holds at most one entry per code.
    """
    missing = "phone = 'null'"
    if heat_options.get("null_as_missing"):
        missing = "(phone = 'null' OR phone IS NULL)"
    grouped = members.groupingSets([["sex"], ["member_channel"], []], "sex", "member_channel").agg(
        *[
            F.expr(e)
            for e in (
                "grouping_id() AS gid",
                "count(id) AS n",
                "count(CASE WHEN mp_open_id != 'null' THEN true END) AS subCount",
                "count(CASE WHEN mp_open_id = 'null' THEN true END) AS unSubCount",
                f"count(CASE WHEN {missing} THEN true END) AS reg",
                "count(CASE WHEN phone != 'null' THEN true END) AS complete",
            )
        ]
    )
    # grouping_id: 1 = per sex (channel rolled up), 2 = per channel, 3 = all
    row = grouped.agg(
        *[
            F.expr(e)
            for e in (
                "array_sort(collect_list(CASE WHEN gid = 1 THEN"
                " named_struct('memberSex', sex, 'sexCount', n) END)) AS memberSexs",
                "array_sort(collect_list(CASE WHEN gid = 2 THEN"
                " named_struct('memberChannel', member_channel, 'channelCount', n) END)) AS memberChannels",
                "collect_list(CASE WHEN gid = 3 THEN"
                " named_struct('subCount', subCount, 'unSubCount', unSubCount) END) AS memberMpSubs",
                "max(CASE WHEN gid = 3 THEN reg END) AS reg",
                "max(CASE WHEN gid = 3 THEN complete END) AS complete",
            )
        ]
    )
    act = _one_row(_activity_counts(orders, coupons, heat_options.get("status"), heat_options.get("bucketed", False)))
    heat = F.struct(
        F.col("a.coupon").alias("coupon"),
        F.col("reg"),
        F.col("complete"),
        F.col("a.order").alias("order"),
        F.col("a.orderAgain").alias("orderAgain"),
    )
    parts = ["memberSexs", "memberChannels", "memberMpSubs", "memberHeat"]
    out = row.select("*", act.alias("a")).select(
        "memberSexs", "memberChannels", "memberMpSubs", heat.alias("memberHeat")
    )
    return out.withColumn("report", F.to_json(F.struct(*parts)))
