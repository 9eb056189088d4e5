"""Per-member facts from the order and coupon tables in one aggregate.

Several reports need, for every member, facts from both tables (how many
orders, whether any coupon).  Instead of aggregating each table separately
and joining the results, the rows of both tables are unioned and grouped by
``member_id`` once: a single shuffle, fed by the partial aggregate (so a
member with a third of all rows is one row per task), and no join, sort or
broadcast.  Callers filter each table first (order status, coupon kind).

Where both tables are stored bucketed by ``member_id`` (see
``sources.tables.write_table``), ``bucketed=True`` needs no shuffle at all: each
table is aggregated inside its buckets, and buckets of one number are joined
with each other, one row per member on either side.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _bucketed_activity(orders: DataFrame, coupons: DataFrame) -> DataFrame:
    o = orders.groupBy("member_id").agg(F.expr("count(order_id) AS n"), F.expr("true AS ordered"))
    c = coupons.groupBy("member_id").agg(F.expr("true AS coupon"))
    return o.join(c, "member_id", "full").selectExpr(
        "member_id", "coalesce(n, 0L) AS n", "coalesce(ordered, false) AS ordered", "coalesce(coupon, false) AS coupon"
    )


def member_activity(orders: DataFrame, coupons: DataFrame, *, bucketed: bool = False) -> DataFrame:
    """One row per ``member_id`` present in either input (one NULL group):
    ``n`` = non-NULL order ids, ``ordered`` = any order row (with or without
    an id), ``coupon`` = any coupon row.

    ``bucketed`` says that both tables are bucketed alike by ``member_id``;
    the NULL member of the orders and that of the coupons are then two rows
    (a NULL member never matches another table).
    """
    if bucketed:
        return _bucketed_activity(orders, coupons)
    o = orders.selectExpr("member_id", "order_id", "true AS ordered", "false AS coupon")
    c = coupons.selectExpr("member_id", "CAST(NULL AS BIGINT) AS order_id", "false AS ordered", "true AS coupon")
    return (
        o.unionByName(c)
        .groupBy("member_id")
        .agg(F.expr("count(order_id) AS n"), F.expr("max(ordered) AS ordered"), F.expr("max(coupon) AS coupon"))
    )


# A real member (not the NULL group) holding a coupon: a NULL member id never
# counts as distinct and never matches another table.
KNOWN_COUPON_HOLDER = "coupon AND member_id IS NOT NULL"


def known_coupon_holder() -> Column:
    return F.expr(KNOWN_COUPON_HOLDER)
