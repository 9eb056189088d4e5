"""Small in-memory tables with the canonical schemas."""

import datetime as dt

from shoplens.schemas import COUPON_MEMBER, MEMBER, ORDER, SEARCH_LOG

T0 = dt.datetime(2019, 11, 1)


def ts(day: int, hour: int = 0, minute: int = 0, second: int = 0, base=T0) -> dt.datetime:
    return base + dt.timedelta(days=day, hours=hour, minutes=minute, seconds=second)


def members_df(spark, rows):
    """rows: (id, sex, channel, mp_open_id, phone, create_time)"""
    return spark.createDataFrame(rows, MEMBER)


def orders_df(spark, rows):
    """rows: (order_id, member_id, status, price, create_time)"""
    return spark.createDataFrame(rows, ORDER)


def coupons_df(spark, rows):
    """rows: (member_id, coupon_id, channel, create_time)"""
    return spark.createDataFrame(rows, COUPON_MEMBER)


def log_df(spark, lines):
    return spark.createDataFrame([(x,) for x in lines], SEARCH_LOG)


def rows(df, order_by=None):
    if order_by:
        df = df.orderBy(*order_by)
    return [tuple(r) for r in df.collect()]
