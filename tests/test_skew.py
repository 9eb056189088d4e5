"""A member holding a third of all orders and coupons: exact results.

The plans pre-aggregate before every shuffle (test_plans), so a hot member is
one row per task when it crosses the network; here the answers are checked
against a brute-force computation in pandas on the same rows.
"""

import pandas as pd
from pyspark.sql import functions as F

from shoplens import operators as op
from shoplens.sources import canonical as src
from tests.conftest import SF_SMALL

HOT = 7


def _skewed(spark):
    o = src.orders(spark, SF_SMALL).withColumn(
        "member_id", F.when(F.col("order_id") % 3 == 0, F.lit(HOT)).otherwise(F.col("member_id"))
    )
    c = src.coupon_members(spark, SF_SMALL)
    c = c.withColumn("member_id", F.when(F.rand(1) < 1 / 3, F.lit(HOT)).otherwise(F.col("member_id")))
    # freeze the random choice so Spark and pandas see the same rows
    return o, spark.createDataFrame(c.toPandas(), c.schema)


def test_hot_member_funnel_and_heat(spark):
    o, c = _skewed(spark)
    po, pc = o.toPandas(), c.toPandas()
    assert (po.member_id == HOT).mean() > 0.3

    done = po[po.order_status == 2]
    per = done.groupby("member_id", dropna=False).order_id.count()
    paid = set(pc[(pc.coupon_id != 1) & (pc.coupon_channel == 1)].member_id.dropna())
    repeat = per[per >= 2]
    want = (
        1000,
        800,
        done.member_id.nunique(dropna=False),
        len(repeat),
        sum(1 for m in repeat.index if pd.notna(m) and m in paid),
    )
    assert tuple(op.funnel_summary(o, c).first()) == want

    per_all = po.groupby("member_id", dropna=False).order_id.count()
    heat = op.member_heat(src.members(spark, SF_SMALL), o, c).first()
    assert (heat["order"], heat["orderAgain"]) == ((per_all == 1).sum(), (per_all >= 2).sum())
    assert heat["coupon"] == pc.member_id.nunique()


def test_hot_word(spark):
    log = src.search_log(spark, SF_SMALL)
    hot = log.withColumn(
        "value", F.when(F.rand(2) < 0.34, F.lit("0\t0\thot_word\t1")).otherwise(F.col("value"))
    )
    hot = spark.createDataFrame(hot.toPandas(), hot.schema)
    lines = hot.toPandas().value
    words = lines.str.split("\t").str[2]
    want = words[words.notna() & (words != "")].value_counts()
    got = op.search_hot_words(hot, k=3).collect()
    assert got[0]["word"] == "hot_word" and got[0]["cnt"] == want["hot_word"]
