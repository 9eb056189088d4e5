"""Day-partitioned tables: the window operators prune whole partitions."""

import datetime as dt
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from shoplens import operators as op
from shoplens.plans import inspect as P
from shoplens.sources import canonical as src
from tests.conftest import SF_SMALL

GROWTH = dt.datetime(2001, 7, 25)
MARKETING = dt.datetime(2024, 1, 25)


@pytest.fixture(scope="module")
def stored(spark):
    base = tempfile.mkdtemp(prefix="shoplens-pruning-")
    tables = {
        "members": src.members(spark, SF_SMALL),
        "orders": src.orders(spark, SF_SMALL),
        "coupons": src.coupon_members(spark, SF_SMALL),
    }
    out = {}
    for name, df in tables.items():
        path = os.path.join(base, name)
        df.withColumn("dt", F.to_date("create_time")).write.partitionBy("dt").parquet(path)
        out[name] = (df, spark.read.parquet(path))
    return out


CASES = {
    "growth_daily_orders": lambda t, pd: op.growth_daily_orders(t["orders"], as_of=GROWTH, partition_day=pd),
    "growth_prior_gmv": lambda t, pd: op.growth_prior_gmv(t["orders"], as_of=GROWTH, partition_day=pd),
    "wow_daily_registrations": lambda t, pd: op.wow_daily_registrations(t["members"], as_of=GROWTH, partition_day=pd),
    "marketing_paid_coupons": lambda t, pd: op.marketing_paid_coupons(t["coupons"], as_of=MARKETING, partition_day=pd),
    "growth_report": lambda t, pd: op.growth_report(t["members"], t["orders"], as_of=GROWTH, partition_day=pd),
    "growth_report_complete": lambda t, pd: op.growth_report_complete(
        t["members"], t["orders"], as_of=GROWTH, partition_day=pd
    ),
}


@pytest.mark.parametrize("name", sorted(CASES))
def test_partition_filters_same_results(spark, stored, name):
    plain = {k: v[0] for k, v in stored.items()}
    parted = {k: v[1] for k, v in stored.items()}
    want = sorted(tuple(r) for r in CASES[name](plain, None).collect())
    df = CASES[name](parted, "dt")
    assert sorted(tuple(r) for r in df.collect()) == want
    plan = P.physical_plan(df)
    assert "PartitionFilters: [isnotnull(dt" in plan, plan
