"""Catalog tables as sinks, partition pruning from the catalog, and reports over bucketed tables."""

import re
import tempfile
import uuid

import pytest
from pyspark.sql import functions as F

from shoplens import jobs
from shoplens import operators as op
from shoplens.plans import inspect as P
from shoplens.sources import canonical as src
from shoplens.sources.readers import read_catalog_table
from shoplens.sources.tables import OVERWRITE_MODE, bucketed_alike, bucketing, write_table
from tests.conftest import SF_ORACLE
from tests.helpers import coupons_df, members_df, orders_df, ts


@pytest.fixture
def database(spark):
    """A database of the session's in-memory catalog, in a fresh folder."""
    name = f"shop_{uuid.uuid4().hex[:8]}"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{tempfile.mkdtemp(prefix='shoplens-db-')}'")
    return name


def found(df):
    return sorted(map(tuple, df.collect()), key=repr)


def days(spark, *pairs):
    return spark.createDataFrame(list(pairs), "day string, n long")


def test_whole_tables_and_single_partitions_are_replaced(spark, database):
    table, before = f"{database}.by_day", spark.conf.get(OVERWRITE_MODE)
    write_table(days(spark, ("a", 1), ("b", 2)), table, ["day"])
    write_table(days(spark, ("b", 5)).select("day", "n"), table, keep_other_partitions=True)
    assert found(spark.table(table).select("day", "n")) == [("a", 1), ("b", 5)]
    write_table(days(spark, ("c", 7)), table)
    assert found(spark.table(table).select("day", "n")) == [("c", 7)]
    assert spark.conf.get(OVERWRITE_MODE) == before
    with pytest.raises(ValueError, match="column n"):
        write_table(days(spark, ("c", 7)).drop("n"), table)


def test_catalog_partitions_are_pruned(spark, database):
    table = f"{database}.t_order"
    o = src.orders(spark, SF_ORACLE).filter("create_time >= TIMESTAMP_NTZ '2001-06-01'")
    write_table(o.withColumn("dt", F.to_date("create_time")), table, ["dt"])
    stored = read_catalog_table(spark, table)
    df = op.wow_daily_orders(stored, as_of="2001-07-25", partition_day="dt")
    assert found(df) == found(op.wow_daily_orders(o, as_of="2001-07-25"))
    plan = P.physical_plan(df)
    assert "PartitionFilters: [isnotnull(dt" in plan
    # after planning the scan lists the window's partitions only
    kept = [int(n) for n in re.findall(r"InMemoryFileIndex\((\d+) paths", plan)]
    assert kept and max(kept) <= 15 < stored.select("dt").distinct().count()


def bucketed_shop(spark, database, o, c, buckets=8):
    write_table(o, f"{database}.t_order", bucket_by="member_id", buckets=buckets)
    write_table(c, f"{database}.t_coupon_member", bucket_by="member_id", buckets=buckets)
    return spark.table(f"{database}.t_order"), spark.table(f"{database}.t_coupon_member")


def shuffles(df) -> int:
    return P.count_nodes(df, r"hashpartitioning")


def test_bucketed_tables_need_no_shuffle_by_member(spark, database):
    m, o, c = src.members(spark, SF_ORACLE), src.orders(spark, SF_ORACLE), src.coupon_members(spark, SF_ORACLE)
    bo, bc = bucketed_shop(spark, database, o, c)
    assert bucketing(spark, f"{database}.t_order") == ("member_id", 8)
    assert bucketed_alike(spark, "member_id", f"{database}.t_order", f"{database}.t_coupon_member")
    assert len(bo.inputFiles()) <= 8
    pairs = [
        (op.member_heat(m, bo, bc, bucketed=True), op.member_heat(m, o, c)),
        (op.member_heat(m, bo, bc, status=2, bucketed=True), op.member_heat(m, o, c, status=2)),
        (op.funnel_summary(bo, bc, bucketed=True), op.funnel_summary(o, c)),
        (op.funnel_repeat_and_coupon(bo, bc, bucketed=True), op.funnel_repeat_and_coupon(o, c)),
        (op.funnel_buyers(bo), op.funnel_buyers(o)),
        (op.funnel_repeat_buyers(bo), op.funnel_repeat_buyers(o)),
    ]
    for bucketed, plain in pairs:
        assert shuffles(bucketed) == 0, P.physical_plan(bucketed)
        assert shuffles(plain) > 0
        assert found(bucketed) == found(plain)
    wide = op.member_overview(m, bo, bc, bucketed=True)
    assert found(wide.select("report")) == found(op.member_overview(m, o, c).select("report"))


def test_bucketed_tables_with_null_members(spark, database):
    o = orders_df(spark, [(1, None, 2, 1.0, ts(0)), (2, None, 2, 1.0, ts(0)), (3, 5, 2, 1.0, ts(0)), (None, 6, 2, 1.0, ts(0))])
    c = coupons_df(spark, [(None, 2, 1, ts(0)), (5, 2, 1, ts(0)), (9, 2, 1, ts(0))])
    m = members_df(spark, [(5, 1, 1, "x", "x", ts(0))])
    bo, bc = bucketed_shop(spark, database, o, c, 3)
    assert found(op.member_heat(m, bo, bc, bucketed=True)) == found(op.member_heat(m, o, c))
    assert found(op.funnel_summary(bo, bc, bucketed=True)) == found(op.funnel_summary(o, c))
    # a rerun into the existing tables keeps buckets and rows
    write_table(o, f"{database}.t_order")
    assert bucketing(spark, f"{database}.t_order") == ("member_id", 3)
    assert found(op.funnel_buyers(spark.table(f"{database}.t_order"))) == found(op.funnel_buyers(o))


def test_unlike_buckets_are_seen(spark, database):
    o, c = src.orders(spark, SF_ORACLE).limit(10), src.coupon_members(spark, SF_ORACLE).limit(10)
    write_table(o, f"{database}.t_order", bucket_by="member_id", buckets=4)
    write_table(c, f"{database}.t_coupon_member", bucket_by="member_id", buckets=8)
    write_table(c, f"{database}.plain")
    for other in ("t_coupon_member", "plain"):
        assert not bucketed_alike(spark, "member_id", f"{database}.t_order", f"{database}.{other}")
    with pytest.raises(ValueError):
        write_table(o, f"{database}.more", bucket_by="member_id")


def test_jobs_read_bucketed_and_write_catalog_tables(spark, database):
    o, c = src.orders(spark, SF_ORACLE), src.coupon_members(spark, SF_ORACLE)
    bucketed_shop(spark, database, o, c)
    assert jobs.main(["conversion", "--catalog", database, "--table", f"{database}.funnel"]) == 0
    assert found(spark.table(f"{database}.funnel")) == found(op.funnel_summary(o, c))
    args = ["marketing", "--catalog", database, "--table", f"{database}.coupons", "--table-partition", "day"]
    for as_of in ("2024-01-15", "2024-01-25"):
        assert jobs.main([*args, "--as-of", as_of]) == 0
    free = spark.table(f"{database}.coupons_free").select("day", "freeCount")
    # the second run has the later days; the first one's earlier days stay
    early, late = (found(op.marketing_free_coupons(c, as_of=a)) for a in ("2024-01-15", "2024-01-25"))
    assert found(free) == sorted(set(late) | {r for r in early if r[0] not in dict(late)}, key=repr)
