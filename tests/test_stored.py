"""Snapshot tables, the per-day summaries and the funnel state kept in them."""

import datetime as dt
import os
import random
import tempfile

import pytest
from pyspark.sql import functions as F

from shoplens import jobs
from shoplens import operators as op
from shoplens.sources import canonical as src
from shoplens.sources.snapshots import SnapshotConflict, SnapshotTable, nullable
from shoplens.stored import FunnelState, coupon_summary, growth_summary, read_daily
from tests.conftest import SF_ORACLE, SF_SMALL
from tests.helpers import coupons_df, members_df, orders_df, ts

AS_OF = dt.datetime(2019, 12, 1)


def folder(name):
    return os.path.join(tempfile.mkdtemp(prefix="shoplens-stored-"), name)


def found(df):
    return sorted(map(tuple, df.collect()), key=repr)


# ---------------------------------------------------------------- snapshot tables


def numbers(spark, *pairs):
    return spark.createDataFrame(list(pairs), "k string, n long")


def test_parts_are_replaced_and_versions_stay_readable(spark):
    table = SnapshotTable(spark, folder("t"))
    assert not table.exists() and table.parts() == []
    table.replace(numbers(spark, ("a", 1), ("b", 2), ("b", 3)), F.col("k"), notes={"made": 1})
    old = table.read()
    table.replace(numbers(spark, ("b", 9)), F.col("k"), ["b", "c"])
    assert found(table.read()) == [("a", 1), ("b", 9)]
    assert found(table.read(["b", "zzz"])) == [("b", 9)]
    assert found(old) == found(table.read(version=1)) == [("a", 1), ("b", 2), ("b", 3)]
    table.replace(numbers(spark), F.col("k"), ["a"])
    assert table.parts() == ["b"] and table.notes() == {"made": 1} and table.versions() == [1, 2, 3]
    table.replace(numbers(spark), F.col("k"))
    assert table.read().count() == 0 and table.read().columns == ["k", "n"]
    with pytest.raises(ValueError):
        table.read(version=17)


def test_rows_outside_the_replaced_parts_are_refused(spark):
    table = SnapshotTable(spark, folder("t"))
    table.replace(numbers(spark, ("a", 1), ("b", 2)), F.col("k"))
    with pytest.raises(ValueError, match="outside"):
        table.replace(numbers(spark, ("a", 5), ("b", 5)), F.col("k"), ["a"])
    with pytest.raises(ValueError, match="part name"):
        table.replace(numbers(spark, ("a/b", 5)), F.col("k"))
    with pytest.raises(ValueError, match="columns differ"):
        table.replace(numbers(spark, ("a", 5)).withColumn("more", F.lit(1)), F.col("k"), ["a"])
    assert found(table.read()) == [("a", 1), ("b", 2)] and table.versions() == [1]


def test_a_killed_write_leaves_the_old_table(spark):
    table = SnapshotTable(spark, folder("t"))
    table.replace(numbers(spark, ("a", 1)), F.col("k"))
    table.stage(numbers(spark, ("a", 2)), F.col("k"))  # killed before the commit
    failing = numbers(spark, ("a", 3)).withColumn("n", F.expr("CAST(raise_error('killed') AS BIGINT)"))
    with pytest.raises(Exception, match="killed"):
        table.replace(failing, F.col("k"), ["a"])
    assert found(table.read()) == [("a", 1)] and table.versions() == [1]


def test_the_slower_of_two_writers_fails(spark):
    path = folder("t")
    table, other = SnapshotTable(spark, path), SnapshotTable(spark, path)
    table.replace(numbers(spark, ("a", 1), ("b", 1)), F.col("k"))
    base = table.manifest()
    rows = numbers(spark, ("a", 2))
    staged = table.stage(rows, F.col("k"))
    other.replace(numbers(spark, ("b", 7)), F.col("k"), ["b"])
    with pytest.raises(SnapshotConflict):
        table.commit(staged, nullable(rows.schema), ["a"], base)
    assert found(table.read()) == [("a", 1), ("b", 7)]


def test_vacuum_removes_what_no_kept_version_names(spark):
    table = SnapshotTable(spark, folder("t"))
    table.replace(numbers(spark, ("a", 1), ("b", 1)), F.col("k"))
    table.stage(numbers(spark, ("a", 5)), F.col("k"))
    for n in (2, 3):
        table.replace(numbers(spark, ("a", n)), F.col("k"), ["a"])
    assert table.vacuum() == 0  # all are young
    assert table.vacuum(keep=2, older_than_hours=-1) == 2  # the staged rows and part a of version 1
    assert table.versions() == [2, 3]
    assert found(table.read()) == [("a", 3), ("b", 1)] and found(table.read(version=2)) == [("a", 2), ("b", 1)]


# ---------------------------------------------------------------- per-day summaries


def shop(spark, day_rows):
    """Members and orders: {day offset: number of both}."""
    days = [(d, k) for d, n in day_rows.items() for k in range(n)]
    m = members_df(spark, [(100 * d + k, 1, 1, "x", "x", ts(d, k % 24)) for d, k in days])
    o = orders_df(spark, [(1000 * d + k, k, 2, 1.25 * k, ts(d, k % 24, 59)) for d, k in days])
    return m, o


def reports(daily):
    return [
        found(f(daily, as_of=AS_OF))
        for f in (
            op.growth_report_from_daily,
            op.growth_report_complete_from_daily,
            op.wow_daily_registrations_from_daily,
            op.wow_daily_orders_from_daily,
        )
    ]


def test_a_day_that_lost_its_rows_leaves_the_summary(spark):
    kept = growth_summary(spark, folder("daily"))
    before = shop(spark, {0: 3, 20: 5, 27: 2, 28: 4, 35: 2})
    kept.rebuild(*before)
    after = shop(spark, {0: 3, 20: 5, 28: 6, 35: 2})  # day 27 lost, day 28 grew
    kept.replace_days(ts(27), ts(28), *after)
    assert found(kept.read()) == found(op.daily_activity(*after))
    assert reports(kept.read()) == reports(op.daily_activity(*after))
    # a whole rebuild without day 20 and without a month
    last = shop(spark, {0: 3, 28: 6})
    kept.rebuild(*last)
    assert reports(kept.read()) == reports(op.daily_activity(*last)) and kept.table.parts() == ["2019-11"]
    # a killed rebuild changes nothing
    m, o = shop(spark, {1: 1})
    with pytest.raises(Exception, match="killed"):
        kept.rebuild(m, o.withColumn("origin_price", F.expr("CAST(raise_error('killed') AS DOUBLE)")))
    assert reports(kept.read()) == reports(op.daily_activity(*last))


def test_days_in_any_order_and_twice_give_the_whole_summary(spark):
    m, o = src.members(spark, SF_SMALL), src.orders(spark, SF_SMALL)
    some = F.col("create_time") >= F.lit("2001-06-20").cast("timestamp_ntz")
    m, o = m.filter(some), o.filter(some)
    kept = growth_summary(spark, folder("daily"))
    first, last = dt.datetime(2001, 6, 20), dt.datetime(2001, 8, 2)
    cuts = [first, dt.datetime(2001, 7, 3), dt.datetime(2001, 7, 20), last + dt.timedelta(days=1)]
    spans = [(a, b - dt.timedelta(days=1)) for a, b in zip(cuts, cuts[1:])]
    for a, b in [spans[2], spans[0], spans[1], spans[0]]:
        kept.replace_days(a, b, m, o)
    assert found(kept.read()) == found(op.daily_activity(m, o))
    as_of = dt.datetime(2001, 7, 25)
    near = kept.read(since=as_of - dt.timedelta(days=14))
    assert len(near.inputFiles()) < len(kept.read().inputFiles())
    assert found(op.wow_daily_orders_from_daily(near, as_of=as_of)) == found(op.wow_daily_orders(o, as_of=as_of))


def test_coupon_summary_in_jobs(spark, capsys):
    base = tempfile.mkdtemp(prefix="shoplens-coupon-job-")
    c = src.coupon_members(spark, SF_SMALL)
    c.write.parquet(os.path.join(base, "t_coupon_member.parquet"))
    summary, out = os.path.join(base, "coupons"), os.path.join(base, "out")
    args = ["daily_coupons", "--parquet", base, "--summary", summary]
    assert jobs.main([*args, "--day", "2024-01-01", "--to-day", "2024-01-20"]) == 0
    assert jobs.main([*args, "--day", "2024-01-18", "--to-day", "2024-01-31"]) == 0
    assert found(read_daily(spark, summary)) == found(op.daily_coupons(c))
    assert jobs.main(["marketing", "--summary", summary, "--as-of", "2024-01-25", "--out", out]) == 0
    for name, direct in (("free", op.marketing_free_coupons), ("paid", op.marketing_paid_coupons)):
        assert found(spark.read.parquet(os.path.join(out, name))) == found(direct(c, as_of="2024-01-25"))
    assert coupon_summary(spark, summary).table.versions() == [1, 2]


# ---------------------------------------------------------------- funnel state


def funnel_rows(spark, rng, days):
    """Random orders and coupons of the days, with NULL members and NULL order ids."""
    orders, coupons = [], []
    for d in days:
        for k in range(rng.randrange(12)):
            member = rng.choice([None, *range(8)])
            orders.append((None if rng.random() < 0.2 else 100 * d + k, member, rng.choice([1, 2, 2]), 1.0, ts(d, k)))
        for k in range(rng.randrange(6)):
            coupons.append((rng.choice([None, *range(8)]), rng.choice([1, 2, 3]), rng.choice([1, 2]), ts(d, k)))
    return orders, coupons


def same_reports(state, o, c):
    assert found(state.buyers()) == found(op.funnel_buyers(o))
    assert found(state.repeat_buyers()) == found(op.funnel_repeat_buyers(o))
    assert found(state.coupon_buyers()) == found(op.funnel_coupon_buyers(c))
    assert found(state.repeat_and_coupon()) == found(op.funnel_repeat_and_coupon(o, c))
    assert found(state.summary()) == found(op.funnel_summary(o, c))


@pytest.mark.parametrize("seed", [1, 2])
def test_any_sequence_of_days_equals_the_full_run(spark, seed):
    rng = random.Random(seed)
    state, now = FunnelState(spark, folder("funnel"), buckets=5), {}
    for step in range(7):
        day = rng.randrange(4)
        now[day] = funnel_rows(spark, rng, [day]) if rng.random() < 0.8 else ([], [])  # a rerun may find no rows
        o = orders_df(spark, [x for v in now.values() for x in v[0]])
        c = coupons_df(spark, [x for v in now.values() for x in v[1]])
        state.replace_day(ts(day), o, c)
        if step % 3 == 0:
            state.replace_day(ts(day), o, c)
    same_reports(state, o, c)
    whole = FunnelState(spark, folder("whole"), buckets=5)
    whole.rebuild(o, c)
    assert found(whole.members()) == found(state.members()) and whole.table.parts() == state.table.parts()


def test_rows_without_a_time_and_without_a_change(spark):
    o = orders_df(spark, [(1, 10, 2, 1.0, None), (2, 10, 2, 1.0, ts(0)), (3, None, 2, 1.0, ts(1))])
    c = coupons_df(spark, [(10, 2, 1, ts(1)), (11, 2, 1, None)])
    state = FunnelState(spark, folder("funnel"), buckets=3)
    state.rebuild(o, c)
    same_reports(state, o, c)
    before = state.table.manifest()["parts"]
    state.replace_day(ts(1), o, c)
    after = state.table.manifest()["parts"]
    assert {k for k in before if before[k] != after[k]} == {"day-2019-11-02"}  # no bucket is rewritten
    assert found(state.members([10, 99])) == [(10, 2, 2, 1)]


def test_only_buckets_of_changed_members_are_rewritten(spark):
    o = orders_df(spark, [(i, i, 2, 1.0, ts(0)) for i in range(200)])
    c = coupons_df(spark, [])
    state = FunnelState(spark, folder("funnel"), buckets=16)
    state.rebuild(o, c)
    before = state.table.manifest()["parts"]
    more = o.unionByName(orders_df(spark, [(900, 7, 2, 1.0, ts(1))]))
    state.replace_day(ts(1), more, c)
    after = state.table.manifest()["parts"]
    changed = {k for k in after if before.get(k) != after[k]}
    assert len(changed) == 2 and "day-2019-11-02" in changed
    same_reports(state, more, c)


def test_closed_days_and_other_settings_are_refused(spark):
    o, c = orders_df(spark, [(1, 1, 2, 1.0, ts(0)), (2, 1, 2, 1.0, ts(3))]), coupons_df(spark, [])
    path = folder("funnel")
    state = FunnelState(spark, path, buckets=4)
    state.replace_day(ts(0), o, c)
    state.replace_day(ts(3), o, c)
    state.close_days(ts(2))
    with pytest.raises(ValueError, match="closed"):
        state.replace_day(ts(0), o, c)
    state.replace_day(ts(3), o, c)
    same_reports(state, o, c)
    with pytest.raises(ValueError, match="built with"):
        FunnelState(spark, path, buckets=8).buyers()


def test_funnel_of_the_given_tables_in_jobs(spark):
    base = tempfile.mkdtemp(prefix="shoplens-funnel-job-")
    o, c = src.orders(spark, SF_ORACLE), src.coupon_members(spark, SF_ORACLE)
    o.write.parquet(os.path.join(base, "t_order.parquet"))
    c.write.parquet(os.path.join(base, "t_coupon_member.parquet"))
    state, out = os.path.join(base, "state"), os.path.join(base, "out")
    args = ["daily_funnel", "--parquet", base, "--summary", state, "--buckets", "4"]
    assert jobs.main(args) == 0
    assert jobs.main([*args, "--day", "2001-07-20", "--to-day", "2001-07-21"]) == 0
    assert jobs.main(["conversion", "--summary", state, "--buckets", "4", "--out", out]) == 0
    assert found(spark.read.parquet(os.path.join(out, "funnel"))) == found(op.funnel_summary(o, c))
    same_reports(FunnelState(spark, state, buckets=4), o, c)
