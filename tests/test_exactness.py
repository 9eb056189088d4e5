"""Totals, windows and stored summaries that must be exact."""

import datetime as dt
import os
import tempfile
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shoplens import jobs
from shoplens import operators as op
from shoplens.functions.timewin import DayPartition
from shoplens.plans import inspect as P
from shoplens.plans.registry import QUERIES
from shoplens.schemas import MEMBER, rejected_values
from shoplens.session import session_builder
from shoplens.sources.sinks import write_report
from shoplens.stored import read_daily
from tests.conftest import SF_SMALL
from tests.helpers import coupons_df, members_df, orders_df, rows, ts

AS_OF = dt.datetime(2019, 11, 30)
EARLY = dt.datetime(2019, 11, 1)
NOON = dt.datetime(2019, 11, 30, 12)


def _prices(spark, prices, when=EARLY):
    return orders_df(spark, [(i, 1, 2, p, when) for i, p in enumerate(prices, 1)])


def test_small_amounts_are_not_rounded_per_row(spark):
    o = _prices(spark, [0.004] * 1000)
    assert rows(op.growth_prior_gmv(o, as_of=AS_OF)) == [(4.0,)]


def test_decimal_amounts_keep_their_scale(spark):
    o = _prices(spark, [0.0] * 3).withColumn("origin_price", F.lit(Decimal("0.3349")).cast("decimal(18,4)"))
    assert rows(op.growth_prior_gmv(o, as_of=AS_OF)) == [(1.0,)]


def test_large_amounts_are_in_the_total(spark):
    o = _prices(spark, [1e16, 2e16, 3.0])
    assert rows(op.growth_prior_gmv(o, as_of=AS_OF)) == [(3e16 + 3.0,)]
    last = op.growth_report_complete(members_df(spark, []), o, as_of=AS_OF).collect()[-1]
    assert last["gmv"] == 3e16 + 3.0


def test_amounts_that_are_no_numbers_are_counted(spark):
    o = _prices(spark, [float("nan"), float("inf"), float("-inf"), 2.5, None])
    daily = op.daily_activity(members_df(spark, []), o).first()
    assert (daily["odd_amounts"], daily["amount"], daily["order_rows"]) == (3, Decimal("2.5"), 5)
    assert rows(op.growth_prior_gmv(o, as_of=AS_OF)) == [(2.5,)]


def test_summary_buyers_include_orders_without_an_id(spark):
    o = orders_df(spark, [(1, 10, 2, 1.0, ts(0)), (None, 11, 2, 1.0, ts(0)), (None, None, 2, 1.0, ts(0)), (2, 12, 1, 1.0, ts(0))])
    got = op.funnel_summary(o, coupons_df(spark, [(11, 2, 1, ts(0)), (13, 2, 1, ts(0))])).first()
    assert got["order"] == op.funnel_buyers(o).count() == 3


def _noon_tables(spark):
    edge = NOON - dt.timedelta(days=7)
    instants = [edge - dt.timedelta(hours=2), edge, edge + dt.timedelta(hours=1), NOON - dt.timedelta(hours=1), NOON,
                EARLY, dt.datetime(2019, 11, 26, 8)]
    m = members_df(spark, [(i, 1, 1, "x", "x", t) for i, t in enumerate(instants, 1)])
    o = orders_df(spark, [(i, 1, 2, float(10**i), t) for i, t in enumerate(instants, 1)])
    return m, o


def test_windows_may_start_inside_a_day(spark):
    m, o = _noon_tables(spark)
    report = {r["day"]: r for r in op.growth_report(m, o, as_of=NOON).collect()}
    # prior: the order two hours before the edge and the one on 1 November
    assert report["2019-11-23"]["newRegCount"] == 2
    assert report["2019-11-23"]["gmv"] == 10.0 + 10**6 + 10**2 + 10**3
    assert report["2019-11-26"]["gmv"] == report["2019-11-23"]["gmv"] + 10**7
    direct = {r["day"]: r["gmv"] for r in op.growth_daily_orders(o, as_of=NOON).collect()}
    assert set(direct) == set(report)
    full = op.growth_report_complete(m, o, as_of=NOON).collect()
    assert [r["day"] for r in full] == [f"2019-11-{d}" for d in range(23, 31)]
    assert full[0]["newRegCount"] == 2 and full[-1]["newRegCount"] == 1
    assert full[-1]["totalOrderCount"] == 6  # the order at noon itself is outside
    assert sum(r["newRegCount"] for r in full) == m.filter(
        (F.col("create_time") >= F.lit("2019-11-23 12:00:00").cast("timestamp_ntz"))
        & (F.col("create_time") < F.lit("2019-11-30 12:00:00").cast("timestamp_ntz"))
    ).count()


@pytest.mark.parametrize(
    "report",
    [
        op.growth_report_from_daily,
        op.growth_report_complete_from_daily,
        op.wow_daily_registrations_from_daily,
        op.wow_daily_orders_from_daily,
    ],
)
def test_summaries_refuse_windows_inside_a_day(spark, report):
    daily = op.daily_activity(*_noon_tables(spark))
    with pytest.raises(ValueError):
        report(daily, as_of=NOON)
    report(daily, as_of=AS_OF).collect()


def test_late_partitions_lose_nothing(spark):
    o = _prices(spark, [5.0, 10.0], dt.datetime(2019, 11, 22, 20))
    o = o.withColumn("dt", F.when(F.col("order_id") == 1, F.lit(dt.date(2019, 11, 22))).otherwise(dt.date(2019, 11, 24)))
    path = os.path.join(tempfile.mkdtemp(prefix="shoplens-late-"), "orders")
    o.write.partitionBy("dt").parquet(path)
    stored = spark.read.parquet(path)
    late = DayPartition("dt", lag_days=2)
    df = op.growth_prior_gmv(stored, as_of=AS_OF, partition_day=late)
    assert rows(df) == rows(op.growth_prior_gmv(stored, as_of=AS_OF)) == [(15.0,)]
    assert "PartitionFilters: [isnotnull(dt" in P.physical_plan(df)


def test_partitioned_reports_replace_only_their_days(spark):
    path = os.path.join(tempfile.mkdtemp(prefix="shoplens-days-"), "daily")
    two = spark.createDataFrame([("a", 1), ("b", 2)], "d string, n int")
    write_report(two, path, partition_by=["d"])
    write_report(spark.createDataFrame([("b", 5)], "d string, n int"), path, partition_by=["d"])
    assert sorted((r["d"], r["n"]) for r in spark.read.parquet(path).collect()) == [("a", 1), ("b", 5)]


def test_daily_job_is_safe_to_rerun(spark, capsys):
    base = tempfile.mkdtemp(prefix="shoplens-daily-job-")
    from shoplens.sources import canonical as src

    m, o = src.members(spark, SF_SMALL), src.orders(spark, SF_SMALL)
    m.write.parquet(os.path.join(base, "t_member.parquet"))
    o.write.parquet(os.path.join(base, "t_order.parquet"))
    summary = os.path.join(base, "daily")
    args = ["daily", "--parquet", base, "--summary", summary]
    assert jobs.main(args) == 0
    want = sorted(tuple(r) for r in op.daily_activity(m, o).collect())

    def kept():
        return sorted(tuple(r) for r in read_daily(spark, summary).select(*op.daily_activity(m, o).columns).collect())

    assert kept() == want
    for _ in range(2):
        assert jobs.main([*args, "--day", "2001-07-20"]) == 0
        assert kept() == want
    capsys.readouterr()
    assert jobs.main(["growth", "--summary", summary, "--as-of", "2001-07-25"]) == 0
    printed = capsys.readouterr().out.strip().splitlines()
    assert len(printed) == op.growth_report(m, o, as_of="2001-07-25").count()


def test_printing_is_whole(spark, capsys):
    base = tempfile.mkdtemp(prefix="shoplens-print-")
    log = os.path.join(base, "log")
    spark.range(2500).selectExpr("concat('a\tb\tword', id) AS value").write.text(log)
    capsys.readouterr()
    assert jobs.main(["words", "--log", log, "--show", "--out", os.path.join(base, "out")]) == 0
    assert len(capsys.readouterr().out.strip().splitlines()) == 2500


@pytest.mark.parametrize("args", [["growth"], ["words"], ["quality"], ["daily", "--parquet", "/x"]])
def test_missing_inputs_are_named(args, capsys):
    with pytest.raises(SystemExit):
        jobs.main(args)
    assert "needs --" in capsys.readouterr().err


def test_date_jobs(spark, capsys):
    path = os.path.join(tempfile.mkdtemp(prefix="shoplens-dates-"), "dates")
    spark.createDataFrame([("2019-11-30",), ("junk",)], "ds string").write.parquet(path)
    capsys.readouterr()
    assert jobs.main(["quality", "--dates", path]) == 0
    assert sorted(capsys.readouterr().out.split()) == ['{"style":"YYYY_MM_DD","n":1}', '{"style":"rejected","n":1}']


def test_hive_is_an_option_of_the_session():
    assert session_builder(hive=True)._options["spark.sql.catalogImplementation"] == "hive"


def test_rejected_values_are_counted(spark):
    raw = spark.createDataFrame(
        [("1", "x", "2019-11-30 10:00:00"), ("2", None, "junk"), ("no", "1", None)], "id string, sex string, create_time string"
    )
    schema = T.StructType([f for f in MEMBER.fields if f.name in ("id", "sex", "create_time")])
    got = {r["column"]: r["rejected"] for r in rejected_values(raw, schema).collect()}
    assert got == {"id": 1, "sex": 1, "create_time": 1}


@pytest.mark.parametrize("name", ["growth_report", "wow_daily_registrations", "wow_daily_orders"])
def test_small_results_are_not_range_partitioned(spark, name):
    df = QUERIES[name](spark, SF_SMALL)
    assert P.count_nodes(df, r"rangepartitioning") == 0
    assert P.exchanges(df) <= 3
    assert len([s for s in P.scans(df) if s["table"] == "customer.parquet"]) <= 1


@pytest.mark.parametrize(
    "prices",
    [
        [0.01, 0.1, 0.29, 1.15, 4.35, 9.99, 1e9 + 0.45, 9_999_999_999.99, 1e10, 1e10 + 0.5],
        [-0.01, -5.55, 12.34, -9_999_999_999.99, -0.0, 0.0],
        [0.004, 0.005, 1 / 3, 2.675, 1e-11, 1e-9, 123.456, 0.1 + 0.2],
        [1e14 + 0.25, 1e13 + 0.01, 5e14, 999.995, 7.0],
        [1048575.99, 1048576.0, 10485.75, 10485.76, -10485.76, -10485.77],
    ],
)
def test_totals_equal_decimal_sums(spark, prices):
    o = _prices(spark, prices * 37)
    text = [Decimal(repr(p)).quantize(Decimal("1e-10"), rounding="ROUND_HALF_UP") for p in prices]
    daily = op.daily_activity(members_df(spark, []), o).first()
    assert daily["amount"] == 37 * sum(text)
    old = o.agg(F.expr("round(sum(CAST(origin_price AS DECIMAL(38,10))), 2)").cast("double")).first()[0]
    assert rows(op.growth_prior_gmv(o, as_of=AS_OF)) == [(old,)]


def test_cents_do_not_overflow_their_sums(spark):
    from shoplens.functions.timewin import MONEY_BITS, money_total

    rows_ = 2**42
    most = 10**12 - 1  # cents below 1e10
    assert (most >> MONEY_BITS) * rows_ < 2**63 and (2**MONEY_BITS - 1) * rows_ < 2**63
    high, low = (most >> MONEY_BITS) * rows_, (most & (2**MONEY_BITS - 1)) * rows_
    sums = spark.createDataFrame([(high, low, None)], "cents_high long, cents_low long, exact decimal(38,10)")
    assert sums.selectExpr(money_total(T.DoubleType())).first()[0] == Decimal(most * rows_) / 100
