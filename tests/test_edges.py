"""Hand-written edge rows with exact expectations (FIXTURES.md §4)."""

import datetime as dt


from shoplens import operators as op
from tests.helpers import coupons_df, log_df, members_df, orders_df, rows, ts

AS_OF = dt.datetime(2019, 11, 30)
START7 = AS_OF - dt.timedelta(days=7)


def _no_orders(spark):
    return orders_df(spark, [])


def _no_coupons(spark):
    return coupons_df(spark, [])


def test_1_phone_states(spark):
    m = members_df(
        spark,
        [(1, 1, 1, "x", "null", ts(0)), (2, 1, 1, "x", None, ts(0)), (3, 1, 1, "x", "138", ts(0))],
    )
    heat = op.member_heat(m, _no_orders(spark), _no_coupons(spark)).first()
    assert (heat["reg"], heat["complete"]) == (1, 1)
    heat2 = op.member_heat(m, _no_orders(spark), _no_coupons(spark), null_as_missing=True).first()
    assert (heat2["reg"], heat2["complete"]) == (2, 1)


def test_2_order_and_order_again_are_disjoint(spark):
    o = orders_df(
        spark,
        [(1, 10, 2, 1.0, ts(0)), (2, 11, 2, 1.0, ts(0)), (3, 11, 1, 1.0, ts(0)), (4, 11, 0, 1.0, ts(0))],
    )
    heat = op.member_heat(members_df(spark, []), o, _no_coupons(spark)).first()
    assert (heat["order"], heat["orderAgain"]) == (1, 1)
    # only completed orders: member 11 has one
    heat2 = op.member_heat(members_df(spark, []), o, _no_coupons(spark), status=2).first()
    assert (heat2["order"], heat2["orderAgain"]) == (2, 0)


def test_3_coupon_distinct_skips_null(spark):
    c = coupons_df(spark, [(7, 1, 1, ts(0)), (7, 2, 1, ts(0)), (None, 1, 1, ts(0))])
    heat = op.member_heat(members_df(spark, []), _no_orders(spark), c).first()
    assert heat["coupon"] == 1


def test_4_distinct_buyers_keep_one_null(spark):
    o = orders_df(spark, [(1, 5, 2, 1.0, ts(0)), (2, None, 2, 1.0, ts(0)), (3, None, 2, 1.0, ts(0))])
    assert op.funnel_buyers(o).count() == 2
    assert op.funnel_summary(o, _no_coupons(spark)).first()["order"] == 2


def test_5_repeat_needs_two_completed(spark):
    o = orders_df(spark, [(1, 5, 2, 1.0, ts(0)), (2, 5, 1, 1.0, ts(0))])
    assert op.funnel_repeat_buyers(o).count() == 0


def test_6_null_member_never_matches(spark):
    o = orders_df(spark, [(1, None, 2, 1.0, ts(0)), (2, None, 2, 1.0, ts(0))])
    c = coupons_df(spark, [(None, 2, 1, ts(0))])
    assert rows(op.funnel_repeat_buyers(o)) == [(None,)]
    assert op.funnel_repeat_and_coupon(o, c).count() == 0
    s = op.funnel_summary(o, c).first()
    assert (s["order"], s["orderAgain"], s["chargeCoupon"]) == (1, 1, 0)


def test_7_marketing_start_is_strict(spark):
    c = coupons_df(spark, [(1, 1, 2, START7), (2, 1, 2, START7 + dt.timedelta(seconds=1))])
    got = rows(op.marketing_free_coupons(c, as_of=AS_OF))
    assert got == [("2019-11-23", 1)]
    got_incl = rows(op.marketing_free_coupons(c, as_of=AS_OF, inclusive=True))
    assert got_incl == [("2019-11-23", 2)]


def test_8_growth_start_is_inclusive(spark):
    m = members_df(spark, [(1, 1, 1, "x", "1", START7), (2, 1, 1, "x", "1", START7 - dt.timedelta(seconds=1))])
    assert rows(op.growth_daily_registrations(m, as_of=AS_OF)) == [("2019-11-23", 1, 1)]


def test_9_wow_end_is_exclusive(spark):
    m = members_df(
        spark,
        [(1, 1, 1, "x", "1", AS_OF), (2, 1, 1, "x", "1", AS_OF - dt.timedelta(seconds=1))],
    )
    assert rows(op.wow_daily_registrations(m, as_of=AS_OF)) == [("2019-11-29", 1)]


def test_10_no_prior_orders(spark):
    m = members_df(spark, [(1, 1, 1, "x", "1", START7)])
    o = orders_df(spark, [(1, 1, 2, 10.5, START7 + dt.timedelta(hours=1))])
    assert rows(op.growth_prior_gmv(o, as_of=AS_OF)) == [(None,)]
    assert rows(op.growth_report(m, o, as_of=AS_OF)) == [("2019-11-23", 1, 1, 1, 10.5)]


def _day11_fixture(spark):
    day0 = START7
    m = members_df(
        spark,
        [(1, 1, 1, "x", "1", day0 - dt.timedelta(days=30)),
         (2, 1, 1, "x", "1", day0 + dt.timedelta(hours=2)),
         (3, 1, 1, "x", "1", day0 + dt.timedelta(days=2, hours=2))],
    )
    o = orders_df(
        spark,
        [(1, 1, 2, 100.0, day0 - dt.timedelta(days=10)),
         (2, 2, 2, 1.25, day0 + dt.timedelta(hours=5)),
         (3, 2, 2, 7.0, day0 + dt.timedelta(days=1, hours=5)),  # no registration that day
         (4, 3, 2, 2.5, day0 + dt.timedelta(days=2, hours=5))],
    )
    return m, o


def test_11_parity_report_drops_unmatched_days(spark):
    m, o = _day11_fixture(spark)
    got = rows(op.growth_report(m, o, as_of=AS_OF))
    assert got == [("2019-11-23", 1, 2, 2, 101.25), ("2019-11-25", 1, 3, 4, 103.75)]


def test_12_complete_report_keeps_every_day(spark):
    m, o = _day11_fixture(spark)
    got = rows(op.growth_report_complete(m, o, as_of=AS_OF))
    assert len(got) == 7
    assert got[0] == ("2019-11-23", 1, 2, 2, 101.25)
    assert got[1] == ("2019-11-24", 0, 2, 3, 108.25)
    assert got[2] == ("2019-11-25", 1, 3, 4, 110.75)
    assert got[6] == ("2019-11-29", 0, 3, 4, 110.75)


def test_13_short_lines_are_skipped(spark):
    log = log_df(spark, ["1\t2", "1\t2\tshoes\t9", "1\t2\t", "a\tb\tshoes"])
    assert rows(op.search_word_counts(log)) == [("shoes", 2)]
    # keep_empty counts a genuinely empty third field, still skips short lines
    got = rows(op.search_word_counts(log, keep_empty=True), ["word"])
    assert got == [("", 1), ("shoes", 2)]


def test_14_ties_at_the_cut_break_on_word(spark):
    words = [f"w{i:02d}" for i in range(20)]
    lines = [f"x\ty\t{w}" for w in words] + ["x\ty\ttop"] * 3
    got = rows(op.search_hot_words(log_df(spark, lines), k=10))
    assert got[0] == ("top", 3)
    assert [w for w, _ in got[1:]] == words[:9]


def _standardise(spark, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "event_id long, ds string")
    return [tuple(r) for r in op.date_standardise(df, "ds").orderBy("event_id").collect()]


def test_15_one_style(spark):
    got = _standardise(spark, ["2019-11-30 10:00:00"])
    assert got == [(0, "2019-11-30 10:00:00", dt.datetime(2019, 11, 30, 10), "YYYY_MM_DD_HH_MM_SS", "2019-11-30 10:00:00")]


def test_16_rejected(spark):
    values = ["2019-13-40", "", None, "2019-2-3", "2019-11-30 10:00:60", "24:00", "dddd-dd-dd"]
    got = _standardise(spark, values)
    assert all(r[2] is None and r[3] is None and r[4] is None for r in got)
    df = spark.createDataFrame([(v,) for v in values], "ds string")
    assert rows(op.date_quality(df)) == [("rejected", len(values))]


def test_17_yearless_defaults_to_1970(spark):
    got = _standardise(spark, ["11-30", "11月30日 08:05", "08:05:09"])
    assert [r[2] for r in got] == [
        dt.datetime(1970, 11, 30),
        dt.datetime(1970, 11, 30, 8, 5),
        dt.datetime(1970, 1, 1, 8, 5, 9),
    ]
    assert [r[3] for r in got] == ["MM_DD", "MM_DD_HH_MM_CN", "HH_MM_SS"]


def test_18_interval_days_do_not_overflow(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1, 23, 0),)], "ts timestamp_ntz")
    out = op.calendar_enrich(df, reference_date=dt.date(2024, 8, 1)).first()
    assert out["days_to"] == 213


def test_19_month_and_year_steps_clamp(spark):
    df = spark.createDataFrame(
        [(dt.datetime(2024, 1, 31, 10),), (dt.datetime(2024, 2, 29),)], "ts timestamp_ntz"
    )
    shifts = (("plus_month", "month", 1), ("plus_year", "year", 1), ("minus_hour", "hour", -1))
    got = op.calendar_enrich(df, reference_date="2024-01-01", shifts=shifts).orderBy("ts").collect()
    assert got[0]["plus_month"] == dt.datetime(2024, 2, 29, 10)
    assert got[1]["plus_year"] == dt.datetime(2025, 2, 28)
    assert got[0]["minus_hour"] == dt.datetime(2024, 1, 31, 9)
    assert (got[0]["weekday"], got[0]["weekday_cn"], got[0]["weekday_short"], got[0]["weekday_no"]) == (
        "Wednesday", "星期三", "Wed.", 3,
    )


def test_non_amounts_do_not_fail_the_job(spark):
    o = orders_df(
        spark,
        [(1, 1, 2, float("nan"), START7), (2, 1, 2, float("inf"), START7), (3, 1, 2, 2.5, START7)],
    )
    assert rows(op.growth_daily_orders(o, as_of=AS_OF)) == [("2019-11-23", 3, 2.5)]


def test_known_style_renders_and_same_style_shifts(spark):
    df = spark.createDataFrame(
        [(0, "2019-11-30"), (1, "2019/11/30 23:59"), (2, "11月30日"), (3, "11-30")],
        "event_id long, ds string",
    )
    out = op.date_standardise(
        df,
        "ds",
        target_style={"date": "YYYY_MM_DD", "time": "HH_MM_SS"},
        shift_in_style=[("next_day", "day", 1), ("last_year", "year", -1)],
    ).orderBy("event_id").collect()
    assert [r["date"] for r in out] == ["2019-11-30", "2019-11-30", "1970-11-30", "1970-11-30"]
    assert [r["time"] for r in out] == ["00:00:00", "23:59:00", "00:00:00", "00:00:00"]
    assert [r["next_day"] for r in out] == ["2019-12-01", "2019/12/01 23:59", "12月01日", "12-01"]
    assert [r["last_year"] for r in out] == ["2018-11-30", "2018/11/30 23:59", "11月30日", "11-30"]
    # a known style only: the other shapes are rejected
    only = op.date_standardise(df, "ds", styles=["MM_DD"], target_style=None).orderBy("event_id")
    assert [r["style"] for r in only.collect()] == [None, None, None, "MM_DD"]
    assert rows(op.date_quality(df, styles=["MM_DD"]), ["style"]) == [("MM_DD", 1), ("rejected", 3)]


def test_parse_in_one_known_style(spark):
    from shoplens.functions.dates import parse_in_style

    df = spark.createDataFrame([("2019年11月30日",), ("2019-11-30",), ("2019年02月30日",)], "ds string")
    got = [r[0] for r in df.select(parse_in_style("ds", "yyyy年MM月dd日")).collect()]
    assert got == [dt.datetime(2019, 11, 30), None, None]


def test_null_timestamps_get_null_calendar_parts(spark):
    df = spark.createDataFrame([(None,), (dt.datetime(2024, 1, 1),)], "ts timestamp_ntz")
    got = op.calendar_enrich(df, reference_date="2024-01-01").orderBy("ts").collect()
    assert (got[0]["weekday"], got[0]["weekday_cn"], got[0]["weekday_short"], got[0]["weekday_no"]) == (
        None, None, None, None,
    )
    assert got[1]["weekday"] == "Monday"
