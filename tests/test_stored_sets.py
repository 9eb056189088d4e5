"""Bitmaps of ids, member sets and word counts by day, and rejects counted by the run."""

import json
import os
import random
import tempfile

import pytest
from pyspark.sql import functions as F

from shoplens import jobs
from shoplens import operators as op
from shoplens.functions.bitmaps import count_ids, id_bitmaps, list_ids
from shoplens.plans import inspect as P
from shoplens.schemas import MEMBER, ORDER, conform, conform_counted, rejected_values
from shoplens.sources import canonical as src
from shoplens.stored import DailyWords, buyers, coupon_buyers, coupon_holders
from tests.conftest import SF_SMALL
from tests.helpers import coupons_df, log_df, orders_df, ts

IDS = [None, 0, 1, 7, 8, 32767, 32768, 32769, 65536, -1, -32767, -32768, -32769, 2**31 - 1, 2**31, 2**31 + 1, 2**40, 2**62, -(2**45)]


def found(df):
    return sorted(map(tuple, df.collect()), key=repr)


def folder(name):
    return os.path.join(tempfile.mkdtemp(prefix="shoplens-sets-"), name)


def test_bitmaps_equal_distinct(spark):
    rng = random.Random(4)
    rows = spark.createDataFrame([(rng.choice("ab"), rng.choice(IDS)) for _ in range(300)] + [("c", None)], "k string, id long")
    sets = id_bitmaps(rows, "id", "k")
    assert found(count_ids(sets, "n", "k")) == found(rows.groupBy("k").agg(F.count_distinct("id").alias("n")))
    assert found(list_ids(sets, "id")) == found(rows.select("id").distinct())
    assert found(count_ids(sets.unionByName(sets), "n")) == [(rows.agg(F.count_distinct("id")).first()[0],)]
    assert not P.has_python(list_ids(sets, "id"))
    empty = id_bitmaps(rows.limit(0), "id")
    assert found(count_ids(empty, "n")) == [(0,)] and list_ids(empty, "id").count() == 0


def test_members_of_any_days(spark):
    rng = random.Random(5)
    rows = [(rng.randrange(500), rng.choice(IDS), rng.choice([1, 2]), 1.0, ts(rng.randrange(40), rng.randrange(24))) for _ in range(400)]
    o = orders_df(spark, rows)
    kept = buyers(spark, folder("buyers"))
    kept.rebuild(o)
    assert found(kept.members()) == found(op.funnel_buyers(o))
    day = F.to_date("create_time")
    for first, last in ((ts(3), ts(9)), (ts(20), None), (None, ts(31))):
        span = o.filter((day >= first.date()) if first else F.lit(True)).filter((day <= last.date()) if last else F.lit(True))
        assert found(kept.members(first, last)) == found(op.funnel_buyers(span))
        expected = span.filter("order_status = 2").agg(F.count_distinct("member_id")).first()[0]
        assert found(kept.count(first, last)) == [(expected,)]
    # a day is replaced, twice, and lost its rows
    fewer = o.filter(day != ts(5).date())
    for _ in range(2):
        kept.replace_days(ts(5), ts(5), fewer)
    assert found(kept.members()) == found(op.funnel_buyers(fewer))


def test_coupon_sets_of_the_given_tables(spark):
    m, o, c = src.members(spark, SF_SMALL), src.orders(spark, SF_SMALL), src.coupon_members(spark, SF_SMALL)
    holders, paid = coupon_holders(spark, folder("holders")), coupon_buyers(spark, folder("paid"))
    holders.rebuild(c)
    paid.rebuild(c)
    assert found(holders.count()) == [(op.member_heat(m, o, c).first()["coupon"],)]
    assert found(paid.members()) == found(op.funnel_coupon_buyers(c))
    nulls = coupon_holders(spark, folder("nulls"))
    nulls.rebuild(coupons_df(spark, [(None, 1, 1, ts(0)), (None, 2, 1, ts(1))]))
    assert found(nulls.count()) == [(0,)] and found(nulls.members()) == [(None,)]


# ---------------------------------------------------------------- words


def lines(counts):
    return [f"1\t2\t{w}\tx" for w, n in counts.items() for _ in range(n)]


def word_days(seed, days=6, words=60):
    rng = random.Random(seed)
    return [{f"w{min(words, int(rng.paretovariate(0.6)))}": rng.choice([1, 1, 2, 3, 9, 40]) for _ in range(40)} for _ in range(days)]


@pytest.mark.parametrize("seed", range(4))
def test_hot_words_of_days_equal_the_full_count(spark, seed):
    data = word_days(seed)
    kept = DailyWords(spark, folder("words"), top=8)
    for d, counts in enumerate(data):
        kept.replace_day(ts(d), log_df(spark, lines(counts) + ["short\tline", "1\t2\t\tempty"]))
    kept.replace_day(ts(2), log_df(spark, lines(data[2])))
    for first, last in ((0, 5), (1, 3), (4, 4)):
        log = log_df(spark, [x for counts in data[first : last + 1] for x in lines(counts)])
        assert found(kept.counts(ts(first), ts(last))) == found(op.search_word_counts(log))
        for k in (1, 3, 8, 30, 500):
            got = [tuple(r) for r in kept.hot_words(k, ts(first), ts(last)).collect()]
            assert got == [tuple(r) for r in op.search_hot_words(log, k=k).collect()], (seed, first, last, k)
    assert kept.hot_words(3, ts(50)).count() == 0


def test_hot_words_read_few_rows(spark):
    kept = DailyWords(spark, folder("words"))
    for d in range(3):
        common = {f"common{k}": 400 - k - d for k in range(20)}
        rare = spark.range(20_000).selectExpr(f"concat('1\\t2\\trare', id + {d} * 7, '\\tx') AS value")
        kept.replace_day(ts(d), log_df(spark, lines(common)).unionByName(rare))
    days = kept.days()
    least = kept.threshold(10, days)
    assert least > 300
    read = kept._read("day", days).filter(F.col("cnt") >= least)
    assert "GreaterThanOrEqual(cnt" in P.physical_plan(read)
    assert read.count() <= 60 < kept._read("day", days).count() / 100
    assert [r["word"] for r in kept.hot_words(3).collect()] == ["common0", "common1", "common2"]


def test_words_in_jobs(spark, capsys):
    base = tempfile.mkdtemp(prefix="shoplens-words-job-")
    log = src.search_log(spark, SF_SMALL)
    halves = log.randomSplit([0.5, 0.5], seed=3)
    for d, half in enumerate(halves, 1):
        half.write.text(os.path.join(base, f"log{d}"))
        args = ["daily_words", "--log", os.path.join(base, f"log{d}"), "--summary", os.path.join(base, "kept")]
        assert jobs.main([*args, "--day", f"2024-01-0{d}"]) == 0
    capsys.readouterr()
    assert jobs.main(["hotwords", "--summary", os.path.join(base, "kept"), "--k", "7", "--show"]) == 0
    got = [tuple(json.loads(x).values()) for x in capsys.readouterr().out.strip().splitlines()]
    assert got == [tuple(r) for r in op.search_hot_words(log, k=7).collect()]
    with pytest.raises(SystemExit):
        jobs.main(["daily_words", "--log", base, "--summary", base])


# ---------------------------------------------------------------- rejects


def text_orders(spark):
    rows = [("1", "5", "2", "1.5", "2019-11-30 10:00:00"), ("x", "6", "2", "cheap", "junk"), ("3", None, "two", None, "2019-11-29")]
    return spark.createDataFrame(rows, "order_id string, member_id string, order_status string, origin_price string, create_time string")


def test_rejects_are_counted_by_the_run(spark):
    raw = text_orders(spark)
    rows, lost = conform_counted(raw, ORDER)
    assert found(rows) == found(conform(raw, ORDER))
    expected = {r["column"]: r["rejected"] for r in rejected_values(raw, ORDER).collect()}
    assert lost.get == expected == {"order_id": 1, "member_id": 0, "order_status": 1, "origin_price": 1, "create_time": 1}
    typed = spark.createDataFrame([], MEMBER)
    assert conform_counted(typed, MEMBER)[1] is None
    assert "CollectMetrics" not in P.physical_plan(conform_counted(typed, MEMBER)[0])


def test_jobs_report_their_rejects(spark, capsys):
    base = tempfile.mkdtemp(prefix="shoplens-rejects-")
    text_orders(spark).write.parquet(os.path.join(base, "t_order.parquet"))
    c = spark.createDataFrame([(5, "2", 1, ts(0)), (6, "two", 1, ts(0))], "member_id long, coupon_id string, coupon_channel long, create_time timestamp_ntz")
    c.write.parquet(os.path.join(base, "t_coupon_member.parquet"))
    src.members(spark, SF_SMALL).write.parquet(os.path.join(base, "t_member.parquet"))

    def rejects(*args):
        capsys.readouterr()
        assert jobs.main([*args, "--show"]) == 0
        return json.loads(capsys.readouterr().err.strip().splitlines()[-1])["rejected"]

    coupons = {"t_coupon_member.coupon_id": 1}
    orders = {"t_order.create_time": 1, "t_order.order_id": 1, "t_order.order_status": 1, "t_order.origin_price": 1}
    assert rejects("conversion", "--parquet", base).keys() >= {"t_coupon_member.coupon_id", "t_order.order_status"}
    assert rejects("marketing", "--parquet", base, "--as-of", "2019-11-30") == coupons
    assert rejects("growth", "--parquet", base, "--as-of", "2019-12-01") == orders
    dates = os.path.join(base, "dates")
    spark.createDataFrame([("2019-11-30",), ("junk",), (None,)], "ds string").write.parquet(dates)
    assert rejects("standardise", "--dates", dates) == {"dates.ds": 1}
