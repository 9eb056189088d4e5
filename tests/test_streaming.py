"""Streaming forms give the batch answers once all input is processed."""

import datetime as dt
import json
import os
import tempfile
import uuid

from pyspark.sql import functions as F

from shoplens import operators as op
from shoplens.schemas import COUPON_MEMBER
from shoplens.sources import canonical as src
from shoplens.streaming import (
    daily_counts_stream,
    followed_word_counts,
    search_hot_words_stream,
    search_word_counts_stream,
    start_stream,
)
from shoplens.streaming.reports import parquet_stream
from tests.conftest import SF_SMALL


def _name(prefix):
    return f"{prefix}_{uuid.uuid4().hex[:8]}"


def test_word_counts_stream_equals_batch(spark):
    log = src.search_log(spark, SF_SMALL)
    lines = [r["value"] for r in log.collect()]
    folder = tempfile.mkdtemp(prefix="shoplens-log-")
    # three appended files, as a log would grow
    for i in range(3):
        with open(os.path.join(folder, f"part-{i}.txt"), "w") as fh:
            fh.write("\n".join(lines[i::3]) + "\n")
    name = _name("words")
    query = start_stream(
        search_word_counts_stream(spark, folder, max_files_per_trigger=1),
        name,
        sink="memory",
        output_mode="complete",
    )
    try:
        query.processAllAvailable()
        got = sorted(tuple(r) for r in spark.table(name).collect())
    finally:
        query.stop()
    want = sorted(tuple(r) for r in op.search_word_counts(log).collect())
    assert got == want

    top_name = _name("hot")
    top = start_stream(
        search_hot_words_stream(spark, folder, k=10), top_name, sink="memory", output_mode="complete"
    )
    try:
        top.processAllAvailable()
        got_top = [tuple(r) for r in spark.table(top_name).collect()]
    finally:
        top.stop()
    assert got_top == [tuple(r) for r in op.search_hot_words(log, k=10).collect()]


def test_daily_coupon_stream_finalises_days(spark):
    coupons = src.coupon_members(spark, SF_SMALL)
    folder = tempfile.mkdtemp(prefix="shoplens-coupons-")
    coupons.write.mode("overwrite").parquet(os.path.join(folder, "batch0"))
    stream = parquet_stream(spark, os.path.join(folder, "batch0"), COUPON_MEMBER)
    cond = F.col("coupon_id") != 1
    name = _name("paid")
    query = start_stream(
        daily_counts_stream(stream, count_col="member_id", out="couponCount", condition=cond),
        name,
        sink="memory",
        output_mode="append",
    )
    try:
        query.processAllAvailable()
        # a second, empty trigger lets the watermark advance past the data
        query.processAllAvailable()
        got = dict(tuple(r) for r in spark.table(name).collect())
    finally:
        query.stop()
    batch = op.marketing_paid_coupons(coupons, as_of=dt.datetime(2024, 1, 1), days=3650)
    want = dict(tuple(r) for r in batch.collect())
    # every day the watermark has closed is final and equals the batch count
    assert got
    assert all(want[day] == n for day, n in got.items())


def test_daily_stream_counts_late_rows_inside_the_watermark_only(spark):
    def t(day, hour):
        return dt.datetime(2024, 1, day, hour)

    folder = tempfile.mkdtemp(prefix="shoplens-late-")

    def drop_batch(i, rows):
        spark.createDataFrame(rows, COUPON_MEMBER).coalesce(1).write.parquet(os.path.join(folder, f"b{i}"))

    # batch 0: days 1-3; event time reaches 3 Jan 12:00 -> watermark 2 Jan 12:00
    drop_batch(0, [(1, 2, 1, t(1, 9)), (2, 2, 1, t(1, 10)), (3, 2, 1, t(2, 9)), (4, 2, 1, t(3, 12))])
    stream = spark.readStream.schema(COUPON_MEMBER).option("recursiveFileLookup", "true").parquet(folder)
    name = _name("late")
    query = start_stream(
        daily_counts_stream(stream, count_col="member_id", out="n"), name, sink="memory", output_mode="append"
    )
    try:
        query.processAllAvailable()
        # batch 1: a row for 1 Jan (its day closed: dropped), one for 2 Jan
        # 18:00 (still after the watermark: counted), and 6 Jan to move time on
        drop_batch(1, [(5, 2, 1, t(1, 11)), (6, 2, 1, t(2, 18)), (7, 2, 1, t(6, 9))])
        query.processAllAvailable()
        query.processAllAvailable()
        got = dict(tuple(r) for r in spark.table(name).collect())
    finally:
        query.stop()
    assert got["2024-01-01"] == 2  # the late 1 Jan row was dropped
    assert got["2024-01-02"] == 2  # the 2 Jan row within the watermark counted
    assert "2024-01-06" not in got  # still open


def test_follow_words_job_counts_every_file_once(spark, capsys):
    from shoplens import jobs

    log = src.search_log(spark, SF_SMALL)
    lines = [r["value"] for r in log.collect()] + ["no word", "a\tb\t", "a\tb\tonce"]
    folder, name = tempfile.mkdtemp(prefix="shoplens-log-"), _name("follow")
    argv = ["follow_words", "--log", folder, "--stream", name, "--k", "7", "--show"]
    for i in range(3):
        with open(os.path.join(folder, f"part-{i}.txt"), "w") as fh:
            fh.write("\n".join(lines[i::3]) + "\n")
        assert jobs.main(argv) == 0
        printed = [tuple(json.loads(x).values()) for x in capsys.readouterr().out.strip().splitlines()]
        so_far = spark.createDataFrame([(x,) for j in range(i + 1) for x in lines[j::3]], "value string")
        assert printed == [tuple(r) for r in op.search_hot_words(so_far, k=7).collect()]
    # nothing new: the same answer from the state
    assert jobs.main(argv) == 0
    assert [tuple(json.loads(x).values()) for x in capsys.readouterr().out.strip().splitlines()] == printed
    counts = sorted(tuple(r) for r in followed_word_counts(spark, name).collect())
    assert counts == sorted(tuple(r) for r in op.search_word_counts(so_far).collect())


def test_follow_daily_job_appends_closed_days_once(spark, capsys):
    from shoplens import jobs

    base, name = tempfile.mkdtemp(prefix="shoplens-follow-"), _name("daily")
    out = os.path.join(base, "out")
    argv = ["follow_daily", "--parquet", base, "--out", out, "--stream", name, "--watermark", "2 days", "--show"]
    days = [dt.datetime(2019, 11, d, 9) for d in range(1, 11)]
    for upto in (days[:4], days[4:8], days[8:]):
        rows = [(int(d.day * 10 + j), d) for d in upto for j in range(d.day)]
        m = spark.createDataFrame(rows, "id long, create_time timestamp_ntz")
        m.coalesce(1).write.mode("append").parquet(os.path.join(base, "t_member.parquet"))
        o = m.withColumnRenamed("id", "order_id")
        o.coalesce(1).write.mode("append").parquet(os.path.join(base, "t_order.parquet"))
        assert jobs.main(argv) == 0
        printed = [json.loads(x) for x in capsys.readouterr().out.strip().splitlines()]
        # a day is over when the latest row is two days past its end
        closed = [(f"2019-11-{d.day:02d}", d.day) for d in days if d.day + 1 + 2 <= upto[-1].day]
        assert [(r["day"], r["registrations"]) for r in printed if "registrations" in r] == closed
        assert [(r["day"], r["orders"]) for r in printed if "orders" in r] == closed


def test_follow_jobs_say_what_they_need(capsys):
    import pytest

    from shoplens import jobs

    for argv in (
        ["follow_words", "--log", "x"],
        ["follow_words", "--stream", "x"],
        ["follow_daily", "--stream", "x", "--parquet", "p"],
        ["follow_daily", "--stream", "x", "--parquet", "p", "--out", "o", "--format", "json"],
    ):
        with pytest.raises(SystemExit):
            jobs.main(argv)
    assert "needs" in capsys.readouterr().err
