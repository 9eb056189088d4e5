"""The command-line jobs read stored tables and write the same reports."""

import os
import tempfile

from shoplens import jobs
from shoplens import operators as op
from shoplens.sources import canonical as src
from tests.conftest import SF_SMALL


def test_jobs_round_trip(spark, capsys):
    base = tempfile.mkdtemp(prefix="shoplens-jobs-")
    m, o, c = src.members(spark, SF_SMALL), src.orders(spark, SF_SMALL), src.coupon_members(spark, SF_SMALL)
    m.write.parquet(os.path.join(base, "t_member.parquet"))
    o.write.parquet(os.path.join(base, "t_order.parquet"))
    c.write.parquet(os.path.join(base, "t_coupon_member.parquet"))
    src.search_log(spark, SF_SMALL).write.text(os.path.join(base, "log"))
    out = os.path.join(base, "out")

    assert jobs.main(["conversion", "--parquet", base, "--out", out]) == 0
    got = spark.read.parquet(os.path.join(out, "funnel")).collect()
    assert [tuple(r) for r in got] == [tuple(r) for r in op.funnel_summary(o, c).collect()]

    assert jobs.main(["growth", "--parquet", base, "--as-of", "2001-07-25", "--out", out]) == 0
    got = sorted(tuple(r) for r in spark.read.parquet(os.path.join(out, "growth")).collect())
    want = sorted(tuple(r) for r in op.growth_report(m, o, as_of="2001-07-25").collect())
    assert got == want

    assert jobs.main(["hotwords", "--log", os.path.join(base, "log"), "--show"]) == 0
    printed = capsys.readouterr().out.strip().splitlines()
    assert len(printed) == 10 and printed[0].startswith('{"word":')

    assert jobs.main(["member", "--parquet", base, "--show"]) == 0
    printed = capsys.readouterr().out.strip().splitlines()
    assert len(printed) == 1 and '"memberHeat"' in printed[0]


def test_conform_converts_text_columns(spark):
    from shoplens.schemas import MEMBER, conform

    raw = spark.createDataFrame(
        [("1", "1", "2", "x", "138", "2019-11-30 10:00:00"), ("2", "0", "1", "null", "null", "junk")],
        "id string, sex string, member_channel string, mp_open_id string, phone string, create_time string",
    )
    got = conform(raw, MEMBER).orderBy("id").collect()
    assert [(f.name, f.dataType) for f in conform(raw, MEMBER).schema.fields] == [
        (f.name, f.dataType) for f in MEMBER.fields
    ]
    assert got[0]["create_time"].isoformat() == "2019-11-30T10:00:00"
    assert got[1]["create_time"] is None


def test_jobs_accept_ltz_timestamps(spark):
    from pyspark.sql import functions as F

    base = tempfile.mkdtemp(prefix="shoplens-jobs-ltz-")
    o = src.orders(spark, SF_SMALL).withColumn("create_time", F.col("create_time").cast("timestamp"))
    c = src.coupon_members(spark, SF_SMALL).withColumn("create_time", F.col("create_time").cast("timestamp"))
    o.write.parquet(os.path.join(base, "t_order.parquet"))
    c.write.parquet(os.path.join(base, "t_coupon_member.parquet"))
    out = os.path.join(base, "out")
    assert jobs.main(["conversion", "--parquet", base, "--out", out]) == 0
    want = op.funnel_summary(src.orders(spark, SF_SMALL), src.coupon_members(spark, SF_SMALL))
    assert [tuple(r) for r in spark.read.parquet(os.path.join(out, "funnel")).collect()] == [
        tuple(r) for r in want.collect()
    ]


def test_jobs_read_catalog_tables(spark, capsys):
    src.members(spark, SF_SMALL).createOrReplaceGlobalTempView("t_member")
    src.orders(spark, SF_SMALL).createOrReplaceGlobalTempView("t_order")
    src.coupon_members(spark, SF_SMALL).createOrReplaceGlobalTempView("t_coupon_member")
    capsys.readouterr()
    assert jobs.main(["wow", "--catalog", "global_temp", "--as-of", "2001-07-25", "--show"]) == 0
    printed = capsys.readouterr().out.strip().splitlines()
    want = op.wow_daily_registrations(src.members(spark, SF_SMALL), as_of="2001-07-25").count()
    want += op.wow_daily_orders(src.orders(spark, SF_SMALL), as_of="2001-07-25").count()
    assert len(printed) == want and all(line.startswith('{"day":') for line in printed)


def test_jobs_on_day_partitioned_tables(spark):
    from pyspark.sql import functions as F

    base = tempfile.mkdtemp(prefix="shoplens-jobs-parted-")
    for name, df in [("t_member", src.members(spark, SF_SMALL)), ("t_order", src.orders(spark, SF_SMALL))]:
        df.withColumn("dt", F.to_date("create_time")).write.partitionBy("dt").parquet(
            os.path.join(base, f"{name}.parquet")
        )
    out = os.path.join(base, "out")
    args = ["wow", "--parquet", base, "--as-of", "2001-07-25", "--partition-day", "dt", "--out", out]
    assert jobs.main(args) == 0
    got = sorted(tuple(r) for r in spark.read.parquet(os.path.join(out, "orders")).collect())
    want = sorted(tuple(r) for r in op.wow_daily_orders(src.orders(spark, SF_SMALL), as_of="2001-07-25").collect())
    assert got == want
