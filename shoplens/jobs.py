"""Command-line report jobs: read the shop tables, run a report, write or print it.

    python -m shoplens.jobs member   --catalog shop --out /shared/reports/member
    python -m shoplens.jobs growth   --parquet /data/shop --as-of 2019-11-30 --show
    python -m shoplens.jobs hotwords --log /data/search-logs/ --k 10 --show
    python -m shoplens.jobs daily    --catalog shop --summary /shared/daily            # whole history
    python -m shoplens.jobs daily    --catalog shop --summary /shared/daily --day 2019-11-29
    python -m shoplens.jobs growth   --summary /shared/daily --as-of 2019-11-30 --show
    python -m shoplens.jobs daily_coupons --catalog shop --summary /shared/coupons --day 2019-11-23 --to-day 2019-11-29
    python -m shoplens.jobs marketing --summary /shared/coupons --as-of 2019-11-30 --show
    python -m shoplens.jobs daily_funnel --catalog shop --summary /shared/funnel --day 2019-11-29
    python -m shoplens.jobs conversion --summary /shared/funnel --show
    python -m shoplens.jobs daily_words --log /data/search-logs/2019-11-29/ --summary /shared/words --day 2019-11-29
    python -m shoplens.jobs hotwords --summary /shared/words --from-day 2019-11-01 --k 10 --show
    python -m shoplens.jobs follow_words --log /data/search-logs/ --stream words --k 10 --out /shared/live
    python -m shoplens.jobs follow_daily --parquet /data/shop --stream daily --out /shared/days

Tables come from the Hive metastore's catalog (``<db>.t_member`` ...) or from
Parquet (``<dir>/t_member.parquet`` ...); the search log is text, date strings
a Parquet file or folder.  Results are written with ``--out`` (any Spark
format), to a catalog table with ``--table``, or printed as JSON lines with ``--show``: the whole result, one
partition at a time.  A result that is both written and printed is computed
once and printed from what was written.  Stored values that are not of their
column's declared type become NULL; how many, by column, is counted by the run
itself and written to standard error at its end.

``daily`` keeps the per-day summary of members and orders, ``daily_coupons``
that of coupons and ``daily_funnel`` the per-member state of the funnel, each
as a snapshot table: without ``--day`` it is built from the whole history,
with it that day (to ``--to-day``) is computed anew and takes the place of the
stored one, in one step, so a rerun changes nothing, a day that lost its rows
is gone and a killed job leaves the old table.  ``growth``,
``growth_complete`` and ``wow``, ``marketing``, and ``conversion`` read these
with ``--summary`` instead of the tables.

``follow_words`` and ``follow_daily`` are streams, named by ``--stream``: a run
works off the files that have appeared since the last one and ends.  The first
keeps the running word counts in its state and reports the hottest words of all
files so far; the second reads ``<dir>/t_member.parquet/`` and
``<dir>/t_order.parquet/`` as growing folders and appends the registrations and
orders of every day that is over (``--watermark`` later) to ``--out``, whose
rows it alone writes.
"""

from __future__ import annotations

import argparse
import datetime as dt
import json
import sys
import time
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shoplens import operators as op
from shoplens.functions.timewin import DayPartition, as_datetime, days_before
from shoplens.schemas import COUPON_MEMBER, MEMBER, ORDER, conform_counted, rejected_values
from shoplens.session import build_session, checkpoint_dir
from shoplens.sources.readers import read_catalog_table, read_parquet_table, read_text_log
from shoplens.sources.sinks import to_json_lines, write_report
from shoplens.sources.tables import bucketed_alike, write_table
from shoplens.stored import DailyWords, FunnelState, coupon_summary, growth_summary, read_daily
from shoplens.streaming import follow_daily_counts, follow_search_words
from shoplens.streaming.reports import parquet_stream

TABLES = {"t_member": MEMBER, "t_order": ORDER, "t_coupon_member": COUPON_MEMBER}


def _table(spark: SparkSession, args, name: str) -> DataFrame:
    schema = TABLES[name]
    if args.partition_day:
        schema = T.StructType(schema.fields + [T.StructField(args.partition_day, T.DateType())])
    # read by the stored schema, then narrow: stored types may differ
    # (e.g. TIMESTAMP rather than TIMESTAMP_NTZ)
    if args.catalog:
        stored = read_catalog_table(spark, f"{args.catalog}.{name}")
    else:
        stored = read_parquet_table(spark, args.parquet, name)
    rows, lost = conform_counted(stored, schema)
    if lost is not None:
        args.lost.append((name, lost, lambda: dict(map(tuple, rejected_values(stored, schema).collect()))))
    return rows


def _observed_dates(args, df: DataFrame) -> DataFrame:
    """The date strings' report, with texts of no known style counted as it runs."""
    lost = Observation()
    args.lost.append(("dates", lost, dict))
    bad = F.col(args.column).isNotNull() & F.col("style").isNull()
    return df.observe(lost, F.count(F.when(bad, True)).alias(args.column))


def _report_rejects(args) -> None:
    """One line on standard error: values that are not of their column's type, by column."""
    counted: dict[str, dict] = {}
    for name, lost, _ in args.lost:
        counted[name] = counted.get(name) or _metrics(lost)
    for name, _, count in args.lost:
        # Spark drops a table's counts with its plan where a result turns out empty
        counted[name] = counted[name] or count()
    rejected = {f"{name}.{column}": n for name, columns in counted.items() for column, n in columns.items() if n}
    print(json.dumps({"rejected": rejected}), file=sys.stderr)


def _metrics(lost: Observation) -> dict:
    # counts arrive just after their action; a plan that was found empty has none, and ``get`` would wait for ever
    until = time.monotonic() + 5
    while not lost._jo.future().isCompleted():
        if time.monotonic() > until:
            return {}
        time.sleep(0.05)
    return dict(lost._jo.getAsJava())  # empty where the action's plan did not hold the table


def _bucketed(spark: SparkSession, args) -> bool:
    """Whether the catalog's order and coupon tables are bucketed alike by member (views are not)."""
    names = [f"{args.catalog}.{name}" for name in ("t_order", "t_coupon_member")] if args.catalog else []
    return bool(names) and bucketed_alike(spark, "member_id", *names)


def _need(parser: argparse.ArgumentParser, args) -> None:
    """Stop with a message where a job's input is not named."""
    if args.job in FOLLOW_JOBS and not args.stream:
        parser.error(f"{args.job} needs --stream")
    if args.job == "follow_daily":
        if not (args.parquet and args.out) or args.table or args.format != "parquet":
            parser.error("follow_daily needs --parquet and --out, and writes nothing but Parquet")
    elif args.job in ("hotwords", "words", "daily_words", "follow_words"):
        if not args.log and not (args.summary and args.job in ("hotwords", "words")):
            parser.error(f"{args.job} needs --log")
        if args.job == "daily_words" and not args.day:
            parser.error("daily_words needs --day")
    elif args.job in ("standardise", "quality", "calendar"):
        if not args.dates:
            parser.error(f"{args.job} needs --dates")
    elif args.job in SUMMARY_JOBS and args.summary:
        pass
    elif not (args.catalog or args.parquet):
        parser.error(f"{args.job} needs --catalog or --parquet" + (" (or --summary)" if args.job in SUMMARY_JOBS else ""))
    if args.job in KEEPING_JOBS and not args.summary:
        parser.error(f"{args.job} needs --summary")
    if args.to_day and not args.day:
        parser.error("--to-day needs --day")


def _partition_day(args):
    if not args.partition_day:
        return None
    return DayPartition(args.partition_day, lag_days=args.partition_lag_days)


def _keep(spark: SparkSession, args, table, partition_day) -> None:
    """Build or renew the stored table of ``--summary``."""
    day, last = args.day, args.to_day or args.day
    if args.job == "daily_funnel":
        state, tables = FunnelState(spark, args.summary, args.buckets), (table("t_order"), table("t_coupon_member"))
        if day is None:
            state.rebuild(*tables)
            return
        at = as_datetime(day)
        while at <= as_datetime(last):
            state.replace_day(at, *tables, partition_day=partition_day)
            at = days_before(at, -1)
        return
    kept = (growth_summary if args.job == "daily" else coupon_summary)(spark, args.summary)
    names = ("t_member", "t_order") if args.job == "daily" else ("t_coupon_member",)
    tables = [table(name) for name in names]
    if day is None:
        kept.rebuild(*tables)
    else:
        kept.replace_days(day, last, *tables, partition_day=partition_day)


def _from_summary(spark: SparkSession, args, as_of) -> dict[str, DataFrame]:
    if args.job == "conversion":
        return {"funnel": FunnelState(spark, args.summary, args.buckets).summary(view=args.view, click=args.click)}
    # the running totals need all days before the window, the other series do not
    weeks = {"wow": 14, "marketing": 7}.get(args.job)
    daily = read_daily(spark, args.summary, days_before(as_of, weeks) if weeks else None)
    if args.job == "growth":
        return {"growth": op.growth_report_from_daily(daily, as_of=as_of)}
    if args.job == "growth_complete":
        return {"growth_complete": op.growth_report_complete_from_daily(daily, as_of=as_of)}
    if args.job == "marketing":
        return {
            "free": op.marketing_free_coupons_from_daily(daily, as_of=as_of),
            "paid": op.marketing_paid_coupons_from_daily(daily, as_of=as_of),
        }
    return {
        "registrations": op.wow_daily_registrations_from_daily(daily, as_of=as_of),
        "orders": op.wow_daily_orders_from_daily(daily, as_of=as_of),
    }


def _date_reports(spark: SparkSession, args, as_of) -> dict[str, DataFrame]:
    rows = spark.read.parquet(args.dates)
    if args.job == "standardise":
        return {"standardised": _observed_dates(args, op.date_standardise(rows, args.column))}
    if args.job == "quality":
        return {"quality": op.date_quality(rows, args.column)}
    return {"calendar": op.calendar_enrich(rows, args.column, reference_date=as_of)}


def _follow_daily(spark: SparkSession, args) -> None:
    """Append the days that are over, and print the whole series with ``--show``."""
    for name, table, column in (("registrations", "t_member", "id"), ("orders", "t_order", "order_id")):
        rows = parquet_stream(spark, f"{args.parquet.rstrip('/')}/{table}.parquet", TABLES[table])
        path = f"{args.out.rstrip('/')}/{name}"
        follow_daily_counts(
            rows, f"{args.stream}_{name}", path, count_col=column, out=name, watermark=args.watermark
        )
        if args.show:
            days = spark.read.schema(f"day string, {name} long").parquet(path).orderBy("day")
            for row in to_json_lines(days).toLocalIterator():
                print(row["value"])


def _reports(spark: SparkSession, args) -> dict[str, DataFrame]:
    job = args.job
    as_of = dt.datetime.fromisoformat(args.as_of)
    if job in ("hotwords", "words") and args.summary:
        kept = DailyWords(spark, args.summary)
        if job == "hotwords":
            return {"hot_words": kept.hot_words(args.k, args.from_day, args.day)}
        return {"word_counts": kept.counts(args.from_day, args.day)}
    if job == "daily_words":
        DailyWords(spark, args.summary).replace_day(args.day, read_text_log(spark, args.log))
        return {}
    if job == "follow_words":
        counts = follow_search_words(spark, args.log, args.stream)
        return {"hot_words": counts.orderBy(F.col("cnt").desc(), F.col("word").asc()).limit(args.k)}
    if job == "follow_daily":
        _follow_daily(spark, args)
        return {}
    if job == "hotwords":
        return {"hot_words": op.search_hot_words(read_text_log(spark, args.log), k=args.k)}
    if job == "words":
        return {"word_counts": op.search_word_counts(read_text_log(spark, args.log))}
    if job in ("standardise", "quality", "calendar"):
        return _date_reports(spark, args, as_of)
    if args.summary and job in SUMMARY_JOBS:
        return _from_summary(spark, args, as_of)
    pd = _partition_day(args)

    def table(name: str) -> DataFrame:
        return _table(spark, args, name)

    if job in KEEPING_JOBS:
        _keep(spark, args, table, pd)
        return {}
    if job == "member":
        tables = table("t_member"), table("t_order"), table("t_coupon_member")
        return {"member_overview": op.member_overview(*tables, bucketed=_bucketed(spark, args))}
    if job == "growth":
        return {"growth": op.growth_report(table("t_member"), table("t_order"), as_of=as_of, partition_day=pd)}
    if job == "growth_complete":
        return {
            "growth_complete": op.growth_report_complete(
                table("t_member"), table("t_order"), as_of=as_of, partition_day=pd
            )
        }
    if job == "wow":
        return {
            "registrations": op.wow_daily_registrations(table("t_member"), as_of=as_of, partition_day=pd),
            "orders": op.wow_daily_orders(table("t_order"), as_of=as_of, partition_day=pd),
        }
    if job == "marketing":
        return {
            "free": op.marketing_free_coupons(table("t_coupon_member"), as_of=as_of, partition_day=pd),
            "paid": op.marketing_paid_coupons(table("t_coupon_member"), as_of=as_of, partition_day=pd),
        }
    funnel = op.funnel_summary(
        table("t_order"),
        table("t_coupon_member"),
        view=args.view,
        click=args.click,
        bucketed=_bucketed(spark, args),
    )
    return {"funnel": funnel}


KEEPING_JOBS = ("daily", "daily_coupons", "daily_funnel", "daily_words")
SUMMARY_JOBS = ("growth", "growth_complete", "wow", "marketing", "conversion")
FOLLOW_JOBS = ("follow_words", "follow_daily")
JOBS = ["member", *SUMMARY_JOBS, *KEEPING_JOBS, *FOLLOW_JOBS, "hotwords", "words", "standardise", "quality", "calendar"]


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="shoplens.jobs")
    p.add_argument("job", choices=JOBS)
    src = p.add_mutually_exclusive_group()
    src.add_argument("--catalog", help="database holding t_member, t_order, t_coupon_member")
    src.add_argument("--parquet", help="directory holding <table>.parquet")
    p.add_argument("--summary", help="folder of the stored table (written by a daily job)")
    p.add_argument("--day", help="daily jobs: the day to compute anew (default: all)")
    p.add_argument("--to-day", help="daily jobs: the last of the days to compute anew (default: --day)")
    p.add_argument("--from-day", help="words, hotwords from --summary: the first day (--day: the last; default all)")
    p.add_argument("--buckets", type=int, default=256, help="parts of the funnel state, fixed when it is built")
    p.add_argument("--log", help="search log path (text, tab-separated)")
    p.add_argument("--stream", help="follow jobs: name of the stream, whose progress and state lie under spark.checkpoint.dir")
    p.add_argument("--watermark", default="1 day", help="follow_daily: how long after its day a row may come")
    p.add_argument("--dates", help="Parquet file or folder with a date column")
    p.add_argument("--column", default="ds", help="the date column")
    p.add_argument("--as-of", default=dt.date.today().isoformat())
    p.add_argument(
        "--partition-day",
        help="day column the tables are partitioned by (prunes partitions outside the window)",
    )
    p.add_argument("--partition-lag-days", type=int, default=0, help="most days a row's partition lies after its day")
    p.add_argument("--k", type=int, default=10)
    p.add_argument("--view", type=int, default=1000, help="conversion: page views")
    p.add_argument("--click", type=int, default=800, help="conversion: clicks")
    p.add_argument("--out", help="output folder; one sub-folder per result")
    p.add_argument("--format", default="parquet")
    p.add_argument("--table", help="catalog table to write to, db.name; with several results db.name_<result>")
    p.add_argument(
        "--table-partition", action="append", help="partition column of the table; then only written partitions are replaced"
    )
    p.add_argument("--show", action="store_true", help="print results as JSON lines")
    args = p.parse_args(argv)
    args.lost = []
    _need(p, args)
    spark = build_session(hive=bool(args.catalog or args.table))
    reports = _reports(spark, args)
    for name, df in reports.items():
        if args.table:
            table = args.table if len(reports) == 1 else f"{args.table}_{name}"
            write_table(df, table, args.table_partition, keep_other_partitions=bool(args.table_partition))
            df = spark.table(table) if args.show else df
        if args.out:
            path = f"{args.out.rstrip('/')}/{name}"
            write_report(df, path, fmt=args.format)
            df = spark.read.schema(df.schema).format(args.format).load(path) if args.show else df
        if args.lost and not (args.out or args.table):
            # counts need an action that ends before the rows are printed
            path = f"{checkpoint_dir(spark).rstrip('/')}/{args.job}-{uuid.uuid4().hex}"
            df.write.parquet(path)
            df = spark.read.schema(df.schema).parquet(path)
        if args.show or not (args.out or args.table):
            for row in to_json_lines(df).toLocalIterator():
                print(row["value"])
    _report_rejects(args)
    return 0


if __name__ == "__main__":
    sys.exit(main())
