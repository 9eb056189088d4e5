"""Properties over seeded random rows."""

import datetime as dt
import random

from pyspark.sql import functions as F

from shoplens import operators as op
from shoplens.functions.dates import DATE_STYLES
from tests.helpers import coupons_df, log_df, members_df, orders_df

AS_OF = dt.datetime(2020, 3, 1)


def _random_tables(spark, seed):
    rnd = random.Random(seed)
    base = AS_OF - dt.timedelta(days=40)
    members = []
    for i in range(1, 301):
        members.append(
            (
                i if rnd.random() > 0.02 else None,
                rnd.choice([0, 1, 2, None]),
                rnd.randint(1, 5),
                rnd.choice(["null", None, f"mp{i}"]),
                rnd.choice(["null", None, f"1{i}"]),
                base + dt.timedelta(minutes=rnd.randint(0, 60 * 24 * 45)),
            )
        )
    orders = []
    for i in range(1, 1201):
        orders.append(
            (
                i,
                rnd.choice([None] + list(range(1, 200))),
                rnd.choice([0, 1, 2, 2]),
                round(rnd.uniform(0, 500), 2),
                base + dt.timedelta(minutes=rnd.randint(0, 60 * 24 * 45)),
            )
        )
    coupons = [
        (rnd.choice([None] + list(range(1, 200))), rnd.randint(1, 3), rnd.randint(1, 2),
         base + dt.timedelta(minutes=rnd.randint(0, 60 * 24 * 45)))
        for _ in range(400)
    ]
    return members_df(spark, members), orders_df(spark, orders), coupons_df(spark, coupons)


def test_distributions_sum_to_members(spark):
    m, _, _ = _random_tables(spark, 1)
    with_id = m.filter(F.col("id").isNotNull()).count()
    assert op.member_sex_distribution(m).agg(F.sum("sexCount")).first()[0] == with_id
    assert op.member_channel_distribution(m).agg(F.sum("channelCount")).first()[0] == with_id


def test_overview_agrees_with_parts(spark):
    m, o, c = _random_tables(spark, 2)
    ov = op.member_overview(m, o, c).first()
    def code_order(r):  # array_sort puts a NULL code first
        return (r[0] is not None, r[0] if r[0] is not None else 0)

    sexes = sorted((tuple(r) for r in op.member_sex_distribution(m).collect()), key=code_order)
    assert [(s["memberSex"], s["sexCount"]) for s in ov["memberSexs"]] == sexes
    assert any(s["memberSex"] is None for s in ov["memberSexs"])
    channels = sorted(tuple(r) for r in op.member_channel_distribution(m).collect())
    assert [(s["memberChannel"], s["channelCount"]) for s in ov["memberChannels"]] == channels
    split = op.member_subscription_split(m).first()
    assert [tuple(x) for x in ov["memberMpSubs"]] == [tuple(split)]
    heat = op.member_heat(m, o, c).first()
    assert ov["memberHeat"].asDict() == heat.asDict()
    assert ov["report"].startswith('{"memberSexs":[')


def test_funnel_is_monotone(spark):
    _, o, c = _random_tables(spark, 3)
    s = op.funnel_summary(o, c).first()
    assert s["chargeCoupon"] <= s["orderAgain"] <= s["order"]
    assert s["order"] == op.funnel_buyers(o).count()
    assert s["orderAgain"] == op.funnel_repeat_buyers(o).count()
    assert s["chargeCoupon"] == op.funnel_repeat_and_coupon(o, c).count()


def test_heat_order_counts_partition_buyers(spark):
    m, o, c = _random_tables(spark, 4)
    heat = op.member_heat(m, o, c).first()
    buyers = o.groupBy("member_id").count().count()
    assert heat["order"] + heat["orderAgain"] == buyers


def test_running_totals_never_fall_and_end_at_total(spark):
    m, o, _ = _random_tables(spark, 5)
    rows = op.growth_report_complete(m, o, as_of=AS_OF).collect()
    gmv = [r["gmv"] for r in rows]
    assert gmv == sorted(gmv)
    before = o.filter(F.col("create_time") < F.lit(AS_OF)).agg(
        F.round(F.sum(F.col("origin_price").cast("decimal(18,2)")), 2).cast("double")
    ).first()[0]
    assert gmv[-1] == before
    report = op.growth_report(m, o, as_of=AS_OF).collect()
    assert [r["gmv"] for r in report] == sorted(r["gmv"] for r in report)


def test_top_k_is_a_subset_of_counts(spark):
    rnd = random.Random(6)
    lines = [f"{i}\tu\t{rnd.choice('abcdefghijklmnop')}{rnd.randint(0, 5)}" for i in range(3000)]
    log = log_df(spark, lines)
    counts = {r["word"]: r["cnt"] for r in op.search_word_counts(log).collect()}
    top = op.search_hot_words(log, k=10).collect()
    assert len(top) == 10
    assert all(counts[r["word"]] == r["cnt"] for r in top)
    assert min(r["cnt"] for r in top) >= sorted(counts.values(), reverse=True)[9]


def test_format_then_standardise_round_trips(spark):
    rnd = random.Random(7)
    base = dt.datetime(2001, 1, 1)
    stamps = [base + dt.timedelta(seconds=rnd.randint(0, 10**9)) for _ in range(200)]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(stamps)], "event_id long, t timestamp_ntz")
    for name, pattern in DATE_STYLES:
        if not all(tok in pattern for tok in ("yyyy", "MM", "dd", "HH", "mm", "ss")):
            continue
        out = op.date_standardise(df.withColumn("ds", F.date_format("t", pattern)), "ds")
        bad = out.filter((F.col("ts") != F.col("t")) | (F.col("style") != name)).count()
        assert bad == 0, name


def test_shape_dispatch_equals_brute_force(spark):
    """Every style is matched exactly as a strict parse with its pattern."""
    rnd = random.Random(8)
    pieces = ["2019", "19", "1", "01", "11", "12", "13", "29", "30", "31", "00", "23", "24", "59", "60",
              "-", "/", ":", " ", "年", "月", "日", "x", "d", ""]
    values = ["".join(rnd.choice(pieces) for _ in range(rnd.randint(1, 9))) for _ in range(3000)]
    base = dt.datetime(2000, 2, 29, 23, 59, 58)
    for _, p in DATE_STYLES:
        for k in range(40):
            values.append((base + dt.timedelta(hours=37 * k, seconds=k)).strftime(
                p.replace("yyyy", "%Y").replace("MM", "%m").replace("dd", "%d")
                 .replace("HH", "%H").replace("mm", "%M").replace("ss", "%S")))
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "event_id long, ds string")
    brute = F.coalesce(*[F.try_to_timestamp(F.col("ds"), F.lit(p)) for _, p in DATE_STYLES])
    out = op.date_standardise(df, "ds").withColumn("brute", brute.cast("timestamp_ntz"))
    diff = out.filter(~F.col("ts").eqNullSafe(F.col("brute")))
    assert diff.count() == 0, diff.limit(5).collect()


def test_overview_passes_heat_options(spark):
    m, o, c = _random_tables(spark, 9)
    for options in ({"status": 2}, {"null_as_missing": True}, {"status": 2, "null_as_missing": True}):
        ov = op.member_overview(m, o, c, **options).first()
        assert ov["memberHeat"].asDict() == op.member_heat(m, o, c, **options).first().asDict(), options


def test_growth_report_equals_the_original_algorithm(spark):
    from decimal import Decimal

    m, o, _ = _random_tables(spark, 10)
    start = AS_OF - dt.timedelta(days=7)
    pm, po = m.toPandas(), o.toPandas()
    pm = pm[pm.create_time >= start].assign(day=lambda x: x.create_time.dt.strftime("%Y-%m-%d"))
    po_win = po[po.create_time >= start].assign(day=lambda x: x.create_time.dt.strftime("%Y-%m-%d"))
    money = lambda s: sum((Decimal(str(v)) for v in s if v == v), Decimal(0))
    r = pm.groupby("day").agg(newRegCount=("id", "count"), totalMemberCount=("id", "max"))
    g = po_win.groupby("day").agg(totalOrderCount=("order_id", "max"), g=("origin_price", money))
    joined = r.join(g, how="inner").sort_index()
    running = money(po[po.create_time < start].origin_price)
    want = []
    for day, row in joined.iterrows():
        running += row["g"]
        want.append((day, int(row["newRegCount"]), int(row["totalMemberCount"]),
                     int(row["totalOrderCount"]), float(round(running, 2))))
    got = [tuple(r) for r in op.growth_report(m, o, as_of=AS_OF).collect()]
    assert got == want
