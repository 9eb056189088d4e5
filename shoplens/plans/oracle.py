"""DuckDB SQL that computes every report independently of Spark.

The test tables are registered in DuckDB under their own names; the
canonical shop tables are rebuilt from them as CTEs with the same rules as
``shoplens.sources.canonical``.  Money is a plain sum rounded to cents at the
end, whatever the Spark side does to sum it; counts are BIGINT on both sides.
"""

from __future__ import annotations

from shoplens.functions.dates import DATE_STYLES, WEEKDAYS
from shoplens.plans.registry import CALENDAR_REFERENCE, GROWTH_AS_OF, MARKETING_AS_OF
from shoplens.functions.timewin import days_before

_T_MEMBER = """t_member as (
  select c_custkey + 1 as id,
         c_nationkey % 3 as sex,
         case c_mktsegment when 'AUTOMOBILE' then 1 when 'BUILDING' then 2
              when 'FURNITURE' then 3 when 'HOUSEHOLD' then 4 else 5 end as member_channel,
         case when c_nationkey % 4 = 0 then 'null' when c_nationkey % 4 = 1 then null
              else concat('mp_', cast(c_custkey as varchar)) end as mp_open_id,
         case when c_nationkey % 5 = 0 then 'null' when c_nationkey % 5 = 1 then null
              else concat('1', cast(c_custkey as varchar)) end as phone,
         timestamp '1995-01-01 00:00:00'
           + to_days(cast((c_custkey * 1601) % 2404 as int))
           + to_hours(cast(c_custkey % 24 as int)) as create_time
  from customer)"""

_T_ORDER = """t_order as (
  select o_orderkey as order_id,
         o_custkey + 1 as member_id,
         case o_orderstatus when 'F' then 2 when 'O' then 1 else 0 end as order_status,
         o_totalprice as origin_price,
         o_orderdate as create_time
  from orders)"""

_T_COUPON = """t_coupon_member as (
  select user_id + 1 as member_id,
         1 + event_id % 3 as coupon_id,
         1 + event_id % 2 as coupon_channel,
         ts as create_time
  from events where event_type in ('purchase', 'signup'))"""

_T_SEARCH = """t_search_log as (
  select concat_ws(chr(9), cast(event_id as varchar), cast(user_id as varchar),
                   event_type || '_' || json_extract_string(props, '$.k'),
                   cast(value as varchar)) as value
  from events)"""

_STRFTIME = (("yyyy", "%Y"), ("MM", "%m"), ("dd", "%d"), ("HH", "%H"), ("mm", "%M"), ("ss", "%S"))


def strftime_format(pattern: str) -> str:
    for spark_token, duck_token in _STRFTIME:
        pattern = pattern.replace(spark_token, duck_token)
    return pattern


def _t_dates() -> str:
    arms = "\n".join(
        f"       when {i} then strftime(ts, '{strftime_format(p)}')"
        for i, (_, p) in enumerate(DATE_STYLES)
    )
    return f"""t_dates as (
  select event_id,
    case event_id % {len(DATE_STYLES) + 1}
{arms}
       else 'n/a' end as ds
  from events)"""


def _with(*ctes: str) -> str:
    return "with " + ",\n".join(ctes) + "\n"


def _ts(value) -> str:
    return f"timestamp '{value:%Y-%m-%d %H:%M:%S}'"


def _money_sum(expr: str = "origin_price") -> str:
    return f"sum({expr})"


def _money_out(expr: str) -> str:
    return f"cast(round({expr}, 2) as double)"


def _style_sql() -> str:
    arms = "\n".join(
        f"    when try_strptime(ds, '{strftime_format(p)}') is not null then '{name}'"
        for name, p in DATE_STYLES
    )
    return f"case\n{arms}\n  end"


def _standardised_sql() -> str:
    formats = ", ".join(f"'{strftime_format(p)}'" for _, p in DATE_STYLES)
    yearless = ", ".join(f"'{name}'" for name, p in DATE_STYLES if "yyyy" not in p)
    # DuckDB fills a missing year with 1900, Spark with 1970
    return f"""select event_id, ds, style,
       case when style in ({yearless}) then t + interval 70 year else t end as ts
from (select event_id, ds, try_strptime(ds, [{formats}]) as t,
             {_style_sql()} as style
      from t_dates) x"""


def _own_style(moved: str) -> str:
    """A moved time written in the row's own style."""
    arms = " ".join(f"when '{name}' then strftime({moved}, '{strftime_format(p)}')" for name, p in DATE_STYLES)
    return f"case when ts is null then null else case style {arms} end end"


def _weekday_list(field: int) -> str:
    return "[" + ", ".join(f"'{w[field]}'" for w in WEEKDAYS) + "]"


_HEAT = """select c.coupon, r.reg, r.complete, o."order", o."orderAgain"
from (select count(distinct member_id) as coupon from t_coupon_member) c
cross join (select count(case when phone = 'null' then 1 end) as reg,
                   count(case when phone != 'null' then 1 end) as complete from t_member) r
cross join (select count(case when n = 1 then 1 end) as "order",
                   count(case when n >= 2 then 1 end) as "orderAgain"
            from (select member_id, count(order_id) as n from t_order group by member_id) t) o"""


def _member_overview_sql() -> str:
    """The overview document: both distributions as code-sorted lists, the
    subscription split as a one-element list and the heat row, as JSON."""
    return _with(
        _T_MEMBER,
        _T_ORDER,
        _T_COUPON,
        "sx as (select sex, count(id) as n from t_member group by sex)",
        "ch as (select member_channel, count(id) as n from t_member group by member_channel)",
        "sub as (select count(case when mp_open_id != 'null' then 1 end) as s,\n"
        "               count(case when mp_open_id = 'null' then 1 end) as u from t_member)",
        f"h as ({_HEAT})",
    ) + """select to_json(struct_pack(
  "memberSexs" := (select list(struct_pack("memberSex" := sex, "sexCount" := n) order by sex, n) from sx),
  "memberChannels" := (select list(struct_pack("memberChannel" := member_channel, "channelCount" := n)
                                   order by member_channel, n) from ch),
  "memberMpSubs" := (select list(struct_pack("subCount" := s, "unSubCount" := u)) from sub),
  "memberHeat" := (select struct_pack(coupon := coupon, reg := reg, complete := complete,
                                      "order" := "order", "orderAgain" := "orderAgain") from h)
)) as report"""


def oracle_queries() -> dict[str, str]:
    g_start = _ts(days_before(GROWTH_AS_OF, 7))
    w_start = _ts(days_before(GROWTH_AS_OF, 14))
    g_end = _ts(GROWTH_AS_OF)
    m_start = _ts(days_before(MARKETING_AS_OF, 7))
    day = "strftime(create_time, '%Y-%m-%d')"
    repeat = (
        "select member_id from t_order where order_status = 2 "
        "group by member_id having count(order_id) >= 2"
    )
    coupon_buyers = (
        "select distinct member_id from t_coupon_member "
        "where coupon_id != 1 and coupon_channel = 1"
    )
    q: dict[str, str] = {}
    q["member_sex_distribution"] = _with(_T_MEMBER) + (
        'select sex as "memberSex", count(id) as "sexCount" from t_member group by sex'
    )
    q["member_channel_distribution"] = _with(_T_MEMBER) + (
        'select member_channel as "memberChannel", count(id) as "channelCount" '
        "from t_member group by member_channel"
    )
    q["member_subscription_split"] = _with(_T_MEMBER) + (
        "select count(case when mp_open_id != 'null' then 1 end) as \"subCount\",\n"
        "       count(case when mp_open_id = 'null' then 1 end) as \"unSubCount\" from t_member"
    )
    q["member_heat"] = _with(_T_MEMBER, _T_ORDER, _T_COUPON) + _HEAT
    q["member_overview"] = _member_overview_sql()
    q["growth_daily_registrations"] = _with(_T_MEMBER) + (
        f'select {day} as day, count(id) as "newRegCount", max(id) as "totalMemberCount"\n'
        f"from t_member where create_time >= {g_start} group by 1"
    )
    q["growth_daily_orders"] = _with(_T_ORDER) + (
        f'select {day} as day, max(order_id) as "totalOrderCount", '
        f"{_money_out(_money_sum())} as gmv\n"
        f"from t_order where create_time >= {g_start} group by 1"
    )
    q["growth_prior_gmv"] = _with(_T_ORDER) + (
        f'select {_money_out(_money_sum())} as "totalGmv" from t_order '
        f"where create_time < {g_start}"
    )
    q["growth_report"] = _with(
        _T_MEMBER,
        _T_ORDER,
        f"""r as (select {day} as day, count(id) as "newRegCount", max(id) as "totalMemberCount"
           from t_member where create_time >= {g_start} group by 1)""",
        f"""o as (select {day} as day, max(order_id) as "totalOrderCount", {_money_sum()} as g
           from t_order where create_time >= {g_start} group by 1)""",
        f"""p as (select coalesce({_money_sum()}, 0) as pg from t_order where create_time < {g_start})""",
    ) + (
        'select r.day, "newRegCount", "totalMemberCount", "totalOrderCount",\n'
        "       "
        + _money_out("pg + sum(g) over (order by r.day rows between unbounded preceding and current row)")
        + " as gmv\nfrom r join o on r.day = o.day cross join p"
    )
    q["growth_report_complete"] = _with(
        _T_MEMBER,
        _T_ORDER,
        f"d as (select unnest(generate_series({g_start}, {g_end} - interval 1 day, interval 1 day)) as d)",
    ) + (
        "select strftime(d, '%Y-%m-%d') as day,\n"
        '  (select count(id) from t_member m where m.create_time >= d and m.create_time < d + interval 1 day) as "newRegCount",\n'
        '  (select count(id) from t_member m where m.create_time < d + interval 1 day) as "totalMemberCount",\n'
        '  (select count(order_id) from t_order o where o.create_time < d + interval 1 day) as "totalOrderCount",\n'
        f"  (select {_money_out('coalesce(' + _money_sum() + ', 0)')} from t_order o where o.create_time < d + interval 1 day) as gmv\n"
        "from d"
    )
    q["wow_daily_registrations"] = _with(_T_MEMBER) + (
        f'select {day} as day, count(id) as "regCount" from t_member\n'
        f"where create_time >= {w_start} and create_time < {g_end} group by 1"
    )
    q["wow_daily_orders"] = _with(_T_ORDER) + (
        f'select {day} as day, count(order_id) as "orderCount" from t_order\n'
        f"where create_time >= {w_start} and create_time < {g_end} group by 1"
    )
    q["marketing_free_coupons"] = _with(_T_COUPON) + (
        f'select {day} as day, count(member_id) as "freeCount" from t_coupon_member\n'
        f"where coupon_id = 1 and coupon_channel = 2 and create_time > {m_start} group by 1"
    )
    q["marketing_paid_coupons"] = _with(_T_COUPON) + (
        f'select {day} as day, count(member_id) as "couponCount" from t_coupon_member\n'
        f"where coupon_id != 1 and create_time > {m_start} group by 1"
    )
    q["funnel_buyers"] = _with(_T_ORDER) + "select distinct member_id from t_order where order_status = 2"
    q["funnel_repeat_buyers"] = _with(_T_ORDER) + repeat
    q["funnel_coupon_buyers"] = _with(_T_COUPON) + coupon_buyers
    q["funnel_repeat_and_coupon"] = _with(_T_ORDER, _T_COUPON) + (
        f"select distinct c.member_id from ({coupon_buyers}) c\n"
        f"join ({repeat}) a on a.member_id = c.member_id"
    )
    q["funnel_summary"] = _with(_T_ORDER, _T_COUPON, f"a as ({repeat})") + (
        "select cast(1000 as bigint) as view, cast(800 as bigint) as click,\n"
        '  (select count(*) from (select distinct member_id from t_order where order_status = 2) x) as "order",\n'
        '  (select count(*) from a) as "orderAgain",\n'
        f'  (select count(*) from a join ({coupon_buyers}) c on a.member_id = c.member_id) as "chargeCoupon"'
    )
    words = "select split_part(value, chr(9), 3) as word from t_search_log"
    q["search_word_counts"] = _with(_T_SEARCH) + (
        f"select word, count(*) as cnt from ({words}) t where word != '' group by word"
    )
    q["search_hot_words"] = _with(_T_SEARCH) + (
        f"select word, count(*) as cnt from ({words}) t where word != '' group by word\n"
        "order by cnt desc, word limit 10"
    )
    # timestamps leave as TIMESTAMP_NS: same values, and the same pandas
    # dtype (datetime64[ns]) as Spark's toPandas()
    q["date_standardise"] = _with(_t_dates(), f"s as ({_standardised_sql()})") + (
        "select event_id, ds, cast(ts as timestamp_ns) as ts,\n"
        "       case when ts is null then null else style end as style,\n"
        "       strftime(ts, '%Y-%m-%d %H:%M:%S') as ds_std,\n"
        "       strftime(ts, '%Y-%m-%d') as ds_date, strftime(ts, '%H:%M:%S') as ds_time,\n"
        f"       {_own_style('ts + interval 1 day')} as ds_next_day,\n"
        f"       {_own_style('ts - interval 90 minute')} as ds_earlier from s"
    )
    q["date_quality"] = _with(_t_dates(), f"s as ({_standardised_sql()})") + (
        "select case when ts is null then 'rejected' else style end as style, count(*) as n\n"
        "from s group by 1"
    )
    q["calendar_enrich"] = f"""select event_id, cast(ts as timestamp_ns) as ts, year(ts) as y, month(ts) as m, day(ts) as d,
       hour(ts) as h, minute(ts) as mi, cast(second(ts) as bigint) as s,
       dayname(ts) as weekday, isodow(ts) as weekday_no,
       {_weekday_list(0)}[isodow(ts)] as weekday_cn,
       {_weekday_list(2)}[isodow(ts)] as weekday_short,
       cast(ts + interval 1 month as timestamp_ns) as next_month,
       cast(ts - interval 7 day as timestamp_ns) as week_before,
       cast(ts + interval 1 year as timestamp_ns) as next_year,
       cast(ts + interval 36 hour as timestamp_ns) as hours_on,
       cast(ts - interval 90 minute as timestamp_ns) as minutes_before,
       cast(ts + interval 4000 second as timestamp_ns) as seconds_on,
       abs(date_diff('day', ts, date '{CALENDAR_REFERENCE:%Y-%m-%d}')) as days_to
from events"""
    return q
