"""Every SQL-checkable query equals its DuckDB oracle on the sf0.01 tables."""

import pytest

import __spark_entry__ as entry_mod
from shoplens.plans.registry import QUERIES as REPORTS
from tests.compare import compare, compare_frames, duckdb_connection
from tests.conftest import SF_ORACLE

QUERIES = entry_mod.queries()
ORACLE = {k: v for k, v in entry_mod.oracle_sql().items() if k in REPORTS}


@pytest.fixture(scope="module")
def con():
    return duckdb_connection(SF_ORACLE)


def test_every_query_has_an_oracle_or_is_listed():
    missing = set(REPORTS) - set(ORACLE)
    assert missing == set(entry_mod.NO_SQL_TWIN)
    assert set(REPORTS) <= set(QUERIES)
    assert set(ORACLE) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, con, name):
    ok, msg = compare(QUERIES[name](spark, SF_ORACLE), con, ORACLE[name])
    assert ok, msg


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_pandas_frames_equal_with_dtypes(spark, con, name):
    ok, msg = compare_frames(QUERIES[name](spark, SF_ORACLE), con, ORACLE[name])
    assert ok, msg


def test_entry_runs_on_smoke_data(spark):
    df = entry_mod.entry(spark)
    assert df.columns == ["day", "newRegCount", "totalMemberCount", "totalOrderCount", "gmv"]
    assert df.count() == 7


@pytest.mark.parametrize(
    "name", ["growth_report", "wow_daily_orders", "marketing_free_coupons", "date_standardise", "calendar_enrich"]
)
def test_results_do_not_depend_on_session_time_zone(spark, con, name):
    key = "spark.sql.session.timeZone"
    old = spark.conf.get(key)
    spark.conf.set(key, "Asia/Shanghai")
    try:
        ok, msg = compare(QUERIES[name](spark, SF_ORACLE), con, ORACLE[name])
    finally:
        spark.conf.set(key, old)
    assert ok, msg


@pytest.mark.parametrize(
    "name", ["member_overview", "growth_report_complete", "funnel_summary", "search_hot_words", "date_quality"]
)
def test_results_do_not_depend_on_configuration(spark, con, name):
    settings = {
        "spark.sql.adaptive.enabled": "false",
        "spark.sql.shuffle.partitions": "37",
        "spark.sql.ansi.enabled": "false",
        "spark.sql.codegen.wholeStage": "false",
    }
    old = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        ok, msg = compare(QUERIES[name](spark, SF_ORACLE), con, ORACLE[name])
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert ok, msg


SURVEY_KEYS = {
    "member_sex_distribution", "member_channel_distribution", "member_subscription_split",
    "member_heat", "member_overview", "growth_daily_registrations", "growth_daily_orders",
    "growth_prior_gmv", "growth_report", "growth_report_complete", "wow_daily_registrations",
    "wow_daily_orders", "marketing_free_coupons", "marketing_paid_coupons", "funnel_buyers",
    "funnel_repeat_buyers", "funnel_coupon_buyers", "funnel_repeat_and_coupon", "funnel_summary",
    "search_word_counts", "search_hot_words", "date_standardise", "date_quality", "calendar_enrich",
}


def test_every_survey_operator_is_registered_with_an_oracle():
    assert set(REPORTS) == SURVEY_KEYS
    assert set(ORACLE) == SURVEY_KEYS
