"""Results do not depend on how the input is partitioned."""


from shoplens import operators as op
from shoplens.sources import canonical as src
from tests.conftest import SF_SMALL


def _inputs(spark, n):
    m = src.members(spark, SF_SMALL).repartition(n)
    o = src.orders(spark, SF_SMALL).repartition(n)
    c = src.coupon_members(spark, SF_SMALL).repartition(n)
    log = src.search_log(spark, SF_SMALL).repartition(n)
    return m, o, c, log


def _results(spark, n):
    m, o, c, log = _inputs(spark, n)
    as_of = "2001-07-25"
    out = {
        "heat": op.member_heat(m, o, c),
        "growth": op.growth_report(m, o, as_of=as_of),
        "complete": op.growth_report_complete(m, o, as_of=as_of),
        "funnel": op.funnel_summary(o, c),
        "hot": op.search_hot_words(log, k=10),
        "sex": op.member_sex_distribution(m),
    }
    return {k: sorted(tuple(r) for r in v.collect()) for k, v in out.items()}


def test_partition_independence(spark):
    base = _results(spark, 1)
    for n in (4, 17):
        assert _results(spark, n) == base


def test_canonical_schemas(spark):
    from shoplens.schemas import COUPON_MEMBER, MEMBER, ORDER, SEARCH_LOG

    def shape(schema):  # names and types; nullability may be narrower
        return [(f.name, f.dataType) for f in schema.fields]

    assert shape(src.members(spark, SF_SMALL).schema) == shape(MEMBER)
    assert shape(src.orders(spark, SF_SMALL).schema) == shape(ORDER)
    assert shape(src.coupon_members(spark, SF_SMALL).schema) == shape(COUPON_MEMBER)
    assert shape(src.search_log(spark, SF_SMALL).schema) == shape(SEARCH_LOG)
