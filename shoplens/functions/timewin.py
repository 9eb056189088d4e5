"""As-of windows and day keys.

Window bounds are computed on the driver from the ``as_of`` parameter and
enter the plan as typed TIMESTAMP_NTZ literals, so a comparison against the
raw ``create_time`` column is pushed into the Parquet scan.  A filter is
never written on a formatted day string.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

DAY_FORMAT = "yyyy-MM-dd"


def as_datetime(value: dt.date | dt.datetime | str) -> dt.datetime:
    """Normalise an as-of parameter to a naive datetime at its given time."""
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None)
    if isinstance(value, dt.date):
        return dt.datetime(value.year, value.month, value.day)
    return dt.datetime.fromisoformat(str(value))


def days_before(as_of, days: int) -> dt.datetime:
    """``as_of`` shifted back by ``days`` calendar days."""
    return as_datetime(as_of) - dt.timedelta(days=days)


def is_midnight(value) -> bool:
    t = as_datetime(value)
    return t == dt.datetime.combine(t.date(), dt.time())


def require_midnight(value) -> None:
    """Per-day summaries hold whole days only."""
    if not is_midnight(value):
        raise ValueError("a per-day summary answers windows that start and end at midnight only")


def ts_lit(value) -> Column:
    """A TIMESTAMP_NTZ literal (pushable into Parquet filters).

    Built from text, so neither the Python process's nor the session's time
    zone can shift it.
    """
    return F.lit(as_datetime(value).isoformat(sep=" ")).cast("timestamp_ntz")


def date_lit(value) -> Column:
    return F.lit(as_datetime(value).date())


def day_key(ts: Column) -> Column:
    """Grouping key for a calendar day: a DATE (4 bytes, cheap to hash)."""
    return F.to_date(ts)


def day_label(day: Column) -> Column:
    """The ``yyyy-MM-dd`` text the reports show for a day key."""
    return F.date_format(day, DAY_FORMAT)


# Amounts.  A DECIMAL column keeps its own scale.  A floating-point amount of
# whole cents (nearly all are) is summed as cents in two longs, its upper bits
# and its lower MONEY_BITS: no sum of fewer than 2^42 rows can overflow.  Any
# other below MONEY_EXACT is summed as a decimal of MONEY_SCALE places.  So
# sums are exact and do not depend on the order partitions are combined in; a
# larger finite one (it has no cents left to lose) goes into a third,
# floating-point sum; NaN and infinite amounts are in none and are counted.
MONEY_SCALE = 10
MONEY_EXACT = "1e15"
MONEY_CENTS = "1e10"
MONEY_BITS = 20


def money_rows(kind: T.DataType, amount: str = "origin_price") -> dict[str, str]:
    """What :func:`money_sums` adds up, per row, as SQL text: ``cents`` (a long) and ``rest``
    (the amount itself where it is not in ``cents``)."""
    if isinstance(kind, T.DecimalType):
        scale = max(kind.scale, MONEY_SCALE) if kind.precision - kind.scale <= 28 else kind.scale
        return {"cents": "CAST(NULL AS BIGINT)", "rest": f"CAST({amount} AS DECIMAL(38,{scale}))"}
    x = amount if isinstance(kind, T.DoubleType) else f"CAST({amount} AS DOUBLE)"
    cents = f"rint({x} * 100D)"
    # dividing back gives the same double only if the amount's decimal text has at most two places
    whole = f"abs({x}) < {MONEY_CENTS}D AND {cents} / 100D = {x}"
    return {
        "cents": f"CASE WHEN {whole} THEN CAST({cents} AS BIGINT) END",
        "rest": f"CASE WHEN {whole} THEN NULL ELSE {x} END",
    }


def money_sums(kind: T.DataType) -> dict[str, str]:
    """Aggregates over the columns of :func:`money_rows` as SQL text: the parts of
    :func:`money_total`, and ``big_amount`` (double)."""
    if isinstance(kind, T.DecimalType):
        return {"exact": "sum(rest)", "big_amount": "sum(CAST(NULL AS DOUBLE))"}
    return {
        "cents_high": f"sum(shiftright(cents, {MONEY_BITS}))",
        "cents_low": f"sum(cents & {2**MONEY_BITS - 1}L)",
        "exact": f"sum(CAST(rest AS DECIMAL(38,{MONEY_SCALE}))) FILTER (WHERE abs(rest) < {MONEY_EXACT}D)",
        "big_amount": f"sum(rest) FILTER (WHERE abs(rest) >= {MONEY_EXACT}D AND abs(rest) < double('Infinity'))",
    }


def money_odd(kind: T.DataType) -> str:
    """Aggregate that counts NaN and infinite amounts, as SQL text."""
    odd = "false" if isinstance(kind, T.DecimalType) else "isnan(rest) OR abs(rest) = double('Infinity')"
    return f"count(CASE WHEN {odd} THEN 1 END)"


def money_total(kind: T.DataType) -> str:
    """SQL text of the exact total of the sums of :func:`money_sums` (NULL without amounts)."""
    if isinstance(kind, T.DecimalType):
        return "exact"
    cents = f"(CAST(cents_high AS DECIMAL(20,0)) * CAST({2**MONEY_BITS} AS DECIMAL(7,0)) + CAST(cents_low AS DECIMAL(20,0)))"
    part = "DECIMAL(37,10)"
    return (
        f"CASE WHEN cents_high IS NULL THEN exact WHEN exact IS NULL THEN CAST({cents} * 0.01BD AS DECIMAL(38,10))"
        f" ELSE CAST(exact AS {part}) + CAST({cents} * 0.01BD AS {part}) END"
    )


def money_out(exact: Column, big: Column) -> Column:
    """Total of the two sums, rounded to cents once, as DOUBLE (NULL without amounts)."""
    small = F.round(exact, 2).cast("double")
    both = F.round(F.coalesce(exact.cast("double"), F.lit(0.0)) + big, 2)
    return F.when(big.isNull(), small).otherwise(both)


@dataclass(frozen=True)
class DayPartition:
    """A day column a table is partitioned by, and how far it may be off.

    A row's partition day must lie between ``lead_days`` before and
    ``lag_days`` after the calendar day of its ``create_time`` (load-day
    partitions: ``lag_days`` = the longest delay).  Rows outside that range
    may be skipped; inside it, no row is lost.
    """

    column: str
    lag_days: int = 0
    lead_days: int = 0


def _partition(partition_day: str | DayPartition | None) -> DayPartition | None:
    return DayPartition(partition_day) if isinstance(partition_day, str) else partition_day


def time_window(
    lower=None,
    upper=None,
    *,
    lower_inclusive: bool = True,
    partition_day: str | DayPartition | None = None,
    time_col: str = "create_time",
) -> Column:
    """``lower <= time_col < upper`` (strict lower bound when
    ``lower_inclusive`` is False); either bound may be omitted.

    With ``partition_day`` (the day column a table is partitioned by, e.g.
    ``dt``) whole-day bounds are also put on that column, so Spark skips the
    partitions outside the window.  A plain name promises that a row's
    partition day is the calendar day of ``time_col``; a :class:`DayPartition`
    widens the bounds by its lag and lead.
    """
    t = F.col(time_col)
    part = _partition(partition_day)
    conds = []
    if lower is not None:
        conds.append(t >= ts_lit(lower) if lower_inclusive else t > ts_lit(lower))
        if part:
            conds.append(F.col(part.column) >= date_lit(days_before(lower, part.lead_days)))
    if upper is not None:
        conds.append(t < ts_lit(upper))
        if part:
            conds.append(F.col(part.column) <= date_lit(days_before(upper, -part.lag_days)))
    if not conds:
        return F.lit(True)
    cond = conds[0]
    for c in conds[1:]:
        cond = cond & c
    return cond
