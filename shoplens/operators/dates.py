"""Table jobs over date columns: standardise, quality, calendar attributes.

All are narrow (per-row) projections except ``date_quality``, a grouped count
over at most 24 keys.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoplens.functions import dates as D
from shoplens.functions.timewin import as_datetime

REJECTED = "rejected"


def date_standardise(
    df: DataFrame,
    col: str = "ds",
    *,
    out: str = "ts",
    style_col: str = "style",
    target_style: str | dict[str, str] | None = "YYYY_MM_DD_HH_MM_SS",
    text_col: str = "ds_std",
    styles: Sequence[str] | None = None,
    shift_in_style: Sequence[tuple[str, str, int]] = (),
) -> DataFrame:
    """Add the parsed timestamp, the matched style name and re-rendered text.

    * ``styles``: style names to recognise (default all 23); one name reads
      the column in a known style.
    * ``target_style``: a style name, rendered into ``text_col``, or a
      mapping ``{output column: style name}`` (e.g. a date-only and a
      time-only column); None for no text.
    * ``shift_in_style``: ``(output column, unit, amount)`` entries: the
      timestamp moved by calendar units and written back in the row's own
      style (``'2019-11-30'`` + 1 day = ``'2019-12-01'``).

    A string matching no style, or with impossible values, gets NULL in every
    added column.  Year-less styles resolve to 1970, date-less ones to
    1970-01-01.
    """
    table = D.select_styles(styles)
    shape, index = "__shoplens_shape", "__shoplens_style"
    # Shape and style index are separate projections: each is referenced by
    # many CASE arms and is computed once per row.
    result = (
        df.withColumn(shape, D.text_shape(F.col(col)))
        .withColumn(index, D.style_index(shape, table))
        .withColumn(out, D.parse_by_index(col, index, table))
        .withColumn(style_col, F.when(F.col(out).isNotNull(), D.style_name(index, table)))
    )
    added = {}
    for name, unit, amount in shift_in_style:
        added[name] = D.render_by_index(D.shift(F.col(out), unit, amount), index, table)
    if added:
        result = result.withColumns(added)
    result = result.drop(shape, index)
    renders = {text_col: target_style} if isinstance(target_style, str) else (target_style or {})
    if renders:
        result = result.withColumns(
            {name: D.render(F.col(out), style) for name, style in renders.items()}
        )
    return result


def date_quality(df: DataFrame, col: str = "ds", *, styles: Sequence[str] | None = None) -> DataFrame:
    """``style, n``: rows per matched style, unmatched rows as 'rejected'."""
    return (
        date_standardise(df.select(col), col, target_style=None, styles=styles)
        .groupBy(F.coalesce(F.col("style"), F.lit(REJECTED)).alias("style"))
        .agg(F.count(F.lit(1)).alias("n"))
    )


# Default shifted copies: (output column, unit, amount)
DEFAULT_SHIFTS = (("next_month", "month", 1), ("week_before", "day", -7))


def calendar_enrich(
    df: DataFrame,
    col: str = "ts",
    *,
    reference_date: dt.date | dt.datetime | str,
    shifts=DEFAULT_SHIFTS,
) -> DataFrame:
    """Add calendar parts, weekday names and numbers, shifted copies and the
    whole days between the row's day and ``reference_date``.

    Added columns: ``y m d h mi s weekday weekday_no weekday_cn
    weekday_short days_to`` plus one per shift.
    """
    ts = F.col(col)
    number = D.weekday_number(ts)
    parts = {
        "y": F.year(ts),
        "m": F.month(ts),
        "d": F.dayofmonth(ts),
        "h": F.hour(ts),
        "mi": F.minute(ts),
        "s": F.second(ts),
    }
    added = {name: c.cast("bigint") for name, c in parts.items()}
    added["weekday"] = D.weekday_name(number)
    added["weekday_no"] = number.cast("bigint")
    added["weekday_cn"] = D.weekday_name_cn(number)
    added["weekday_short"] = D.weekday_short_name(number)
    for name, unit, amount in shifts:
        added[name] = D.shift(ts, unit, amount)
    added["days_to"] = D.days_between(ts, as_datetime(reference_date).date())
    return df.withColumns(added)
