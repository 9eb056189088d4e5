"""Date-string styles and calendar attributes as column expressions.

A string is matched to a style by its *shape*: every ASCII digit is mapped to
``d`` and the result compared with the style's pattern, where every pattern
letter is mapped to ``d`` the same way.  All styles have fixed-width fields,
so the shape picks at most one style and the field positions within the
string.  The fields are then validated and assembled by
``try_make_timestamp_ntz``: one lookup of the style, one construction per
row, no exception per failed pattern, and no dependence on the session time
zone.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- Fixed values (must equal the reference's style list, in its order) ---
# (style name, pattern)
DATE_STYLES: tuple[tuple[str, str], ...] = (
    ("MM_DD", "MM-dd"),
    ("YYYY_MM", "yyyy-MM"),
    ("YYYY_MM_DD", "yyyy-MM-dd"),
    ("MM_DD_HH_MM", "MM-dd HH:mm"),
    ("MM_DD_HH_MM_SS", "MM-dd HH:mm:ss"),
    ("YYYY_MM_DD_HH_MM", "yyyy-MM-dd HH:mm"),
    ("YYYY_MM_DD_HH_MM_SS", "yyyy-MM-dd HH:mm:ss"),
    ("MM_DD_EN", "MM/dd"),
    ("YYYY_MM_EN", "yyyy/MM"),
    ("YYYY_MM_DD_EN", "yyyy/MM/dd"),
    ("MM_DD_HH_MM_EN", "MM/dd HH:mm"),
    ("MM_DD_HH_MM_SS_EN", "MM/dd HH:mm:ss"),
    ("YYYY_MM_DD_HH_MM_EN", "yyyy/MM/dd HH:mm"),
    ("YYYY_MM_DD_HH_MM_SS_EN", "yyyy/MM/dd HH:mm:ss"),
    ("MM_DD_CN", "MM月dd日"),
    ("YYYY_MM_CN", "yyyy年MM月"),
    ("YYYY_MM_DD_CN", "yyyy年MM月dd日"),
    ("MM_DD_HH_MM_CN", "MM月dd日 HH:mm"),
    ("MM_DD_HH_MM_SS_CN", "MM月dd日 HH:mm:ss"),
    ("YYYY_MM_DD_HH_MM_CN", "yyyy年MM月dd日 HH:mm"),
    ("YYYY_MM_DD_HH_MM_SS_CN", "yyyy年MM月dd日 HH:mm:ss"),
    ("HH_MM", "HH:mm"),
    ("HH_MM_SS", "HH:mm:ss"),
)

# --- Fixed values (must equal the reference's weekday table) ---
# (Chinese name, English name, short name, number), Monday first
WEEKDAYS: tuple[tuple[str, str, str, int], ...] = (
    ("星期一", "Monday", "Mon.", 1),
    ("星期二", "Tuesday", "Tues.", 2),
    ("星期三", "Wednesday", "Wed.", 3),
    ("星期四", "Thursday", "Thur.", 4),
    ("星期五", "Friday", "Fri.", 5),
    ("星期六", "Saturday", "Sat.", 6),
    ("星期日", "Sunday", "Sun.", 7),
)

STYLE_PATTERNS: dict[str, str] = dict(DATE_STYLES)

# The year a year-less style resolves to (Spark's datetime parser default).
DEFAULT_YEAR = 1970

_DIGITS = "0123456789"
_PATTERN_LETTERS = "yMdHms"
# (pattern token, default value) for each field of a timestamp
_FIELDS = (("yyyy", DEFAULT_YEAR), ("MM", 1), ("dd", 1), ("HH", 0), ("mm", 0), ("ss", 0))


def pattern_shape(pattern: str) -> str:
    """Shape of a pattern: each pattern letter becomes ``d``."""
    return pattern.translate(str.maketrans(_PATTERN_LETTERS, "d" * len(_PATTERN_LETTERS)))


def text_shape(text: Column) -> Column:
    """Shape of a string column: each ASCII digit becomes ``d``."""
    return F.translate(text, _DIGITS, "d" * len(_DIGITS))


def parse_in_style(text_col: str, pattern: str) -> Column:
    """TIMESTAMP_NTZ of column ``text_col`` read strictly in one pattern:
    NULL for text of another shape or with impossible values (month 13,
    30 February, 24:00, second 60)."""
    shape = text_shape(F.col(text_col))
    parsed = parse_by_index(text_col, F.lit(0), styles=(("", pattern),))
    return F.when(shape == F.lit(pattern_shape(pattern)), parsed)


def _q(name: str) -> str:
    """A column name quoted for SQL expression text."""
    return "`" + name.replace("`", "``") + "`"


def _lit(text: str) -> str:
    """A string literal for SQL expression text."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def style_index(shape_col: str, styles=DATE_STYLES) -> Column:
    """Position (0-based) of the style whose shape equals column
    ``shape_col`` (a :func:`text_shape` result, computed once), or NULL:
    one lookup in a literal map from shape to style number."""
    pairs = ", ".join(f"{_lit(pattern_shape(p))}, {i}" for i, (_, p) in enumerate(styles))
    return F.expr(f"try_element_at(map({pairs}), {_q(shape_col)})")


def _positions(token: str, styles) -> list[int]:
    """1-based position of ``token`` in each style's pattern, 0 if absent."""
    return [pattern.find(token) + 1 for _, pattern in styles]


def parse_by_index(text_col: str, index_col: str | Column, styles=DATE_STYLES) -> Column:
    """TIMESTAMP_NTZ of column ``text_col`` read in style number ``index_col``.

    Every style has fixed-width fields, so one parse serves all of them: the
    position of each field for the row's style comes from a literal array
    indexed by the style number (0 = the field is absent and takes its
    default).  One small expression instead of one arm per style keeps the
    generated code small enough for the JIT; ``get`` is 0-based and NULL for
    a NULL index (``element_at(array, NULL)`` is not NULL under whole-stage
    codegen in Spark 4.1).
    """
    if not isinstance(index_col, str):
        # a constant style number (single-pattern parse)
        return _parse_sql(text_col, "0", styles)
    return _parse_sql(text_col, _q(index_col), styles)


def _parse_sql(text_col: str, index: str, styles) -> Column:
    text = _q(text_col)
    fields = []
    for token, default in _FIELDS:
        positions = _positions(token, styles)
        pos = f"get(array({', '.join(map(str, positions))}), {index})"
        fields.append(
            f"CASE WHEN {pos} = 0 THEN {default}"
            f" ELSE try_cast(substring({text}, {pos}, {len(token)}) AS INT) END"
        )
    y, mo, d, h, mi, sec = fields
    # make_timestamp rolls second 60 into the next minute; a strict parse
    # rejects it
    return F.expr(
        f"CASE WHEN {sec} < 60 THEN try_make_timestamp_ntz({y}, {mo}, {d}, {h}, {mi}, {sec}) END"
    )


def render_by_index(ts: Column, index_col: str, styles=DATE_STYLES) -> Column:
    """Render ``ts`` in style number ``index_col`` (the row's own style)."""
    return F.coalesce(
        *[
            F.when(F.col(index_col) == i, F.date_format(ts, pattern))
            for i, (_, pattern) in enumerate(styles)
        ]
    )


def select_styles(names=None) -> tuple[tuple[str, str], ...]:
    """The style table restricted to ``names`` (all 23 when None)."""
    if names is None:
        return DATE_STYLES
    unknown = set(names) - set(STYLE_PATTERNS)
    if unknown:
        raise ValueError(f"unknown date styles: {sorted(unknown)}")
    return tuple((n, p) for n, p in DATE_STYLES if n in set(names))


def style_name(index_col: str, styles=DATE_STYLES) -> Column:
    names = ", ".join(_lit(name) for name, _ in styles)
    return F.expr(f"get(array({names}), {_q(index_col)})")


def render(ts: Column, style: str) -> Column:
    """Render a timestamp in a named style."""
    return F.date_format(ts, STYLE_PATTERNS[style])


def weekday_number(ts: Column) -> Column:
    """ISO weekday number, Monday = 1 ... Sunday = 7."""
    return F.weekday(ts) + 1


def _weekday_lookup(number: Column, field: int) -> Column:
    names = F.array(*[F.lit(w[field]) for w in WEEKDAYS])
    return F.get(names, number - 1)


def weekday_name(number: Column) -> Column:
    return _weekday_lookup(number, 1)


def weekday_name_cn(number: Column) -> Column:
    return _weekday_lookup(number, 0)


def weekday_short_name(number: Column) -> Column:
    return _weekday_lookup(number, 2)


_YM_UNITS = {"year": 0, "month": 1}
_DT_UNITS = {"day": 0, "hour": 1, "minute": 2, "second": 3}


def shift(ts: Column, unit: str, amount: int) -> Column:
    """``ts`` moved by ``amount`` calendar units.

    Month and year steps clamp to the end of a shorter month
    (2024-01-31 + 1 month = 2024-02-29), like calendar arithmetic.
    """
    if unit in _YM_UNITS:
        parts = [0, 0]
        parts[_YM_UNITS[unit]] = amount
        return ts + F.make_ym_interval(F.lit(parts[0]), F.lit(parts[1]))
    if unit in _DT_UNITS:
        parts = [0, 0, 0, 0]
        parts[_DT_UNITS[unit]] = amount
        return ts + F.make_dt_interval(*[F.lit(p) for p in parts])
    raise ValueError(f"unknown unit {unit!r}")


def days_between(ts: Column, other: dt.date) -> Column:
    """Whole calendar days between the day of ``ts`` and ``other``."""
    return F.abs(F.datediff(F.lit(other), F.to_date(ts))).cast("bigint")
