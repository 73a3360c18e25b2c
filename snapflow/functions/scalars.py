"""Scalar helpers (P9-P20) written as Column expressions so they stay inside codegen.

NULL semantics follow the warehouse dialect the original job targets, which differs from
Spark's defaults in places (see the docstrings).
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ColumnOrName = Column | str


def _c(x: ColumnOrName) -> Column:
    return F.col(x) if isinstance(x, str) else x


def greatest_strict(*cols: ColumnOrName) -> Column:
    """GREATEST that is NULL when any input is NULL (Spark's ``greatest`` skips NULLs)."""
    cs = [_c(c) for c in cols]
    all_set = cs[0].isNotNull()
    for c in cs[1:]:
        all_set = all_set & c.isNotNull()
    return F.when(all_set, F.greatest(*cs))


def safe_ratio(num: ColumnOrName, den: ColumnOrName, scale: int | None = None) -> Column:
    """``num / den`` when ``den > 0``, else 0.0 (NULL or non-positive denominator).

    ``scale=None``: float division (a ratio written with a float cast). ``scale=6``: the
    warehouse's whole-number division, an exact decimal rounded half up to 6 places
    (e.g. ``7 / 3 = 2.333333``), returned as double.
    """
    n, d = _c(num), _c(den)
    if scale is None:
        q = n.cast("double") / d
    else:
        q = F.round(n.cast("decimal(38,0)") / d.cast("decimal(38,0)"), scale).cast("double")
    return F.when(d > 0, q).otherwise(F.lit(0.0))


def tier(col: ColumnOrName, bounds: Sequence[tuple[float, str]], default: str) -> Column:
    """Label by descending inclusive lower bounds; NULL falls through to ``default``."""
    c = _c(col)
    ordered = sorted(bounds, key=lambda b: b[0], reverse=True)
    expr = None
    for lo, label in ordered:
        expr = F.when(c >= lo, F.lit(label)) if expr is None else expr.when(c >= lo, F.lit(label))
    return F.lit(default) if expr is None else expr.otherwise(F.lit(default))


def growth_pct(cur: ColumnOrName, past: ColumnOrName) -> Column:
    """``(cur - past) / past * 100`` as double when ``past > 0``, else 0.0."""
    c, p = _c(cur), _c(past)
    return F.when(p > 0, ((c - p).cast("double") / p) * 100).otherwise(F.lit(0.0))


# The three indicator labels (above, below, equal).
INDICATOR_LABELS = ("Above Average", "Below Average", "Average")


def trend_indicator(cur: ColumnOrName, avg: ColumnOrName, above: str = INDICATOR_LABELS[0],
                    below: str = INDICATOR_LABELS[1], equal: str = INDICATOR_LABELS[2]) -> Column:
    """Three-way label; NULL on either side gives ``equal``."""
    c, a = _c(cur), _c(avg)
    return F.when(c > a, F.lit(above)).when(c < a, F.lit(below)).otherwise(F.lit(equal))


def delta(cur: ColumnOrName, prev: ColumnOrName) -> Column:
    """``cur - coalesce(prev, 0)``: a missing previous shows the full value as change."""
    return _c(cur) - F.coalesce(_c(prev), F.lit(0))


def any_not_null(*cols: ColumnOrName) -> Column:
    cs = [_c(c).isNotNull() for c in cols]
    out = cs[0]
    for c in cs[1:]:
        out = out | c
    return out


def _as_date(as_of) -> Column:
    if isinstance(as_of, Column):
        return as_of.cast("date")
    if isinstance(as_of, (_dt.date, _dt.datetime)):
        return F.lit(as_of.isoformat()[:10]).cast("date")
    if as_of is None:
        return F.current_date()
    return F.lit(str(as_of)).cast("date")


def retain_days(df: DataFrame, date_col: str, as_of, days: int) -> DataFrame:
    """Keep rows with ``date_col >= as_of - days`` (inclusive); NULL dates drop."""
    return df.where(F.col(date_col) >= F.date_sub(_as_date(as_of), days))


def ts_literal(value) -> Column:
    """A ``timestamp_ntz`` literal from a datetime/str: naive values are taken as UTC wall
    clock, zone-aware ones are converted to UTC first."""
    if isinstance(value, Column):
        return value.cast("timestamp_ntz")
    if isinstance(value, _dt.datetime):
        if value.tzinfo is not None:                       # aware: express it as UTC wall clock
            value = value.astimezone(_dt.timezone.utc)
        value = value.replace(tzinfo=None).isoformat(sep=" ")
    elif isinstance(value, _dt.date):
        value = value.isoformat() + " 00:00:00"
    return F.lit(str(value)).cast("timestamp_ntz")


def build_time(now=None) -> Column:
    """Build-time value: a literal ``now`` (reproducible) or the current timestamp."""
    return F.current_timestamp().cast("timestamp_ntz") if now is None else ts_literal(now)


def with_audit(df: DataFrame, name: str, now=None) -> DataFrame:
    """Add a build-time column."""
    return df.withColumn(name, build_time(now))
