"""Freshness gate (S9, A1): rows per source loaded on day ``as_of``."""

from __future__ import annotations

import datetime as _dt
from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapflow.functions.scalars import ts_literal


def _day_bounds(as_of):
    d = as_of if isinstance(as_of, _dt.date) else _dt.date.fromisoformat(str(as_of)[:10])
    if isinstance(d, _dt.datetime):
        d = d.date()
    start = _dt.datetime(d.year, d.month, d.day)
    return start, start + _dt.timedelta(days=1)


def fresh_counts(frames: Mapping[str, DataFrame], as_of, ts_col: str = "extracted_at") -> DataFrame:
    """One row per source: ``(source, n_rows)`` loaded on ``as_of`` (UTC day).

    The day test is a half-open timestamp range, so Parquet scans get it as a pushed
    filter instead of evaluating ``to_date`` on every row. A frame with ``load_date`` (a
    landing folder by day) also gets a partition filter: other days' files are not opened.
    """
    lo, hi = _day_bounds(as_of)
    parts = []
    for name, df in frames.items():
        ts = F.col(ts_col)
        if "load_date" in df.columns:
            df = df.where(F.col("load_date") == F.lit(lo.date()))
        parts.append(
            df.where((ts >= ts_literal(lo)) & (ts < ts_literal(hi)))
            .agg(F.count(F.lit(1)).cast("bigint").alias("n_rows"))
            .select(F.lit(name).alias("source"), "n_rows")
        )
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def assert_fresh(frames: Mapping[str, DataFrame], as_of, ts_col: str = "extracted_at") -> dict[str, int]:
    """Fail if any source has no rows for ``as_of``; returns the counts (one per source)."""
    counts = {r["source"]: int(r["n_rows"]) for r in fresh_counts(frames, as_of, ts_col).collect()}
    empty = sorted(k for k, v in counts.items() if v == 0)
    if empty:
        raise ValueError(f"no rows loaded on {as_of} for: {', '.join(empty)}")
    return counts
