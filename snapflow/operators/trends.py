"""Trends (R1): moving averages, look-backs, growth, indicators, daily rank, retention.

Frames and look-backs count **rows**, not days (with missing days, "7 days ago" is 7
snapshots ago). Ascending order puts NULL dates last, so undated rows never shift the
frames of dated ones; they are removed by the retention filter at the end.

Plan shape: all per-entity windows share one ``WindowSpec`` so Spark runs them in one
exchange + sort + ``Window`` node. Each per-entity window partition holds one entity's
snapshots; with one snapshot per entity and day (what the history upsert guarantees)
that is bounded by the number of days, not by the data size. The daily rank is the
one window whose partition (a whole day, every entity) grows with the data; it is
computed by ``snapflow.operators.ranking.rank_desc`` which splits a big day across
tasks instead of sorting it in one.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql.types import DateType

from snapflow.functions.scalars import _as_date, growth_pct, retain_days, trend_indicator
from snapflow.operators.ranking import rank_desc
from snapflow.sources import sinks

# Moving averages (output: measure, rows in the frame), look-backs (output:
# measure, rows back), growth columns (output: measure, look-back column) and retention days.
MOVING_AVERAGES = {
    "stars_7day_avg": ("github_stars", 7),
    "downloads_7day_avg": ("pypi_downloads_daily", 7),
    "stars_30day_avg": ("github_stars", 30),
}
LOOK_BACKS = {
    "stars_7days_ago": ("github_stars", 7),
    "stars_30days_ago": ("github_stars", 30),
    "downloads_7days_ago": ("pypi_downloads_daily", 7),
}
GROWTH = {
    "stars_7day_growth_pct": ("github_stars", "stars_7days_ago"),
    "stars_30day_growth_pct": ("github_stars", "stars_30days_ago"),
    "downloads_7day_growth_pct": ("pypi_downloads_daily", "downloads_7days_ago"),
}
INDICATORS = {
    "stars_trend_indicator": ("github_stars", "stars_7day_avg"),
    "downloads_trend_indicator": ("pypi_downloads_daily", "downloads_7day_avg"),
}
RETENTION_DAYS = 90
# Dates that the latest table keeps of an entity: retention, look-back and some to spare.
STATE_DATES = 150

TRENDS_COLUMNS = [
    "technology_name", "snapshot_date", "github_stars", "github_forks", "pypi_downloads_daily",
    "stars_7day_avg", "downloads_7day_avg", "stars_30day_avg", "daily_popularity_rank",
    "stars_7day_growth_pct", "stars_30day_growth_pct", "downloads_7day_growth_pct",
    "stars_trend_indicator", "downloads_trend_indicator",
]


def entity_window(key: str = "technology_name", date_col: str = "snapshot_date",
                  tiebreak: Sequence[str] = ()) -> WindowSpec:
    return Window.partitionBy(key).orderBy(
        F.col(date_col).asc_nulls_last(), *[F.col(t).asc_nulls_last() for t in tiebreak])


def with_moving_averages(df: DataFrame, w: WindowSpec, specs: dict[str, tuple[str, int]]) -> DataFrame:
    """``out: (value_col, n_rows)`` -> average over the current and ``n_rows - 1`` preceding rows."""
    return df.withColumns({o: F.avg(F.col(c)).over(w.rowsBetween(-(n - 1), 0)) for o, (c, n) in specs.items()})


def with_lags(df: DataFrame, w: WindowSpec, specs: dict[str, tuple[str, int]]) -> DataFrame:
    """``out: (value_col, k)`` -> value ``k`` rows back (NULL when fewer rows exist)."""
    return df.withColumns({o: F.lag(F.col(c), k).over(w) for o, (c, k) in specs.items()})


# The widest frame and the longest look-back, in rows.
LOOKBACK_ROWS = max([n for _, n in MOVING_AVERAGES.values()] + [k for _, k in LOOK_BACKS.values()])


@dataclass
class LookBack:
    start: dt.date | None              # no partition before this date is read ...
    deep: DataFrame | None = None      # ... but for these entities


def look_back_start(state: DataFrame, as_of, days: int = RETENTION_DAYS, rows: int = LOOKBACK_ROWS,
                    band_days: int = 90) -> LookBack:
    """From which date on the history must be read for the retained days, and for which entities before that.

    ``state`` has one row per entity: ``first_snapshot_date`` and ``recent_dates`` (the newest dates, in descending
    order). An entity with retained rows needs its ``rows`` newest dates before the cut, or all of them if it has
    fewer. The start is the least such date within ``band_days`` before the cut; entities that need more (sparse ones,
    or those whose kept dates don't reach far enough) are listed to be read in full. The driver gets one row.
    """
    cut = F.date_sub(_as_date(as_of), days)
    older = F.filter("recent_dates", lambda d: d < cut)
    # the last of the older dates that count; if the list ends before, only the first date is known
    need = F.when(F.size(older) >= rows, F.get(older, F.lit(rows - 1))).otherwise(F.col("first_snapshot_date"))
    known = state.where(F.get("recent_dates", F.lit(0)) >= cut).select(
        F.col("technology_name"), F.least(need, cut).alias("need"))
    band = F.date_sub(cut, band_days)
    deep = known.where(F.col("need") < band).select("technology_name")
    start, n_deep = known.agg(F.min(F.when(F.col("need") >= band, F.col("need"))), F.count_if(F.col("need") < band)).first()
    return LookBack(start, deep if n_deep else None)


def _bounded_lookback(base: DataFrame, as_of, days: int, rows: int, tiebreak: Sequence[str],
                      look_back: LookBack | None = None) -> DataFrame:
    """Retained rows plus, per entity, only the ``rows`` newest rows before the cut.

    Frames and look-backs of retained rows reach at most ``rows`` rows back, so older
    history cannot change any output row; dropping it before the per-entity shuffle and
    sort keeps that work proportional to the retention period instead of to the whole
    history. The cut-off top-N runs as a ``WindowGroupLimit`` (partial top-N per task
    before the shuffle). Undated rows sort after dated ones and so never precede them.

    ``look_back`` (see ``look_back_start``) also bounds the scan: partitions before its start
    are read for its listed entities only, and not at all when there are none. Exact in
    every case.
    """
    cut = F.date_sub(_as_date(as_of), days)
    kept = base.where(F.col("snapshot_date") >= cut)
    older = base.where(F.col("snapshot_date") < cut)
    if look_back is not None:
        start = cut if look_back.start is None else F.lit(look_back.start)
        near = older.where(F.col("snapshot_date") >= start)
        if look_back.deep is not None:
            near = near.unionByName(older.where(F.col("snapshot_date") < start).join(look_back.deep, "technology_name", "left_semi"))
        older = near
    w = Window.partitionBy("technology_name").orderBy(
        F.col("snapshot_date").desc(), *[F.col(t).desc_nulls_first() for t in tiebreak])
    older = older.withColumn("__k", F.row_number().over(w)).where(F.col("__k") <= rows).drop("__k")
    return kept.unionByName(older)


def build_trends(snapshots: DataFrame, as_of=None, days: int | None = RETENTION_DAYS,
                 key: str = "technology_name", date_col: str = "snapshot_date",
                 tiebreak: Sequence[str] = (), rank_strategy: str = "split",
                 look_back: LookBack | None = None, dates: Sequence[dt.date] | None = None) -> DataFrame:
    """Trend fact (14 columns) from any snapshot frame with ``key``, ``date_col``,
    ``github_stars``, ``github_forks``, ``pypi_downloads_daily``.

    ``as_of``: the day the 90-day retention counts back from (``None`` = current date);
    ``days=None`` keeps every row. ``look_back``: how far back the scan must go, see
    ``look_back_start``; without it older partitions are scanned whole. ``dates``: only the
    rows of these days come out (and are ranked); later days are not read.
    """
    if dates is not None:
        snapshots = snapshots.where(F.col(date_col) <= max(dates))
    base = snapshots.select(
        F.col(key).alias("technology_name"), F.col(date_col).alias("snapshot_date"),
        "github_stars", "github_forks", "pypi_downloads_daily", *tiebreak)
    w = entity_window("technology_name", "snapshot_date", tiebreak)
    src = base if days is None else _bounded_lookback(base, as_of, days, LOOKBACK_ROWS, tiebreak, look_back)
    t = with_moving_averages(src, w, MOVING_AVERAGES)
    t = with_lags(t, w, LOOK_BACKS)
    if days is not None:
        # Retention is applied after the look-back windows (they need older rows), but the
        # daily rank partitions by date, so it only ever needs the retained days: rank from
        # the filtered source, where the date filter can reach the scan.
        t = retain_days(t, "snapshot_date", as_of, days)
        rank_src = retain_days(base, "snapshot_date", as_of, days)
    else:
        rank_src = base
    if dates is not None:
        t, rank_src = (x.where(F.col("snapshot_date").isin(list(dates))) for x in (t, rank_src))
    t = rank_desc(t, "snapshot_date", "github_stars", "daily_popularity_rank", strategy=rank_strategy,
                  rank_input=rank_src)
    t = t.select(
        "technology_name", "snapshot_date", "github_stars", "github_forks", "pypi_downloads_daily",
        "stars_7day_avg", "downloads_7day_avg", "stars_30day_avg",
        F.col("daily_popularity_rank").cast("bigint").alias("daily_popularity_rank"),
        *[growth_pct(c, p).alias(o) for o, (c, p) in GROWTH.items()],
        *[trend_indicator(c, a).alias(o) for o, (c, a) in INDICATORS.items()],
    )
    return t


def changed_dates(rows: DataFrame, state: DataFrame, as_of, days: int, after: int = LOOKBACK_ROWS) -> list[dt.date] | None:
    """The retained days whose trends a merge of ``rows`` changes: theirs, where measures and ranks change, and the
    ``after`` next days of each of their entities, whose frames and look-backs reach them. ``state`` is the latest table
    after the merge. None if its dates per entity do not reach back to the cut, so that nobody knows. The driver gets the
    days, at most as many as are retained."""
    cut = F.date_sub(_as_date(as_of), days)
    touched = rows.where(F.col("snapshot_date").isNotNull()).groupBy("technology_name").agg(F.min("snapshot_date").alias("t"),
                                                                                           F.collect_set("snapshot_date").alias("own"))
    later = F.sort_array(F.filter("recent_dates", lambda d: d > F.col("t")))
    # the days between an entity's touched days are at most ``after`` apart from one, or are taken without need
    many = F.size("own") > 1
    found = touched.join(state.select("technology_name", "recent_dates"), "technology_name").select(
        F.array_union("own", F.when(many, later).otherwise(F.slice(later, 1, after))).alias("d"),
        ((F.size("recent_dates") > 0) & (F.array_min("recent_dates") > cut) & (F.size("recent_dates") >= STATE_DATES)).alias("unknown"))
    got = found.select(F.explode("d").alias("d"), "unknown").where(F.col("unknown") | (F.col("d") >= cut)).distinct().collect()
    return None if any(r["unknown"] for r in got) else sorted(r["d"] for r in got)


def update_trends(spark: SparkSession, target: str, history: DataFrame, rows: DataFrame, state: DataFrame, as_of,
                  days: int = RETENTION_DAYS) -> bool:
    """Bring the stored trends (partitioned by day, fresh up to the merge of ``rows`` into ``history``) to ``as_of``: the
    changed days are computed and overwritten by one write job, days before the cut go, all others stay as they are. False,
    with nothing done, where only a full build is sure: no table, another retention, an earlier ``as_of``."""
    note, today = sinks.read_note(spark, target), _day(spark, as_of)
    if note is None or note.get("days") != days or note["as_of"] > str(today):
        return False
    dates = changed_dates(rows, state, today, days)
    if dates is None:
        return False
    if dates:
        back = look_back_start(state, dates[0], 0)
        new = build_trends(history, as_of=dates[0], days=0, look_back=back, dates=dates)
        sinks.overwrite_partitions(new, target, "snapshot_date")
    sinks.drop_days(spark, target, "snapshot_date", today - dt.timedelta(days=days))
    sinks.write_note(spark, target, {"as_of": str(today), "days": days})
    return True


def write_trends(spark: SparkSession, target: str, trends: DataFrame, as_of, days: int | None) -> None:
    """Store whole trends, a partition a day."""
    sinks.write_table(trends, target, ["snapshot_date"])
    sinks.write_note(spark, target, {"as_of": str(_day(spark, as_of)), "days": days})


def read_trends(spark: SparkSession, target: str) -> DataFrame | None:
    df = sinks.read_table(spark, target, {"snapshot_date": DateType()})
    return None if df is None else df.select(*TRENDS_COLUMNS)


def _day(spark: SparkSession, as_of) -> dt.date:
    return spark.range(1).select(_as_date(as_of)).first()[0]
