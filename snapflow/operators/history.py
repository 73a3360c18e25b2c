"""Keyed day-by-day history (H1-H4) and its one-pass closed form.

The history table is Parquet partitioned by ``snapshot_date`` and, below it, by ``history_run``,
in a folder or the catalog; ``read_history`` reads it without the second. An increment compares
current metrics with the newest stored row per entity (``W3`` + left join), then the upsert
rewrites only the date partitions the new rows touch: ``kept old rows of those dates (key
anti-join) + new rows``, all under the run ``-``. Rows without a date match nothing: they come
under a run of their own, so one dynamic partition overwrite writes dated and undated rows and
no undated row is ever written again. Everything is DataFrame work; the driver never sees rows.

Beside the history stands a table with one row per entity (``_latest``): its newest stored
row, first date and newest dates. It is marked stale before the history is written and
clear once it follows, so after a stop between the two writes it is derived anew.
"""

from __future__ import annotations

import logging
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StringType, StructField, StructType

from snapflow.functions.scalars import build_time, delta
from snapflow.operators.latest import latest_per_key
from snapflow.operators.trends import STATE_DATES
from snapflow.session import reliable_checkpoint
from snapflow.sources import sinks

log = logging.getLogger(__name__)

HISTORY_KEYS = ("snapshot_date", "technology_name")
HISTORY_COLUMNS = [
    "technology_name", "github_repo", "pypi_package", "github_stars", "github_forks", "github_watchers",
    "pypi_downloads_daily", "pypi_downloads_weekly", "pypi_downloads_monthly", "open_issues",
    "contributors_count", "github_releases", "pypi_release_count", "fork_to_star_ratio",
    "stars_per_contributor", "popularity_tier", "usage_tier", "github_created_at", "github_updated_at",
    "latest_release_published_at", "latest_release_upload_time", "snapshot_date", "last_updated_at",
    "stars_change", "forks_change", "downloads_change", "issues_change", "history_created_at",
]
# Change column -> measured column.
DELTAS = {
    "stars_change": "github_stars",
    "forks_change": "github_forks",
    "downloads_change": "pypi_downloads_daily",
    "issues_change": "open_issues",
}
_CARRIED = HISTORY_COLUMNS[:23]           # metrics columns kept in history (no download ratios)
#: Second partition column: the run that brought rows without a date; dated rows bear ``DATED``.
RUN, DATED = "history_run", "-"


def latest_rows(history: DataFrame, key: str = "technology_name", tiebreak: Sequence[str] = ()) -> DataFrame:
    """Newest stored row per entity (``snapshot_date DESC``, NULL dates first), measures only.

    Rows of one date (only undated ones can be several) go by their build time, newest first.
    """
    built = ["history_created_at"] if "history_created_at" in history.columns else []
    cols = [key, "snapshot_date", *DELTAS.values(), *tiebreak, *built]
    return latest_per_key(history.select(*dict.fromkeys(cols)), key, "snapshot_date", [*tiebreak, *built])


def history_rows(metrics: DataFrame, history: DataFrame | None = None, now=None,
                 key: str = "technology_name", tiebreak: Sequence[str] = (),
                 previous: DataFrame | None = None) -> DataFrame:
    """New history rows (28 columns).

    ``history=None`` and ``previous=None`` is the first run: every change is 0. Otherwise
    the previous row per entity is the newest stored one (``snapshot_date DESC``, NULL
    dates first, as the warehouse orders), however old; an entity new to history shows
    its full value as change. ``previous`` (one row per entity, e.g. the table kept by
    ``upsert_with_latest``) replaces the scan of the whole history.
    """
    cur = metrics.select(*_CARRIED)
    if history is None and previous is None:
        changes = {c: F.lit(0).cast("bigint") for c in DELTAS}
        return cur.withColumns(changes).withColumn("history_created_at", build_time(now)).select(*HISTORY_COLUMNS)
    prev = previous if previous is not None else latest_rows(history, key, tiebreak)
    prev = prev.select(F.col(key).alias("__pk"), *[F.col(m).alias(f"__p_{m}") for m in DELTAS.values()])
    j = cur.join(prev, cur[key] == prev["__pk"], "left")
    changes = {c: delta(F.col(m), F.col(f"__p_{m}")) for c, m in DELTAS.items()}
    return j.withColumns(changes).withColumn("history_created_at", build_time(now)).select(*HISTORY_COLUMNS)


def check_unique_keys(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys occurring more than once among non-NULL keys (a merge needs unique source keys)."""
    nn = rows
    for k in keys:
        nn = nn.where(F.col(k).isNotNull())
    return nn.groupBy(*keys).count().where(F.col("count") > 1)


def merge_frame(target: DataFrame, rows: DataFrame, keys: Sequence[str] = HISTORY_KEYS,
                part: str = "snapshot_date", max_dates: int = 400) -> DataFrame:
    """Contents of every dated partition ``rows`` touches after the merge.

    Old rows of the touched dates minus those whose key the new rows replace, plus the new
    rows. Rows without a date match nothing (a NULL key never equals another, as in a SQL
    MERGE), so their partition is not rewritten and they are not part of the result.

    Up to ``max_dates`` touched dates (a daily run touches one or a few) become a literal
    list, beyond that a range and a semi-join: either way the target scan gets a static
    partition filter.
    """
    rows = rows.where(F.col(part).isNotNull())
    dates = rows.select(part).distinct()
    found = [r[0] for r in dates.limit(max_dates + 1).collect()]
    if len(found) <= max_dates:
        touched = target.where(F.col(part).isin(found))
    else:
        low, high = rows.agg(F.min(part), F.max(part)).first()
        touched = target.where(F.col(part).between(low, high)).join(dates, part, "left_semi")
    kept = touched.join(rows.select(*keys), list(keys), "left_anti")
    return kept.select(*target.columns).unionByName(rows.select(*target.columns))


def upsert(spark: SparkSession, target: str, rows: DataFrame, keys: Sequence[str] = HISTORY_KEYS,
           part: str = "snapshot_date", checkpoint: bool = True) -> None:
    """Merge ``rows`` into the table ``target``, a folder or a catalog table (created on first use).

    Only the dated partitions present in ``rows`` are rewritten; rows without a date form a
    partition of their own. Both go through one dynamic partition overwrite, so no stop
    leaves the one without the other, and a repeated run ends in the same dated rows.

    Columns changed (``sync_all_columns``): the columns are set first, as the warehouse
    alters its table before it merges; no stored file is rewritten (``sinks.Layout``; a
    catalog table gets new columns by ``ALTER TABLE``). Only a column of another type, a
    dropped column of a catalog table, and a table written without the second partition
    column are written anew, beside the old table, and take its place when whole.

    ``rows`` is checkpointed first, so the duplicate-key check and the writes see the same
    rows, and a lost executor recomputes from the reliable copy, not from the table
    being rewritten.
    """
    if checkpoint:
        rows = reliable_checkpoint(rows)
    dups = check_unique_keys(rows, keys)
    if dups.limit(1).count():
        raise ValueError(f"incoming rows repeat a merge key {tuple(keys)}")
    run = F.when(F.col(part).isNotNull(), DATED).otherwise(uuid.uuid4().hex)
    stored = _stored(spark, target, part, rows.schema[part].dataType)
    if stored is None:
        sinks.write_table(rows.withColumn(RUN, run), target, [part, RUN])
        return
    if not _align(spark, target, stored, rows):
        old = stored if RUN in stored.columns else stored.withColumn(RUN, run)
        kept = sync_columns(old, rows.withColumn(RUN, run)).join(rows.select(*keys), list(keys), "left_anti")
        sinks.write_table(kept.unionByName(rows.withColumn(RUN, run)), target, [part, RUN])
        return
    old = read_history(spark, target, part, rows.schema[part].dataType)
    undated = rows.where(F.col(part).isNull()).select(*old.columns)
    merged = merge_frame(old, rows, keys, part).unionByName(undated)
    sinks.overwrite_partitions(merged.withColumn(RUN, run), target, part, RUN)


def _align(spark: SparkSession, target: str, stored: DataFrame, rows: DataFrame) -> bool:
    """Give the table the columns of ``rows`` without writing a row again; False where that can't be."""
    if RUN not in stored.columns:
        return False
    have = {f.name: f.dataType for f in stored.schema.fields if f.name != RUN}
    want = {f.name: f.dataType for f in rows.schema.fields}
    if any(have[c] != want[c] for c in have.keys() & want.keys()):
        return False
    if have.keys() == want.keys():
        return True
    if sinks.is_path(target):
        now = sinks.read_layout(spark, target) or sinks.Layout(stored.schema)
        sinks.write_layout(spark, target, now.changed(StructType([*rows.schema.fields, StructField(RUN, StringType())])))
        return True
    if have.keys() - want.keys():
        return False
    new = ", ".join(f"`{c}` {want[c].simpleString()}" for c in rows.columns if c not in have)
    spark.sql(f"ALTER TABLE {target} ADD COLUMNS ({new})")
    return True


def _stored(spark: SparkSession, target: str, part: str, part_type=None) -> DataFrame | None:
    return sinks.read_table(spark, target, {part: part_type or DateType(), RUN: StringType()})


def read_history(spark: SparkSession, target: str, part: str = "snapshot_date", part_type=None) -> DataFrame | None:
    """The history with its partition column typed, or None before the first run."""
    stored = _stored(spark, target, part, part_type)
    return None if stored is None else stored.drop(RUN)


def latest_path(target: str) -> str:
    return target.rstrip("/") + "_latest"


def _entity_state(rows: DataFrame, key: str, part: str, seq: Column, first: Column, recent: Column) -> DataFrame:
    """One row per entity: newest row (by date, undated first, then ``seq`` and build time), first and newest dates."""
    kept = [part, *DELTAS.values(), "history_created_at"]
    at = F.struct(F.col(part).isNull().alias("undated"), F.col(part), seq.alias("seq"), F.col("history_created_at").alias("built"))
    rows = rows.select(key, F.struct(at.alias("at"), F.struct(*kept).alias("row")).alias("x"), first.alias("first"), recent.alias("recent"))
    dates = F.array_distinct(F.flatten(F.collect_list("recent")))
    return (rows.groupBy(key).agg(F.max_by("x.row", "x.at").alias("row"), F.min("first").alias("first_snapshot_date"),
                                  F.slice(F.sort_array(dates, asc=False), 1, STATE_DATES).alias("recent_dates"))
            .select(key, "row.*", "first_snapshot_date", "recent_dates"))


def derive_latest(history: DataFrame, key: str = "technology_name", part: str = "snapshot_date") -> DataFrame:
    """The latest table from the whole history (dates per entity are bounded by the days of the history)."""
    return _entity_state(history, key, part, F.lit(0), F.col(part), F.array_compact(F.array(part)))


def previous_rows(spark: SparkSession, target: str, key: str = "technology_name",
                  part: str = "snapshot_date") -> DataFrame | None:
    """Newest stored row per entity: the latest table if it follows the history, else from the history; None before
    the first run."""
    if not sinks.is_stale(spark, latest_path(target)):
        return sinks.read_table(spark, latest_path(target), {part: DateType()})
    history = read_history(spark, target, part)
    return None if history is None else derive_latest(history, key, part)


def upsert_with_latest(spark: SparkSession, target: str, rows: DataFrame, keys: Sequence[str] = HISTORY_KEYS,
                       part: str = "snapshot_date", key: str = "technology_name", checkpoint: bool = True) -> DataFrame:
    """``upsert`` plus the table of each entity's newest stored row, first date and newest dates.

    The next increment reads that small table (``previous_rows``) instead of scanning the
    whole history for every entity's latest row, so a daily run costs O(entities), not
    O(history). New rows win over stored rows of the same date (the merge replaces them).
    A catalog table is bucketed and sorted by entity, so the next increment's join reads it
    where it lies: only the current metrics are shuffled. ``checkpoint=False``: ``rows`` is
    checkpointed already. Returns the new latest table.
    """
    if checkpoint:
        rows = reliable_checkpoint(rows)
    latest = latest_path(target)
    old = None if sinks.is_stale(spark, latest) else sinks.read_table(spark, latest, {part: DateType()})
    sinks.mark_stale(spark, latest)
    upsert(spark, target, rows, keys, part, checkpoint=False)
    if old is None:                       # first use, or a run stopped before: derive it from the whole table
        whole = read_history(spark, target, part)
        new = derive_latest(rows if whole is None else whole, key, part)
    else:
        fresh = rows.select(key, part, *DELTAS.values(), "history_created_at", F.col(part).alias("first_snapshot_date"),
                            F.array_compact(F.array(part)).alias("recent_dates"), F.lit(1).alias("seq"))
        both = fresh.unionByName(old.withColumn("seq", F.lit(0)))
        new = _entity_state(both, key, part, F.col("seq"), F.col("first_snapshot_date"), F.col("recent_dates"))
    sinks.write_table(new, latest, bucket_by=key)
    sinks.clear_stale(spark, latest)
    return sinks.read_table(spark, latest)


def sync_columns(target: DataFrame, rows: DataFrame) -> DataFrame:
    """Make ``target`` carry exactly the columns of ``rows``: new ones as typed NULLs,
    dropped ones removed, others in the type they have there (``on_schema_change='sync_all_columns'``)."""
    have = set(target.columns)
    sel = [(F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name) for f in rows.schema.fields]
    return target.select(*sel)


def rebuild_history(snapshots: DataFrame, key: str = "technology_name", date_col: str = "snapshot_date",
                    measures: dict[str, str] | None = None) -> DataFrame:
    """One-pass backfill: what folding the daily increment over in-order data gives.

    With one row per entity and date, the change is ``m - coalesce(lag(m), 0)`` per
    entity in date order, and 0 for every row of the very first date (the first run).
    One shuffle by entity and one window, instead of one merge per day. The first date
    is a scalar subquery (a global ``min``, computed once and inlined), not a join. A row
    without a date has no place in the order of the days and is an error.
    """
    measures = measures or DELTAS
    w = Window.partitionBy(key).orderBy(F.col(date_col).asc_nulls_last())
    first_day = snapshots.agg(F.min(date_col)).scalar()
    return snapshots.withColumns({
        c: F.when(F.col(date_col).isNull(), F.raise_error(F.lit(f"{date_col} is null")).cast("bigint"))
            .when(F.col(date_col) == first_day, F.lit(0).cast("bigint"))
            .otherwise(delta(F.col(m), F.lag(F.col(m)).over(w)))
        for c, m in measures.items()
    })
