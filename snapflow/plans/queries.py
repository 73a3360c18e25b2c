"""Registered queries: one per operator group, each over the whole driver tables.

Each callable takes ``(spark, sf_dir)`` and returns a DataFrame whose column names
match the DuckDB oracle in ``snapflow.plans.oracle``. Build-time columns use the fixed
``NOW`` so results are reproducible; VARIANT columns are rendered as JSON text.
"""

from __future__ import annotations

import datetime as dt
from functools import partial

from pyspark.sql import Window
from pyspark.sql import functions as F

from snapflow.functions.jsonpaths import extract
from snapflow.functions.scalars import growth_pct, safe_ratio, tier, trend_indicator
from snapflow.operators import checks as C
from snapflow.operators.dimension import PACKAGE_INPUTS, REPO_INPUTS, build_dimension
from snapflow.operators.history import history_rows, read_history, rebuild_history, upsert
from snapflow.operators.latest import latest_per_key
from snapflow.operators.metrics import (POPULARITY_DEFAULT, POPULARITY_TIERS, USAGE_DEFAULT, USAGE_TIERS,
                                        build_metrics)
from snapflow.operators.ranking import rank_desc
from snapflow.operators.staging import REPO_COLUMNS, stage_packages, stage_repos, variant_to_json
from snapflow.operators.trends import build_trends, entity_window, with_lags, with_moving_averages
from snapflow.plans import bridge as B
from snapflow.plans.daily import EXAMPLE_MAPPING
from snapflow.session import reliable_checkpoint, reliable_checkpoints, scratch_path
from snapflow.sources.freshness import fresh_counts
from snapflow.sources.raw import prepare_landing
from snapflow.sources.responses import flatten_package, flatten_repo

# Fixed values used by the queries and their oracles.
AS_OF = dt.date(2001, 11, 4)          # last ship date in the test data
NOW = dt.datetime(2024, 2, 1, 0, 0, 0)
HISTORY_CUTS = dt.date(1995, 1, 1), dt.date(1998, 1, 1)     # the runs of history_three_days
FRESH_DAY = dt.date(2024, 1, 15)
DAILY_AS_OF = dt.date(2024, 1, 30)
STREAM_CUT = "2024-01-16 00:00:00"
PACKAGES_LOADED_AT = dt.datetime(2024, 1, 30, 12, 0, 0)
# The runs of the multi-day queries: (day, load time of packages, build time); documents before the cuts are
# there on the first day, the rest on the second, and the second day runs twice.
RUNS = [(dt.date(2024, 1, 15), dt.datetime(2024, 1, 15, 12), dt.datetime(2024, 1, 15, 23)),
        (dt.date(2024, 1, 30), dt.datetime(2024, 1, 30, 12), dt.datetime(2024, 1, 30, 23)),
        (dt.date(2024, 1, 30), None, dt.datetime(2024, 1, 30, 23, 30))]
REPO_CUT, ORDER_CUT = "2024-01-16 00:00:00", "1996-01-01 00:00:00"


def _raw_repos(spark, sf):
    return B.repo_documents(B.table(spark, sf, "events"))


def _raw_packages(spark, sf):
    return B.package_documents(B.table(spark, sf, "orders"))


def _stg_repos(spark, sf, only=None):
    return stage_repos(_raw_repos(spark, sf), only=only)


def _stg_packages(spark, sf, only=None):
    return stage_packages(_raw_packages(spark, sf), only=only)


def _snapshots(spark, sf):
    return B.daily_snapshots(B.table(spark, sf, "lineitem"))


def _dimension(spark, sf):
    return build_dimension(B.mapping(B.table(spark, sf, "customer")), _stg_repos(spark, sf, {*REPO_INPUTS, "full_name"}),
                           _stg_packages(spark, sf, PACKAGE_INPUTS), now=NOW,
                           repo_tiebreak=["full_name"], package_tiebreak=["version"])


# --- sources and projections -------------------------------------------------------

def q_json_extract(spark, sf):
    """Typed flat fields and a kept sub-document from every repo document."""
    raw = _raw_repos(spark, sf)
    out = extract(raw, "raw_data", {
        "inner_name": ("repo_name", "string"),
        "stars": ("stars", "bigint"),
        "forks": ("forks", "bigint"),
        "created_at": ("created_at", "timestamp"),
        "topics": ("topics", "variant"),
    }, keep=["extracted_at", "repo_name"])
    return variant_to_json(out, ["topics"])


def q_json_nested(spark, sf):
    """Nested paths (object fields, array element) from every package document."""
    raw = _raw_packages(spark, sf)
    return extract(raw, "raw_data", {
        "upload_time": ("latest_release_info.upload_time", "timestamp"),
        "python_version": ("$.latest_release_info.python_version", "string"),
        "file_size": ("latest_release_info.size", "bigint"),
        "first_classifier": ("classifiers[0]", "string"),
        "home_url": ("project_urls.Home", "string"),
    }, keep=["package_name"])


def q_key_fallback(spark, sf):
    """Inner key, else the landing key; rows per resulting key."""
    return _stg_repos(spark, sf).groupBy("repo_name").agg(F.count(F.lit(1)).alias("n"))


def q_fill_zero(spark, sf):
    """P5: count fields defaulted to 0 (absent statistics, empty release info)."""
    return _stg_packages(spark, sf).select(
        "package_name", "version", "release_count", "latest_release_size", "downloads_last_day",
        "downloads_last_week", "downloads_last_month")


def q_stage_repos(spark, sf):
    """Repository staging, 20 columns."""
    return variant_to_json(_stg_repos(spark, sf), ["topics"])


def q_stage_packages(spark, sf):
    """Package staging, 23 columns."""
    return variant_to_json(_stg_packages(spark, sf), ["classifiers", "requires_dist", "project_urls"])


def _fetched_with_broken(spark, sf):
    """Fetched documents with truncated, empty, missing and non-object ones mixed in, and white space before good ones."""
    raw = B.repo_documents(B.table(spark, sf, "events"), keep=("event_id",))
    eid = F.col("event_id")
    doc = (F.when(eid % 17 == 0, F.substring("raw_data", 1, 25))        # truncated text
             .when(eid % 19 == 0, F.lit("{ }"))                           # empty object
             .when(eid % 23 == 0, F.lit(None).cast("string"))            # no document
             .when(eid % 29 == 0, F.lit("[1, 2]"))                        # not an object
             .when(eid % 43 == 0, F.lit("{}\n\n"))                        # empty object, line breaks after it
             .when(eid % 31 == 0, F.concat(F.lit("\n"), "raw_data"))      # good: a line break first
             .when(eid % 37 == 0, F.concat(F.lit("\t"), "raw_data"))
             .when(eid % 41 == 0, F.concat(F.lit("\r\n"), "raw_data"))
             .when(eid % 47 == 0, F.concat(F.lit('{"language":"?",'), F.substring("raw_data", 2, 1 << 30)))     # good: a key twice
             .otherwise(F.col("raw_data")))
    # the fetched documents exist as stored values before landing: write them once
    return reliable_checkpoint(raw.select("repo_name", doc.alias("doc")))


def q_land_valid(spark, sf):
    """Landing with broken and empty documents mixed in: only loadable ones stay."""
    landed = prepare_landing(_fetched_with_broken(spark, sf), "repo_name", "doc", NOW, as_variant=True)
    return extract(landed, "raw_data", {"language": ("language", "string"), "full_name": ("full_name", "string")},
                   keep=["extracted_at", "repo_name"])


def q_land_counts(spark, sf):
    """One landing job: fetched, loaded and rejected counts gathered by Observation."""
    from snapflow.sources.raw import land_raw
    res = land_raw(_fetched_with_broken(spark, sf), "repo_name", "doc", scratch_path(spark, "land_counts"), NOW)
    return spark.createDataFrame([(res.fetched, res.loaded, res.rejected)],
                                 "fetched bigint, loaded bigint, rejected bigint")


def q_land_rejected(spark, sf):
    """Every document that did not load, with its key and the reason, from the job that loaded the others."""
    from snapflow.sources.raw import land_raw, read_raw, read_rejected
    path = scratch_path(spark, "land_rejected")
    res = land_raw(_fetched_with_broken(spark, sf), "repo_name", "doc", path, NOW, by_day=True)
    rejected = read_rejected(spark, path, "repo_name").withColumn("document", F.when(F.col("reason") != "not JSON", F.col("document")))
    counts = {"loaded_rows": read_raw(spark, path, "repo_name").count(), "fetched": res.fetched, "loaded": res.loaded}
    return rejected.withColumns({c: F.lit(n).cast("bigint") for c, n in counts.items()})


def q_flatten_repo(spark, sf):
    """Repository documents assembled from landed responses, then extracted."""
    docs = flatten_repo(B.repo_responses(B.table(spark, sf, "events")), loaded_at=NOW, fetched_at="fetched_at")
    out = extract(docs, "raw_data", {
        "full_name": ("full_name", "string"), "language": ("language", "string"),
        "stars": ("stars", "bigint"), "forks": ("forks", "bigint"), "watchers": ("watchers", "bigint"),
        "open_issues": ("open_issues", "bigint"), "size": ("size", "bigint"),
        "created_at": ("created_at", "timestamp"), "updated_at": ("updated_at", "timestamp"),
        "contributors_count": ("contributors_count", "bigint"), "releases_count": ("releases_count", "bigint"),
        "latest_release_tag": ("latest_release.tag_name", "string"),
        "latest_release_published_at": ("latest_release.published_at", "timestamp"),
        "topics": ("topics", "variant"), "license": ("license", "string"),
    }, keep=["repo_name"])
    return variant_to_json(out, ["topics"])


def q_flatten_package(spark, sf):
    """Package documents assembled from landed responses, then extracted."""
    docs = flatten_package(B.package_responses(B.table(spark, sf, "orders")), loaded_at=NOW, fetched_at="fetched_at")
    out = extract(docs, "raw_data", {
        "version": ("version", "string"), "summary": ("summary", "string"),
        "release_count": ("release_count", "bigint"),
        "upload_time": ("latest_release_info.upload_time", "timestamp"),
        "python_version": ("latest_release_info.python_version", "string"),
        "file_size": ("latest_release_info.size", "bigint"),
        "filename": ("latest_release_info.filename", "string"),
        "downloads_last_day": ("downloads_last_day", "bigint"),
        "downloads_last_week": ("downloads_last_week", "bigint"),
        "downloads_last_month": ("downloads_last_month", "bigint"),
        "classifiers": ("classifiers", "variant"),
    }, keep=["package_name"])
    return variant_to_json(out, ["classifiers"])


def q_fresh_counts(spark, sf):
    """Rows per source landed on one day."""
    return fresh_counts({"github_repos": _raw_repos(spark, sf), "pypi_packages": _raw_packages(spark, sf)},
                        FRESH_DAY)


def q_latest_repo(spark, sf):
    """Latest staged repository row per key."""
    s = latest_per_key(_stg_repos(spark, sf), "repo_name", "extracted_at", ["full_name"])
    return s.select("repo_name", "extracted_at", "full_name", "stars", "forks", "contributors_count")


def q_latest_package(spark, sf):
    """Latest staged package row per key."""
    s = latest_per_key(_stg_packages(spark, sf), "package_name", "extracted_at", ["version"])
    return s.select("package_name", "extracted_at", "version", "downloads_last_day", "downloads_last_month")


def q_stream_latest_repo(spark, sf):
    """Latest staged repo per key, maintained by a streaming aggregation over two landings."""
    from snapflow.streaming.latest import read_latest, stream_latest
    root = scratch_path(spark, "stream_latest")
    landing, out, ckpt = f"{root}/landing", f"{root}/latest", f"{root}/_checkpoint"
    raw = _raw_repos(spark, sf)
    cut = F.col("extracted_at") < F.lit(STREAM_CUT).cast("timestamp_ntz")
    for part in (raw.where(cut), raw.where(~F.coalesce(cut, F.lit(False)))):   # two days of landings, one run after each
        part.write.mode("append").parquet(landing)
        q = stream_latest(spark, landing, "repo_name", out, ckpt, partial(stage_repos, only=REPO_COLUMNS), tiebreak=["full_name"])
        q.awaitTermination()
    s = read_latest(spark, out)
    return s.select("repo_name", "extracted_at", "full_name", "stars", "forks", "contributors_count")


def q_dimension(spark, sf):
    """The two-source dimension, 28 columns."""
    return variant_to_json(_dimension(spark, sf), ["topics"])


def q_metrics(spark, sf):
    """Ratios, tiers and snapshot date, 25 columns."""
    return build_metrics(_dimension(spark, sf))


# --- scalar KPIs over lineitem per supplier ------------------------------------------

def _per_supplier(spark, sf):
    li = B.table(spark, sf, "lineitem")
    return li.groupBy("l_suppkey").agg(
        F.sum(F.col("l_quantity").cast("bigint")).alias("stars"),
        F.count_if(F.col("l_returnflag") == "R").alias("forks"),
        F.count_if(F.col("l_linestatus") == "O").alias("contributors"),
        F.count_if(F.col("l_discount") == 0).alias("zero_disc"))


def q_ratios(spark, sf):
    """Guarded ratios over per-supplier aggregates."""
    s = _per_supplier(spark, sf)
    return s.select("l_suppkey",
                    safe_ratio("forks", "stars").alias("fork_to_star_ratio"),
                    safe_ratio("stars", "contributors").alias("stars_per_contributor"),
                    safe_ratio("forks", "zero_disc", scale=6).alias("guarded_ratio"))


def q_tiers(spark, sf):
    """Tier labels over per-supplier aggregates."""
    s = _per_supplier(spark, sf)
    return s.select("l_suppkey",
                    tier(F.col("stars") * 20, POPULARITY_TIERS, POPULARITY_DEFAULT).alias("popularity_tier"),
                    tier(F.col("stars") * 1000, USAGE_TIERS, USAGE_DEFAULT).alias("usage_tier"))


# --- windows over daily snapshots ----------------------------------------------------

def q_moving_avg(spark, sf):
    """7- and 30-row moving averages over daily snapshots."""
    w = entity_window()
    return with_moving_averages(_snapshots(spark, sf), w, {
        "stars_7day_avg": ("github_stars", 7),
        "downloads_7day_avg": ("pypi_downloads_daily", 7),
        "stars_30day_avg": ("github_stars", 30),
    }).select("technology_name", "snapshot_date", "stars_7day_avg", "downloads_7day_avg", "stars_30day_avg")


def q_lag_growth(spark, sf):
    """Values 7 and 30 rows back and growth percentages."""
    w = entity_window()
    t = with_lags(_snapshots(spark, sf), w, {
        "stars_7days_ago": ("github_stars", 7),
        "stars_30days_ago": ("github_stars", 30),
        "downloads_7days_ago": ("pypi_downloads_daily", 7),
    })
    return t.select("technology_name", "snapshot_date", "stars_7days_ago", "stars_30days_ago",
                    "downloads_7days_ago",
                    growth_pct("github_stars", "stars_7days_ago").alias("stars_7day_growth_pct"),
                    growth_pct("github_stars", "stars_30days_ago").alias("stars_30day_growth_pct"),
                    growth_pct("pypi_downloads_daily", "downloads_7days_ago").alias("downloads_7day_growth_pct"))


def q_daily_rank(spark, sf):
    """Daily rank (split strategy)."""
    r = rank_desc(_snapshots(spark, sf), "snapshot_date", "github_stars", "daily_popularity_rank")
    return r.select("technology_name", "snapshot_date", "github_stars", "daily_popularity_rank")


def q_daily_rank_buckets(spark, sf):
    """The same ranks when every day is cut into many buckets."""
    r = rank_desc(_snapshots(spark, sf), "snapshot_date", "github_stars", "daily_popularity_rank", pieces=64)
    return r.select("technology_name", "snapshot_date", "github_stars", "daily_popularity_rank")


def q_daily_rank_window(spark, sf):
    """Daily rank (plain window), same result."""
    r = rank_desc(_snapshots(spark, sf), "snapshot_date", "github_stars", "daily_popularity_rank",
                  strategy="window")
    return r.select("technology_name", "snapshot_date", "github_stars", "daily_popularity_rank")


def q_trends(spark, sf):
    """The trend fact over daily snapshots, 90-day retention."""
    return build_trends(_snapshots(spark, sf), as_of=AS_OF, days=90)


def q_trends_look_back(spark, sf):
    """R1 with the scan of older days bounded by each entity's dates, as in the daily run; same result."""
    from snapflow.operators.trends import look_back_start
    snap = reliable_checkpoint(_snapshots(spark, sf))
    dates = F.sort_array(F.collect_set("snapshot_date"), asc=False)
    state = snap.groupBy("technology_name").agg(F.min("snapshot_date").alias("first_snapshot_date"),
                                                F.slice(dates, 1, 150).alias("recent_dates"))
    return build_trends(snap, as_of=AS_OF, days=90, look_back=look_back_start(state, AS_OF, 90))


def q_trends_update(spark, sf):
    """Trends stored the day before, brought up to date after the last day's merge; same result as ``trends``."""
    from snapflow.operators.history import previous_rows, upsert_with_latest
    from snapflow.operators.trends import read_trends, update_trends, write_trends
    m = reliable_checkpoint(B.snapshot_metrics(_snapshots(spark, sf)))
    path, target, before = scratch_path(spark, "history_trends"), scratch_path(spark, "trends"), AS_OF - dt.timedelta(days=1)
    upsert_with_latest(spark, path, history_rows(m.where(F.col("snapshot_date") <= F.lit(before)), None, now=NOW))
    write_trends(spark, target, build_trends(read_history(spark, path), as_of=before, days=90), before, 90)
    last = m.where(F.col("snapshot_date") > F.lit(before))
    rows = reliable_checkpoint(history_rows(last, None, now=NOW, previous=previous_rows(spark, path)))
    state = upsert_with_latest(spark, path, rows)
    if not update_trends(spark, target, read_history(spark, path), rows, state, AS_OF, 90):
        raise AssertionError("stored trends of the day before can be brought up to date")
    return read_trends(spark, target)


def q_trend_indicators(spark, sf):
    """Above / below / equal to the 7-row average."""
    w = entity_window()
    t = with_moving_averages(_snapshots(spark, sf), w, {"a": ("github_stars", 7), "b": ("pypi_downloads_daily", 7)})
    return t.select("technology_name", "snapshot_date",
                    trend_indicator("github_stars", "a").alias("stars_trend_indicator"),
                    trend_indicator("pypi_downloads_daily", "b").alias("downloads_trend_indicator"))


def q_trends_single(spark, sf):
    """Literal original behaviour: trends over the one-row-per-technology metrics."""
    return build_trends(build_metrics(_dimension(spark, sf)), as_of=dt.date(2024, 1, 30), days=90)


# --- history -------------------------------------------------------------------------

def _split_latest(spark, sf):
    m = B.snapshot_metrics(_snapshots(spark, sf))
    w = Window.partitionBy("technology_name").orderBy(F.col("snapshot_date").desc_nulls_first())
    m = m.withColumn("__rn", F.row_number().over(w))
    return m.where("__rn = 1").drop("__rn"), m.where("__rn > 1").drop("__rn")


def q_history_first(spark, sf):
    """First run, zero changes."""
    cur, _ = _split_latest(spark, sf)
    return history_rows(cur, None, now=NOW)


def q_history_step(spark, sf):
    """Latest snapshot against the one before it."""
    cur, prior = _split_latest(spark, sf)
    return history_rows(cur, history_rows(prior, None, now=NOW), now=NOW)


def q_history_rerun(spark, sf):
    """H1: same-day rerun, changes are 0."""
    cur, prior = _split_latest(spark, sf)
    first = history_rows(cur, history_rows(prior, None, now=NOW), now=NOW)
    hist = history_rows(prior, None, now=NOW).unionByName(first)
    return history_rows(cur, hist, now=NOW)


def q_history_upsert(spark, sf):
    """Merge into a day-partitioned table, read back whole."""
    cur, prior = _split_latest(spark, sf)
    path = scratch_path(spark, "history_upsert")
    upsert(spark, path, history_rows(prior, None, now=NOW))
    upsert(spark, path, history_rows(cur, read_history(spark, path), now=NOW))
    return read_history(spark, path)


def q_history_step_latest(spark, sf):
    """H1 via the latest-state table: previous rows come from the one-row-per-entity table
    kept by ``upsert_with_latest``, not from a scan of the history (same result as
    ``history_step``)."""
    from snapflow.operators.history import latest_path, upsert_with_latest
    cur, prior = _split_latest(spark, sf)
    path = scratch_path(spark, "history_latest")
    upsert_with_latest(spark, path, history_rows(prior, None, now=NOW))
    return history_rows(cur, None, now=NOW, previous=spark.read.parquet(latest_path(path)))


def q_history_three_days(spark, sf):
    """H1, H1a, H2 over four runs of all snapshots: those of the first years, of the next ones, these again with more stars
    and downloads, and of the last. Every row of a run is compared with its entity's newest stored one."""
    from snapflow.operators.history import previous_rows, upsert_with_latest
    m = reliable_checkpoint(B.snapshot_metrics(_snapshots(spark, sf)))
    day, (low, high) = F.col("snapshot_date"), (F.lit(c) for c in HISTORY_CUTS)
    one, two, three = m.where(day < low), m.where((day >= low) & (day < high)), m.where(day >= high)
    again = two.withColumns({"github_stars": F.col("github_stars") + 5, "pypi_downloads_daily": F.col("pypi_downloads_daily") + 1})
    path = scratch_path(spark, "history_days")
    for day in (one, two, again, three):
        upsert_with_latest(spark, path, history_rows(day, None, now=NOW, previous=previous_rows(spark, path)))
    return read_history(spark, path)


def q_history_replay(spark, sf):
    """One-pass history back-fill (closed form of the daily fold)."""
    return rebuild_history(B.snapshot_metrics(_snapshots(spark, sf))).select(
        "technology_name", "snapshot_date", "github_stars", "stars_change", "forks_change",
        "downloads_change", "issues_change")


def q_schema_sync(spark, sf):
    """H3: merge after a column was added and one dropped."""
    cur, prior = _split_latest(spark, sf)
    path = scratch_path(spark, "schema_sync")
    old = history_rows(prior, None, now=NOW).drop("issues_change").withColumn("legacy_note", F.lit("v1"))
    upsert(spark, path, old)
    upsert(spark, path, history_rows(cur, read_history(spark, path), now=NOW))
    return read_history(spark, path)


# --- checks --------------------------------------------------------------------------

def q_check_not_null(spark, sf):
    """Failing rows of a not-null check."""
    stg = _stg_repos(spark, sf)
    return C.check_not_null(stg, "description").select("repo_name", "extracted_at", "full_name")


def q_check_unique(spark, sf):
    """Repeated values."""
    return C.check_unique(_stg_packages(spark, sf), "package_name")


def q_check_accepted(spark, sf):
    """Values outside the accepted set."""
    m = build_metrics(_dimension(spark, sf))
    return C.check_accepted(m.withColumn("popularity_tier", F.when(
        F.col("github_stars") >= 45000, F.lit("Legendary")).otherwise(F.col("popularity_tier"))),
        "popularity_tier", C.POPULARITY_VALUES)


def q_check_suite(spark, sf):
    """C4: report of every check over every table. Tables that feed several others are stored once, as in the
    daily run: staged rows (the columns that dimension and checks read), the dimension, the snapshots."""
    stg_r, stg_p, snap = reliable_checkpoints(
        _stg_repos(spark, sf, {*REPO_INPUTS, "full_name", "description"}),
        _stg_packages(spark, sf, PACKAGE_INPUTS),
        _snapshots(spark, sf))
    dim = reliable_checkpoint(build_dimension(B.mapping(B.table(spark, sf, "customer")), stg_r, stg_p, now=NOW,
                                              repo_tiebreak=["full_name"], package_tiebreak=["version"]))
    m = B.snapshot_metrics(snap)
    w = Window.partitionBy("technology_name").orderBy(F.col("snapshot_date").desc_nulls_first())
    newest = m.withColumn("__rn", F.row_number().over(w)).where("__rn = 1").drop("__rn")
    tables = {
        "stg_github_repos": stg_r,
        "stg_pypi_packages": stg_p,
        "dim_technologies": dim,
        "fct_technology_metrics": build_metrics(dim),
        "fct_technology_history": history_rows(newest, None, now=NOW),
        "fct_technology_trends": build_trends(snap, as_of=AS_OF, days=90),
    }
    extra = (C.Check("stg_github_repos", "not_null", "description"),
             C.Check("fct_technology_metrics", "not_null", "snapshot_date"),
             C.Check("stg_pypi_packages", "unique", "package_name"))
    return C.run_checks(tables, C.DEFAULT_CHECKS + extra)


def q_daily_trends(spark, sf):
    """One daily run on landed copies of the driver tables; returns its trends."""
    from snapflow.plans.daily import RunConfig, run_daily
    from snapflow.sources.raw import land_raw
    cfg = RunConfig(root=scratch_path(spark, "daily_trends"), as_of=DAILY_AS_OF, now=NOW, check="report",
                    repo_tiebreak=("full_name",), package_tiebreak=("version",))
    B.repo_documents(B.table(spark, sf, "events")).write.parquet(cfg.raw_repos)
    land_raw(B.package_documents(B.table(spark, sf, "orders")), "package_name", "raw_data",
             cfg.raw_packages, PACKAGES_LOADED_AT, by_day=True)
    out = run_daily(spark, B.mapping(B.table(spark, sf, "customer")), cfg)
    return out["trends"]


def _daily_runs(spark, sf, staging):
    """Two days of landings and a rerun of the second (``RUNS``)."""
    from snapflow.plans.daily import RunConfig, run_daily
    from snapflow.sources.raw import land_raw
    root = scratch_path(spark, f"daily_{staging}")
    repos = B.repo_documents(B.table(spark, sf, "events"))
    orders = B.table(spark, sf, "orders")
    early = [F.coalesce(F.col(c) < F.lit(cut).cast("timestamp_ntz"), F.lit(False))
             for c, cut in (("extracted_at", REPO_CUT), ("o_orderdate", ORDER_CUT))]
    for n, (day, loaded_at, now) in enumerate(RUNS):
        cfg = RunConfig(root=root, as_of=day, now=now, check="report", staging=staging,
                        repo_tiebreak=("full_name",), package_tiebreak=("version",))
        if loaded_at is not None:
            here = [c if n == 0 else ~c for c in early]
            repos.where(here[0]).write.mode("append").parquet(cfg.raw_repos)
            land_raw(B.package_documents(orders.where(here[1])), "package_name", "raw_data", cfg.raw_packages, loaded_at,
                     by_day=True)
        out = run_daily(spark, B.mapping(B.table(spark, sf, "customer")), cfg)
    return out


def q_daily_run(spark, sf):
    """L1: two days and a rerun, staging only newly landed documents; returns the history with its changes."""
    return _daily_runs(spark, sf, "incremental")["history"]


def q_daily_run_full(spark, sf):
    """L1: the same runs, staging every document each time; the same history."""
    return _daily_runs(spark, sf, "full")["history"]


def q_daily_run_dimension(spark, sf):
    """L1: the dimension after those runs, with the VARIANT topics that staged rows were stored with."""
    return variant_to_json(_daily_runs(spark, sf, "incremental")["dimension"], ["topics"])


def q_example_mapping(spark, sf):
    """The ten literal mapping rows, joined to staged documents of their own names made of ``orders``."""
    from snapflow.plans.daily import example_mapping
    m = example_mapping(spark)
    names = F.array(*[F.lit(x) for _, x, _ in EXAMPLE_MAPPING]), F.array(*[F.lit(x) for _, _, x in EXAMPLE_MAPPING])
    k = (F.col("o_orderkey") % len(EXAMPLE_MAPPING) + 1).cast("int")
    per = B.table(spark, sf, "orders").groupBy(F.element_at(names[0], k).alias("repo"), F.element_at(names[1], k).alias("package")).agg(
        F.count(F.lit(1)).alias("orders"))
    return (m.join(per.select("repo", F.col("orders").alias("repo_orders")), m.github_repo == F.col("repo"), "left")
            .join(per.select("package", F.col("orders").alias("package_orders")), m.pypi_package == F.col("package"), "left")
            .select("technology_name", "github_repo", "pypi_package", "repo_orders", "package_orders"))


QUERIES = {
    "json_extract": q_json_extract,
    "json_nested": q_json_nested,
    "key_fallback": q_key_fallback,
    "fill_zero": q_fill_zero,
    "stage_repos": q_stage_repos,
    "stage_packages": q_stage_packages,
    "land_valid": q_land_valid,
    "land_counts": q_land_counts,
    "land_rejected": q_land_rejected,
    "flatten_repo": q_flatten_repo,
    "flatten_package": q_flatten_package,
    "fresh_counts": q_fresh_counts,
    "latest_repo": q_latest_repo,
    "latest_package": q_latest_package,
    "stream_latest_repo": q_stream_latest_repo,
    "dimension": q_dimension,
    "metrics": q_metrics,
    "ratios": q_ratios,
    "tiers": q_tiers,
    "moving_avg": q_moving_avg,
    "lag_growth": q_lag_growth,
    "daily_rank": q_daily_rank,
    "daily_rank_window": q_daily_rank_window,
    "daily_rank_buckets": q_daily_rank_buckets,
    "trend_indicators": q_trend_indicators,
    "trends": q_trends,
    "trends_single": q_trends_single,
    "trends_look_back": q_trends_look_back,
    "trends_update": q_trends_update,
    "history_first": q_history_first,
    "history_step": q_history_step,
    "history_rerun": q_history_rerun,
    "history_upsert": q_history_upsert,
    "history_step_latest": q_history_step_latest,
    "history_three_days": q_history_three_days,
    "history_replay": q_history_replay,
    "schema_sync": q_schema_sync,
    "check_not_null": q_check_not_null,
    "check_unique": q_check_unique,
    "check_accepted": q_check_accepted,
    "check_suite": q_check_suite,
    "daily_run": q_daily_run,
    "daily_run_full": q_daily_run_full,
    "daily_run_dimension": q_daily_run_dimension,
    "daily_trends": q_daily_trends,
    "example_mapping": q_example_mapping,
}
