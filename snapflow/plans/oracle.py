"""DuckDB oracle SQL for every registered query.

Written against the plain driver tables (``events``, ``orders``, ``customer``,
``lineitem``), not against the JSON documents the Spark side builds, so the two sides
are independent: the oracle re-derives each field from its source column by the
bridge rules, and the Spark side has to get there through JSON text, VARIANT parsing,
typed extraction and defaults. NULL ordering is always spelled out.
"""

from __future__ import annotations

import datetime as dt

from snapflow.plans.daily import EXAMPLE_MAPPING
from snapflow.plans.queries import AS_OF, DAILY_AS_OF, FRESH_DAY, HISTORY_CUTS, NOW, ORDER_CUT, PACKAGES_LOADED_AT, REPO_CUT, RUNS

_NOW = f"TIMESTAMP '{NOW:%Y-%m-%d %H:%M:%S}'"
_CUT = (AS_OF - dt.timedelta(days=90)).isoformat()
_DAILY_CUT = (DAILY_AS_OF - dt.timedelta(days=90)).isoformat()

E = """e AS (
  SELECT event_id, ts, user_id, event_type, value, event_id % 10 AS m,
         CAST(json_extract_string(props, '$.k') AS BIGINT) AS k
  FROM events)"""

STG_REPOS = E + """,
stg_repos AS (
  SELECT ts AS extracted_at,
    CASE WHEN m = 0 THEN 'R' ELSE 'r' END || CAST(user_id AS VARCHAR) AS repo_name,
    'u' || CAST(user_id AS VARCHAR) || '/e' || CAST(event_id AS VARCHAR) AS full_name,
    CASE WHEN m = 1 THEN NULL ELSE event_type || ' events' END AS description,
    event_type AS language,
    CAST(CASE WHEN m = 3 THEN 0 ELSE k * 500 END AS BIGINT) AS stars,
    CAST(CASE WHEN m = 9 THEN 0 ELSE k * 7 END AS BIGINT) AS forks,
    CAST(k * 500 AS BIGINT) AS watchers,
    CAST(event_id % 50 AS BIGINT) AS open_issues,
    CAST(floor(value) AS BIGINT) AS size,
    date_trunc('second', ts) AS created_at,
    date_trunc('second', ts) AS updated_at,
    CASE WHEN m = 2 THEN NULL ELSE date_trunc('second', ts) END AS pushed_at,
    'main' AS default_branch,
    CAST(k % 13 AS BIGINT) AS contributors_count,
    CAST(k % 5 AS BIGINT) AS releases_count,
    CASE WHEN k % 5 = 0 THEN NULL ELSE 'v' || CAST(k AS VARCHAR) END AS latest_release_tag,
    CASE WHEN k % 5 = 0 THEN NULL ELSE date_trunc('second', ts) END AS latest_release_published_at,
    '["' || event_type || '"]' AS topics,
    CASE WHEN k % 3 = 0 THEN 'MIT' END AS license
  FROM e)"""

PKG_COLS = """
    CASE WHEN o_orderkey % 10 = 0 THEN 'P' ELSE 'p' END || CAST(o_custkey AS VARCHAR) AS package_name,
    CAST(o_orderkey AS VARCHAR) AS version,
    o_orderpriority AS summary,
    'text/plain' AS description_content_type,
    CASE WHEN o_orderkey % 4 = 0 THEN NULL ELSE 'site/' || CAST(o_custkey AS VARCHAR) END AS home_page,
    o_orderstatus AS author,
    CAST(NULL AS VARCHAR) AS author_email,
    o_orderstatus AS maintainer,
    CASE WHEN o_orderkey % 3 = 0 THEN 'BSD' END AS license,
    o_orderstatus || ',' || o_orderpriority AS keywords,
    '["' || o_orderpriority || '"]' AS classifiers,
    '[]' AS requires_dist,
    '>=3.8' AS requires_python,
    '{"Home":"site/' || CAST(o_custkey AS VARCHAR) || '"}' AS project_urls,
    CAST(o_orderkey % 20 AS BIGINT) AS release_count,
    CASE WHEN o_orderkey % 20 = 0 THEN NULL ELSE o_orderdate END AS latest_release_upload_time,
    CASE WHEN o_orderkey % 20 = 0 THEN NULL ELSE 'py3' END AS latest_python_version,
    CAST(CASE WHEN o_orderkey % 20 = 0 THEN 0 ELSE o_orderkey % 1000 END AS BIGINT) AS latest_release_size,
    CASE WHEN o_orderkey % 20 = 0 THEN NULL ELSE 'pkg-' || CAST(o_orderkey AS VARCHAR) || '.whl' END AS latest_filename,
    CAST(CASE WHEN o_orderkey % 10 = 4 THEN 0 ELSE floor(o_totalprice / 1000) END AS BIGINT) AS downloads_last_day,
    CAST(CASE WHEN o_orderkey % 10 = 4 THEN 0 ELSE floor(o_totalprice / 100) END AS BIGINT) AS downloads_last_week,
    CAST(CASE WHEN o_orderkey % 10 = 4 THEN 0 ELSE floor(o_totalprice * 20) END AS BIGINT) AS downloads_last_month"""

STG_PACKAGES = f"""stg_packages AS (
  SELECT o_orderdate AS extracted_at, {PKG_COLS}
  FROM orders)"""

MAPPING = """tm AS (
  SELECT c_name AS technology_name,
    CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE 'r' || CAST(c_custkey AS VARCHAR) END AS github_repo,
    CASE WHEN c_custkey % 11 = 0 THEN NULL ELSE 'p' || CAST(c_custkey AS VARCHAR) END AS pypi_package
  FROM customer)"""

LATEST = """gh AS (
  SELECT * FROM stg_repos
  QUALIFY row_number() OVER (PARTITION BY repo_name
                             ORDER BY extracted_at DESC NULLS FIRST, full_name DESC NULLS FIRST) = 1),
py AS (
  SELECT * FROM stg_packages
  QUALIFY row_number() OVER (PARTITION BY package_name
                             ORDER BY extracted_at DESC NULLS FIRST, version DESC NULLS FIRST) = 1)"""

DIM_SELECT = f"""dim AS (
  SELECT tm.technology_name, tm.github_repo, tm.pypi_package,
    gh.stars, gh.forks, gh.watchers, gh.open_issues, gh.contributors_count, gh.releases_count,
    gh.language, gh.license, gh.created_at AS github_created_at, gh.updated_at AS github_updated_at,
    gh.latest_release_tag, gh.latest_release_published_at, gh.topics,
    py.version AS current_version, py.downloads_last_day, py.downloads_last_week, py.downloads_last_month,
    py.release_count AS pypi_release_count, py.requires_python, py.author, py.summary, py.home_page,
    py.latest_release_upload_time,
    CASE WHEN gh.extracted_at IS NULL OR py.extracted_at IS NULL THEN NULL
         ELSE greatest(gh.extracted_at, py.extracted_at) END AS last_updated_at,
    {_NOW} AS mart_created_at
  FROM tm
  LEFT JOIN gh ON tm.github_repo = gh.repo_name
  LEFT JOIN py ON tm.pypi_package = py.package_name)"""

DIM = f"WITH {STG_REPOS},\n{STG_PACKAGES},\n{MAPPING},\n{LATEST},\n{DIM_SELECT}"

# The tier bounds and labels below.
METRICS_SELECT = """met AS (
  SELECT technology_name, github_repo, pypi_package,
    stars AS github_stars, forks AS github_forks, watchers AS github_watchers,
    downloads_last_day AS pypi_downloads_daily, downloads_last_week AS pypi_downloads_weekly,
    downloads_last_month AS pypi_downloads_monthly,
    open_issues, contributors_count, releases_count AS github_releases, pypi_release_count,
    CASE WHEN downloads_last_day > 0 THEN round(CAST(downloads_last_week AS DOUBLE) / downloads_last_day, 6) ELSE 0.0 END
      AS weekly_to_daily_ratio,
    CASE WHEN downloads_last_week > 0 THEN round(CAST(downloads_last_month AS DOUBLE) / downloads_last_week, 6)
         ELSE 0.0 END AS monthly_to_weekly_ratio,
    CASE WHEN stars > 0 THEN CAST(forks AS DOUBLE) / stars ELSE 0.0 END AS fork_to_star_ratio,
    CASE WHEN contributors_count > 0 THEN CAST(stars AS DOUBLE) / contributors_count ELSE 0.0 END
      AS stars_per_contributor,
    CASE WHEN stars >= 30000 THEN 'Very Popular' WHEN stars >= 15000 THEN 'Popular'
         WHEN stars >= 5000 THEN 'Moderate' ELSE 'Emerging' END AS popularity_tier,
    CASE WHEN downloads_last_month >= 10000000 THEN 'High Usage' WHEN downloads_last_month >= 1000000 THEN 'Medium Usage'
         WHEN downloads_last_month >= 100000 THEN 'Low Usage' ELSE 'Minimal Usage' END AS usage_tier,
    github_created_at, github_updated_at, latest_release_published_at, latest_release_upload_time,
    last_updated_at, CAST(last_updated_at AS DATE) AS snapshot_date
  FROM dim
  WHERE github_repo IS NOT NULL OR pypi_package IS NOT NULL)"""

SNAP = """snap AS (
  SELECT 's' || CAST(l_suppkey AS VARCHAR) AS technology_name, CAST(l_shipdate AS DATE) AS snapshot_date,
    CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS github_stars,
    CAST(sum(CAST(l_linenumber AS BIGINT)) AS BIGINT) AS github_forks,
    count(*) AS pypi_downloads_daily,
    count(*) FILTER (WHERE l_returnflag = 'R') AS open_issues
  FROM lineitem GROUP BY 1, 2)"""

W_ENT = "PARTITION BY technology_name ORDER BY snapshot_date ASC NULLS LAST"


def _trends_sql(src: str, cut: str) -> str:
    # The frames, look-backs and indicator labels below.
    return f"""tc AS (
  SELECT technology_name, snapshot_date, github_stars, github_forks, pypi_downloads_daily,
    avg(github_stars) OVER ({W_ENT} ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS stars_7day_avg,
    avg(pypi_downloads_daily) OVER ({W_ENT} ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS downloads_7day_avg,
    avg(github_stars) OVER ({W_ENT} ROWS BETWEEN 29 PRECEDING AND CURRENT ROW) AS stars_30day_avg,
    lag(github_stars, 7) OVER ({W_ENT}) AS stars_7days_ago,
    lag(github_stars, 30) OVER ({W_ENT}) AS stars_30days_ago,
    lag(pypi_downloads_daily, 7) OVER ({W_ENT}) AS downloads_7days_ago,
    rank() OVER (PARTITION BY snapshot_date ORDER BY github_stars DESC NULLS FIRST) AS daily_popularity_rank
  FROM {src})
SELECT technology_name, snapshot_date, github_stars, github_forks, pypi_downloads_daily,
  stars_7day_avg, downloads_7day_avg, stars_30day_avg, CAST(daily_popularity_rank AS BIGINT) AS daily_popularity_rank,
  CASE WHEN stars_7days_ago > 0 THEN (CAST(github_stars - stars_7days_ago AS DOUBLE) / stars_7days_ago) * 100 ELSE 0.0 END
    AS stars_7day_growth_pct,
  CASE WHEN stars_30days_ago > 0 THEN (CAST(github_stars - stars_30days_ago AS DOUBLE) / stars_30days_ago) * 100 ELSE 0.0 END
    AS stars_30day_growth_pct,
  CASE WHEN downloads_7days_ago > 0
       THEN (CAST(pypi_downloads_daily - downloads_7days_ago AS DOUBLE) / downloads_7days_ago) * 100 ELSE 0.0 END
    AS downloads_7day_growth_pct,
  CASE WHEN github_stars > stars_7day_avg THEN 'Above Average' WHEN github_stars < stars_7day_avg THEN 'Below Average'
       ELSE 'Average' END AS stars_trend_indicator,
  CASE WHEN pypi_downloads_daily > downloads_7day_avg THEN 'Above Average'
       WHEN pypi_downloads_daily < downloads_7day_avg THEN 'Below Average' ELSE 'Average' END AS downloads_trend_indicator
FROM tc
WHERE snapshot_date >= DATE '{cut}'"""


# The tier bounds and labels below.
SNAP_METRICS = SNAP + """,
sm AS (
  SELECT technology_name, technology_name AS github_repo, CAST(NULL AS VARCHAR) AS pypi_package,
    github_stars, github_forks, github_stars AS github_watchers, pypi_downloads_daily,
    CAST(NULL AS BIGINT) AS pypi_downloads_weekly, CAST(NULL AS BIGINT) AS pypi_downloads_monthly,
    open_issues, CAST(NULL AS BIGINT) AS contributors_count, CAST(NULL AS BIGINT) AS github_releases,
    CAST(NULL AS BIGINT) AS pypi_release_count,
    CASE WHEN github_stars > 0 THEN CAST(github_forks AS DOUBLE) / github_stars ELSE 0.0 END AS fork_to_star_ratio,
    CAST(0.0 AS DOUBLE) AS stars_per_contributor,
    CASE WHEN github_stars >= 30000 THEN 'Very Popular' WHEN github_stars >= 15000 THEN 'Popular'
         WHEN github_stars >= 5000 THEN 'Moderate' ELSE 'Emerging' END AS popularity_tier,
    'Minimal Usage' AS usage_tier,
    CAST(NULL AS TIMESTAMP) AS github_created_at, CAST(NULL AS TIMESTAMP) AS github_updated_at,
    CAST(NULL AS TIMESTAMP) AS latest_release_published_at, CAST(NULL AS TIMESTAMP) AS latest_release_upload_time,
    snapshot_date, CAST(snapshot_date AS TIMESTAMP) AS last_updated_at,
    row_number() OVER (PARTITION BY technology_name ORDER BY snapshot_date DESC NULLS FIRST) AS rn
  FROM snap)"""

HIST_CARRIED = """technology_name, github_repo, pypi_package, github_stars, github_forks, github_watchers,
    pypi_downloads_daily, pypi_downloads_weekly, pypi_downloads_monthly, open_issues, contributors_count,
    github_releases, pypi_release_count, fork_to_star_ratio, stars_per_contributor, popularity_tier, usage_tier,
    github_created_at, github_updated_at, latest_release_published_at, latest_release_upload_time,
    snapshot_date, last_updated_at"""

ZERO_DELTAS = f"""CAST(0 AS BIGINT) AS stars_change, CAST(0 AS BIGINT) AS forks_change,
    CAST(0 AS BIGINT) AS downloads_change, CAST(0 AS BIGINT) AS issues_change, {_NOW} AS history_created_at"""


def _step_rows(issues: bool = True) -> str:
    """Latest snapshot per supplier vs the one before it."""
    cur = ", ".join(f"c.{c.strip()}" for c in HIST_CARRIED.split(","))
    return f"""SELECT {cur},
    c.github_stars - coalesce(p.github_stars, 0) AS stars_change,
    c.github_forks - coalesce(p.github_forks, 0) AS forks_change,
    c.pypi_downloads_daily - coalesce(p.pypi_downloads_daily, 0) AS downloads_change,
    c.open_issues - coalesce(p.open_issues, 0) AS issues_change,
    {_NOW} AS history_created_at
  FROM sm c LEFT JOIN sm p ON c.technology_name = p.technology_name AND p.rn = 2
  WHERE c.rn = 1"""


def _daily_dim() -> str:
    loaded = f"TIMESTAMP '{PACKAGES_LOADED_AT:%Y-%m-%d %H:%M:%S}'"
    stg_p = f"""stg_packages AS (
  SELECT {loaded} AS extracted_at, {PKG_COLS}
  FROM orders)"""
    return f"WITH {STG_REPOS},\n{stg_p},\n{MAPPING},\n{LATEST},\n{DIM_SELECT}"


ORACLE_SQL: dict[str, str] = {
    "json_extract": "WITH " + E + """
SELECT ts AS extracted_at, 'R' || CAST(user_id AS VARCHAR) AS repo_name,
  CASE WHEN m = 0 THEN NULL ELSE 'r' || CAST(user_id AS VARCHAR) END AS inner_name,
  CAST(CASE WHEN m = 3 THEN NULL ELSE k * 500 END AS BIGINT) AS stars,
  CAST(CASE WHEN m = 9 THEN NULL ELSE k * 7 END AS BIGINT) AS forks,
  date_trunc('second', ts) AS created_at,
  '["' || event_type || '"]' AS topics
FROM e""",

    "json_nested": """
SELECT 'P' || CAST(o_custkey AS VARCHAR) AS package_name,
  CASE WHEN o_orderkey % 20 = 0 THEN NULL ELSE o_orderdate END AS upload_time,
  CASE WHEN o_orderkey % 20 = 0 THEN NULL ELSE 'py3' END AS python_version,
  CAST(CASE WHEN o_orderkey % 20 = 0 THEN NULL ELSE o_orderkey % 1000 END AS BIGINT) AS file_size,
  o_orderpriority AS first_classifier,
  'site/' || CAST(o_custkey AS VARCHAR) AS home_url
FROM orders""",

    "key_fallback": f"WITH {STG_REPOS}\nSELECT repo_name, count(*) AS n FROM stg_repos GROUP BY repo_name",

    "fill_zero": f"""WITH {STG_PACKAGES}
SELECT package_name, version, release_count, latest_release_size, downloads_last_day, downloads_last_week,
  downloads_last_month FROM stg_packages""",

    "stage_repos": f"WITH {STG_REPOS}\nSELECT * FROM stg_repos",

    "stage_packages": f"WITH {STG_PACKAGES}\nSELECT * FROM stg_packages",

    "land_valid": f"""
SELECT {_NOW} AS extracted_at, 'R' || CAST(user_id AS VARCHAR) AS repo_name, event_type AS language,
  'u' || CAST(user_id AS VARCHAR) || '/e' || CAST(event_id AS VARCHAR) AS full_name
FROM events
WHERE event_id % 17 <> 0 AND event_id % 19 <> 0 AND event_id % 23 <> 0 AND event_id % 29 <> 0
  AND event_id % 43 <> 0""",

    "flatten_repo": """WITH u AS (
  SELECT user_id, count(*) AS n, count(*) FILTER (WHERE event_type = 'click') AS clicks,
    count(*) FILTER (WHERE event_type = 'error') AS errors, CAST(sum(floor(value)) AS BIGINT) AS size,
    min(ts) AS first_ts, max(ts) AS last_ts, list_sort(list(DISTINCT event_type)) AS types,
    count(DISTINCT event_type) AS ntypes, arg_max(event_type, ts) AS last_type
  FROM events GROUP BY user_id)
SELECT 'r' || CAST(user_id AS VARCHAR) AS repo_name, 'u' || CAST(user_id AS VARCHAR) AS full_name,
  types[1] AS language, n AS stars, CAST(CASE WHEN user_id % 4 = 1 THEN 0 ELSE clicks END AS BIGINT) AS forks,
  n AS watchers, errors AS open_issues, size,
  date_trunc('second', first_ts) AS created_at, date_trunc('second', last_ts) AS updated_at,
  CAST(CASE WHEN user_id % 7 = 3 OR user_id % 23 = 11 THEN 0 WHEN user_id % 23 = 8 THEN 3 ELSE ntypes END AS BIGINT)
    AS contributors_count,
  CAST(CASE WHEN user_id % 11 = 4 OR user_id % 19 IN (7, 13) THEN 0 ELSE ntypes END AS BIGINT) AS releases_count,
  CASE WHEN user_id % 11 = 4 OR user_id % 19 IN (7, 13) THEN NULL ELSE last_type END AS latest_release_tag,
  CASE WHEN user_id % 11 = 4 OR user_id % 19 IN (7, 13) THEN NULL ELSE last_ts END AS latest_release_published_at,
  CASE WHEN user_id % 6 = 5 THEN '[]' ELSE CAST(to_json(types) AS VARCHAR) END AS topics,
  CASE WHEN user_id % 3 = 0 THEN 'MIT' END AS license
FROM u
WHERE user_id % 13 <> 5 AND user_id % 17 NOT IN (3, 6, 9, 12) AND user_id % 29 <> 5
  AND NOT (user_id % 23 = 4 AND user_id % 7 <> 3) AND NOT (user_id % 19 = 11 AND user_id % 11 <> 4)""",

    "flatten_package": """WITH c AS (
  SELECT o_custkey, count(*) AS n, max(o_orderpriority) AS pri,
    first(o_orderstatus ORDER BY o_orderdate DESC, o_orderkey DESC) AS latest_status,
    CAST(sum(floor(o_totalprice / 1000)) AS BIGINT) AS week, CAST(sum(floor(o_totalprice)) AS BIGINT) AS month,
    count(DISTINCT o_orderstatus) AS nver
  FROM orders GROUP BY o_custkey),
st AS (
  SELECT o_custkey, o_orderstatus, max(o_orderdate) AS last, count(*) AS cnt FROM orders GROUP BY 1, 2),
v AS (
  SELECT c.*, CASE WHEN o_custkey % 9 = 2 THEN 'X' ELSE latest_status END AS version FROM c)
SELECT 'p' || CAST(v.o_custkey AS VARCHAR) AS package_name, v.version, v.pri AS summary,
  CAST(v.nver AS BIGINT) AS release_count,
  CASE WHEN v.o_custkey % 9 = 5 THEN NULL ELSE st.last END AS upload_time,
  CASE WHEN v.o_custkey % 9 = 5 OR st.o_orderstatus IS NULL THEN NULL ELSE 'py3' END AS python_version,
  CASE WHEN v.o_custkey % 9 = 5 THEN NULL ELSE st.cnt END AS file_size,
  CASE WHEN v.o_custkey % 9 = 5 OR st.o_orderstatus IS NULL THEN NULL ELSE 'pkg-' || st.o_orderstatus || '.whl' END
    AS filename,
  CASE WHEN v.o_custkey % 8 IN (1, 3) THEN NULL ELSE v.n END AS downloads_last_day,
  CAST(CASE WHEN v.o_custkey % 8 IN (1, 3) THEN NULL WHEN v.o_custkey % 8 = 6 THEN 0 ELSE v.week END AS BIGINT)
    AS downloads_last_week,
  CASE WHEN v.o_custkey % 8 IN (1, 3) THEN NULL ELSE v.month END AS downloads_last_month,
  CASE WHEN v.o_custkey % 5 = 0 THEN '[]' ELSE '["' || v.pri || '"]' END AS classifiers
FROM v LEFT JOIN st ON st.o_custkey = v.o_custkey AND st.o_orderstatus = v.version
WHERE v.o_custkey % 13 <> 7 AND v.o_custkey % 17 NOT IN (3, 5, 8, 11, 13)
  AND NOT (v.o_custkey % 19 IN (4, 9, 12) AND v.o_custkey % 8 NOT IN (1, 3))""",

    "land_counts": """
SELECT count(*) AS fetched,
  count(*) FILTER (WHERE event_id % 17 <> 0 AND event_id % 19 <> 0 AND event_id % 23 <> 0 AND event_id % 29 <> 0
                   AND event_id % 43 <> 0) AS loaded,
  count(*) FILTER (WHERE event_id % 17 = 0 OR event_id % 19 = 0 OR event_id % 23 = 0 OR event_id % 29 = 0
                   OR event_id % 43 = 0) AS rejected
FROM events""",

    "land_rejected": f"""
WITH d AS (SELECT 'R' || CAST(user_id AS VARCHAR) AS repo_name, CASE WHEN event_id % 17 = 0 THEN 'not JSON'
    WHEN event_id % 19 = 0 THEN 'empty object' WHEN event_id % 23 = 0 THEN 'no document' WHEN event_id % 29 = 0 THEN 'not an object'
    WHEN event_id % 43 = 0 THEN 'empty object' END AS reason, CASE WHEN event_id % 17 = 0 THEN NULL WHEN event_id % 19 = 0 THEN '{{ }}'
    WHEN event_id % 23 = 0 THEN NULL WHEN event_id % 29 = 0 THEN '[1, 2]' ELSE '{{}}' || chr(10) || chr(10) END AS document FROM events),
c AS (SELECT count(*) AS fetched, count(*) FILTER (WHERE reason IS NULL) AS loaded FROM d)
SELECT {_NOW} AS extracted_at, repo_name, reason, document, loaded AS loaded_rows, fetched, loaded FROM d, c WHERE reason IS NOT NULL""",

    "fresh_counts": f"""
SELECT 'github_repos' AS source, count(*) AS n_rows FROM events
  WHERE ts >= TIMESTAMP '{FRESH_DAY} 00:00:00' AND ts < TIMESTAMP '{FRESH_DAY + dt.timedelta(days=1)} 00:00:00'
UNION ALL
SELECT 'pypi_packages' AS source, count(*) AS n_rows FROM orders
  WHERE o_orderdate >= TIMESTAMP '{FRESH_DAY} 00:00:00'
    AND o_orderdate < TIMESTAMP '{FRESH_DAY + dt.timedelta(days=1)} 00:00:00'""",

    "latest_repo": f"""WITH {STG_REPOS}
SELECT repo_name, extracted_at, full_name, stars, forks, contributors_count FROM stg_repos
QUALIFY row_number() OVER (PARTITION BY repo_name ORDER BY extracted_at DESC NULLS FIRST, full_name DESC NULLS FIRST) = 1""",

    "latest_package": f"""WITH {STG_PACKAGES}
SELECT package_name, extracted_at, version, downloads_last_day, downloads_last_month FROM stg_packages
QUALIFY row_number() OVER (PARTITION BY package_name ORDER BY extracted_at DESC NULLS FIRST, version DESC NULLS FIRST) = 1""",

    "dimension": DIM + "\nSELECT * FROM dim",

    "metrics": DIM + ",\n" + METRICS_SELECT + "\nSELECT * FROM met",

    "ratios": """WITH s AS (
  SELECT l_suppkey, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS stars,
    count(*) FILTER (WHERE l_returnflag = 'R') AS forks,
    count(*) FILTER (WHERE l_linestatus = 'O') AS contributors,
    count(*) FILTER (WHERE l_discount = 0) AS zero_disc
  FROM lineitem GROUP BY l_suppkey)
SELECT l_suppkey,
  CASE WHEN stars > 0 THEN CAST(forks AS DOUBLE) / stars ELSE 0.0 END AS fork_to_star_ratio,
  CASE WHEN contributors > 0 THEN CAST(stars AS DOUBLE) / contributors ELSE 0.0 END AS stars_per_contributor,
  CASE WHEN zero_disc > 0 THEN round(CAST(forks AS DOUBLE) / zero_disc, 6) ELSE 0.0 END AS guarded_ratio
FROM s""",

    "tiers": """WITH s AS (
  SELECT l_suppkey, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS stars FROM lineitem GROUP BY l_suppkey)
SELECT l_suppkey,
  CASE WHEN stars * 20 >= 30000 THEN 'Very Popular' WHEN stars * 20 >= 15000 THEN 'Popular'
       WHEN stars * 20 >= 5000 THEN 'Moderate' ELSE 'Emerging' END AS popularity_tier,
  CASE WHEN stars * 1000 >= 10000000 THEN 'High Usage' WHEN stars * 1000 >= 1000000 THEN 'Medium Usage'
       WHEN stars * 1000 >= 100000 THEN 'Low Usage' ELSE 'Minimal Usage' END AS usage_tier
FROM s""",

    "moving_avg": f"""WITH {SNAP}
SELECT technology_name, snapshot_date,
  avg(github_stars) OVER ({W_ENT} ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS stars_7day_avg,
  avg(pypi_downloads_daily) OVER ({W_ENT} ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS downloads_7day_avg,
  avg(github_stars) OVER ({W_ENT} ROWS BETWEEN 29 PRECEDING AND CURRENT ROW) AS stars_30day_avg
FROM snap""",

    "lag_growth": f"""WITH {SNAP},
l AS (
  SELECT technology_name, snapshot_date, github_stars, pypi_downloads_daily,
    lag(github_stars, 7) OVER ({W_ENT}) AS stars_7days_ago,
    lag(github_stars, 30) OVER ({W_ENT}) AS stars_30days_ago,
    lag(pypi_downloads_daily, 7) OVER ({W_ENT}) AS downloads_7days_ago
  FROM snap)
SELECT technology_name, snapshot_date, stars_7days_ago, stars_30days_ago, downloads_7days_ago,
  CASE WHEN stars_7days_ago > 0 THEN (CAST(github_stars - stars_7days_ago AS DOUBLE) / stars_7days_ago) * 100 ELSE 0.0 END
    AS stars_7day_growth_pct,
  CASE WHEN stars_30days_ago > 0 THEN (CAST(github_stars - stars_30days_ago AS DOUBLE) / stars_30days_ago) * 100 ELSE 0.0 END
    AS stars_30day_growth_pct,
  CASE WHEN downloads_7days_ago > 0
       THEN (CAST(pypi_downloads_daily - downloads_7days_ago AS DOUBLE) / downloads_7days_ago) * 100 ELSE 0.0 END
    AS downloads_7day_growth_pct
FROM l""",

    "daily_rank": f"""WITH {SNAP}
SELECT technology_name, snapshot_date, github_stars,
  CAST(rank() OVER (PARTITION BY snapshot_date ORDER BY github_stars DESC NULLS FIRST) AS BIGINT) AS daily_popularity_rank
FROM snap""",

    "trend_indicators": f"""WITH {SNAP},
a AS (
  SELECT technology_name, snapshot_date, github_stars, pypi_downloads_daily,
    avg(github_stars) OVER ({W_ENT} ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS sa,
    avg(pypi_downloads_daily) OVER ({W_ENT} ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS da
  FROM snap)
SELECT technology_name, snapshot_date,
  CASE WHEN github_stars > sa THEN 'Above Average' WHEN github_stars < sa THEN 'Below Average' ELSE 'Average' END
    AS stars_trend_indicator,
  CASE WHEN pypi_downloads_daily > da THEN 'Above Average' WHEN pypi_downloads_daily < da THEN 'Below Average'
       ELSE 'Average' END AS downloads_trend_indicator
FROM a""",

    "trends": f"WITH {SNAP},\n" + _trends_sql("snap", _CUT),

    "trends_single": DIM + ",\n" + METRICS_SELECT + ",\n" + _trends_sql("met", _DAILY_CUT),

    "history_first": f"WITH {SNAP_METRICS}\nSELECT {HIST_CARRIED},\n    {ZERO_DELTAS}\nFROM sm WHERE rn = 1",

    "history_step": f"WITH {SNAP_METRICS}\n" + _step_rows(),

    "history_rerun": f"WITH {SNAP_METRICS}\nSELECT {HIST_CARRIED},\n    {ZERO_DELTAS}\nFROM sm WHERE rn = 1",

    "history_upsert": f"""WITH {SNAP_METRICS}
SELECT {HIST_CARRIED},
    {ZERO_DELTAS}
FROM sm WHERE rn > 1
UNION ALL
""" + _step_rows(),

    "history_replay": f"""WITH {SNAP}
SELECT technology_name, snapshot_date, github_stars,
  CASE WHEN snapshot_date = (SELECT min(snapshot_date) FROM snap) THEN 0
       ELSE github_stars - coalesce(lag(github_stars) OVER ({W_ENT}), 0) END AS stars_change,
  CASE WHEN snapshot_date = (SELECT min(snapshot_date) FROM snap) THEN 0
       ELSE github_forks - coalesce(lag(github_forks) OVER ({W_ENT}), 0) END AS forks_change,
  CASE WHEN snapshot_date = (SELECT min(snapshot_date) FROM snap) THEN 0
       ELSE pypi_downloads_daily - coalesce(lag(pypi_downloads_daily) OVER ({W_ENT}), 0) END AS downloads_change,
  CASE WHEN snapshot_date = (SELECT min(snapshot_date) FROM snap) THEN 0
       ELSE open_issues - coalesce(lag(open_issues) OVER ({W_ENT}), 0) END AS issues_change
FROM snap""",

    "schema_sync": f"""WITH {SNAP_METRICS}
SELECT {HIST_CARRIED},
    CAST(0 AS BIGINT) AS stars_change, CAST(0 AS BIGINT) AS forks_change, CAST(0 AS BIGINT) AS downloads_change,
    CAST(NULL AS BIGINT) AS issues_change, {_NOW} AS history_created_at
FROM sm WHERE rn > 1
UNION ALL
""" + _step_rows(),

    "check_not_null": f"""WITH {STG_REPOS}
SELECT repo_name, extracted_at, full_name FROM stg_repos WHERE description IS NULL""",

    "check_unique": f"""WITH {STG_PACKAGES}
SELECT package_name, count(*) AS n_records FROM stg_packages
WHERE package_name IS NOT NULL GROUP BY package_name HAVING count(*) > 1""",

    "check_accepted": DIM + ",\n" + METRICS_SELECT + """
SELECT popularity_tier, count(*) AS n_records FROM (
  SELECT CASE WHEN github_stars >= 45000 THEN 'Legendary' ELSE popularity_tier END AS popularity_tier FROM met) x
WHERE popularity_tier IS NOT NULL
  AND popularity_tier NOT IN ('Very Popular', 'Popular', 'Moderate', 'Emerging')
GROUP BY popularity_tier""",
}

ORACLE_SQL["daily_rank_window"] = ORACLE_SQL["daily_rank"]
ORACLE_SQL["trends_update"] = ORACLE_SQL["trends"]
ORACLE_SQL["stream_latest_repo"] = ORACLE_SQL["latest_repo"]
ORACLE_SQL["history_step_latest"] = ORACLE_SQL["history_step"]


def _nn(model: str, rel: str, col: str) -> str:
    return (f"SELECT '{model}' AS model, 'not_null' AS \"check\", '{col}' AS \"column\", "
            f"count(*) FILTER (WHERE {col} IS NULL) AS failures FROM {rel}")


ORACLE_SQL["check_suite"] = DIM + ",\n" + METRICS_SELECT + ",\n" + SNAP_METRICS + f""",
tr AS (WITH {_trends_sql("snap", _CUT)})
{_nn("stg_github_repos", "stg_repos", "repo_name")}
UNION ALL {_nn("stg_github_repos", "stg_repos", "stars")}
UNION ALL {_nn("stg_github_repos", "stg_repos", "forks")}
UNION ALL {_nn("stg_pypi_packages", "stg_packages", "package_name")}
UNION ALL {_nn("stg_pypi_packages", "stg_packages", "downloads_last_month")}
UNION ALL {_nn("dim_technologies", "dim", "technology_name")}
UNION ALL SELECT 'dim_technologies', 'unique', 'technology_name', count(*) FROM (
  SELECT technology_name FROM dim WHERE technology_name IS NOT NULL GROUP BY 1 HAVING count(*) > 1) u
UNION ALL {_nn("fct_technology_metrics", "met", "technology_name")}
UNION ALL SELECT 'fct_technology_metrics', 'accepted_values', 'popularity_tier', count(*) FROM (
  SELECT popularity_tier FROM met WHERE popularity_tier IS NOT NULL
    AND popularity_tier NOT IN ('Very Popular', 'Popular', 'Moderate', 'Emerging') GROUP BY 1) a
UNION ALL SELECT 'fct_technology_metrics', 'accepted_values', 'usage_tier', count(*) FROM (
  SELECT usage_tier FROM met WHERE usage_tier IS NOT NULL
    AND usage_tier NOT IN ('High Usage', 'Medium Usage', 'Low Usage', 'Minimal Usage') GROUP BY 1) b
UNION ALL {_nn("fct_technology_history", "(SELECT * FROM sm WHERE rn = 1)", "technology_name")}
UNION ALL {_nn("fct_technology_history", "(SELECT * FROM sm WHERE rn = 1)", "snapshot_date")}
UNION ALL {_nn("fct_technology_trends", "tr", "technology_name")}
UNION ALL {_nn("stg_github_repos", "stg_repos", "description")}
UNION ALL {_nn("fct_technology_metrics", "met", "snapshot_date")}
UNION ALL SELECT 'stg_pypi_packages', 'unique', 'package_name', count(*) FROM (
  SELECT package_name FROM stg_packages WHERE package_name IS NOT NULL GROUP BY 1 HAVING count(*) > 1) p"""

ORACLE_SQL["daily_trends"] = _daily_dim() + ",\n" + METRICS_SELECT + ",\n" + _trends_sql("met", _DAILY_CUT)
ORACLE_SQL["daily_rank_buckets"] = ORACLE_SQL["daily_rank"]
ORACLE_SQL["trends_look_back"] = ORACLE_SQL["trends"]


def _ts(t: dt.datetime) -> str:
    return f"TIMESTAMP '{t:%Y-%m-%d %H:%M:%S}'"


def _run_ctes(last: int) -> str:
    """Staging to metrics over what has landed by the given run (0: the first)."""
    loaded = f"CASE WHEN o_orderdate < TIMESTAMP '{ORDER_CUT}' THEN {_ts(RUNS[0][1])} ELSE {_ts(RUNS[1][1])} END"
    repos, orders = STG_REPOS, f"stg_packages AS (\n  SELECT {loaded} AS extracted_at, {PKG_COLS}\n  FROM orders"
    if last == 0:
        repos = repos.replace("FROM events)", f"FROM events WHERE ts < TIMESTAMP '{REPO_CUT}')")
        orders += f" WHERE o_orderdate < TIMESTAMP '{ORDER_CUT}'"
    return f"{repos},\n{orders}),\n{MAPPING},\n{LATEST},\n{DIM_SELECT}".replace(_NOW, _ts(RUNS[2][2])) + ",\n" + METRICS_SELECT


def _changes(now: dt.datetime, previous: str | None) -> str:
    """New history rows of ``met`` against ``previous``."""
    carried = ", ".join(f"c.{c.strip()}" for c in HIST_CARRIED.split(","))
    names = {"stars_change": "github_stars", "forks_change": "github_forks", "downloads_change": "pypi_downloads_daily",
             "issues_change": "open_issues"}
    deltas = ", ".join((f"c.{m} - coalesce(p.{m}, 0)" if previous else "CAST(0 AS BIGINT)") + f" AS {d}" for d, m in names.items())
    join = f" LEFT JOIN {previous} p ON c.technology_name = p.technology_name" if previous else ""
    return f"SELECT {carried}, {deltas}, {_ts(now)} AS history_created_at FROM {{src}} c{join}"


def _merged(old: str, new: str) -> str:
    return (f"SELECT * FROM {old} o WHERE NOT EXISTS (SELECT 1 FROM {new} n WHERE n.snapshot_date = o.snapshot_date "
            f"AND n.technology_name = o.technology_name) UNION ALL SELECT * FROM {new}")


ORACLE_SQL["daily_run"] = f"""WITH met1 AS (WITH {_run_ctes(0)} SELECT * FROM met),
met2 AS (WITH {_run_ctes(1)} SELECT * FROM met),
h1 AS ({_changes(RUNS[0][2], None).format(src="met1")}),
r2 AS ({_changes(RUNS[1][2], "h1").format(src="met2")}),
h2 AS ({_merged("h1", "r2")}),
p3 AS (SELECT * FROM h2 QUALIFY row_number() OVER (PARTITION BY technology_name
       ORDER BY snapshot_date DESC NULLS FIRST, history_created_at DESC) = 1),
r3 AS ({_changes(RUNS[2][2], "p3").format(src="met2")})
{_merged("h2", "r3")}"""
ORACLE_SQL["daily_run_full"] = ORACLE_SQL["daily_run"]
ORACLE_SQL["daily_run_dimension"] = f"WITH {_run_ctes(1)} SELECT * FROM dim"

_SM = [c.strip() for c in HIST_CARRIED.split(",")]
_MORE = ", ".join({"github_stars": "github_stars + 5 AS github_stars",
                   "pypi_downloads_daily": "pypi_downloads_daily + 1 AS pypi_downloads_daily"}.get(c, c) for c in _SM)
_NEWEST = "QUALIFY row_number() OVER (PARTITION BY technology_name ORDER BY snapshot_date DESC) = 1"
ORACLE_SQL["history_three_days"] = f"""WITH {SNAP_METRICS},
one AS (SELECT * FROM sm WHERE snapshot_date < DATE '{HISTORY_CUTS[0]}'),
two AS (SELECT * FROM sm WHERE snapshot_date >= DATE '{HISTORY_CUTS[0]}' AND snapshot_date < DATE '{HISTORY_CUTS[1]}'),
again AS (SELECT {_MORE} FROM two), three AS (SELECT * FROM sm WHERE snapshot_date >= DATE '{HISTORY_CUTS[1]}'),
before_again AS (SELECT {HIST_CARRIED} FROM two {_NEWEST}),
before_three AS (SELECT * FROM (SELECT {HIST_CARRIED} FROM one UNION ALL SELECT {HIST_CARRIED} FROM again) {_NEWEST})
SELECT {HIST_CARRIED}, {ZERO_DELTAS} FROM one
UNION ALL
{_changes(NOW, "before_again").format(src="again")}
UNION ALL
{_changes(NOW, "before_three").format(src="three")}"""

ORACLE_SQL["example_mapping"] = "WITH m AS (SELECT * FROM (VALUES " + ", ".join(
    f"({i}, '{a}', '{b}', '{c}')" for i, (a, b, c) in enumerate(EXAMPLE_MAPPING)) + f""") t(k, technology_name, github_repo, pypi_package)),
n AS (SELECT o_orderkey % {len(EXAMPLE_MAPPING)} AS k, count(*) AS c FROM orders GROUP BY 1)
SELECT technology_name, github_repo, pypi_package, c AS repo_orders, c AS package_orders FROM m LEFT JOIN n USING (k)"""
