import datetime as dt

from pyspark.sql import functions as F

from snapflow.operators.dimension import DIMENSION_COLUMNS, build_dimension
from snapflow.operators.latest import latest_per_key
from snapflow.operators.metrics import METRICS_COLUMNS, build_metrics
from tests.conftest import plan_text, rows

T = dt.datetime


def test_latest_null_time_wins_and_ties_are_broken(spark):
    df = spark.createDataFrame([
        ("a", T(2024, 1, 1), "x1"), ("a", T(2024, 1, 2), "x2"), ("a", None, "x0"),
        ("b", T(2024, 1, 5), "y1"), ("b", T(2024, 1, 5), "y2"),
    ], "k string, ts timestamp_ntz, v string")
    got = rows(latest_per_key(df, "k", "ts", ["v"]), "k", "v")
    assert got == [("a", "x0"), ("b", "y2")]
    got = rows(latest_per_key(df, "k", "ts", ["v"], nulls_first=False), "k", "v")
    assert got == [("a", "x2"), ("b", "y2")]


def test_latest_plans_partial_group_limit(spark):
    df = spark.range(1000).select((F.col("id") % 7).alias("k"), F.col("id").alias("ts"))
    lines = plan_text(latest_per_key(df, "k", "ts")).splitlines()
    exchange = next(i for i, l in enumerate(lines) if "Exchange hashpartitioning(k" in l)
    partial = next(i for i, l in enumerate(lines) if "WindowGroupLimit" in l and "Partial" in l)
    final = next(i for i, l in enumerate(lines) if "WindowGroupLimit" in l and "Final" in l)
    assert final < exchange < partial          # partial top-1 runs in the map tasks, below the shuffle


def _repos(spark):
    return spark.createDataFrame([
        (T(2024, 1, 1), "r1", 10, 2, 5), (T(2024, 1, 3), "r1", 30000, 9000, 10),
        (T(2024, 1, 2), "r2", 5000, 0, 0), (T(2024, 1, 2), "rX", 1, 1, 1),
    ], "extracted_at timestamp_ntz, repo_name string, stars bigint, forks bigint, contributors_count bigint")


def _packages(spark):
    return spark.createDataFrame([
        (T(2024, 1, 4), "p1", "1.0", 1, 7, 100000), (T(2024, 1, 5), "p1", "1.1", 0, 0, 99999),
        (T(2024, 1, 1), "p3", "3.0", 2, 20, 10000000),
    ], "extracted_at timestamp_ntz, package_name string, version string, downloads_last_day bigint, "
       "downloads_last_week bigint, downloads_last_month bigint")


def _full(df, cols):
    for c in cols:
        if c not in df.columns:
            df = df.withColumn(c, F.lit(None).cast("string"))
    return df


def _mapping(spark):
    return spark.createDataFrame([
        ("both", "r1", "p1"), ("left", "r2", None), ("right", None, "p3"), ("neither", None, None),
        ("unmatched", "zz", "zz"),
    ], "technology_name string, github_repo string, pypi_package string")


REPO_EXTRA = ["watchers", "open_issues", "releases_count", "language", "license", "created_at", "updated_at",
              "latest_release_tag", "latest_release_published_at", "topics"]
PKG_EXTRA = ["release_count", "requires_python", "author", "summary", "home_page", "latest_release_upload_time"]


def test_dimension_left_joins_and_strict_greatest(spark):
    for max_keys in (0, 1000):          # without and with the broadcast semi-join reduction
        dim = build_dimension(_mapping(spark), _full(_repos(spark), REPO_EXTRA), _full(_packages(spark), PKG_EXTRA),
                              now=T(2024, 2, 1), reduce_max_keys=max_keys)
        assert dim.columns == DIMENSION_COLUMNS
        got = {r.technology_name: r for r in dim.collect()}
        assert len(got) == 5
        assert got["both"].stars == 30000 and got["both"].current_version == "1.1"
        assert got["both"].last_updated_at == T(2024, 1, 5)
        assert got["left"].stars == 5000 and got["left"].downloads_last_month is None
        assert got["left"].last_updated_at is None          # one side missing -> NULL (strict greatest)
        assert got["right"].stars is None and got["right"].downloads_last_month == 10000000
        assert got["neither"].stars is None and got["unmatched"].stars is None
        assert got["both"].mart_created_at == T(2024, 2, 1)


def test_dimension_of_a_large_mapping_shuffles_no_staged_row_for_it(spark):
    """A mapping beyond ``reduce_max_keys``: no semi-join of all staged rows below the window, the same rows come out."""
    args = _mapping(spark), _full(_repos(spark), REPO_EXTRA), _full(_packages(spark), PKG_EXTRA)
    large, small = (build_dimension(*args, now=T(2024, 2, 1), reduce_max_keys=n) for n in (1, 1000))
    assert "LeftSemi" not in plan_text(large) and "LeftSemi" in plan_text(small)
    assert rows(large) == rows(small)


def test_metrics_ratios_tiers_and_filter(spark):
    dim = build_dimension(_mapping(spark), _full(_repos(spark), REPO_EXTRA), _full(_packages(spark), PKG_EXTRA),
                          now=T(2024, 2, 1))
    met = build_metrics(dim)
    assert met.columns == METRICS_COLUMNS
    got = {r.technology_name: r for r in met.collect()}
    assert "neither" not in got and len(got) == 4
    b = got["both"]
    assert (b.popularity_tier, b.usage_tier) == ("Very Popular", "Minimal Usage")
    assert b.fork_to_star_ratio == 9000 / 30000 and b.stars_per_contributor == 3000.0
    assert b.weekly_to_daily_ratio == 0.0 and b.monthly_to_weekly_ratio == 0.0   # zero denominators
    assert b.snapshot_date == dt.date(2024, 1, 5)
    assert got["left"].popularity_tier == "Moderate" and got["left"].fork_to_star_ratio == 0.0
    assert got["left"].snapshot_date is None
    r = got["right"]
    assert (r.popularity_tier, r.usage_tier, r.weekly_to_daily_ratio) == ("Emerging", "High Usage", 10.0)
