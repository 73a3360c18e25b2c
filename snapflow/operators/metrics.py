"""Snapshot metrics (M2): ratios, tiers and the snapshot date."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapflow.functions.scalars import any_not_null, safe_ratio, tier

# Inclusive lower bounds of the popularity (stars) and usage (monthly downloads) tiers.
POPULARITY_TIERS = [(30000, "Very Popular"), (15000, "Popular"), (5000, "Moderate")]
POPULARITY_DEFAULT = "Emerging"
USAGE_TIERS = [(10000000, "High Usage"), (1000000, "Medium Usage"), (100000, "Low Usage")]
USAGE_DEFAULT = "Minimal Usage"

METRICS_COLUMNS = [
    "technology_name", "github_repo", "pypi_package", "github_stars", "github_forks", "github_watchers",
    "pypi_downloads_daily", "pypi_downloads_weekly", "pypi_downloads_monthly", "open_issues",
    "contributors_count", "github_releases", "pypi_release_count", "weekly_to_daily_ratio",
    "monthly_to_weekly_ratio", "fork_to_star_ratio", "stars_per_contributor", "popularity_tier", "usage_tier",
    "github_created_at", "github_updated_at", "latest_release_published_at", "latest_release_upload_time",
    "last_updated_at", "snapshot_date",
]


def build_metrics(dim: DataFrame,
                  popularity: Sequence[tuple[float, str]] = POPULARITY_TIERS,
                  popularity_default: str = POPULARITY_DEFAULT,
                  usage: Sequence[tuple[float, str]] = USAGE_TIERS,
                  usage_default: str = USAGE_DEFAULT) -> DataFrame:
    """One row per dimension row that has at least one source key (25 columns)."""
    d = dim.where(any_not_null("github_repo", "pypi_package"))
    return d.select(
        "technology_name", "github_repo", "pypi_package",
        F.col("stars").alias("github_stars"),
        F.col("forks").alias("github_forks"),
        F.col("watchers").alias("github_watchers"),
        F.col("downloads_last_day").alias("pypi_downloads_daily"),
        F.col("downloads_last_week").alias("pypi_downloads_weekly"),
        F.col("downloads_last_month").alias("pypi_downloads_monthly"),
        "open_issues", "contributors_count",
        F.col("releases_count").alias("github_releases"),
        "pypi_release_count",
        # whole-number divisions (6 decimal places); the two below divide after a float cast
        safe_ratio("downloads_last_week", "downloads_last_day", scale=6).alias("weekly_to_daily_ratio"),
        safe_ratio("downloads_last_month", "downloads_last_week", scale=6).alias("monthly_to_weekly_ratio"),
        safe_ratio("forks", "stars").alias("fork_to_star_ratio"),
        safe_ratio("stars", "contributors_count").alias("stars_per_contributor"),
        tier("stars", popularity, popularity_default).alias("popularity_tier"),
        tier("downloads_last_month", usage, usage_default).alias("usage_tier"),
        "github_created_at", "github_updated_at", "latest_release_published_at",
        "latest_release_upload_time", "last_updated_at",
        F.to_date("last_updated_at").alias("snapshot_date"),
    )
