"""Two-source dimension (M1): latest of each side, mapped, left-joined."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snapflow.functions.scalars import build_time, greatest_strict
from snapflow.operators.joins import semi_reduce, small_enough
from snapflow.operators.latest import latest_per_key, total_tiebreak

DIMENSION_COLUMNS = [
    "technology_name", "github_repo", "pypi_package", "stars", "forks", "watchers", "open_issues",
    "contributors_count", "releases_count", "language", "license", "github_created_at", "github_updated_at",
    "latest_release_tag", "latest_release_published_at", "topics", "current_version", "downloads_last_day",
    "downloads_last_week", "downloads_last_month", "pypi_release_count", "requires_python", "author",
    "summary", "home_page", "latest_release_upload_time", "last_updated_at", "mart_created_at",
]
# Staged columns that the dimension reads.
REPO_INPUTS = ["extracted_at", "repo_name", "stars", "forks", "watchers", "open_issues", "contributors_count", "releases_count",
               "language", "license", "created_at", "updated_at", "latest_release_tag", "latest_release_published_at", "topics"]
PACKAGE_INPUTS = ["extracted_at", "package_name", "version", "downloads_last_day", "downloads_last_week", "downloads_last_month",
                  "release_count", "requires_python", "author", "summary", "home_page", "latest_release_upload_time"]


def _key_match(left: Column, right: Column) -> Column:
    """``left = right`` for a left join, written so it implies no ``isnotnull(right)``.

    Same matches as plain equality (a NULL mapping key matches nothing), but Catalyst
    infers no not-null filter on the right side, which it would otherwise push through
    the latest-row window into the scan and so parse every document a second time.
    """
    return left.isNotNull() & left.eqNullSafe(right)


def build_dimension(mapping: DataFrame, repos: DataFrame, packages: DataFrame, now=None,
                    repo_tiebreak: Sequence[str] | None = None, package_tiebreak: Sequence[str] | None = None,
                    reduce_max_keys: int = 200_000, one_per_key: bool = False) -> DataFrame:
    """One row per mapping row (28 columns).

    ``mapping``: ``(technology_name, github_repo, pypi_package)``; ``repos`` / ``packages``:
    staged rows, many per key. Tie-breaks default to every atomic column (deterministic).
    Only the repo/package keys named by the mapping can reach the output, so the staged rows
    are semi-joined with its keys before the latest-row window (fewer rows sorted), against
    a broadcast, below the shuffle, when the mapping is provably small. With a larger one no
    semi-join runs: it would shuffle and sort every staged row, of which the window sends on one
    a key and task, and the left joins drop the keys that the mapping lacks. ``one_per_key``: the
    staged rows are the latest ones already (``streaming.latest``), so no window runs.
    """
    gh, py = repos, packages
    if reduce_max_keys and small_enough(mapping, reduce_max_keys):             # one bounded probe
        gh = semi_reduce(repos, "repo_name", mapping, "github_repo", reduce_max_keys, known_small=True)
        py = semi_reduce(packages, "package_name", mapping, "pypi_package", reduce_max_keys, known_small=True)
    if not one_per_key:
        if repo_tiebreak is None:
            repo_tiebreak = total_tiebreak(gh, ["repo_name", "extracted_at"])
        if package_tiebreak is None:
            package_tiebreak = total_tiebreak(py, ["package_name", "extracted_at"])
        gh = latest_per_key(gh, "repo_name", "extracted_at", repo_tiebreak)
        py = latest_per_key(py, "package_name", "extracted_at", package_tiebreak)
    gh, py = gh.alias("gh"), py.alias("py")
    tm = mapping.select("technology_name", "github_repo", "pypi_package").alias("tm")
    j = (tm.join(gh, _key_match(F.col("tm.github_repo"), F.col("gh.repo_name")), "left")
           .join(py, _key_match(F.col("tm.pypi_package"), F.col("py.package_name")), "left"))
    built = build_time(now)
    return j.select(
        F.col("tm.technology_name").alias("technology_name"),
        F.col("tm.github_repo").alias("github_repo"),
        F.col("tm.pypi_package").alias("pypi_package"),
        F.col("gh.stars").alias("stars"),
        F.col("gh.forks").alias("forks"),
        F.col("gh.watchers").alias("watchers"),
        F.col("gh.open_issues").alias("open_issues"),
        F.col("gh.contributors_count").alias("contributors_count"),
        F.col("gh.releases_count").alias("releases_count"),
        F.col("gh.language").alias("language"),
        F.col("gh.license").alias("license"),
        F.col("gh.created_at").alias("github_created_at"),
        F.col("gh.updated_at").alias("github_updated_at"),
        F.col("gh.latest_release_tag").alias("latest_release_tag"),
        F.col("gh.latest_release_published_at").alias("latest_release_published_at"),
        F.col("gh.topics").alias("topics"),
        F.col("py.version").alias("current_version"),
        F.col("py.downloads_last_day").alias("downloads_last_day"),
        F.col("py.downloads_last_week").alias("downloads_last_week"),
        F.col("py.downloads_last_month").alias("downloads_last_month"),
        F.col("py.release_count").alias("pypi_release_count"),
        F.col("py.requires_python").alias("requires_python"),
        F.col("py.author").alias("author"),
        F.col("py.summary").alias("summary"),
        F.col("py.home_page").alias("home_page"),
        F.col("py.latest_release_upload_time").alias("latest_release_upload_time"),
        greatest_strict(F.col("gh.extracted_at"), F.col("py.extracted_at")).alias("last_updated_at"),
        built.alias("mart_created_at"),
    )
