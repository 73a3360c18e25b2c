"""Staging models (P6, P7): typed, defaulted, not deduplicated."""

from __future__ import annotations

from collections.abc import Collection

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapflow.functions.jsonpaths import coalesce_key, extract, fill_zero

# Field name -> (JSON path, type) of the repository document.
REPO_FIELDS = {
    "repo_name_parsed": ("repo_name", "string"),
    "full_name": ("full_name", "string"),
    "description": ("description", "string"),
    "language": ("language", "string"),
    "stars": ("stars", "bigint"),
    "forks": ("forks", "bigint"),
    "watchers": ("watchers", "bigint"),
    "open_issues": ("open_issues", "bigint"),
    "size": ("size", "bigint"),
    "created_at": ("created_at", "timestamp"),
    "updated_at": ("updated_at", "timestamp"),
    "pushed_at": ("pushed_at", "timestamp"),
    "default_branch": ("default_branch", "string"),
    "contributors_count": ("contributors_count", "bigint"),
    "releases_count": ("releases_count", "bigint"),
    "latest_release_tag": ("latest_release.tag_name", "string"),
    "latest_release_published_at": ("latest_release.published_at", "timestamp"),
    "topics": ("topics", "variant"),
    "license": ("license", "string"),
}
REPO_ZERO = ["stars", "forks", "watchers", "open_issues", "size", "contributors_count", "releases_count"]
REPO_COLUMNS = [
    "extracted_at", "repo_name", "full_name", "description", "language", "stars", "forks", "watchers",
    "open_issues", "size", "created_at", "updated_at", "pushed_at", "default_branch", "contributors_count",
    "releases_count", "latest_release_tag", "latest_release_published_at", "topics", "license",
]

# Field name -> (JSON path, type) of the package document.
PACKAGE_FIELDS = {
    "package_name_parsed": ("package_name", "string"),
    "version": ("version", "string"),
    "summary": ("summary", "string"),
    "description_content_type": ("description_content_type", "string"),
    "home_page": ("home_page", "string"),
    "author": ("author", "string"),
    "author_email": ("author_email", "string"),
    "maintainer": ("maintainer", "string"),
    "license": ("license", "string"),
    "keywords": ("keywords", "string"),
    "classifiers": ("classifiers", "variant"),
    "requires_dist": ("requires_dist", "variant"),
    "requires_python": ("requires_python", "string"),
    "project_urls": ("project_urls", "variant"),
    "release_count": ("release_count", "bigint"),
    "latest_release_upload_time": ("latest_release_info.upload_time", "timestamp"),
    "latest_python_version": ("latest_release_info.python_version", "string"),
    "latest_release_size": ("latest_release_info.size", "bigint"),
    "latest_filename": ("latest_release_info.filename", "string"),
    "downloads_last_day": ("downloads_last_day", "bigint"),
    "downloads_last_week": ("downloads_last_week", "bigint"),
    "downloads_last_month": ("downloads_last_month", "bigint"),
}
PACKAGE_ZERO = ["release_count", "latest_release_size", "downloads_last_day", "downloads_last_week",
                "downloads_last_month"]
PACKAGE_COLUMNS = [
    "extracted_at", "package_name", "version", "summary", "description_content_type", "home_page", "author",
    "author_email", "maintainer", "license", "keywords", "classifiers", "requires_dist", "requires_python",
    "project_urls", "release_count", "latest_release_upload_time", "latest_python_version",
    "latest_release_size", "latest_filename", "downloads_last_day", "downloads_last_week",
    "downloads_last_month",
]


def _stage(raw: DataFrame, key: str, fields: dict, zero: list[str], columns: list[str],
           doc_col: str, on_error: str, only: Collection[str] | None) -> DataFrame:
    if only is not None:
        unknown = set(only) - set(columns)
        if unknown:
            raise ValueError(f"no staged columns {sorted(unknown)}")
        columns = [c for c in columns if c in only]
        fields = {n: f for n, f in fields.items() if n in only or (n == f"{key}_parsed" and key in only)}
        zero = [c for c in zero if c in only]
    parsed = extract(raw, doc_col, fields, keep=["extracted_at", key], on_error=on_error, one_walk=only is not None)
    if f"{key}_parsed" in fields:
        parsed = parsed.withColumn(key, coalesce_key(f"{key}_parsed", key)).drop(f"{key}_parsed")
    return fill_zero(parsed, zero).select(*columns)


def stage_repos(raw: DataFrame, doc_col: str = "raw_data", on_error: str = "fail",
                only: Collection[str] | None = None) -> DataFrame:
    """Repository staging (20 columns) from ``(extracted_at, repo_name, raw_data)``. ``only`` names the columns that the
    caller reads, all of them if it likes: no others come out, and these are taken in one walk of a document."""
    return _stage(raw, "repo_name", REPO_FIELDS, REPO_ZERO, REPO_COLUMNS, doc_col, on_error, only)


def stage_packages(raw: DataFrame, doc_col: str = "raw_data", on_error: str = "fail",
                   only: Collection[str] | None = None) -> DataFrame:
    """Package staging (23 columns) from ``(extracted_at, package_name, raw_data)``; ``only`` as in ``stage_repos``."""
    return _stage(raw, "package_name", PACKAGE_FIELDS, PACKAGE_ZERO, PACKAGE_COLUMNS, doc_col, on_error, only)


def variant_to_json(df: DataFrame, cols: list[str]) -> DataFrame:
    """Render VARIANT columns as JSON text (VARIANT cannot be compared or grouped)."""
    return df.withColumns({c: F.to_json(F.col(c)) for c in cols})
