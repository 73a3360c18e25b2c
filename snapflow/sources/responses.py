"""Assemble one snapshot document per entity from landed API responses.

Input: ``(entity, endpoint, status, body)`` rows, one per fetched response. Output:
``(<key>, raw_data)`` with the document as JSON text, ready for ``land_raw``.

Plan: every response row is first digested *map-side* into a few small values (a
count, the first list element, an error flag, the document's fields of the main
response); the large API bodies never travel. One ``groupBy(entity)`` then combines
each entity's responses (partial aggregation before the shuffle), and the document is
built from the combined row.
One shuffle, no joins between endpoints, nothing collected. The input is one fetch run
(one response per entity and endpoint). Should an endpoint appear twice for an entity,
one whole response is taken: the newest by ``fetched_at`` if such a column is named, the
one with the greatest digest among equals.

Rules (what a fetcher would have produced):
- main and metadata responses fail at status 400 and above, the secondary ones at any
  status but 200; a failed main or metadata response, or none, drops the entity.
- a good response that a fetcher could not read drops the entity: a body that is not
  JSON, a main, metadata or statistics body that is not an object, a license, ``info`` or
  ``data`` of another kind than an object, ``releases`` without a length, a
  contributors or releases body without a length, a releases object that is not empty.
- repos: contributors not OK -> 0; releases not OK -> empty list; counts are lengths;
  ``latest_release`` is the first list element or null; ``license`` is ``license.name``
  when a license object is present; absent counts become 0 and absent ``topics`` an
  empty list, while an explicit JSON null stays null.
- packages: statistics not OK -> the three download fields are absent; present
  statistics missing a field -> 0; release count = number of versions; latest release
  file = first file listed under the current version, or ``{}`` when the version is
  missing or has no files.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snapflow.functions.scalars import ts_literal

# From which status a main or metadata response fails; the one good status of the others.
_FAILED, _OK = 400, 200
_JSON_KEEP_NULLS = {"ignoreNullFields": "false"}


def _vget(v: Column, path: str) -> Column:
    return F.variant_get(v, path, "variant")


def _default(v: Column, path: str, json_default: str) -> Column:
    """Field as VARIANT; an absent field gets ``json_default``, a JSON null stays null."""
    return F.coalesce(_vget(v, path), F.parse_json(F.lit(json_default)))


def _iso(loaded_at) -> Column:
    return F.date_format(ts_literal(loaded_at), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'")


def _digest(responses: DataFrame, entity: str, endpoint: str, status: str, body: str, primary: str,
            fetched_at: str | None) -> DataFrame:
    ep, st = F.col(endpoint), F.col(status)
    ok = F.coalesce(F.when(ep == primary, st < _FAILED).otherwise(st == _OK), F.lit(False))
    at = F.col(fetched_at).cast("timestamp") if fetched_at else F.lit(None).cast("timestamp")
    return responses.select(
        F.col(entity).cast("string").alias("__e"), ep.alias("__ep"), ok.alias("__ok"), at.alias("__at"),
        F.regexp_extract(F.col(body), r"^\s*(.)", 1).alias("__kind"), F.try_parse_json(F.col(body)).alias("__v"))


def _is_object(v: Column) -> Column:
    return F.try_variant_get(v, "$", "map<string,variant>").isNotNull()


def _truthy(v: Column) -> Column:
    """Whether a present value counts as true: not null, false, zero or empty."""
    return v.isNotNull() & ~F.to_json(v).isin("null", "false", "0", "0.0", '""', "[]", "{}")


def _one_each(d: DataFrame, payloads: dict[str, Column]) -> DataFrame:
    """One response per entity and endpoint: its digest as a column named like the endpoint (null: none).

    ``max`` over ``(fetched, digest)`` combines map-side and never mixes two responses.
    """
    return d.groupBy("__e").agg(*[
        F.max(F.when(F.col("__ep") == ep, F.struct(F.col("__at"), F.col("__ok").alias("ok"), p.alias("p")))).alias(ep)
        for ep, p in payloads.items()])


def _size(c: Column) -> Column:
    """Size of an array/map, NULL for NULL (independent of the ANSI/legacy size setting)."""
    return F.when(c.isNotNull(), F.size(c))


def _license_name(m: Column) -> Column:
    """``license.name`` when a (non-empty) license object is present, else null."""
    lic = _vget(m, "$.license")
    lic_set = lic.isNotNull() & ~F.is_variant_null(lic) & (F.to_json(lic) != "{}")
    return F.when(lic_set, _vget(m, "$.license.name"))


def _pick(m: Column, names) -> list[Column]:
    """Fields of a digest (every key present, nulls kept) in the given order."""
    return [_vget(m, f"$.{n}").alias(n) for n in names]


# Document fields taken from the main repository response (order = document order).
_REPO_MAIN = ["full_name", "description", "language", "stars", "forks", "watchers", "open_issues", "size",
              "created_at", "updated_at", "pushed_at", "default_branch"]


def flatten_repo(responses: DataFrame, loaded_at=None, entity: str = "entity", endpoint: str = "endpoint",
                 status: str = "status", body: str = "body", key: str = "repo_name",
                 fetched_at: str | None = None) -> DataFrame:
    d = _digest(responses, entity, endpoint, status, body, "main", fetched_at)
    v, kind = F.col("__v"), F.col("__kind")
    arr = F.try_variant_get(v, "$", "array<variant>")
    obj = F.try_variant_get(v, "$", "map<string,variant>")
    text = F.when(v.isNotNull() & (kind == '"'), F.try_variant_get(v, "$", "string"))   # text has a length, too
    n_contrib = F.coalesce(_size(arr), _size(obj), F.length(text))
    n_rel = F.coalesce(_size(arr), F.when(_size(obj) == 0, F.lit(0)), F.length(text))   # a non-empty object fails
    first_rel = F.coalesce(F.to_json(F.variant_get(v, "$[0]", "variant")),
                           F.when(F.length(text) > 0, F.regexp_extract(F.to_json(F.array(F.left(text, F.lit(1)))), r"(?s)^\[(.*)\]$", 1)))
    # Map-side digest of the main response: only the fields the document needs travel
    # through the shuffle, not the whole (large) API body.
    main = F.to_json(F.struct(
        _vget(v, "$.full_name").alias("full_name"),
        _vget(v, "$.description").alias("description"),
        _vget(v, "$.language").alias("language"),
        _default(v, "$.stargazers_count", "0").alias("stars"),
        _default(v, "$.forks_count", "0").alias("forks"),
        _default(v, "$.watchers_count", "0").alias("watchers"),
        _default(v, "$.open_issues_count", "0").alias("open_issues"),
        _default(v, "$.size", "0").alias("size"),
        _vget(v, "$.created_at").alias("created_at"),
        _vget(v, "$.updated_at").alias("updated_at"),
        _vget(v, "$.pushed_at").alias("pushed_at"),
        _vget(v, "$.default_branch").alias("default_branch"),
        _default(v, "$.topics", "[]").alias("topics"),
        _license_name(v).alias("license"),
    ), _JSON_KEEP_NULLS)
    lic = _vget(v, "$.license")
    readable = _is_object(v) & (~F.coalesce(_truthy(lic), F.lit(False)) | _is_object(lic))
    g = _one_each(d, {
        "main": F.when(readable, main),
        "contributors": F.struct(n_contrib.alias("n")),
        "releases": F.struct(n_rel.alias("n"), F.when(n_rel > 0, first_rel).alias("first"))})
    unreadable = lambda ep: F.coalesce(F.col(f"{ep}.ok") & F.col(f"{ep}.p.n").isNull(), F.lit(False))
    good = lambda ep, c: F.when(F.col(f"{ep}.ok"), F.col(f"{ep}.p.{c}"))
    g = g.where(F.col("main.ok") & F.col("main.p").isNotNull() & ~unreadable("contributors") & ~unreadable("releases"))
    m = F.parse_json(F.col("main.p"))
    loaded = F.current_timestamp() if loaded_at is None else ts_literal(loaded_at)
    doc = F.struct(
        F.col("__e").alias("repo_name"),
        *_pick(m, _REPO_MAIN),
        F.coalesce(good("contributors", "n"), F.lit(0)).cast("bigint").alias("contributors_count"),
        F.coalesce(good("releases", "n"), F.lit(0)).cast("bigint").alias("releases_count"),
        F.parse_json(good("releases", "first")).alias("latest_release"),
        *_pick(m, ["topics", "license"]),
        F.date_format(loaded, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'").alias("extracted_at"),
    )
    return g.select(F.col("__e").alias(key), F.to_json(doc, _JSON_KEEP_NULLS).alias("raw_data"))


# Package info fields passed through as they are, and those with a default when absent.
PACKAGE_INFO_FIELDS = ["summary", "description_content_type", "home_page", "author", "author_email", "maintainer",
                       "license", "keywords"]
PACKAGE_INFO_DEFAULTS = {"classifiers": "[]", "requires_dist": "[]"}


_PACKAGE_META = ["version", *PACKAGE_INFO_FIELDS, *PACKAGE_INFO_DEFAULTS, "requires_python", "project_urls",
                 "release_count", "latest_release_info"]


def flatten_package(responses: DataFrame, loaded_at=None, entity: str = "entity", endpoint: str = "endpoint",
                    status: str = "status", body: str = "body", key: str = "package_name",
                    fetched_at: str | None = None) -> DataFrame:
    d = _digest(responses, entity, endpoint, status, body, "metadata", fetched_at)
    v = F.col("__v")
    absent_or_object = lambda path: ~F.coalesce(_vget(v, path).isNotNull(), F.lit(False)) | _is_object(_vget(v, path))
    stats = lambda name: F.to_json(_default(_default(v, "$.data", "{}"), f"$.{name}", "0"))
    # Map-side digest of the metadata response: the version map (every file of every
    # release) is reduced to its size and the current version's first file here, so
    # only the document's fields travel through the shuffle.
    info = _default(v, "$.info", "{}")
    releases = F.try_variant_get(_default(v, "$.releases", "{}"), "$", "map<string,variant>")
    listed = F.try_variant_get(_vget(v, "$.releases"), "$", "array<variant>")     # a list has a length, too
    version = F.try_variant_get(info, "$.version", "string")
    files = F.when(version != "", F.try_element_at(releases, version))
    first_file = F.variant_get(files, "$[0]", "variant")
    release_info = F.when(
        first_file.isNotNull(),
        F.parse_json(F.to_json(F.struct(
            _vget(first_file, "$.upload_time").alias("upload_time"),
            _vget(first_file, "$.python_version").alias("python_version"),
            _vget(first_file, "$.size").alias("size"),
            _vget(first_file, "$.filename").alias("filename")), _JSON_KEEP_NULLS)),
    ).otherwise(F.parse_json(F.lit("{}")))
    meta = F.to_json(F.struct(
        _vget(info, "$.version").alias("version"),
        *[_vget(info, f"$.{f}").alias(f) for f in PACKAGE_INFO_FIELDS],
        *[_default(info, f"$.{f}", dv).alias(f) for f, dv in PACKAGE_INFO_DEFAULTS.items()],
        _vget(info, "$.requires_python").alias("requires_python"),
        _default(info, "$.project_urls", "{}").alias("project_urls"),
        F.coalesce(_size(releases), _size(listed), F.lit(0)).cast("bigint").alias("release_count"),
        release_info.alias("latest_release_info"),
    ), _JSON_KEEP_NULLS)
    in_list = F.exists(listed, lambda x: F.to_json(x) == F.to_json(_vget(info, "$.version")))
    versions = F.when(listed.isNotNull(), (F.coalesce(version, F.lit("")) == "") | ~in_list).otherwise(absent_or_object("$.releases"))
    # files that are there must begin with an object
    first_ok = ~F.coalesce(_truthy(files), F.lit(False)) | F.coalesce(_is_object(first_file), F.lit(False))
    readable = _is_object(v) & absent_or_object("$.info") & F.coalesce(versions, F.lit(False)) & first_ok
    g = _one_each(d, {
        "metadata": F.when(readable, meta),
        "recent": F.when(_is_object(v) & absent_or_object("$.data"), F.struct(
            stats("last_day").alias("day"), stats("last_week").alias("week"), stats("last_month").alias("month")))})
    unread = F.coalesce(F.col("recent.ok") & F.col("recent.p").isNull(), F.lit(False))
    g = g.where(F.col("metadata.ok") & F.col("metadata.p").isNotNull() & ~unread)
    m = F.parse_json(F.col("metadata.p"))
    loaded = F.current_timestamp() if loaded_at is None else ts_literal(loaded_at)
    common = [F.col("__e").alias("package_name"), *_pick(m, _PACKAGE_META)]
    ts = F.date_format(loaded, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'").alias("extracted_at")
    with_stats = F.struct(*common, *[F.parse_json(F.col(f"recent.p.{c}")).alias(f"downloads_last_{c}") for c in ("day", "week", "month")], ts)
    without = F.struct(*common, ts)
    doc = F.when(F.col("recent.ok"), F.to_json(with_stats, _JSON_KEEP_NULLS)).otherwise(
        F.to_json(without, _JSON_KEEP_NULLS))
    return g.select(F.col("__e").alias(key), doc.alias("raw_data"))
