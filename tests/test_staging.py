import datetime as dt
import json

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from snapflow.functions.jsonpaths import extract
from snapflow.operators.staging import PACKAGE_COLUMNS, REPO_COLUMNS, stage_packages, stage_repos, variant_to_json
from tests.conftest import plan_text, rows


def _raw(spark, docs, key="repo_name"):
    data = [(dt.datetime(2024, 1, 1, i), f"k{i}", d if isinstance(d, str) or d is None else json.dumps(d))
            for i, d in enumerate(docs)]
    return spark.createDataFrame(data, f"extracted_at timestamp_ntz, {key} string, raw_data string")


def test_stage_repos_defaults_fallback_and_types(spark):
    docs = [
        {"repo_name": "a/b", "stars": 12, "forks": None, "created_at": "2015-04-13T18:04:58Z",
         "latest_release": {"tag_name": "v1", "published_at": "2024-12-01T00:00:00+02:00"}, "topics": ["x", "y"]},
        {"stars": "31", "license": "MIT"},          # inner key missing, numeric string
        {"repo_name": "c/d", "latest_release": None},
    ]
    out = stage_repos(_raw(spark, docs)).orderBy("extracted_at").collect()
    assert [c for c in out[0].asDict()] == REPO_COLUMNS
    a, b, c = out
    assert (a.repo_name, a.stars, a.forks, a.size) == ("a/b", 12, 0, 0)
    assert a.created_at == dt.datetime(2015, 4, 13, 18, 4, 58)
    assert a.latest_release_tag == "v1"
    assert a.latest_release_published_at == dt.datetime(2024, 11, 30, 22, 0, 0)   # offset honoured, UTC
    assert (b.repo_name, b.stars, b.license, b.latest_release_tag) == ("k1", 31, "MIT", None)
    assert (c.repo_name, c.stars, c.contributors_count) == ("c/d", 0, 0)


def test_stage_packages_nested_and_missing_stats(spark):
    docs = [
        {"package_name": "p", "version": "1.0", "release_count": 3,
         "latest_release_info": {"upload_time": "2024-01-02T03:04:05", "size": 10, "filename": "f.whl"},
         "downloads_last_day": 1, "downloads_last_week": 7, "downloads_last_month": 30,
         "classifiers": ["A"], "project_urls": {"Home": "h"}},
        {"package_name": "q", "latest_release_info": {}},
    ]
    out = stage_packages(_raw(spark, docs, "package_name")).orderBy("extracted_at").collect()
    assert [c for c in out[0].asDict()] == PACKAGE_COLUMNS
    p, q = out
    assert p.latest_release_upload_time == dt.datetime(2024, 1, 2, 3, 4, 5)
    assert (p.latest_release_size, p.latest_filename, p.downloads_last_month) == (10, "f.whl", 30)
    assert (q.latest_release_size, q.downloads_last_day, q.downloads_last_week, q.downloads_last_month,
            q.release_count) == (0, 0, 0, 0, 0)


def test_bad_cast_fails_unless_on_error_null(spark):
    raw = _raw(spark, [{"stars": "many"}])
    with pytest.raises(PySparkException):
        stage_repos(raw).collect()
    assert stage_repos(raw, on_error="null").collect()[0].stars == 0


def test_extract_variant_keeps_subdocument(spark):
    raw = _raw(spark, [{"topics": ["a", "b"], "o": {"x": {"y": 5}}}])
    out = extract(raw, "raw_data", {"t": ("topics", "variant"), "y": ("o.x.y", "bigint")})
    r = out.select(F.to_json("t").alias("t"), "y").collect()[0]
    assert (r.t, r.y) == ('["a","b"]', 5)


def test_fraction_to_whole_number_rounds(spark):
    raw = _raw(spark, [{"stars": 1.5, "forks": 2.4, "watchers": -1.5, "size": "7", "open_issues": 12345678901234}])
    r = stage_repos(raw).collect()[0]
    assert (r.stars, r.forks, r.watchers, r.size, r.open_issues) == (2, 2, -2, 7, 12345678901234)


@pytest.mark.parametrize("stage, key, columns", [(stage_repos, "repo_name", REPO_COLUMNS), (stage_packages, "package_name", PACKAGE_COLUMNS)])
def test_one_walk_gives_the_columns_of_paths(spark, stage, key, columns):
    """``only`` takes its columns in one walk: the same values for odd documents, and no lookup by path in the whole one."""
    full = {key: "in", "stars": "7", "forks": 2.5, "watchers": None, "size": -1.5, "created_at": "2024-01-01T02:00:00+02:00",
            "topics": ["a", {"b": None}], "license": {"x": 1}, "latest_release": {"tag_name": "v", "published_at": "2024-01-02"},
            "version": 3, "classifiers": None, "latest_release_info": {"size": "9", "upload_time": None}, "release_count": 1e3}
    docs = [json.dumps(full), "{}", "[1]", "null", "3", '"x"', None, "no json", f'{{"{key}":null,"topics":null,"latest_release":3,"Stars":5}}',
            f'{{"{key}":"a","{key}":"b","stars":1,"stars":2,"latest_release":null,"latest_release_info":[1]}}']
    raw = _raw(spark, docs, key) if key != "repo_name" else _raw(spark, docs)
    variants = [c for c in ("topics", "classifiers", "requires_dist", "project_urls") if c in columns]
    shown = lambda df: rows(variant_to_json(df, [c for c in variants if c in df.columns]))
    assert shown(stage(raw, only=columns)) == shown(stage(raw))
    some = ["extracted_at", key, columns[3]]
    assert stage(raw, only=some).columns == [c for c in columns if c in some]
    assert shown(stage(raw, only=some)) == shown(stage(raw).select(*[c for c in columns if c in some]))
    assert plan_text(stage(raw)).count("variant_get(__doc_v") > 15
    plan = plan_text(stage(raw, only=columns))
    assert "variant_get(__doc_v" not in plan and plan.count("parseJson") == 1
    with pytest.raises(ValueError, match="nosuch"):
        stage(raw, only=["nosuch"])


def test_one_walk_of_names_that_differ_in_case(spark):
    df = spark.createDataFrame([('{"a":1,"A":"2","b":{"c":[3]}}',)], "doc string")
    fields = {"x": ("a", "bigint"), "y": ("A", "bigint"), "z": ("$.b.c[0]", "bigint")}
    assert rows(extract(df, "doc", fields, one_walk=True)) == [(1, 2, 3)]
    del fields["y"]
    assert rows(extract(df, "doc", fields, one_walk=True)) == [(1, 3)]
