import json

from snapflow.operators.staging import stage_packages, stage_repos
from snapflow.sources.responses import flatten_package, flatten_repo

NOW = "2024-01-02 03:04:05"


def _resp(spark, data):
    return spark.createDataFrame(data, "entity string, endpoint string, status int, body string")


def test_flatten_repo_rules(spark):
    main = {"full_name": "o/a", "stargazers_count": 5, "forks_count": None, "topics": ["t"],
            "license": {"name": "MIT"}, "created_at": "2020-01-01T00:00:00Z"}
    data = [
        ("o/a", "main", 200, json.dumps(main)),
        ("o/a", "contributors", 200, json.dumps([{"login": "x"}, {"login": "y"}])),
        ("o/a", "releases", 200, json.dumps([{"tag_name": "v2", "published_at": "2024-01-01T00:00:00Z"},
                                             {"tag_name": "v1"}])),
        ("o/b", "main", 200, json.dumps({"full_name": "o/b"})),          # absent counts, topics, license
        ("o/b", "contributors", 500, "oops"),                            # not OK -> 0
        ("o/b", "releases", 403, "nope"),                                # not OK -> empty list
        ("o/c", "main", 404, "{}"),                                      # main not OK -> dropped
        ("o/d", "main", 200, "<html>"),                                  # OK but not JSON -> dropped
    ]
    docs = flatten_repo(_resp(spark, data), loaded_at=NOW)
    got = {r.repo_name: json.loads(r.raw_data) for r in docs.collect()}
    assert set(got) == {"o/a", "o/b"}
    a, b = got["o/a"], got["o/b"]
    assert (a["stars"], a["forks"], a["contributors_count"], a["releases_count"]) == (5, None, 2, 2)
    assert a["latest_release"]["tag_name"] == "v2" and a["license"] == "MIT" and a["topics"] == ["t"]
    assert (b["stars"], b["forks"], b["contributors_count"], b["releases_count"]) == (0, 0, 0, 0)
    assert b["latest_release"] is None and b["topics"] == [] and b["license"] is None
    assert a["extracted_at"].startswith("2024-01-02T03:04:05")
    raw = docs.selectExpr("timestamp_ntz'2024-01-02 03:04:05' as extracted_at", "repo_name", "raw_data")
    st = {r.repo_name: r for r in stage_repos(raw).collect()}
    assert st["o/a"].forks == 0 and st["o/a"].latest_release_tag == "v2"   # staging fills the explicit null


def test_flatten_package_rules(spark):
    meta = {"info": {"version": "1.1", "summary": "s", "classifiers": None},
            "releases": {"1.0": [{"upload_time": "2023-01-01T00:00:00"}],
                         "1.1": [{"upload_time": "2024-01-01T10:00:00", "size": 9, "filename": "f.whl"}]}}
    data = [
        ("a", "metadata", 200, json.dumps(meta)),
        ("a", "recent", 200, json.dumps({"data": {"last_day": 1, "last_month": 30}})),  # week missing -> 0
        ("b", "metadata", 200, json.dumps({"info": {"version": "9"}, "releases": {"1": []}})),
        ("b", "recent", 429, "slow down"),                                               # stats absent
        ("c", "metadata", 200, json.dumps({"info": {"version": "1"}, "releases": {"1": []}})),
        ("d", "metadata", 500, "x"),
    ]
    docs = flatten_package(_resp(spark, data), loaded_at=NOW)
    got = {r.package_name: json.loads(r.raw_data) for r in docs.collect()}
    assert set(got) == {"a", "b", "c"}
    a, b, c = got["a"], got["b"], got["c"]
    assert a["release_count"] == 2 and a["latest_release_info"]["filename"] == "f.whl"
    assert (a["downloads_last_day"], a["downloads_last_week"], a["downloads_last_month"]) == (1, 0, 30)
    assert a["classifiers"] is None and a["requires_dist"] == [] and a["project_urls"] == {}
    assert "downloads_last_day" not in b and b["latest_release_info"] == {} and b["release_count"] == 1
    assert c["latest_release_info"] == {}                                   # version with an empty file list
    raw = docs.selectExpr("timestamp_ntz'2024-01-02 03:04:05' as extracted_at", "package_name", "raw_data")
    st = {r.package_name: r for r in stage_packages(raw).collect()}
    assert st["b"].downloads_last_month == 0 and st["a"].latest_release_size == 9


def _repo(spark, main='{"full_name":"o/x"}', contributors="[]", releases="[]", status=200, c_status=200):
    data = [("o/x", "main", status, main), ("o/x", "contributors", c_status, contributors), ("o/x", "releases", 200, releases)]
    got = flatten_repo(_resp(spark, data), loaded_at=NOW).collect()
    return json.loads(got[0].raw_data) if got else None


def test_unreadable_repo_responses_drop_the_entity(spark):
    for main in ("[]", "null", '"x"', "7", "", '{"license":"MIT"}', '{"license":[1]}', None):
        assert _repo(spark, main=main) is None, main
    for lic in ("null", '""', "{}", "[]", "0", "false"):
        assert _repo(spark, main='{"license":%s}' % lic)["license"] is None
    assert _repo(spark, main='\n\t {"full_name":"o/x"}\r\n')["full_name"] == "o/x"
    for body in ("null", "3", "true", "x"):
        assert _repo(spark, contributors=body) is None and _repo(spark, releases=body) is None, body
    assert _repo(spark, releases='{"a":1}') is None
    assert _repo(spark, releases="{}")["releases_count"] == 0
    assert _repo(spark, contributors='{"a":1}')["contributors_count"] == 1
    assert _repo(spark, contributors='"abc"')["contributors_count"] == 3
    r = _repo(spark, releases='"abc"')
    assert (r["releases_count"], r["latest_release"]) == (3, "a")


def test_statuses(spark):
    for status in (200, 201, 203, 304, 399):
        assert _repo(spark, status=status) is not None
    for status in (400, 404, 503, None):
        assert _repo(spark, status=status) is None
    assert _repo(spark, c_status=201, contributors="[1]")["contributors_count"] == 0
    data = [("a", "metadata", 201, '{"info":{}}'), ("a", "recent", 201, "null"), ("b", "metadata", 400, "{}")]
    got = {r.package_name: json.loads(r.raw_data) for r in flatten_package(_resp(spark, data), loaded_at=NOW).collect()}
    assert set(got) == {"a"} and "downloads_last_day" not in got["a"]


def test_unreadable_package_responses_drop_the_entity(spark):
    ok = '{"info":{"version":"1"},"releases":{"1":[{"size":3}]}}'
    bad_meta = ["[]", "null", '"x"', '{"info":null}', '{"info":[]}', '{"releases":null}', '{"releases":7}',
                '{"info":{"version":"1"},"releases":["1"]}', '{"info":{"version":"1"},"releases":{"1":["f"]}}',
                '{"info":{"version":"1"},"releases":{"1":{"a":1}}}', '{"info":{"version":"1"},"releases":{"1":5}}']
    good_meta = {"{}": 0, ok: 1, '{"info":{"version":"1"},"releases":["2","3"]}': 2, '{"info":{"version":"1"},"releases":{"1":null}}': 1,
                 '{"info":{"version":""},"releases":{"":["f"]}}': 1}
    data = [(f"bad{i}", "metadata", 200, b) for i, b in enumerate(bad_meta)]
    data += [(f"good{i}", "metadata", 200, b) for i, b in enumerate(good_meta)]
    bad_recent = ["[]", "null", '"x"', '{"data":null}', '{"data":[]}', "x"]
    for i, b in enumerate(bad_recent):
        data += [(f"r{i}", "metadata", 200, ok), (f"r{i}", "recent", 200, b)]
    data += [("r_ok", "metadata", 200, ok), ("r_ok", "recent", 200, "{}")]
    got = {r.package_name: json.loads(r.raw_data) for r in flatten_package(_resp(spark, data), loaded_at=NOW).collect()}
    assert set(got) == {f"good{i}" for i in range(len(good_meta))} | {"r_ok"}
    assert [got[f"good{i}"]["release_count"] for i in range(len(good_meta))] == list(good_meta.values())
    assert got["r_ok"]["downloads_last_week"] == 0


def test_one_whole_response_is_taken(spark):
    rows = [("o/x", "main", 200, '{"full_name":"old","size":9}', "2024-01-01 00:00:00"),
            ("o/x", "main", 200, '{"full_name":"new"}', "2024-01-02 00:00:00"),
            ("o/x", "releases", 200, '[{"tag_name":"v1"},{"tag_name":"v0"}]', "2024-01-01 00:00:00"),
            ("o/x", "releases", 200, '[{"tag_name":"a"}]', "2024-01-02 00:00:00"),
            ("o/y", "main", 200, "{}", "2024-01-01 00:00:00"), ("o/y", "main", 404, "{}", "2024-01-02 00:00:00")]
    df = spark.createDataFrame(rows, "entity string, endpoint string, status int, body string, at string")
    got = {r.repo_name: json.loads(r.raw_data) for r in flatten_repo(df, loaded_at=NOW, fetched_at="at").collect()}
    assert set(got) == {"o/x"}
    x = got["o/x"]
    assert (x["full_name"], x["size"], x["releases_count"], x["latest_release"]["tag_name"]) == ("new", 0, 1, "a")
