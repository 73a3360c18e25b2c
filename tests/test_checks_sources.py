import datetime as dt
import json
import os
import tempfile

import pytest

from snapflow.operators.checks import (Check, assert_checks, check_accepted, check_not_null, check_unique,
                                       run_checks)
from snapflow.sources.freshness import assert_fresh, fresh_counts
from snapflow.sources.raw import land_raw, read_raw
from snapflow.sources.sinks import qualify
from tests.conftest import rows

T = dt.datetime


def test_checks_fail_and_pass(spark):
    df = spark.createDataFrame([("a", "Popular"), ("a", "Bogus"), (None, None), ("b", "Emerging")],
                               "name string, tier string")
    assert check_not_null(df, "name").count() == 1
    assert rows(check_unique(df, "name")) == [("a", 2)]
    assert rows(check_accepted(df, "tier", ["Popular", "Emerging"])) == [("Bogus", 1)]
    checks = (Check("m", "not_null", "name"), Check("m", "unique", "name"),
              Check("m", "accepted_values", "tier", ("Popular", "Emerging")))
    rep = {(r.check, r.column): r.failures for r in run_checks({"m": df}, checks).collect()}
    assert rep == {("not_null", "name"): 1, ("unique", "name"): 1, ("accepted_values", "tier"): 1}
    with pytest.raises(AssertionError):
        assert_checks(run_checks({"m": df}, checks))
    good = df.where("name = 'b'")
    assert_checks(run_checks({"m": good}, checks))


def test_land_raw_drops_broken_and_empty_and_counts(spark):
    target = tempfile.mkdtemp(prefix="land-", dir=os.environ.get("TMPDIR", "/tmp")) + "/raw"
    docs = [("a", json.dumps({"stars": 1})), ("b", '{"stars": '), ("c", None), ("d", "{}"), ("e", "[1]"),
            ("f", json.dumps({"x": None}))]
    df = spark.createDataFrame(docs, "repo_name string, doc string")
    res = land_raw(df, "repo_name", "doc", target, T(2024, 1, 2, 3))
    assert (res.fetched, res.loaded, res.rejected) == (6, 2, 4)
    back = read_raw(spark, target, "repo_name")
    assert rows(back, "repo_name") == [("a",), ("f",)]
    assert {r.extracted_at for r in back.collect()} == {T(2024, 1, 2, 3)}
    empty = land_raw(df.where("false"), "repo_name", "doc", target, T(2024, 1, 3))
    assert (empty.fetched, empty.loaded) == (0, 0)
    assert read_raw(spark, target, "repo_name").count() == 2


def test_freshness_gate(spark):
    a = spark.createDataFrame([(T(2024, 1, 2, 0, 0),), (T(2024, 1, 2, 23, 59),), (T(2024, 1, 3),), (None,)],
                              "extracted_at timestamp_ntz")
    b = spark.createDataFrame([(T(2024, 1, 1),)], "extracted_at timestamp_ntz")
    assert rows(fresh_counts({"a": a, "b": b}, dt.date(2024, 1, 2))) == [("a", 2), ("b", 0)]
    with pytest.raises(ValueError, match="b"):
        assert_fresh({"a": a, "b": b}, dt.date(2024, 1, 2))
    assert assert_fresh({"a": a}, "2024-01-02") == {"a": 2}


def test_qualify():
    assert qualify("marts", "dim") == "marts.dim"
    assert qualify(None, "dim", "analytics") == "analytics.dim"
    assert qualify(None, "dim") == "dim"


def test_land_as_variant_then_stage_without_parsing(spark):
    from snapflow.operators.staging import stage_repos
    target = tempfile.mkdtemp(prefix="landv-", dir=os.environ.get("TMPDIR", "/tmp")) + "/raw"
    df = spark.createDataFrame([("a", json.dumps({"stars": 3, "topics": ["x"]})), ("b", "{oops")],
                               "repo_name string, doc string")
    res = land_raw(df, "repo_name", "doc", target, T(2024, 1, 2), as_variant=True)
    assert (res.fetched, res.loaded) == (2, 1)
    raw = read_raw(spark, target, "repo_name")
    assert raw.schema["raw_data"].dataType.typeName() == "variant"
    st = stage_repos(raw).collect()
    assert [(r.repo_name, r.stars) for r in st] == [("a", 3)]


def test_landing_by_day_keeps_rejected_documents(spark):
    import os
    import tempfile

    from snapflow.operators.staging import stage_repos
    from snapflow.sources.freshness import fresh_counts
    from snapflow.sources.raw import landing_path, read_rejected
    from snapflow.streaming.latest import read_latest, stream_latest
    from tests.conftest import plan_text
    root = tempfile.mkdtemp(prefix="landd-", dir=os.environ.get("TMPDIR", "/tmp"))
    target = f"{root}/raw"
    docs = [("a", '{"stars": 1, "stars": 2}'), ("b", ""), ("c", None), ("d", "[1]"), ("e", "{}"), ("f", "{oops"), (None, "null"),
            ("g", ' {"stars": 7}')]
    for day, keep in ((1, 8), (2, 3)):
        df = spark.createDataFrame(docs[:keep], "repo_name string, doc string")
        res = land_raw(df, "repo_name", "doc", target, T(2024, 1, day, 5), by_day=True)
        assert (res.fetched, res.loaded, res.rejected) == ((8, 2, 6) if day == 1 else (3, 1, 2))
    raw = read_raw(spark, target, "repo_name")
    assert rows(raw.select("repo_name", "extracted_at")) == [("a", T(2024, 1, 1, 5)), ("a", T(2024, 1, 2, 5)), ("g", T(2024, 1, 1, 5))]
    gone = read_rejected(spark, target, "repo_name")
    assert rows(gone.where("extracted_at < '2024-01-02'"), "repo_name", "reason", "document") == [
        ("b", "not JSON", ""), ("c", "no document", None), ("d", "not an object", "[1]"), ("e", "empty object", "{}"),
        ("f", "not JSON", "{oops"), (None, "not an object", "null")]
    assert gone.count() == 8
    fresh = fresh_counts({"repos": raw}, "2024-01-02")
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    scan = [line for line in plan_text(fresh).splitlines() if "FileScan parquet" in line][0]
    assert "load_date" in scan.split("PartitionFilters")[1].split("PushedFilters")[0] and "2024-01-02" in scan
    assert fresh.first()["n_rows"] == 1
    # the stream reads loaded documents only; the last of repeated keys holds
    stream_latest(spark, landing_path(spark, target), "repo_name", f"{root}/out", f"{root}/ckpt", stage_repos, tiebreak=None).awaitTermination()
    assert rows(read_latest(spark, f"{root}/out"), "repo_name", "stars") == [("a", 2), ("g", 7)]
    none = land_raw(spark.createDataFrame([], "repo_name string, doc string"), "repo_name", "doc", f"{root}/none", T(2024, 1, 1), by_day=True)
    assert (none.fetched, none.loaded) == (0, 0) and read_rejected(spark, f"{root}/none", "repo_name") is None
    land_raw(spark.createDataFrame(docs, "repo_name string, doc string"), "repo_name", "doc", f"{root}/v", T(2024, 1, 1), as_variant=True, by_day=True)
    assert rows(read_raw(spark, f"{root}/v", "repo_name").selectExpr("variant_get(raw_data, '$.stars', 'int') as s")) == [(2,), (7,)]
    land_raw(spark.createDataFrame(docs[1:3], "repo_name string, doc string"), "repo_name", "doc", f"{root}/bad", T(2024, 1, 1), by_day=True)
    assert read_raw(spark, f"{root}/bad", "repo_name").count() == 0 and read_rejected(spark, f"{root}/bad", "repo_name").count() == 2
    stream_latest(spark, landing_path(spark, f"{root}/bad"), "repo_name", f"{root}/o", f"{root}/c", stage_repos, tiebreak=None).awaitTermination()


def test_landing_by_day_opens_few_files_and_holds_more(spark, monkeypatch):
    """Reasons say what ``is_loadable`` says; a batch of more folders than files kept open lands whole; the setting goes back."""
    from pyspark.sql import DataFrameWriter
    from pyspark.sql import functions as F
    from snapflow.sources.raw import is_loadable, read_rejected, reject_reason
    docs = ["{}", " { } ", "\n{\t}\r\n", "[{}]", "[]", "null", '"{}"', "1", "x", "", None, '{"a":{}}', '{"_":null}', '{"a":null}', ' {"": 1}']
    df = spark.createDataFrame([(f"k{i}", d, dt.datetime(2024, 1, 1 + i)) for i, d in enumerate(docs)], "repo_name string, doc string, at timestamp_ntz")
    v = F.try_parse_json("doc")
    said = df.select(reject_reason(F.col("doc"), v).alias("why"), is_loadable(v).alias("fine")).collect()
    assert [r["why"] is None for r in said] == [r["fine"] for r in said]
    assert [r["why"] for r in said] == ["empty object"] * 3 + ["not an object"] * 5 + ["not JSON"] * 2 + ["no document"] + [None] * 4
    name, seen, save = "spark.sql.maxConcurrentOutputFileWriters", [], DataFrameWriter.save
    monkeypatch.setattr(DataFrameWriter, "save", lambda self, *a, **k: (seen.append(int(spark.conf.get(name))), save(self, *a, **k))[1])
    before = spark.conf.get(name)
    target = tempfile.mkdtemp(prefix="land-", dir=os.environ.get("TMPDIR", "/tmp")) + "/t"
    land_raw(df.coalesce(1), "repo_name", "doc", target, F.col("at"), by_day=True)
    assert seen and seen[0] > 0 and spark.conf.get(name) == before       # no sort of whole documents by folder
    assert read_raw(spark, target, "repo_name").count() == 4 and read_rejected(spark, target, "repo_name").count() == 11
