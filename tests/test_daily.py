import datetime as dt
import os
import tempfile

from pyspark.sql import functions as F

from snapflow.plans import bridge as B
from snapflow.operators.checks import Check
from snapflow.operators.staging import variant_to_json
from snapflow.plans.daily import RunConfig, example_mapping, run_daily
from tests.conftest import rows

SF = "/root/testdata/sf0.001"


def _cfg(root, staging, as_of, tiebreaks=True):
    tb = dict(repo_tiebreak=("full_name",), package_tiebreak=("version",)) if tiebreaks else {}
    return RunConfig(root=root, as_of=as_of, now=dt.datetime(2024, 2, 1), check="report", gate=False,
                     staging=staging, **tb)


def test_incremental_staging_equals_full(spark):
    events = B.table(spark, SF, "events")
    repos = B.repo_documents(events)
    packages = B.package_documents(B.table(spark, SF, "orders"))
    mapping = B.mapping(B.table(spark, SF, "customer"))
    outs = {}
    for staging in ("full", "incremental"):
        root = tempfile.mkdtemp(prefix=f"daily-{staging}-", dir=os.environ.get("TMPDIR", "/tmp"))
        for day, cut in ((dt.date(2024, 1, 15), "2024-01-16"), (dt.date(2024, 1, 30), "2024-02-01")):
            cfg = _cfg(root, staging, day, tiebreaks=False)       # default: total (all atomic columns)
            lo = F.lit("2024-01-16" if day.day == 30 else "1900-01-01").cast("timestamp_ntz")
            batch = repos.where((F.col("extracted_at") >= lo) & (F.col("extracted_at") < F.lit(cut).cast("timestamp_ntz")))
            batch.write.mode("append").parquet(cfg.raw_repos)
            if day.day == 15:
                packages.write.mode("append").parquet(cfg.raw_packages)
            out = run_daily(spark, mapping, cfg)
        outs[staging] = out
    for t in ("dimension", "history", "trends", "checks"):
        full, inc = (variant_to_json(o[t], ["topics"]) if t == "dimension" else o[t] for o in (outs["full"], outs["incremental"]))
        assert outs["full"][t].dtypes == outs["incremental"][t].dtypes
        assert rows(full, *full.columns) == rows(inc, *full.columns), t


def test_daily_checks_report_and_fail(spark):
    import pytest
    root = tempfile.mkdtemp(prefix="daily-chk-", dir=os.environ.get("TMPDIR", "/tmp"))
    cfg = _cfg(root, "full", dt.date(2024, 1, 30))
    B.repo_documents(B.table(spark, SF, "events")).write.parquet(cfg.raw_repos)
    B.package_documents(B.table(spark, SF, "orders")).write.parquet(cfg.raw_packages)
    mapping = B.mapping(B.table(spark, SF, "customer"))
    out = run_daily(spark, mapping, cfg)
    rep = {(r.model, r.check, r.column): r.failures for r in out["checks"].collect()}
    assert len(rep) == 13
    assert rep[("stg_github_repos", "not_null", "stars")] == 0
    assert rep[("dim_technologies", "unique", "technology_name")] == 0
    assert rep[("fct_technology_history", "not_null", "snapshot_date")] > 0   # one-sided technologies
    cfg.check = "fail"
    with pytest.raises(AssertionError, match="snapshot_date"):
        run_daily(spark, mapping, cfg)


def _landed(spark, cfg):
    B.repo_documents(B.table(spark, SF, "events")).write.parquet(cfg.raw_repos)
    B.package_documents(B.table(spark, SF, "orders")).write.parquet(cfg.raw_packages)


def test_checks_cannot_pass_by_absence(spark):
    """An empty mapping lets the optimiser drop the observed staging; overtaken rows count as well."""
    import pytest
    empty = example_mapping(spark).limit(0)
    description = Check("stg_github_repos", "not_null", "description")
    nulls = B.table(spark, SF, "events").where("event_id % 10 = 1").count()
    for staging in ("full", "incremental"):
        cfg = _cfg(tempfile.mkdtemp(prefix="daily-abs-", dir=os.environ.get("TMPDIR", "/tmp")), staging, dt.date(2024, 1, 30))
        _landed(spark, cfg)
        cfg.checks = (description, Check("dim_technologies", "not_null", "technology_name"))
        rep = {r.column: r.failures for r in run_daily(spark, empty, cfg)["checks"].collect()}
        assert rep == {"description": nulls, "technology_name": 0}
        cfg.checks = (description,)                                     # staging checks only
        assert [r.failures for r in run_daily(spark, empty, cfg)["checks"].collect()] == [nulls]
        cfg.checks = (Check("stg_pypi_packages", "unique", "package_name"),)
        many = B.table(spark, SF, "orders").count()
        assert 0 < run_daily(spark, empty, cfg)["checks"].first().failures < many
        cfg.checks = (Check("no_such_model", "not_null", "x"),)
        with pytest.raises(ValueError):
            run_daily(spark, empty, cfg)


def test_marts_as_named_tables(spark):
    spark.sql("DROP DATABASE IF EXISTS marts CASCADE")
    cfg = _cfg(tempfile.mkdtemp(prefix="daily-cat-", dir=os.environ.get("TMPDIR", "/tmp")), "incremental", dt.date(2024, 1, 30))
    cfg.catalog = True
    _landed(spark, cfg)
    mapping = B.mapping(B.table(spark, SF, "customer"))
    for _ in range(2):
        out = run_daily(spark, mapping, cfg)
    assert spark.sql("select count(*) as n from marts.dim_technologies").first().n == mapping.count()
    for name, key in (("fct_technology_history", "history"), ("fct_technology_trends", "trends")):
        assert spark.table(f"marts.{name}").count() == out[key].count() > 0
    # one-sided technologies have no date: a rerun adds their rows again
    undated = spark.table("marts.fct_technology_history").where("snapshot_date is null").count()
    assert undated > 0 and undated % 2 == 0
    spark.sql("DROP DATABASE marts CASCADE")
