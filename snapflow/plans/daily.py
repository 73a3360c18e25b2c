"""The daily run (L1): gate -> staging -> marts -> checks, stopping at the first failure.

Plain driver code calling the operators; every step is one or more Spark jobs. Marts
that several later steps read (dimension, metrics) are written as tables and read back,
which both materialises them once and cuts the lineage so a lost executor recomputes
from the stored table, not from the raw JSON.

Staging parses only what has landed since the run before (``staging="incremental"``); its
results and check counts are those of staging every document ever landed (``"full"``).
"""

from __future__ import annotations

import datetime as dt
import logging
from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import partial

from pyspark.sql import DataFrame, SparkSession

from snapflow.operators.checks import (DEFAULT_CHECKS, assert_checks, counted_report, observe_not_null,
                                       observed_report, run_checks)
from snapflow.operators.dimension import PACKAGE_INPUTS, REPO_INPUTS, build_dimension
from snapflow.operators.history import HISTORY_KEYS, history_rows, previous_rows, read_history, upsert_with_latest
from snapflow.operators.metrics import build_metrics
from snapflow.operators.staging import PACKAGE_COLUMNS, REPO_COLUMNS, stage_packages, stage_repos
from snapflow.operators.trends import build_trends, look_back_start, read_trends, update_trends, write_trends
from snapflow.session import reliable_checkpoint
from snapflow.sources import sinks
from snapflow.sources.freshness import assert_fresh
from snapflow.sources.raw import landing_path, read_raw
from snapflow.sources.sinks import as_view, qualify, read_table, write_table
from snapflow.streaming.latest import BUCKETS, landing_schema, null_counts, read_latest, stream_latest

log = logging.getLogger(__name__)


@dataclass
class RunConfig:
    root: str                                   # shared folder holding every table of the run
    as_of: dt.date | None = None                # the run's day (None = today, UTC)
    now: dt.datetime | None = None              # build time stamped on marts (None = now)
    gate: bool = True                           # freshness gate on the raw tables
    check: str = "fail"                         # "fail": stop on a failed check; "report": only report; "off"
    trends_input: str = "history"               # "history" (moving windows) or "metrics" (literal)
    retention_days: int | None = 90
    staging: str = "incremental"                # only newly landed files; "full": every raw row, same results
    latest_buckets: int = BUCKETS               # key buckets of a new latest-staged table
    catalog: bool = False                       # marts as catalog tables "schema.name" instead of folders
    doc_type: str = "string"                    # how landing folders store documents: "string" or "variant"
    repo_tiebreak: tuple[str, ...] | None = None    # None: every atomic staged column (deterministic)
    package_tiebreak: tuple[str, ...] | None = None
    checks: tuple = field(default=DEFAULT_CHECKS)
    marts_schema: str | None = "marts"          # custom schema per model group, used as written
    default_schema: str = "analytics"           # for models without a custom schema

    def path(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/{name}"

    def table(self, name: str, schema: str | None = None) -> str:
        """A model's table: ``schema.name`` with the schema chosen by ``qualify``, or its folder under the root."""
        target = qualify(schema, name, self.default_schema)
        return target if self.catalog else self.path(target.replace(".", "/"))

    @property
    def raw_repos(self) -> str:
        return self.path("raw_data/github_repos")

    @property
    def raw_packages(self) -> str:
        return self.path("raw_data/pypi_packages")


# The ten-row technology mapping the original job ships inline (example data;
# any mapping DataFrame with the same three columns can be passed instead).
EXAMPLE_MAPPING = [
    ("Apache Airflow", "apache/airflow", "apache-airflow"),
    ("dbt", "dbt-labs/dbt-core", "dbt-core"),
    ("Apache Spark", "apache/spark", "pyspark"),
    ("Pandas", "pandas-dev/pandas", "pandas"),
    ("SQLAlchemy", "sqlalchemy/sqlalchemy", "sqlalchemy"),
    ("Great Expectations", "great-expectations/great_expectations", "great-expectations"),
    ("Prefect", "prefecthq/prefect", "prefect"),
    ("Apache Kafka", "apache/kafka", "kafka-python"),
    ("Snowflake Connector", "snowflakedb/snowflake-connector-python", "snowflake-connector-python"),
    ("DuckDB", "duckdb/duckdb", "duckdb"),
]


def example_mapping(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(EXAMPLE_MAPPING, "technology_name string, github_repo string, pypi_package string")


def _materialize(spark: SparkSession, df: DataFrame, target: str, partition_by=None) -> DataFrame:
    write_table(df, target, partition_by)
    return read_table(spark, target)


def _incremental_latest(spark, cfg, sources):
    """Per source ``(landing, key, stage, tiebreak)``: the latest staged rows per key after taking up newly landed files,
    and the folder that holds them. The sources don't depend on each other: their streams run side by side."""
    names = [landing.rstrip("/").rsplit("/", 1)[-1] for landing, *_ in sources]
    outs = [cfg.path(f"staging/{name}_latest") for name in names]
    running = []
    try:
        for name, out, (landing, key, stage, tiebreak) in zip(names, outs, sources, strict=True):
            running.append(stream_latest(spark, landing_path(spark, landing), key, out, cfg.path(f"_streams/{name}"), stage,
                                         tiebreak=tiebreak, doc_type=cfg.doc_type, buckets=cfg.latest_buckets))
        for query in running:
            query.awaitTermination()
    finally:
        for query in running:                 # one failed: the other takes up its files in the next run
            query.stop()
    found = []
    for out, (_, key, stage, _) in zip(outs, sources, strict=True):
        empty = stage(spark.createDataFrame([], landing_schema(key, cfg.doc_type)))
        found.append((empty if read_table(spark, out) is None else read_latest(spark, out, schema=empty.schema), out))   # None: nothing landed yet
    return found


def _read(checks, model: str, columns: Sequence[str], inputs: Sequence[str], tiebreak: Sequence[str] | None) -> set[str]:
    """Staged columns that a run reads: the dimension's, those that break ties (any, if none are named), the checked ones."""
    if tiebreak is None:
        return set(columns)
    return {*inputs, *tiebreak, *(c.column for c in checks if c.model == model and c.check == "not_null")}


def run_daily(spark: SparkSession, mapping: DataFrame, cfg: RunConfig) -> dict[str, DataFrame]:
    as_of = cfg.as_of or dt.datetime.now(dt.timezone.utc).date()       # load times are UTC
    raw_r = read_raw(spark, cfg.raw_repos, "repo_name")
    raw_p = read_raw(spark, cfg.raw_packages, "package_name")
    if cfg.gate:
        counts = assert_fresh({"github_repos": raw_r, "pypi_packages": raw_p}, as_of)
        log.info("fresh rows on %s: %s", as_of, counts)
    staged = {"stg_github_repos": (raw_r, stage_repos), "stg_pypi_packages": (raw_p, stage_packages)}
    checks = [] if cfg.check == "off" else list(cfg.checks)
    counted: list = []                        # reports of staging checks that need no pass of their own
    if cfg.staging == "incremental":
        (stg_r, log_r), (stg_p, log_p) = _incremental_latest(spark, cfg, [
            (cfg.raw_repos, "repo_name", partial(stage_repos, only=REPO_COLUMNS), cfg.repo_tiebreak),
            (cfg.raw_packages, "package_name", partial(stage_packages, only=PACKAGE_COLUMNS), cfg.package_tiebreak)])
        for model, out in (("stg_github_repos", log_r), ("stg_pypi_packages", log_p)):
            nn = [c for c in checks if c.model == model and c.check == "not_null"]
            if nn:
                nulls = null_counts(spark, out)
                counted.append((nn, lambda nn=nn, nulls=nulls: counted_report(spark, nn, nulls)))
    elif cfg.staging == "full":
        as_view(stage_packages(raw_p), "stg_pypi_packages")         # a named view
        # inlined (never stored); of the view's columns those that the run reads
        stg_r = stage_repos(raw_r, only=_read(checks, "stg_github_repos", REPO_COLUMNS, REPO_INPUTS, cfg.repo_tiebreak))
        stg_p = stage_packages(raw_p, only=_read(checks, "stg_pypi_packages", PACKAGE_COLUMNS, PACKAGE_INPUTS, cfg.package_tiebreak))
        # staging checks ride along with the dimension build instead of re-parsing every document
        stg_r, o_r, nn_r = observe_not_null(stg_r, "stg_github_repos", checks)
        stg_p, o_p, nn_p = observe_not_null(stg_p, "stg_pypi_packages", checks)
        for o, nn, model in ((o_r, nn_r, "stg_github_repos"), (o_p, nn_p, "stg_pypi_packages")):
            if nn:
                raw, stage = staged[model]
                counted.append((nn, lambda o=o, nn=nn, raw=raw, stage=stage: observed_report(spark, o, nn, stage(raw))))
    else:
        raise ValueError(f"unknown staging {cfg.staging!r}")
    dim = _materialize(spark, build_dimension(mapping, stg_r, stg_p, now=cfg.now,
                                              repo_tiebreak=cfg.repo_tiebreak,
                                              package_tiebreak=cfg.package_tiebreak,
                                              one_per_key=cfg.staging == "incremental"),
                       cfg.table("dim_technologies", cfg.marts_schema))
    met = _materialize(spark, build_metrics(dim), cfg.table("fct_technology_metrics", cfg.marts_schema))
    target = cfg.table("fct_technology_history", cfg.marts_schema)
    previous = previous_rows(spark, target)                      # one row per entity; None on the first run
    rows = history_rows(met, None, now=cfg.now, previous=previous)
    trends_target = cfg.table("fct_technology_trends", cfg.marts_schema)
    fresh = cfg.trends_input == "history" and cfg.retention_days is not None and not sinks.is_stale(spark, trends_target)
    sinks.mark_stale(spark, trends_target)                       # until it has followed the history
    rows = reliable_checkpoint(rows)
    state = upsert_with_latest(spark, target, rows, HISTORY_KEYS, "snapshot_date", "technology_name", False)
    hist = read_history(spark, target)
    if hist is None:                                             # no rows yet
        hist = spark.createDataFrame([], rows.schema)
    if not (fresh and update_trends(spark, trends_target, hist, rows, state, as_of, cfg.retention_days)):
        if cfg.trends_input == "history":
            back = None if cfg.retention_days is None else look_back_start(state, as_of, cfg.retention_days)
            trend = build_trends(hist, as_of=as_of, days=cfg.retention_days, look_back=back)
        else:
            trend = build_trends(met, as_of=as_of, days=cfg.retention_days)
        write_trends(spark, trends_target, trend, as_of, cfg.retention_days)
    sinks.clear_stale(spark, trends_target)
    trends = read_trends(spark, trends_target)
    if trends is None:                                           # no rows yet
        trends = build_trends(hist, as_of=as_of, days=cfg.retention_days).limit(0)
    result = {"dimension": dim, "metrics": met, "history": hist, "trends": trends}
    if cfg.check != "off":
        done = {id(c) for nn, _ in counted for c in nn}
        out = {"dim_technologies": dim, "fct_technology_metrics": met, "fct_technology_history": hist,
               "fct_technology_trends": trends}
        # other checks of staged rows look at all of them, too
        out |= {m: stage(raw) for m, (raw, stage) in staged.items()}
        reports = [r() for _, r in counted]
        rest = [c for c in checks if id(c) not in done and c.model in out]
        if rest:
            reports.append(run_checks(out, rest))
        if not reports:
            raise ValueError("no checks apply to the tables of the run")
        report = reports[0]
        for r in reports[1:]:
            report = report.unionByName(r)
        if cfg.check == "fail":
            assert_checks(report)
        result["checks"] = report
    return result
