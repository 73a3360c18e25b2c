"""Data checks.

Each check is a distributed aggregate; a suite returns a small report DataFrame
``(model, check, column, failures)`` with one row per check. All checks of one table
share a single scan and a single shuffle, pre-aggregated map-side.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapflow.session import observed


@dataclass(frozen=True)
class Check:
    model: str
    check: str          # "not_null" | "unique" | "accepted_values"
    column: str
    values: tuple = ()


# The active checks of the original job's models (10 not-null, 1 unique, 2 accepted-values).
POPULARITY_VALUES = ("Very Popular", "Popular", "Moderate", "Emerging")
USAGE_VALUES = ("High Usage", "Medium Usage", "Low Usage", "Minimal Usage")
DEFAULT_CHECKS = (
    Check("stg_github_repos", "not_null", "repo_name"),
    Check("stg_github_repos", "not_null", "stars"),
    Check("stg_github_repos", "not_null", "forks"),
    Check("stg_pypi_packages", "not_null", "package_name"),
    Check("stg_pypi_packages", "not_null", "downloads_last_month"),
    Check("dim_technologies", "not_null", "technology_name"),
    Check("dim_technologies", "unique", "technology_name"),
    Check("fct_technology_metrics", "not_null", "technology_name"),
    Check("fct_technology_metrics", "accepted_values", "popularity_tier", POPULARITY_VALUES),
    Check("fct_technology_metrics", "accepted_values", "usage_tier", USAGE_VALUES),
    Check("fct_technology_history", "not_null", "technology_name"),
    Check("fct_technology_history", "not_null", "snapshot_date"),
    Check("fct_technology_trends", "not_null", "technology_name"),
)


def check_not_null(df: DataFrame, col: str) -> DataFrame:
    """Failing rows: ``col`` is NULL."""
    return df.where(F.col(col).isNull())


def check_unique(df: DataFrame, col: str) -> DataFrame:
    """Failing values: non-NULL values seen more than once, with their counts."""
    return (df.where(F.col(col).isNotNull()).groupBy(col)
              .agg(F.count(F.lit(1)).alias("n_records")).where(F.col("n_records") > 1))


def check_accepted(df: DataFrame, col: str, values: Iterable) -> DataFrame:
    """Failing values: non-NULL values outside ``values``, with their counts."""
    vals = list(values)
    return (df.where(F.col(col).isNotNull() & ~F.col(col).isin(vals)).groupBy(col)
              .agg(F.count(F.lit(1)).alias("n_records")))


def _table_report(model: str, df: DataFrame, cs: Sequence[Check]) -> DataFrame:
    """Failures of every check on one table from a single scan and a single shuffle.

    Each row emits one small item ``(check id, value)`` per check it fails or feeds: a
    NULL for not-null, the value for unique, an unaccepted value for accepted-values.
    Items are counted per ``(id, value)`` with partial aggregation before the shuffle,
    then reduced per check: rows (not-null), values seen twice or more (unique),
    distinct values (accepted-values).
    """
    items = []
    for i, c in enumerate(cs):
        col = F.col(c.column)
        if c.check == "not_null":
            cond, val = col.isNull(), F.lit(None).cast("string")
        elif c.check == "unique":
            cond, val = col.isNotNull(), col.cast("string")
        elif c.check == "accepted_values":
            cond, val = col.isNotNull() & ~col.isin(list(c.values)), col.cast("string")
        else:
            raise ValueError(f"unknown check {c.check!r}")
        items.append(F.when(cond, F.struct(F.lit(i).alias("id"), val.alias("v"))))
    e = df.select(F.explode(F.filter(F.array(*items), lambda x: x.isNotNull())).alias("x")).select("x.id", "x.v")
    per_value = e.groupBy("id", "v").agg(F.count(F.lit(1)).alias("n"))
    per_check = per_value.groupBy("id").agg(
        F.sum("n").alias("rows"), F.count_if(F.col("n") > 1).alias("repeated"), F.count(F.lit(1)).alias("values"))
    meta = df.sparkSession.createDataFrame(
        [(i, model, c.check, c.column) for i, c in enumerate(cs)], "id int, model string, check string, column string")
    failures = (F.when(F.col("check") == "not_null", F.col("rows"))
                 .when(F.col("check") == "unique", F.col("repeated"))
                 .otherwise(F.col("values")))
    return (meta.join(per_check, "id", "left")
                .select("model", "check", "column", F.coalesce(failures, F.lit(0)).cast("bigint").alias("failures")))


def run_checks(tables: Mapping[str, DataFrame], checks: Sequence[Check] = DEFAULT_CHECKS) -> DataFrame:
    """Report ``(model, check, column, failures)`` for every check whose model is given.

    Failures: NULL rows (not_null), repeated values (unique), distinct unaccepted
    values (accepted_values). Each table is read once for all of its checks.
    """
    by_model: dict[str, list[Check]] = {}
    for c in checks:
        if c.model in tables:
            by_model.setdefault(c.model, []).append(c)
    if not by_model:
        raise ValueError("no checks apply to the given tables")
    parts = [_table_report(m, tables[m], cs) for m, cs in by_model.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def observe_not_null(df: DataFrame, model: str, checks: Sequence[Check]):
    """Attach the not-null checks of ``model`` to ``df`` as an ``Observation``.

    The counts are gathered while ``df`` is computed for something else (e.g. the
    dimension build), so a table that is expensive to produce (staging parses every
    document) is not produced a second time just to be checked. Returns the observed
    frame, the observation and the checks it covers.
    """
    from pyspark.sql import Observation
    nn = [c for c in checks if c.model == model and c.check == "not_null"]
    if not nn:
        return df, None, []
    obs = Observation(f"checks_{model}")
    aggs = [F.count_if(F.col(c.column).isNull()).alias(f"c{i}") for i, c in enumerate(nn)]
    return df.observe(obs, *aggs), obs, nn


def _counts(spark, rows) -> DataFrame:
    return spark.createDataFrame(rows, "model string, check string, column string, failures bigint")


def observed_report(spark, obs, nn: Sequence[Check], df: DataFrame) -> DataFrame:
    """Report rows for checks gathered by ``observe_not_null`` (after the observed job ran).

    A count that is missing (the optimiser took the observed part out of the plan) is no pass:
    it is taken again from ``df``.
    """
    return _counts(spark, [(c.model, c.check, c.column, observed(obs, f"c{i}", lambda c=c: check_not_null(df, c.column).count()))
                           for i, c in enumerate(nn)])


def counted_report(spark, nn: Sequence[Check], nulls: Mapping[str, int]) -> DataFrame:
    """Report rows for not-null checks from null counts by column (``streaming.latest.null_counts``, which fails where counts
    of staged rows are missing); only a table that never held a row has none."""
    missing = [c.column for c in nn if nulls and c.column not in nulls]
    if missing:
        raise ValueError(f"no null counts for {missing}")
    return _counts(spark, [(c.model, c.check, c.column, nulls.get(c.column, 0)) for c in nn])


def assert_checks(report: DataFrame) -> None:
    """Raise if any check failed. The report has one row per check, so collecting it is bounded."""
    bad = [r for r in report.where(F.col("failures") > 0).collect()]
    if bad:
        msg = "; ".join(f"{r['model']}.{r['column']} {r['check']}: {r['failures']}" for r in bad)
        raise AssertionError(f"data checks failed: {msg}")
