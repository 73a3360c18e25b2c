import datetime as dt

from pyspark.sql import functions as F

from snapflow.functions.scalars import (any_not_null, delta, greatest_strict, growth_pct, retain_days,
                                        safe_ratio, tier, trend_indicator)
from snapflow.operators.metrics import POPULARITY_DEFAULT, POPULARITY_TIERS, USAGE_DEFAULT, USAGE_TIERS


def test_greatest_strict_is_null_when_any_side_null(spark):
    df = spark.createDataFrame([(1, 2), (None, 2), (3, None), (None, None)], "a bigint, b bigint")
    got = [r[0] for r in df.select(greatest_strict("a", "b")).collect()]
    assert got == [2, None, None, None]
    # Spark's own greatest skips NULLs, which is exactly what must not happen here
    assert [r[0] for r in df.select(F.greatest("a", "b")).collect()] == [2, 2, 3, None]


def test_safe_ratio_zero_and_null_denominators(spark):
    df = spark.createDataFrame([(10, 4), (10, 0), (10, None), (None, 5), (7, -1)], "n bigint, d bigint")
    got = [r[0] for r in df.select(safe_ratio("n", "d")).collect()]
    assert got == [2.5, 0.0, 0.0, None, 0.0]
    df2 = spark.createDataFrame([(7, 3), (1, 2000000), (2, 3), (5, 0)], "n bigint, d bigint")
    got = [r[0] for r in df2.select(safe_ratio("n", "d", scale=6)).collect()]
    assert got == [2.333333, 0.000001, 0.666667, 0.0]          # whole-number division: 6 places, half up


def test_tiers_inclusive_bounds_and_null(spark):
    vals = [None, 0, 4999, 5000, 14999, 15000, 29999, 30000, 10 ** 9]
    df = spark.createDataFrame([(v,) for v in vals], "s bigint")
    got = [r[0] for r in df.select(tier("s", POPULARITY_TIERS, POPULARITY_DEFAULT)).collect()]
    assert got == ["Emerging", "Emerging", "Emerging", "Moderate", "Moderate", "Popular", "Popular",
                   "Very Popular", "Very Popular"]
    vals = [None, 99999, 100000, 999999, 1000000, 9999999, 10000000]
    df = spark.createDataFrame([(v,) for v in vals], "m bigint")
    got = [r[0] for r in df.select(tier("m", USAGE_TIERS, USAGE_DEFAULT)).collect()]
    assert got == ["Minimal Usage", "Minimal Usage", "Low Usage", "Low Usage", "Medium Usage", "Medium Usage",
                   "High Usage"]


def test_growth_indicator_delta(spark):
    df = spark.createDataFrame([(110, 100, 105.0), (90, 0, 90.0), (5, None, None), (None, 4, 4.0)],
                               "c bigint, p bigint, a double")
    out = df.select(growth_pct("c", "p").alias("g"), trend_indicator("c", "a").alias("t"),
                    delta("c", "p").alias("d")).collect()
    assert [r.g for r in out] == [10.0, 0.0, 0.0, None]     # NULL current stays NULL
    assert [r.t for r in out] == ["Above Average", "Average", "Average", "Average"]
    assert [r.d for r in out] == [10, 90, 5, None]


def test_any_not_null_and_retention(spark):
    df = spark.createDataFrame([("a", None), (None, None), (None, "b")], "x string, y string")
    assert df.where(any_not_null("x", "y")).count() == 2
    as_of = dt.date(2024, 4, 30)
    days = [as_of - dt.timedelta(days=90), as_of - dt.timedelta(days=91), None, as_of]
    d = spark.createDataFrame([(x,) for x in days], "d date")
    kept = sorted(r.d for r in retain_days(d, "d", as_of, 90).collect())
    assert kept == [as_of - dt.timedelta(days=90), as_of]


def test_with_audit_literal_and_current(spark):
    from snapflow.functions.scalars import with_audit
    df = spark.range(2)
    assert {r.built for r in with_audit(df, "built", dt.datetime(2024, 2, 1, 3)).collect()} == {dt.datetime(2024, 2, 1, 3)}
    assert with_audit(df, "built").schema["built"].dataType.simpleString() == "timestamp_ntz"


def test_ts_literal_zones(spark):
    from snapflow.functions.scalars import ts_literal
    aware = dt.datetime(2024, 1, 1, 12, 0, tzinfo=dt.timezone(dt.timedelta(hours=2)))
    got = spark.range(1).select(ts_literal(aware).alias("a"), ts_literal(dt.datetime(2024, 1, 1, 12)).alias("b"),
                                ts_literal("2024-01-01 05:06:07").alias("c")).collect()[0]
    assert (got.a, got.b, got.c) == (dt.datetime(2024, 1, 1, 10), dt.datetime(2024, 1, 1, 12),
                                     dt.datetime(2024, 1, 1, 5, 6, 7))
