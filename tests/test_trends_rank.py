import datetime as dt
import random

from pyspark.sql import functions as F

from snapflow.operators.ranking import rank_desc
from snapflow.operators.trends import TRENDS_COLUMNS, build_trends
from tests.conftest import rows

D0 = dt.date(2024, 1, 1)


def _snap(spark, data):
    return spark.createDataFrame(data, "technology_name string, snapshot_date date, github_stars bigint, "
                                       "github_forks bigint, pypi_downloads_daily bigint")


def test_trends_frames_count_rows_not_days(spark):
    data = []
    for i in range(40):                       # 40 snapshots with gaps (every other day)
        data.append(("a", D0 + dt.timedelta(days=2 * i), 100 + i, 1, 10 * (i + 1)))
    for i in range(3):                        # fewer than 7 snapshots
        data.append(("b", D0 + dt.timedelta(days=i), 5, 1, 0))
    data.append(("b", None, 999, 1, 1))       # undated row: sorts last, dropped by retention
    out = build_trends(_snap(spark, data), as_of=D0 + dt.timedelta(days=200), days=None)
    assert out.columns == TRENDS_COLUMNS
    a = {r.snapshot_date: r for r in out.where("technology_name = 'a'").collect()}
    r7 = a[D0 + dt.timedelta(days=2 * 7)]      # 8th row: lag 7 = first row
    assert r7.stars_7day_growth_pct == (107 - 100) / 100 * 100
    assert r7.stars_7day_avg == sum(range(101, 108)) / 7
    r0 = a[D0]
    assert (r0.stars_7day_avg, r0.stars_7day_growth_pct, r0.stars_trend_indicator) == (100.0, 0.0, "Average")
    r39 = a[D0 + dt.timedelta(days=78)]
    assert r39.stars_30day_avg == sum(range(110, 140)) / 30
    assert r39.stars_30day_growth_pct == (139 - 109) / 109 * 100
    assert r39.stars_trend_indicator == "Above Average"
    b = [r for r in out.where("technology_name = 'b'").collect() if r.snapshot_date is not None]
    assert all(r.stars_7day_avg == 5.0 and r.downloads_7day_growth_pct == 0.0 for r in b)


def test_retention_after_windows(spark):
    data = [("a", D0 + dt.timedelta(days=i), 10 * (i + 1), 1, 1) for i in range(100)]
    as_of = D0 + dt.timedelta(days=99)
    out = build_trends(_snap(spark, data), as_of=as_of, days=90)
    dates = sorted(r.snapshot_date for r in out.collect())
    assert dates[0] == as_of - dt.timedelta(days=90) and len(dates) == 91
    first = out.where(F.col("snapshot_date") == as_of - dt.timedelta(days=90)).collect()[0]
    assert first.stars_7day_growth_pct != 0.0    # look-back used rows cut by retention


def test_rank_ties_gaps_and_nulls_first(spark):
    df = spark.createDataFrame([("d", 5), ("d", 9), ("d", 9), ("d", None), ("d", 1), ("e", 3), (None, 2)],
                               "g string, v bigint")
    for strategy in ("window", "split"):
        got = rows(rank_desc(df, "g", "v", "r", strategy=strategy), "g", "v", "r")
        assert got == [("d", 1, 5), ("d", 5, 4), ("d", 9, 2), ("d", 9, 2), ("d", None, 1), ("e", 3, 1),
                       (None, 2, 1)], strategy


def test_split_rank_equals_window_on_skewed_data(spark):
    rnd = random.Random(7)
    data = []
    for i in range(4000):                     # one hot day with a third+ of the rows, many ties
        g = "hot" if i % 2 == 0 else f"g{i % 13}"
        v = None if i % 97 == 0 else (0 if i % 5 == 0 else rnd.randint(0, 300))
        data.append((g, v, i))
    df = spark.createDataFrame(data, "g string, v bigint, id bigint")
    a = rows(rank_desc(df, "g", "v", "r", strategy="window"), "id", "r")
    b = rows(rank_desc(df, "g", "v", "r", strategy="split", pieces=40), "id", "r")
    assert a == b
    from snapflow.operators.ranking import rank_table
    for cap in (1, 30, 300):                  # one piece, some, about as many as values
        t = rank_table(df.select("g", "v"), "g", "v", "r", pieces=cap)
        c = rows(df.join(t, (df.g.eqNullSafe(t.g)) & (df.v.eqNullSafe(t.v))).select("id", "r"), "id", "r")
        assert a == c, cap


def _final_plan(df) -> str:
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_one_wide_day_is_counted_in_pieces(spark):
    """A table of one day: its values go over all pieces, which are read from one exchange; no job while building."""
    from snapflow.operators.ranking import rank_table
    rnd = random.Random(3)
    day = spark.createDataFrame([("d", None if i % 50 == 0 else rnd.choice((7, rnd.randint(0, 900))), i) for i in range(3000)],
                                "g string, v bigint, id bigint").repartition(5)
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("ranks", "building")
    got = rank_table(day, "g", "v", "r", pieces=16)
    assert not tracker.getJobIdsForGroup("ranks")
    spark.sparkContext.setJobGroup("other", "running")
    plan = _final_plan(got)
    assert "ReusedExchange" in plan and "rangepartitioning" in plan and "percentile" not in plan and "bounds" not in plan
    assert rows(rank_desc(day, "g", "v", "r", pieces=16), "id", "r") == rows(rank_desc(day, "g", "v", "r", strategy="window"), "id", "r")
    spread = day.groupBy("g", "v").count().repartitionByRange(16, F.col("g").asc_nulls_first(), F.col("v").desc_nulls_first())
    sizes = spread.groupBy(F.spark_partition_id()).count().collect()
    assert len(sizes) >= 12 and max(r["count"] for r in sizes) < 200


def test_pieces_without_reused_exchanges(spark):
    df = spark.createDataFrame([("d", i * 7 % 100) for i in range(500)], "g string, v bigint")
    want = rows(rank_desc(df, "g", "v", "r", strategy="window"))
    spark.conf.set("spark.sql.exchange.reuse", "false")
    try:
        assert rows(rank_desc(df, "g", "v", "r", pieces=9)) == want
    finally:
        spark.conf.unset("spark.sql.exchange.reuse")
