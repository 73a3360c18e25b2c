"""Physical-plan properties the design relies on (regression guards)."""

import datetime as dt
import os
import tempfile

from pyspark.sql import functions as F

from snapflow.operators.history import merge_frame
from snapflow.plans import queries as Q
from tests.conftest import plan_text

SF = "/root/testdata/sf0.001"


def _plan(df) -> str:
    df.sparkSession.conf.set("spark.sql.maxMetadataStringLength", "2000")     # partition filters in full
    return plan_text(df)


def test_dimension_partial_top1_and_single_parse(spark):
    plan = _plan(Q.QUERIES["dimension"](spark, SF))
    assert plan.count("WindowGroupLimit") >= 4            # partial + final for both sources
    assert "Partial" in plan and "LeftSemi" in plan       # semi-join reduction below the window
    lines = plan.splitlines()
    exch = next(i for i, l in enumerate(lines) if "Exchange hashpartitioning(repo_name" in l)
    semi = next(i for i, l in enumerate(lines) if "LeftSemi" in l)
    assert exch < semi                                    # filtered map-side, before the shuffle
    scans = [l for l in plan.splitlines() if "FileScan parquet" in l and ("events" in l or "orders" in l)]
    assert scans and all("parseJson" not in l for l in scans)   # no parse pushed into scan filters


def test_staging_reads_only_needed_columns(spark):
    plan = _plan(Q.QUERIES["latest_package"](spark, SF))
    scan = [l for l in plan.splitlines() if "FileScan parquet" in l and "orders" in l][0]
    assert "ReadSchema" in scan


def test_freshness_filter_reaches_the_scan(spark):
    plan = _plan(Q.QUERIES["fresh_counts"](spark, SF))
    scan = [l for l in plan.splitlines() if "FileScan parquet" in l and "events" in l][0]
    assert "PushedFilters: [IsNotNull(ts), GreaterThanOrEqual(ts" in scan


def test_merge_reads_only_touched_partitions(spark):
    p = tempfile.mkdtemp(prefix="plan-", dir=os.environ.get("TMPDIR", "/tmp")) + "/t"
    rows = [(dt.date(2024, 1, d), "a", d) for d in range(1, 10)]
    spark.createDataFrame(rows, "snapshot_date date, technology_name string, v int") \
        .write.partitionBy("snapshot_date").parquet(p)
    new = spark.createDataFrame([(dt.date(2024, 1, 5), "a", 50)], "snapshot_date date, technology_name string, v int")
    plan = _plan(merge_frame(spark.read.parquet(p), new))
    assert "PartitionFilters: [isnotnull(snapshot_date" in plan or "PartitionFilters: [(snapshot_date" in plan


def test_trends_windows_share_one_sort(spark):
    plan = _plan(Q.QUERIES["trends"](spark, SF))
    avg_windows = [l for l in plan.splitlines() if "Window [avg(" in l]
    assert len(avg_windows) == 1 and "lag(" in avg_windows[0]   # averages and look-backs in one Window node
    assert "WindowGroupLimit" in plan and ", 30, Partial" in plan   # bounded look-back: partial top-30 per task


def test_merge_of_many_dates_prunes(spark):
    p = tempfile.mkdtemp(prefix="plan-", dir=os.environ.get("TMPDIR", "/tmp")) + "/t"
    schema = "snapshot_date date, technology_name string, v int"
    spark.createDataFrame([(dt.date(2024, 1, d), "a", d) for d in range(1, 10)], schema) \
        .write.partitionBy("snapshot_date").parquet(p)
    new = spark.createDataFrame([(dt.date(2024, 1, d), "a", 50) for d in (4, 5)], schema)
    plan = _plan(merge_frame(spark.read.parquet(p), new, max_dates=1))
    scan = [line for line in plan.splitlines() if "FileScan parquet" in line][0]
    assert "snapshot_date#" in scan.split("PartitionFilters")[1] and ">= 2024-01-04" in scan and "<= 2024-01-05" in scan


def test_trends_over_partitioned_history_prunes(spark):
    from snapflow.operators.trends import build_trends, look_back_start
    p = tempfile.mkdtemp(prefix="plan-", dir=os.environ.get("TMPDIR", "/tmp")) + "/h"
    d0 = dt.date(2024, 1, 1)
    as_of = d0 + dt.timedelta(days=299)
    schema = "technology_name string, snapshot_date date, github_stars bigint, github_forks bigint, pypi_downloads_daily bigint"
    daily = [(e, d0 + dt.timedelta(days=d), d + 1, 1, 1) for e in ("a", "b") for d in range(300)]
    new = [("new", d0 + dt.timedelta(days=d), d + 1, 1, 1) for d in range(290, 300)]
    sparse = [("sparse", d0 + dt.timedelta(days=d), d + 1, 1, 1) for d in (0, 150, 299)]

    def trends(data):
        path = f"{p}{len(data)}"
        df = spark.createDataFrame(data, schema)
        df.write.partitionBy("snapshot_date").parquet(path)
        dates = F.sort_array(F.collect_set("snapshot_date"), asc=False)
        state = df.groupBy("technology_name").agg(F.min("snapshot_date").alias("first_snapshot_date"), F.slice(dates, 1, 150).alias("recent_dates"))
        back = look_back_start(state, as_of, 90)
        t = build_trends(spark.read.parquet(path), as_of=as_of, days=90, look_back=back)
        lows = [line.split("PartitionFilters")[1] for line in _plan(t).splitlines() if "FileScan parquet" in line]
        return t, back, lows

    # a new entity opens no older partitions: the look-back starts 30 days before the cut
    t, back, lows = trends(daily + new)
    start = as_of - dt.timedelta(days=90 + 30)
    assert back.start == start and back.deep is None
    assert lows and all(f">= {start}" in f or f">= {as_of - dt.timedelta(days=90)}" in f for f in lows)
    assert t.count() == 2 * 91 + 10
    # an entity that needs more is read in full, the others are not
    t, back, lows = trends(daily + new + sparse)
    assert back.start == start and [r[0] for r in back.deep.collect()] == ["sparse"]
    assert t.count() == 2 * 91 + 10 + 1


def test_previous_rows_are_joined_in_place(spark):
    """The bucketed latest table is neither shuffled nor, unless tiny, broadcast."""
    from snapflow.operators.history import history_rows, previous_rows, upsert_with_latest
    from tests.test_history import NOW, _metrics
    spark.sql("DROP DATABASE IF EXISTS bucket_test CASCADE")
    name, before = "bucket_test.h", spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    for n in range(2):
        m = _metrics(spark, [(f"e{i}", dt.date(2024, 1, 1 + n), i + n, 1, 1, 1) for i in range(50)])
        upsert_with_latest(spark, name, history_rows(m, None, now=NOW, previous=previous_rows(spark, name)))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        new = history_rows(m, None, now=NOW, previous=previous_rows(spark, name))
        plan = _plan(new)
        assert plan.count("Exchange hashpartitioning") == 1 and "SortMergeJoin" in plan        # the current metrics only
        scan = plan[:plan.index("FileScan parquet spark_catalog.bucket_test.h_latest")].splitlines()
        assert "Bucketed: true" in plan and not any("Exchange" in line for line in scan[-4:])
        assert {r.stars_change for r in new.collect()} == {0}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    spark.sql("DROP DATABASE bucket_test CASCADE")
