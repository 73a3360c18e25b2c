import datetime as dt
import os
import tempfile

from pyspark.sql import functions as F

from snapflow.plans import bridge as B
from snapflow.session import deal_rows, ensure_parallelism, reliable_checkpoint, storage_root
from snapflow.sources.sinks import as_view, write_table


def test_ensure_parallelism_spreads_only_narrow_inputs(spark):
    target = spark.sparkContext.defaultParallelism
    one = spark.range(100).coalesce(1)
    spread = ensure_parallelism(one)
    assert spread.rdd.getNumPartitions() == target
    assert sorted(r.id for r in spread.collect()) == list(range(100))
    wide = spark.range(100).repartition(target + 3)
    assert ensure_parallelism(wide) is wide


def test_documents_are_dealt_by_rows_not_by_row_groups(spark):
    """All rows in one row group, the file in more splits than cores: one task reads them, every task builds documents."""
    path = tempfile.mkdtemp(prefix="deal-", dir=os.environ.get("TMPDIR", "/tmp")) + "/events.parquet"
    eid = F.col("id")
    (spark.range(300_000).coalesce(1).select(
        eid.alias("event_id"), F.timestamp_seconds(eid).alias("ts"), (eid % 97).alias("user_id"), F.lit("view").alias("event_type"),
        F.lit(1.0).alias("value"), F.concat(F.lit('{"k":'), (eid % 11).cast("string"), F.lit("}")).alias("props")).write.parquet(path))
    name = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(name)
    spark.conf.set(name, "64k")
    try:
        events = spark.read.parquet(path)
        assert events.rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism
        docs = B.repo_documents(events, keep=("event_id",))
        per_task = [r["n"] for r in docs.groupBy(F.spark_partition_id()).agg(F.count(F.lit(1)).alias("n")).collect()]
        assert sum(per_task) == 300_000 and max(per_task) < 300_000 * 3 / spark.sparkContext.defaultParallelism
        assert docs.select("event_id").distinct().count() == 300_000
        few = spark.range(1000)
        assert deal_rows(few, "id").count() == 1000 and deal_rows(few, "id", rows=100).distinct().count() == 1000
    finally:
        spark.conf.set(name, before)


def test_write_table_partitioned_and_view(spark):
    path = tempfile.mkdtemp(prefix="sink-", dir=os.environ.get("TMPDIR", "/tmp")) + "/t"
    df = spark.createDataFrame([(dt.date(2024, 1, d % 3 + 1), d) for d in range(30)], "d date, v int")
    write_table(df, path, partition_by=["d"])
    write_table(df.where("v < 10"), path, partition_by=["d"])          # replace, not append
    back = spark.read.parquet(path)
    assert back.count() == 10
    assert {"d=2024-01-01", "d=2024-01-02", "d=2024-01-03"} <= set(os.listdir(path))
    as_view(back, "snapflow_test_view")
    assert spark.sql("select count(*) as n from snapflow_test_view").collect()[0].n == 10


def test_checkpoints_go_to_the_session_folder(spark):
    root = storage_root(spark)
    assert root and spark.conf.get("spark.checkpoint.dir")
    c = reliable_checkpoint(spark.range(5))
    assert c.count() == 5


def test_a_cluster_must_name_a_shared_folder(spark, monkeypatch):
    import types

    import pytest

    from snapflow import session
    context = types.SimpleNamespace(master="spark://host:7077", getCheckpointDir=lambda: None)
    other = types.SimpleNamespace(conf=types.SimpleNamespace(get=lambda k, d=None: d), sparkContext=context)
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.storage_root(other)
    context.master = "local-cluster[2,1,512]"
    with pytest.raises(ValueError):
        session.storage_root(other)


def test_scratch_is_deleted_when_released(spark):
    from snapflow.session import path_exists, release_scratch, scratch_path
    kept, gone = scratch_path(spark, "kept"), scratch_path(spark, "gone")
    for p in (kept, gone):
        spark.range(3).write.parquet(p)
    release_scratch(spark, gone)
    assert path_exists(spark, kept) and not path_exists(spark, gone)
    release_scratch(spark, kept)
    assert not path_exists(spark, kept)
