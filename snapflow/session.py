"""Session defaults and the shared storage root.

The storage root is where lineage is cut and intermediate tables are written.
On a cluster it is ``spark.checkpoint.dir`` (a shared, reliable folder named by the
cluster); only when the session has none (local tests) do we pick one ourselves.
"""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid
from concurrent.futures import ThreadPoolExecutor

from py4j.protocol import Py4JError
from pyspark.sql import SparkSession

_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
    # A document that names a key twice is read as the fetchers read it: the last value holds.
    "spark.sql.variant.allowDuplicateKeys": "true",
    # Small floor for AQE-coalesced partitions: keeps several writer tasks for the small
    # day-partitioned tables of local runs; large shuffles are unaffected (they are far
    # above the floor and sized by spark.sql.shuffle.partitions / advisory size).
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "16k",
}


def get_spark(master: str = "local[*]", shuffle_partitions: int = 8, app: str = "snapflow",
              extra: dict | None = None) -> SparkSession:
    b = SparkSession.builder.master(master).appName(app)
    conf = dict(_DEFAULTS)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf["spark.ui.enabled"] = "false"
    conf["spark.cleaner.referenceTracking.cleanCheckpoints"] = "true"    # checkpoints go with their frames
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    apply_defaults(spark)
    return spark


def apply_defaults(spark: SparkSession) -> None:
    """Set the session defaults the operators rely on (UTC wall clock, the last of repeated JSON keys). Partition
    overwrite modes are passed per write, never set session-wide."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.variant.allowDuplicateKeys", "true")
    # List partition folders of day-partitioned tables with one task per core, not one per folder.
    spark.conf.set("spark.sql.sources.parallelPartitionDiscovery.parallelism",
                   str(max(1, spark.sparkContext.defaultParallelism)))


def storage_root(spark: SparkSession) -> str:
    """Shared folder for checkpoints and working tables.

    Read from ``spark.checkpoint.dir``. Only a local session (tests), whose executors are
    this process, gets a folder of its own when none is set, deleted when the process
    ends; on a cluster a missing setting is an error, as executors would not share it.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        d = spark.sparkContext.getCheckpointDir()
    if not d:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise ValueError(f"spark.checkpoint.dir must name a shared folder (master {master})")
        d = tempfile.mkdtemp(prefix="snapflow-ckpt-", dir=os.environ.get("SNAPFLOW_TMP", "/tmp"))
        atexit.register(shutil.rmtree, d, ignore_errors=True)
        spark.conf.set("spark.checkpoint.dir", d)
    sc_dir = spark.sparkContext.getCheckpointDir()
    if not sc_dir:
        spark.sparkContext.setCheckpointDir(d)
    return d.rstrip("/")


_scratch: list[str] = []


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the storage root (never a machine-local folder on a cluster)."""
    path = f"{storage_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"
    _scratch.append(path)
    return path


def release_scratch(spark: SparkSession, *paths: str) -> None:
    """Delete working tables that a finished run no longer reads (all of this process if none are named)."""
    for p in paths or tuple(_scratch):
        delete_path(spark, p)
        if p in _scratch:
            _scratch.remove(p)


def _file_system(spark: SparkSession, path: str):
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop, hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def path_exists(spark: SparkSession, path: str) -> bool:
    p, fs = _file_system(spark, path)
    return fs.exists(p)


def list_names(spark: SparkSession, path: str) -> list[str]:
    p, fs = _file_system(spark, path)
    return [f.getPath().getName() for f in fs.listStatus(p)] if fs.exists(p) else []


def make_path(spark: SparkSession, path: str) -> None:
    p, fs = _file_system(spark, path)
    fs.mkdirs(p)


def delete_path(spark: SparkSession, path: str) -> None:
    p, fs = _file_system(spark, path)
    fs.delete(p, True)


def move_path(spark: SparkSession, source: str, target: str) -> None:
    """Rename within one file system; the target must not exist."""
    p, fs = _file_system(spark, source)
    to, _ = _file_system(spark, target)
    if fs.exists(to) or not fs.rename(p, to):
        raise OSError(f"cannot move {source} to {target}")


def observed(observation, name: str, recount) -> int:
    """A count gathered by an ``Observation``, or counted again where the optimiser took the observed part out of the
    plan (then the metric doesn't exist, which is no zero)."""
    try:
        value = observation.get.get(name)
    except (Py4JError, AssertionError):
        value = None
    return int(recount() if value is None else value)


def reliable_checkpoint(df, eager: bool = True):
    """``df.checkpoint()`` into the shared checkpoint folder (set from the session first)."""
    storage_root(df.sparkSession)
    return df.checkpoint(eager=eager)


def reliable_checkpoints(*frames) -> list:
    """Checkpoint frames that don't depend on each other side by side (each may be too narrow to fill the cluster)."""
    storage_root(frames[0].sparkSession)
    with ThreadPoolExecutor(len(frames)) as pool:
        return list(pool.map(reliable_checkpoint, frames))


#: Source rows that one task makes documents of.
DEALT_ROWS = 250_000


def deal_rows(df, *keys: str, rows: int = DEALT_ROWS):
    """Spread a source scan for work that makes every row much larger (building documents).

    A scan is cut by bytes, and a row group of a file is read by one task: a few bytes a row and a million rows a row
    group leave most tasks without rows and the others with millions. So the rows are counted (file footers, unless
    ``df`` is filtered) and, beyond ``rows``, dealt by ``keys`` before they grow: ``rows`` a task at most on average, and
    every core as many tasks as the others.
    """
    if df.isStreaming:
        return df
    n = df.count()
    if n <= rows:
        return ensure_parallelism(df)
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores * -(-n // (rows * cores)), *keys)


def ensure_parallelism(df, min_partitions: int | None = None):
    """Spread ``df`` over at least the cluster's default parallelism before CPU-heavy
    per-row work (JSON parsing, document building).

    Call it on a source scan: asking a frame that contains a shuffle for its partition
    count would make adaptive execution run that shuffle stage first.

    Large inputs already arrive in many splits and are returned unchanged (no shuffle).
    Inputs with fewer partitions than cores (a small file with one row group) get a
    round-robin repartition; Spark sorts before round-robin so a retried task sees the
    same rows (deterministic under executor loss).
    """
    if df.isStreaming:
        return df
    target = min_partitions or df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() < target:
        return df.repartition(target)
    return df
