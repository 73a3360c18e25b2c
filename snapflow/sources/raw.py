"""Raw snapshot tables: read (S1) and land.

A landing table is append-only ``(extracted_at timestamp_ntz, <key> string, raw_data)``
with many rows per key over time. ``raw_data`` is JSON text on disk (portable Parquet);
it becomes VARIANT on read, once per row.

A landing folder is a plain folder of files, or (``land_raw(by_day=True)``) is partitioned by
``outcome`` and, below it, by ``load_date``: documents that load and documents that were
rejected, with key and reason, come from one write job, and readers of one day (gate, stream)
list and open that day's files only.
"""

from __future__ import annotations

import logging
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from snapflow.functions.scalars import ts_literal
from snapflow.session import ensure_parallelism, list_names, make_path, observed, path_exists
from snapflow.sources.sinks import is_path

log = logging.getLogger(__name__)


#: Partition column of a landing folder by day, and what it says of its rows.
OUTCOME, LOADED, REJECTED, DAY = "outcome", "loaded", "rejected", "load_date"
#: Files that a task of a write by day keeps open, so that a batch of one or two days isn't sorted by folder.
WRITERS = 4


def landing_path(spark: SparkSession, source: str) -> str:
    """The folder that holds the loadable documents of a landing folder (made if only rejected ones came so far)."""
    if not is_path(source) or not any(n.startswith(f"{OUTCOME}=") for n in list_names(spark, source)):
        return source
    loaded = f"{source.rstrip('/')}/{OUTCOME}={LOADED}"
    if not path_exists(spark, loaded):
        make_path(spark, loaded)
    return loaded


def _read_folder(spark: SparkSession, source: str, outcome: str) -> DataFrame:
    path = f"{source.rstrip('/')}/{OUTCOME}={outcome}"
    return spark.read.option("basePath", source.rstrip("/")).parquet(path)


def read_raw(spark: SparkSession, source: str, key: str, doc_col: str = "raw_data",
             ts_col: str = "extracted_at") -> DataFrame:
    """Read a landing table by catalog name or Parquet path: the three landing columns, and ``load_date`` where the folder
    is partitioned by it."""
    loaded = landing_path(spark, source)
    if loaded != source:
        if not list_names(spark, loaded):
            return spark.createDataFrame([], f"extracted_at timestamp_ntz, `{key}` string, raw_data string, {DAY} date")
        df = _read_folder(spark, source, LOADED)
        return df.select(F.col(ts_col).alias("extracted_at"), F.col(key), F.col(doc_col).alias("raw_data"), F.col(DAY).cast("date").alias(DAY))
    df = spark.read.parquet(source) if ("/" in source or source.endswith(".parquet")) else spark.table(source)
    df = ensure_parallelism(df)     # a plain scan: checking its split count runs nothing
    return df.select(F.col(ts_col).alias("extracted_at"), F.col(key), F.col(doc_col).alias("raw_data"))


def read_rejected(spark: SparkSession, source: str, key: str) -> DataFrame | None:
    """``(extracted_at, <key>, reason, document)`` of every document that a landing folder by day did not load; None if
    there are none."""
    if not path_exists(spark, f"{source.rstrip('/')}/{OUTCOME}={REJECTED}"):
        return None
    return _read_folder(spark, source, REJECTED).select("extracted_at", key, "reason", F.col("rejected_doc").alias("document"))


def is_loadable(v: Column) -> Column:
    """A parsed document that is a non-empty JSON object (what the fetchers would have kept).

    Decided on the parsed value: white space around or inside the text doesn't matter.
    """
    return F.coalesce(F.size(F.try_variant_get(v, "$", "map<string,variant>")) > 0, F.lit(False))


def reject_reason(doc: Column, v: Column) -> Column:
    """Why a document (text, and parsed) doesn't load; null for one that does.

    What ``is_loadable`` says, without a map of every field of the document: only an object can be read as a struct, and
    the text of one without fields shows it (it has been parsed, so its first brace opens the object).
    """
    is_object = F.try_variant_get(v, "$", "struct<_:variant>").isNotNull()
    return (F.when(doc.isNull(), "no document").when(v.isNull(), "not JSON").when(~is_object, "not an object")
            .when(doc.rlike(r"^[^{]*\{\s*\}"), "empty object"))


def prepare_landing(df: DataFrame, key: str, doc_col: str, loaded_at, as_variant: bool = False) -> DataFrame:
    """Drop empty and non-JSON documents, stamp the load time; others still load.

    ``loaded_at`` is a literal timestamp (one value for the whole batch) or a Column.
    ``as_variant`` returns the parsed VARIANT instead of the text (for immediate use;
    landing tables store the text).
    """
    ts = ts_literal(loaded_at)
    v = F.try_parse_json(F.col(doc_col))
    return df.where(is_loadable(v)).select(
        ts.alias("extracted_at"),
        F.col(key).cast("string").alias(key),
        (F.parse_json(F.col(doc_col)) if as_variant else F.col(doc_col).cast("string")).alias("raw_data"),
    )


@dataclass
class LandResult:
    fetched: int
    loaded: int

    @property
    def rejected(self) -> int:
        return self.fetched - self.loaded


def land_raw(df: DataFrame, key: str, doc_col: str, target: str, loaded_at,
             fmt: str = "parquet", as_variant: bool = False, by_day: bool = False) -> LandResult:
    """Append valid documents to ``target`` (a path) in one write job.

    The write is one Spark job with a single job commit, so the batch lands all or
    nothing; a failed task is retried by Spark without duplicating output. Counts come
    from an ``Observation`` on the same job (the input is computed once). A batch without
    documents adds no rows, with a warning. ``as_variant`` stores the parsed VARIANT (Parquet) instead of the
    text, so staging reads documents without parsing them again; text is the portable
    default. ``by_day`` partitions the folder by outcome and load date and keeps rejected
    documents, as text with a reason, beside the loaded ones (``read_rejected``).
    """
    obs_in = Observation("fetched")
    counted = df.observe(obs_in, F.count(F.lit(1)).alias("n"))
    obs_out = Observation("loaded")
    if by_day:
        rows = _sorted_out(counted, key, doc_col, loaded_at, as_variant)
        rows = rows.observe(obs_out, F.count_if(F.col(OUTCOME) == LOADED).alias("n"))
        conf, name = df.sparkSession.conf, "spark.sql.maxConcurrentOutputFileWriters"
        before = conf.get(name)
        conf.set(name, str(max(int(before), WRITERS)))       # a session setting, no write option
        try:
            rows.write.mode("append").format(fmt).partitionBy(OUTCOME, DAY).save(target)
        finally:
            conf.set(name, before)
    else:
        rows = prepare_landing(counted, key, doc_col, loaded_at, as_variant=as_variant).observe(
            obs_out, F.count(F.lit(1)).alias("n"))
        rows.write.mode("append").format(fmt).save(target)
    # a count that the optimiser took out of the plan (an input known to be empty) is taken again
    fetched = observed(obs_in, "n", lambda: df.count())
    loaded = observed(obs_out, "n", lambda: prepare_landing(df, key, doc_col, loaded_at).count())
    if loaded == 0:
        log.warning("nothing to load into %s (%d fetched)", target, fetched)
    return LandResult(fetched, loaded)


def _sorted_out(df: DataFrame, key: str, doc_col: str, loaded_at, as_variant: bool) -> DataFrame:
    """Every fetched document as a row of a landing folder by day."""
    doc = F.col("__doc")
    rows = df.select(ts_literal(loaded_at).alias("extracted_at"), F.col(key).cast("string").alias(key),
                     F.col(doc_col).cast("string").alias("__doc"), F.try_parse_json(F.col(doc_col)).alias("__v"))
    rows = rows.withColumn("reason", reject_reason(doc, F.col("__v")))
    fine = F.col("reason").isNull()
    return rows.select("extracted_at", key, F.when(fine, F.col("__v") if as_variant else doc).alias("raw_data"), "reason",
                       F.when(~fine, doc).alias("rejected_doc"), F.when(fine, LOADED).otherwise(REJECTED).alias(OUTCOME),
                       F.to_date("extracted_at").alias(DAY))
