"""Latest row per key, maintained incrementally from a landing folder.

The batch job recomputes "latest row per key" over every raw row ever landed. As a
stream, newly landed files are read once (the checkpoint records which files were
processed, so a rerun never double counts) and staged; a micro-batch is reduced to its
latest row per key (``max_by(row, order_key)``, combined before the shuffle, so a key that
receives a third of all documents still sends one row per task) and merged into a table
of one row per key. The table is partitioned by key bucket: only buckets that the
micro-batch holds keys of are read and overwritten, by one write job, and readers take
the rows as they stand, without a window.

The same pass over a micro-batch counts its rows and the nulls of every staged column; a
ledger beside the table adds them up over all rows ever staged, which is what checks of
the staged rows need. It holds the totals after the last micro-batch and those before it,
however many there were.

``trigger(availableNow=True)`` processes everything landed since the last run and
stops: the daily schedule of the original job, with exactly-once progress tracking.
A micro-batch replayed after a failure merges rows that are there already and adds its
counts to the totals before it, so replays are harmless.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StringType, StructField, StructType, TimestampNTZType, VariantType

from snapflow.operators.latest import total_tiebreak
from snapflow.session import observed, reliable_checkpoint
from snapflow.sources import sinks


LEDGER = "epoch bigint, column string, nulls bigint"
#: The ledger's row count goes by this name.
ROWS = "*"
#: Buckets of a new table: one for every 256 MB or so that it will hold.
BUCKETS = 16


def landing_schema(key: str, doc_type: str = "string") -> StructType:
    """Schema of a landing folder: documents stored as text (default) or as VARIANT."""
    doc = VariantType() if doc_type == "variant" else StringType()
    return StructType([StructField("extracted_at", TimestampNTZType()), StructField(key, StringType()),
                       StructField("raw_data", doc)])


def latest_order_key(order_col: str, tiebreak: Sequence[str] = ()) -> Column:
    """Ordering value for ``max_by`` equal to ``ORDER BY order_col DESC NULLS FIRST, tiebreak…``.

    ``max_by`` ignores NULL ordering values, so NULL-ness is made an explicit leading
    field: ``(is_null, value)`` compares greatest for a NULL value, as the warehouse orders.
    """
    parts = []
    for c in (order_col, *tiebreak):
        parts += [F.col(c).isNull().alias(f"{c}__null"), F.col(c).alias(c)]
    return F.struct(*parts)


def _no_variant(df: DataFrame) -> DataFrame:
    """The log keeps plain types (VARIANT can't be ordered): render VARIANT columns as JSON text."""
    return df.withColumns({f.name: F.to_json(F.col(f.name)) for f in df.schema.fields
                           if isinstance(f.dataType, VariantType)})


def _newest(rows: DataFrame, key: str, order: Column) -> DataFrame:
    return rows.groupBy(key).agg(F.max_by(F.struct(*rows.columns), order).alias("__row")).select("__row.*")


def stream_latest(spark: SparkSession, landing_path: str, key: str, out_path: str, checkpoint: str,
                  stage: Callable[[DataFrame], DataFrame], order_col: str = "extracted_at",
                  tiebreak: Sequence[str] | None = (), available_now: bool = True,
                  doc_type: str = "string", max_files_per_batch: int | None = 1000, buckets: int = BUCKETS) -> StreamingQuery:
    """``tiebreak=None``: every atomic column (deterministic). ``doc_type="variant"`` for folders landed with
    ``land_raw(as_variant=True)``. ``max_files_per_batch`` bounds each micro-batch, so a first run over a large backlog
    proceeds in bounded batches (``availableNow`` still processes all of it). ``buckets`` holds for a new table; one that
    exists keeps its own number."""
    reader = spark.readStream.schema(landing_schema(key, doc_type))
    if max_files_per_batch:
        reader = reader.option("maxFilesPerTrigger", max_files_per_batch)

    def fold(batch: DataFrame, epoch_id: int) -> None:
        staged = _no_variant(stage(batch))
        ties = total_tiebreak(staged, [key, order_col]) if tiebreak is None else tiebreak
        seen = Observation()
        counts = [F.count(F.lit(1)).alias(ROWS), *[F.count_if(F.col(c).isNull()).alias(c) for c in staged.columns]]
        newest = _newest(staged.observe(seen, *counts), key, latest_order_key(order_col, ties))
        newest = reliable_checkpoint(newest.withColumn("__epoch", F.lit(epoch_id).cast("bigint")))
        got = {ROWS: observed(seen, ROWS, staged.count)}
        got |= {c: observed(seen, c, lambda c=c: staged.where(F.col(c).isNull()).count()) for c in staged.columns}
        _merge(spark, out_path, newest, key, [order_col, *ties], buckets)
        _count(spark, ledger_path(out_path), epoch_id, got)

    w = reader.parquet(landing_path).writeStream.foreachBatch(fold).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()


def _bucketed(rows: DataFrame, key: str, buckets: int) -> DataFrame:
    return rows.withColumn("bucket", F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int"))


def _merge(spark: SparkSession, out_path: str, newest: DataFrame, key: str, order: Sequence[str], buckets: int) -> None:
    """Merge one row per key into the table; later micro-batches win on equal ordering."""
    by = latest_order_key(order[0], [*order[1:], "__epoch"])
    old = sinks.read_table(spark, out_path)
    if old is None or "bucket" not in old.columns:                      # new, or a log of micro-batches
        whole = newest if old is None else _newest(newest.unionByName(old), key, by)
        sinks.write_table(_bucketed(whole, key, buckets), out_path, ["bucket"])
        sinks.write_note(spark, out_path, {"buckets": buckets})
        return
    note = sinks.read_note(spark, out_path)
    if note is None:                                                    # stopped right after the first write: deal anew
        sinks.write_table(_bucketed(_newest(newest.unionByName(old.drop("bucket")), key, by), key, buckets), out_path, ["bucket"])
        sinks.write_note(spark, out_path, {"buckets": buckets})
        return
    buckets = note["buckets"]
    newest = _bucketed(newest, key, buckets)
    touched = [r[0] for r in newest.select("bucket").distinct().collect()]       # at most as many as there are buckets
    if touched:
        merged = _newest(newest.unionByName(old.where(F.col("bucket").isin(touched))), key, by)
        sinks.overwrite_partitions(merged, out_path, "bucket")


def ledger_path(out_path: str) -> str:
    return out_path.rstrip("/") + "_ledger"


def _count(spark: SparkSession, ledger: str, epoch: int, counts: dict[str, int]) -> None:
    """Put the totals after micro-batch ``epoch`` beside those before it."""
    old = sinks.read_table(spark, ledger)
    kept = [] if old is None else [r for r in old.collect() if r["epoch"] < epoch]      # two rows a column
    before = [r for r in kept if r["epoch"] == max(k["epoch"] for k in kept)]
    totals = {r["column"]: r["nulls"] for r in before}
    now = [(epoch, c, totals.get(c, 0) + n) for c, n in counts.items()]
    now += [(epoch, c, n) for c, n in totals.items() if c not in counts]
    sinks.write_table(spark.createDataFrame([tuple(r) for r in before] + now, LEDGER).coalesce(1), ledger)


def null_counts(spark: SparkSession, out_path: str) -> dict[str, int]:
    """Nulls of each staged column over all rows ever staged, and under ``ROWS`` the number of these; empty before the first
    row. A ledger that is missing or counts fewer rows than the table holds is an error."""
    table, ledger = sinks.read_table(spark, out_path), sinks.read_table(spark, ledger_path(out_path))
    rows = [] if ledger is None else ledger.collect()
    got = {r["column"]: r["nulls"] for r in rows if r["epoch"] == max(k["epoch"] for k in rows)}
    keys = 0 if table is None else table.count()
    if got.get(ROWS, 0) < keys:
        raise ValueError(f"{ledger_path(out_path)} counts {got.get(ROWS, 'no')} rows, the table holds {keys} keys")
    return got


def read_latest(spark: SparkSession, out_path: str, schema: StructType | None = None) -> DataFrame:
    """Newest row per key. ``schema`` is that of the staged rows: its VARIANT columns are read back from their text."""
    latest = sinks.read_table(spark, out_path).drop("bucket", "__epoch")
    variants = [f.name for f in schema.fields if isinstance(f.dataType, VariantType)] if schema else []
    return latest.withColumns({c: F.parse_json(F.col(c)) for c in variants})
