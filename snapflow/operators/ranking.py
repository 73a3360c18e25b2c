"""Rank within a group, descending, NULLs first, gaps after ties.

``strategy="window"`` is the plain ``rank()`` window: one task sorts each whole group.
That is fine while groups are small, but the daily rank groups by day, and one day
holds every entity of that day, so the group grows with the data.

``strategy="split"`` computes the same ranks without ever sorting a whole group in one
task. It rests on ``rank = 1 + (rows ordered strictly before this one)``:

1. ``H`` = rows counted per ``(group, value)``: partial aggregation map-side, so a value
   shared by a third of all rows becomes one row before any shuffle.
2. ``H`` is range-partitioned by ``(group, value)`` into pieces of about equal size,
   whatever the width of the groups: a wide group spans many pieces, narrow ones share one.
3. Per ``(group, piece)``: the total count; a running sum over a group's pieces (at most
   one row a piece) gives the rows in all earlier pieces.
4. Inside each ``(group, piece)`` a running sum over ``H`` in value order gives the rows
   before each value in its piece, which holds at most a piece's share of ``H``.
5. ``rank = 1 + earlier pieces + earlier in piece``, joined back to the rows on
   ``(group, value)`` (null-safe). Adaptive execution splits a skewed join partition.

Building the frame runs no job. Steps 3 and 4 read one range exchange (its bounds are
sampled once, so both see the same pieces); a session that forbids reusing exchanges gets
the pieces from the checkpoint folder instead. Ranks are exact; only the sizes of the
pieces are approximate.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from snapflow.session import reliable_checkpoint


def rank_desc(df: DataFrame, group: str, value: str, out: str, strategy: str = "split",
              pieces: int | None = None, rank_input: DataFrame | None = None) -> DataFrame:
    """Add ``out`` = rank of ``value`` (descending, NULLs first) within ``group``.

    ``rank_input`` (split strategy): a narrower frame holding the same ``(group, value)``
    rows to rank from, e.g. the source before later windows; defaults to ``df``.
    """
    if strategy == "window":
        w = Window.partitionBy(group).orderBy(F.col(value).desc_nulls_first())
        return df.withColumn(out, F.rank().over(w).cast("bigint"))
    if strategy != "split":
        raise ValueError(f"unknown rank strategy {strategy!r}")
    src = df if rank_input is None else rank_input
    r = rank_table(src.select(group, value), group, value, out, pieces).select(
        F.col(group).alias("__rg"), F.col(value).alias("__rv"), out)
    cond = F.col(group).eqNullSafe(F.col("__rg")) & F.col(value).eqNullSafe(F.col("__rv"))
    return df.join(r, cond, "left").drop("__rg", "__rv")


def rank_table(df: DataFrame, group: str, value: str, out: str, pieces: int | None = None) -> DataFrame:
    """``(group, value, out)``: the rank of every distinct ``(group, value)``, counted over ``pieces`` ranges (as many
    as the session has shuffle partitions)."""
    conf = df.sparkSession.conf
    pieces = pieces or int(conf.get("spark.sql.shuffle.partitions"))
    order = F.col(value).desc_nulls_first()
    h = df.groupBy(group, value).agg(F.count(F.lit(1)).alias("__n"))
    h = h.repartitionByRange(pieces, F.col(group).asc_nulls_first(), order).withColumn("__p", F.spark_partition_id())
    if conf.get("spark.sql.exchange.reuse", "true") != "true":
        h = reliable_checkpoint(h)
    before = Window.unboundedPreceding, -1
    totals = h.groupBy(group, "__p").agg(F.sum("__n").alias("__t"))
    earlier = F.sum("__t").over(Window.partitionBy(group).orderBy("__p").rowsBetween(*before))
    offsets = totals.select(F.col(group).alias("__og"), F.col("__p").alias("__op"), F.coalesce(earlier, F.lit(0)).alias("__off"))
    within = F.sum("__n").over(Window.partitionBy(group, "__p").orderBy(order).rowsBetween(*before))
    local = h.select(group, "__p", value, F.coalesce(within, F.lit(0)).alias("__cum"))
    met = local.join(offsets, F.col(group).eqNullSafe(F.col("__og")) & (F.col("__p") == F.col("__op")))
    return met.select(group, value, (F.lit(1) + F.col("__off") + F.col("__cum")).cast("bigint").alias(out))
