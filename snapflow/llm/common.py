"""Small helpers shared by the training-data operators (Arrow buffers, blocks, tables)."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

from snapflow.session import ensure_parallelism


def table(spark: SparkSession, sf_dir: str, name: str, *cols: str) -> DataFrame:
    """The named columns of an input table, spread over the cluster if it came in too few splits."""
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return ensure_parallelism(df.select(*cols) if cols else df)


def partitions(df: DataFrame) -> int:
    """Partition count for the exchanges of this session."""
    return max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")),
               df.sparkSession.sparkContext.defaultParallelism)


def some_rows(df: DataFrame, n: int, size: int) -> DataFrame:
    """About ``size`` of the ``n`` rows of a stored frame (all if there are no more), at most a tenth over."""
    return df if n <= size else df.sample(size / n, seed=1).limit(size + size // 10)


def utf8(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """A string or binary column as (all bytes, offsets of rows); null reads as empty."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if col.null_count:
        col = pc.fill_null(col, "" if pa.types.is_string(col.type) or pa.types.is_large_string(col.type) else b"")
    wide = pa.types.is_large_string(col.type) or pa.types.is_large_binary(col.type)
    n = len(col)
    if not n:
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    _, off, data = col.buffers()
    offsets = np.frombuffer(off, np.int64 if wide else np.int32)[col.offset:col.offset + n + 1].astype(np.int64)
    if data is None:
        return np.empty(0, np.uint8), np.zeros(n + 1, np.int64)
    return np.frombuffer(data, np.uint8)[offsets[0]:offsets[-1]], offsets - offsets[0]


def pieces(offsets: np.ndarray, limit: int):
    """Row ranges (lo, hi) whose bytes stay near ``limit`` (one row may exceed it)."""
    lo, n = 0, len(offsets) - 1
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + limit, side="right")) - 1)
        yield lo, min(hi, n)
        lo = min(hi, n)


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit mixer (xor-shift and multiply), element-wise."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    return x


def lower_ascii(b: np.ndarray) -> np.ndarray:
    """Bytes with A-Z lower-cased, others unchanged."""
    return np.where((b >= 65) & (b <= 90), b + np.uint8(32), b)
