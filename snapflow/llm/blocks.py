"""Packed blocks that pieces of the input and hash parts send each other through ordinary exchanges.

A row is (key, kind, src, data): the exchange deals rows by key and sorts them by (key, kind, src), so a task
sees each key's rows together and in order. Data are arrays, compressed.
"""

from __future__ import annotations

import pickle

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame

ROWS = "key long, kind int, src long, data binary"
#: Kinds of rows: a piece's text, a question to a part, its answer to a piece.
TEXT, ASK, ANSWER = 0, 1, 2


def pack(*values, level: int = 6) -> bytes:
    return zstandard.ZstdCompressor(level=level).compress(pickle.dumps(values, protocol=5))


def unpack(blob: bytes) -> tuple:
    return pickle.loads(zstandard.ZstdDecompressor().decompress(blob))


def planes(a: np.ndarray) -> np.ndarray:
    """Numbers as byte planes, which compress where high bytes repeat."""
    return np.ascontiguousarray(a).view(np.uint8).reshape(-1, a.dtype.itemsize).T.copy()


def from_planes(p: np.ndarray, dtype) -> np.ndarray:
    return np.ascontiguousarray(p.T).view(dtype).ravel()


def ascending(a: np.ndarray) -> np.ndarray:
    """Ascending unsigned numbers as byte planes of their differences."""
    return planes(np.diff(a, prepend=a.dtype.type(0)))


def from_ascending(p: np.ndarray, dtype) -> np.ndarray:
    return np.cumsum(from_planes(p, dtype), dtype=dtype)


def rows(items: list[tuple]) -> pa.RecordBatch:
    """A batch of (key, kind, src, data) rows."""
    kinds = (pa.int64(), pa.int32(), pa.int64(), pa.binary())
    return pa.record_batch([pa.array(c, t) for c, t in zip(zip(*items, strict=True), kinds, strict=True)],
                           names=["key", "kind", "src", "data"])


def groups(batches):
    """(key, rows) of rows sorted by key, across Arrow batches; a row is (kind, src, data)."""
    now, found = None, []
    for batch in batches:
        for key, *row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if key != now and found:
                yield now, found
                found = []
            now = key
            found.append(row)
    if found:
        yield now, found


def exchange(df: DataFrame, n: int) -> DataFrame:
    return df.repartition(n, "key").sortWithinPartitions("key", "kind", "src")


def by_part(part: np.ndarray):
    """(part, its positions in order) for an array of part numbers."""
    if len(part):
        order = np.argsort(part, kind="stable")
        ids, first = np.unique(part[order], return_index=True)
        yield from zip(ids.tolist(), np.split(order, first[1:]), strict=True)
