"""Join helpers: broadcast only behind a size check, otherwise a shuffled join."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def small_enough(df: DataFrame, max_rows: int) -> bool:
    """True when ``df`` has at most ``max_rows`` rows.

    Runs ``limit(max_rows + 1).count()``: the scan stops early, so the check costs at most
    ``max_rows + 1`` rows however large ``df`` is.
    """
    return df.limit(max_rows + 1).count() <= max_rows


def semi_reduce(big: DataFrame, big_key: str, keys: DataFrame, key: str, max_rows: int,
                known_small: bool | None = None) -> DataFrame:
    """Keep rows of ``big`` whose key appears in ``keys``.

    The key set is broadcast (so the filter runs map-side, below any shuffle of ``big``)
    only if ``keys`` has at most ``max_rows`` rows (so at most that many distinct keys);
    otherwise the same semi-join runs without a hint: the rows that go no further are
    dropped before they are sorted, and adaptive execution picks the join.
    ``known_small`` passes a check already made on ``keys``.
    """
    small = known_small if known_small is not None else bool(max_rows) and small_enough(keys, max_rows)
    k = keys.select(F.col(key).alias("__k")).where(F.col("__k").isNotNull()).distinct()
    # Null-safe match: same rows as ``=`` here (the key set has no NULL), but it implies
    # no ``isnotnull(key)`` constraint, so Catalyst does not push a copy of the key's
    # (JSON-parsing) expression into the scan filter; the document is parsed once.
    return big.join(F.broadcast(k) if small else k, F.col(big_key).eqNullSafe(F.col("__k")), "left_semi")
