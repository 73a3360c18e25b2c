"""Latest row per key.

``row_number() = 1`` over ``partition by key order by ts desc`` is planned by Spark as a
``WindowGroupLimit``: a partial top-1 per key runs inside each map task before the
shuffle, so a key with a huge number of rows sends at most one row per map task across
the network. The final top-1 then runs per key after the shuffle.

Ordering follows the warehouse default: ``DESC`` puts NULLs **first**, so a row with a
NULL load time wins. Ties are broken by ``tiebreak`` columns (descending) so the choice
is deterministic.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import (BinaryType, BooleanType, DateType, DecimalType, DoubleType, FloatType,
                               IntegralType, StringType, TimestampNTZType, TimestampType)

_ORDERABLE = (StringType, IntegralType, DoubleType, FloatType, DecimalType, DateType, TimestampType,
              TimestampNTZType, BooleanType, BinaryType)


def total_tiebreak(df: DataFrame, exclude: Sequence[str]) -> list[str]:
    """Every atomic column not in ``exclude``: a deterministic tie-break when none is given.

    With it, rows tied on the ordering column resolve the same way on every run and on
    every task retry (a lost executor's recomputation picks the same row). Only rows
    equal in all atomic columns stay interchangeable.
    """
    return [f.name for f in df.schema.fields if f.name not in exclude and isinstance(f.dataType, _ORDERABLE)]


def _order(col: str, nulls_first: bool) -> Column:
    return F.col(col).desc_nulls_first() if nulls_first else F.col(col).desc_nulls_last()


def latest_per_key(df: DataFrame, key: str | Sequence[str], order_col: str,
                   tiebreak: Sequence[str] = (), nulls_first: bool = True) -> DataFrame:
    keys = [key] if isinstance(key, str) else list(key)
    w = Window.partitionBy(*keys).orderBy(
        _order(order_col, nulls_first), *[_order(t, nulls_first) for t in tiebreak]
    )
    rn = "__rn"
    return df.withColumn(rn, F.row_number().over(w)).where(F.col(rn) == 1).drop(rn)
