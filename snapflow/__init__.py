"""snapflow: periodic JSON snapshots of many entities -> analytics tables, on Spark.

Every public operator takes DataFrames and column names and returns a DataFrame;
nothing is collected to the driver and time (``as_of``, ``now``) is always a parameter.
"""

from snapflow.session import get_spark, storage_root

__all__ = ["get_spark", "storage_root"]
