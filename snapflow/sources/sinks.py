"""Sinks (S10-S14): tables by path or catalog name, views, schema-qualified names.

A target with a ``/`` is a folder of Parquet files, any other a catalog table. A table that exists is replaced by writing
the new one beside it and swapping the two, so a stop at any point leaves a whole table: ``recover`` puts it back in place.

A folder whose columns have changed since it was first written holds a ``Layout``, a one-row table that readers of the folder
pass over: the columns as they are now and the name each bears in the files. Files of other times lack columns that came later (they read as null) and
hold columns that went (they are not read); a name that comes back gets a new one in the files, so old values stay gone.
"""

from __future__ import annotations

import datetime
import json
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, NullType, StructField, StructType

from snapflow.session import delete_path, list_names, make_path, move_path, path_exists, reliable_checkpoint


def qualify(schema: str | None, name: str, default_schema: str | None = None) -> str:
    """Target relation name: the custom schema as written (no prefixing), else the default."""
    s = schema if schema is not None else default_schema
    return f"{s}.{name}" if s else name


def is_path(target: str) -> bool:
    return "/" in target


def recover(spark: SparkSession, target: str) -> None:
    """Finish a swap that a stopped run left half done."""
    if is_path(target):
        t = target.rstrip("/")
        if not path_exists(spark, t) and path_exists(spark, f"{t}__old"):
            move_path(spark, f"{t}__old", t)
    elif not spark.catalog.tableExists(target) and spark.catalog.tableExists(f"{target}__new"):
        _adopt(spark, target)


def _adopt(spark: SparkSession, target: str) -> None:
    """Give the whole catalog table ``target__new`` its name; there is no table of that name."""
    parts = [c.name for c in spark.catalog.listColumns(f"{target}__new") if c.isPartition]
    if parts:                              # not every catalog moves a table's partitions with its name
        _save(spark.table(f"{target}__new"), target, parts, "parquet")
        spark.sql(f"DROP TABLE {target}__new")
    else:
        spark.sql(f"ALTER TABLE {target}__new RENAME TO {target}")


def table_exists(spark: SparkSession, target: str) -> bool:
    recover(spark, target)
    return path_exists(spark, target) if is_path(target) else spark.catalog.tableExists(target)


def read_table(spark: SparkSession, target: str, types: dict[str, DataType] | None = None) -> DataFrame | None:
    """The table, or None if there is none or only an empty folder (the first-run switch, H4); any other trouble
    is an error.

    ``types`` names the types of partition columns: a folder read infers them from the values,
    which fails for a column that has only been null so far.
    """
    if not table_exists(spark, target):
        return None
    if not is_path(target):
        return spark.table(target)
    layout = read_layout(spark, target)
    if layout is not None:
        fields = [StructField(layout.in_files(f.name), (types or {}).get(f.name, f.dataType)) for f in layout.schema.fields]
        files = spark.read.schema(StructType(fields)).parquet(target)
        return files.select(*[F.col(layout.in_files(f.name)).alias(f.name) for f in layout.schema.fields])
    try:
        df = spark.read.parquet(target)
    except AnalysisException as e:
        if e.getCondition() == "UNABLE_TO_INFER_SCHEMA":      # a folder without any file: written without rows
            return None
        raise
    fields = [StructField(f.name, (types or {}).get(f.name, f.dataType)) for f in df.schema.fields]
    if any(f.dataType != g.dataType for f, g in zip(df.schema.fields, fields, strict=True)):
        df = spark.read.schema(StructType(fields)).parquet(target)
    if any(isinstance(f.dataType, NullType) for f in df.schema.fields):
        raise ValueError(f"{target}: name the types of {[f.name for f in df.schema.fields if isinstance(f.dataType, NullType)]}")
    return df


@dataclass(frozen=True)
class Layout:
    """Columns of a folder, the names they bear in its files, and names in the files that no column bears any more."""
    schema: StructType
    stored: dict[str, str] = field(default_factory=dict)
    retired: tuple[str, ...] = ()

    def in_files(self, name: str) -> str:
        return self.stored.get(name, name)

    def changed(self, schema: StructType) -> Layout:
        """The layout with the columns of ``schema`` instead: kept names keep their column, others go or come."""
        keep = {f.name for f in self.schema.fields} & {f.name for f in schema.fields}
        retired = [*self.retired, *(self.in_files(f.name) for f in self.schema.fields if f.name not in keep)]
        stored, taken = {n: self.in_files(n) for n in keep}, {n.lower() for n in retired}
        for f in schema.fields:
            name, k = stored.get(f.name, f.name), 2
            while f.name not in keep and name.lower() in taken:
                name, k = f"{f.name}__{k}", k + 1
            stored[f.name] = name
        return Layout(schema, stored, tuple(dict.fromkeys(retired)))


def layout_path(target: str) -> str:
    return f"{target.rstrip('/')}/_layout"


def read_layout(spark: SparkSession, target: str) -> Layout | None:
    """The layout of a folder, None if its files say it all."""
    if not is_path(target) or not table_exists(spark, layout_path(target)):
        return None
    said = json.loads(spark.read.schema("layout string").parquet(layout_path(target)).first()["layout"])
    return Layout(StructType.fromJson(said["schema"]), said["stored"], tuple(said["retired"]))


def write_layout(spark: SparkSession, target: str, layout: Layout) -> None:
    said = {"schema": json.loads(layout.schema.json()), "stored": layout.stored, "retired": layout.retired}
    write_table(spark.createDataFrame([(json.dumps(said),)], "layout string").coalesce(1), layout_path(target))


def _save(df: DataFrame, target: str, partition_by: list[str] | None, fmt: str, bucket_by: str | None = None) -> None:
    if partition_by:
        df = df.hint("rebalance", *partition_by)   # one file per partition value; AQE splits hot ones
    w = df.write.mode("overwrite").format(fmt)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if is_path(target):
        w.option("partitionOverwriteMode", "static").save(target)
        return
    if bucket_by:                          # joins on the key find it dealt and sorted
        n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        w = df.repartition(n, bucket_by).write.mode("overwrite").format(fmt).bucketBy(n, bucket_by).sortBy(bucket_by)
    w.saveAsTable(target)                  # options would stay with the table


def write_table(df: DataFrame, target: str, partition_by: list[str] | None = None,
                fmt: str = "parquet", bucket_by: str | None = None) -> None:
    """Replace a table: a path (contains '/') or a catalog name. ``bucket_by``: a catalog table without partitions is
    bucketed and sorted by this key, as many buckets as the session has shuffle partitions."""
    spark = df.sparkSession
    if not table_exists(spark, target):
        if not is_path(target) and "." in target:
            spark.sql(f"CREATE DATABASE IF NOT EXISTS {target.rsplit('.', 1)[0]}")
        _save(df, target, partition_by, fmt, bucket_by)
        return
    if is_path(target):
        t = target.rstrip("/")
        _save(df, f"{t}__new", partition_by, fmt)
        delete_path(spark, f"{t}__old")
        move_path(spark, t, f"{t}__old")
        move_path(spark, f"{t}__new", t)
        delete_path(spark, f"{t}__old")
    else:
        spark.sql(f"DROP TABLE IF EXISTS {target}__new")
        _save(df, f"{target}__new", partition_by, fmt, bucket_by)
        spark.sql(f"DROP TABLE {target}")
        _adopt(spark, target)


def overwrite_partitions(df: DataFrame, target: str, *parts: str) -> None:
    """Replace the partitions that ``df`` has rows for, and no others, by one write job. A catalog table must not be
    read and overwritten by one job, so its rows are checkpointed first."""
    spark = df.sparkSession
    if is_path(target):
        layout = read_layout(spark, target)
        cols = [F.col(c).alias(layout.in_files(c) if layout else c) for c in df.columns]
        (df.hint("rebalance", *parts).select(*cols).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy(*parts).parquet(target))
        return
    conf, name = spark.conf, "spark.sql.sources.partitionOverwriteMode"
    before = conf.get(name)
    rows = reliable_checkpoint(df).select(*spark.table(target).columns).hint("rebalance", *parts)
    conf.set(name, "dynamic")              # inserts read the session's mode, not a write option
    try:
        rows.write.mode("overwrite").insertInto(target)
    finally:
        conf.set(name, before)


def drop_days(spark: SparkSession, target: str, part: str, cut: datetime.date) -> None:
    """Delete the partitions of days before ``cut`` from a table with the one partition column ``part``."""
    if is_path(target):
        for name in list_names(spark, target):
            day = name.removeprefix(f"{part}=")
            if day != name and day[:1].isdigit() and datetime.date.fromisoformat(day) < cut:
                delete_path(spark, f"{target.rstrip('/')}/{name}")
        return
    old = spark.table(target).where(F.col(part) < F.lit(cut)).select(part).distinct()
    for r in old.collect():                # days, not rows
        spark.sql(f"ALTER TABLE {target} DROP IF EXISTS PARTITION ({part} = DATE'{r[0]}')")


def write_note(spark: SparkSession, target: str, note: dict) -> None:
    """Keep a few values with a table: what it was built for. A table that is replaced loses them."""
    said = json.dumps(note)
    if is_path(target):
        write_table(spark.createDataFrame([(said,)], "note string").coalesce(1), f"{target.rstrip('/')}/_note")
    else:
        spark.sql(f"ALTER TABLE {target} SET TBLPROPERTIES ('note' = '{said}')")


def read_note(spark: SparkSession, target: str) -> dict | None:
    if not table_exists(spark, target):
        return None
    if is_path(target):
        path = f"{target.rstrip('/')}/_note"
        return json.loads(spark.read.schema("note string").parquet(path).first()["note"]) if table_exists(spark, path) else None
    said = spark.sql(f"SHOW TBLPROPERTIES {target}").where("key = 'note'").first()
    return json.loads(said["value"]) if said else None


def mark_stale(spark: SparkSession, target: str) -> None:
    """Say that a table doesn't follow its source until it is written again and ``clear_stale`` is called."""
    if is_path(target):
        make_path(spark, f"{target.rstrip('/')}__stale")
    elif spark.catalog.tableExists(target):
        spark.sql(f"ALTER TABLE {target} SET TBLPROPERTIES ('stale' = 'true')")


def clear_stale(spark: SparkSession, target: str) -> None:
    if is_path(target):
        delete_path(spark, f"{target.rstrip('/')}__stale")
    elif spark.catalog.tableExists(target):
        spark.sql(f"ALTER TABLE {target} UNSET TBLPROPERTIES IF EXISTS ('stale')")


def is_stale(spark: SparkSession, target: str) -> bool:
    """Whether the table is missing or marked."""
    if not table_exists(spark, target):
        return True
    if is_path(target):
        return path_exists(spark, f"{target.rstrip('/')}__stale")
    return spark.sql(f"SHOW TBLPROPERTIES {target}").where("key = 'stale' and value = 'true'").count() > 0


def as_view(df: DataFrame, name: str) -> DataFrame:
    """Named, lazily evaluated relation (a warehouse view)."""
    df.createOrReplaceTempView(name)
    return df
