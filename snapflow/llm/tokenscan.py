"""Token counts of documents in flat token files without an index.

A token file is an array of fixed-size token ids, documents one after the other, each closed by the end-of-document
id. Files are scanned in blocks that pay no regard to documents: a vectorised search finds the separators of a
block and with them the lengths of the documents inside it, the tokens before its first separator and those after
its last. A prefix scan over the blocks of a file then gives each block the documents ended before it and the
tokens that its first document brings along. The scan runs in two levels, over the blocks of a segment and over
the segments of a file, so that no task gets all blocks of a large file.

Tokens after a file's last separator are a document that has not ended. Two separators in a row enclose an empty
document. An empty file has no documents.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from snapflow.llm import bpe
from snapflow.session import reliable_checkpoint, scratch_path

#: Tokens of a block; blocks of a segment.
BLOCK, SEGMENT = 1 << 16, 1 << 12
_SUMMARY = "file string, block long, n_tokens long, n_eod long, head long, tail long, inner array<int>"


def read_files(spark: SparkSession, path: str, width: int = 2, block: int = BLOCK) -> DataFrame:
    """Blocks (file, block, data) of the flat files under a path; ids have ``width`` bytes. A task reads whole files
    (2 GB at most each, as Spark's binary source does)."""
    size = block * width
    files = spark.read.format("binaryFile").load(path).where("length > 0").select(F.col("path").alias("file"), "content", "length")
    at = F.explode(F.sequence(F.lit(0), F.expr(f"(length - 1) div {size}"))).alias("block")
    return files.select("file", at, "content").select("file", "block", F.expr(f"substring(content, block * {size} + 1, {size})").alias("data"))


def write_tokens(docs: DataFrame, rank_path: str, pattern: str, eod: int, path: str, id_col: str = "doc_id",
                 text_col: str = "text", block: int = BLOCK) -> None:
    """Token files of the documents, one for each map task, as a table of blocks under ``path``/kind=block, and the
    documents' order in the files (file, block: place, data: id) under ``path``/kind=order. Ids take two bytes."""
    loaded = bpe.load_ranks(rank_path)
    if max(*loaded.values(), eod) >= 1 << 16:
        raise ValueError("token ids must fit two bytes")
    ranks = docs.sparkSession.sparkContext.broadcast(loaded)
    key = bpe.new_key()

    def run(batches):
        codec = bpe.codec_of(key, ranks, pattern)
        file = f"part-{TaskContext.get().partitionId():05d}"
        left, size, n_blocks, n_docs = [], 0, 0, 0

        def batch_of(kind: str, numbers: list[int], data: list[bytes]) -> pa.RecordBatch:
            n = len(numbers)
            return pa.record_batch([pa.array([kind] * n), pa.array([file] * n), pa.array(numbers, pa.int64()), pa.array(data, pa.binary())],
                                   names=["kind", "file", "block", "data"])

        for batch in batches:
            ids = np.array([0 if i is None else i for i in batch.column(0).to_pylist()], np.int64)
            null = batch.column(0).is_null().to_numpy(zero_copy_only=False)
            if len(ids):
                yield batch_of("order", [n_docs], [np.r_[ids, null.astype(np.int64)].tobytes()])
            n_docs += len(ids)
            for text in batch.column(1):
                left.append(np.array([*codec.encode(text.as_py() or ""), eod], np.uint16))
                size += len(left[-1])
                if size >= block:
                    tokens = np.concatenate(left)
                    whole = len(tokens) // block
                    yield batch_of("block", [n_blocks + i for i in range(whole)],
                                   [tokens[i * block:(i + 1) * block].tobytes() for i in range(whole)])
                    n_blocks += whole
                    left, size = [tokens[whole * block:]], len(tokens) - whole * block
        if size:
            yield batch_of("block", [n_blocks], [np.concatenate(left).tobytes()])

    (docs.select(F.col(id_col).cast("long"), text_col).mapInArrow(run, "kind string, file string, block long, data binary")
     .write.partitionBy("kind").option("compression", "zstd").mode("overwrite").parquet(path))


def _summaries(blocks: DataFrame, eod: int, dtype: str) -> DataFrame:
    schema = pa.schema([("file", pa.string()), *((k, pa.int64()) for k in ("block", "n_tokens", "n_eod", "head", "tail")),
                        ("inner", pa.list_(pa.int32()))])

    def run(batches):
        for batch in batches:
            out = []
            for file, block, data in zip(*batch.columns, strict=True):
                tokens = np.frombuffer(data.as_buffer() if data.is_valid else b"", dtype)
                at = np.flatnonzero(tokens == eod)
                n, ended = len(tokens), len(at)
                out.append((file.as_py(), block.as_py(), n, ended, int(at[0]) if ended else n, n - int(at[-1]) - 1 if ended else n,
                            (np.diff(at) - 1).tolist()))
            if out:
                yield pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), schema, strict=True)], schema=schema)

    return blocks.select("file", F.col("block").cast("long"), "data").mapInArrow(run, _SUMMARY)


def _before(df: DataFrame, keys: list[str], order: str, size: str, carry: str) -> DataFrame:
    """Prefix scan of (documents ended, tokens since the last separator): ``ended`` and ``open`` before each row.
    ``size`` are the row's separators, ``carry`` its tokens after the last one (all if it has none)."""
    w = Window.partitionBy(*keys).orderBy(order)
    past = w.rowsBetween(Window.unboundedPreceding, -1)
    df = df.withColumn("ended", F.coalesce(F.sum(size).over(past), F.lit(0)))
    last = F.coalesce(F.last(F.when(F.col(size) > 0, F.col(carry)), ignorenulls=True).over(past), F.lit(0))
    since = Window.partitionBy(*keys, "ended").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    # rows with the same number of ended documents before them: the first follows a separator, the others add to it
    df = df.withColumn("_last", last).withColumn("_more", F.coalesce(F.sum(F.when(F.col(size) == 0, F.col(carry))).over(since), F.lit(0)))
    return df.withColumn("open", F.col("_last") + F.col("_more")).drop("_last", "_more")


def count(blocks: DataFrame, eod: int, dtype: str = "<u2") -> DataFrame:
    """Per document of the files: ``file``, ``place`` (from 0), ``n_tokens`` without the separator, ``ended``.

    ``blocks``: file, block (number in the file, from 0), data (whole ids of type ``dtype``).
    """
    found = reliable_checkpoint(_summaries(blocks, eod, dtype)).withColumn("segment", F.floor(F.col("block") / SEGMENT))
    local = _before(found, ["file", "segment"], "block", "n_eod", "tail")
    whole = local.groupBy("file", "segment").agg(
        F.sum("n_eod").alias("n"),
        F.max_by(F.when(F.col("n_eod") > 0, F.col("tail")).otherwise(F.col("open") + F.col("tail")), "block").alias("rest"))
    segments = _before(whole, ["file"], "segment", "n", "rest").select(
        "file", "segment", F.col("ended").alias("ended_s"), F.col("open").alias("open_s"), "n", "rest")
    placed = local.join(segments.select("file", "segment", "ended_s", "open_s"), ["file", "segment"])
    carried = F.col("open") + F.when(F.col("ended") == 0, F.col("open_s")).otherwise(0)
    place = F.col("ended") + F.col("ended_s")
    ends = placed.where("n_eod > 0")
    first = ends.select("file", place.alias("place"), (carried + F.col("head")).alias("n_tokens"))
    inner = ends.select("file", place.alias("from"), F.posexplode("inner").alias("p", "n")).select(
        "file", (F.col("from") + F.col("p") + 1).alias("place"), F.col("n").cast("long").alias("n_tokens"))
    last = Window.partitionBy("file").orderBy(F.desc("segment"))
    rest = (segments.withColumn("k", F.row_number().over(last)).where("k = 1")
            .withColumn("n_tokens", F.col("rest") + F.when(F.col("n") == 0, F.col("open_s")).otherwise(0)).where("n_tokens > 0")
            .select("file", (F.col("ended_s") + F.col("n")).alias("place"), "n_tokens"))
    yes = first.unionByName(inner).withColumn("ended", F.lit(True))
    return yes.unionByName(rest.withColumn("ended", F.lit(False)))


def document_counts(docs: DataFrame, rank_path: str, pattern: str, eod: int, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """Per row: id and ``n_tokens``, counted by scanning the token files written from the texts. Null and empty texts
    are empty documents; repeated rows and ids are documents of their own."""
    spark = docs.sparkSession
    path = scratch_path(spark, "tokens")
    write_tokens(docs, rank_path, pattern, eod, path, id_col, text_col)
    table = spark.read.schema("file string, block long, data binary, kind string").parquet(path)
    counts = count(table.where("kind = 'block'"), eod).select(F.col("file").alias("f"), "place", "n_tokens")

    def places(batches):
        for batch in batches:
            for file, first, data in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                ids, null = np.frombuffer(data, np.int64).reshape(2, -1)
                n = len(ids)
                yield pa.record_batch([pa.array([file] * n, pa.string()), pa.array(np.arange(first, first + n)),
                                       pa.array(ids, mask=null.astype(bool))], names=["file", "p", id_col])

    order = table.where("kind = 'order'").select("file", "block", "data").mapInArrow(places, f"file string, p long, `{id_col}` long")
    return (order.join(counts, (F.col("file") == F.col("f")) & (F.col("p") == F.col("place")), "left")
            .select(id_col, "n_tokens"))
