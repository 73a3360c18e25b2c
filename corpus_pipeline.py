"""Corpus pipeline: the documents that a training run gets, as token ids.

Five stages, each over all that its predecessor kept: rejected documents go, one document of each group of near
duplicates stays, benchmark passages are cut out, personal data become surrogates, and the texts are encoded. Every
stage takes (spark, docs, sf_dir); all but the last return the columns of their input, with ``n_chars`` (if there) of
the new text where a stage changed it.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from snapflow.llm import bpe, decontam, pii, quality, simhash
from snapflow.llm.queries import BPE_RANKS, KEEP, PII_KEY
from snapflow.session import apply_defaults, ensure_parallelism, release_scratch, scratch_path

#: Near duplicates: words of a shingle, most differing bits. Decontamination: words of a window.
SHINGLE, BITS, WINDOW = 3, 3, 10


def _with_text(changed: DataFrame, like: DataFrame, text: Column, where: Column) -> DataFrame:
    """The columns of ``like`` out of ``row``, with a new text where the condition holds."""
    row = F.col("row").withField("text", F.when(where, text).otherwise(F.col("row.text")))
    if "n_chars" in like.columns:
        chars = F.when(where, F.length(text)).otherwise(F.col("row.n_chars")).cast(like.schema["n_chars"].dataType)
        row = row.withField("n_chars", chars)
    return changed.select(row.alias("row")).select("row.*")


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that the classifier rejects, for their quality or as toxic."""
    rows = ensure_parallelism(docs).select(F.struct("*").alias("row"), "text")
    return quality.classify(rows, threshold=KEEP, row="row").where("keep").select("row.*")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group of near duplicates: the least id (none is last), one row of it."""
    rows = ensure_parallelism(docs).select(F.struct("*").alias("row")).select(
        "row", F.concat_ws(":", F.coalesce(F.col("row.doc_id").cast("string"), F.lit("-")), F.hex(F.xxhash64("row"))).alias("name"))
    found = simhash.near_duplicates(rows.select("row.doc_id", "row.text", "name"), SHINGLE, BITS, carry=("name",))
    first = found.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "name")).alias("first"))
    names = first.select(F.col("first.name").alias("kept"))
    one = Window.partitionBy("name").orderBy("name")
    kept = rows.join(names, F.col("name") == F.col("kept"), "left_semi")
    return kept.withColumn("n", F.row_number().over(one)).where("n = 1").select("row.*")


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cut the words out that repeat a window of a benchmark item."""
    rows = ensure_parallelism(docs).select(F.struct("*").alias("row"), "text")
    found = decontam.find(rows, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), WINDOW, row="row")
    raw = F.encode("text", "UTF-8")
    begin = F.concat(F.array(F.lit(0).cast("long")), F.col("spans.byte_end"))
    end = F.concat(F.col("spans.byte"), F.array(F.octet_length("text").cast("long")))
    between = F.zip_with(begin, end, lambda a, b: F.decode(F.substring(raw, (a + 1).cast("int"), (b - a).cast("int")), "UTF-8"))
    return _with_text(found, docs, F.array_join(between, ""), F.size("spans") > 0)


def pseudonymise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replace personal data and secrets by surrogates."""
    found = pii.replace(ensure_parallelism(docs), PII_KEY)
    return _with_text(found, docs, F.col("row.text"), F.col("n_entities") > 0)


def tokenise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, with the digests of the ids and of the bytes that they decode to."""
    return bpe.encode(ensure_parallelism(docs), public_tokenizers.path(BPE_RANKS), public_tokenizers.PATTERN)


STAGES = [("quality_classifier", quality_filter), ("simhash_near_dedup", drop_near_duplicates),
          ("benchmark_decontamination", decontaminate), ("pii", pseudonymise), ("byte_level_bpe", tokenise)]

#: SQL expresses none of the five stages; tests/llm holds them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what a stage returns is written to the shared folder and read again, and
    deleted once the next stage is written (the last one's input when the caller releases its scratch)."""
    apply_defaults(spark)
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        if before:
            release_scratch(spark, before)
        docs, before = spark.read.parquet(path), path
    return STAGES[-1][1](spark, docs, sf_dir)
