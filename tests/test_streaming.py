import datetime as dt
import json
import os
import tempfile

from snapflow.operators.latest import latest_per_key
from snapflow.operators.staging import stage_repos
from snapflow.streaming.latest import read_latest, stream_latest
from tests.conftest import rows

T = dt.datetime


def test_stream_latest_matches_batch_and_is_exactly_once(spark):
    root = tempfile.mkdtemp(prefix="stream-", dir=os.environ.get("TMPDIR", "/tmp"))
    landing, out, ckpt = f"{root}/landing", f"{root}/latest", f"{root}/ckpt"
    schema = "extracted_at timestamp_ntz, repo_name string, raw_data string"
    b1 = [(T(2024, 1, 1), "a", json.dumps({"stars": 1, "full_name": "a1"})),
          (T(2024, 1, 2), "a", json.dumps({"stars": 2, "full_name": "a2"})),
          (T(2024, 1, 1), "b", json.dumps({"stars": 5, "full_name": "b1"}))]
    b2 = [(T(2024, 1, 3), "a", json.dumps({"stars": 3, "full_name": "a3"})),
          (None, "b", json.dumps({"stars": 9, "full_name": "b0"})),          # NULL load time wins
          (T(2024, 1, 9), "c", json.dumps({"stars": 7, "full_name": "c1"}))]
    seen = []
    for batch in (b1, b2, []):                      # the last run finds no new files
        if batch:
            spark.createDataFrame(batch, schema).write.mode("append").parquet(landing)
        stream_latest(spark, landing, "repo_name", out, ckpt, stage_repos, tiebreak=["full_name"]).awaitTermination()
        seen += batch
        got = rows(read_latest(spark, out), "repo_name", "stars")
        want = rows(latest_per_key(stage_repos(spark.createDataFrame(seen, schema)), "repo_name", "extracted_at",
                                   ["full_name"]), "repo_name", "stars")
        assert got == want
    assert got == [("a", 3), ("b", 9), ("c", 7)]
    assert spark.read.parquet(out).count() == 3      # one row a key
    b3 = [(T(2024, 2, 1), "a", json.dumps({"stars": 4, "full_name": "a4"}))]       # one key of three
    spark.createDataFrame(b3, schema).write.mode("append").parquet(landing)
    stream_latest(spark, landing, "repo_name", out, ckpt, stage_repos, tiebreak=["full_name"]).awaitTermination()
    assert rows(read_latest(spark, out), "repo_name", "stars") == \
        [("a", 4), ("b", 9), ("c", 7)]


def test_stream_reads_variant_landing(spark):
    from snapflow.sources.raw import land_raw
    root = tempfile.mkdtemp(prefix="streamv-", dir=os.environ.get("TMPDIR", "/tmp"))
    docs = spark.createDataFrame([("a", json.dumps({"stars": 1})), ("a", json.dumps({"stars": 2}))],
                                 "repo_name string, doc string")
    land_raw(docs.where("doc like '%1%'"), "repo_name", "doc", f"{root}/landing", T(2024, 1, 1), as_variant=True)
    land_raw(docs.where("doc like '%2%'"), "repo_name", "doc", f"{root}/landing", T(2024, 1, 2), as_variant=True)
    stream_latest(spark, f"{root}/landing", "repo_name", f"{root}/out", f"{root}/ckpt", stage_repos,
                  doc_type="variant", max_files_per_batch=1).awaitTermination()     # one file per micro-batch
    assert rows(read_latest(spark, f"{root}/out"), "repo_name", "stars") == [("a", 2)]


def test_null_counts_cover_every_staged_row_once(spark):
    import pytest
    from snapflow.session import delete_path
    from snapflow.streaming.latest import ROWS, _count, ledger_path, null_counts
    root = tempfile.mkdtemp(prefix="streamn-", dir=os.environ.get("TMPDIR", "/tmp"))
    schema = "extracted_at timestamp_ntz, repo_name string, raw_data string"
    assert null_counts(spark, f"{root}/out") == {}
    docs = [{"description": None, "topics": ["x"]}, {"description": "d"}, {}]          # overtaken rows count, too
    for day in (1, 2, 3):
        spark.createDataFrame([(T(2024, 1, day, h), "a", json.dumps(d)) for h, d in enumerate(docs)], schema) \
            .coalesce(1).write.mode("append").parquet(f"{root}/landing")
        stream_latest(spark, f"{root}/landing", "repo_name", f"{root}/out", f"{root}/ckpt", stage_repos,
                      tiebreak=None).awaitTermination()
    got = null_counts(spark, f"{root}/out")
    assert (got["description"], got["topics"], got["repo_name"], got["stars"], got[ROWS]) == (6, 6, 0, 0, 9)
    ledger = ledger_path(f"{root}/out")
    assert spark.read.parquet(ledger).select("epoch").distinct().count() == 2          # however many micro-batches there were
    last = {r["column"]: r["nulls"] for r in spark.read.parquet(ledger).where("epoch = 1").collect()}
    _count(spark, ledger, 2, {c: got[c] - last[c] for c in got})                       # a replayed micro-batch is counted once
    assert null_counts(spark, f"{root}/out") == got
    delete_path(spark, ledger)                                                         # lost: an error, not a pass
    with pytest.raises(ValueError, match="counts no rows"):
        null_counts(spark, f"{root}/out")


def test_only_touched_buckets_are_rewritten(spark):
    """A micro-batch of one key rewrites one bucket; replays and late rows change nothing that they shouldn't."""
    from snapflow.streaming.latest import _merge
    from tests.test_history import _files
    root = tempfile.mkdtemp(prefix="streamb-", dir=os.environ.get("TMPDIR", "/tmp"))
    landing, out, ckpt = f"{root}/landing", f"{root}/latest", f"{root}/ckpt"
    schema = "extracted_at timestamp_ntz, repo_name string, raw_data string"

    def land(items, buckets=8):
        spark.createDataFrame([(t, k, json.dumps({"stars": s})) for t, k, s in items], schema).write.mode("append").parquet(landing)
        stream_latest(spark, landing, "repo_name", out, ckpt, stage_repos, tiebreak=None, buckets=buckets).awaitTermination()

    land([(T(2024, 1, 1), f"k{i}", i) for i in range(100)])
    before = _files(out)
    assert len({d for d, _ in before if "bucket=" in d}) == 8
    land([(T(2024, 1, 2), "k7", 700), (T(2023, 1, 1), "k7", 1)], buckets=3)             # the table keeps its number of buckets
    changed = {d for d, _ in before.keys() ^ _files(out).keys()}
    assert len(changed) == 1 and "bucket=" in changed.pop()
    want = sorted((f"k{i}", 700 if i == 7 else i) for i in range(100))
    assert rows(read_latest(spark, out), "repo_name", "stars") == want
    again = spark.read.parquet(out).where("repo_name in ('k7', 'k8')").drop("bucket")
    _merge(spark, out, again.cache(), "repo_name", ["extracted_at"], 8)
    assert rows(read_latest(spark, out), "repo_name", "stars") == want


def test_a_log_of_micro_batches_is_taken_over(spark):
    from snapflow.streaming.latest import _no_variant
    root = tempfile.mkdtemp(prefix="streaml-", dir=os.environ.get("TMPDIR", "/tmp"))
    schema = "extracted_at timestamp_ntz, repo_name string, raw_data string"
    staged = _no_variant(stage_repos(spark.createDataFrame(
        [(T(2024, 1, d), k, json.dumps({"stars": d})) for d in (1, 2) for k in "ab"], schema)))
    staged.selectExpr("*", "0L as __epoch").write.parquet(f"{root}/out")
    spark.createDataFrame([(T(2024, 1, 5), "a", json.dumps({"stars": 5}))], schema).write.parquet(f"{root}/landing")
    stream_latest(spark, f"{root}/landing", "repo_name", f"{root}/out", f"{root}/ckpt", stage_repos, tiebreak=None).awaitTermination()
    assert rows(read_latest(spark, f"{root}/out"), "repo_name", "stars") == [("a", 5), ("b", 2)]


def test_variant_columns_come_back(spark):
    root = tempfile.mkdtemp(prefix="streamt-", dir=os.environ.get("TMPDIR", "/tmp"))
    schema = "extracted_at timestamp_ntz, repo_name string, raw_data string"
    df = spark.createDataFrame([(T(2024, 1, 1), "a", json.dumps({"topics": ["x", {"y": 1}]})), (T(2024, 1, 1), "b", "{}")], schema)
    df.write.parquet(f"{root}/landing")
    stream_latest(spark, f"{root}/landing", "repo_name", f"{root}/out", f"{root}/ckpt", stage_repos).awaitTermination()
    staged = stage_repos(df)
    got = read_latest(spark, f"{root}/out", schema=staged.schema)
    assert got.schema["topics"].dataType == staged.schema["topics"].dataType
    pick = "variant_get(topics, '$[1].y', 'int') as y"
    assert sorted(r.y is None for r in got.selectExpr(pick).collect()) == [False, True]
