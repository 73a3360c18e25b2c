import hashlib

import public_tokenizers as P
import pytest

import corpus_pipeline as C
from snapflow.llm import bpe, quality
from snapflow.llm.queries import BPE_RANKS
from tests.llm import test_decontam, test_simhash
from tests.llm.cases import SF, documents, empty, frame, key

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def table(df):
    return sorted((tuple(r) for r in df.select(*COLUMNS).collect()), key=key)


def test_stage_names():
    assert [n for n, _ in C.STAGES] == ["quality_classifier", "simhash_near_dedup", "benchmark_decontamination", "pii", "byte_level_bpe"]


@pytest.mark.parametrize("stage", [s for _, s in C.STAGES[:-1]])
def test_columns_and_empty_input(spark, stage):
    docs = frame(spark)
    assert stage(spark, docs, SF).columns == docs.columns
    assert stage(spark, empty(spark), SF).collect() == []


def test_rejected_documents_go(spark):
    docs = frame(spark)
    kept = table(C.quality_filter(spark, docs, SF))
    verdict = {(r["row"]["doc_id"], r["row"]["text"]): r["keep"] for r in quality.classify(
        docs.selectExpr("struct(doc_id, text) as row", "text"), C.KEEP, row="row").collect()}
    want = sorted((r for r in documents() if verdict[r[0], r[1]]), key=key)
    assert kept == want and len(kept) < len(documents())


def test_one_document_of_each_group_stays(spark):
    rows = documents(150)
    got = C.drop_near_duplicates(spark, frame(spark, rows), SF)
    groups = {}
    for r, (_, root) in zip(rows, test_simhash.roots(rows)):
        groups.setdefault(root, []).append(r)
    out = table(got)
    assert len(out) == len(groups)
    ids = sorted((min((r[0] for r in g if r[0] is not None), default=None) for g in groups.values()), key=lambda x: (x is None, x or 0))
    assert sorted((r[0] for r in out), key=lambda x: (x is None, x or 0)) == ids
    assert set(out) <= set(rows)


def test_benchmark_words_go(spark):
    import pandas as pd
    b = pd.read_parquet(f"{SF}/benchmark.parquet")
    items = [(int(i), t) for i, t in zip(b.item_id, b.text)]
    rows = [*documents(), (7000, "Éa " + items[2][1] + " zz", "en", "s", 1)]
    got = {r[0]: r for r in table(C.decontaminate(spark, frame(spark, rows), SF)) if r[0] is not None}
    dirty = {r[0] for r, x in zip(rows, test_decontam.brute(rows, items)) if x[5]}
    assert 7000 in dirty
    assert got[7000][1].split()[0] == "Éa" and got[7000][1].split()[-1] == "zz" and len(got[7000][1]) < 20
    assert got[7000][4] == len(got[7000][1])
    left = [r for r in got.values()]
    for r, x in zip(left, test_decontam.brute(left, items)):
        assert not x[5] or r[0] in dirty
    for r in rows:
        if r[0] is not None and r[0] not in dirty and [q[0] for q in rows].count(r[0]) == 1:
            assert got[r[0]] == r


def test_whole_run(spark):
    got = C.run(spark, SF).collect()
    codec = bpe.Codec(bpe.load_ranks(P.path(BPE_RANKS)), P.PATTERN)
    assert 0 < len(got) < spark.read.parquet(f"{SF}/documents.parquet").count()
    assert len({r["doc_id"] for r in got}) == len(got)
    for r in got:
        assert r["n_tokens"] == len(r["ids"])
        assert r["ids_sha256"] == hashlib.sha256(",".join(map(str, r["ids"])).encode()).hexdigest()
        text = codec.decode(r["ids"])
        assert r["decoded_sha256"] == hashlib.sha256(text).hexdigest() and codec.encode(text.decode()) == r["ids"]
