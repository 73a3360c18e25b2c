import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from snapflow.llm import ann
from tests.llm.cases import SF


def brute(rows, k):
    rows = [(i, np.array(v, float)) for i, v in rows
            if i is not None and v is not None and len(v) == 64 and None not in v and np.isfinite(np.array(v, float)).all() and any(v)]
    out = {}
    for q, v in rows:
        if q % 20 == 0:
            near = sorted((-float(v @ w), i) for i, w in rows if i != q)[:k]
            out.setdefault(q, [(i, -p) for p, i in near])
    return out


def vectors():
    e = pd.read_parquet(f"{SF}/embeddings.parquet")
    return [(int(i), [float(x) for x in v]) for i, v in zip(e.vec_id, e.embedding)]


def run(spark, rows, **options):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").selectExpr("*", "vec_id as id", "1 as list", "'x' as v")
    got = {}
    for r in ann.search(df.repartition(3), F.col("id") % 20 == 0, **options).orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
        assert r["rank"] == len(got[r["query_id"]])
    return got


def test_awkward_rows_and_copies_are_exact_with_one_list(spark):
    rows = vectors()[:200]
    top = max(i for i, _ in rows) + 1
    v = rows[5][1]
    bad = [None, [], [0.0] * 64, [None] + v[1:], [float("nan")] + v[1:], [float("inf")] + v[1:], v[:10]]
    rows += [(top + i, x) for i, x in enumerate(bad)] + [(None, v)]
    start = (top // 20 + 2) * 20
    rows += [(start + i, v) for i in range(60)]                       # many copies, queries among them
    rows += [(start + 100 + i, [2 * x for x in rows[7][1]]) for i in range(30)]   # longer vectors
    got, want = run(spark, rows), brute(rows, 20)
    assert got.keys() == want.keys()
    for q in want:
        assert [i for i, _ in got[q]] == [i for i, _ in want[q]], q
        assert np.allclose([s for _, s in got[q]], [s for _, s in want[q]], rtol=0, atol=1e-12)


def test_recall_over_many_lists(spark, monkeypatch):
    monkeypatch.setattr(ann, "LIST", 20)
    monkeypatch.setattr(ann, "GROUP", 30)     # lists and queries split
    rows = vectors()
    got, want = run(spark, rows), brute(rows, 20)
    assert got.keys() == want.keys()
    hit = sum(len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in want)
    assert hit >= 0.9 * sum(map(len, want.values()))


def test_long_vectors_cost_others_nothing(spark, monkeypatch):
    rows = vectors()
    top = (max(i for i, _ in rows) // 20 + 1) * 20
    rows += [(top, [1e4 * x for x in rows[3][1]]), (top + 1, [1e4 * x for x in rows[8][1]]), (top + 2, [1e-4 * x for x in rows[9][1]])]
    want = brute([(i, np.float32(v).tolist()) for i, v in rows], 20)
    for lists, least in ((1000, 1), (20, 0.9)):               # one list a band, and many
        monkeypatch.setattr(ann, "LIST", lists)
        got = run(spark, rows)
        assert got.keys() == want.keys()
        hit = sum(len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in want)
        assert hit >= least * sum(map(len, want.values())), (lists, hit)


def answers(rows, k):
    """Every query row's ranks, by id and vector."""
    good = [(i, np.array(v, float)) for i, v in rows]
    return sorted((q, [i for _, i in sorted((-float(v @ w), i) for i, w in good if i != q)[:k]]) for q, v in good if q % 20 == 0)


def test_repeated_ids_find_as_many(spark):
    rows = vectors()[:120]
    v, w = rows[5][1], rows[9][1]
    rows += [(20, v), (20, v), *[(40, [(1 + 0.01 * j) * x for x in v]) for j in range(25)],      # own rows near, and many
             *[(60, w)] * 30, (60, rows[20][1]), *[(7, w)] * 23, *[(3, v)] * 2, (61, w)]          # one vector, several ids
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(3)
    found = ann.search(df, F.col("id") % 20 == 0, k=20).collect()
    assert len(found) == 20 * sum(i % 20 == 0 for i, _ in rows)
    want = answers([(i, np.float32(v).tolist()) for i, v in rows], 20)
    for q in {i for i, _ in want}:
        ranks = {}
        for r in found:
            if r["query_id"] == q:
                ranks.setdefault(r["rank"], []).append(r["vec_id"])
        of = [ids for i, ids in want if i == q]
        assert [sorted(ranks[k + 1]) for k in range(20)] == [sorted(ids[k] for ids in of) for k in range(20)], q


def test_few_and_none(spark):
    assert run(spark, []) == {}
    assert run(spark, [(20, [1.0, 0.0])]) == {}
    assert run(spark, [(20, [1.0, 0.0]), (21, [0.5, 0.5]), (40, [0.0, 1.0])]) == {20: [(21, 0.5), (40, 0.0)], 40: [(21, 0.5), (20, 0.0)]}


def test_abandoned_candidates_cost_little_recall():
    rng = np.random.default_rng(0)
    x = rng.standard_normal((5000, 64)).astype(np.float32)
    hit = 0
    for q in rng.standard_normal((40, 64)).astype(np.float32):
        truth = np.argsort(((x - q) ** 2).sum(1))[:20]
        hit += len(set(ann.adaptive_scan(q, x, 20).tolist()) & set(truth.tolist()))
    assert hit >= 0.97 * 800
