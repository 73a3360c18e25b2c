import numpy as np
import pandas as pd

from snapflow.llm import charpoly, whiten
from tests.llm.cases import SF

KIND = "vec_id long, embedding array<float>"


def vectors():
    e = pd.read_parquet(f"{SF}/embeddings.parquet")
    return [(int(i), [float(x) for x in v]) for i, v in zip(e.vec_id, e.embedding)]


def run(spark, rows, kind=KIND, **options):
    df = spark.createDataFrame(rows, kind).selectExpr("*", "vec_id as id", "'x' as v", "1 as component", "2 as n")
    return whiten.whiten(df.repartition(3), **{"offset": 1_000_000, **options}).toPandas()


def brute(rows, components=32):
    x = [[int(np.floor(64.0 * np.float32(c).astype(float))) + 1_000_000 for c in v] for _, v in rows]
    n, d = len(x), len(x[0])
    sums = [sum(r[i] for r in x) for i in range(d)]
    num = np.array([[n * a - s for a, s in zip(r, sums)] for r in x], dtype=object)
    y = num.astype(float) / n
    values, vecs = np.linalg.eigh(y.T @ y / n)
    values, vecs = values[::-1][:components], vecs[:, ::-1][:, :components]
    return n, (num * num).sum(1), y @ vecs / np.sqrt(values), values / np.trace(y.T @ y / n)


def test_components_of_awkward_rows(spark):
    rows = vectors()
    v, top = rows[5][1], max(i for i, _ in rows) + 1
    bad = [None, [], [None] + v[1:], [float("nan")] + v[1:], [float("inf")] + v[1:], v[:10], [1e30] + v[1:]]
    good = rows + rows[:3] + [(top, [0.0] * 64), (None, v), (top + 1, [3 * c for c in v])]
    got = run(spark, good + [(top + 2 + i, b) for i, b in enumerate(bad)])
    n, deviation, whitened, explained = brute(good)
    assert len(got) == 32 * len(good) and set(got.n) == {n} and got.identity_error.max() < 1e-9
    assert got.vec_id.isna().sum() == 32
    ids = [i for i, _ in good]
    for k in range(1, 33):
        part = got[got.component == k]
        assert np.allclose(part.explained, explained[k - 1], rtol=1e-9)
        sign = None
        for i, value, dev in part[["vec_id", "whitened", "deviation"]].itertuples(index=False):
            at = ids.index(None if np.isnan(i) else int(i))
            assert int(dev) == deviation[at]
            sign = sign or np.sign(value) * np.sign(whitened[at, k - 1])
            assert abs(value - sign * whitened[at, k - 1]) < 1e-8


def test_few_directions_ties_and_none(spark):
    assert run(spark, []).empty
    assert run(spark, [(1, [1.0, 2.0])]).empty
    assert run(spark, [(1, [1.0, 2.0]), (2, [1.0, 2.0])]).empty
    line = run(spark, [(i, [i / 64, 0.5, -i / 64]) for i in range(4)])             # one direction in three dimensions
    assert sorted(line.component.unique()) == [1] and np.allclose(line.explained, 1)
    assert np.allclose(np.sort(np.abs(line.whitened)) ** 2, [0.2, 0.2, 1.8, 1.8])
    square = run(spark, [(1, [1.0, 0.0]), (2, [-1.0, 0.0]), (3, [0.0, 1.0]), (4, [0.0, -1.0])])     # two equal eigenvalues
    assert np.allclose(square.explained, 0.5) and square.identity_error.max() < 1e-12 and len(square) == 8


def test_large_numbers_stay_exact(spark):
    rows = [(i, [float(2**40 + i * 2**33), float((-3) ** i), 0.1 * i]) for i in range(9)]
    got = run(spark, rows, "vec_id long, embedding array<double>", components=3)
    x = [[int(np.floor(64 * c)) + 1_000_000 for c in v] for _, v in rows]
    sums = [sum(c) for c in zip(*x)]
    want = {i: sum((9 * a - s) ** 2 for a, s in zip(v, sums)) for i, v in enumerate(x)}
    assert {int(r.vec_id): int(r.deviation) for r in got.itertuples()} == want
    assert sorted(got.component.unique()) == [1, 2, 3] and got.identity_error.max() < 1e-4


def matrix(blocks):
    m = np.zeros((2 * len(blocks),) * 2, dtype=object)
    for k, b in enumerate(blocks):
        m[2 * k:2 * k + 2, 2 * k:2 * k + 2] = np.array(b, dtype=object)
    return m.tolist()


def test_close_equal_and_zero_roots(spark):
    big = 10**15
    m = matrix([[[big, 1], [1, big]], [[5, 2], [2, 3]], [[5, 2], [2, 3]], [[4, 2], [2, 1]]])   # big - 1, big + 1; twice; 5 and 0
    values, vecs, trace = whiten.spectrum(spark, m, 32)
    assert trace == 2 * big + 21 and len(values) == 7
    assert [abs(float(v - w)) < 1e-9 for v, w in zip(values[:2], (big + 1, big - 1))] == [True, True]
    assert np.allclose(np.array(vecs) @ np.array(vecs).T, np.eye(7), atol=1e-15)
    assert np.allclose(np.abs(vecs[0][:2]), np.sqrt(0.5), atol=1e-15) and vecs[0][0] * vecs[1][0] * vecs[0][1] * vecs[1][1] < 0
    rest = np.array(m, float)[2:, 2:] @ np.array(vecs)[2:, 2:].T
    assert np.allclose(rest, np.array(vecs)[2:, 2:].T * [float(v) for v in values[2:]], atol=1e-13)


def test_polynomial_and_roots():
    m = [[2, 1, 0], [1, 2, 0], [0, 0, 3]]                                           # (x - 1)(x - 3)**2
    ps = charpoly.primes(charpoly.coefficient_bits(7, 3))
    poly = charpoly.remainders([(p, charpoly.polynomial_mod(np.array(m), p).tolist()) for p in ps])
    assert poly == [-9, 15, -7, 1] and charpoly.distinct_roots(poly) == 2
    assert [(float(r.middle()), r.times) for r in charpoly.roots(poly)] == [(3.0, 2), (1.0, 1)]
