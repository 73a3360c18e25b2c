"""Whitening of embeddings by the exact spectrum of their integer scatter.

Entries become whole numbers, so the scatter over all vectors is exact however it is summed: tasks multiply blocks of
limbs that float64 holds exactly, and Spark adds their partial sums as decimals. From the scatter come the characteristic
polynomial (modular Hessenberg images, a prime a row of a Spark job, joined by Chinese remainders), its roots (isolated by
exact counts), and one eigenvector a root (inverse iteration in high precision, again a row of a Spark job each). What the
driver holds depends on the vectors' length alone.

Null vectors, empty ones and such with null, non-finite or huge entries (2**56 and beyond: no whole number of 64 bits)
take no part; of vectors of several lengths only the most frequent length does (ties: the longer). Repeated rows count as
often as they occur; null ids keep their rows. Directions without any variance have no component, so fewer than the asked
number come back where the vectors span less; no rows come back from an empty table, or where all vectors are equal.
"""

from __future__ import annotations

from dataclasses import dataclass
from math import gcd

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapflow.llm.charpoly import Root, coefficient_bits, eigenvectors, polynomial_mod, primes, remainders, roots

#: Rows of a block, bits of a limb: 2**12 products of 2**40 are exact in float64.
BLOCK, LIMB = 1 << 12, 20
_LARGEST = float(2**56)


@dataclass(frozen=True)
class Whitening:
    """Fitted over ``n`` vectors: per-dimension ``sums`` and ``trace`` * n**2 of the covariance are exact; ``vectors``
    (unit, a row each) and ``values`` (eigenvalues) are doubles, largest first."""
    n: int
    sums: tuple[int, ...]
    vectors: np.ndarray
    values: np.ndarray
    explained: np.ndarray
    scale: int
    offset: int

    def numerators(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(n * x - sums exactly, whitened) for a block of whole numbers."""
        centre = [s // self.n for s in self.sums]
        y = x - np.array(centre, np.int64)
        rest = [s - self.n * c for s, c in zip(self.sums, centre, strict=True)]
        small = self.n * (int(np.abs(y).max(initial=0)) + 1) < 2**62
        exact = (y if small else y.astype(object)) * self.n - np.array(rest, np.int64 if small else object)
        if not len(self.values):
            return exact, np.empty((len(x), 0))
        deviations = y - np.array([r / self.n for r in rest])
        return exact, deviations @ (self.vectors / np.sqrt(self.values)[:, None]).T


def usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(id, vector of doubles) of the rows that take part."""
    v = F.col(vector_col).cast("array<double>")
    fine = F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < _LARGEST))
    rows = vectors.select(F.col(id_col).alias("id"), v.alias("v")).where(F.col("v").isNotNull() & (F.size("v") > 0) & fine.eqNullSafe(True))
    length = rows.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    return rows.where(F.size("v") == (length["d"] if length else 0))


def _blocks(batch: pa.RecordBatch, scale: int, offset: int):
    """(first row, whole numbers) of a batch in blocks; vectors are the last column."""
    col = batch.column(batch.num_columns - 1)
    if not len(col):
        return
    flat = col.flatten().to_numpy(zero_copy_only=False).reshape(len(col), -1)
    for lo in range(0, len(flat), BLOCK):
        yield lo, np.floor(scale * flat[lo:lo + BLOCK]).astype(np.int64) + offset


def _limbs(y: np.ndarray) -> list[np.ndarray]:
    out = []
    while np.abs(y).max(initial=0) >= 1 << LIMB:
        out.append((y & ((1 << LIMB) - 1)).astype(float))
        y = y >> LIMB
    return [*out, y.astype(float)]


def _added(rows: DataFrame, run, keys: tuple[str, ...]) -> dict[tuple, int]:
    """Sums over all tasks of the (keys, value) rows that ``run`` makes of its batches; as many as the vectors are long, or
    its square."""
    kinds = ", ".join(f"{k} int" for k in keys)
    found = rows.mapInArrow(run, f"{kinds}, value decimal(38,0)").groupBy(*keys).agg(F.sum("value").alias("value"))
    return {tuple(r[k] for k in keys): int(r["value"]) for r in found.collect()}


def _partial(keys: tuple[str, ...], items: list[tuple]) -> pa.RecordBatch:
    cols = list(zip(*items, strict=True))
    kinds = [pa.int32()] * len(keys) + [pa.decimal128(38, 0)]
    return pa.record_batch([pa.array(c, t) for c, t in zip(cols, kinds, strict=True)], names=[*keys, "value"])


def fit(rows: DataFrame, components: int, scale: int = 64, offset: int = 0) -> Whitening:
    """The exact spectrum of floor(scale * c) + offset over all rows (``id``, ``v``)."""
    vectors = rows.select("v")

    def sums(batches):
        n, total = 0, 0
        for batch in batches:
            for _, x in _blocks(batch, scale, offset):
                n += len(x)
                total = total + (x >> 31).sum(0).astype(object) * 2**31 + (x & (2**31 - 1)).sum(0).astype(object)
        if n:
            yield _partial(("i",), [(-1, n), *enumerate(total.tolist())])

    added = _added(vectors, sums, ("i",))
    n = added.pop((-1,), 0)
    d = len(added)
    total = [added[i,] for i in range(d)]
    if not n:
        return Whitening(0, (), np.empty((0, 0)), np.empty(0), np.empty(0), scale, offset)
    centre = [s // n for s in total]

    def scatter(batches):
        acc, tri = {}, np.triu_indices(d)
        for batch in batches:
            for _, x in _blocks(batch, scale, offset):
                limbs = _limbs(x - np.array(centre, np.int64))
                for a, left in enumerate(limbs):
                    for b, right in enumerate(limbs):
                        acc[a + b] = acc.get(a + b, 0) + (left.T @ right).astype(np.int64).astype(object)
        for shift, m in acc.items():
            yield _partial(("i", "j", "shift"), [(int(i), int(j), shift, m[i, j]) for i, j in zip(*tri, strict=True)])

    products = [[0] * d for _ in range(d)]
    for (i, j, shift), value in _added(vectors, scatter, ("i", "j", "shift")).items():
        products[i][j] += value << LIMB * shift
    rest = [s - n * c for s, c in zip(total, centre, strict=True)]
    whole = [[n * products[min(i, j)][max(i, j)] - rest[i] * rest[j] for j in range(d)] for i in range(d)]
    found, vecs, trace = spectrum(rows.sparkSession, whole, components)
    return Whitening(n, tuple(total), np.array(vecs).reshape(-1, d), np.array([float(e / n**2) for e in found]),
                     np.array([float(e / trace) for e in found]), scale, offset)


def spectrum(spark, matrix: list[list[int]], most: int):
    """(eigenvalues as fractions, unit eigenvectors, trace) of a positive semidefinite integer matrix: the ``most`` largest
    that are not zero, repeated ones as often as they occur."""
    d, trace = len(matrix), sum(matrix[i][i] for i in range(len(matrix)))
    if not trace:
        return [], [], trace
    unit = gcd(*(x for row in matrix for x in row))
    small = [[x // unit for x in row] for row in matrix]

    def image(batches):
        for batch in batches:
            got = [polynomial_mod(np.array([[x % p for x in row] for row in small], np.int64), p).tolist()
                   for p in batch.column(0).to_pylist()]
            yield pa.record_batch([batch.column(0), pa.array(got, pa.list_(pa.int64()))], names=["p", "c"])

    def job(items, schema, run, out):
        width = min(len(items), spark.sparkContext.defaultParallelism)
        return spark.createDataFrame(items, schema).repartition(width).mapInArrow(run, out).collect()

    images = job([(p,) for p in primes(coefficient_bits(trace // unit, d))], "p long", image, "p long, c array<long>")
    found = roots(remainders([(r["p"], r["c"]) for r in images]))
    digits = 60 + max(r.high.bit_length() + r.bits for r in found) // 3
    top, have = [], 0
    for r in found:
        if have < most:
            top.append(r)
            have += r.times

    def direction(batches):
        for batch in batches:
            rows = batch.to_pylist()
            got = [eigenvectors(small, Root(int(r["low"]), int(r["high"]), r["bits"], r["times"]), digits) for r in rows]
            yield pa.record_batch([batch.column(0), pa.array(got, pa.list_(pa.list_(pa.float64())))], names=["k", "v"])

    got = {r["k"]: r["v"] for r in job([(k, str(r.low), str(r.high), r.bits, r.times) for k, r in enumerate(top)],
                                       "k int, low string, high string, bits int, times int", direction,
                                       "k int, v array<array<double>>")}
    pairs = [(r.middle() * unit, v) for k, r in enumerate(top) for v in got[k]][:most]
    return [e for e, _ in pairs], [v for _, v in pairs], trace


def identity_error(rows: DataFrame, model: Whitening) -> float:
    """Largest absolute entry of the whitened vectors' covariance (centred, divisor n) less the identity."""
    k = len(model.values)

    def totals(run_block, keys):
        def run(batches):
            acc = 0
            for batch in batches:
                for _, x in _blocks(batch, model.scale, model.offset):
                    acc = acc + run_block(model.numerators(x)[1])
            if not np.isscalar(acc):
                yield pa.record_batch([pa.array(a.ravel(), t) for a, t in zip(
                    [*np.indices(acc.shape), acc], [pa.int32()] * acc.ndim + [pa.float64()], strict=True)], names=[*keys, "value"])
        kinds = ", ".join(f"{c} int" for c in keys)
        added = rows.select("v").mapInArrow(run, f"{kinds}, value double").groupBy(*keys).agg(F.sum("value").alias("value"))
        out = np.zeros((k,) * len(keys))
        for r in added.collect():
            out[tuple(r[c] for c in keys)] = r["value"] / model.n
        return out

    mean = totals(lambda w: w.sum(0), ("i",))
    return float(np.abs(totals(lambda w: (w - mean).T @ (w - mean), ("i", "j")) - np.eye(k)).max())


def transform(rows: DataFrame, model: Whitening, id_type: str = "long") -> DataFrame:
    """(id, ``deviation`` decimal: sum of (n * x - sums)**2, null from 10**38, ``whitened`` array) of every row."""
    def run(batches):
        for batch in batches:
            deviation, whitened = [], []
            for _, x in _blocks(batch, model.scale, model.offset):
                exact, w = model.numerators(x)
                wide = exact.dtype == object or float(np.abs(exact).max(initial=0)) ** 2 * exact.shape[1] >= 2**62
                square = exact.astype(object) if wide else exact
                deviation += [x if x < 10**38 else None for x in (square * square).sum(1).tolist()]
                whitened += w.tolist()
            yield pa.record_batch([batch.column(0), pa.array(deviation, pa.decimal128(38, 0)),
                                   pa.array(whitened, pa.list_(pa.float64()))], names=["id", "deviation", "whitened"])

    return rows.mapInArrow(run, f"id {id_type}, deviation decimal(38,0), whitened array<double>")


def whiten(vectors: DataFrame, components: int = 32, scale: int = 64, offset: int = 0, id_col: str = "vec_id",
           vector_col: str = "embedding") -> DataFrame:
    """A row for each usable vector and component: id, ``component`` (from 1), ``n``, ``deviation`` (exact: the sum over
    dimensions of (n * x - sums)**2; null from 10**38), ``whitened``, ``explained`` and ``identity_error``."""
    rows = usable(vectors, id_col, vector_col)
    model = fit(rows, components, scale, offset)
    error = identity_error(rows, model) if len(model.values) else 0.0
    of = F.array(*(F.lit(float(x)) for x in model.explained)).cast("array<double>")
    out = transform(rows, model, vectors.schema[id_col].dataType.simpleString())
    return out.select("id", "deviation", F.posexplode("whitened").alias("at", "whitened")).select(
        F.col("id").alias(id_col), (F.col("at") + 1).alias("component"), F.lit(model.n).cast("long").alias("n"), "deviation",
        "whitened", F.get(of, "at").alias("explained"), F.lit(error).alias("identity_error"))
