"""Approximate nearest neighbours by inner product, with an adaptive scan of dimensions.

Vectors are dealt to bands of norms, each within a factor of two. In a band they are divided by its greatest norm
and get one more coordinate that gives all of them norm 1, queries are divided by their own, so that the largest
inner product is the least Euclidean distance, whatever the norms of other bands; then comes a random rotation. A
coarse index (k-means on a bounded sample, by band) deals all vectors to lists of about ``LIST`` vectors; a query
visits its nearest lists in each band, as many as the sample's own nearest neighbours in that band need for the
``recall`` asked for, and one at least. Within a list the distance is summed over blocks of
columns; after each block a candidate is given up once its partial distance, scaled to all dimensions, exceeds
the current threshold by more than a hypothesis test allows (``ADAPT``). Candidates that stay get their exact
inner product on the original vectors in double precision.

Equal vectors are one class, searched once as a candidate and once as a query, with the ``k + 1`` least ids of
each class: enough for every query, since a class's further copies come after those. Lists are split so that
no group holds more than about ``GROUP`` vectors or queries of a list.

Vectors that are null, zero, of another length than most, or hold null or non-finite components take no part,
nor do rows without id. Rows with the query's id are its own. Ties go to the smaller id. An empty table gives
an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from snapflow.llm.common import partitions, some_rows
from snapflow.session import reliable_checkpoint

#: Vectors a list should have; lists at most; vectors and queries sampled to place them; rounds of k-means.
LIST, MAX_LISTS, SAMPLE, ASKED, ROUNDS = 1000, 16_384, 131_072, 256, 8
GROUP = 4000
#: Columns of a block; tolerance of the test, in units of 1 / sqrt(dimensions seen).
BLOCK, ADAPT = 16, 2.1
_STEP = 1024


def usable(v: Column) -> Column:
    """Whether a vector takes part."""
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(v.isNotNull() & (F.size(v) > 0) & finite & F.exists(v, lambda x: x != 0), F.lit(False))


def _matrix(col: pa.Array, dim: int) -> np.ndarray:
    return col.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)


def _norms(x: np.ndarray) -> np.ndarray:
    """Norms that neither overflow nor vanish in the squares."""
    top = np.maximum(np.abs(x).max(axis=1), np.finfo(np.float64).tiny)
    return top * np.sqrt(((x / top[:, None]) ** 2).sum(axis=1))


def _bands(norms: np.ndarray) -> np.ndarray:
    """The band of each norm; the edges lie off the powers of two, so that norms of about 1 share one."""
    return np.ceil(np.log2(norms) - 0.5).astype(np.int32)


class Space:
    """The rotated space of unit vectors, a part for each band of norms, the centres of its lists, and how many lists
    a query must visit. ``bands``: number, rows and greatest norm of each, in ascending order."""

    def __init__(self, sample: np.ndarray, bands: list[tuple[int, int, float]], k: int, recall: float) -> None:
        rng = np.random.default_rng(7)
        dim, n = sample.shape[1], sum(rows for _, rows, _ in bands)
        self.bands, self.norms = np.array([b for b, _, _ in bands]), np.array([norm for _, _, norm in bands])
        self.rotation = np.linalg.qr(rng.standard_normal((dim + 1, dim + 1)))[0].astype(np.float32)
        x, of = self.place(sample)
        centres = []
        for b, (_, rows, _) in enumerate(bands):
            mine = x[of == b]
            centres.append(self._means(mine, max(1, min(MAX_LISTS * rows // n, rows // LIST, len(mine) // 8)), rng))
        self.centres = np.concatenate(centres)
        self.first = np.cumsum([0, *map(len, centres)])
        q = rng.choice(len(sample), min(ASKED, len(sample)), replace=False)
        order = np.argsort(-(sample[q] @ sample.T), axis=1)[:, :k]
        asked, to = self.ask(sample[q]), self.lists(x, of)
        self.probes = []
        for b in range(len(bands)):
            place = np.argsort(self._near(asked, b, self.first[b + 1] - self.first[b], in_order=True), axis=1)
            query, hit = np.nonzero(of[order] == b)
            need = place[query, to[order[query, hit]] - self.first[b]]
            self.probes.append(int(np.quantile(need, recall, method="higher")) + 1 if len(need) else 1)

    def _means(self, x: np.ndarray, lists: int, rng: np.random.Generator) -> np.ndarray:
        """Centres of ``lists`` lists; of a band that the sample misses, the origin."""
        if not len(x):
            return np.zeros((1, x.shape[1]), np.float32)
        centres = x[rng.choice(len(x), lists, replace=False)]
        for _ in range(ROUNDS):
            near = self._nearest(x, centres)
            count = np.bincount(near, minlength=len(centres))
            total = np.zeros((len(centres), x.shape[1]))
            np.add.at(total, near, x)
            some = count > 0
            centres[some] = (total[some] / count[some, None]).astype(np.float32)
        return centres

    def place(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Candidates in the rotated space, and the position of each one's band."""
        of = np.minimum(np.searchsorted(self.bands, _bands(_norms(x))), len(self.bands) - 1)
        x = x / self.norms[of][:, None]
        last = np.sqrt(np.maximum(1 - (x * x).sum(axis=1), 0))
        return np.c_[x, last].astype(np.float32) @ self.rotation, of

    def ask(self, q: np.ndarray) -> np.ndarray:
        """Queries in the rotated space."""
        return np.c_[q / _norms(q)[:, None], np.zeros(len(q))].astype(np.float32) @ self.rotation

    @staticmethod
    def _nearest(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
        size = (centres * centres).sum(axis=1)
        out = [np.argmin(size - 2 * (x[lo:lo + 4096] @ centres.T), axis=1) for lo in range(0, len(x), 4096)]
        return np.concatenate(out) if out else np.empty(0, np.int64)

    def lists(self, x: np.ndarray, of: np.ndarray) -> np.ndarray:
        """The list of each candidate: the nearest of its band."""
        out = np.zeros(len(x), np.int64)
        for b in np.unique(of):
            mine = of == b
            out[mine] = self.first[b] + self._nearest(x[mine], self.centres[self.first[b]:self.first[b + 1]])
        return out

    def visits(self, q: np.ndarray) -> np.ndarray:
        """The lists that each query visits."""
        return np.concatenate([self.first[b] + self._near(q, b, n) for b, n in enumerate(self.probes)], axis=1)

    def _near(self, q: np.ndarray, b: int, n: int, in_order: bool = False) -> np.ndarray:
        """The ``n`` nearest lists of each query in a band, counted within the band."""
        out = []
        centres = self.centres[self.first[b]:self.first[b + 1]]
        size = (centres * centres).sum(axis=1)
        for lo in range(0, len(q), 4096):
            d = size - 2 * (q[lo:lo + 4096] @ centres.T)
            out.append(np.argsort(d, axis=1)[:, :n] if in_order else np.argpartition(d, n - 1, axis=1)[:, :n])
        return np.concatenate(out) if out else np.empty((0, n), np.int64)


def adaptive_scan(q: np.ndarray, x: np.ndarray, k: int) -> np.ndarray:
    """Positions in ``x`` of about the ``k`` nearest to ``q``: candidates are given up early."""
    dim = len(q)
    kept, dist = np.empty(0, np.int64), np.empty(0, np.float32)
    for lo in range(0, len(x), _STEP):
        at = np.arange(lo, min(lo + _STEP, len(x)))
        bound = dist.max() if len(dist) >= k else np.inf
        partial = np.zeros(len(at), np.float32)
        for c in range(0, dim, BLOCK):
            d = x[at, c:c + BLOCK] - q[c:c + BLOCK]
            partial += np.einsum("ij,ij->i", d, d)
            seen = min(c + BLOCK, dim)
            if bound < np.inf:
                allowed = bound if seen == dim else bound * seen / dim * (1 + ADAPT / np.sqrt(seen)) ** 2
                stay = partial <= allowed
                at, partial = at[stay], partial[stay]
                if not len(at):
                    break
        kept, dist = np.r_[kept, at], np.r_[dist, partial]
        if len(kept) > k:
            best = np.argpartition(dist, k - 1)[:k]
            kept, dist = kept[best], dist[best]
    return kept


def search(vectors: DataFrame, is_query: Column, k: int = 20, recall: float = 0.95, id_col: str = "vec_id",
           vector_col: str = "embedding") -> DataFrame:
    """Per query row: ``query_id``, ``rank`` (from 1), ``vec_id``, ``score`` of its ``k`` nearest other rows.

    ``is_query`` is a condition on the column ``id``. Fewer candidates than ``k``: all of them. ``recall`` sets how
    many lists a query visits; it is met on the sample's own neighbours. Every query row has an answer of its own, from all
    rows of other ids: rows of one id never find each other, rows of another id count as often as they occur.
    """
    spark = vectors.sparkSession
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("v"))
    rows = rows.where(F.col("id").isNotNull() & usable(F.col("v")))
    top = Window.partitionBy("v").orderBy("id")
    each = F.array_repeat("id", F.least(F.col("times"), F.lit(k)).cast("int"))
    classes = (rows.groupBy("v", "id").agg(F.count("*").alias("times"))          # k ids and rows are left without any one id
               .withColumn("n", F.row_number().over(top)).where(F.col("n") <= k + 1)
               .groupBy("v").agg(F.sort_array(F.flatten(F.collect_list(each))).alias("ids")))
    classes = reliable_checkpoint(classes.withColumn("class", F.monotonically_increasing_id()))
    sizes = classes.groupBy(F.size("v").alias("dim")).count().orderBy(F.desc("count"), "dim").first()
    schema = "query_id long, rank int, vec_id long, score double"
    if sizes is None:
        return spark.createDataFrame([], schema)
    dim, n = sizes["dim"], sizes["count"]
    classes = classes.where(F.size("v") == dim)

    def band(batches):
        for batch in batches:
            norms = _norms(_matrix(batch.column(0), dim))
            yield pa.record_batch([pa.array(_bands(norms)), pa.array(norms)], names=["band", "norm"])

    bands = (classes.select("v").mapInArrow(band, "band int, norm double").groupBy("band")
             .agg(F.count("*").alias("n"), F.max("norm").alias("norm")).collect())       # at most some 2,100 rows
    bands = sorted((r["band"], r["n"], r["norm"]) for r in bands)
    sample = some_rows(classes, n, SAMPLE).select("v").toArrow().column("v").combine_chunks()
    space = spark.sparkContext.broadcast(Space(_matrix(sample, dim), bands, k, recall))

    queries = rows.where(is_query & (F.size("v") == dim))
    several = queries.groupBy("id").count().where("count > 1").select(F.col("id").alias("own"))
    queries = queries.join(several, F.col("id") == F.col("own"), "left")          # ids of several rows ask for themselves
    asked = queries.select("v", "own").distinct().join(classes, "v").select("class", "v", "own")

    def deal(asks: bool):
        def run(batches):
            for batch in batches:
                x = _matrix(batch.column(1), dim)
                s = space.value
                to = s.visits(s.ask(x)) if asks else s.lists(*s.place(x))[:, None]
                take = np.repeat(np.arange(len(x)), to.shape[1])
                yield pa.record_batch([pa.array(to.ravel().astype(np.int32)), *(c.take(pa.array(take)) for c in batch.columns)],
                                      names=["list", *batch.schema.names])
        return run

    kind = next(f.dataType.simpleString() for f in rows.schema if f.name == "v")
    dealt = reliable_checkpoint(classes.select("class", "v", "ids").mapInArrow(
        deal(False), f"list int, class long, v {kind}, ids array<long>"))
    asking = reliable_checkpoint(asked.mapInArrow(deal(True), f"list int, class long, v {kind}, own long"))
    # at most one row a list: the numbers of its splits
    held = dealt.groupBy("list").agg(F.ceil(F.count("*") / GROUP).alias("vs"))
    wanted = asking.groupBy("list").agg(F.ceil(F.count("*") / GROUP).alias("qs"))
    splits = F.broadcast(held.join(wanted, "list"))
    salt = F.xxhash64("class")
    dealt = (dealt.join(splits, "list").withColumn("s", F.pmod(salt, "vs").cast("int"))
             .withColumn("b", F.explode(F.sequence(F.lit(0), (F.col("qs") - 1).cast("int"))))
             .select("list", "s", "b", "class", "v", "ids"))
    asking = (asking.join(splits, "list").withColumn("b", F.pmod(salt, "qs").cast("int"))
              .withColumn("s", F.explode(F.sequence(F.lit(0), (F.col("vs") - 1).cast("int"))))
              .select("list", "s", "b", "class", "v", "own"))

    def scan(left: pa.Table, right: pa.Table) -> pa.Table:
        out: tuple[list, list, list] = ([], [], [])
        if left.num_rows and right.num_rows:
            x, q = (_matrix(t.column("v").combine_chunks(), dim) for t in (left, right))
            ids = left.column("ids").to_pylist()
            least, most = (np.array([i[e] for i in ids]) for e in (0, -1))
            s = space.value
            xs, qs = s.place(x)[0], s.ask(q)
            for c, own, v, w in zip(right.column("class").to_pylist(), right.column("own").to_pylist(), q, qs, strict=True):
                if own is None:
                    near = adaptive_scan(w, xs, k + 1)
                else:
                    others = np.flatnonzero((least != own) | (most != own))      # classes of the own id alone stay out
                    near = others[adaptive_scan(w, xs[others], k + 1)]
                score = x[near] @ v
                best = sorted((-p, i) for p, a in zip(score.tolist(), near.tolist(), strict=True) for i in ids[a] if i != own)[:k + 1]
                out[0].append(c)
                out[1].append(own)
                out[2].append([{"minus": p, "vec_id": i} for p, i in best])
        return pa.table({"class": pa.array(out[0], pa.int64()), "own": pa.array(out[1], pa.int64()),
                         "near": pa.array(out[2], pa.list_(pa.struct([("minus", pa.float64()), ("vec_id", pa.int64())])))})

    keys = ["list", "s", "b"]
    found = (dealt.repartition(partitions(vectors), *keys).groupBy(*keys).cogroup(asking.groupBy(*keys))
             .applyInArrow(scan, "class long, own long, near array<struct<minus:double,vec_id:long>>"))
    # one short list from each visited split: their union is merged, not spread out as rows
    found = found.groupBy("class", F.col("own").alias("asker")).agg(F.slice(F.sort_array(F.flatten(F.collect_list("near"))), 1, k + 1).alias("near"))
    of = queries.join(classes.select("v", "class"), "v").select(F.col("id").alias("query_id"), "class", "own")
    own = F.filter("near", lambda x: x["vec_id"] != F.col("query_id"))
    met = of.join(found, (of["class"] == found["class"]) & F.col("own").eqNullSafe(F.col("asker")))
    return (met.select("query_id", F.posexplode(F.slice(own, 1, k)).alias("p", "x"))
            .select("query_id", (F.col("p") + 1).alias("rank"), "x.vec_id", (-F.col("x.minus")).alias("score")))
