"""SimHash near-duplicates linked through deletion-variant signatures.

Fingerprints within ``bits`` differing bits have, once cut into ``(bits + 1) // 2`` segments, one segment that
differs by at most one bit. Each segment is therefore indexed under its one-wildcard variants (one bit
deleted): two segments that differ by at most one bit share a variant, so an equality join on (segment,
deleted bit, rest) meets every linked pair, and the full distance decides.

Only distinct fingerprints are indexed. The index travels as packed blocks, one per (map task, part); a part
sorts its entries, verifies distances, and emits a spanning forest of its links, never all pairs of a bucket.
Buckets that a bounded sample shows to be hot are cut further by a quarter of the remaining bits (one of
four quarters is equal within three differing bits), which loses no link.

Null or empty texts have no words: fingerprint zero, linked like any other. Repeated rows share a
fingerprint. A null id keeps its row and never becomes a component's id unless no other is there.
"""

from __future__ import annotations

from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from snapflow.llm.common import mix64, partitions, some_rows
from snapflow.llm.components import components
from snapflow.session import reliable_checkpoint

#: Fingerprints sampled to find hot buckets, the share of the sample that makes one hot, entries of a part.
SAMPLE, HOT_SHARE, PART_ENTRIES = 20_000, 1 / 256, 250_000
_SEED = 42


def _signature(words: list[bytes], shingle: int) -> int:
    """The fingerprint: each bit is that of over half the shingles' hashes."""
    if not words:
        return 0
    if len(words) <= shingle:
        grams = iter([b" ".join(words)])
        n = 1
    else:
        n = len(words) - shingle + 1
        grams = map(b" ".join, zip(*(words[i:] for i in range(shingle)), strict=False))
    ones = np.zeros(64, np.int64)
    left = n
    while left:
        k = min(left, 1 << 16)
        h = np.fromiter(map(xxh64_intdigest, grams, repeat(_SEED)), np.uint64, k)
        ones += np.unpackbits(h.view(np.uint8).reshape(k, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int32)
        left -= k
    return int(np.packbits(2 * ones > n, bitorder="little").view(np.int64)[0])


def fingerprints(docs: DataFrame, shingle: int = 3, id_col: str = "doc_id", text_col: str = "text",
                 carry: tuple[str, ...] = ()) -> DataFrame:
    """(id, the columns ``carry``, ``fp`` long) of every row; words are split at ASCII white space, A-Z lower-cased."""
    docs = docs.select(F.col(id_col).cast("long"), *carry, text_col)
    kinds = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in docs.schema.fields[:-1])

    def run(batches):
        for batch in batches:
            fps = [_signature((t.as_py() or "").encode().lower().split(), shingle) for t in batch.column(batch.num_columns - 1)]
            yield pa.record_batch([*batch.columns[:-1], pa.array(fps, pa.int64())], names=[*batch.schema.names[:-1], "fp"])

    return docs.mapInArrow(run, f"{kinds}fp long")


def _variants(fp: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """(entry's fingerprint, key) of every one-wildcard variant of every segment."""
    m = (bits + 1) // 2
    cuts = np.linspace(0, 64, m + 1).astype(int)
    keys = []
    for s, (lo, hi) in enumerate(zip(cuts, cuts[1:], strict=False)):
        segment = (fp >> np.uint64(lo)) & np.uint64((1 << int(hi - lo)) - 1)
        for j in range(hi - lo):
            low = segment & np.uint64((1 << j) - 1)
            rest = (segment >> np.uint64(j + 1)) << np.uint64(j) | low
            keys.append(mix64(rest ^ mix64(np.array([s * 64 + j + 1], np.uint64))[0]))
    return np.tile(fp, len(keys)), np.concatenate(keys)


def _refine(fp: np.ndarray, key: np.ndarray, hot: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Entries of hot keys once for each 16-bit quarter of the fingerprint, keyed by its value too."""
    if not len(hot):
        return fp, key
    at = np.minimum(np.searchsorted(hot, key), len(hot) - 1)
    is_hot = hot[at] == key
    f, k = fp[is_hot], key[is_hot]
    fs, ks = [fp[~is_hot]], [key[~is_hot]]
    for q in range(4):
        quarter = (f >> np.uint64(16 * q)) & np.uint64(0xFFFF)
        fs.append(f)
        ks.append(mix64(k ^ mix64(quarter + np.uint64((q + 1) << 32))))
    return np.concatenate(fs), np.concatenate(ks)


def _links(fp: np.ndarray, key: np.ndarray, bits: int) -> np.ndarray:
    """Linked pairs within equal keys, (n, 2): all of a small bucket, a spanning forest of a larger one."""
    order = np.lexsort((fp, key))
    fp, key = fp[order], key[order]
    start = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
    length = np.diff(np.r_[start, len(key)])
    out = []
    small = np.repeat(length <= 8, length)
    for d in range(1, 8):
        i = np.flatnonzero((key[d:] == key[:-d]) & small[d:])
        i = i[np.bitwise_count(fp[i] ^ fp[i + d]) <= bits]
        out.append(np.stack([fp[i], fp[i + d]], 1))
    for k in np.flatnonzero(length > 8):
        left = np.unique(fp[start[k]:start[k] + length[k]])
        todo = []
        while todo or len(left):
            if not todo:
                todo, left = [left[0]], left[1:]
            x = todo.pop()
            near = np.bitwise_count(left ^ x) <= bits
            if near.any():
                found = left[near]
                left = left[~near]
                out.append(np.stack([np.full(len(found), x), found], 1))
                todo.extend(found)
    pairs = np.concatenate(out) if out else np.empty((0, 2), np.uint64)
    return np.unique(pairs, axis=0) if len(pairs) else pairs


def _forest(pairs: np.ndarray) -> np.ndarray:
    """A spanning forest of the pairs."""
    root: dict[int, int] = {}

    def find(x: int) -> int:
        while (up := root.get(x, x)) != x:
            root[x] = root.get(up, up)
            x = up
        return x

    keep = []
    for a, b in pairs.tolist():
        x, y = find(a), find(b)
        if x != y:
            root[max(x, y)] = min(x, y)
            keep.append((a, b))
    return np.array(keep, np.uint64).reshape(-1, 2)


def links(fps: DataFrame, bits: int = 3) -> DataFrame:
    """Links (a, b) between distinct fingerprints (column ``fp``) that connect all within ``bits`` bits."""
    if not 1 <= bits <= 3:
        raise ValueError("bits must be 1, 2 or 3: hot buckets are cut by quarters, one of which must be equal")
    n = fps.count()
    per = len(_variants(np.zeros(1, np.uint64), bits)[0])
    parts = max(1, -(-n * per // PART_ENTRIES))
    if n > SAMPLE:
        some = some_rows(fps, n, SAMPLE).toPandas()["fp"].to_numpy(np.int64).view(np.uint64)
        k, c = np.unique(_variants(some, bits)[1], return_counts=True)
        hot = k[c > len(some) * HOT_SHARE]
    else:
        hot = np.empty(0, np.uint64)

    def index(batches):
        for batch in batches:
            values = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
            for lo in range(0, len(values), 1 << 14):
                fp, key = _refine(*_variants(values[lo:lo + (1 << 14)], bits), hot)
                part = (key % np.uint64(parts)).astype(np.int64)
                order = np.argsort(part, kind="stable")
                ids, first = np.unique(part[order], return_index=True)
                blocks = [np.concatenate([fp[o], key[o]]).tobytes() for o in np.split(order, first[1:])]
                yield pa.record_batch([pa.array(ids, pa.int64()), pa.array(blocks, pa.binary())], names=["part", "block"])

    def meet(batches):
        for part, blocks in _by_part(batches):
            both = [np.frombuffer(b, np.uint64).reshape(2, -1) for b in blocks]
            edges = _forest(_links(np.concatenate([x[0] for x in both]), np.concatenate([x[1] for x in both]), bits))
            if len(edges):
                e = edges.view(np.int64)
                yield pa.record_batch([pa.array(e[:, 0].copy()), pa.array(e[:, 1].copy())], names=["a", "b"])

    deal = min(parts, 4 * partitions(fps))
    # a stored frame of fingerprints has few partitions for the entries that it makes
    blocks = fps.select("fp").repartition(deal, "fp").mapInArrow(index, "part long, block binary")
    return (blocks.repartition(deal, "part").sortWithinPartitions("part")
            .mapInArrow(meet, "a long, b long"))


def _by_part(batches):
    """(part, blocks) of rows sorted by part, across Arrow batches."""
    now, blocks = None, []
    for batch in batches:
        for part, block in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            if part != now and blocks:
                yield now, blocks
                blocks = []
            now = part
            blocks.append(block)
    if blocks:
        yield now, blocks


def near_duplicates(docs: DataFrame, shingle: int = 3, bits: int = 3, id_col: str = "doc_id",
                    text_col: str = "text", carry: tuple[str, ...] = ()) -> DataFrame:
    """Per row: id, the columns ``carry``, ``fp`` (long), ``root`` (a fingerprint that names the component) and
    ``component_id``: the least id reachable over links of at most ``bits`` bits."""
    rows = reliable_checkpoint(fingerprints(docs, shingle, id_col, text_col, carry))
    reps = reliable_checkpoint(rows.groupBy("fp").agg(F.min(id_col).alias("rep")))
    stars = components(links(reps.select("fp"), bits))
    rooted = reps.join(stars, reps.fp == stars.node, "left").select(
        "fp", "rep", F.coalesce("root", "fp").alias("root"))
    least = rooted.groupBy("root").agg(F.min("rep").alias("component_id"))
    of = rooted.select("fp", "root").join(least, "root").select(F.col("fp").alias("of"), "root", "component_id")
    return rows.join(of, rows.fp == F.col("of"), "left").select(id_col, *carry, "fp", "root", "component_id")
