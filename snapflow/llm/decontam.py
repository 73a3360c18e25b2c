"""Benchmark decontamination: an FM-index for each shard of training text finds every occurrence of every
benchmark window, and the words of the occurrences become removal spans.

A shard is a run of whole documents of about ``SHARD_BYTES``. Words that no window holds can't be part of
an occurrence, so a shard's index covers its maximal runs of window words, as integer sequences, a separator
after each run; runs shorter than the shortest window hold none. All windows are searched together.

The windows are broadcast in groups of at most ``GROUP_BYTES`` of benchmark text, one pass over the
documents for each group; a pass takes up the spans and items of the pass before it.

Null or empty texts have no words. Repeated items count once per id; items without id mark words but are
not listed; items without words are never found. No documents: an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapflow.llm.common import lower_ascii, mix64, pieces, utf8
from snapflow.llm.fmindex import FMIndex

SHARD_BYTES, GROUP_BYTES = 4 << 20, 16 << 20

_IS_WORD = np.array([0x30 <= b <= 0x39 or 0x41 <= b <= 0x5A or 0x61 <= b <= 0x7A or b >= 0x80 for b in range(256)])
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_CODE = mix64(np.arange(1, 257, dtype=np.uint64))
_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the hash base and of its inverse, modulo 2**64."""
    if len(_powers[0]) < n:
        for k, base in enumerate((_BASE, _INVERSE)):
            p = np.full(n, base, np.uint64)
            p[0] = 1
            _powers[k] = np.cumprod(p)
    return _powers[0], _powers[1]


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(first byte, end byte, 64-bit hash) of each word of the rows, and the rows' word offsets.

    Words are runs of digits, letters (A-Z lower-cased for the hash) and bytes from 0x80, within a row. The
    hash is a polynomial modulo 2**64 over random byte codes, mixed with the length.
    """
    n = len(data)
    is_word = _IS_WORD[data]
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True
    before = np.zeros(n, bool)
    before[1:] = is_word[:-1]
    start = np.flatnonzero(is_word & (~before | edge[:n]))
    after = np.zeros(n, bool)
    after[:-1] = is_word[1:]
    end = np.flatnonzero(is_word & (~after | edge[1:])) + 1
    up, down = _power(n + 1)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(_CODE[lower_ascii(data)] * up[:n], out=total[1:])
    h = mix64((total[end] - total[start]) * down[start] + (end - start).astype(np.uint64))
    return start, end, h, np.searchsorted(start, offsets)


class Windows:
    """The windows of a group of benchmark items, as vocabulary numbers from 1."""

    def __init__(self, items: list[tuple[int | None, str]], width: int) -> None:
        texts = pa.array([t or "" for _, t in items], pa.string())
        _, _, h, at = words(*utf8(texts))
        self.vocabulary = np.unique(h)
        number = np.searchsorted(self.vocabulary, h) + 1
        owners: dict[tuple, set] = {}
        for (item, _), lo, hi in zip(items, at, at[1:], strict=False):
            w = min(width, hi - lo)
            for k in range(lo, hi - w + 1) if w else ():
                owners.setdefault(tuple(number[k:k + w].tolist()), set()).add(item)
        self.patterns, self.owners = {}, {}  # by length
        for p in sorted(owners, key=lambda p: (len(p), p)):
            self.patterns.setdefault(len(p), []).append(p)
            self.owners.setdefault(len(p), []).append(sorted(x for x in owners[p] if x is not None))
        self.patterns = {w: np.array(p, np.int64) for w, p in self.patterns.items()}

    def find(self, h: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, dict[int, set]]:
        """(word is hit, items found by row) for a shard's word hashes and the rows' word offsets."""
        hit = np.zeros(len(h) + 1, np.int64)
        found: dict[int, set] = {}
        if not len(h) or not self.patterns:
            return hit[:-1].astype(bool), found
        k = np.minimum(np.searchsorted(self.vocabulary, h), len(self.vocabulary) - 1)
        number = np.where(self.vocabulary[k] == h, k + 1, 0)
        known = number > 0
        cut = np.zeros(len(h) + 1, bool)
        cut[at] = True
        first = np.flatnonzero(known & (np.r_[True, ~known[:-1]] | cut[:-1]))
        last = np.flatnonzero(known & (np.r_[~known[1:], True] | cut[1:])) + 1
        long = last - first >= min(self.patterns)
        first, last = first[long], last[long]
        if not len(first):
            return hit[:-1].astype(bool), found
        size = last - first + 1  # with its separator
        where = np.repeat(first - np.r_[0, np.cumsum(size)[:-1]], size) + np.arange(size.sum())
        ends = np.cumsum(size) - 1
        symbols = number[np.minimum(where, len(h) - 1)]
        symbols[ends] = 0
        index = FMIndex(symbols, len(self.vocabulary))
        for width, patterns in self.patterns.items():
            lo, hi = index.search(patterns)
            count = np.maximum(hi - lo, 0)
            which = np.repeat(np.arange(len(lo)), count)
            rows = np.repeat(lo, count) + np.arange(len(which)) - np.repeat(np.cumsum(count) - count, count)
            word = where[index.locate(rows)]
            np.add.at(hit, word, 1)
            np.add.at(hit, word + width, -1)
            row = np.searchsorted(at, word, side="right") - 1
            owners = self.owners[width]
            for r, p in np.unique(np.stack([row, which], 1), axis=0).tolist():
                found.setdefault(r, set()).update(owners[p])
        return np.cumsum(hit)[:-1] > 0, found


_SPANS = "spans array<struct<word:long,word_end:long,byte:long,byte_end:long>>"


def _merge(spans: list[dict]) -> list[dict]:
    out: list[dict] = []
    for s in sorted(spans, key=lambda s: s["word"]):
        if out and s["word"] <= out[-1]["word_end"]:
            if s["word_end"] > out[-1]["word_end"]:
                out[-1] |= {"word_end": s["word_end"], "byte_end": s["byte_end"]}
        else:
            out.append(dict(s))
    return out


def _pass(docs: DataFrame, group, width: int) -> DataFrame:
    span = pa.struct([(k, pa.int64()) for k in ("word", "word_end", "byte", "byte_end")])

    def run(batches):
        windows = Windows(group.value, width)
        for batch in batches:
            data, offsets = utf8(batch.column(1))
            for lo, hi in pieces(offsets, SHARD_BYTES):
                base = offsets[lo]
                start, end, h, at = words(data[base:offsets[hi]], offsets[lo:hi + 1] - base)
                hit, found = windows.find(h, at)
                first = np.flatnonzero(hit & ~np.r_[False, hit[:-1]] | hit & _edges(at, len(h))[:-1])
                last = np.flatnonzero(hit & ~np.r_[hit[1:], False] | hit & _edges(at, len(h))[1:]) + 1
                row = np.searchsorted(at, first, side="right") - 1
                part = batch.slice(lo, hi - lo)
                spans, items = part.column(3).to_pylist(), part.column(4).to_pylist()
                for r, a, b in zip(row.tolist(), first.tolist(), last.tolist(), strict=True):
                    origin = int(offsets[lo + r] - base)
                    spans[r] = [*(spans[r] or []), {"word": a - int(at[r]), "word_end": b - int(at[r]),
                                                    "byte": int(start[a]) - origin, "byte_end": int(end[b - 1]) - origin}]
                for r, got in found.items():
                    items[r] = sorted({*(items[r] or []), *got})
                yield pa.record_batch([
                    part.column(0), part.column(1), pa.array(np.diff(at), pa.int64()),
                    pa.array([_merge(s or []) for s in spans], pa.list_(span)),
                    pa.array([x or [] for x in items], pa.list_(pa.int64()))],
                    names=["row", "text", "n_words", "spans", "items"])

    row = next(f.dataType.simpleString() for f in docs.schema if f.name == "row")
    return docs.mapInArrow(run, f"row {row}, text string, n_words long, {_SPANS}, items array<long>")


def _edges(at: np.ndarray, n: int) -> np.ndarray:
    edge = np.zeros(n + 1, bool)
    edge[at] = True
    return edge


def find(docs: DataFrame, benchmark: DataFrame, width: int = 10, row: str = "doc_id", text_col: str = "text",
         item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """Per row: ``row`` (that column), ``text``, ``n_words``, ``spans`` (merged hit words, with their bytes in
    the text), ``items`` (ids of the items with an occurring window, sorted)."""
    spark = docs.sparkSession
    items = benchmark.select(F.col(item_col).cast("long").alias("item"), F.col(item_text).alias("text"))
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    groups = -(-size // GROUP_BYTES) or 1
    out = docs.select(F.col(row).alias("row"), F.col(text_col).alias("text"), F.lit(0).cast("long").alias("n_words"),
                      F.expr(f"cast(null as {_SPANS.split(' ', 1)[1]})").alias("spans"),
                      F.expr("cast(null as array<long>)").alias("items"))
    for g in range(groups):
        part = items.where(F.pmod(F.xxhash64("item", "text"), F.lit(groups)) == g)
        out = _pass(out, spark.sparkContext.broadcast([tuple(x) for x in part.collect()]), width)
    return out


def digest(found: DataFrame) -> DataFrame:
    """Counts and the digest of the items, from what ``find`` returns."""
    names = F.array_join(F.array_sort(F.transform("items", lambda x: x.cast("string"))), ",")
    hits = F.aggregate("spans", F.lit(0).cast("long"), lambda a, s: a + s["word_end"] - s["word"])
    return found.select(F.col("row").alias("doc_id"), "n_words", hits.alias("n_hit"),
                        F.size("items").cast("long").alias("n_items"), F.sha2(names, 256).alias("items_sha256"),
                        (hits > 0).alias("contaminated"))


def remove(text: str, spans: list[dict]) -> str:
    """The text without the bytes of its spans."""
    raw, at, kept = text.encode(), 0, []
    for s in spans:
        kept.append(raw[at:s["byte"]])
        at = s["byte_end"]
    return b"".join([*kept, raw[at:]]).decode()
