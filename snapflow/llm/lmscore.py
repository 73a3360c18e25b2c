"""Language-model scores of documents by stupid backoff, computed relationally.

The model of a document is all other documents: counts of words and word n-grams over the whole corpus, less the
document's own. Count tables are partitioned by n-gram hash. A piece of the input sends every part its distinct
n-grams with their counts (pre-aggregated: a frequent n-gram is one entry of a piece), a part adds them up over
all pieces and answers each piece for the n-grams it sent, and the piece joins the totals to the n-grams of its
documents, scores every word and adds up per document. The empty n-gram counts the words of the corpus.

Score of a word: its longest n-gram that other documents hold gives log(count / count of its context); each step
down to a shorter one costs ``log(alpha)``; a word that no other document holds counts ``1 / (N + 1)``, N being the
words of the other documents, after all steps.

Words are runs of bytes other than ASCII white space, A-Z lower-cased; n-grams are told apart by 64-bit hashes, 44 bits
of them within a part, and stay within a document. Null and empty texts, or those without words, have no words and a null average. Repeated
rows are documents of their own. No rows: an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapflow.llm.blocks import (ANSWER, ASK, ROWS, TEXT, ascending, by_part, exchange, from_ascending, from_planes, groups,
                                 pack, planes, rows, unpack)
from snapflow.llm.common import lower_ascii, mix64, partitions, pieces, utf8

PIECE_BYTES, PART_BYTES = 6 << 20, 8 << 20
_SPACE = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])
_BASE = 0x9E3779B97F4A7C15
_CODE = mix64(np.arange(1, 257, dtype=np.uint64))
#: The empty n-gram.
_EMPTY = np.uint64(0)


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hash of each word of the rows, and the rows' word offsets."""
    n = len(data)
    is_word = ~_SPACE[data]
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True
    start = np.flatnonzero(is_word & (~np.r_[False, is_word[:-1]][:n] | edge[:n]))
    place = np.zeros(n, np.int64)
    place[start] = start
    place = np.arange(n) - np.maximum.accumulate(place)          # of a byte in its word
    power = np.cumprod(np.r_[np.uint64(1), np.full(int(place[is_word].max(initial=0)), _BASE, np.uint64)])
    values = np.where(is_word, _CODE[lower_ascii(data)] * power[np.where(is_word, place, 0)], np.uint64(0))
    h = np.add.reduceat(values, start) if len(start) else np.empty(0, np.uint64)
    return mix64(h) | np.uint64(1), np.searchsorted(start, offsets)


def ngrams(h: np.ndarray, at: np.ndarray, order: int) -> list[np.ndarray]:
    """For n = 1 .. order, the hash of the n-gram that ends at each word; 0 where the document has too few words."""
    row_start = np.repeat(at[:-1], np.diff(at))
    place = np.arange(len(h)) - row_start
    grams, prefix = [h], h
    for n in range(2, order + 1):
        longer = np.zeros_like(h)
        longer[1:] = mix64(prefix[:-1] * np.uint64(_BASE) + h[1:] + np.uint64(n)) | np.uint64(1)
        longer[place < n - 1] = 0
        grams.append(longer)
        prefix = longer
    return grams


def _distinct(grams: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """The distinct n-grams of a piece, order by order, the empty one last, and their counts."""
    keys, totals = [], []
    for n, g in enumerate(grams, 1):
        u, total = np.unique(g[g != 0], return_counts=True)
        keys.append(_key(u, n))
        totals.append(total.astype(np.uint32))
    return np.r_[np.concatenate(keys), _EMPTY], np.r_[np.concatenate(totals), np.uint32(len(grams[0]))]


def _key(gram: np.ndarray, n: int) -> np.ndarray:
    """What a part knows an n-gram of order n by."""
    return mix64(gram ^ np.uint64(n * _BASE & (1 << 64) - 1))


def _parts(keys: np.ndarray, parts: int):
    """(part, positions of its n-grams in ascending order of their names, the names): 44 bits within a part."""
    name = keys >> np.uint64(20)
    for p, k in by_part((mix64(keys) % np.uint64(parts)).astype(np.int64)):
        k = k[np.argsort(name[k], kind="stable")]
        yield p, k, name[k]


def _places(grams: list[np.ndarray], at: np.ndarray):
    """Positions of each order's n-grams among the distinct ones, and their counts within their own row."""
    rows_ = np.repeat(np.arange(len(at) - 1), np.diff(at))
    places, owns = [], []
    base = 0
    for g in grams:
        has = g != 0
        u, inverse = np.unique(g[has], return_inverse=True)
        place = np.full(len(g), -1)
        place[has] = inverse + base
        pair = rows_[has] * np.int64(len(u) + 1) + inverse
        _, back, own = np.unique(pair, return_inverse=True, return_counts=True)
        mine = np.zeros(len(g), np.int64)
        mine[has] = own[back]
        places.append(place)
        owns.append(mine)
        base += len(u)
    return places, owns


def _score(grams: list[np.ndarray], at: np.ndarray, places, owns, corpus: np.ndarray, words: int, alpha: float) -> np.ndarray:
    """Sum of the words' log scores for each row. ``corpus``: counts over the whole corpus by place; ``words``: its words."""
    size = np.diff(at)
    rest = np.repeat(words - size, size).astype(np.float64)       # words of the other documents
    done = np.zeros(len(grams[0]), bool)
    total = np.zeros(len(grams[0]))
    steps = np.zeros(len(grams[0]))
    first = np.repeat(at[:-1], size)
    place = np.arange(len(grams[0])) - first
    for n in range(len(grams), 0, -1):
        has = ~done & (grams[n - 1] != 0)
        i = np.flatnonzero(has)
        count = corpus[places[n - 1][i]] - owns[n - 1][i]
        i, count = i[count > 0], count[count > 0]
        if n == 1:
            context = rest[i]
        else:
            context = corpus[places[n - 2][i - 1]] - owns[n - 2][i - 1]
        total[i] = np.log(count) - np.log(context)
        done[i] = True
        left = ~done & (place >= n - 1) if n > 1 else ~done
        steps[left] += n > 1
    total[~done] = -np.log(rest[~done] + 1)
    total += steps * np.log(alpha)
    out = np.zeros(len(at) - 1)
    some = size > 0
    if some.any():
        out[some] = np.add.reduceat(total, at[:-1][some])
    return out


def score(docs: DataFrame, order: int = 3, alpha: float = 0.4, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, ``n_words``, ``log_score`` (sum over the words), ``avg_log_score`` (null without words)."""
    docs = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(1, -(-size // PART_BYTES))
    deal = max(parts, partitions(docs))

    def name(batches):  # 1: pieces name their n-grams with counts
        src = TaskContext.get().partitionId() << 32
        for batch in batches:
            data, offsets = utf8(batch.column(1))
            ids = batch.column(0)
            for lo, hi in pieces(offsets, PIECE_BYTES):
                x, off = data[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo]
                h, at = word_hashes(x, off)
                keys, total = _distinct(ngrams(h, at, order))
                out = [(src, TEXT, src, pack(ids.slice(lo, hi - lo).to_pylist(), off, x.tobytes()))]
                for p, k, named in _parts(keys, parts):
                    out.append((p, ASK, src, pack(ascending(named), planes(total[k]))))
                yield rows(out)
                src += 1

    def tell(batches):  # 2: parts add up and answer
        for key, found in groups(batches):
            asked = []
            for kind, src, d in found:
                if kind == TEXT:
                    yield rows([(src, TEXT, src, d)])
                else:
                    asked.append((src, unpack(d)))
            if not asked:
                continue
            named = [from_ascending(k, np.uint64) for _, (k, _) in asked]
            every = np.concatenate(named)
            order_ = np.argsort(every, kind="stable")
            s = every[order_]
            first = np.r_[True, s[1:] != s[:-1]]
            counts = np.concatenate([from_planes(t, np.uint32) for _, (_, t) in asked])[order_].astype(np.uint64)
            total = np.add.reduceat(counts, np.flatnonzero(first))
            answer = np.empty(len(every), np.uint64)
            answer[order_] = total[np.cumsum(first) - 1]
            for (src, _), a in zip(asked, np.split(answer, np.cumsum([len(k) for k in named])[:-1]), strict=True):
                yield rows([(src, ANSWER, key, pack(key, planes(a)))])

    def join(batches):  # 3: pieces join the totals and score
        for _, found in groups(batches):
            ids, off, x = unpack(next(d for kind, _, d in found if kind == TEXT))
            h, at = word_hashes(np.frombuffer(x, np.uint8), off)
            grams = ngrams(h, at, order)
            keys, _ = _distinct(grams)
            places, owns = _places(grams, at)
            corpus = np.zeros(len(keys), np.int64)
            answers = dict(unpack(d) for kind, _, d in found if kind == ANSWER)
            for p, k, _ in _parts(keys, parts):
                corpus[k] = from_planes(answers[p], np.uint64).astype(np.int64)
            total = _score(grams, at, places, owns, corpus[:-1], int(corpus[-1]), alpha)
            n = np.diff(at)
            with np.errstate(invalid="ignore", divide="ignore"):
                mean = total / n
            yield pa.record_batch([pa.array(ids, pa.int64()), pa.array(n, pa.int64()), pa.array(total),
                                   pa.array(mean, mask=n == 0)], names=[id_col, "n_words", "log_score", "avg_log_score"])

    out = docs.mapInArrow(name, ROWS)
    out = exchange(out, deal).mapInArrow(tell, ROWS)
    return exchange(out, deal).mapInArrow(join, f"`{id_col}` long, n_words long, log_score double, avg_log_score double")
