"""Spelling variants among the words of a corpus, found with an index of variable-length grams.

The dictionary of grams is pruned by frequency: a gram grows from ``Q_MIN`` letters, one by one, while it is frequent among
the words, to ``q_max`` at most. From every place of a word (closed by an end mark) starts the gram so found, which depends
on its own letters alone; so an edit at a place changes no more grams than cover it, and the most that cover one place bound
the affected grams of the word. Words one edit apart therefore share at least their grams less this bound, so the lists of
each word's rarest grams, one more than its bound, hold a common one: these are merged, and what meets is compared.

Lists of the dictionary's own grams, and such as turn out longer than ``HOT``, are cut by halves of their words: one edit
leaves the first or the last half of the shorter word's open letters in both. Parts that are still too long are cut again,
until two letters are open, which bounds a list by the alphabet. No pair is lost. Only distinct words are indexed; their
counts are added up before the exchange.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from snapflow.llm.common import partitions
from snapflow.session import reliable_checkpoint

#: Shortest and longest grams; most frequent grams of each length that a task holds; least count of a frequent gram; words
#: of a list that is merged uncut; words that a task counts before it hands them on, rows that it compares at a time; letters
#: at either end that it compares.
Q_MIN, Q_MAX, DICTIONARY, FREQUENT, HOT, HOLD, CHUNK, EDGE = 2, 6, 20_000, 32, 1000, 200_000, 50_000, 16
#: Closes a word in its grams; no word holds it.
END = "$"
_RUN = re.compile("[A-Za-zÀ-ÿ]+")
_LOWER = {c: c + 32 for c in range(65, 91)}


def _spelling(run: str, prefix: int, drop: int) -> str:
    """The run with A-Z lower-cased, one code point left out where ``drop`` divides the checksum of ``<id>:<run>``."""
    word = run.translate(_LOWER)
    h = zlib.crc32(word.encode(), prefix)
    if drop and h % drop == 0:
        at = h % len(word)
        return word[:at] + word[at + 1:]
    return word


def vocabulary(docs: DataFrame, min_length: int = 7, min_count: int = 2, drop: int = 0, id_col: str = "doc_id",
               text_col: str = "text") -> DataFrame:
    """(word, n): distinct words of at least ``min_length`` letters and ``min_count`` occurrences in whole texts, as runs
    of Latin letters. Null and empty texts have no words; a null id counts as the empty one; repeated rows count each."""
    def run(batches):
        counts: Counter = Counter()
        for batch in batches:
            for name, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                prefix = zlib.crc32(f"{name}:".encode())
                for found, n in Counter(_RUN.findall(text or "")).items():
                    if len(found) >= min_length and len(word := _spelling(found, prefix, drop)) >= min_length:
                        counts[word] += n
                if len(counts) > HOLD:
                    yield _counted(counts)
                    counts.clear()
        if counts:
            yield _counted(counts)

    rows = docs.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("id"), F.col(text_col).alias("text"))
    return (rows.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
            .where(F.col("n") >= min_count))


def _counted(counts: Counter) -> pa.RecordBatch:
    return pa.record_batch([pa.array(list(counts)), pa.array(list(counts.values()), pa.int64())], names=["word", "n"])


def frequent_grams(words: DataFrame, q_max: int) -> dict[str, int]:
    """Grams of ``Q_MIN`` to ``q_max`` letters at more places of the words than an even share of the dictionary, and at how
    many; no length has more than ``DICTIONARY`` of them."""
    places = words.agg(F.sum(F.length("word") + 1)).first()[0] or 0
    least = max(FREQUENT, -(-places // DICTIONARY))

    def run(batches):
        counts: Counter = Counter()
        for batch in batches:
            for word in batch.column(0).to_pylist():
                s = word + END
                counts.update(s[p:p + q] for q in range(Q_MIN, q_max + 1) for p in range(len(s) - q + 1))
                if len(counts) > HOLD:
                    yield _counted(counts)
                    counts.clear()
        if counts:
            yield _counted(counts)

    found = words.select("word").mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return {r["word"]: r["n"] for r in found.where(F.col("n") > least).collect()}


def decompose(word: str, frequent: dict[str, int], q_max: int) -> tuple[list[str], int]:
    """(grams in order of their places, most of them that cover one place)."""
    s, grams, ends = word + END, [], [0] * (len(word) + q_max + 2)
    for p in range(len(s) - Q_MIN + 1):
        end = p + Q_MIN
        while end < len(s) and end - p < q_max and s[p:end] in frequent:
            end += 1
        grams.append(s[p:end])
        ends[p] += 1
        ends[end] -= 1
    cover, most = 0, 0
    for step in ends[:len(word)]:
        cover += step
        most = max(most, cover)
    return grams, most


def rarest(word: str, frequent: dict[str, int], q_max: int) -> list[str]:
    """The grams whose lists are merged for the word: one more than an edit may affect, rare ones first; equal grams are
    told apart by number."""
    grams, affected = decompose(word, frequent, q_max)
    seen: Counter = Counter()
    named = []
    for g in grams:
        seen[g] += 1
        named.append((frequent.get(g, 0), g, seen[g]))
    return [f"{g} {i}" for _, g, i in sorted(named)[:affected + 1]]


def _cut(key: int, word: str, low: int, high: int):
    """(key, low, high) of a list's parts for the word: one edit within ``word[low:high]`` leaves the first or the last half
    of the shorter word's letters there, by which the list is cut; the other letters stay open."""
    for h in {(high - low) // 2, (high - low - 1) // 2} - {0}:
        first, last = word[low:low + h], word[high - h:high]
        yield xxh64_intdigest(f"<{h}{first}", key), low + h, high
        yield xxh64_intdigest(f">{h}{last}", key), low, high - h


ENTRY = "key long, word string, n long, low int, high int"


def _entries(items: list[tuple]) -> pa.RecordBatch:
    """Rows of (key, word, n, low, high)."""
    key, word, n, low, high = zip(*items, strict=True)
    return pa.record_batch([pa.array(np.array(key, np.uint64).view(np.int64)), pa.array(word), pa.array(n, pa.int64()),
                            pa.array(low, pa.int32()), pa.array(high, pa.int32())], names=["key", "word", "n", "low", "high"])


def _shape(words: list[str]) -> tuple[np.ndarray, ...]:
    """Of words: length, set of letters as bits, first and last ``EDGE`` letters."""
    raw = [w.encode("latin-1") for w in words]
    n = np.array([len(w) for w in raw])
    data, off = np.frombuffer(b"".join(raw), np.uint8), np.cumsum(n) - n
    letters = np.bitwise_or.reduceat(np.uint64(1) << (data & 63).astype(np.uint64), off)
    place = np.arange(EDGE)
    inside = place < n[:, None]
    head = np.where(inside, data[np.minimum(off[:, None] + place, len(data) - 1)], 0)
    tail = np.where(inside, data[np.maximum((off + n)[:, None] - 1 - place, 0)], 1)
    return n, letters, head, tail


def _near(key: np.ndarray, words: list[str]):
    """Places of the pairs within equal keys that may be one edit apart, some at a time; sure for words of up to ``EDGE``
    letters."""
    n, letters, head, tail = _shape(words)
    i, found, size = np.arange(len(key)), [], 0
    for d in range(1, len(key)):
        i = i[:np.searchsorted(i, len(key) - d)]
        i = i[key[i] == key[i + d]]
        if not len(i):
            break
        j = i + d
        ok = (np.abs(n[i] - n[j]) <= 1) & (np.bitwise_count(letters[i] ^ letters[j]) <= 2)
        x, y = i[ok], j[ok]
        same = np.minimum.accumulate(head[x] == head[y], 1).sum(1) + np.minimum.accumulate(tail[x] == tail[y], 1).sum(1)
        ok = same >= np.minimum(np.maximum(n[x], n[y]) - 1, EDGE)
        found.append((x[ok], y[ok]))
        size += int(ok.sum())
        if size > CHUNK:
            yield tuple(np.concatenate(c).tolist() for c in zip(*found, strict=True))
            found, size = [], 0
    if size:
        yield tuple(np.concatenate(c).tolist() for c in zip(*found, strict=True))


def _merge(batches):
    """Entries sorted by key: candidate pairs of lists of up to ``HOT`` words or with two open letters, (word, n, other, m);
    words of longer lists come back as entries without ``other``."""
    names = ["key", "word", "n", "low", "high", "other", "m"]
    kinds = (pa.int64(), pa.string(), pa.int64(), pa.int32(), pa.int32(), pa.string(), pa.int64())
    held, size, hot, now = [], 0, False, None

    def pairs(rows):
        key, word, n, _, _ = zip(*rows, strict=True)
        for a, b in _near(np.array(key), word):
            yield batch_of([[None] * len(a), [word[i] for i in a], [n[i] for i in a], [None] * len(a), [None] * len(a),
                            [word[i] for i in b], [n[i] for i in b]])

    def back(rows):
        yield batch_of([*zip(*rows, strict=True), [None] * len(rows), [None] * len(rows)])

    def batch_of(columns):
        return pa.record_batch([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=names)

    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if row[0] != now:
                if hot or len(held) > CHUNK:
                    yield from (back if hot else pairs)(held) if held else ()
                    held = []
                now, size, hot = row[0], 0, False
            held.append(row)
            size += 1
            if size > HOT and row[4] - row[3] > 2 and not hot:
                hot = True                                             # the list's words so far are the last ones held
                if len(held) > size:
                    yield from pairs(held[:-size])
                held = held[-size:]
            if hot and len(held) > CHUNK:
                yield from back(held)
                held = []
    if held:
        yield from (back if hot else pairs)(held)


def near_pairs(words: DataFrame, min_length: int = 7) -> DataFrame:
    """(a, b, n_a, n_b): the pairs of words that differ by one inserted, deleted or replaced code point, once each.

    ``words`` holds distinct (word, n) of at least ``min_length`` letters (3 or more) and is stored."""
    if min_length < 3:
        raise ValueError("words of fewer than three letters need not share a gram")
    q_max = min(Q_MAX, min_length - 1)
    frequent = frequent_grams(words, q_max)

    def lists(batches):
        for batch in batches:
            items = []
            for word, n in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                for gram in rarest(word, frequent, q_max):
                    key = xxh64_intdigest(gram)
                    if gram[:gram.index(" ")] in frequent:             # known to be long: cut at once
                        items += [(k, word, n, lo, hi) for k, lo, hi in _cut(key, word, 0, len(word))]
                    else:
                        items.append((key, word, n, 0, len(word)))
            yield _entries(items)

    def parts(batches):
        for batch in batches:
            items = [(k, word, n, lo, hi) for key, word, n, low, high in zip(*(c.to_pylist() for c in batch.columns), strict=True)
                     for k, lo, hi in _cut(key & (2**64 - 1), word, low, high)]
            if items:
                yield _entries(items)

    entries, found = words.select("word", "n").mapInArrow(lists, ENTRY), []
    while True:
        met = reliable_checkpoint(entries.repartition(partitions(words), "key").sortWithinPartitions("key").mapInArrow(
            _merge, f"{ENTRY}, other string, m long"))
        found.append(met.where("other IS NOT NULL"))
        again = met.where("other IS NULL").select("key", "word", "n", "low", "high")
        if not again.limit(1).count():
            break
        entries = again.mapInArrow(parts, ENTRY)
    pairs = found[0]
    for more in found[1:]:
        pairs = pairs.union(more)
    first = F.col("word") < F.col("other")
    both = [F.when(first, F.struct("word", "n")).otherwise(F.struct(F.col("other").alias("word"), F.col("m").alias("n"))),
            F.when(first, F.struct(F.col("other").alias("word"), F.col("m").alias("n"))).otherwise(F.struct("word", "n"))]
    return (pairs.where(F.levenshtein("word", "other", 1) == 1).select(both[0].alias("x"), both[1].alias("y")).distinct()
            .select(F.col("x.word").alias("a"), F.col("y.word").alias("b"), F.col("x.n").alias("n_a"), F.col("y.n").alias("n_b")))


def follow(forms: DataFrame) -> DataFrame:
    """(word, root) of (word, form): the last word that forms lead to. Jumps double every round; a form occurs several times
    as often as its word, so no path returns and rounds are few."""
    at = reliable_checkpoint(forms.select("word", F.col("form").alias("root")))
    while True:
        on = at.select(F.col("word").alias("via"), F.col("root").alias("next"))
        at = reliable_checkpoint(at.join(on, at.root == on.via, "left"))
        if not at.where(F.col("next").isNotNull()).limit(1).count():
            return at.select("word", "root")
        at = at.select("word", F.coalesce("next", "root").alias("root"))


def group_variants(words: DataFrame, ratio: int = 10, min_length: int = 7) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every word: ``form`` is its most frequent near word (ties: the first in
    code-point order) if that one is ``ratio`` times as frequent or more, else null; ``root`` follows forms to the last. No
    words: no rows."""
    words = reliable_checkpoint(words.select("word", "n"))
    pairs = reliable_checkpoint(near_pairs(words, min_length))
    both = pairs.select(F.col("a").alias("word"), F.col("b").alias("near"), F.col("n_b").alias("m")).union(
        pairs.select("b", "a", "n_a"))
    best = both.groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("m")).alias("less"), "near")).alias("best"))
    form = F.when(-F.col("best.less") >= ratio * F.col("n"), F.col("best"))
    found = reliable_checkpoint(words.join(best, "word", "left").select(
        "word", form["near"].alias("form"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        (-form["less"]).alias("form_n")))
    roots = follow(found.where(F.col("form").isNotNull()))
    return found.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
