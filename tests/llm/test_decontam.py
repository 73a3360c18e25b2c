import hashlib
import re

import numpy as np
import pandas as pd

from snapflow.llm import decontam
from snapflow.llm.fmindex import FMIndex, suffix_array
from tests.llm.cases import LINE, SF, documents, empty, frame, key

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def split(t):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))


def brute(rows, items, width=10):
    windows = {}
    for i, t in items:
        w = split(t)
        n = min(width, len(w))
        for k in range(len(w) - n + 1 if n else 0):
            windows.setdefault(tuple(w[k:k + n]), set()).add(i)
    out = []
    for r in rows:
        w = split(r[1])
        hit, found = np.zeros(len(w), bool), set()
        for n in {len(x) for x in windows}:
            for k in range(len(w) - n + 1):
                if (x := tuple(w[k:k + n])) in windows:
                    hit[k:k + n] = True
                    found |= windows[x]
        found.discard(None)
        digest = hashlib.sha256(",".join(sorted(map(str, found))).encode()).hexdigest()
        out.append((r[0], len(w), int(hit.sum()), len(found), digest, bool(hit.any())))
    return out


def items():
    b = pd.read_parquet(f"{SF}/benchmark.parquet")
    return [(int(i), t) for i, t in zip(b.item_id, b.text)] + [
        (900, LINE), (901, "old oak tree"), (902, ""), (903, None), (None, "quick brown"), (900, "lazy DOG"), (10, "É")]


def test_index_finds_every_occurrence():
    rng = np.random.default_rng(1)
    for _ in range(60):
        s = np.r_[rng.integers(0, 4, rng.integers(1, 60)), 0]
        assert sorted(suffix_array(s).tolist()) == list(range(len(s)))
        index = FMIndex(s, 3, 4)
        for m in (1, 2, 4):
            patterns = rng.integers(1, 4, (10, m))
            lo, hi = index.search(patterns)
            for p, a, b in zip(patterns, lo, hi):
                want = [i for i in range(len(s) - m + 1) if (s[i:i + m] == p).all()]
                assert sorted(index.locate(np.arange(a, max(a, b))).tolist()) == want


def test_matches_brute_force(spark, monkeypatch):
    rows, its = documents(), items()
    text = its[3][1]
    rows += [(5000, "x " + text[:len(text) // 2] + " y"), (5001, (text + " ") * 3), (5002, " ".join(split(LINE)).upper())]
    rows = [r if len(r) == 5 else (*r, None, None, None) for r in rows]
    bench = spark.createDataFrame(its, "item_id long, text string")
    want = sorted(brute(rows, its), key=key)
    got = decontam.digest(decontam.find(frame(spark, rows), bench))
    assert sorted((tuple(r) for r in got.collect()), key=key) == want
    monkeypatch.setattr(decontam, "GROUP_BYTES", 4000)     # several passes
    monkeypatch.setattr(decontam, "SHARD_BYTES", 5000)     # several shards
    got = decontam.digest(decontam.find(frame(spark, rows), bench))
    assert sorted((tuple(r) for r in got.collect()), key=key) == want


def test_spans_cover_the_hit_words(spark):
    bench = spark.createDataFrame([(1, "alpha beta gamma")], "item_id long, text string")
    docs = spark.createDataFrame([(1, "Ünd Alpha, beta\ngamma: rest alpha")], "doc_id long, text string")
    r = decontam.find(docs, bench).first()
    assert decontam.remove(r["text"], [s.asDict() for s in r["spans"]]) == "Ünd : rest alpha"
    assert [(s["word"], s["word_end"]) for s in r["spans"]] == [(1, 4)]


def test_empty_tables(spark):
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontam.find(empty(spark), none).collect() == []
    got = decontam.digest(decontam.find(frame(spark), none)).collect()
    assert len(got) == len(documents()) and not any(r["contaminated"] for r in got)
