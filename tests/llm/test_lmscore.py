import math
from collections import Counter

import numpy as np

from snapflow.llm import lmscore
from tests.llm.cases import documents, empty, frame, key


def brute(rows, order=3, alpha=0.4):
    docs = [[w for w in (r[1] or "").encode().lower().split()] for r in rows]
    grams = [Counter(tuple(d[i:i + n]) for n in range(1, order + 1) for i in range(len(d) - n + 1)) for d in docs]
    every = Counter()
    for g in grams:
        every.update(g)
    words = sum(map(len, docs))
    out = []
    for r, d, own in zip(rows, docs, grams):
        total = 0.0
        for i in range(len(d)):
            for n in range(min(order, i + 1), 0, -1):
                g = tuple(d[i - n + 1:i + 1])
                count = every[g] - own[g]
                if count:
                    context = every[g[:-1]] - own[g[:-1]] if n > 1 else words - len(d)
                    total += math.log(count / context)
                    break
                total += math.log(alpha) if n > 1 else -math.log(words - len(d) + 1)
        out.append((r[0], len(d), round(total, 6), round(total / len(d), 9) if d else None))
    return out


def test_matches_brute_force(spark, monkeypatch):
    rows = documents()
    for order in (1, 2, 3):
        got = [(r[0], r[1], round(r[2], 6), None if r[3] is None else round(r[3], 9))
               for r in lmscore.score(frame(spark, rows), order=order).collect()]
        for a, b in zip(sorted(got, key=key), sorted(brute(rows, order), key=key)):
            assert a[:2] == b[:2] and math.isclose(a[2], b[2], abs_tol=2e-5) and (a[3] == b[3] or abs(a[3] - b[3]) < 2e-9)
    monkeypatch.setattr(lmscore, "PIECE_BYTES", 20_000)
    monkeypatch.setattr(lmscore, "PART_BYTES", 50_000)
    got = sorted((r[0] is None, r[0] or 0, r[1], round(r[2], 4)) for r in lmscore.score(frame(spark, rows)).collect())
    want = sorted((r[0] is None, r[0] or 0, r[1], round(r[2], 4)) for r in brute(rows))
    assert len(got) == len(want) and all(a[:3] == b[:3] and abs(a[3] - b[3]) < 2e-4 for a, b in zip(got, want))


def test_empty(spark):
    assert lmscore.score(empty(spark)).collect() == []
    one = spark.createDataFrame([(1, "a b a"), (2, None)], "doc_id long, text string")
    got = {r["doc_id"]: tuple(r)[1:] for r in lmscore.score(one).collect()}
    # no other document has words: N is 0, and all steps down are paid
    assert got[2] == (0, 0.0, None)
    assert math.isclose(got[1][1], 3 * math.log(0.4))
    assert not np.isnan(got[1][2])
