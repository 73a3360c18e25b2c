import zlib
from collections import Counter

import pytest

from snapflow.llm import vgram
from tests.llm.cases import documents, empty, frame


def brute_vocabulary(rows, least=7, drop=31):
    counts = Counter()
    for doc_id, text, *_ in rows:
        run = ""
        for c in (text or "") + " ":
            if "A" <= c <= "Z" or "a" <= c <= "z" or "À" <= c <= "ÿ":
                run += chr(ord(c) + 32) if "A" <= c <= "Z" else c
                continue
            if run:
                h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
                word = run[:h % len(run)] + run[h % len(run) + 1:] if h % drop == 0 else run
                counts[word] += len(word) >= least
            run = ""
    return {w: n for w, n in counts.items() if n >= 2}


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    i = next((k for k, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
    return a[i + 1:] == b[i + 1:] if len(a) == len(b) else a[i:] == b[i + 1:]


def brute(words, ratio=10):
    out = {}
    for w, n in words.items():
        near = [(-m, v) for v, m in words.items() if one_edit(w, v)]
        m, v = min(near, default=(0, None))
        out[w] = (v, n, len(near), -m) if near and -m >= ratio * n else (None, n, len(near), None)
    def root(w):
        return w if out[w][0] is None else root(out[w][0])
    return sorted((w, f, root(w), n, k, m) for w, (f, n, k, m) in out.items())


def found(df):
    return sorted(tuple(r) for r in df.select("word", "form", "root", "n", "n_near", "form_n").collect())


def variants(seed=3, families=40):
    """Families of words by edits of edits, with frequencies that lead to forms and ties."""
    import random
    draw, words = random.Random(seed), {}
    for _ in range(families):
        w = "".join(draw.choice("abcdeéÿ") for _ in range(draw.randint(7, 12)))
        n = 20000
        for _ in range(12):
            words.setdefault(w, max(2, n // draw.choice((1, 1, 9, 10, 11))))
            i = draw.randrange(len(w) + 1)
            w = draw.choice((w[:i] + "a" + w[i:], w[:i] + w[i + 1:], w[:i] + "b" + w[i + 1:], w + "c", "d" + w))
            w = w if len(w) >= 7 else w + "abcdefg"
            n = max(2, n // draw.choice((1, 10, 12)))
    return words


def test_words_of_awkward_documents(spark):
    rows = documents() + [(900001 + i, "Straße été-ÉTÉ×÷ wonderful Wonderful1wonderfulĀwonderful×", "en", "s", 1) for i in range(80)]
    got = vgram.vocabulary(frame(spark, rows), drop=31)
    want = brute_vocabulary(rows)
    assert {r["word"]: r["n"] for r in got.collect()} == want
    assert found(vgram.group_variants(got)) == brute(want)
    assert found(vgram.group_variants(vgram.vocabulary(empty(spark)))) == []


@pytest.mark.parametrize("hot", [1000, 2])
def test_variants_equal_brute_force(spark, monkeypatch, hot):
    monkeypatch.setattr(vgram, "HOT", hot)             # every list cut, again and again
    monkeypatch.setattr(vgram, "FREQUENT", 3)          # grams of all lengths
    words = variants()
    long_ = "wordsoverthirtyletterslongandmore"
    words |= {long_: 900, long_[:20] + long_[21:]: 80, long_ + "x": 3, long_[:16] + "é" + long_[17:]: 2, "x" + long_[1:]: 2, long_[1:]: 4,
              long_[:8] + "zz" + long_[10:]: 9}
    want = brute(words)
    assert sum(r[1] is not None and r[2] != r[1] for r in want) > 5           # chains of forms
    assert found(vgram.group_variants(spark.createDataFrame(list(words.items()), "word string, n long").repartition(5))) == want


def test_grams_and_bounds():
    frequent = {"ab": 9, "abc": 7, "bc": 8}
    assert vgram.decompose("abcabd", frequent, 4) == (["abca", "bca", "ca", "abd", "bd", "d$"], 4)
    for a in list(variants())[:60]:                    # one edit leaves all grams but the bound
        grams, most = vgram.decompose(a, frequent, 6)
        for i in range(len(a) + 1):
            for b in {a[:i] + "x" + a[i:], a[:i] + a[i + 1:], a[:i] + "x" + a[i + 1:]} - {a}:
                other, bound = vgram.decompose(b, frequent, 6)
                shared = sum((Counter(grams) & Counter(other)).values())
                assert shared >= max(len(grams) - most, len(other) - bound) and len(grams) > most


def test_short_words_are_refused(spark):
    with pytest.raises(ValueError):
        vgram.near_pairs(spark.createDataFrame([("ab", 1)], "word string, n long"), 2)
