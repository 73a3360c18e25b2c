import numpy as np
import xxhash

from snapflow.llm import simhash
from snapflow.llm.components import components
from tests.llm.cases import documents, empty, frame, key


def fingerprint(text):
    w = (text or "").encode().lower().split()
    grams = [b" ".join(w[i:i + 3]) for i in range(max(1, len(w) - 2))] if w else []
    h = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def roots(rows, bits=3):
    """Each row's fingerprint and the one that stands for its component."""
    fps = [fingerprint(r[1]) for r in rows]
    group = {f: f for f in fps}

    def find(x):
        while group[x] != x:
            x = group[x]
        return x

    distinct = sorted(group)
    for i, a in enumerate(distinct):
        for b in distinct[:i]:
            if (a ^ b).bit_count() <= bits:
                group[find(a)] = find(b)
    return [(f, find(f)) for f in fps]


def brute(rows, bits=3):
    found, least = roots(rows, bits), {}
    for (_, c), r in zip(found, rows):
        if r[0] is not None:
            least[c] = min(least.get(c, r[0]), r[0])
    return [(r[0], f - (f >> 63 << 64), least.get(c)) for (f, c), r in zip(found, rows)]


def test_matches_brute_force(spark):
    rows = documents(150)
    got = [(r["doc_id"], r["fp"], r["component_id"]) for r in simhash.near_duplicates(frame(spark, rows)).collect()]
    assert sorted(got, key=key) == sorted(brute(rows), key=key)
    assert simhash.near_duplicates(empty(spark)).collect() == []


def test_words_are_split_at_ascii_space(spark):
    t = "A\x0bB\x0cC\x1cD\u00a0E\u2003f É"
    assert [w.decode() for w in t.encode().lower().split()] == ["a", "b", "c\x1cd\u00a0e\u2003f", "É"]


def test_links_connect_all_close_fingerprints(spark, monkeypatch):
    rng = np.random.default_rng(2)
    centre = rng.integers(0, 1 << 63, 40, dtype=np.int64)
    fps = {int(c) for c in centre} | {0, -1}
    for c in centre[:10]:
        for _ in range(30):  # a dense cluster, chains of up to three bits each
            c = int(np.int64(c) ^ np.int64(sum(1 << int(b) for b in rng.choice(63, rng.integers(1, 4), replace=False))))
            fps.add(c)
    base = int(centre[0])
    fps |= {base ^ (1 << a) ^ (1 << b) for a in range(32) for b in range(32, 40)}  # over eight in a bucket
    fps = sorted(fps)
    df = spark.createDataFrame([(f,) for f in fps], "fp long")
    u = np.array(fps, np.int64).view(np.uint64)
    near = np.bitwise_count(u[:, None] ^ u[None, :]) <= 3

    def groups(pairs):
        label = {f: f for f in fps}

        def find(x):
            while label[x] != x:
                x = label[x]
            return x
        for a, b in pairs:
            label[find(a)] = find(b)
        out = {}
        for f in fps:
            out.setdefault(find(f), set()).add(f)
        return sorted(map(sorted, out.values()))

    want = groups([(fps[i], fps[j]) for i, j in zip(*np.nonzero(near))])
    for sample, parts in ((20_000, 1_000_000), (100, 500)):
        monkeypatch.setattr(simhash, "SAMPLE", sample)
        monkeypatch.setattr(simhash, "HOT_SHARE", 1 / 50)
        monkeypatch.setattr(simhash, "PART_ENTRIES", parts)
        pairs = [tuple(r) for r in simhash.links(df).collect()]
        assert all(bin((a ^ b) & (1 << 64) - 1).count("1") <= 3 for a, b in pairs)
        assert groups(pairs) == want


def test_components(spark):
    edges = [(i, i + 1) for i in range(30)] + [(100, 90), (90, 95), (95, 100), (7, 7), (200, None), (50, 60), (60, 50)]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(31)}, 90: 90, 95: 90, 100: 90, 50: 50, 60: 50}
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []
