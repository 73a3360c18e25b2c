import random
import tracemalloc
from itertools import combinations
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pytest

from snapflow.llm import partenum
from tests.llm.cases import documents, empty, frame


def shingle_set(text, size=5):
    words = [w.translate({c: c + 32 for c in range(65, 91)}) for w in
             (text or "").translate({c: " " for c in range(9, 14)}).split(" ") if w]
    return {" ".join(words[i:i + size]) for i in range(max(1, len(words) - size + 1))} if words else set()


def brute(rows, percent=80, size=5):
    sets = [shingle_set(r[1], size) for r in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for i, j in combinations(range(len(rows)), 2):
        if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
            root[find(i)] = find(j)
    least = {}
    for i, r in enumerate(rows):
        if r[0] is not None:
            least[find(i)] = min(r[0], least.get(find(i), r[0]))
    return sorted(((r[0], len(sets[i]), least.get(find(i))) for i, r in enumerate(rows)), key=str)


def found(df):
    return sorted((tuple(r) for r in df.select("doc_id", "n_shingles", "component_id").collect()), key=str)


def doc(i, words):
    return (i, " ".join(words), "en", "s", 1)


def test_awkward_documents(spark):
    rows = documents()
    assert found(partenum.near_sets(frame(spark, rows))) == brute(rows)
    assert found(partenum.near_sets(empty(spark))) == []


def near_copies(seed, bases=25, copies=12):
    """Texts of all lengths, each with copies of copies that differ more and more."""
    draw, rows = random.Random(seed), []
    for b in range(bases):
        words = [f"w{draw.randrange(10**6)}" for _ in range(draw.choice((4, 5, 6, 8, 9, 12, 20, 40, 90, 250)))]
        for _ in range(copies):
            rows.append(words)
            words = list(words)
            for _ in range(draw.randrange(1, 2 + len(words) // 60)):
                i = draw.randrange(len(words))
                words[i:i + draw.choice((0, 1, 1))] = draw.choice(([], ["x"], [f"y{draw.randrange(9)}"]))
                words = words or ["z"]
    draw.shuffle(rows)
    return [doc(i, w) for i, w in enumerate(rows)]


def chains(rows):
    return sum(c != d for d, _, c in brute(rows))


def test_links_at_the_bound_and_chains(spark):
    rows = near_copies(1)
    assert chains(rows) > 100
    assert found(partenum.near_sets(frame(spark, rows))) == brute(rows)
    assert found(partenum.near_sets(frame(spark, rows), size=3, percent=60)) == brute(rows, 60, 3)


@pytest.mark.parametrize("limit, block, often", [(256, 256, 4), (2, 3, 4), (2, 3, 2)])
def test_common_passages_split_no_link(spark, monkeypatch, limit, block, often):
    """Many texts share most of their words with each other, few are near: groups go on to the last level."""
    monkeypatch.setattr(partenum, "OFTEN", often)
    monkeypatch.setattr(partenum, "SMALL", 2)
    monkeypatch.setattr(partenum, "LIMIT", limit)
    monkeypatch.setattr(partenum, "BLOCK", block)
    monkeypatch.setattr(partenum, "STAR", 4)
    monkeypatch.setattr(partenum, "PART", 500)
    draw = random.Random(5)
    passage = [f"p{i}" for i in range(90)]
    rows = []
    for i in range(40):
        own = [f"o{i // 3 if i % 2 else i}x{k}" for k in range(draw.randrange(8, 40))]
        rows.append(doc(i, passage + own))
    rows += [doc(100 + i, r[1].split()[:-1] + ["last"]) for i, r in enumerate(rows[:8])]
    rows += [doc(200 + i, ["short", "line", "that", "all", "have", f"t{i % 7}", f"u{i}"]) for i in range(30)]
    rows += near_copies(7, 4, 10)
    assert found(partenum.near_sets(frame(spark, rows))) == brute(rows)


@pytest.mark.parametrize("level", range(len(partenum.LEVELS)))
def test_similar_sets_share_a_signature(level):
    draw = np.random.default_rng(level)
    for percent in (60, 80, 90):
        instances = partenum.Instances(percent, level)
        for _ in range(150):
            a = draw.integers(1, 2**63, draw.integers(2, 200)).astype(np.uint64)
            b = list(a[draw.random(len(a)) > 0.1 * draw.random()]) + list(draw.integers(1, 2**63, draw.integers(0, 1 + len(a) // 10)))
            b = np.unique(np.array(b, np.uint64))
            a = np.unique(a)
            both = len(np.intersect1d(a, b))
            if not len(b) or both in (len(a), len(b)) == (True, True) or 100 * both < percent * (len(a) + len(b) - both) or np.array_equal(a, b):
                continue
            n = np.array([len(a), len(b)])
            of, key, (own, above) = instances.signatures(n, np.concatenate([a, b]))
            shared = np.intersect1d(key[of == 0], key[of == 1]).size
            assert shared >= max(1, instances.least(n, own, above, np.array([0]), np.array([1]))[0])
            sets = [x[x % np.uint64(3) > 0] for x in (a, b)]                 # a part of the domain
            held = np.array([len(x) for x in sets])
            of, key, (own, above) = instances.signatures(n, np.concatenate(sets), held)
            shared = np.intersect1d(key[of == 0], key[of == 1]).size
            least = instances.least(n, own, above, np.array([0]), np.array([1]))[0]
            assert shared >= max(least, not instances.uncovered(n, held).all())


def _peak(work):
    tracemalloc.start()
    try:
        out = work()
        return out, tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()


def _signed_rows(sets, rows, values, seed=2):
    draw = np.random.default_rng(seed)
    name, n = draw.integers(-2**62, 2**62, sets), draw.integers(200, 500, sets)
    of = np.repeat(np.arange(sets, dtype=np.int32), rows // sets)
    return name, n, of, draw.integers(0, 2**40, values).astype(np.uint64)[draw.integers(0, values, rows)]


def test_a_part_is_sorted_in_ranges(monkeypatch):
    """A task sorts some signatures of its part at a time and finds the same pairs, hits and groups."""
    instances, rows = partenum.Instances(80, 0), _signed_rows(5000, 60_000, 15_000)

    def met(sorted_at_once):
        monkeypatch.setattr(partenum, "SORTED", sorted_at_once)
        found = pa.Table.from_batches(partenum._groups(3, *rows, instances)).to_pylist()
        return sorted(tuple(r.values()) for r in found if r["grp"] is None), sorted(tuple(r.values()) for r in found if r["grp"] is not None)

    whole = met(10**9)
    assert all(whole) and met(500) == whole and met(20_000) == whole


def test_memory_of_a_part_stays_near_its_signatures():
    instances, rows = partenum.Instances(80, 0), _signed_rows(20_000, 2_000_000, 16_000_000)
    met, peak = _peak(lambda: sum(b.num_rows for b in partenum._groups(3, *rows, instances)))
    assert met and peak < 38e6                          # all at once: 47 MB


def test_a_task_holds_few_rows_of_a_batch():
    """An Arrow batch of many large sets isn't made Python values at once."""
    blob = np.arange(500, dtype=np.uint64).tobytes()
    batch = pa.record_batch([pa.array(range(10_000), pa.int64()), pa.array([500] * 10_000, pa.int64()), pa.array([blob] * 10_000)],
                            names=["name", "n", "features"])
    often = SimpleNamespace(value=np.empty(0, np.uint64))
    count, peak = _peak(lambda: sum(1 for _ in partenum._domain(often, [batch])))
    assert count == 10_000 and peak < 10e6              # all at once: over 40 MB


def test_sets_that_link_with_nothing_are_told_first(spark, monkeypatch):
    """Texts whose features hardly occur elsewhere get no signatures; of those that link, none is lost."""
    monkeypatch.setattr(partenum, "TOLD", 2000)
    monkeypatch.setattr(partenum, "PART", 500)
    monkeypatch.setattr(partenum, "FEW", 30)
    draw, signed = random.Random(3), []
    alone = [doc(1000 + i, ["one", "line", "that", "all", "of", "them", "have", *(f"a{i}x{k}" for k in range(draw.randrange(40, 300)))])
             for i in range(60)]
    linked = near_copies(4, 12, 8)
    monkeypatch.setattr(partenum, "_parts", lambda rows, instances: signed.append(rows.count()) or 64)
    assert found(partenum.near_sets(frame(spark, alone + linked))) == brute(alone + linked)
    assert signed[0] <= len(linked)


@pytest.mark.parametrize("percent", (60, 80, 90))
def test_linked_sets_share_what_they_need(percent):
    """Across tasks and parts, with small sets beside larger ones and one set sent twice."""
    draw, domain = np.random.default_rng(percent), partenum.Domain(percent)
    sets = []
    for _ in range(300):
        a = np.unique(draw.integers(1, 2**63, draw.integers(1, 200)).astype(np.uint64))
        out = draw.integers(0, 1 + len(a) * (100 - percent) // 200)
        more = draw.integers(1, 2**63, draw.integers(0, 1 + len(a) * (100 - percent) // 200)).astype(np.uint64)
        sets += [a, np.unique(np.r_[draw.permutation(a)[out:], more])]
    n = np.array([len(s) for s in sets])
    need = domain.need(n, np.concatenate(sets))
    tasks = [list(t) for t in np.array_split(draw.permutation(len(sets)), 4)]
    tasks[0] += tasks[1][:3]
    shared, rows = np.zeros(len(sets)), {}
    for t in tasks:
        for part, *row in zip(*(c.to_pylist() for c in domain.sent(np.array(t), n[t], np.concatenate([sets[i] for i in t]), 7).columns), strict=True):
            rows.setdefault(part, []).append(row)
    for some in rows.values():
        names, counts = domain.shared(some)
        shared[names] += counts
    for i in range(0, len(sets), 2):
        a, b = sets[i], sets[i + 1]
        both = len(np.intersect1d(a, b))
        if 100 * both >= percent * (len(a) + len(b) - both):
            assert shared[i] >= need[i] and shared[i + 1] >= need[i + 1]
    lone = np.unique(draw.integers(1, 2**63, 150).astype(np.uint64))
    (row,) = zip(*(c.to_pylist() for c in domain.sent(np.array([5]), np.array([len(lone)]), lone, 1).columns[1:]), strict=True)
    assert not len(domain.shared([row])[0]) and domain.need(np.array([len(lone)]), lone)[0] > 0


def test_texts_that_are_no_copies_make_few_pairs(spark, monkeypatch):
    """A large group of near copies and changed texts that link with none of them: these meet by what they share, yet hardly
    any pair is looked at for it."""
    monkeypatch.setattr(partenum, "SMALL", 2)
    draw, rows = random.Random(11), []
    base = [f"b{i}" for i in range(150)]
    for i in range(120):
        words = list(base)
        for k in draw.sample(range(0, 150, 12), draw.choice((1, 1, 5, 6))):
            words[k] = f"c{i}x{k}"
        rows.append(doc(i, words))
    pairs, verified = [], partenum._verified
    monkeypatch.setattr(partenum, "_verified", lambda some, *rest: pairs.append(some.count()) or verified(some, *rest))
    want = brute(rows)
    alone = sum(c not in {x for d, _, x in want if d != c} and c == d for d, _, c in want)
    assert 20 < alone < 100
    assert found(partenum.near_sets(frame(spark, rows))) == want
    assert len(pairs) > 1 and sum(pairs[1:]) < len(rows)    # the first are of signatures


@pytest.mark.parametrize("percent", (60, 80, 90))
def test_linked_sets_meet_by_their_rarest_features(monkeypatch, percent):
    """Counted in pieces and parts, of sets of all sizes: a linked pair is given, or its sets are members of one group."""
    monkeypatch.setattr(partenum, "SMALL", 3)
    draw, rarest, sets = np.random.default_rng(percent), partenum.Rarest(percent), []
    passage = draw.integers(1, 2**63, 60).astype(np.uint64)
    for i in range(120):
        a = draw.integers(1, 2**63, draw.integers(1, 120)).astype(np.uint64)
        if i % 2:
            a = np.r_[a, passage]
        for _ in range(3):
            sets.append(np.unique(a))
            a = np.r_[a[draw.integers(0, 1 + len(a) * (100 - percent) // 150):],
                      draw.integers(1, 2**63, draw.integers(0, 1 + len(a) * (100 - percent) // 200)).astype(np.uint64)]
            a = draw.permutation(a if len(a) else sets[-1])
    sets = [np.frombuffer(b, np.uint64) for b in dict.fromkeys(s.tobytes() for s in sets)]
    pieces = [np.concatenate(sets[:70]), np.concatenate(sets[70:])]
    asked, count = [partenum._asked(p, 5) for p in pieces], [np.empty(len(p), np.uint8) for p in pieces]
    for part in range(5):
        keys = [k[cuts[part]:cuts[part + 1]] for _, cuts, k in asked]
        for c, (order, cuts, _), told in zip(count, asked, partenum._tally(keys), strict=True):
            c[order[cuts[part]:cuts[part + 1]]] = told
    all_of = dict(zip(*np.unique(np.concatenate(pieces), return_counts=True), strict=True))
    assert all(c == all_of[f] if c < 128 else all_of[f] >= 128 for p, some in zip(pieces, count, strict=True) for f, c in zip(p, some, strict=True))
    at = [0, 70, len(sets)]
    rows = pa.Table.from_batches([
        partenum._rarest(np.arange(lo, hi), np.array([len(s) for s in sets[lo:hi]]), p, c, rarest, 2)
        for lo, hi, p, c in zip(at, at[1:], pieces, count, strict=False)]).to_pandas()
    pairs, groups = set(), {}
    for part, some in rows.groupby("part"):
        for met in partenum._rare_groups(part, *(some[c].to_numpy() for c in ("name", "n", "ahead", "key")), rarest):
            for r in met.to_pylist():
                if r["grp"] is None:
                    assert r["a"] < r["b"]
                    pairs.add((r["a"], r["b"]))
                else:
                    groups.setdefault(r["grp"], []).append((r["a"], r["b"], r["hits"]))
    for group in groups.values():
        n, ahead = (np.array([m[i] for m in group]) for i in (1, 2))
        x, y = (np.array(c) for c in zip(*combinations(range(len(group)), 2), strict=True))
        fit = rarest.meet(n, ahead, x, y)
        pairs |= {tuple(sorted((group[i][0], group[j][0]))) for i, j in zip(x[fit], y[fit], strict=True)}
    linked = {(i, j) for i, j in combinations(range(len(sets)), 2)
              if 100 * (both := len(np.intersect1d(sets[i], sets[j]))) >= percent * (len(sets[i]) + len(sets[j]) - both)}
    assert groups and len(linked) > 100 and linked <= pairs


def test_the_join_holds_pairs_to_the_same(spark):
    draw = random.Random(2)
    rows = [[draw.randrange(1, 90) for _ in range(2)] + [draw.randrange(1, 20) for _ in range(2)] for _ in range(500)]
    n, ahead = (np.array([r[i:i + 2] for r in rows]).ravel() for i in (0, 2))
    some = spark.createDataFrame([(i, (r[0], r[2]), (r[1], r[3])) for i, r in enumerate(rows)],
                                 "i int, x struct<n: long, ahead: long>, y struct<n: long, ahead: long>")
    for percent in (60, 80, 99):
        rarest = partenum.Rarest(percent)
        want = rarest.meet(n, ahead, np.arange(0, 1000, 2), np.arange(1, 1000, 2))
        assert [r[0] for r in some.orderBy("i").selectExpr(rarest.meet_sql("x", "y")).collect()] == want.tolist()
        assert want.any() and not want.all()


def test_components_of_few_links_in_one_task(spark, monkeypatch):
    draw = random.Random(4)
    links = spark.createDataFrame([(draw.randrange(-500, 500), draw.randrange(-500, 500)) for _ in range(450)] + [(7, 7), (7, -900)], "a long, b long")
    here = sorted(map(tuple, partenum._roots(links).collect()))
    monkeypatch.setattr(partenum, "FIT", 0)
    assert here == sorted(map(tuple, partenum._roots(links).collect()))
    assert not partenum._roots(links.limit(0)).count()
