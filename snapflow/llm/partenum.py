"""Jaccard join of shingle sets by PartEnum signatures.

A set links with nothing if more of its features than its links can differ in occur in no other set. That is told first, on
a part of the feature domain that leaves room for it: each feature travels four bytes, and sets that may link, usually few,
go on.

Sizes are cut into bands so wide that linked sets lie in one band or in neighbouring ones; a set takes part in the instance
of its band and of the next. Linked sets of an instance differ in at most ``k`` features. The feature domain is hashed into
first-level partitions, each into ``cells`` second-level ones; as there are more partitions than ``k // (spare + 1)``, some
partition differs in at most ``spare`` cells, so of the signatures that a partition gives - one for each subset of all but
``spare`` cells - the sets share one. Signatures of nothing but empty cells are left out: a set with enough partitions of
more than ``spare`` filled cells meets every partner without them, and in as many partitions as it has above those that
differences can spoil, which candidates are held to; two sets that both lack those also meet by their single features.

A signature is an equality join; its groups give candidate pairs, verified on the sets themselves. Small groups give all
their pairs, larger ones a star: most are one component then. Sets of groups that are not go on to their rarest features: by
how many of these sets have a feature, counted in full, each takes its rarest ones, so many that linked sets share one at
least (``Rarest``), and meets by the first that they share: features that follow there must be enough for a link. So what many
texts have in common, without being similar, makes hardly any pairs. Groups of these features are treated in the same way;
those that several components are left in give the pairs between these, block by block and without a limit. No link is lost,
and none is taken without verification.

Equal sets are one node, whatever their texts. Null and empty texts have the empty set and link with nothing; a null id
keeps its row and names a component only if no other id is there; repeated rows are copies.
"""

from __future__ import annotations

import gc
from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from snapflow.llm.common import mix64, partitions
from snapflow.llm.components import components
from snapflow.session import reliable_checkpoint

#: By level: features that may differ within a partition, its cells.
LEVELS = ((1, 3),)
#: Signatures of a part, sets of a group that gives all pairs at once, sets of a block, pairs that a task compares with one
#: set, bytes of a signature within its part; parts at least, so that the rows of a set, one a part, do not grow with the table
#: before they reach its signatures.
PART, SMALL, BLOCK, STAR, WIDTH, PARTS = 2_000_000, 8, 256, 2000, 5, 64
#: Links whose components one task finds.
FIT = 1_000_000
#: Of levels that are no more (features left out as frequent, groups of a limited size); callers may still set them.
OFTEN, LIMIT = 4, 256
_CHUNK, _MOST = 100_000, 4095                           # features that are signed at a time; partitions that are counted on
#: Rows that a task holds as Python values at a time, whatever an Arrow batch has; signatures that it sorts at a time, about.
ROWS, SORTED = 500, 250_000
#: Sets of up to so many features are told apart by all of these; features that a task sends to that at a time.
FEW, TOLD = 80, 500_000


def shingles(text: str | None, size: int, seed: int) -> np.ndarray:
    """Hashes of the distinct shingles, ascending: words at ASCII white space, A-Z lower-cased; of fewer words one for the
    whole sequence. Words are hashed, and shingles from these by columns."""
    words = (text or "").encode().lower().split()
    if not words:
        return np.empty(0, np.uint64)
    size = min(size, len(words))
    word = np.fromiter(map(xxh64_intdigest, words, repeat(seed)), np.uint64, len(words))
    last = len(words) - size + 1
    grams = word[:last]
    for i in range(1, size):
        grams = mix64(grams * np.uint64(0x9E3779B97F4A7C15) + word[i:last + i])
    grams = np.sort(grams)                              # np.unique takes several times as long
    return grams[np.r_[True, grams[1:] != grams[:-1]]]


def _name(features: np.ndarray) -> tuple[int, int]:
    """Two independent 64-bit digests of a set."""
    one, two = mix64(features).sum(dtype=np.uint64), mix64(features ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64)
    return int(mix64(np.array([one + np.uint64(len(features))]))[0].view(np.int64)), int(two.view(np.int64))


def _few(batches):
    """The batches, ``ROWS`` rows at a time."""
    for batch in batches:
        for at in range(0, len(batch), ROWS):
            yield batch.slice(at, ROWS)


def _names(docs: DataFrame, size: int, percent: int, seed: int) -> DataFrame:
    """(id, ``look``: the text's hash, ``n`` features, ``name`` and ``check``: digests of the set, ``need``: see ``Domain``) of
    (id, text)."""
    domain = Domain(percent)

    def run(batches):
        for batch in _few(batches):
            sets = [shingles(t, size, seed) for t in batch.column(2).to_pylist()]
            names = [_name(s) for s in sets]
            n = np.array([len(s) for s in sets], np.int64)
            need = domain.need(n, np.concatenate([*sets, np.empty(0, np.uint64)]))
            yield pa.record_batch([*batch.columns[:2], pa.array(n), pa.array([a for a, _ in names], pa.int64()),
                                   pa.array([b for _, b in names], pa.int64()), pa.array(need)],
                                  names=["id", "look", "n", "name", "check", "need"])

    return docs.select("id", F.xxhash64("text").alias("look"), "text").mapInArrow(
        run, "id long, look long, n long, name long, check long, need long")


#: A set in a part: the keys that follow, and those that another set of the same task has.
_TOLD = np.dtype([("name", np.int64), ("whole", np.bool_), ("keys", np.uint32), ("known", np.uint32)])


class Domain:
    """Features by which sets are told that link with nothing: twice as many as those in which a set may differ from its
    partners, of small sets all. Sets that such a small one can link with send all, too. Two features of one key count as
    one that is shared, which keeps a set."""

    def __init__(self, percent: int):
        self.percent, self.share = percent, np.uint64(min(2**32, (2**32 * 2 * (100 - percent)) // 100))

    def _within(self, key: np.ndarray, whole: np.ndarray) -> np.ndarray:
        return whole | (key < self.share)

    @staticmethod
    def _hash(features: np.ndarray) -> np.ndarray:
        return mix64(features ^ np.uint64(0x6A09E667F3BCC909))

    def need(self, n: np.ndarray, features: np.ndarray) -> np.ndarray:
        """How many of the domain's features other sets must have, too, for sets of ``n`` features each to link."""
        of = np.repeat(np.arange(len(n)), n)
        held = np.bincount(of, weights=self._within(self._hash(features) >> np.uint64(32), n[of] <= FEW), minlength=len(n))
        return held.astype(np.int64) - n * (100 - self.percent) // 100

    def sent(self, name: np.ndarray, n: np.ndarray, features: np.ndarray, parts: int) -> pa.RecordBatch:
        """A row for each part: what it is to know of the features of some sets. Of those that several of these have, the
        part learns the key alone."""
        of, h = np.repeat(np.arange(len(n)), n), self._hash(features)
        on = self._within(h >> np.uint64(32), n[of] * self.percent <= FEW * 100)
        of, h, half = of[on], h[on], np.uint64(32)
        part, key = h % np.uint64(parts) << half, h >> half
        order = np.argsort(part | key)
        of, part, key = of[order], part[order], key[order]
        again = np.r_[False, (part[1:] == part[:-1]) & (key[1:] == key[:-1])][:len(key)]
        alone = ~(again | np.r_[again[1:], False][:len(key)])
        first = ~alone & ~again
        place, at = np.unique(part | of.astype(np.uint64), return_inverse=True)
        number = (place & np.uint64(2**32 - 1)).astype(np.int64)
        sets = np.zeros(len(place), _TOLD)
        sets["name"], sets["whole"] = name[number], n[number] <= FEW
        sets["keys"] = np.bincount(at[alone], minlength=len(place))
        sets["known"] = np.bincount(at[~alone & self._within(key, n[of] <= FEW)], minlength=len(place))
        keep = (sets["keys"] > 0) | (sets["known"] > 0)
        mine = np.flatnonzero(alone)[np.argsort(at[alone], kind="stable")]
        numbers = np.arange(parts, dtype=np.uint64)
        return pa.record_batch([pa.array(numbers.astype(np.int64))] + [
            _binary(values, np.searchsorted(where >> half, np.arange(parts + 1, dtype=np.uint64)))
            for values, where in ((sets[keep], place[keep]), (key[mine].astype(np.uint32), part[mine]),
                                  (key[first].astype(np.uint32), part[first]))], names=["part", "sets", "keys", "known"])

    def shared(self, rows) -> tuple[np.ndarray, np.ndarray]:
        """(name, its features that other sets have, too) of the rows (sets, keys, known) of a part. A set that several tasks
        sent may count what it shares more than once."""
        sets, key, known = (np.concatenate([np.frombuffer(r[i], t) for r in rows])
                            for i, t in enumerate((_TOLD, np.uint32, np.uint32)))
        of = np.repeat(np.arange(len(sets), dtype=np.int32), sets["keys"])
        order = np.argsort(key)
        key, of = key[order], of[order]
        again = np.r_[False, key[1:] == key[:-1]][:len(key)]
        there = np.isin(key, known)
        some = again | np.r_[again[1:], False][:len(key)] | there
        key, of, there = key[some], of[some], there[some]
        name = sets["name"][of]
        order = np.lexsort((name, key))
        key, of, there, name = key[order], of[order], there[order], name[order]
        new = np.r_[True, (key[1:] != key[:-1]) | (name[1:] != name[:-1])][:len(key)]
        key, of, there, name = key[new], of[new], there[new], name[new]
        start = np.flatnonzero(np.r_[True, key[1:] != key[:-1]][:len(key)])
        length = np.diff(np.r_[start, len(key)])
        on = (there | np.repeat(length > 1, length)) & self._within(key, sets["whole"][of])
        names, at = np.unique(np.concatenate([name[on], sets["name"]]), return_inverse=True)
        counts = np.bincount(at, weights=np.concatenate([np.ones(int(on.sum())), sets["known"]])).astype(np.int64)
        return names[counts > 0], counts[counts > 0]


def _binary(values: np.ndarray, cuts: np.ndarray) -> pa.Array:
    """Between each two ``cuts`` the bytes of the values there."""
    data = pa.py_buffer(np.ascontiguousarray(values))
    return pa.BinaryArray.from_buffers(pa.binary(), len(cuts) - 1, [None, pa.py_buffer((cuts * values.itemsize).astype(np.int32)), data])


def _may_link(docs: DataFrame, classes: DataFrame, size: int, percent: int, seed: int) -> DataFrame:
    """The classes (name, n, need) but those that link with nothing, as too few of their features occur in other sets."""
    domain = Domain(percent)
    total = classes.agg(F.sum(F.when(F.col("n") <= FEW, F.col("n")).otherwise(F.col("n") * domain.share.item() / 2**32))).first()[0]
    parts = max(PARTS, int(total or 0) // PART + 1)

    def send(batches):
        seen, held, count = set(), [], 0

        def out():
            return domain.sent(np.array([x for x, _ in held], np.int64), np.array([len(f) for _, f in held], np.int64),
                               np.concatenate([f for _, f in held]), parts)
        for batch in _few(batches):
            for text in batch.column(0).to_pylist():
                features = shingles(text, size, seed)
                name = _name(features)[0]
                if len(features) and name not in seen:
                    seen.add(name)
                    held.append((name, features))
                    count += len(features)
                    if count >= TOLD:
                        yield out()
                        held, count = [], 0
        if held:
            yield out()

    def tell(batches):
        for _, rows in _by_part(batches, _rows):
            names, counts = domain.shared(rows)
            yield pa.record_batch([pa.array(names), pa.array(counts)], names=["told", "shared"])

    sent = docs.select("text").mapInArrow(send, "part long, sets binary, keys binary, known binary")
    told = sent.repartition(parts, "part").sortWithinPartitions("part").mapInArrow(tell, "told long, shared long")
    told = told.groupBy("told").agg(F.sum("shared").alias("shared"))
    return classes.join(told, classes.name == told.told, "left").where(F.coalesce("shared", F.lit(0)) >= F.col("need")).select(classes["*"])


class Instances:
    """Size bands and, by level, what their instances ask of signatures."""

    def __init__(self, percent: int, level: int):
        low, self.high = 1, []
        while low < 2**40:
            self.high.append(low * 100 // percent)
            low = self.high[-1] + 1
        self.high = np.array(self.high)
        self.percent, self.level = percent, level
        self.spare, self.cells = LEVELS[level]
        self.k = 2 * self.high * (100 - percent) // (100 + percent)
        must = self.k // (self.spare + 1) + 1
        self.partitions = must + -(-must // 5) + 2
        self.subsets = list(combinations(range(self.cells), self.cells - self.spare))

    def taken(self, n: np.ndarray, step: int) -> np.ndarray:
        """The instance of sets of ``n`` features in their band (step 0) or the next; -1 where they meet nobody there."""
        band = np.searchsorted(self.high, n)
        # equal sets are one node: an instance without room for differences links nothing, nor one above all partners
        on = (self.k[band + step] > 0) & ((step == 0) | (n * 100 // self.percent > self.high[band]))
        return np.where(on, band + step, -1)

    def signatures(self, n: np.ndarray, features: np.ndarray, held: np.ndarray | None = None
                   ) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
        """(set's number, signature) of the sets of ``n`` features each, one after another, of which ``held`` (all) are in the
        domain; and for each set in how many partitions at least it meets every partner of its own and of the next instance."""
        owner = np.repeat(np.arange(len(n)), n if held is None else held)
        found = [self._instance(self.taken(n, step), owner, features) for step in (0, 1)]
        return np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found]), [f[2] for f in found]

    def uncovered(self, n: np.ndarray, held: np.ndarray) -> np.ndarray:
        """Whether linked sets of ``n`` features may have none in common of the ``held`` ones in the domain."""
        most = np.max([np.where((t := self.taken(n, step)) >= 0, self.k[t], -1) for step in (0, 1)], axis=0)
        return held <= most

    def least(self, n: np.ndarray, own: np.ndarray, above: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Signatures that linked sets ``a`` and ``b`` (numbers) share at least."""
        band, up = np.searchsorted(self.high, n), self.taken(n, 1) >= 0
        alike = np.maximum(own[a], own[b]) + np.where(up[a] & up[b], np.maximum(above[a], above[b]), 0)
        low, high = np.where(n[a] < n[b], a, b), np.where(n[a] < n[b], b, a)
        return np.where(band[a] == band[b], alike, np.maximum(above[low], own[high]))

    def _instance(self, t: np.ndarray, owner: np.ndarray, features: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        rows = np.where(t >= 0, self.partitions[t], 0)
        base = np.cumsum(rows) - rows
        here = t[owner] >= 0
        owner, features = owner[here], features[here]
        h = mix64(features ^ np.uint64(0x9E3779B97F4A7C15 * (self.level + 1) & (2**64 - 1)))
        half = np.uint64(32)
        row = ((h >> half) * rows[owner].astype(np.uint64) >> half).astype(np.int64) + base[owner]
        cell = row * self.cells + ((h & np.uint64(0xFFFFFFFF)) * np.uint64(self.cells) >> half).astype(np.int64)
        sums = np.zeros(int(rows.sum()) * self.cells, np.uint64)
        np.add.at(sums, cell, mix64(features + np.uint64(1)))
        sums = sums.reshape(-1, self.cells)
        filled = sums != 0
        of = np.repeat(np.arange(len(t)), rows)
        place = mix64((t[of].astype(np.uint64) << half) + (np.arange(len(of)) - base[of]).astype(np.uint64))
        spread = mix64(sums) * np.arange(3, 3 + 2 * self.cells, 2, dtype=np.uint64)
        sets, keys = [], []
        for number, subset in enumerate(self.subsets):
            some = filled[:, subset].any(1)
            sets.append(of[some])
            keys.append(mix64(spread[some][:, subset].sum(1, dtype=np.uint64) ^ place[some] + np.uint64(number)))
        sure = np.bincount(of, weights=filled.sum(1) > self.spare, minlength=len(t)).astype(np.int64) - self.k[t] // (self.spare + 1)
        alone = sure[owner] <= 0
        sets.append(owner[alone])
        keys.append(mix64(mix64(features[alone]) + t[owner[alone]].astype(np.uint64)))
        return np.concatenate(sets), np.concatenate(keys), np.where(t >= 0, sure.clip(0, _MOST), 0)

    def load(self) -> float:
        """About how many signatures a feature makes, over both instances of its set."""
        differ = 2 * (100 - self.percent) / (100 + self.percent)
        return 2.6 * 1.2 * differ / (self.spare + 1) * len(self.subsets) + 0.1


class Rarest:
    """What the rarest features ask of linked sets. Under any one order of all features, a set takes all but so many as it
    shares with each partner at least, less one: linked sets have some of those in common."""

    def __init__(self, percent: int):
        self.percent = percent

    def rest(self, n: np.ndarray) -> np.ndarray:
        """How many of ``n`` features a set does not take."""
        return -(-n * self.percent // 100) - 1

    def meet(self, n: np.ndarray, ahead: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether ``a`` and ``b`` of one feature may be linked sets that share none before it: of the features that a set
        takes and that others have, too, ``ahead`` begin with this one. What linked sets share besides features that both
        take, the one whose taken features end first in the order does not take."""
        low, high = np.minimum(n[a], n[b]), np.maximum(n[a], n[b])
        both = -(-(low + high) * self.percent // (100 + self.percent))
        return (self.percent * high <= 100 * low) & (np.minimum(ahead[a], ahead[b]) >= both - self.rest(high))

    def meet_sql(self, x: str, y: str) -> str:
        """``meet`` of two rows (n, ahead) that a join names ``x`` and ``y``."""
        p, high = self.percent, f"greatest({x}.n, {y}.n)"
        return (f"{p} * {high} <= 100 * least({x}.n, {y}.n) AND least({x}.ahead, {y}.ahead) >= "
                f"(({x}.n + {y}.n) * {p} + {99 + p}) div {100 + p} - (({high} * {p} + 99) div 100 - 1)")

    def load(self) -> float:
        """About how many features a set takes, of each of its own."""
        return (100 - self.percent) / 100 + 0.1


ENTRIES = "part long, name long, n long, keys binary"            # n: features, and the partitions counted on by 12 bits each


def _entries(held, instances: Instances, parts: int) -> pa.RecordBatch:
    """A row for each set and part: the signatures that the part takes, ``WIDTH`` bytes each."""
    name, n = np.array([x for x, _, _ in held], np.int64), np.array([k for _, k, _ in held], np.int64)
    of, key, (own, above) = instances.signatures(n, np.concatenate([f for *_, f in held]), np.array([len(f) for *_, f in held], np.int64))
    n = n | own << 40 | above << 52
    part = (key % np.uint64(parts)).astype(np.int64)
    order = np.argsort(part * len(n) + of, kind="stable")
    of, part = of[order], part[order]
    data = np.ascontiguousarray((key[order] >> np.uint64(64 - 8 * WIDTH)).view(np.uint8).reshape(-1, 8)[:, :WIDTH])
    first = np.flatnonzero(np.r_[len(of) > 0, (of[1:] != of[:-1]) | (part[1:] != part[:-1])])
    offsets = (np.r_[first, len(of)] * WIDTH).astype(np.int32)
    keys = pa.BinaryArray.from_buffers(pa.binary(), len(first), [None, pa.py_buffer(offsets), pa.py_buffer(data)])
    return pa.record_batch([pa.array(part[first]), pa.array(name[of[first]]), pa.array(n[of[first]]), keys],
                           names=["part", "name", "n", "keys"])


def _signed(sets, instances: Instances, parts: int):
    """Entries of (name, n, features in the domain), some sets at a time."""
    held, size = [], 0
    for item in sets:
        held.append(item)
        size += len(item[2]) + 1
        if size >= _CHUNK:
            yield _entries(held, instances, parts)
            held, size = [], 0
    if held:
        yield _entries(held, instances, parts)


def _parts(rows: DataFrame, instances: Instances) -> int:
    total = rows.agg(F.sum("n")).first()[0] or 0
    return max(PARTS, int(total * instances.load()) // PART + 1)


MET = "grp long, a long, b long, hits long, least long"
#: Hits of a pair that stands for a larger group, whatever its signatures.
_STAR_HITS = 1 << 40


def _meet(entries: DataFrame, parts: int, groups, joined=None) -> DataFrame:
    """What shares a signature: candidate pairs without ``grp``, with the signatures they share in a part and need in all; and
    (grp, name, n, more of the member) of groups of over ``SMALL`` sets; by ``groups`` of a part's columns."""
    def run(batches):
        for part, columns in _by_part(batches, joined):
            yield from groups(part, *columns)

    return entries.repartition(parts, "part").sortWithinPartitions("part").mapInArrow(run, MET)


def _by_part(batches, joined=None):
    """(part, its other columns as ``joined`` makes them) of rows sorted by part, across Arrow batches."""
    joined = joined or _joined
    now, held = None, []
    for batch in batches:
        part = batch.column(0).to_numpy(zero_copy_only=False)
        cuts = np.flatnonzero(np.r_[len(part) > 0, part[1:] != part[:-1]])
        for lo, hi in zip(cuts, np.r_[cuts[1:], len(part)], strict=True):
            if held and part[lo] != now:
                yield now, joined(held)
            now = int(part[lo])
            held.append(batch.slice(lo, hi - lo))
    if held:
        yield now, joined(held)


def _rows(held) -> list[tuple]:
    rows = [row for b in held for row in zip(*(c.to_pylist() for c in b.columns[1:]), strict=True)]
    held.clear()
    return rows


def _joined(held) -> tuple[np.ndarray, ...]:
    """(set names, sizes as packed, and per signature the number of its set and the signature); lets go of ``held``."""
    name = np.concatenate([b.column(1).to_numpy(zero_copy_only=False) for b in held])
    n = np.concatenate([b.column(2).to_numpy(zero_copy_only=False) for b in held])
    keys, counts = [], []
    for b in held:
        c = b.column(3)
        offsets = np.frombuffer(c.buffers()[1], np.int32)[c.offset:c.offset + len(c) + 1]
        keys.append(np.frombuffer(c.buffers()[2], np.uint8)[offsets[0]:offsets[-1]].reshape(-1, WIDTH))
        counts.append(np.diff(offsets) // WIDTH)
    held.clear()
    wide = np.zeros((sum(map(len, keys)), 8), np.uint8)
    np.concatenate(keys, out=wide[:, :WIDTH])
    return name, n, np.repeat(np.arange(len(name), dtype=np.int32), np.concatenate(counts)), wide.view(np.uint64).ravel()


def _groups(part: int, name: np.ndarray, packed: np.ndarray, of: np.ndarray, key: np.ndarray, instances: Instances):
    n, own, above = packed & (2**40 - 1), packed >> 40 & _MOST, packed >> 52 & _MOST
    found = {False: [], True: []}
    for at in _ranges(key):
        pairs, stars, (many, members) = _alike(name, of[at], key[at])
        found[False].append(pairs)
        found[True].append(stars)
        if len(many):
            yield _met(mix64(many + mix64(np.array([part], np.uint64))[0]).view(np.int64), name[members], packed[members])
    for stars, some in found.items():
        a, b = (np.concatenate([x[side] for x in some]) for side in (0, 1))
        fit = instances.percent * np.maximum(n[a], n[b]) <= 100 * np.minimum(n[a], n[b])
        if fit.any():
            both, first, hits = np.unique(a[fit].astype(np.int64) << 32 | b[fit], return_index=True, return_counts=True)
            a, b = a[fit][first], b[fit][first]
            yield _met(None, name[a], name[b], np.full(len(a), _STAR_HITS) if stars else hits, instances.least(n, own, above, a, b))


def _ranges(key: np.ndarray):
    """Positions of the signatures, some whole signatures at a time: about ``SORTED`` positions, by a byte that is mixed well."""
    pieces = min(256, len(key) // SORTED + 1)
    piece = (key >> np.uint64(8 * WIDTH - 8) & np.uint64(255)).astype(np.uint16) * np.uint16(pieces) >> 8
    return (np.flatnonzero(piece == p) for p in range(pieces))


def _alike(name: np.ndarray, of: np.ndarray, key: np.ndarray):
    """Groups of sets (numbers ``of``) with one signature: the pairs of small ones, the stars of others, and these with their
    members."""
    order = np.argsort(key)
    key, of = key[order], of[order]
    same = np.r_[False, key[1:] == key[:-1]]
    twice = same | np.r_[same[1:], False]               # signatures of one set alone go
    key, of = key[twice], of[twice]
    order = np.lexsort((name[of], key))
    key, of = key[order], of[order]
    new = np.r_[True, (key[1:] != key[:-1]) | (name[of][1:] != name[of][:-1])][:len(key)]
    key, of = key[new], of[new]                         # copies that several tasks named
    start = np.flatnonzero(np.r_[len(key) > 0, key[1:] != key[:-1]])
    length = np.diff(np.r_[start, len(key)])
    small = np.repeat(length <= SMALL, length)
    left, right = [], []
    for d in range(1, SMALL):
        i = np.flatnonzero((key[d:] == key[:-d]) & small[d:])
        left.append(of[i])
        right.append(of[i + d])
    centre = np.repeat(of[start], length)
    star = ~small & (centre != of)
    return (np.concatenate(left), np.concatenate(right)), (centre[star], of[star]), (key[~small], of[~small])


def _met(group, a, b, hits=None, least=None) -> pa.RecordBatch:
    none = pa.nulls(len(a), pa.int64())
    return pa.record_batch([none if c is None else pa.array(c, pa.int64()) for c in (group, a, b, hits, least)],
                           names=["grp", "a", "b", "hits", "least"])


def _sets(docs: DataFrame, nodes: DataFrame, size: int, seed: int) -> DataFrame:
    """(name, features) of the ``nodes`` (name, look), read from the texts again; a task takes a text once. Texts of one hash
    may add sets that nobody asks for, and a set may come twice."""
    def once(batches):
        seen, squeeze = set(), zstandard.ZstdCompressor(level=1)
        for batch in _few(batches):
            looks, texts = [], []
            for look, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if look not in seen:
                    seen.add(look)
                    looks.append(look)
                    texts.append(squeeze.compress((text or "").encode()))
            yield pa.record_batch([pa.array(looks, pa.int64()), pa.array(texts, pa.binary())], names=["look", "text"])

    def read(batches):
        seen, whole = set(), zstandard.ZstdDecompressor()
        for batch in _few(batches):
            names, blobs = [], []
            for look, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if look not in seen:
                    seen.add(look)
                    features = shingles(whole.decompress(text).decode(), size, seed)
                    names.append(_name(features)[0])
                    blobs.append(features.tobytes())
            yield pa.record_batch([pa.array(names, pa.int64()), pa.array(blobs, pa.binary())], names=["name", "features"])

    texts = docs.select(F.xxhash64("text").alias("look"), "text").mapInArrow(once, "look long, text binary")
    return texts.join(nodes.select("look").distinct(), "look", "left_semi").mapInArrow(read, "name long, features binary")


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose sets are similar enough. A set travels once for up to ``STAR`` of its partners."""
    degree = pairs.groupBy("a").agg(F.ceil(F.count("*") / STAR).cast("int").alias("salts"))
    other = (pairs.join(degree, "a").withColumn("salt", F.pmod(F.xxhash64("b"), F.col("salts")).cast("int"))
             .join(sets.withColumnRenamed("name", "b"), "b").select("a", "salt", F.lit(1).alias("side"), "b", "features"))
    centre = (degree.withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)))
              .join(sets.withColumnRenamed("name", "a"), "a").select("a", "salt", F.lit(0).alias("side"), F.col("a").alias("b"), "features"))

    def run(batches):
        whole, now = None, None
        for batch in _few(batches):
            a, b = [], []
            for x, salt, side, y, blob in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                features = np.frombuffer(blob, np.uint64)
                if side == 0:
                    whole, now = features, (x, salt)
                    continue
                if now != (x, salt):
                    raise ValueError(f"set {x} is not among those read from the texts again")
                at = np.minimum(np.searchsorted(whole, features), len(whole) - 1)
                both = int((whole[at] == features).sum())
                if 100 * both >= percent * (len(whole) + len(features) - both):
                    a.append(x)
                    b.append(y)
            yield pa.record_batch([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    return (other.union(centre).repartition(partitions(pairs), "a", "salt").sortWithinPartitions("a", "salt", "side")
            .mapInArrow(run, "a long, b long"))


def _between(groups: DataFrame, rarest: Rarest) -> DataFrame:
    """Pairs of one group but different components that may be linked, from (grp, name, n, ahead, root, members), block by
    block."""
    blocks = F.ceil(F.col("members") / BLOCK).cast("int")
    dealt = (groups.withColumn("block", F.pmod(F.xxhash64("name"), blocks).cast("int"))
             .withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
             .select("grp", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"), "block", "name", "n", "ahead", "root"))
    x, y = dealt.alias("x"), dealt.alias("y")
    same = [F.col(f"x.{c}") == F.col(f"y.{c}") for c in ("grp", "low", "high")]
    pairs = x.join(y, same[0] & same[1] & same[2] & (F.col("x.name") < F.col("y.name")) & (F.col("x.root") != F.col("y.root"))
                   & ((F.col("x.block") != F.col("y.block")) | (F.col("x.low") == F.col("x.high"))) & F.expr(rarest.meet_sql("x", "y")))
    return pairs.select(F.col("x.name").alias("a"), F.col("y.name").alias("b")).distinct()


def _labelled(groups: DataFrame, labels: DataFrame) -> DataFrame:
    """Members (grp, name, n, ahead, root, members) of the groups that hold several components."""
    rooted = groups.join(labels, groups.a == labels.node, "left").select(
        "grp", F.col("a").alias("name"), F.col("b").alias("n"), F.col("hits").alias("ahead"), F.coalesce("root", "a").alias("root"))
    mixed = rooted.groupBy("grp").agg(F.count("*").alias("members"), F.min("root").alias("least"), F.max("root").alias("most"))
    return rooted.join(mixed.where("least <> most").select("grp", "members"), "grp")


def links(docs: DataFrame, classes: DataFrame, size: int, percent: int, seed: int) -> DataFrame:
    """(node, root) of the classes (name, look, n, need) that link with another; ``docs`` are (id, text)."""
    spark = docs.sparkSession
    classes = reliable_checkpoint(_may_link(docs, classes, size, percent, seed))
    _let_go(spark)
    sets = _sets(docs, classes, size, seed).withColumn("n", (F.octet_length("features") / 8).cast("long"))
    sets = reliable_checkpoint(sets.where("n > 0").select("name", "n", "features"))
    _let_go(spark)
    instances, every = Instances(percent, 0), spark.sparkContext.broadcast(np.empty(0, np.uint64))
    parts = _parts(classes, instances)
    entries = sets.mapInArrow(_resigned(instances, every, parts), ENTRIES)
    met = reliable_checkpoint(_meet(entries, parts, lambda part, *columns: _groups(part, *columns, instances)))
    _let_go(spark)
    pairs, groups = _split(met)
    found = reliable_checkpoint(_verified(pairs, sets.select("name", "features"), percent))
    _let_go(spark)
    labels = reliable_checkpoint(_roots(found))
    hot = reliable_checkpoint(_labelled(groups, labels).select("name").distinct())
    if not hot.limit(1).count():
        return labels
    again = reliable_checkpoint(sets.join(hot, "name", "left_semi"))
    rarest = Rarest(percent)
    parts = _parts(again, rarest)
    del entries, met, pairs, groups, sets
    _let_go(spark)
    met = _meet(_rare(_counted(again), rarest, parts), parts, lambda part, *columns: _rare_groups(part, *columns, rarest), _columns)
    met = reliable_checkpoint(met)
    _let_go(spark)
    pairs, groups = _split(met)
    again = again.select("name", "features")
    found = found.union(reliable_checkpoint(_verified(_apart(pairs, labels), again, percent)))
    _let_go(spark)
    labels = reliable_checkpoint(_roots(found))
    mixed = reliable_checkpoint(_labelled(groups, labels))
    more = reliable_checkpoint(_between(mixed, rarest).join(pairs, ["a", "b"], "left_anti"))
    _let_go(spark)
    if not more.limit(1).count():
        return labels
    return _roots(found.union(reliable_checkpoint(_verified(more, again, percent))))


def _roots(links: DataFrame) -> DataFrame:
    """``components`` of stored links; of up to ``FIT`` in one task, without exchanges."""
    if links.count() > FIT:
        return components(links)

    def run(batches):
        held = [[c.to_numpy(zero_copy_only=False) for c in batch.columns] for batch in batches]
        if held:
            yield pa.record_batch(list(_united(*(np.concatenate(c) for c in zip(*held, strict=True)))), names=["node", "root"])

    return links.select("a", "b").coalesce(1).mapInArrow(run, "node long, root long")


def _united(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(node, the least node reachable) of the ends of links."""
    node, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    one, two = at[:len(a)], at[len(a):]
    root, last = np.arange(len(node)), None
    while last is None or (root != last).any():
        last, root = root, root.copy()
        low = np.minimum(last[one], last[two])
        for side in (one, two, last[one], last[two]):
            np.minimum.at(root, side, low)
        while (root[root] != root).any():
            root = root[root]
    return node, node[root]


def _apart(pairs: DataFrame, labels: DataFrame) -> DataFrame:
    """The pairs (a, b) of different components."""
    of = [labels.select(F.col("node").alias(c), F.col("root").alias(f"root_{c}")) for c in "ab"]
    return (pairs.join(of[0], "a", "left").join(of[1], "b", "left")
            .where(F.coalesce("root_a", "a") != F.coalesce("root_b", "b")).select("a", "b"))


def _let_go(spark) -> None:
    """Let Spark's cleaner delete the shuffle files of steps whose results are checkpointed: it learns from the collectors
    that nobody holds them any more."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def _domain(often, batches):
    """(name, n, features in the domain) of (name, n, features)."""
    out = often.value
    for batch in _few(batches):
        for name, n, blob in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            features = np.frombuffer(blob, np.uint64)
            if len(out):
                features = features[out[np.minimum(np.searchsorted(out, features), len(out) - 1)] != features]
            yield name, n, features


def _resigned(instances: Instances, often, parts: int):
    def run(batches):
        yield from _signed(_domain(often, batches), instances, parts)
    return run


#: Rows of a piece of the sets: what it asks a part, or the part's answer; of source -1 the piece itself.
PIECES = "piece long, source long, data binary"


def _asked(features: np.ndarray, parts: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(order by part, where each part begins there and the last ends, keys in that order) of features that are counted."""
    h = mix64(features ^ np.uint64(0xBB67AE8584CAA73B))
    part = (h % np.uint64(parts)).astype(np.int64)
    order = np.argsort(part, kind="stable")
    return order, np.searchsorted(part[order], np.arange(parts + 1)), (h[order] >> np.uint64(32)).astype(np.uint32)


def _tally(keys: list[np.ndarray]) -> list[np.ndarray]:
    """For each key of each piece, how often the part was asked for it: a byte, exact up to 128 and then by its logarithm."""
    _, at, count = np.unique(np.concatenate(keys), return_inverse=True, return_counts=True)
    scaled = np.where(count <= 128, count, np.minimum(128 + 8 * np.log2(count / 128), 255)).astype(np.uint8)
    return np.split(scaled[at], np.cumsum([len(k) for k in keys])[:-1])


#: A feature that a set takes, of its part: n, ahead as for ``Rarest.meet``.
RARE = "part long, name long, n long, ahead long, key long"


def _rarest(name: np.ndarray, n: np.ndarray, features: np.ndarray, count: np.ndarray, rarest: Rarest, parts: int) -> pa.RecordBatch:
    """Rows of ``RARE`` of the sets of ``n`` features each, by the counts of these; such as no other set has meet nobody."""
    of = np.repeat(np.arange(len(n)), n)
    order = np.lexsort((features, count, of))
    of, place = of[order], np.arange(len(of)) - np.repeat(np.cumsum(n) - n, n)
    taken = (place < (n - rarest.rest(n))[of]) & (count[order] > 1)
    of, key = of[taken], mix64(features[order][taken] + np.uint64(1))
    ahead = np.cumsum(np.bincount(of, minlength=len(n)))[of] - np.arange(len(of))
    part = (key % np.uint64(parts)).astype(np.int64)
    return pa.record_batch([pa.array(c) for c in (part, name[of], n[of], ahead, key.view(np.int64))], names=["part", "name", "n", "ahead", "key"])


def _columns(held) -> list[np.ndarray]:
    columns = [np.concatenate([b.column(i).to_numpy(zero_copy_only=False) for b in held]) for i in range(1, held[0].num_columns)]
    held.clear()
    return columns


def _rare_groups(part: int, name: np.ndarray, n: np.ndarray, ahead: np.ndarray, key: np.ndarray, rarest: Rarest):
    """Rows of ``MET`` of a part's rows; the centre of a star has most features ahead. Members of groups go with theirs."""
    key, order = key.view(np.uint64), np.lexsort((name, -ahead))
    first = np.r_[True, (np.diff(name[order]) != 0) | (np.diff(ahead[order]) != 0)][:len(key)]
    rank = np.empty(len(key), np.int64)
    rank[order] = np.cumsum(first)
    found = []
    for at in _ranges(key):
        *some, (many, members) = _alike(rank, at, key[at])
        for a, b in some:
            fit = rarest.meet(n, ahead, a, b)
            found.append((np.minimum(name[a], name[b])[fit], np.maximum(name[a], name[b])[fit]))
        if len(many):
            yield _met(mix64(many + mix64(np.array([part], np.uint64))[0]).view(np.int64), name[members], n[members], ahead[members])
    a, b = (np.concatenate([x[side] for x in found]) for side in (0, 1))
    order = np.lexsort((b, a))
    a, b = a[order], b[order]
    new = np.r_[True, (a[1:] != a[:-1]) | (b[1:] != b[:-1])][:len(a)]
    yield _met(None, a[new], b[new], np.ones(int(new.sum())), np.ones(int(new.sum())))


def _counted(sets: DataFrame) -> DataFrame:
    """The stored sets (name, n, features) in pieces, with the counts of their features among all of them: rows of ``PIECES``,
    of a piece in the order of source."""
    total = sets.agg(F.sum("n")).first()[0] or 0
    parts = max(PARTS, total // PART + 1)

    def pieces(batches):
        number, held, size = TaskContext.get().partitionId() << 32, [], 0
        for batch in _few(batches):
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                held.append(row)
                size += row[1]
                if size >= TOLD:
                    yield number, held
                    number, held, size = number + 1, [], 0
        if held:
            yield number, held

    def ask(batches):
        for number, held in pieces(batches):
            _, cuts, keys = _asked(np.frombuffer(b"".join(f for *_, f in held), np.uint64), parts)
            yield pa.record_batch([pa.array([number] * parts), pa.array(range(parts)), _binary(keys, cuts)], names=["piece", "source", "data"])

    def whole(batches):
        for number, held in pieces(batches):
            head = np.array([len(held), parts, *(x for x, *_ in held), *(n for _, n, _ in held)], np.int64)
            data = b"".join([head.tobytes(), *(f for *_, f in held)])
            yield pa.record_batch([pa.array([number]), pa.array([-1]), pa.array([data])], names=["piece", "source", "data"])

    def answer(batches):
        for part, rows in _by_part(batches, _rows):
            counts = _tally([np.frombuffer(data, np.uint32) for _, data in rows])
            yield pa.record_batch([pa.array([piece for piece, _ in rows]), pa.array([part] * len(rows)), pa.array([c.tobytes() for c in counts])],
                                  names=["piece", "source", "data"])

    sets = sets.select("name", "n", "features")
    asked = sets.mapInArrow(ask, PIECES).repartition(parts, "source").sortWithinPartitions("source")
    answers = asked.select("source", "piece", "data").mapInArrow(answer, PIECES)
    return (sets.mapInArrow(whole, PIECES).union(answers).repartition(partitions(sets), "piece").sortWithinPartitions("piece", "source"))


def _rare(counted: DataFrame, rarest: Rarest, parts: int) -> DataFrame:
    """Rows of ``RARE`` of sets in pieces."""
    def run(batches):
        for _, rows in _by_part(batches, _rows):
            data = rows[0][1]
            some, asked = np.frombuffer(data, np.int64, 2)
            name, n = np.frombuffer(data, np.int64, 2 * some, 16).reshape(2, -1)
            features = np.frombuffer(data, np.uint64, -1, 16 * (some + 1))
            count = np.empty(len(features), np.uint8)
            count[_asked(features, asked)[0]] = np.frombuffer(b"".join(c for _, c in rows[1:]), np.uint8)
            yield _rarest(name, n, features, count, rarest, parts)

    return counted.mapInArrow(run, RARE)


def _split(met: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(candidate pairs that share enough signatures, members of larger groups)."""
    pairs = met.where("grp IS NULL").groupBy("a", "b").agg(F.sum("hits").alias("hits"), F.max("least").alias("least"))
    return reliable_checkpoint(pairs.where("hits >= least").select("a", "b")), met.where("grp IS NOT NULL")


def near_sets(docs: DataFrame, size: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, ``n_shingles`` (size of its set of ``size``-word shingles) and ``component_id``, the least id reachable
    over links of a Jaccard similarity of ``percent`` hundredths or more (51 to 99), itself included."""
    if not 51 <= percent <= 99:
        raise ValueError("percent must be 51 to 99: bands of sizes must hold two sizes at least")
    docs = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    seed, clash = -1, True
    while clash:                                        # no two different sets may bear one name
        seed += 1
        rows = reliable_checkpoint(_names(docs, size, percent, seed))
        classes = reliable_checkpoint(rows.where("n > 0").groupBy("name").agg(
            F.min("id").alias("rep"), F.min("look").alias("look"), F.min("n").alias("n"), F.min("need").alias("need"),
            (F.min("check") != F.max("check")).alias("clash")))
        clash = classes.where("clash").limit(1).count() > 0
    roots = links(docs, classes, size, percent, seed)
    rooted = classes.join(roots, classes.name == roots.node, "left").select("name", "rep", F.coalesce("root", "name").alias("root"))
    least = rooted.groupBy("root").agg(F.min("rep").alias("component_id"))
    of = rooted.select("name", "root").join(least, "root").select(F.col("name").alias("of"), "component_id")
    return rows.join(of, (rows.name == F.col("of")) & (rows.n > 0), "left").select(
        F.col("id").alias(id_col), F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("id"))
        .alias("component_id"))
