"""Quality classifier from weak labels.

Heuristic labellers vote good, bad or nothing on each whole text. Their votes overlap and disagree;
expectation-maximisation estimates, for each labeller, how often it votes what on good and on bad documents, and the
share of good ones, from the counts of vote patterns over all documents (at most ``3 ** labellers`` patterns, whatever
the size of the corpus). The posterior of a pattern is the label of its documents. A linear scorer over hashed
features of the whole text (shapes of words and of neighbouring words, repeats) is then trained on the posterior labels
of a bounded sample of about ``SAMPLE`` documents and scores every document; a document is kept if its score reaches the
threshold.

Toxic documents are looked for in the same way: labellers vote toxic, clean or nothing by the shares of abusive words of
several lists, with a label model of their own, and a second scorer over hashed words is trained on its posteriors (about
``TOXIC_SAMPLE`` documents of either kind, weighted by their numbers). With a pair of thresholds a document is also
rejected once that score reaches the second. The lists hold words of four languages; abuse in other words is found only as far as the scorer
learns words that stand beside them.

No given label is used in training; ``labels`` only measure. Null and empty texts, or those without words, get the
labellers' votes like any other (too short: bad). Repeated rows get equal scores. No rows: an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapflow.llm.common import lower_ascii, mix64, pieces, some_rows, utf8
from snapflow.session import reliable_checkpoint

#: Documents that the scorer is trained on; hashed features; bytes of text in one vectorised step.
SAMPLE, DIM, PIECE_BYTES = 20_000, 1 << 14, 2 << 20
#: Toxic and clean documents, each, that the toxicity scorer is trained on; hashed words; rounds of training.
TOXIC_SAMPLE, TOXIC_DIM, TOXIC_ROUNDS = 4000, 1 << 16, 250
GOOD, BAD, NONE = 1, -1, 0
#: Labellers: signal, bad and good from / up to these values (low, high): a signal within a range votes.
#: Fixed values.
LABELLERS = [
    ("same_as_before", (0.10, 1.0), (0.0, 0.04)),
    ("upper", (0.20, 1.0), (0.0, 0.05)),
    ("symbols", (0.10, 1.0), (0.0, 0.02)),
    ("bars", (0.06, 1.0), (0.0, 0.01)),
    ("distinct", (0.0, 0.35), (0.55, 1.0)),
    ("pairs_again", (0.40, 1.0), (0.0, 0.15)),
    ("stop_words", (0.0, 0.07), (0.12, 0.75)),
    ("short_words", (0.0, 0.15), (0.22, 0.90)),
    ("ends", (0.0, 0.008), (0.03, 0.35)),
    ("words", (0, 2), (20, 1e12)),
]
#: Abusive words by what they aim at; none that is as often meant otherwise. Fixed values.
ABUSE = {
    "mind": ("idiot idiots idiotic moron morons moronic stupid dumb dumbass imbecile imbeciles cretin retard retarded fool fools dimwit "
             "halfwit brainless dummkopf dumm blöd blödmann trottel depp schwachkopf vollidiot imbécile crétin débile abruti "
             "idiote stupide estúpido estúpida imbécil necio").split(),
    "worth": ("worthless pathetic loser losers useless coward wretched wertlos erbärmlich versager nichtsnutz jämmerlich "
              "pitoyable lâche inútil patético patética fracasado cobarde").split(),
    "disgust": ("trash scum disgusting filth filthy vermin vile repulsive abschaum dreck ekelhaft "
                "widerlich ungeziefer schwein ordure racaille dégoûtant dégueulasse vermine basura escoria asqueroso asquerosa "
                "cerdo").split(),
    "mock": ("clown clowns laughable ridiculous freak creep weirdo crybaby lächerlich witzfigur spinner bouffon ridicule "
             "guignol payaso ridículo ridícula").split(),
    "curse": ("fuck fucking fucker shit shitty bullshit bitch bastard asshole arsehole cunt dick prick whore slut damn scheiße scheiss "
              "arschloch wichser hure fotze hurensohn merde putain connard connasse salope enculé bâtard mierda puta puto cabrón "
              "gilipollas pendejo").split(),
}
#: Labellers of toxicity: signal, toxic and clean from / up to these values. Shares are of a text's words; ``kinds`` counts
#: the different words of all lists. Fixed values.
TOXIC_LABELLERS = [
    ("abuse", (0.008, 1.0), (0.0, 0.002)),
    ("kinds", (2, 1e12), (0, 0)),
    *((name, (0.003, 1.0), (0.0, 0.0)) for name in ABUSE),
]
#: Frequent function words of the corpus's languages. Fixed values.
STOP_WORDS = ("the of and to in a is that for it was with as on be at by this had not are but from or have an they which "
              "one you der die und das ist nicht ein eine mit von zu den auf für im dem des sich auch als an le la les de du "
              "et un une est que dans pour qui sur par pas au avec ce se sont el los las y en del por con su al lo como más").split()

_SPACE = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])
_BASE = 0x9E3779B97F4A7C15
_CODE = mix64(np.arange(1, 257, dtype=np.uint64))
# classes of bytes in a word's shape: upper, lower (and beyond ASCII), digit, else the byte itself
_SHAPE = np.arange(256, dtype=np.uint8)
_SHAPE[65:91], _SHAPE[97:123], _SHAPE[128:], _SHAPE[48:58] = 65, 97, 97, 48
_SYMBOL = np.isin(np.arange(256), [ord(c) for c in "#$%&*+=<>^~@\\_{}[]"])
SIGNALS = [name for name, _, _ in LABELLERS]
TOXIC_SIGNALS = [name for name, _, _ in TOXIC_LABELLERS]
_PUNCTUATION = np.isin(np.arange(256), [ord(c) for c in ".,;:!?\"'()[]{}<>*_-"])


def _hash_runs(values: np.ndarray, start: np.ndarray, place: np.ndarray) -> np.ndarray:
    """Polynomial hash of each run of values that begins at ``start``; ``place``: of a value in its run."""
    if not len(start):
        return np.empty(0, np.uint64)
    power = np.cumprod(np.r_[np.uint64(1), np.full(int(place.max()), _BASE, np.uint64)])
    return mix64(np.add.reduceat(_CODE[values] * power[place], start))


def _places(start: np.ndarray, n: int) -> np.ndarray:
    at = np.zeros(n, np.int64)
    at[start] = start
    return np.arange(n) - np.maximum.accumulate(at)


class Words:
    """Words (runs of bytes other than ASCII white space) of the rows of a piece, with hashes of text and shape."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray) -> None:
        n = len(data)
        is_word = ~_SPACE[data]
        edge = np.zeros(n + 1, bool)
        edge[offsets] = True
        start = np.flatnonzero(is_word & (~np.r_[False, is_word[:-1]][:n] | edge[:n]))
        self.at = np.searchsorted(start, offsets)
        kept = np.flatnonzero(is_word)                       # the bytes of words, without the space between
        self.data = data[kept]
        self.start = np.searchsorted(kept, start)
        self.size = np.diff(np.r_[self.start, len(kept)])
        self.text = _hash_runs(lower_ascii(self.data), self.start, _places(self.start, len(kept)))
        shape = _SHAPE[self.data]
        new = np.r_[True, shape[1:] != shape[:-1]][:len(shape)]
        new[self.start] = True
        turns = np.flatnonzero(new)                          # shapes without repeats of a class
        first = np.searchsorted(turns, self.start)
        self.shape = _hash_runs(shape[turns], first, _places(first, len(turns)))
        self.row = np.repeat(np.arange(len(offsets) - 1), np.diff(self.at))
        self.first = np.zeros(len(start), bool)
        self.first[self.at[:-1][np.diff(self.at) > 0]] = True

    def per_word(self, flags: np.ndarray) -> np.ndarray:
        """How many bytes of each word have the flag."""
        return np.add.reduceat(flags.astype(np.int64), self.start) if len(self.start) else np.empty(0, np.int64)


_STOP = None


def _stop_hashes() -> np.ndarray:
    global _STOP
    if _STOP is None:
        _STOP = np.sort(Words(*utf8(pa.array([" ".join(STOP_WORDS)]))).text)
    return _STOP


def signals(w: Words, rows: int) -> np.ndarray:
    """The labellers' signals of each row, a column each in the order of ``SIGNALS``; 0 without words."""
    n = np.diff(w.at)
    last = np.r_[w.start[1:], len(w.data)][:len(w.start)] - 1
    bare = w.per_word(~np.isin(w.data, [ord(c) for c in ".,;:!?"]))
    upper = w.per_word((w.data >= 65) & (w.data <= 90))
    lower = w.per_word((w.data >= 97) & (w.data <= 122))
    letters = w.per_word((w.data >= 65) & (w.data <= 90) | (w.data >= 97) & (w.data <= 122) | (w.data >= 0xC0))
    symbol = w.per_word(_SYMBOL[w.data])
    again = np.r_[False, w.text[1:] == w.text[:-1]][:len(w.text)] & ~w.first
    before = np.r_[np.uint64(0), w.text[:-1]][:len(w.text)].copy()
    before[w.first] = 0
    pair = mix64(w.text * np.uint64(3) + before)
    stop = _stop_hashes()
    is_stop = stop[np.minimum(np.searchsorted(stop, w.text), len(stop) - 1)] == w.text if len(w.text) else np.empty(0, bool)

    def share(flags: np.ndarray) -> np.ndarray:
        return np.bincount(w.row[flags], minlength=rows) / np.maximum(n, 1)

    def distinct(h: np.ndarray) -> np.ndarray:
        order = np.lexsort((h, w.row))
        new = np.r_[True, (h[order][1:] != h[order][:-1]) | (w.row[order][1:] != w.row[order][:-1])][:len(h)]
        return np.bincount(w.row[order][new], minlength=rows) / np.maximum(n, 1)

    # longer texts repeat more words of a language; their distinct share is measured against the square root
    few = np.minimum(distinct(w.text) * np.sqrt(np.maximum(n, 100) / 100), 1)
    columns = {
        "same_as_before": share(again), "upper": share((upper >= 2) & (upper > 2 * lower)), "symbols": share(symbol >= 2),
        "bars": share((bare <= 1) & (w.size == 1) & (w.data[w.start] == ord("|"))) if len(w.start) else np.zeros(rows),
        "short_words": share((letters >= 1) & (letters <= 4)), "distinct": np.where(n, few, 0),
        "pairs_again": np.where(n, 1 - distinct(pair), 0), "stop_words": share(is_stop),
        "ends": share(np.isin(w.data[last], [ord("."), ord("!"), ord("?")]) if len(last) else np.empty(0, bool)), "words": n.astype(float)}
    return np.stack([columns[s] for s in SIGNALS], axis=1)


_ABUSE = None


def _abuse_hashes() -> tuple[np.ndarray, np.ndarray]:
    """Sorted hashes of all abusive words, and the list of each."""
    global _ABUSE
    if _ABUSE is None:
        h = [bare_words(Words(*utf8(pa.array([" ".join(words)])))) for words in ABUSE.values()]
        of = np.repeat(np.arange(len(h)), [len(x) for x in h])
        h, first = np.unique(np.concatenate(h), return_index=True)
        _ABUSE = h, of[first]
    return _ABUSE


def bare_words(w: Words) -> np.ndarray:
    """Hashes of the words in lower case without their ASCII punctuation; 0 if nothing is left."""
    kept = np.flatnonzero(~_PUNCTUATION[w.data])
    word = np.searchsorted(w.start, kept, side="right") - 1
    new = np.flatnonzero(np.r_[True, word[1:] != word[:-1]][:len(word)])
    out = np.zeros(len(w.start), np.uint64)
    out[word[new]] = _hash_runs(lower_ascii(w.data[kept]), new, _places(new, len(kept)))
    return out


def toxic_signals(w: Words, bare: np.ndarray, rows: int) -> np.ndarray:
    """The toxicity labellers' signals of each row, a column each in the order of ``TOXIC_SIGNALS``; 0 without words."""
    h, of = _abuse_hashes()
    at = np.minimum(np.searchsorted(h, bare), len(h) - 1)
    hit = np.flatnonzero(h[at] == bare)
    row, word = w.row[hit], at[hit]
    by_list = np.zeros((rows, len(ABUSE)))
    np.add.at(by_list, (row, of[word]), 1)
    by_list /= np.maximum(np.diff(w.at), 1)[:, None]
    kinds = np.bincount(np.unique(row * len(h) + word) // len(h), minlength=rows)
    return np.c_[by_list.sum(axis=1), kinds, by_list]


def toxic_votes(x: np.ndarray, words: np.ndarray) -> np.ndarray:
    """Each toxicity labeller's vote on each row: GOOD (clean), BAD (toxic) or NONE; texts without words get none."""
    out = np.zeros((len(x), len(TOXIC_LABELLERS)), np.int8)
    for k, (_, bad, good) in enumerate(TOXIC_LABELLERS):
        v = x[:, k]
        out[:, k] = np.where((v >= bad[0]) & (v <= bad[1]), BAD, np.where((v >= good[0]) & (v <= good[1]), GOOD, NONE))
    out[words == 0] = NONE
    return out


def votes(x: np.ndarray) -> np.ndarray:
    """Each labeller's vote on each row: GOOD, BAD or NONE. Shares of texts under 2 words vote nothing."""
    out = np.zeros((len(x), len(LABELLERS)), np.int8)
    short = x[:, SIGNALS.index("words")] < 2
    for k, (name, bad, good) in enumerate(LABELLERS):
        v = x[:, SIGNALS.index(name)]
        out[:, k] = np.where((v >= bad[0]) & (v <= bad[1]), BAD, np.where((v >= good[0]) & (v <= good[1]), GOOD, NONE))
        if name != "words":
            out[short, k] = NONE
    return out


def features(w: Words, rows: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """(feature, share of the row's words) of each row: shapes, pairs of shapes, and pairs of equal words."""
    before = np.r_[np.uint64(0), w.shape[:-1]][:len(w.shape)].copy()
    before[w.first] = 0
    same = np.r_[False, w.text[1:] == w.text[:-1]][:len(w.text)] & ~w.first
    h = np.concatenate([w.shape, mix64(w.shape * np.uint64(3) + before + np.uint64(1)),
                        np.full(int(same.sum()), 12345, np.uint64)])
    row = np.concatenate([w.row, w.row, w.row[same]])
    return _shares(h, row, w, rows, DIM)


def toxic_features(w: Words, bare: np.ndarray, rows: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """(feature, share of the row's words) of each row: its words."""
    some = bare != 0
    return _shares(bare[some], w.row[some], w, rows, TOXIC_DIM)


def _shares(h: np.ndarray, row: np.ndarray, w: Words, rows: int, dim: int) -> list[tuple[np.ndarray, np.ndarray]]:
    key, count = np.unique(row * dim + (mix64(h) % np.uint64(dim)).astype(np.int64), return_counts=True)
    n = np.maximum(np.diff(w.at), 1)
    cuts = np.searchsorted(key, np.arange(rows + 1) * dim)
    return [((key[a:b] % dim).astype(np.uint16), (count[a:b] / n[r]).astype(np.float32))
            for r, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False))]


class LabelModel:
    """Two classes; each labeller votes by its own class-conditional rates, independently given the class."""

    def __init__(self, patterns: np.ndarray, counts: np.ndarray, rounds: int = 200) -> None:
        onehot = np.stack([patterns == v for v in (BAD, NONE, GOOD)], axis=2).astype(float)
        weight = counts / counts.sum()
        # start: votes are right more often than not
        balance = patterns.sum(axis=1) / np.maximum((patterns != 0).sum(axis=1), 1)
        good = np.clip(0.5 + 0.45 * balance, 0.05, 0.95)
        for _ in range(rounds):
            self.prior = float(np.clip(weight @ good, 1e-6, 1 - 1e-6))
            self.rates = []
            for p in (1 - good, good):
                total = np.einsum("p,plv->lv", weight * p, onehot) + 1e-6
                self.rates.append(total / total.sum(axis=1, keepdims=True))
            new = self.posterior(patterns)
            if np.abs(new - good).max() < 1e-9:
                break
            good = new

    def posterior(self, patterns: np.ndarray) -> np.ndarray:
        """The probability that documents with these votes are good."""
        logs = [np.log(q) + np.log(np.take_along_axis(r[None].repeat(len(patterns), 0), patterns[:, :, None].astype(int) + 1, 2))
                .sum(axis=(1, 2)) for q, r in ((1 - self.prior, self.rates[0]), (self.prior, self.rates[1]))]
        return 1 / (1 + np.exp(np.clip(logs[0] - logs[1], -500, 500)))

    def accuracy(self) -> np.ndarray:
        """Each labeller's estimated share of right votes among those that it casts."""
        right = self.prior * self.rates[1][:, 2] + (1 - self.prior) * self.rates[0][:, 0]
        cast = right + self.prior * self.rates[1][:, 0] + (1 - self.prior) * self.rates[0][:, 2]
        return right / np.maximum(cast, 1e-12)


def train(rows: list[tuple[np.ndarray, np.ndarray]], target: np.ndarray, rounds: int = 300, dim: int = DIM,
          weight: np.ndarray | None = None) -> np.ndarray:
    """Weights (and intercept, last) of a logistic scorer on soft labels. ``weight``: of each row, all rows alike if none."""
    size = np.array([len(f) for f, _ in rows])
    row = np.repeat(np.arange(len(rows)), size)
    f = np.concatenate([f for f, _ in rows]).astype(np.int64) if len(rows) else np.empty(0, np.int64)
    x = np.sqrt(np.concatenate([v for _, v in rows])) if len(rows) else np.empty(0)
    weight = np.full(len(rows), 1 / max(len(rows), 1)) if weight is None else weight / weight.sum()
    w, b = np.zeros(dim), 0.0
    m, s = np.zeros(dim + 1), np.zeros(dim + 1)
    for t in range(1, rounds + 1):                             # Adam on the full sample
        p = 1 / (1 + np.exp(-np.clip(np.bincount(row, x * w[f], minlength=len(rows)) + b, -30, 30)))
        err = weight * (p - target)
        g = np.r_[np.bincount(f, x * err[row], minlength=dim) + 1e-5 * w, err.sum()]
        m, s = 0.9 * m + 0.1 * g, 0.99 * s + 0.01 * g * g
        step = 0.1 * (m / (1 - 0.9 ** t)) / (np.sqrt(s / (1 - 0.99 ** t)) + 1e-8)
        w, b = w - step[:-1], b - step[-1]
    return np.r_[w, b]


def _pack(f: np.ndarray, v: np.ndarray) -> bytes:
    return f.tobytes() + v.tobytes()


def _unpack(data: bytes, share: type = np.float32) -> tuple[np.ndarray, np.ndarray]:
    n = len(data) // (2 + np.dtype(share).itemsize)
    return np.frombuffer(data, np.uint16, n), np.frombuffer(data[2 * n:], share, n).astype(np.float32)


def _marks(v: np.ndarray) -> pa.Array:
    return pa.array(["".join("-0+"[k + 1] for k in r) for r in v.tolist()], pa.string())


def _patterns(marks: list[str]) -> np.ndarray:
    return np.array([["-0+".index(c) - 1 for c in m] for m in marks], np.int8)


def evidence(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """(row, votes, features, toxic_votes, toxic_features) for rows (row, text): votes as strings of ``-``, ``0``, ``+``;
    features packed."""
    kind = docs.schema["row"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            data, offsets = utf8(batch.column(1))
            for lo, hi in pieces(offsets, PIECE_BYTES):
                w = Words(data[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo])
                bare = bare_words(w)
                yield pa.record_batch([
                    batch.column(0).slice(lo, hi - lo), _marks(votes(signals(w, hi - lo))),
                    pa.array([_pack(*f) for f in features(w, hi - lo)], pa.binary()),
                    _marks(toxic_votes(toxic_signals(w, bare, hi - lo), np.diff(w.at))),
                    pa.array([_pack(f, v.astype(np.float16)) for f, v in toxic_features(w, bare, hi - lo)], pa.binary())],
                    names=["row", "votes", "features", "toxic_votes", "toxic_features"])

    return docs.select("row", text_col).mapInArrow(
        run, f"row {kind}, votes string, features binary, toxic_votes string, toxic_features binary")


def _label_model(found: DataFrame, votes_col: str) -> tuple[LabelModel, dict[str, float], dict[str, int]] | None:
    """The label model of all rows' votes, and each pattern's posterior and count; None without rows."""
    counts = found.groupBy(votes_col).count().collect()        # at most 3 ** labellers rows
    if not counts:
        return None
    counts = {r[votes_col]: r["count"] for r in sorted(counts, key=lambda r: r[votes_col])}
    patterns = _patterns(list(counts))
    model = LabelModel(patterns, np.array(list(counts.values()), float))
    return model, dict(zip(counts, model.posterior(patterns).tolist(), strict=True)), counts


def fit(found: DataFrame) -> tuple[LabelModel, np.ndarray] | None:
    """The label model of all rows' votes and the scorer's weights; None without rows."""
    fitted = _label_model(found, "votes")
    if fitted is None:
        return None
    model, label, counts = fitted
    got = some_rows(found.select("votes", "features"), sum(counts.values()), SAMPLE).collect()
    return model, train([_unpack(bytes(r["features"])) for r in got], np.array([label[r["votes"]] for r in got]))


def fit_toxic(found: DataFrame) -> tuple[LabelModel, np.ndarray] | None:
    """The same for toxicity; the scorer gives the probability of a toxic document."""
    fitted = _label_model(found, "toxic_votes")
    if fitted is None:
        return None
    model, label, counts = fitted
    rows, target, weight = [], [], []
    for toxic in (False, True):
        of = [v for v in counts if (label[v] < 0.5) == toxic]
        n = sum(counts[v] for v in of)
        some = found.select("toxic_votes", "toxic_features").where(F.col("toxic_votes").isin(of))
        got = some_rows(some, n, TOXIC_SAMPLE).collect() if of else []
        rows += [_unpack(bytes(r["toxic_features"]), np.float16) for r in got]
        target += [1 - label[r["toxic_votes"]] for r in got]
        weight += [n / len(got)] * len(got)
    return model, train(rows, np.array(target), TOXIC_ROUNDS, TOXIC_DIM, np.array(weight))


def _scores(weights: np.ndarray, packed: list[bytes], share: type = np.float32) -> np.ndarray:
    out = np.empty(len(packed))
    for k, data in enumerate(packed):
        f, v = _unpack(data, share)
        out[k] = weights[f] @ np.sqrt(v) + weights[-1]
    return 1 / (1 + np.exp(-np.clip(out, -30, 30)))


def classify(docs: DataFrame, threshold: float | tuple[float, float] = 0.5, row: str = "doc_id",
             text_col: str = "text") -> DataFrame:
    """Per row: ``row`` (that column), ``votes``, ``label_prob`` (posterior of its votes), ``score``, the same for toxicity
    (``toxic_votes``, ``toxic_prob``, ``toxic_score``), ``keep``: the score reaches ``threshold``; if that is a pair, the
    score reaches the first and the toxic score is less than the second."""
    least, below = threshold if isinstance(threshold, tuple) else (threshold, None)
    spark = docs.sparkSession
    kind = docs.schema[row].dataType.simpleString()
    names = ["row", "votes", "label_prob", "score", "toxic_votes", "toxic_prob", "toxic_score", "keep"]
    kinds = [kind, "string", "double", "double", "string", "double", "double", "boolean"]
    schema = ", ".join(f"{n} {k}" for n, k in zip(names, kinds, strict=True))
    found = reliable_checkpoint(evidence(docs.select(F.col(row).alias("row"), F.col(text_col).alias("text"))))
    fitted = fit(found)
    if fitted is None:
        return spark.createDataFrame([], schema)
    both = spark.sparkContext.broadcast((*fitted, *fit_toxic(found)))

    def run(batches):
        model, weights, toxic_model, toxic_weights = both.value
        for batch in batches:
            if not batch.num_rows:
                continue
            label = model.posterior(_patterns(batch.column(1).to_pylist()))
            score = _scores(weights, batch.column(2).to_pylist())
            toxic = 1 - toxic_model.posterior(_patterns(batch.column(3).to_pylist()))
            toxic_score = _scores(toxic_weights, batch.column(4).to_pylist(), np.float16)
            keep = (score >= least) & (True if below is None else toxic_score < below)
            yield pa.record_batch([batch.column(0), batch.column(1), pa.array(label), pa.array(score), batch.column(3),
                                   pa.array(toxic), pa.array(toxic_score), pa.array(keep)], names=names)

    return found.mapInArrow(run, schema)
