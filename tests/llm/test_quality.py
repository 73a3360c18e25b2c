import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from snapflow.llm import quality
from snapflow.llm.common import utf8
from tests.llm.cases import documents, empty, frame

SF = "/root/testdata/sf0.01"


def plain(text):
    """The signals of one text, word by word."""
    w = [x.decode("utf-8", "replace") for x in (text or "").encode().split()]
    n = max(len(w), 1)
    low = [x.encode().lower() for x in w]
    count = lambda f: sum(map(f, w)) / n

    def upper(x):
        up, down = sum("A" <= c <= "Z" for c in x), sum("a" <= c <= "z" for c in x)
        return up >= 2 and up > 2 * down

    letters = lambda x: sum(65 <= b <= 90 or 97 <= b <= 122 or b >= 0xC0 for b in x.encode())
    pairs = list(zip([None, *low], low))
    return {
        "same_as_before": sum(a == b for a, b in zip(low, low[1:])) / n, "upper": count(upper),
        "symbols": count(lambda x: sum(c in "#$%&*+=<>^~@\\_{}[]" for c in x) >= 2), "bars": count(lambda x: x == "|"),
        "distinct": min(len(set(low)) / n * max(len(w), 100) ** 0.5 / 10, 1) if w else 0,
        "pairs_again": 1 - len(set(pairs)) / n if w else 0,
        "stop_words": count(lambda x: x.encode().lower().decode() in quality.STOP_WORDS),
        "short_words": count(lambda x: 1 <= letters(x) <= 4), "ends": count(lambda x: x[-1] in ".!?"), "words": len(w)}


def test_signals_of_whole_texts():
    texts = [r[1] for r in documents()]
    data, offsets = utf8(pa.array(texts, pa.string()))
    got = quality.signals(quality.Words(data, offsets), len(texts))
    for t, row in zip(texts, got):
        want = plain(t)
        assert np.allclose(row, [want[s] for s in quality.SIGNALS]), (t, dict(zip(quality.SIGNALS, row)), want)


def test_expectation_maximisation_finds_the_accuracies():
    rng = np.random.default_rng(0)
    good = rng.random(40_000) < 0.8
    right, cast = np.array([.95, .8, .7, .9, .85]), np.array([.5, .9, 1, .3, .7])
    v = np.where(rng.random((len(good), 5)) < right, np.where(good, 1, -1)[:, None], np.where(good, -1, 1)[:, None])
    v = np.where(rng.random(v.shape) < cast, v, 0).astype(np.int8)
    patterns, back, counts = np.unique(v, axis=0, return_inverse=True, return_counts=True)
    model = quality.LabelModel(patterns, counts.astype(float))
    assert abs(model.prior - 0.8) < 0.02 and np.abs(model.accuracy() - right).max() < 0.02
    assert ((model.posterior(patterns)[back] > 0.5) == good).mean() > 0.93


def test_held_out_accuracy(spark):
    """No given label is used in training, so all of them are held out."""
    docs = spark.read.parquet(f"{SF}/documents.parquet").repartition(4)
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    got = quality.classify(docs, threshold=0.25).join(labels, F.col("row") == labels.doc_id)
    kept = {r["quality"]: r["m"] for r in got.groupBy("quality").agg(F.avg(F.col("keep").cast("int")).alias("m")).collect()}
    assert kept[1] >= 0.98 and kept[0] <= 0.1


def test_toxic_documents_are_rejected(spark):
    """The test tables' abusive words are listed for English only; other languages invent theirs."""
    docs = spark.read.parquet(f"{SF}/documents.parquet").repartition(4)
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    got = quality.classify(docs, threshold=(0.25, 0.5)).join(labels, F.col("row") == labels.doc_id).where("quality = 1")
    kept = {(r["toxic"], r["en"]): r["m"] for r in got.join(docs.select("doc_id", (F.col("lang") == "en").alias("en")), "doc_id")
            .groupBy("toxic", "en").agg(F.avg(F.col("keep").cast("int")).alias("m")).collect()}
    assert kept[1, True] <= 0.1 and kept[0, True] >= 0.98 and kept[0, False] >= 0.98


def test_toxic_signals():
    texts = ["You IDIOT, what a clown!", "a fine day for all of us", "", None, "idiot idiot x moron."]
    data, offsets = utf8(pa.array(texts, pa.string()))
    w = quality.Words(data, offsets)
    got = quality.toxic_signals(w, quality.bare_words(w), len(texts))
    at = quality.TOXIC_SIGNALS.index
    assert np.allclose(got[:, at("abuse")], [0.4, 0, 0, 0, 0.75]) and got[:, at("kinds")].tolist() == [2, 0, 0, 0, 2]
    assert np.allclose(got[:, at("mind")], [0.2, 0, 0, 0, 0.75]) and np.allclose(got[:, at("mock")], [0.2, 0, 0, 0, 0])


def test_awkward_rows(spark):
    rows = documents()
    got = quality.classify(frame(spark, rows), row="doc_id").collect()
    assert len(got) == len(rows)
    assert all(0 <= r["score"] <= 1 and 0 <= r["label_prob"] <= 1 and len(r["votes"]) == len(quality.LABELLERS) for r in got)
    twice = [r["score"] for r in got if r["row"] == rows[2][0]]
    assert len(twice) == 3 and len(set(twice)) == 1
    assert quality.classify(empty(spark)).collect() == []
    whole = quality.classify(frame(spark, rows).select(F.struct("*").alias("row"), F.col("text")), row="row")
    assert {r["row"]["doc_id"] for r in whole.collect()} == {r[0] for r in rows}
