import numpy as np
import public_tokenizers as P
from hypothesis import given, settings
from hypothesis import strategies as st

from snapflow.llm import bpe, tokenscan
from snapflow.llm.queries import BPE_RANKS
from tests.llm.cases import documents, empty, frame, key

EOD = 9


def brute(files):
    out = []
    for name, tokens in files.items():
        place = n = 0
        for t in tokens:
            if t == EOD:
                out.append((name, place, n, True))
                place, n = place + 1, 0
            else:
                n += 1
        if n:
            out.append((name, place, n, False))
    return sorted(out)


def blocks(spark, files, size):
    rows = [(name, i, np.array(t[i * size:(i + 1) * size], "<u2").tobytes()) for name, t in files.items() for i in range(-(-len(t) // size))]
    return spark.createDataFrame(rows, "file string, block int, data binary").repartition(3)


def test_documents_cross_blocks_and_segments(spark, monkeypatch):
    rng = np.random.default_rng(1)
    files = {f"f{k}": rng.choice([1, 2, EOD], n, p=[0.5, 0.5 - p, p]).tolist()
             for k, (n, p) in enumerate([(400, .3), (400, .02), (1, 0), (300, 0), (50, .5), (257, .1)])}
    files |= {"ends": [1, 2, EOD], "only": [EOD], "two": [EOD, EOD], "open": [EOD, 1], "none": []}
    for segment in (1 << 12, 2, 3):
        monkeypatch.setattr(tokenscan, "SEGMENT", segment)
        for size in (1, 7, 64):
            assert sorted(tuple(r) for r in tokenscan.count(blocks(spark, files, size), EOD).collect()) == brute(files)


@given(st.lists(st.sampled_from([1, 2, 3, EOD]), max_size=40))
@settings(max_examples=6, deadline=None)
def test_any_file(spark, tokens):
    got = tokenscan.count(blocks(spark, {"f": tokens}, 5), EOD)
    assert sorted(tuple(r) for r in got.collect()) == brute({"f": tokens})


def test_flat_files(spark, tmp_path):
    rng = np.random.default_rng(2)
    files = {f"{k}.bin": rng.choice([1, 70_000, EOD], 1000).tolist() for k in range(3)}
    for name, t in files.items():
        np.array(t, "<u4").tofile(tmp_path / name)
    (tmp_path / "empty.bin").touch()
    got = tokenscan.count(tokenscan.read_files(spark, str(tmp_path), width=4, block=37), EOD, "<u4").collect()
    assert sorted((r["file"].rpartition("/")[2], *tuple(r)[1:]) for r in got) == brute(files)


def test_counts_of_documents(spark, monkeypatch):
    rows = documents()
    path = P.path(BPE_RANKS)
    codec = bpe.Codec(bpe.load_ranks(path), P.PATTERN)
    want = sorted(((r[0], len(codec.encode(r[1] or ""))) for r in rows), key=key)
    got = tokenscan.document_counts(frame(spark, rows), path, P.PATTERN, 50256)
    assert sorted((tuple(r) for r in got.collect()), key=key) == want
    assert tokenscan.document_counts(empty(spark), path, P.PATTERN, 50256).collect() == []
