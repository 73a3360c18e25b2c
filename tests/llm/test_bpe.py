import base64
import hashlib
import random

import public_tokenizers as P
import pytest
import tiktoken

from snapflow.llm import bpe
from snapflow.llm.queries import BPE_RANKS
from tests.llm.cases import documents, empty, frame, key


@pytest.fixture(scope="module")
def own():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(P.path(BPE_RANKS), "rb"))}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def codec():
    return bpe.Codec(bpe.load_ranks(P.path(BPE_RANKS)), P.PATTERN)


def test_same_ids_as_the_library(own, codec):
    rng = random.Random(4)
    texts = ["", "a" * 20_000, "ab" * 9_000, " " * 5_000, "\n" * 999 + "x", "<|endoftext|>", "é" * 3000]
    texts += ["".join(rng.choice("ab .\n'st1é汉🙂\u2003\x85") for _ in range(rng.randint(0, 60))) for _ in range(2000)]
    for t in texts:
        ids = codec.encode(t)
        assert ids == own.encode_ordinary(t)
        assert codec.decode(ids) == t.encode()


def test_remembered_pieces_are_bounded(codec, own, monkeypatch):
    monkeypatch.setattr(bpe, "_CACHED", 50)
    fresh = bpe.Codec(bpe.load_ranks(P.path(BPE_RANKS)), P.PATTERN)
    for t in [r[1] or "" for r in documents()] * 2:
        assert fresh.encode(t) == own.encode_ordinary(t)
        assert len(fresh.pieces) <= 50 and len(fresh.pieces.old) <= 50


def test_frame(spark, own):
    rows = documents()
    out = bpe.encode(frame(spark, rows), P.path(BPE_RANKS), P.PATTERN)
    want = []
    for r in rows:
        ids = own.encode_ordinary(r[1] or "")
        want.append((r[0], ids, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
                     hashlib.sha256((r[1] or "").encode()).hexdigest()))
    assert sorted((tuple(r) for r in out.collect()), key=key) == sorted(want, key=key)
    back = bpe.decode(out, P.path(BPE_RANKS))
    assert sorted((tuple(r) for r in back.collect()), key=key) == sorted(((r[0], r[1] or "") for r in rows), key=key)
    assert bpe.encode(empty(spark), P.path(BPE_RANKS), P.PATTERN).collect() == []
