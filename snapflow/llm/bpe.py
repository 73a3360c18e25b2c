"""Byte-level BPE encoding and decoding with a hierarchical-bitmap rank queue.

Every pre-token of the split pattern is encoded on its own. Its parts form a linked list over byte
positions; each adjacent pair that the vocabulary can merge sits in the bucket of its merge rank. A
two-level bitmap over ranks says which buckets hold entries, so find-first-set gives the next rank
without a search over the pre-token; entries whose pair has changed since are skipped when popped. One
merge costs O(log n) at most, so a pre-token of a megabyte is no special case.

Texts: null reads as empty (no tokens); an empty text has no tokens; repeated rows give repeated
results. Rank file: lines of base64 bytes and rank, read on the driver (its path is a parameter) and
broadcast: a vocabulary is a fixed-size file, and ``MAX_RANKS`` bounds it.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
from heapq import heappop, heappush
from itertools import chain

import pyarrow as pa
import regex
from pyspark.sql import DataFrame

#: Largest vocabulary that is broadcast.
MAX_RANKS = 1_000_000
_SHIFT, _MASK = 8, 255  # 256 ranks in a word of the bitmap
_CACHED = 500_000  # pre-tokens that a worker remembers, in each of two generations
_CACHED_BYTES = 64  # longer pre-tokens are encoded each time


def load_ranks(path: str) -> dict[bytes, int]:
    """The rank file's bytes -> rank."""
    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(r) for a, r in map(bytes.split, filter(bytes.strip, f))}
    if len(ranks) > MAX_RANKS:
        raise ValueError(f"{len(ranks)} ranks; at most {MAX_RANKS} are broadcast")
    missing = [b for b in range(256) if bytes([b]) not in ranks]
    if missing:
        raise ValueError(f"not a byte-level vocabulary: no rank for bytes {missing[:5]}")
    return ranks


class Merger:
    """Encodes pre-tokens; pairs of single bytes have their ranks in a table."""

    def __init__(self, ranks: dict[bytes, int]) -> None:
        self.ranks = ranks
        self.byte_pair = {tuple(k): r for k, r in ranks.items() if len(k) == 2}.get

    def encode(self, piece: bytes) -> list[int]:
        """Token ids of one pre-token: the smallest rank merges first, the leftmost among equals."""
        get = self.ranks.get
        whole = get(piece)
        if whole is not None:
            return [whole]
        n = len(piece)
        # rank of each part joined with the next one; the guards at both ends never merge
        pair = [*map(self.byte_pair, zip(piece, piece[1:])), None, None]
        after, before = [*range(1, n + 1), n, n], [*range(-1, n)]  # neighbours in the linked list of parts
        top, words, buckets = 0, {}, {}  # the queue: bitmap of words, words of ranks, positions by rank
        for i, r in enumerate(pair):
            if r is not None:
                if r in buckets:
                    buckets[r].append(i)
                else:
                    buckets[r] = [i]
                    w = r >> _SHIFT
                    words[w] = words.get(w, 0) | 1 << (r & _MASK)
                    top |= 1 << w
        while top:
            w = (top & -top).bit_length() - 1          # find-first-set on both levels
            word = words[w]
            bit = (word & -word).bit_length() - 1
            rank = (w << _SHIFT) + bit
            bucket = buckets[rank]
            if len(bucket) == 1:
                i = bucket[0]
                del buckets[rank]
                words[w] = word = word & (word - 1)
                if not word:
                    top &= top - 1
            else:
                i = heappop(bucket)
            if pair[i] != rank:
                continue                               # stale: this pair has changed since
            gone = after[i]
            end = after[i] = after[gone]
            before[end] = i
            pair[gone] = None
            r = pair[i] = get(piece[i:after[end]]) if end < n else None
            if r is not None:
                if r in buckets:
                    heappush(buckets[r], i)
                else:
                    buckets[r] = [i]
                    w = r >> _SHIFT
                    words[w] = words.get(w, 0) | 1 << (r & _MASK)
                    top |= 1 << w
            if i:
                left = before[i]
                r = pair[left] = get(piece[left:end])
                if r is not None:
                    if r in buckets:
                        heappush(buckets[r], left)
                    else:
                        buckets[r] = [left]
                        w = r >> _SHIFT
                        words[w] = words.get(w, 0) | 1 << (r & _MASK)
                        top |= 1 << w
        ids, i, ranks = [], 0, self.ranks
        while i < n:
            end = after[i]
            ids.append(ranks[piece[i:end]])
            i = end
        return ids


class Pieces(dict):
    """Ids by pre-token; remembers short pre-tokens in two bounded generations."""

    def __init__(self, merge) -> None:
        super().__init__()
        self.merge, self.old = merge, {}

    def __missing__(self, token: str) -> tuple[int, ...]:
        ids = self.old.get(token)
        if ids is None:
            raw = token.encode()
            ids = tuple(self.merge(raw))
            if len(raw) > _CACHED_BYTES:
                return ids
        if len(self) >= _CACHED:
            self.old = dict(self)
            self.clear()
        self[token] = ids
        return ids


class Codec:
    """Encoder and decoder of whole texts."""

    def __init__(self, ranks: dict[bytes, int], pattern: str) -> None:
        self.vocabulary = {r: b for b, r in ranks.items()}
        self.decimal = {r: str(r) for r in self.vocabulary}
        self.split = regex.compile(pattern).findall
        self.pieces = Pieces(Merger(ranks).encode)

    def encode(self, text: str) -> list[int]:
        return list(chain.from_iterable(map(self.pieces.__getitem__, self.split(text))))

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.vocabulary.__getitem__, ids))


_codecs: dict[str, Codec] = {}


def new_key() -> str:
    return uuid.uuid4().hex


def codec_of(key: str, ranks, pattern: str) -> Codec:
    """A worker process's codec for a ``new_key`` and broadcast ranks."""
    if key not in _codecs:
        _codecs.clear()
        _codecs[key] = Codec(ranks.value, pattern)
    return _codecs[key]


def encode(docs: DataFrame, rank_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text",
           with_ids: bool = True) -> DataFrame:
    """Per row: id, ``ids`` (array<int>; only ``with_ids``), ``n_tokens``, ``ids_sha256`` of the decimal ids
    joined by commas, ``decoded_sha256`` of the bytes that the ids decode to.

    A map over the rows: no shuffle, one text in memory at a time beside its Arrow batch.
    """
    spark = docs.sparkSession
    ranks = spark.sparkContext.broadcast(load_ranks(rank_path))
    key = new_key()
    fields = [pa.field(id_col, pa.int64())] + [pa.field("ids", pa.list_(pa.int32()))] * with_ids + [
        pa.field("n_tokens", pa.int64()), pa.field("ids_sha256", pa.string()), pa.field("decoded_sha256", pa.string())]
    schema = pa.schema(fields)

    def run(batches):
        codec = codec_of(key, ranks, pattern)
        decimal = codec.decimal
        for batch in batches:
            rows: list[list] = [[] for _ in fields]
            size = 0
            for doc, value in zip(batch.column(0), batch.column(1), strict=True):
                ids = codec.encode(value.as_py() or "")
                row = [doc.as_py()] + [ids] * with_ids + [
                    len(ids), hashlib.sha256(",".join(map(decimal.__getitem__, ids)).encode()).hexdigest(),
                    hashlib.sha256(codec.decode(ids)).hexdigest()]
                for column, x in zip(rows, row, strict=True):
                    column.append(x)
                size += len(ids)
                if with_ids and size > 1 << 20:
                    yield pa.record_batch([pa.array(c, f.type) for c, f in zip(rows, fields, strict=True)], schema=schema)
                    rows, size = [[] for _ in fields], 0
            if rows[0]:
                yield pa.record_batch([pa.array(c, f.type) for c, f in zip(rows, fields, strict=True)], schema=schema)

    ids = "ids array<int>, " if with_ids else ""
    return docs.select(id_col, text_col).mapInArrow(
        run, f"`{id_col}` long, {ids}n_tokens long, ids_sha256 string, decoded_sha256 string")


def decode(rows: DataFrame, rank_path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """Texts of the given ids: id, ``text`` (invalid UTF-8 is replaced); null ids give a null text, an id that
    is not in the vocabulary is an error."""
    ranks = rows.sparkSession.sparkContext.broadcast(load_ranks(rank_path))

    def run(batches):
        vocabulary = {r: b for b, r in ranks.value.items()}
        for batch in batches:
            texts = [None if x.as_py() is None else b"".join(map(vocabulary.__getitem__, x.as_py())).decode("utf-8", "replace")
                     for x in batch.column(1)]
            yield pa.record_batch([batch.column(0).cast(pa.int64()), pa.array(texts, pa.string())], names=[id_col, "text"])

    return rows.select(id_col, ids_col).mapInArrow(run, f"`{id_col}` long, text string")
