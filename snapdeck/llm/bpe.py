"""Byte-level BPE encoding and decoding (operator 2).

Each match of the split pattern (a pre-token) is merged on its own. The merge
queue is a hierarchical bitmap: one bucket per merge rank holds the positions
whose pair has that rank, a leaf word has a bit per bucket of its block, a
summary word has a bit per leaf. The next merge is two find-first-set steps.
Positions live in a linked list. Entries are never removed when a neighbour
merges; a stale entry is recognised by its position's present rank and
skipped. A pre-token of n bytes takes O(n log n), however long it is.

Ids equal those of a tiktoken ``Encoding`` with the same ranks and pattern and
without special tokens.

Defined results: a null text counts as empty; an empty text has no ids, and
decodes to no bytes. Repeated rows each get their own output row. Columns
other than the id and text columns are not read.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterable
from functools import partial
from heapq import heappop, heappush

import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from snapdeck.llm._common import TwoAgeCache, held, map_rows

#: Buckets per leaf word of the bitmap.
LEAF_BITS = 256

#: White space of the split pattern (Unicode White_Space); a text may be cut
#: before any run of it, since no pre-token goes from text into white space.
_WS = " \t-\r\x85\xa0  -     　"
_PIECE = re.compile(f"[{_WS}]*[^{_WS}]+|[{_WS}]+")

#: Cached pieces per worker; longer pieces are never cached.
CACHE_ENTRIES = 1_500_000
CACHE_PIECE_CHARS = 48


def merge_bytes(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The ids of one pre-token.

    ``buckets[rank]`` is a heap of positions, so that equal ranks merge from
    the left. Bit ``rank % LEAF_BITS`` of ``leaves[rank // LEAF_BITS]`` says
    that the bucket has entries, bit ``leaf`` of ``summary`` that the leaf has.
    """
    get = ranks.get
    whole = get(piece)
    if whole is not None:
        return [whole]
    n = len(piece)
    after = list(range(1, n + 1))
    before = list(range(-1, n - 1))
    rank_at: list[int] = []  # rank of the pair that starts here; -1: none, or merged away
    buckets: dict[int, list[int]] = {}
    leaves: dict[int, int] = {}
    summary = 0
    for i in range(n - 1):
        r = get(piece[i : i + 2], -1)
        rank_at.append(r)
        if r >= 0:
            if r in buckets:
                buckets[r].append(i)  # ascending, hence a heap
            else:
                buckets[r] = [i]
                leaf = r // LEAF_BITS
                leaves[leaf] = leaves.get(leaf, 0) | 1 << r % LEAF_BITS
                summary |= 1 << leaf
    rank_at.append(-1)
    while summary:
        leaf = (summary & -summary).bit_length() - 1  # find-first-set, twice
        word = leaves[leaf]
        rank = leaf * LEAF_BITS + (word & -word).bit_length() - 1
        bucket = buckets[rank]
        if len(bucket) > 1:
            i = heappop(bucket)
        else:
            i = bucket[0]
            del buckets[rank]
            word &= word - 1
            leaves[leaf] = word
            if not word:
                summary &= summary - 1
        if rank_at[i] != rank:
            continue  # stale: a neighbour has merged since
        j = after[i]
        k = after[j]
        after[i] = k
        rank_at[j] = rank_at[i] = -1
        fresh = []
        if k < n:
            before[k] = i
            fresh.append((i, get(piece[i : after[k]], -1)))
        h = before[i]
        if h >= 0:
            fresh.append((h, get(piece[h:k], -1)))
        for at, r in fresh:
            rank_at[at] = r
            if r >= 0:
                if r in buckets:
                    heappush(buckets[r], at)
                else:
                    buckets[r] = [at]
                    leaf = r // LEAF_BITS
                    leaves[leaf] = leaves.get(leaf, 0) | 1 << r % LEAF_BITS
                    summary |= 1 << leaf
    ids, i = [], 0
    while i < n:
        ids.append(ranks[piece[i : after[i]]])
        i = after[i]
    return ids


class ByteBpe:
    """A rank file and a split pattern: text to ids, ids to bytes."""

    def __init__(self, ranks: dict[bytes, int], pattern: str, cache_entries: int = CACHE_ENTRIES):
        self.ranks = ranks
        self.split = regex.compile(pattern)
        self.bytes_of = {r: b for b, r in ranks.items()}
        self.text_of = {r: str(r) for r in self.bytes_of}
        self.cached = TwoAgeCache(self._piece, cache_entries, CACHE_PIECE_CHARS)

    def _piece(self, piece: str) -> tuple[int, ...]:
        return tuple(i for m in self.split.findall(piece) for i in merge_bytes(m.encode("utf-8"), self.ranks))

    def encode(self, text: str | None) -> list[int]:
        if not text:
            return []
        ids: list[int] = []
        young = self.cached.young
        for p in _PIECE.findall(text):
            got = young.get(p)
            if got is None:
                got = self.cached.miss(p)
                young = self.cached.young
            ids.extend(got)
        return ids

    def decode(self, ids: Iterable[int]) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids))

    def decimal(self, ids: Iterable[int]) -> str:
        return " ".join(map(self.text_of.__getitem__, ids))


def load(path: str, pattern: str, cache_entries: int = CACHE_ENTRIES) -> ByteBpe:
    """The codec of a rank file; kept by a worker between its tasks."""

    def build() -> ByteBpe:
        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
        return ByteBpe(ranks, pattern, cache_entries)

    return held(("bpe", path, pattern, cache_entries), build)


def _encoder(path: str, pattern: str, cache_entries: int):
    bpe = load(path, pattern, cache_entries)
    return lambda key, text: ((key, bpe.encode(text)),)


def _decoder(path: str, pattern: str):
    bpe = load(path, pattern)
    return lambda key, ids: ((key, bpe.decode(ids or ())),)


def _round_trip(path: str, pattern: str):
    bpe = load(path, pattern)

    def one(key, text):
        ids = bpe.encode(text)
        return (
            (
                key,
                len(ids),
                hashlib.sha256(bpe.decimal(ids).encode("ascii")).hexdigest(),
                hashlib.sha256(bpe.decode(ids)).hexdigest(),
            ),
        )

    return one


def encode(
    df: DataFrame,
    path: str,
    pattern: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    cache_entries: int = CACHE_ENTRIES,
) -> DataFrame:
    """(id, ids): the token ids of every whole text. ``cache_entries``: pieces
    that a worker remembers (some 230 bytes each); fewer cost time, not results."""
    key = df.schema[id_col]
    schema = T.StructType([key, T.StructField("ids", T.ArrayType(T.IntegerType()))])
    return map_rows(df, [id_col, text_col], schema, partial(_encoder, path, pattern, cache_entries))


def decode(df: DataFrame, path: str, pattern: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """(id, bytes): what the ids stand for. An id outside the rank file fails the task."""
    key = df.schema[id_col]
    schema = T.StructType([key, T.StructField("bytes", T.BinaryType())])
    return map_rows(df, [id_col, ids_col], schema, partial(_decoder, path, pattern))


def round_trip_digests(
    df: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(id, n_tokens, ids_sha256, decoded_sha256): encoded, decoded again, and
    digested in one pass, so that no ids leave the worker."""
    schema = T.StructType(
        [
            df.schema[id_col],
            T.StructField("n_tokens", T.LongType()),
            T.StructField("ids_sha256", T.StringType()),
            T.StructField("decoded_sha256", T.StringType()),
        ]
    )
    return map_rows(df, [id_col, text_col], schema, partial(_round_trip, path, pattern))
