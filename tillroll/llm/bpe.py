"""Byte-level BPE by a hierarchical-bitmap rank queue.

Encoding one pre-token: its symbols are a linked list; every adjacent pair that has a merge rank is
filed under that rank's bucket, and two levels of bitmap words mark which buckets hold entries.
Find-first-set on the top word and on the word below gives the lowest rank, whatever the length;
each bucket is a heap of positions, so equal ranks merge from the left. Entries are never removed
when a merge changes a neighbour: an entry whose pair no longer has the bucket's rank is skipped.
The work is O(n log n) for a pre-token of n bytes, so a very long run of letters stays cheap.
"""

from __future__ import annotations

import base64
import hashlib
from heapq import heappop, heappush
from itertools import chain

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Distinct pre-tokens a worker remembers; older ones are forgotten, results don't depend on it.
CACHE_SIZE = 400_000
_LONG_PIECE = 64  # longer pre-tokens are not remembered
#: Ranks per word of the lower bitmap level (Python integers are the words): 2 ** 8.
WORD_SHIFT, WORD_MASK = 8, 255


class RankQueue:
    """Buckets of positions by rank under a two-level bitmap.

    ``top`` marks the words of ``low`` that aren't zero, a word marks the ranks whose bucket holds
    entries. A drained queue is all zero again, so one queue serves every pre-token of a worker.
    """

    def __init__(self, n_ranks: int) -> None:
        self.low = [0] * ((n_ranks >> WORD_SHIFT) + 1)
        self.buckets: list[list[int]] = [[] for _ in range(n_ranks)]


def encode_piece(piece: bytes, ranks: dict[bytes, int], queue: RankQueue) -> list[int]:
    """The ids of one pre-token; its bytes are merged by rank, equal ranks from the left.

    The queue's steps stand in line here, as a call per step would cost more than the step.
    """
    rank_of = ranks.get
    whole = rank_of(piece)
    if whole is not None:
        return [whole]
    low, buckets, top = queue.low, queue.buckets, 0
    n = len(piece)
    end = list(range(1, n + 1))  # where the symbol that starts here ends
    before = list(range(-1, n - 1))  # where the symbol before it starts
    pair_rank: list[int | None] = [rank_of(piece[i:i + 2]) for i in range(n - 1)]
    pair_rank.append(None)
    for i, r in enumerate(pair_rank):
        if r is not None:
            word = r >> WORD_SHIFT
            low[word] |= 1 << (r & WORD_MASK)
            top |= 1 << word
            buckets[r].append(i)  # in ascending order, so each bucket is a heap
    while top:
        word = (top & -top).bit_length() - 1  # find-first-set, twice
        bits = low[word]
        r = word << WORD_SHIFT | (bits & -bits).bit_length() - 1
        bucket = buckets[r]
        i = heappop(bucket)
        if not bucket:
            bits &= bits - 1
            low[word] = bits
            if not bits:
                top &= top - 1
        if pair_rank[i] != r:
            continue  # stale: a merge on either side has changed this pair
        j = end[i]
        k = end[j]
        end[i] = k
        pair_rank[j] = None
        fresh = rank_of(piece[i:end[k]]) if k < n else None
        pair_rank[i] = fresh
        if fresh is not None:
            heappush(buckets[fresh], i)
            word = fresh >> WORD_SHIFT
            low[word] |= 1 << (fresh & WORD_MASK)
            top |= 1 << word
        if k < n:
            before[k] = i
        h = before[i]
        if h >= 0:
            fresh = rank_of(piece[h:k])
            if fresh != pair_rank[h]:
                pair_rank[h] = fresh
                if fresh is not None:
                    heappush(buckets[fresh], h)
                    word = fresh >> WORD_SHIFT
                    low[word] |= 1 << (fresh & WORD_MASK)
                    top |= 1 << word
    out, i = [], 0
    while i < n:
        out.append(ranks[piece[i:end[i]]])
        i = end[i]
    return out


def load_ranks(path: str) -> dict[bytes, int]:
    """A rank file: base64 of the token's bytes, a space, its rank, per line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines) if token}


class Codec:
    """Encoder and decoder of one worker; pre-tokens seen before are remembered (bounded).

    Two generations: when the young one is full it becomes the old one, whose entries return to
    the young one as they are met again.
    """

    def __init__(self, rank_path: str, pattern: str, cache_size: int = CACHE_SIZE):
        self.ranks = load_ranks(rank_path)
        self.queue = RankQueue(max(self.ranks.values()) + 1)
        self.tokens: list[bytes] = [b""] * len(self.queue.buckets)
        for token, i in self.ranks.items():
            self.tokens[i] = token
        self.names = list(map(str, range(len(self.tokens))))
        self.split = regex.compile(pattern).findall
        self.half = cache_size // 2
        self.young: dict[str, tuple[int, ...]] = {}
        self.old: dict[str, tuple[int, ...]] = {}

    def _piece(self, piece: str) -> tuple[int, ...]:
        ids = self.young.get(piece) or self.old.get(piece)
        if ids is None:
            ids = tuple(encode_piece(piece.encode("utf-8", "surrogatepass"), self.ranks, self.queue))
        if len(piece) <= _LONG_PIECE:
            if len(self.young) >= self.half:
                self.old, self.young = self.young, {}
            self.young[piece] = ids
        return ids

    def encode(self, text: str) -> list[int]:
        pieces = self.split(text)
        found = list(map(self.young.get, pieces))
        at = -1
        for _ in range(found.count(None)):
            at = found.index(None, at + 1)
            found[at] = self._piece(pieces[at])
        return list(chain.from_iterable(found))

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids))

    def written(self, ids: list[int]) -> str:
        """The ids in decimal, joined by one space."""
        return " ".join(map(self.names.__getitem__, ids))


_codecs: dict[tuple[str, str, int], Codec] = {}


def codec(rank_path: str, pattern: str, cache_size: int = CACHE_SIZE) -> Codec:
    """The worker's codec for a rank file, loaded once."""
    key = (rank_path, pattern, cache_size)
    if key not in _codecs:
        _codecs[key] = Codec(*key)
    return _codecs[key]


def encode_documents(documents: DataFrame, rank_path: str, pattern: str, id_col: str = "doc_id",
                     text_col: str = "text", digests_only: bool = False,
                     cache_size: int = CACHE_SIZE) -> DataFrame:
    """One row per document row: doc_id, ids (array<int>), n_tokens, ids_sha256, decoded_sha256.

    ``rank_path`` must be readable on every executor (it is part of the installed tokenizer
    package). Null counts as empty text: no ids. The decoded bytes come from the ids alone.
    ``digests_only`` leaves the ids out, for checks that need no tokens. No shuffle, one row at a
    time: memory is bounded by the longest text and ``cache_size`` remembered pre-tokens a worker
    (about 250 bytes each; more of them save CPU time, results don't depend on it).
    """
    def run(batches):
        own = codec(rank_path, pattern, cache_size)
        for batch in batches:
            for i in range(0, batch.num_rows, 256):
                part = batch.slice(i, 256)
                counts, digests, decoded, lists = [], [], [], []
                for text in part.column(1):
                    ids = own.encode(text.as_py() or "")
                    counts.append(len(ids))
                    digests.append(hashlib.sha256(own.written(ids).encode()).hexdigest())
                    decoded.append(hashlib.sha256(own.decode(ids)).hexdigest())
                    if not digests_only:
                        lists.append(ids)
                columns = {"doc_id": part.column(0), "n_tokens": pa.array(counts, pa.int64()),
                           "ids_sha256": pa.array(digests, pa.string()), "decoded_sha256": pa.array(decoded, pa.string())}
                if not digests_only:
                    columns["ids"] = pa.array(lists, pa.list_(pa.int32()))
                yield pa.record_batch(list(columns.values()), list(columns))

    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return documents.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(
        run, schema + ("" if digests_only else ", ids array<int>"))
