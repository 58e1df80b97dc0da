"""Byte-level BPE encoding and decoding with a hierarchical-bitmap rank queue.

A text is cut into pre-tokens by a pattern and each is encoded by itself. Its bytes
form a linked list; every adjacent pair whose bytes are a token waits in the bucket of
that token's rank, which holds list positions. A bitmap of three levels tells which
buckets hold anything: find-first-set on each level gives the lowest rank in constant
time however many pairs wait. A merge only re-files the two pairs beside it; entries
whose pair has changed meanwhile are stale and skipped when they come up. So a
pre-token of n bytes costs O(n log n) at most, also one of millions of bytes.

Tasks keep the ids of words seen, in caches of bounded size. Where no white space comes
before a space, matches never cross the start of a space, so a text is looked up by its
space-separated pieces; other texts are matched as a whole. Both give the same ids.

Defined results: a null or empty text has no ids and decodes to no bytes; every row is
encoded by itself, also repeated ones; no rows give no rows; other columns are ignored,
whatever their names. Special tokens do not exist here: their strings are text. Bytes
that are no token of their own, and ids that are no token, raise ``KeyError``.
"""

from __future__ import annotations

import base64
import re
from array import array
from collections.abc import Iterator
from functools import lru_cache
from heapq import heappop, heappush
from itertools import chain

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import prepare_workers

#: Space-separated pieces and pre-tokens whose ids a task keeps; only memory depends on it.
CACHED_PIECES, CACHED_PRE_TOKENS = 400_000, 500_000
PUNCTUATION = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
ROWS_AT_ONCE = 512
NO_PAIR = 1 << 30
SPACE_AFTER_SPACE = re.compile(r"\s ")


class Codec:
    """Encoding and decoding by a rank file (base64 token and rank a line) and a pattern."""

    def __init__(self, path: str, pattern: str):
        with open(path, "rb") as lines:
            self.ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        self.tokens = {rank: token for token, rank in self.ranks.items()}
        words = (max(self.tokens) >> 6) + 1
        if words > 1 << 12:
            raise ValueError("three levels of 64 bits hold 2**18 ranks")
        self.low, self.mid = [0] * words, [0] * ((words >> 6) + 1)
        self.buckets: dict[int, int | list[int]] = {}
        self.pairs = [self.ranks.get(bytes((a, b)), NO_PAIR) for a in range(256) for b in range(256)]
        self.find = regex.compile(pattern).findall
        self.pre_tokens: dict[str, bytes] = {}
        self.older_pre_tokens: dict[str, bytes] = {}
        codec = self

        words_and_marks = pattern == public_tokenizers.PATTERN

        class Pieces(dict):
            def __missing__(self, piece: str) -> bytes:
                if len(self) >= CACHED_PIECES:
                    self.clear()
                stem = piece.rstrip(PUNCTUATION)
                if words_and_marks and stem.isalpha() and (stem.isascii() or max(stem) < "\u0250"):
                    out = codec.pre_token(" " + stem)  # the pattern's first match; what follows, if anything, is its second
                    if len(stem) < len(piece):
                        out += codec.pre_token(piece[len(stem):])
                else:
                    out = codec.matches(" " + piece)
                self[piece] = out
                return out

        self.pieces = Pieces()

    def merged(self, piece: bytes) -> list[int]:
        """Ids of one pre-token.

        The queue is empty before and after. Bit ``r & 63`` of ``low[r >> 6]`` tells that
        bucket ``r`` holds positions (one, or a heap: the leftmost goes first), ``mid`` and
        ``top`` tell the same of the words below them. Only pairs that would merge before
        the pairs overlapping them are filed; a merge files those it sets free.
        """
        ranks, low, mid, buckets, n = self.ranks, self.low, self.mid, self.buckets, len(piece)
        whole = ranks.get(piece)
        if whole is not None:
            return [whole]
        find, held, pairs = ranks.get, buckets.get, self.pairs
        end = list(range(1, n + 2))  # of the part that starts here
        before = list(range(-1, n))  # start of the part before it; the last list item stands for both ends
        waiting = [pairs[a << 8 | b] for a, b in zip(piece, piece[1:], strict=False)]  # rank of the pair that starts here
        waiting += (NO_PAIR, NO_PAIR)
        before[0] = n
        changed, left, top = [], NO_PAIR, 0
        for i in range(n - 1):
            rank = waiting[i]
            if rank < left and rank <= waiting[i + 1] and rank < NO_PAIR:
                changed.append(i)
            left = rank
        while True:
            for position in changed:
                rank = waiting[position]
                bucket = held(rank)
                if bucket is not None:
                    if type(bucket) is int:
                        buckets[rank] = [bucket, position] if bucket < position else [position, bucket]
                    else:
                        heappush(bucket, position)
                    continue
                buckets[rank] = position
                w = rank >> 6
                low[w] |= 1 << (rank & 63)
                mid[w >> 6] |= 1 << (w & 63)
                top |= 1 << (w >> 6)
            if not top:
                break
            m = (top & -top).bit_length() - 1
            x = mid[m]
            w = m << 6 | (x & -x).bit_length() - 1
            x = low[w]
            rank = w << 6 | (x & -x).bit_length() - 1
            bucket = buckets[rank]
            if type(bucket) is int:
                i, bucket = bucket, None
            else:
                i = heappop(bucket)
            if not bucket:
                del buckets[rank]
                low[w] = x & x - 1  # clears the lowest bit
                if not low[w]:
                    mid[m] &= mid[m] - 1
                    if not mid[m]:
                        top &= top - 1
            changed = []
            if waiting[i] != rank:  # stale
                continue
            j = end[i]
            k = end[i] = end[j]
            h = before[i]
            ahead_was, next_was = waiting[h], waiting[j]
            waiting[j] = NO_PAIR
            if k < n:
                before[k] = i
                after = waiting[i] = find(piece[i:end[k]], NO_PAIR)
            else:
                after = waiting[i] = NO_PAIR
            ahead = NO_PAIR
            if h < n:
                ahead = waiting[h] = find(piece[h:k], NO_PAIR)
                g = before[h]
                first = waiting[g]
                if ahead_was < first <= ahead and first < waiting[before[g]] and first < NO_PAIR:
                    changed.append(g)
                if ahead <= after and ahead < first:
                    changed.append(h)
            if after < ahead and after <= waiting[k]:
                changed.append(i)
            last = waiting[k]
            if next_was <= last < after and last <= waiting[end[k]]:
                changed.append(k)
        ids, i = [], 0
        while i < n:
            ids.append(ranks[piece[i:end[i]]])
            i = end[i]
        return ids

    def pre_token(self, t: str) -> bytes:
        """Ids of one match, four bytes each."""
        ids = self.pre_tokens.get(t)
        if ids is None:
            ids = self.older_pre_tokens.get(t)
            if ids is None:
                ids = array("I", self.merged(t.encode())).tobytes()
            if len(t) < 100:
                if len(self.pre_tokens) >= CACHED_PRE_TOKENS:  # what was used since the last time stays
                    self.older_pre_tokens, self.pre_tokens = self.pre_tokens, {}
                self.pre_tokens[t] = ids
        return ids

    def matches(self, text: str) -> bytes:
        """Ids of all pre-tokens of a text, four bytes each."""
        return b"".join(map(self.pre_token, self.find(text)))

    def encode(self, text: str) -> np.ndarray:
        if SPACE_AFTER_SPACE.search(text):
            packed = self.matches(text)
        else:
            pieces = iter(text.split(" "))
            packed = b"".join(chain((self.matches(next(pieces)),), map(self.pieces.__getitem__, pieces)))
        return np.frombuffer(packed, np.uint32)

    def decode(self, ids: np.ndarray) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids.tolist()))


@lru_cache(maxsize=1)  # a worker's tasks share tables and caches
def codec(path: str, pattern: str) -> Codec:
    return Codec(path, pattern)


def id_lists(ids: list[np.ndarray]) -> pa.ListArray:
    ends = np.cumsum([0, *map(len, ids)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(ids).astype(np.int32)))


def encode(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, ids (array of int)."""
    prepare_workers(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(path, pattern)
        for whole in batches:
            for i in range(0, whole.num_rows, ROWS_AT_ONCE):
                b = whole.slice(i, ROWS_AT_ONCE)
                yield pa.RecordBatch.from_arrays([b.column(0), id_lists([c.encode(t.as_py() or "") for t in b.column(1)])], ["doc_id", "ids"])

    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, ids array<int>")


def round_trip(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, ids, decoded: ``encode`` and ``decode`` of its ids in one pass of one worker."""
    prepare_workers(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(path, pattern)
        for whole in batches:
            for i in range(0, whole.num_rows, ROWS_AT_ONCE):
                b = whole.slice(i, ROWS_AT_ONCE)
                ids = [c.encode(t.as_py() or "") for t in b.column(1)]
                yield pa.RecordBatch.from_arrays([b.column(0), id_lists(ids), pa.array(map(c.decode, ids), pa.binary())], ["doc_id", "ids", "decoded"])

    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, ids array<int>, decoded binary")


def decode(tokens: DataFrame, path: str, pattern: str, ids_col: str = "ids") -> DataFrame:
    """``tokens`` (doc_id, ids, ...) as doc_id, ids, decoded (bytes; null ids: none)."""
    prepare_workers(tokens.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(path, pattern)
        for whole in batches:
            for i in range(0, whole.num_rows, ROWS_AT_ONCE):
                b = whole.slice(i, ROWS_AT_ONCE)
                decoded = [c.decode(x.values.to_numpy()) if x.is_valid else b"" for x in b.column(1)]
                yield pa.RecordBatch.from_arrays([*b.columns, pa.array(decoded, pa.binary())], ["doc_id", "ids", "decoded"])

    rows = tokens.select("doc_id", F.col(f"`{ids_col}`").cast("array<int>").alias("ids"))
    return rows.mapInArrow(run, "doc_id long, ids array<int>, decoded binary")
