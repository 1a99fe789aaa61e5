"""Byte-level BPE with a queue of merge ranks under a hierarchical bitmap.

A pre-token's bytes form a linked list. Every neighbouring pair that merges waits in the
bucket of its rank; a bitmap of three or more levels of 64 bits shows which buckets hold
anything, so the lowest rank is found with one find-first-set a level, however long the
pre-token. A bucket gives its leftmost place first. Entries whose pair has changed since
are skipped when they come up. A pre-token of n bytes takes O(n log n) steps.

Defined results: a null text is encoded like an empty one, to no ids, and decodes to no
bytes. Repeated rows give equal results; ids may be null. Extra columns are kept.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from functools import lru_cache
from heapq import heappop, heappush

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType, StringType, StructField, StructType

from eventmart.llm.byte_bpe import vocabulary_path
from eventmart.llm.pretokens import BYTES_AT_ONCE, TextEncoder
from eventmart.llm.runtime import prepare, text_bounds

RANKS = "byte_bpe_multi_50k.tiktoken"
_BITS, _MASK = 6, 63
_MARKS = [1 << i for i in range(_MASK + 1)]


class RankQueue:
    """Places by rank; ``pop`` gives the leftmost place of the lowest rank."""

    def __init__(self, n_ranks: int):
        self._levels = []
        size = max(1, n_ranks)
        while True:
            size = (size + _MASK) >> _BITS
            self._levels.append([0] * size)
            if size == 1:
                break
        self._downwards = self._levels[::-1]
        # The place where a bucket holds one, as most do, else a heap of them.
        self._buckets: dict[int, int | list[int]] = {}

    def push(self, rank: int, place: int) -> None:
        buckets = self._buckets
        if rank in buckets:
            held = buckets[rank]
            if type(held) is list:
                heappush(held, place)
            else:
                buckets[rank] = [held, place] if held < place else [place, held]
            return
        buckets[rank] = place
        at = rank
        for level in self._levels:
            word = at >> _BITS
            before = level[word]
            level[word] = before | _MARKS[at & _MASK]
            if before:
                break
            at = word

    def pop(self) -> tuple[int, int] | None:
        """Rank and place, or None when nothing waits."""
        buckets = self._buckets
        if not buckets:
            return None
        at = 0
        for level in self._downwards:
            word = level[at]
            at = at << _BITS | (word & -word).bit_length() - 1
        held = buckets[at]
        if type(held) is list:
            place = heappop(held)
            if len(held) == 1:
                buckets[at] = held[0]
            return at, place
        del buckets[at]
        cleared = at
        for level in self._levels:
            word = cleared >> _BITS
            level[word] = left = level[word] ^ _MARKS[cleared & _MASK]
            if left:
                break
            cleared = word
        return at, held


class Vocabulary:
    """Merge ranks of byte strings, which are the ids too."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.n_ids = max(ranks.values(), default=-1) + 1
        self.tokens = [b""] * self.n_ids
        for token, rank in ranks.items():
            self.tokens[rank] = token
        self._queue = RankQueue(self.n_ids)
        self.text_encoder = TextEncoder(lambda pretoken: self.encode_bytes(pretoken.encode("utf-8")))

    def encode_bytes(self, data: bytes) -> list[int]:
        """Ids of one pre-token."""
        ranks = self.ranks
        whole = ranks.get(data)
        if whole is not None:
            return [whole]
        n = len(data)
        if n < 2:
            return [ranks[data]] if n else []
        push, pop, known = self._queue.push, self._queue.pop, ranks.get
        end = list(range(1, n + 1))  # where the part that begins here ends, which is where the next begins
        before = list(range(-1, n - 1))
        waiting = [known(data[i : i + 2], -1) for i in range(n)]  # rank of the pair that begins here, -1 if none merges
        waiting[-1] = -1
        for i, rank in enumerate(waiting):
            if rank >= 0:
                push(rank, i)
        while (lowest := pop()) is not None:
            rank, i = lowest
            if waiting[i] != rank:
                continue  # stale
            middle = end[i]
            stop = end[i] = end[middle]
            waiting[middle] = -1
            if stop < n:
                before[stop] = i
                waiting[i] = pair = known(data[i : end[stop]], -1)
                if pair >= 0:
                    push(pair, i)
            else:
                waiting[i] = -1
            left = before[i]
            if left >= 0:
                waiting[left] = pair = known(data[left:stop], -1)
                if pair >= 0:
                    push(pair, left)
        ids, at = [], 0
        while at < n:
            ids.append(ranks[data[at : end[at]]])
            at = end[at]
        return ids

    def encode(self, text: str | None) -> bytes:
        """Ids of a text as little-endian unsigned 32-bit numbers."""
        return self.text_encoder.encode(text)

    def encode_all(self, texts: pd.Series) -> Iterator[bytes]:
        """Ids of every text, some megabytes of texts at a time."""
        whole = pa.array(texts, pa.large_string(), from_pandas=True)
        bounds = text_bounds(whole, BYTES_AT_ONCE)
        for start, stop in zip(bounds, bounds[1:]):
            yield from self.text_encoder.encode_all(whole.slice(start, stop - start))

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.tokens.__getitem__, np.frombuffer(ids, dtype="<u4").tolist()))


def load(path: str) -> dict[bytes, int]:
    """Ranks from a file of lines: token in base64, rank."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}


@lru_cache(maxsize=2)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(load(path))


ENCODED = StructType([StructField("n_tokens", LongType()), StructField("ids_sha256", StringType()), StructField("decoded_sha256", StringType())])


@F.pandas_udf(BinaryType())
def _encode(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    words = vocabulary(vocabulary_path(RANKS))
    for texts in batches:
        yield pd.Series(list(words.encode_all(texts)), dtype=object)


@F.pandas_udf(BinaryType())
def _decode(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    words = vocabulary(vocabulary_path(RANKS))
    for ids in batches:
        yield pd.Series([None if x is None else words.decode(x) for x in ids], dtype=object)


@F.pandas_udf(ENCODED)
def _round_trip(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
    words = vocabulary(vocabulary_path(RANKS))
    for texts in batches:
        rows = []
        for ids in words.encode_all(texts):
            rows.append((len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(words.decode(ids)).hexdigest()))
        yield pd.DataFrame(rows, columns=ENCODED.names)


def encode(frame: DataFrame, text: str, into: str) -> DataFrame:
    """``frame`` with the ids of every text (32-bit little-endian) in a binary column."""
    prepare(frame.sparkSession)
    return frame.withColumn(into, _encode(F.col(text)))


def decode(frame: DataFrame, ids: str, into: str) -> DataFrame:
    """``frame`` with the bytes that the ids stand for; null ids stay null."""
    prepare(frame.sparkSession)
    return frame.withColumn(into, _decode(F.col(ids)))


def digests(frame: DataFrame, text: str, into: str) -> DataFrame:
    """``frame`` with a struct of token count and digests of ids and of the decoded bytes.

    Ids need not leave the worker for that.
    """
    prepare(frame.sparkSession)
    return frame.withColumn(into, _round_trip.asNondeterministic()(F.col(text)))
