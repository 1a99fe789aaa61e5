"""Packing token sequences by exact complements, then best fit.

Pieces of equal length are alike, so the plan is made on the table of lengths, which
has at most as many rows as a sequence has tokens, however many documents there are.
From the longest length down, a sequence's gap is filled exactly by one, two or three
lengths still available (found in indexes of single, pair and triple sums); if none
fill it, the longest length that fits goes in and the smaller gap is tried again.
One pattern is used as often as its scarcest length allows. The pieces then take the
places of their length by their rank, which Spark counts in buckets of bounded size.

Defined results: a null or empty text is its end token alone. Equal and repeated rows
are packed as pieces of their own. A null id is kept and packed like any other. An
empty table gives an empty result. Extra columns of the input don't enter the result.
"""

from __future__ import annotations

import zlib
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from eventmart.llm.byte_bpe import document_encoder, vocabulary_path
from eventmart.llm.runtime import materialise, prepare, slices

CAPACITY, END = 1_024, 2
PIECES_PER_BUCKET = 20_000

PIECE = "piece int, start long, length long, ids_crc32 long"


def cut(ids: bytes, capacity: int) -> Iterator[tuple[int, int, int, int]]:
    """Pieces (number, start, length, crc32) of one document's 32-bit ids; a short one comes first."""
    total = len(ids) // 4
    end = total % capacity or min(total, capacity)
    start = piece = 0
    while start < total:
        yield piece, start, end - start, zlib.crc32(ids[4 * start : 4 * end])
        piece, start, end = piece + 1, end, end + capacity


def pieces(frame: DataFrame, key: str, text: str, capacity: int = CAPACITY, end_id: int = END) -> DataFrame:
    """Every document's pieces, encoded with the end token."""
    prepare(frame.sparkSession)
    tail = int(end_id).to_bytes(4, "little")

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = document_encoder(vocabulary_path())
        for batch in slices(batches):
            rows = []
            for at, ids in enumerate(encoder.encode_all(batch.column(1))):
                rows += [(at, *piece) for piece in cut(ids + tail, capacity)]
            columns = list(zip(*rows)) if rows else [()] * 5
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(columns[0], pa.int64())),
                    pa.array(columns[1], pa.int32()),
                    *(pa.array(c, pa.int64()) for c in columns[2:]),
                ],
                names=["key", "piece", "start", "length", "ids_crc32"],
            )

    kind = dict(frame.dtypes)[key]
    return frame.select(F.col(key).alias("key"), F.col(text).alias("text")).mapInArrow(encoded, f"key {kind}, {PIECE}")


class _Lengths:
    """How many pieces of each length are left, with indexes of what sums they can make."""

    def __init__(self, counts: dict[int, int], capacity: int):
        self.left = np.zeros(capacity + 1, dtype=np.int64)
        for length, n in counts.items():
            self.left[length] = n
        self._pairs: np.ndarray | None = None

    def take(self, length: int, n: int) -> None:
        self.left[length] -= n
        if not self.left[length]:
            self._pairs = None

    def _pair_sums(self) -> np.ndarray:
        """Which sums two lengths can make; how many are left is seen to afterwards."""
        if self._pairs is None:
            there = np.flatnonzero(self.left)
            self._pairs = np.zeros(len(self.left), dtype=bool)
            for a in there:
                sums = a + there
                self._pairs[sums[sums < len(self.left)]] = True
        return self._pairs

    def _pair(self, total: int, left: np.ndarray, most: int) -> list[int] | None:
        larger = np.arange(min(most, total - 1), (total - 1) // 2, -1)
        smaller = total - larger
        fits = (left[larger] > 0) & (left[smaller] > 0) & ((larger != smaller) | (left[larger] > 1))
        at = np.flatnonzero(fits)
        return [int(larger[at[0]]), int(smaller[at[0]])] if len(at) else None

    def exact(self, gap: int, used: Counter) -> list[int] | None:
        """One, two or three lengths that fill ``gap``, the longest first; ``used`` are spoken for."""
        left = self.left.copy()
        for length, n in used.items():
            left[length] -= n
        if left[gap] > 0:
            return [gap]
        if self._pair_sums()[gap] and (pair := self._pair(gap, left, gap)):
            return pair
        first = np.arange(gap - 2, (gap + 2) // 3 - 1, -1)
        first = first[first > 0]
        for a in first[(left[first] > 0) & self._pair_sums()[gap - first]]:
            left[a] -= 1
            rest = self._pair(gap - int(a), left, int(a))
            left[a] += 1
            if rest:
                return [int(a), *rest]
        return None

    def longest(self, gap: int, used: Counter) -> int | None:
        for length in np.flatnonzero(self.left[: gap + 1])[::-1]:
            if self.left[length] > used[int(length)]:
                return int(length)
        return None


def patterns(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[list[int], int]]:
    """Which lengths share a sequence, and how many sequences are filled that way."""
    lengths = _Lengths(counts, capacity)
    found = []
    for longest in sorted(counts, reverse=True):
        while lengths.left[longest]:
            pattern, gap, used = [longest], capacity - longest, Counter([longest])
            while gap:
                more = lengths.exact(gap, used)
                if not more:
                    best = lengths.longest(gap, used)
                    if best is None:
                        break
                    more = [best]
                pattern += more
                used.update(more)
                gap -= sum(more)
            times = min(int(lengths.left[length]) // n for length, n in used.items())
            for length, n in used.items():
                lengths.take(length, n * times)
            found.append((pattern, times))
    return found


def places(counts: dict[int, int], capacity: int = CAPACITY) -> dict[int, tuple[list[int], list[int], list[int]]]:
    """For each length, runs of ranks: where a run begins, its first sequence, its offset."""
    runs: dict[int, tuple[list[int], list[int], list[int]]] = {}
    taken: Counter = Counter()
    sequence = 0
    for pattern, times in patterns(counts, capacity):
        offset = 0
        for length in pattern:
            ranks, sequences, offsets = runs.setdefault(length, ([], [], []))
            ranks.append(taken[length])
            sequences.append(sequence)
            offsets.append(offset)
            taken[length] += times
            offset += length
        sequence += times
    return runs


def _ranked(found: DataFrame) -> DataFrame:
    """Each piece's rank among those of its length, from 0, without gathering a length anywhere."""
    buckets = max(1, -(-found.count() // PIECES_PER_BUCKET))
    dealt = found.withColumn("bucket", F.pmod(F.xxhash64("key", "piece"), F.lit(buckets)))
    before = Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    bases = (
        dealt.groupBy("length", "bucket")
        .agg(F.count("*").alias("n"))
        .select("length", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    )
    inside = Window.partitionBy("length", "bucket").orderBy("key", "piece")
    return (
        dealt.withColumn("place", F.row_number().over(inside))
        .join(bases, ["length", "bucket"])
        .withColumn("rank", F.col("base") + F.col("place") - 1)
        .drop("bucket", "base", "place")
    )


def pack(frame: DataFrame, key: str, text: str, capacity: int = CAPACITY, end_id: int = END) -> DataFrame:
    """``key``, piece columns, ``sequence_id`` and ``offset`` of every piece of every document."""
    spark = frame.sparkSession
    found = materialise(pieces(frame, key, text, capacity, end_id), "pieces")
    counts = {row["length"]: row["n"] for row in found.groupBy("length").agg(F.count("*").alias("n")).collect()}
    shared = spark.sparkContext.broadcast(places(counts, capacity))  # as large as the table of lengths allows

    @F.pandas_udf(StructType([StructField("sequence_id", LongType()), StructField("offset", LongType())]))
    def placed(lengths: pd.Series, ranks: pd.Series) -> pd.DataFrame:
        rows = []
        for length, rank in zip(lengths, ranks):
            begins, sequences, offsets = shared.value[length]
            at = bisect_right(begins, rank) - 1
            rows.append((sequences[at] + rank - begins[at], offsets[at]))
        return pd.DataFrame(rows, columns=["sequence_id", "offset"])

    return (
        _ranked(found)
        .withColumn("at", placed.asNondeterministic()("length", "rank"))
        .select(F.col("key").alias(key), "piece", "start", "length", "ids_crc32", "at.sequence_id", "at.offset")
    )
