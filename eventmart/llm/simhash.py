"""Near duplicates by 64-bit SimHash, candidates cut down by the pigeonring principle.

Fingerprints are cut into five segments on a ring. If two fingerprints differ in at
most four bits, some segment starts a chain along the ring whose first k segments
together differ in at most 4k/5 bits, for every k: none in the first, one at most in the
first two, two in three, three in four. Pairs meet by a hash join on the first two
segments (one side in all forms that differ in one bit of the second), the longer
chains are checked next, the full distance last. No bucket is cut short: where very
many fingerprints share two segments, the bucket is compared in blocks that return
one link to the smallest member per fingerprint and group instead of all pairs.

Equal fingerprints are one node from the start, so copies never meet as pairs.

Defined results: null and empty texts, and texts of white space, have fingerprint zero
and are linked like any other. Fewer than four words make one shingle. A group's
``component_id`` is its smallest id; null ids count only where a group has no other, and
such a group's id is null. Repeated rows fall in one group. Extra columns are kept.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from eventmart.llm.components import components
from eventmart.llm.runtime import materialise, own_columns, prepare, run_bounds, runs

SEED, SHINGLE, DISTANCE = 42, 4, 4
# Width and offset of the segments, and of a bucket that is compared in blocks.
SEGMENTS = [(13, 0), (13, 13), (13, 26), (13, 39), (12, 52)]
CROWDED = 1_024
BLOCK = 1_024
HASHES_AT_ONCE = 1 << 16


def fingerprint(data: bytes | None) -> int:
    """SimHash of the word shingles of a UTF-8 text, repeats included, as a signed number."""
    words = (data or b"").lower().split()  # both touch ASCII only
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = [0, *(ends[:-1] + 1).tolist()]
    ends = ends.tolist()[SHINGLE - 1 :] or [len(joined)]
    digest, total, above = xxhash.xxh64_intdigest, len(ends), np.zeros(64, dtype=np.int64)
    for i in range(0, total, HASHES_AT_ONCE):
        hashes = np.array(
            [digest(joined[a:b], SEED) for a, b in zip(starts[i : i + HASHES_AT_ONCE], ends[i : i + HASHES_AT_ONCE])],
            dtype=">u8",
        )
        above += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * above > total).view(">i8")[0])


@F.pandas_udf(LongType())
def _fingerprints(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for texts in batches:
        yield pd.Series([fingerprint(x.encode("utf-8") if x else None) for x in texts], dtype="int64")


def with_fingerprint(frame: DataFrame, text: str, into: str) -> DataFrame:
    prepare(frame.sparkSession)
    return frame.withColumn(into, F.coalesce(_fingerprints.asNondeterministic()(F.col(text)), F.lit(0)))


def _segment(fp: Column, at: int) -> Column:
    width, offset = SEGMENTS[at % len(SEGMENTS)]
    return F.shiftrightunsigned(fp, offset).bitwiseAND(F.lit((1 << width) - 1))


def _ring_mask(start: int, length: int) -> int:
    mask = 0
    for at in range(start, start + length):
        width, offset = SEGMENTS[at % len(SEGMENTS)]
        mask |= ((1 << width) - 1) << offset
    return mask - (1 << 64) if mask >> 63 else mask


def _buckets(fp: Column) -> Column:
    """For each start on the ring: two segments and the start, in one number."""
    return F.array(
        *(
            F.shiftleft(F.shiftleft(_segment(fp, i), 13).bitwiseOR(_segment(fp, i + 1)), 3).bitwiseOR(F.lit(i))
            for i in range(len(SEGMENTS))
        )
    )


def _chain_holds(a: Column, b: Column, start: Column) -> Column:
    """Whether chains of three, four and all segments from ``start`` keep their budgets."""
    differing = a.bitwiseXOR(b)
    rings = len(SEGMENTS)
    kept = F.bit_count(differing) <= DISTANCE
    for length in range(rings - 1, 2, -1):
        masks = F.array(*(F.lit(_ring_mask(i, length)).cast("long") for i in range(rings)))
        part = differing.bitwiseAND(F.get(masks, start))
        kept = (F.bit_count(part) <= length * DISTANCE // rings) & kept
    return kept


def _crowded_links(probes: DataFrame, index: DataFrame, crowded: DataFrame) -> DataFrame:
    """Links within crowded buckets, from blocks of bounded size."""
    sizes = (
        probes.join(crowded.select("bucket"), "bucket", "left_semi").groupBy("bucket").agg(F.count("*").alias("n_probes"))
    ).join(crowded, "bucket")
    # Written, so that its size is known: estimated, both sides below seem the smaller ones and would be broadcast.
    blocks = materialise(
        sizes.select(
            "bucket",
            F.ceil(F.col("n_probes") / BLOCK).cast("int").alias("rows"),
            F.ceil(F.col("n_index") / BLOCK).cast("int").alias("columns"),
        ),
        "blocks",
    )

    def dealt(side: DataFrame, fp: str, own: str, across: str, first: bool) -> DataFrame:
        mine = F.pmod(F.xxhash64(F.col(fp)), F.col(own)).cast("int")
        cells = side.join(blocks, "bucket").select(
            "bucket", F.col(fp).alias("fp"), mine.alias("mine"), F.explode(F.sequence(F.lit(0), F.col(across) - 1)).alias("other")
        )
        place = ("mine", "other") if first else ("other", "mine")
        return cells.select(F.xxhash64("bucket", *place).alias("cell"), "fp", F.lit(first).alias("probe"))

    cells = dealt(probes, "a", "rows", "columns", True).unionByName(dealt(index, "b", "columns", "rows", False))

    def linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in runs(batches, "cell"):
            cell = table.column("cell").to_numpy()
            fps = table.column("fp").to_numpy()
            probe = table.column("probe").to_numpy()
            bounds = run_bounds(cell)
            for start, end in zip(bounds[:-1], bounds[1:]):
                nodes, roots = block_links(fps[start:end][probe[start:end]], fps[start:end][~probe[start:end]])
                yield pa.RecordBatch.from_pydict({"a": pa.array(nodes, pa.int64()), "b": pa.array(roots, pa.int64())})

    return cells.repartition("cell").sortWithinPartitions("cell").mapInArrow(linked, "a long, b long")


def block_links(rows: np.ndarray, columns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each fingerprint of a block that has a link, with the smallest one it reaches in the block."""
    near = np.bitwise_count(rows.view(np.uint64)[:, None] ^ columns.view(np.uint64)[None, :]) <= DISTANCE
    top = np.iinfo(np.int64).max
    row_root, column_root = rows.copy(), columns.copy()
    while near.size:
        new_rows = np.minimum(row_root, np.where(near, column_root[None, :], top).min(axis=1))
        new_columns = np.minimum(column_root, np.where(near, new_rows[:, None], top).min(axis=0))
        if (new_rows == row_root).all() and (new_columns == column_root).all():
            break
        row_root, column_root = new_rows, new_columns
    nodes, roots = np.concatenate([rows, columns]), np.concatenate([row_root, column_root])
    moved = nodes != roots
    return nodes[moved], roots[moved]


def near_links(fingerprints: DataFrame, column: str) -> DataFrame:
    """Links ``a``, ``b`` whose components are those of all pairs within the distance.

    ``fingerprints`` must be distinct. Outside crowded buckets every such pair is returned.
    """
    fp = F.col(column)
    index = fingerprints.select(F.explode(_buckets(fp)).alias("bucket"), fp.alias("b"))
    flips = F.array(F.lit(0).cast("long"), *(F.lit(1 << (3 + bit)).cast("long") for bit in range(13)))
    probes = (
        fingerprints.select(F.explode(_buckets(fp)).alias("_bucket"), fp.alias("a"))
        .select("a", "_bucket", F.explode(flips).alias("_flip"))
        .select("a", F.col("_bucket").bitwiseXOR(F.col("_flip")).alias("bucket"))
    )
    crowded = materialise(
        index.groupBy("bucket").agg(F.count("*").alias("n_index")).where(F.col("n_index") > CROWDED), "crowded"
    )
    further = None
    if not crowded.isEmpty():
        further = _crowded_links(probes, index, crowded)
        index = index.join(crowded.select("bucket"), "bucket", "left_anti")
    # Spark does not count what explode adds: it takes 70 rows a fingerprint for one and would broadcast them.
    links = (
        probes.hint("merge")
        .join(index, "bucket")
        .where((F.col("a") < F.col("b")) & _chain_holds(F.col("a"), F.col("b"), F.col("bucket").bitwiseAND(F.lit(7)).cast("int")))
        .select("a", "b")
    )
    return links if further is None else links.unionByName(further)


def _classes(fingerprinted: DataFrame, key: str, column: str) -> DataFrame:
    """Every fingerprint (``fp``) with its smallest id (``first``) and its group's root."""
    classes = materialise(
        fingerprinted.groupBy(F.col(column).alias("fp")).agg(F.min(key).alias("first")), "simhash-classes"
    )
    roots = components(near_links(classes, "fp"), "a", "b")
    return materialise(
        classes.join(roots, F.col("fp") == F.col("node"), "left").select(
            "fp", "first", F.coalesce("root", "fp").alias("root"), F.col("root").isNotNull().alias("linked")
        ),
        "simhash-groups",
    )


def group(fingerprinted: DataFrame, key: str, column: str, into: str) -> DataFrame:
    """``fingerprinted`` (written, or cheap to read again) with its group's smallest id."""
    fp, group_id = own_columns(fingerprinted.withColumnRenamed(key, into), "_fp", "_group_id")
    classes = _classes(fingerprinted, key, column)
    linked = classes.where("linked")
    smallest = linked.groupBy("root").agg(F.min("first").alias("least"))
    found = (
        linked.join(smallest, "root")
        .select("fp", "least")
        .unionByName(classes.where("not linked").select("fp", F.col("first").alias("least")))
        .select(F.col("fp").alias(fp), F.col("least").alias(group_id))
    )
    return fingerprinted.join(found, F.col(column) == F.col(fp)).drop(fp).withColumnRenamed(group_id, into)


def deduplicate(frame: DataFrame, key: str, text: str) -> DataFrame:
    """The row with the smallest id of every group, once; columns as they came.

    Null ids come last. The input is written once with its fingerprints, so that texts
    are hashed once.
    """
    fp, place, mine, my_fp = own_columns(frame, "_fingerprint", "_place", "_key", "_fp")
    marked = materialise(with_fingerprint(frame, text, fp), "simhash")
    best = F.min(F.struct(F.col("first").isNull(), F.col("first"), F.col("fp"))).alias("best")
    kept = (
        _classes(marked.select(key, fp), key, fp)
        .groupBy("root")
        .agg(best)
        .select(F.col("best.first").alias(mine), F.col("best.fp").alias(my_fp))
    )
    rows = marked.join(kept, F.col(key).eqNullSafe(F.col(mine)) & (F.col(fp) == F.col(my_fp)), "left_semi")
    if marked.groupBy(key, fp).agg(F.count("*").alias(place)).where(F.col(place) > 1).isEmpty():
        return rows.drop(fp)
    # Of rows that repeat an id and a fingerprint, one stays.
    order = Window.partitionBy(key, fp).orderBy(text)
    return rows.withColumn(place, F.row_number().over(order)).where(F.col(place) == 1).drop(place, fp)
