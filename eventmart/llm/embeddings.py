"""Near duplicates of embeddings by sorted projection passes, dense parts in bounded blocks.

Each pass hashes a vector to the signs of its projections on random directions of its own and
orders the vectors lexicographically by the concatenated signs. A vector is compared with the
neighbours that follow it, a window of ``WINDOW`` at most that reaches to the end of the vectors
that begin with the same signs, and some further. A pair at the threshold is missed only if no
pass gives both the same first signs; the number of passes follows from how many signs those
are and keeps that chance below ``MISS``. Verified pairs are united across passes.

A pass moves vectors rounded to 16 bits a component, whose cosines are wrong by a known bound at most. A
pair whose cosine is that close to the threshold is compared again in double precision.

The first signs are as many as spread the vectors evenly over runs of ``SPREAD``. Where the
data is denser, nothing is cut by the window: a vector that any pass puts into a run of more than
``CROWDED`` is compared with all other such vectors by further passes. Their prefix is the
one that costs least by a sample of the dense vectors' own angles (none at all means that
all of them are compared), and their runs are compared whole, in blocks of bounded size. A pair
of which one vector was never crowded has met in the first passes.

Every link lies inside a component. Links are counted there, all vectors of a component
against all, in blocks of bounded size that return counts and no pairs; so the search
cuts no count short. Equal vectors are one node from the start.

Defined results: vectors that are null, empty or zero, or hold null or non-finite
components, link with nothing and are their own component. Vectors of unequal lengths
never link. Null ids count as the largest; a component of null ids alone has a null id.
Repeated rows are equal vectors and link. Extra columns of the input are not returned.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventmart.llm.components import components
from eventmart.llm.runtime import materialise, prepare, run_bounds, runs

THRESHOLD = 0.95
# Vectors a run of equal first signs would hold if they were spread evenly, and from where on it
# counts as dense. A window takes in the whole of any other run, and so many neighbours at least.
SPREAD = 256
CROWDED = WINDOW = 1_024
LEAST_WINDOW = 64
# What a component is rounded to: 16 bits.
STEPS = 32_767
MISS = 1e-4
KEY_BITS = 64
PASSES_AT_ONCE = 6
BLOCK = 512
# Vectors a block of a dense bucket holds, those sampled to choose the prefix of dense
# passes, and the comparisons that cost as much as moving a vector once.
DENSE_BLOCK = 4_096
SAMPLE = 1_024
MOVE = 2_048


def prefix_signs(vectors: int) -> int:
    """Signs that spread the vectors over buckets of ``SPREAD``, if they lie evenly."""
    return max(1, math.ceil(math.log2(max(2, vectors / SPREAD))))


def passes_needed(signs: int, threshold: float = THRESHOLD) -> int:
    """Passes after which a pair at the threshold was missed with a chance below ``MISS``.

    Two vectors at an angle share a sign with the chance 1 - angle / pi, and meet in a
    pass if they share all signs of the prefix.
    """
    meet = (1 - math.acos(max(-1.0, min(1.0, threshold))) / math.pi) ** signs
    if meet >= 1:
        return 1
    return math.ceil(math.log(MISS) / math.log1p(-meet)) if meet > 0 else 1 << 62


def dense_signs(units: list[np.ndarray], vectors: int, threshold: float = THRESHOLD) -> int:
    """The prefix with which passes over ``vectors`` like the sampled ones cost least."""
    sizes = np.array([len(u) for u in units])
    shared = []  # the chance to share a sign, of pairs of equal lengths; others never meet
    for size in np.unique(sizes):
        matrix = np.array([u for u in units if len(u) == size])
        upper = np.triu_indices(len(matrix), 1)
        shared.append(1 - np.arccos(np.clip(matrix @ matrix.T, -1, 1)[upper]) / math.pi)
    shared = np.concatenate(shared)
    pairs = max(1, len(units) * (len(units) - 1) // 2)

    def cost(signs: int) -> float:
        met = vectors * (shared**signs).sum() / pairs
        return passes_needed(signs, threshold) * (met + MOVE)

    return min(range(KEY_BITS + 1), key=cost)


def directions(number: int, dimensions: int) -> np.ndarray:
    return np.random.default_rng([number, dimensions]).standard_normal((dimensions, KEY_BITS))


def _unit(values) -> np.ndarray | None:
    """Direction of a vector in double precision, None if it has none."""
    if values is None or not len(values) or None in values:
        return None
    vector = np.array(values, dtype=np.float64)
    largest = np.abs(vector).max() if np.isfinite(vector).all() else 0.0
    if not largest > 0:
        return None
    vector = vector / largest
    return vector / np.sqrt((vector**2).sum())


def _prepared(frame: DataFrame, key: str, vector: str) -> DataFrame:
    """``id``, ``node`` (digest of the direction) and ``unit`` (doubles as bytes), null where invalid."""

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            units = [_unit(x) for x in batch.column(1).to_pylist()]
            data = [None if u is None else u.astype("<f8").tobytes() for u in units]
            nodes = [None if d is None else hashlib.blake2b(d, digest_size=16).digest() for d in data]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(nodes, pa.binary()), pa.array(data, pa.binary())], names=["id", "node", "unit"]
            )

    kind = dict(frame.dtypes)[key]
    return frame.select(F.col(key), F.col(vector)).mapInArrow(made, f"id {kind}, node binary, unit binary")


def _matrix(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype="<f8").reshape(len(column), -1)


def _bytes_of(rows: np.ndarray) -> pa.Array:
    """Each row's bytes."""
    rows = np.ascontiguousarray(rows)
    kind = pa.binary(rows.itemsize * rows.shape[1])
    return pa.FixedSizeBinaryArray.from_buffers(kind, len(rows), [None, pa.py_buffer(rows)]).cast(pa.binary())


def _run_keys(number: int, size: int, prefix: np.ndarray) -> pa.Array:
    """The run of each vector: pass, length of the vector, first signs."""
    head = np.frombuffer(number.to_bytes(4, "big") + size.to_bytes(4, "big"), dtype=np.uint8)
    return _bytes_of(np.hstack([np.broadcast_to(head, (len(prefix), 8)), prefix]))


def _keyed(nodes: DataFrame, numbers: range, signs: int, units: bool = True) -> DataFrame:
    """Every vector once a pass with its run: pass, length of the vector, first signs."""
    names = ["bucket", "node", "unit"] if units else ["bucket", "node"]

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = np.array([len(x) for x in batch.column("unit").to_pylist()])
            for size in np.unique(sizes):
                part = batch.take(pa.array(np.flatnonzero(sizes == size)))
                matrix = _matrix(part.column("unit"))
                for number in numbers:
                    prefix = np.packbits(matrix @ directions(number, matrix.shape[1])[:, :signs] > 0, axis=1)
                    columns = [_run_keys(number, int(size), prefix), part.column("node"), part.column("unit")]
                    yield pa.RecordBatch.from_arrays(columns[: len(names)], names=names)

    schema = ", ".join(f"{name} binary" for name in names)
    return nodes.select("node", "unit").mapInArrow(hashed, schema)


def star_links(nodes: list[bytes], near: np.ndarray) -> list[tuple[bytes, bytes]]:
    """Links whose components are those of the square ``near``: each node with the first of its own."""
    links = []
    left = near.any(axis=1)
    for first in np.flatnonzero(left):
        if not left[first]:
            continue
        left[first] = False
        reached = np.array([first])
        while len(reached):
            reached = np.flatnonzero(near[reached].any(axis=0) & left)
            left[reached] = False
            links += [(nodes[first], nodes[i]) for i in reached]
    return links


def _near(units: np.ndarray, across: int, threshold: float) -> np.ndarray:
    """Which vectors are linked; with ``across``, only those before that place with those after."""
    near = np.zeros((len(units),) * 2, dtype=bool)
    for start in range(0, across or len(units), BLOCK):
        rows = slice(start, min(start + BLOCK, across or len(units)))
        near[rows, across:] = units[rows] @ units[across:].T >= threshold
    if across:
        near[across:, :across] = near[:across, across:].T
    else:
        near |= near.T
        np.fill_diagonal(near, False)
    return near


def _linked(cells: DataFrame, threshold: float) -> DataFrame:
    """Links ``a``, ``b`` inside each ``cell`` (binary), or across its two halves (``block``)."""

    def linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in runs(batches, "cell"):
            bounds = run_bounds(table.column("cell").to_numpy())
            blocks = table.column("block").to_numpy()
            nodes, units = table.column("node").to_pylist(), table.column("unit").to_pylist()
            found = []
            for start, end in zip(bounds[:-1], bounds[1:]):
                if end - start < 2:
                    continue
                across = np.flatnonzero(blocks[start:end] != blocks[start])
                matrix = np.frombuffer(b"".join(units[start:end]), dtype="<f8").reshape(end - start, -1)
                found += star_links(nodes[start:end], _near(matrix, int(across[0]) if len(across) else 0, threshold))
            yield pa.RecordBatch.from_pydict(
                {"a": pa.array([a for a, _ in found], pa.binary()), "b": pa.array([b for _, b in found], pa.binary())}
            )

    dealt = cells.repartition("cell").sortWithinPartitions("cell", "block")
    return dealt.select("cell", "block", "node", "unit").mapInArrow(linked, "a binary, b binary").distinct()


def _above(keyed: DataFrame, bound: int) -> DataFrame:
    """The buckets that hold more than ``bound`` vectors, with their number."""
    sizes = keyed.groupBy("bucket").agg(F.count("*").alias("held")).where(F.col("held") > bound)
    return materialise(sizes, "vector-buckets")


def _ordered(nodes: DataFrame, numbers: range, signs: int) -> DataFrame:
    """Every vector once a pass: its run (pass, length, first signs), all signs, and its rounded components."""

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = np.array([len(x) for x in batch.column("unit").to_pylist()])
            for size in np.unique(sizes):
                part = batch.take(pa.array(np.flatnonzero(sizes == size)))
                matrix = _matrix(part.column("unit"))
                rounded = _bytes_of(np.rint(matrix * STEPS).astype("<i2"))
                for number in numbers:
                    positive = matrix @ directions(number, matrix.shape[1]) > 0
                    keys = _run_keys(number, int(size), np.packbits(positive[:, :signs], axis=1))
                    columns = [keys, _bytes_of(np.packbits(positive, axis=1)), part.column("node"), rounded]
                    yield pa.RecordBatch.from_arrays(columns, names=["bucket", "signs", "node", "rounded"])

    return nodes.select("node", "unit").mapInArrow(hashed, "bucket binary, signs binary, node binary, rounded binary")


def rounding_error(dimensions: int) -> float:
    """How far a cosine of rounded directions may lie from the true one."""
    moved = 0.5 / STEPS * math.sqrt(dimensions)
    return 2 * moved + moved**2 + 1e-5  # the last for single precision


def _windows(buckets: list[bytes]) -> Iterator[tuple[int, int, int]]:
    """Blocks of sorted rows and where their window ends: first row, end of the block, end of the window."""
    bounds = run_bounds(np.array(buckets, dtype=object))
    heads = [buckets[i][:8] for i in bounds[:-1]]
    parts = run_bounds(np.array(heads, dtype=object))  # rows of one pass and length
    for begin, end in zip(bounds[parts[:-1]], bounds[parts[1:]]):
        for first in range(begin, end, SPREAD):
            last = min(first + SPREAD, end)
            run_end = bounds[np.searchsorted(bounds, last - 1, side="right")]
            yield first, last, min(max(run_end, last + LEAST_WINDOW), last + WINDOW, end)


def _windowed(rows: DataFrame, threshold: float) -> DataFrame:
    """Links ``a``, ``b`` between neighbours in order; ``sure`` is false where rounding could matter."""

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in runs(batches, "bucket"):
            nodes, rounded = table.column("node").to_pylist(), table.column("rounded").to_pylist()
            sure, open_ = [], []
            for first, last, end in _windows(table.column("bucket").to_pylist()):
                if end - first < 2:
                    continue
                units = np.frombuffer(b"".join(rounded[first:end]), dtype="<i2").reshape(end - first, -1).astype(np.float32) / STEPS
                error = rounding_error(units.shape[1])
                cosines = units[: last - first] @ units.T
                cosines[np.tril_indices(last - first)] = -1  # each pair once
                near = np.zeros((end - first,) * 2, dtype=bool)
                near[: last - first] = cosines >= threshold + error
                near |= near.T
                sure += star_links(nodes[first:end], near)
                rows_, others = np.nonzero((cosines >= threshold - error) & (cosines < threshold + error))
                open_ += [(nodes[first + i], nodes[first + j]) for i, j in zip(rows_, others)]
            links = [*sure, *((min(a, b), max(a, b)) for a, b in open_)]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([a for a, _ in links], pa.binary()),
                    pa.array([b for _, b in links], pa.binary()),
                    pa.array([True] * len(sure) + [False] * len(open_), pa.bool_()),
                ],
                names=["a", "b", "sure"],
            )

    # Equal runs stay in one partition, so none is cut.
    dealt = rows.repartitionByRange("bucket").sortWithinPartitions("bucket", "signs")
    return dealt.select("bucket", "node", "rounded").mapInArrow(compared, "a binary, b binary, sure boolean").distinct()


def _verified(pairs: DataFrame, nodes: DataFrame, threshold: float) -> DataFrame:
    """Those pairs whose cosine reaches the threshold in double precision."""
    units = nodes.select("node", "unit")
    whole = pairs.join(units.withColumnsRenamed({"node": "a", "unit": "unit_a"}), "a")
    whole = whole.join(units.withColumnsRenamed({"node": "b", "unit": "unit_b"}), "b")

    def checked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pairs_ = zip(batch.column("unit_a").to_pylist(), batch.column("unit_b").to_pylist())
            kept = [np.frombuffer(a, "<f8") @ np.frombuffer(b, "<f8") >= threshold for a, b in pairs_]
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], names=["a", "b"]).filter(pa.array(kept, pa.bool_()))

    return whole.mapInArrow(checked, "a binary, b binary")


def _spread_links(nodes: DataFrame, numbers: range, signs: int, threshold: float) -> tuple[DataFrame, DataFrame | None]:
    """Links inside all runs that are not crowded, and the nodes of those that are."""
    marked = _keyed(nodes, numbers, signs, units=False)
    crowded = _above(marked, CROWDED).select("bucket")
    some = not crowded.isEmpty()
    keyed = _ordered(nodes, numbers, signs)
    met = materialise(_windowed(keyed.join(crowded, "bucket", "left_anti") if some else keyed, threshold), "vector-links")
    links = met.where("sure").select("a", "b")
    if not met.where("not sure").isEmpty():
        links = links.unionByName(materialise(_verified(met.where("not sure").select("a", "b"), nodes, threshold), "vector-links"))
    return links, marked.join(crowded, "bucket", "left_semi").select("node") if some else None


def _dense_links(nodes: DataFrame, numbers: range, signs: int, threshold: float) -> DataFrame:
    """Links inside all buckets, however many vectors one holds, from blocks of bounded size."""
    large = _above(_keyed(nodes, numbers, signs, units=False), DENSE_BLOCK)
    blocks = large.select("bucket", F.ceil(F.col("held") / DENSE_BLOCK).cast("int").alias("blocks"))
    mine = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    cells = (
        _keyed(nodes, numbers, signs)
        .join(blocks, "bucket", "left")
        .withColumn("blocks", F.coalesce("blocks", F.lit(1)))
        .withColumn("block", mine)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .withColumn(
            "cell",
            F.concat(
                "bucket", F.encode(F.concat_ws("-", F.least("block", "other"), F.greatest("block", "other")), "utf-8")
            ),
        )
    )
    return materialise(_linked(cells, threshold), "vector-links")


def _links(nodes: DataFrame, threshold: float) -> DataFrame:
    """Links whose components are those of all links, but for the chance ``MISS`` of each."""
    n = nodes.count()
    signs = prefix_signs(n)
    needed = passes_needed(signs, threshold)
    found, crowded = [], []
    for begin in range(0, needed, PASSES_AT_ONCE):
        links, dense = _spread_links(nodes, range(begin, min(begin + PASSES_AT_ONCE, needed)), signs, threshold)
        found.append(links)
        if dense is not None:
            crowded.append(materialise(dense.distinct(), "vector-crowded"))
    if crowded:
        members = reduce(DataFrame.unionByName, crowded).distinct()
        dense = materialise(nodes.select("node", "unit").join(members, "node", "left_semi"), "vector-dense")
        sample = dense.orderBy("node").limit(SAMPLE).select("unit").collect()  # digests are in no order
        signs = dense_signs([np.frombuffer(row["unit"], dtype="<f8") for row in sample], dense.count(), threshold)
        more = passes_needed(signs, threshold)
        # Directions of their own: those of the first passes are spent.
        for begin in range(needed, needed + more, PASSES_AT_ONCE):
            found.append(_dense_links(dense, range(begin, min(begin + PASSES_AT_ONCE, needed + more)), signs, threshold))
    return reduce(DataFrame.unionByName, found)


def _counted(members: DataFrame, threshold: float) -> DataFrame:
    """For each node the vectors linked to it, from ``node``, ``root``, ``copies`` and ``unit``."""
    sizes = members.groupBy("root").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    mine = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    dealt = (
        members.join(sizes, "root")
        .withColumn("mine", mine)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select(
            F.xxhash64("root", F.least("mine", "other"), F.greatest("mine", "other")).alias("cell"),
            "root",
            "node",
            "copies",
            "unit",
            # In a cell of two blocks only links across them count, in a cell of one all.
            (F.col("mine") != F.col("other")).alias("across"),
            "mine",
        )
    )

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in runs(batches, "cell"):
            bounds = run_bounds(table.column("cell").to_numpy())
            copies = table.column("copies").to_numpy()
            mine = table.column("mine").to_numpy()
            across = table.column("across").to_numpy()
            roots = table.column("root").to_pylist()
            units = table.column("unit").to_pylist()
            totals = np.zeros(len(copies), dtype=np.int64)
            for start, end in zip(bounds[:-1], bounds[1:]):
                own = np.arange(start, end)
                # Two cells whose hashes collide come in one run.
                for root in dict.fromkeys(roots[start:end]):
                    at = own[[roots[i] == root for i in own]]
                    matrix = np.frombuffer(b"".join([units[i] for i in at]), dtype="<f8").reshape(len(at), -1)
                    near = matrix @ matrix.T >= threshold
                    same_block = mine[at][:, None] == mine[at][None, :]
                    near &= np.where(across[at][:, None], ~same_block, same_block)
                    near[np.arange(len(at)), np.arange(len(at))] = False
                    totals[at] = near @ copies[at]
            yield pa.RecordBatch.from_arrays(
                [table.column("node").combine_chunks(), pa.array(totals)], names=["node", "n"]
            )

    cells = dealt.repartition("cell").sortWithinPartitions("cell")
    return cells.mapInArrow(counted, "node binary, n long").groupBy("node").agg(F.sum("n").alias("n"))


def near_duplicates(frame: DataFrame, key: str, vector: str, threshold: float = THRESHOLD) -> DataFrame:
    """``key``, ``n_links``, ``component_id`` and ``kept`` of every row."""
    spark = frame.sparkSession
    prepare(spark)
    rows = materialise(_prepared(frame, key, vector), "vectors")
    valid = rows.where("node is not null")
    copies = valid.groupBy("node").agg(F.count("*").alias("copies"), F.min("id").alias("first"), F.first("unit").alias("unit"))
    nodes = materialise(copies, "vector-classes")
    roots = components(_links(nodes, threshold), "a", "b")
    members = materialise(nodes.join(roots, "node"), "vector-components")
    near = _counted(members, threshold)
    smallest = members.groupBy("root").agg(F.min("first").alias("smallest"))
    grouped = members.select("node", "root").join(smallest, "root").join(near, "node", "left").select("node", "smallest", "n")
    classes = nodes.select("node", "copies", "first").join(grouped, "node", "left").select(
        "node",
        (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
        F.coalesce("smallest", "first").alias("component_id"),
    )
    return (
        rows.select("id", "node")
        .join(classes, "node", "left")
        .select(
            F.col("id").alias(key),
            F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
            F.coalesce("component_id", "id").alias("component_id"),
        )
        .withColumn("kept", F.col(key).eqNullSafe(F.col("component_id")))
    )
