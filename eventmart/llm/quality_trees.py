"""Quality of a text by histogram gradient-boosted trees over document statistics.

Statistics come from the bytes and words of the whole text. Trees are grown level by
level on binned statistics with second-order gains, then flattened into one set of
arrays that all rows walk together.

Defined results: a null text counts as empty; an empty text gets the score of its
all-zero statistics. Rows with a null id or label are never trained on; a document
labelled twice takes the greater label. Training without rows gives 0.5 for every text,
training with one label that label's smoothed share. Extra columns are kept untouched.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from operator import eq

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from eventmart.llm.runtime import first_by_hash, one_a_key, prepare

# Bound of the training sample.
TRAINING_ROWS = 16_000

TREES, DEPTH, BINS = 60, 4, 64
LEARNING_RATE, L2, LEAST_ROWS = 0.2, 1.0, 20

STATISTICS = [
    "log_bytes", "log_words", "log_lines", "word_length", "upper", "digits", "marks", "symbols", "spaces",
    "wide", "byte_entropy", "distinct_words", "adjacent_repeats", "repeated_triples", "distinct_lines",
    "words_per_line", "ends_in_stop", "exclamations", "longest_word", "top_word",
]

_CLASS = np.zeros(256, dtype=np.int64)
for _of, _bytes in enumerate(
    (b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b".,;:!?\"'()-", b"#*$%&|<>@^~_=+{}[]\\/", b" \t\r\v\f\n"), 1
):
    _CLASS[list(_bytes)] = _of
_CLASS[128:] = 6


def statistics(data: bytes | None) -> list[float]:
    """The numbers named in ``STATISTICS`` for one UTF-8 text."""
    data = data or b""
    n = len(data)
    if not n:
        return [0.0] * len(STATISTICS)
    per_byte = np.bincount(np.frombuffer(data, dtype=np.uint8), minlength=256)
    shares = np.bincount(_CLASS, weights=per_byte, minlength=7) / n
    seen = per_byte[per_byte > 0] / n
    words = data.split()
    lines = [line for line in data.split(b"\n") if line.strip()]
    n_words, n_lines = max(1, len(words)), max(1, len(lines))
    counts: dict[bytes, int] = {}
    for word in words:
        counts[word] = counts.get(word, 0) + 1
    triples = max(1, len(words) - 2)
    return [
        float(np.log1p(n)),
        float(np.log1p(len(words))),
        float(np.log1p(len(lines))),
        (n - shares[5] * n) / n_words,
        *(float(x) for x in shares[1:7]),
        float(-(seen * np.log2(seen)).sum()),
        len(counts) / n_words,
        sum(map(eq, words, words[1:])) / n_words,
        1 - len(set(zip(words, words[1:], words[2:]))) / triples if len(words) > 2 else 0.0,
        len(set(lines)) / n_lines,
        float(np.log1p(len(words) / n_lines)),
        sum(line.rstrip()[-1:] in (b".", b"!", b"?") for line in lines) / n_lines,
        float(per_byte[33] / n_words),
        float(np.log1p(max(map(len, words), default=0))),
        max(counts.values(), default=0) / n_words,
    ]


@dataclass
class Forest:
    """All trees in one set of arrays; a leaf is a node that leads to itself."""

    prior: float
    roots: np.ndarray = field(default_factory=lambda: np.zeros(0, dtype=np.int64))
    feature: np.ndarray = field(default_factory=lambda: np.zeros(0, dtype=np.int64))
    threshold: np.ndarray = field(default_factory=lambda: np.zeros(0))
    below: np.ndarray = field(default_factory=lambda: np.zeros(0, dtype=np.int64))
    above: np.ndarray = field(default_factory=lambda: np.zeros(0, dtype=np.int64))
    value: np.ndarray = field(default_factory=lambda: np.zeros(0))
    depth: int = 0

    def scores(self, rows: np.ndarray) -> np.ndarray:
        margin = np.full(len(rows), self.prior)
        at_row = np.arange(len(rows))[:, None]
        if len(self.roots) and len(rows):
            node = np.broadcast_to(self.roots, (len(rows), len(self.roots)))
            for _ in range(self.depth):
                higher = rows[at_row, self.feature[node]] > self.threshold[node]
                node = np.where(higher, self.above[node], self.below[node])
            margin = margin + self.value[node].sum(axis=1)
        return 1 / (1 + np.exp(-margin))


def _edges(rows: np.ndarray) -> list[np.ndarray]:
    """For each statistic the values between its bins."""
    cuts = np.linspace(0, 1, BINS + 1)[1:-1]
    return [np.unique(np.quantile(rows[:, j], cuts)) for j in range(rows.shape[1])]


def _best_splits(binned, node, n_nodes, gradient, hessian):
    """For each node of a level the split with the highest gain, from one histogram a statistic."""
    best = np.zeros(n_nodes)
    feature = np.full(n_nodes, -1)
    cut = np.zeros(n_nodes, dtype=np.int64)
    for j in range(binned.shape[1]):
        cell = node * BINS + binned[:, j]
        size = n_nodes * BINS
        g, h, n = (
            np.bincount(cell, weights=w, minlength=size).reshape(n_nodes, BINS).cumsum(axis=1)
            for w in (gradient, hessian, None)
        )
        all_g, all_h, all_n = g[:, -1:], h[:, -1:], n[:, -1:]
        gain = g**2 / (h + L2) + (all_g - g) ** 2 / (all_h - h + L2) - all_g**2 / (all_h + L2)
        gain[(n < LEAST_ROWS) | (all_n - n < LEAST_ROWS)] = 0
        at = gain.argmax(axis=1)
        top = gain[np.arange(n_nodes), at]
        better = top > best + 1e-9
        best[better], feature[better], cut[better] = top[better], j, at[better]
    return feature, cut


def grow(rows: np.ndarray, labels: np.ndarray) -> Forest:
    """Trains on statistics (a row a document) and labels 0 or 1."""
    if not len(rows):
        return Forest(prior=0.0)
    share = (labels.sum() + 1) / (len(labels) + 2)
    forest = Forest(prior=float(np.log(share / (1 - share))), depth=DEPTH)
    edges = _edges(rows)
    binned = np.stack([np.searchsorted(e, rows[:, j], side="left") for j, e in enumerate(edges)], axis=1)
    margin = np.full(len(rows), forest.prior)
    parts: dict[str, list] = {k: [] for k in ("feature", "threshold", "below", "above", "value")}
    roots = []
    for _ in range(TREES):
        p = 1 / (1 + np.exp(-margin))
        gradient, hessian = p - labels, p * (1 - p)
        ids = np.array([len(parts["value"])])  # places of this level's nodes
        roots.append(int(ids[0]))
        for column in parts.values():
            column.append(0)
        node, live = np.zeros(len(rows), dtype=np.int64), np.arange(len(rows))
        for level in range(DEPTH + 1):
            g = np.bincount(node[live], weights=gradient[live], minlength=len(ids))
            h = np.bincount(node[live], weights=hessian[live], minlength=len(ids))
            for i, place in enumerate(ids):
                parts["value"][place] = -LEARNING_RATE * g[i] / (h[i] + L2)
                parts["below"][place] = parts["above"][place] = place
                parts["threshold"][place] = np.inf
            if level == DEPTH:
                margin[live] += np.array(parts["value"])[ids[node[live]]]
                break
            feature, cut = _best_splits(binned[live], node[live], len(ids), gradient[live], hessian[live])
            stopped = feature[node[live]] < 0
            ended = live[stopped]
            margin[ended] += np.array(parts["value"])[ids[node[ended]]]
            live = live[~stopped]
            children, first_child = [], np.full(len(ids), -1)
            for i in np.flatnonzero(feature >= 0):
                first_child[i] = len(children)
                place = int(ids[i])
                left = len(parts["value"])
                for column in parts.values():
                    column += [0, 0]
                parts["feature"][place] = int(feature[i])
                parts["threshold"][place] = float(edges[feature[i]][cut[i]])
                parts["below"][place], parts["above"][place] = left, left + 1
                parts["value"][place] = 0.0
                children += [left, left + 1]
            if not children:
                break
            higher = binned[live, feature[node[live]]] > cut[node[live]]
            node[live] = first_child[node[live]] + higher
            ids = np.array(children)
    forest.roots = np.array(roots)
    for name, column in parts.items():
        setattr(forest, name, np.array(column, dtype=np.float64 if name in ("threshold", "value") else np.int64))
    return forest


def _statistics_of(texts: pa.Array) -> np.ndarray:
    if not len(texts):
        return np.zeros((0, len(STATISTICS)))
    return np.array([statistics(x.as_buffer().to_pybytes() if x.is_valid else None) for x in texts])


def fit(rows: DataFrame, key: str, text: str, labels: DataFrame, label_key: str, label: str, bound: int = TRAINING_ROWS) -> Forest:
    """Trains on at most ``bound`` labelled documents, those with the lowest key hashes, one a key."""
    prepare(rows.sparkSession)
    known = (
        labels.where(F.col(label).isNotNull() & F.col(label_key).isNotNull())
        .groupBy(F.col(label_key).alias("_key"))
        .agg(F.max(label).cast("double").alias("_label"))
    )
    chosen = first_by_hash(known, "_key", bound)
    joined = one_a_key(
        rows.select(F.col(key).alias("_key"), F.col(text).cast("binary").alias("_text")).join(
            F.broadcast(chosen), "_key"  # at most ``bound`` rows of two numbers
        ),
        "_key",
        "_text",
    )

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = _statistics_of(batch.column("_text"))
            yield pa.RecordBatch.from_pydict(
                {"_key": batch.column("_key"), "_label": batch.column("_label"), "x": pa.array(list(values), pa.list_(pa.float64()))}
            )

    schema = f"_key {dict(joined.dtypes)['_key']}, _label double, x array<double>"
    sample = joined.select("_key", "_label", "_text").mapInArrow(measured, schema).collect()
    sample.sort(key=lambda row: (row["_key"], row["x"]))  # sums must not depend on the order of arrival
    return grow(
        np.array([row["x"] for row in sample]).reshape(len(sample), len(STATISTICS)),
        np.array([row["_label"] for row in sample]),
    )


def scorer(frame: DataFrame, forest: Forest):
    """A function of a text column giving its score."""
    prepare(frame.sparkSession)

    @F.pandas_udf(DoubleType())
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            for_each = [statistics(x.encode("utf-8") if x else None) for x in texts]
            yield pd.Series(forest.scores(np.array(for_each).reshape(len(texts), len(STATISTICS))))

    return score.asNondeterministic()


def rate(frame: DataFrame, text: str, forest: Forest, into: str) -> DataFrame:
    """``frame`` with the score of every text in column ``into``."""
    return frame.withColumn(into, scorer(frame, forest)(F.col(text)))
