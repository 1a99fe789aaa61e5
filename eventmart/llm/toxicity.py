"""Toxicity by multiple-instance learning: labels of documents teach scores of sentences.

A sentence's score is a logistic function of its words and of their beginnings; a
document is toxic if any sentence is, so its score is the noisy-or of its sentences'.
Gradients of the document's loss flow to the sentences that explain it, which is what
lets the same weights point to the offending ones.

Defined results: a null or empty text, or one without a letter, has no sentence and
scores 0. Rows with a null id or label are never trained on; a document labelled twice
takes the greater label. Without training rows every text scores 0. Repeated rows score
alike. Extra columns are kept untouched.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, IntegerType, StructField, StructType

from eventmart.llm.runtime import first_by_hash, materialise, one_a_key, prepare

# Bounds of the training sample and of the model.
TRAINING_ROWS, FEATURES = 12_000, 4_000
LEAST_DOCS = 4
PREFIXES = range(3, 7)
OFFENDING = 0.5

STEPS, STEP_SIZE, L2 = 400, 0.1, 1e-5
START = -5.0  # log odds of a sentence before anything is learned
SHIFTS = [x / 4 for x in range(-40, 9)]  # of the bias, tried at the end
MEMORY_WORDS = 250_000

_sentences = regex.compile(r"[^.!?\n]+").finditer
_words = regex.compile(r"\p{L}+").findall


def features(word: str) -> list[str]:
    """A lower-case word and its beginnings, the latter marked by a trailing asterisk."""
    return [word, *(word[:n] + "*" for n in PREFIXES if len(word) >= n)]


def sentences(text: str | None) -> Iterator[tuple[int, int, list[str]]]:
    """Place and lower-case words of every sentence that has a word."""
    for found in _sentences(text or ""):
        words = _words(found.group().lower())
        if words:
            yield found.start(), found.end(), words


@dataclass
class ToxicityModel:
    bias: float
    weights: dict[str, float]


class _Weights(dict):
    """Word to the sum of its features' weights; forgets all when full."""

    def __init__(self, model: ToxicityModel):
        super().__init__()
        self._weights = model.weights

    def __missing__(self, word: str) -> float:
        value = sum(self._weights.get(x, 0.0) for x in features(word))
        if len(self) >= MEMORY_WORDS:
            self.clear()
        self[word] = value
        return value


class Scorer:
    def __init__(self, model: ToxicityModel):
        self._bias, self._weights = model.bias, _Weights(model)

    def score(self, text: str | None) -> tuple[float, list[tuple[int, int, float]]]:
        """The document's score and its offending sentences (start, end, score)."""
        spans, margins = [], []
        for start, end, words in sentences(text):
            spans.append((start, end))
            margins.append(sum(map(self._weights.__getitem__, words)))
        if not spans or not self._weights._weights:
            return 0.0, []
        p = 1 / (1 + np.exp(-(np.array(margins) + self._bias)))
        offending = [(*spans[i], float(p[i])) for i in np.flatnonzero(p >= OFFENDING)]
        return float(-np.expm1(np.log1p(-np.minimum(p, 1 - 1e-12)).sum())), offending


def train(documents: list[tuple[float, list[list[int]]]], n_features: int) -> tuple[float, np.ndarray]:
    """Bias and weights from (label, feature indexes of each sentence) by full-batch Adam."""
    weights = np.zeros(n_features + 1)
    weights[-1] = START
    documents = [d for d in documents if d[1]]
    if not documents or not any(label for label, _ in documents):
        return START, weights[:-1]
    labels = np.array([label for label, _ in documents])
    doc = np.repeat(np.arange(len(documents)), [len(s) for _, s in documents])
    flat = [s for _, each in documents for s in each]
    sentence = np.repeat(np.arange(len(flat)), [len(s) for s in flat])
    index = np.fromiter((x for s in flat for x in s), dtype=np.int64, count=len(sentence))
    # Both labels weigh the same in all.
    share = labels.mean()
    weight = np.where(labels > 0, 0.5 / share, 0.5 / max(1 - share, 1e-9)) / len(labels)
    first = second = np.zeros_like(weights)

    def margins(weights: np.ndarray) -> np.ndarray:
        return np.bincount(sentence, weights=weights[index], minlength=len(flat)) + weights[-1]

    def chances(margin: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of every sentence to be toxic, and of every document to have none that is."""
        p = 1 / (1 + np.exp(-margin))
        return p, np.exp(np.bincount(doc, weights=np.log1p(-np.minimum(p, 1 - 1e-9)), minlength=len(labels)))

    for step in range(1, STEPS + 1):
        p, none = chances(margins(weights))
        # d loss / d margin: p where the document is clean, -p * none / (1 - none) where it is toxic.
        pull = np.where(labels > 0, -none / np.maximum(1 - none, 1e-9), 1.0) * weight
        slope = p * pull[doc]
        gradient = np.append(np.bincount(index, weights=slope[sentence], minlength=n_features), slope.sum())
        gradient[:-1] += L2 * weights[:-1]
        first = 0.9 * first + 0.1 * gradient
        second = 0.999 * second + 0.001 * gradient**2
        weights = weights - STEP_SIZE * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)

    # Every sentence without a sign adds to a document's score, and long clean documents
    # have very many: the bias is set last, where the loss is least.
    final = margins(weights)

    def loss(shift: float) -> float:
        none = np.clip(chances(final + shift)[1], 1e-9, 1 - 1e-9)
        return float(-(weight * np.where(labels > 0, np.log1p(-none), np.log(none))).sum())

    return float(weights[-1] + min(SHIFTS, key=loss)), weights[:-1]


def _sample(rows: DataFrame, key: str, text: str, labels: DataFrame, label_key: str, label: str, bound: int) -> DataFrame:
    known = (
        labels.where(F.col(label).isNotNull() & F.col(label_key).isNotNull())
        .groupBy(F.col(label_key).alias("_key"))
        .agg(F.max(label).cast("double").alias("label"))
    )
    chosen = first_by_hash(known, "_key", bound)
    return one_a_key(
        rows.select(F.col(key).alias("_key"), F.col(text).alias("text")).join(
            F.broadcast(chosen), "_key"  # at most ``bound`` rows of two numbers
        ),
        "_key",
        "text",
    )


def fit(rows: DataFrame, key: str, text: str, labels: DataFrame, label_key: str, label: str, bound: int = TRAINING_ROWS) -> ToxicityModel:
    """Trains on at most ``bound`` labelled documents, those with the lowest key hashes, one a key.

    The features are those whose share of toxic documents differs most from the whole's.
    """
    prepare(rows.sparkSession)
    sample = materialise(_sample(rows, key, text, labels, label_key, label, bound), "toxicity-sample")

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts: dict[str, list[int]] = {}
            for label_, text_ in zip(batch.column("label").to_pylist(), batch.column("text").to_pylist()):
                for feature in {x for word in set(_words((text_ or "").lower())) for x in features(word)}:
                    counts.setdefault(feature, [0, 0])[int(label_ > 0)] += 1
            clean, toxic = zip(*counts.values()) if counts else ((), ())
            yield pa.RecordBatch.from_pydict(
                {"feature": pa.array(list(counts), pa.string()), "clean": pa.array(clean, pa.int64()), "toxic": pa.array(toxic, pa.int64())}
            )

    totals = sample.agg(F.count("*").alias("n"), F.sum((F.col("label") > 0).cast("long")).alias("toxic")).first()
    n, n_toxic = totals["n"], totals["toxic"] or 0
    if not n_toxic or n_toxic == n:
        return ToxicityModel(START, {})
    counts = (
        sample.select("label", "text")
        .mapInArrow(counted, "feature string, clean long, toxic long")
        .groupBy("feature")
        .agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
        .withColumn("docs", F.col("clean") + F.col("toxic"))
        .where(F.col("docs") >= LEAST_DOCS)
    )
    # Squared distance from the expected number, in units of its variance.
    share = n_toxic / n
    distance = (F.col("toxic") - F.col("docs") * share) ** 2 / (F.col("docs") * share * (1 - share))
    ranked = counts.orderBy(F.desc(distance), "feature").limit(FEATURES)
    index = {row["feature"]: i for i, row in enumerate(ranked.select("feature").collect())}

    def indexed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [
                [sorted({index[x] for word in words for x in features(word) if x in index}) for _, _, words in sentences(text_)]
                for text_ in batch.column("text").to_pylist()
            ]
            yield pa.RecordBatch.from_pydict(
                {
                    "_key": batch.column("_key"),
                    "label": batch.column("label"),
                    "found": pa.array([[s for s in each if s] for each in found], pa.list_(pa.list_(pa.int32()))),
                    "empty": pa.array([sum(not s for s in each) for each in found], pa.int64()),
                }
            )

    kind = dict(sample.dtypes)["_key"]
    taken = sample.mapInArrow(indexed, f"_key {kind}, label double, found array<array<int>>, empty long").collect()
    taken.sort(key=lambda row: (row["_key"], row["label"], row["found"]))
    bias, weights = train(
        [(float(row["label"] > 0), [*row["found"], *([[]] * row["empty"])]) for row in taken], len(index)
    )
    return ToxicityModel(bias, {x: float(weights[i]) for x, i in index.items() if abs(weights[i]) > 1e-3})


SPAN = StructType([StructField("start", IntegerType()), StructField("end", IntegerType()), StructField("score", DoubleType())])
SCORED = StructType([StructField("score", DoubleType()), StructField("offending", ArrayType(SPAN))])


def rate(frame: DataFrame, text: str, model: ToxicityModel, into: str) -> DataFrame:
    """``frame`` with a struct of ``score`` and ``offending`` sentences in characters of the text."""
    prepare(frame.sparkSession)

    @F.pandas_udf(SCORED)
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        scorer = Scorer(model)
        for texts in batches:
            found = [scorer.score(x) for x in texts]
            yield pd.DataFrame(
                {
                    "score": [s for s, _ in found],
                    "offending": [[dict(zip(("start", "end", "score"), span)) for span in spans] for _, spans in found],
                }
            )

    return frame.withColumn(into, score.asNondeterministic()(F.col(text)))
