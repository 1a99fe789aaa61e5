"""Language identification, known words first, then ever shorter character n-grams.

A word the training texts held is scored by its log frequency in each language. A new
word is scored by its character n-grams of the greatest length of which training
knows at least one. A text gets the language with the highest sum over its words.

Defined results: a null text or one without a letter is ``und`` with score 0. Equal
sums go to the language first in the alphabet. A model from an empty training table
knows no language and answers ``und``. Null languages, ids or texts are never trained
on. Repeated rows are scored alike; in training, all rows of an id and language are one text. Long
texts are scored whole, so many words at a time. Extra columns of the input are kept untouched.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import regex
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from eventmart.llm.runtime import likely_among_lowest, materialise, prepare

UNKNOWN = "und"
# Bounds of the training sample and of the model. What each language sees most of is kept, together
# with what all other languages have of it; with many languages, fewer items of each.
DOCS_PER_LANGUAGE = 1_500
WORDS_PER_LANGUAGE = 20_000
GRAMS_PER_LANGUAGE = 20_000
MODEL_CELLS = 32_000_000
LONGEST_GRAM = 5

# Pseudo-count of what a language was never seen with.
SMOOTHING = 0.1
# A word counts against a language by so much at most, so that a quotation in another
# language weighs by its length and not by how outlandish its words are.
MOST_AGAINST = 3.0
# New words that a task remembers, by the bytes of their scores, and words scored at once.
MEMORY_BYTES = 8_000_000
AT_ONCE = 10_000

_words = regex.compile(r"\p{L}+").findall
PREDICTION = StructType([StructField("lang", StringType()), StructField("score", DoubleType())])


@dataclass
class LanguageModel:
    """Log frequencies: a row per word or n-gram, a column per language in order."""

    languages: list[str]
    words: dict[str, int]
    word_scores: np.ndarray
    grams: dict[str, int]
    gram_scores: np.ndarray

    def new_word(self, word: str) -> np.ndarray:
        marked = f"<{word}>"
        for size in range(min(LONGEST_GRAM, len(marked)), 0, -1):
            within = marked if size > 1 else word  # a mark alone says nothing
            known = [
                at
                for i in range(len(within) - size + 1)
                if (at := self.grams.get(within[i : i + size])) is not None
            ]
            if known:
                return self.gram_scores[known].mean(axis=0)
        return np.zeros(len(self.languages))


def _relative(scores: np.ndarray) -> np.ndarray:
    """Scores against each row's best."""
    best = scores.max(axis=1, keepdims=True, initial=-np.inf)
    return np.maximum(scores - best, -MOST_AGAINST) if scores.size else scores


class _Scorer(dict):
    """Word to row of a table of scores; new words are added, all forgotten when full."""

    def __init__(self, model: LanguageModel):
        super().__init__()
        self._model = model
        remembered = max(AT_ONCE, MEMORY_BYTES // (8 * max(1, len(model.languages))))
        self.table = np.zeros((len(model.words) + remembered, len(model.languages)))
        self._start()

    def _start(self) -> None:
        self.clear()
        self.update(self._model.words)
        self.table[: len(self)] = _relative(self._model.word_scores)

    def __missing__(self, word: str) -> int:
        at = len(self)
        self.table[at] = _relative(self._model.new_word(word)[None, :])
        self[word] = at
        return at

    def predict(self, text: str | None) -> tuple[str, float]:
        words = _words(text.lower()) if text else []
        if not words or not self._model.languages:
            return UNKNOWN, 0.0
        total = np.zeros(len(self._model.languages))
        for start in range(0, len(words), AT_ONCE):
            part = words[start : start + AT_ONCE]
            if len(self) + len(part) > len(self.table):
                self._start()
            total += self.table[list(map(self.__getitem__, part))].sum(axis=0)
        best = int(total.argmax())
        # Words of a text are no independent witnesses: the posterior is taken at the root of their number.
        odds = np.exp((total - total[best]) / np.sqrt(len(words)))
        return self._model.languages[best], float(odds[best] / odds.sum())


def _table(rows: list, totals: dict[str, int], languages: list[str]) -> tuple[dict[str, int], np.ndarray]:
    """Index and smoothed log frequencies of counted items; ``totals`` count all items of a language."""
    index: dict[str, int] = {}
    for row in rows:
        index.setdefault(row["item"], len(index))
    counts = np.full((len(index), len(languages)), SMOOTHING)
    place = {lang: i for i, lang in enumerate(languages)}
    for row in rows:
        counts[index[row["item"]], place[row["lang"]]] += row["n"]
    sums = np.array([totals.get(lang, 0) for lang in languages]) + SMOOTHING * len(index)
    return index, np.log(counts / np.where(sums > 0, sums, 1))


def _most_frequent(counted: DataFrame, bound: int, least: int) -> list:
    """Counts in every language of the items that are among the ``bound`` most frequent of some language.

    An item counts as frequent from ``least`` on.
    """
    order = Window.partitionBy("lang").orderBy(F.desc("n"), "item")
    top = counted.where(F.col("n") >= least).withColumn("_place", F.row_number().over(order))
    kept = materialise(top.where(F.col("_place") <= bound).select("item").distinct(), "language-items")
    return counted.join(kept, "item", "left_semi").orderBy("item", "lang").collect()


def _totals(counted: DataFrame) -> dict[str, int]:
    return {row["lang"]: row["n"] for row in counted.groupBy("lang").agg(F.sum("n").alias("n")).collect()}


def fit(rows: DataFrame, key: str, text: str, lang: str, docs_per_language: int = DOCS_PER_LANGUAGE) -> LanguageModel:
    """Trains on at most ``docs_per_language`` whole texts of each language.

    ``rows`` must hold training rows only. The sample is the lowest hashes of a language's
    distinct keys, one text a key: that with the lowest hash.
    """
    order = Window.partitionBy("_lang").orderBy(F.xxhash64("_key"), "_key")
    hashed = rows.where(F.col(lang).isNotNull() & F.col(text).isNotNull() & F.col(key).isNotNull()).select(
        F.col(key).alias("_key"), F.col(lang).alias("_lang"), F.col(text).alias("_text"), F.xxhash64(text).alias("_hash")
    )
    # A key's rows are one before anything is counted or ranked, however often it repeats.
    keyed = materialise(hashed.groupBy("_key", "_lang").agg(F.min("_hash").alias("_hash")), "language-keys")
    # Written, so that Spark knows how few they are before it deals out keys and texts.
    sizes = materialise(keyed.groupBy("_lang").agg(F.count("*").alias("_there")), "language-sizes")
    chosen = materialise(
        keyed.join(sizes, "_lang")
        .where(likely_among_lowest(F.col("_key"), docs_per_language, F.col("_there")))
        .withColumn("_place", F.row_number().over(order))
        .where(F.col("_place") <= docs_per_language)
        .select("_key", "_lang", "_hash"),
        "language-sample",
    )
    sample = hashed.join(chosen, ["_key", "_lang", "_hash"]).groupBy("_key", "_lang").agg(F.min("_text").alias("_text"))
    found = F.regexp_extract_all(F.lower("_text"), F.lit(r"(\p{L}+)"), 1)
    words = materialise(
        sample.select(F.col("_lang").alias("lang"), F.explode(found).alias("item"))
        .groupBy("lang", "item")
        .agg(F.count("*").alias("n")),
        "language-words",
    )
    marked = F.concat(F.lit("<"), "item", F.lit(">"))

    def of_size(size: int) -> Column:
        return F.transform(F.sequence(F.lit(1), F.length(marked) - (size - 1)), lambda i: marked.substr(i, F.lit(size)))

    lengths = [of_size(size) for size in range(1, LONGEST_GRAM + 1)]
    # A marked word has three characters at least; longer n-grams need longer words.
    grams = words.select(
        "lang",
        "n",
        F.explode(
            F.concat(
                *(
                    F.when(F.length(marked) >= size, each).otherwise(F.array().cast("array<string>"))
                    for size, each in enumerate(lengths, 1)
                )
            )
        ).alias("item"),
    ).where(~F.col("item").isin("<", ">")).groupBy("lang", "item").agg(F.sum("n").alias("n"))
    grams = materialise(grams, "language-grams")
    totals = _totals(words)
    languages = sorted(totals)
    most = max(1, MODEL_CELLS // max(1, len(languages)) ** 2)
    # A word seen once tells less than its n-grams.
    word_rows = _most_frequent(words, min(WORDS_PER_LANGUAGE, most), 2)
    gram_rows = _most_frequent(grams, min(GRAMS_PER_LANGUAGE, most), 1)
    return LanguageModel(languages, *_table(word_rows, totals, languages), *_table(gram_rows, _totals(grams), languages))


def predictor(frame: DataFrame, model: LanguageModel):
    """A function of a text column giving a struct of ``lang`` and ``score``."""
    prepare(frame.sparkSession)
    shared = frame.sparkSession.sparkContext.broadcast(model)  # bounded by the limits above

    @F.pandas_udf(PREDICTION)
    def predict(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        scorer = _Scorer(shared.value)
        for texts in batches:
            yield pd.DataFrame([scorer.predict(x) for x in texts], columns=PREDICTION.names)

    return predict.asNondeterministic()  # evaluated once, however often its fields are used


def identify(frame: DataFrame, text: str, model: LanguageModel, into: str) -> DataFrame:
    """``frame`` with a struct column ``into`` of ``lang`` and ``score``."""
    return frame.withColumn(into, predictor(frame, model)(F.col(text)))


def trusted(prediction: Column, least: float = 0.5) -> Column:
    """Whether a prediction names a language it is more sure of than not."""
    return (prediction["lang"] != UNKNOWN) & (prediction["score"] >= least)
