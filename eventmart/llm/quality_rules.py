"""Quality rules as one projection of built-in functions, from a table of thresholds.

Words are runs of anything but the six ASCII white space characters. Repeated windows
are found by sorting each text's hashed three-word windows with their places, inside
the row, so that nothing is shuffled.

Defined results: a null or empty text has no words, zero statistics and is not kept
(it fails the base rule). Statistics of repeated rows are equal. Null ids are kept as
they are; extra columns are kept.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventmart.llm.runtime import own_columns

SPACE = r"[\x20\x09-\x0D]+"
SYMBOLS = r"[#*$%&|<>]"
BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]

# Frequent short words of the languages the rules know.
STOP_WORDS = {
    "en": "the of and to in a is that for it was on are as with be at by this from or have not but they which".split(),
    "fr": "le la les de des du et un une est que dans en pour qui sur au par avec pas plus ne se ce il elle son".split(),
    "de": "der die das und in den von zu mit sich des auf für ist im dem nicht ein eine als auch es an er sie aus".split(),
    "es": "el la los las de que y en un una por con no para su al es lo como del se más o pero sus le ha".split(),
}

MIN_WORDS = 50
MOST_REPEATED = 50  # per cent of the words


@dataclass(frozen=True)
class Rule:
    """A statistic over another must lie within bounds; ``over`` None means the number itself."""

    name: str
    statistic: str
    over: str | None
    least: float | None
    most: float | None


# Statistics besides the base ones: n_lines (lines with a word), n_stop_words, n_chars.
RULES = [
    Rule("words", "n_words", None, MIN_WORDS, 1_000_000),
    Rule("repeats", "n_repeat_words", "n_words", None, MOST_REPEATED / 100),
    Rule("word length", "word_chars", "n_words", 1.5, 25),
    Rule("symbols", "n_symbols", "n_words", None, 0.3),
    Rule("repeated lines", "n_dup_lines", "n_lines", None, 0.5),
    Rule("stop words", "n_stop_words", "n_words", 0.005, None),
]


def _filled(text: Column) -> Column:
    return F.coalesce(text, F.lit(""))


def with_statistics(frame: DataFrame, text: str) -> DataFrame:
    """``frame`` with the base statistics and those the rules need besides.

    Columns bearing one of the statistics' names are replaced.
    """
    wanted = [*BASE, "n_lines", "n_stop_words"]
    frame = frame.drop(*(c for c in frame.columns if c.lower() in wanted and c != text))
    words, lines, places, windows, ordered = own_columns(frame, "_words", "_lines", "_places", "_windows", "_ordered")
    filled = _filled(F.col(text))
    listed = frame.withColumns(
        {
            words: F.filter(F.split(filled, SPACE), lambda w: w != ""),
            lines: F.filter(F.split(filled, "\n", -1), lambda line: F.regexp_replace(line, SPACE, "") != ""),
        }
    )
    w = F.col(words)
    n = F.size(w)
    hashed = listed.withColumn(
        windows,
        F.when(
            n >= 4,
            F.transform(
                F.slice(w, F.lit(1), F.greatest(n - 2, F.lit(0))),
                lambda x, i: F.struct(F.xxhash64(x, F.get(w, i + 1), F.get(w, i + 2)).alias("h"), i.alias("p")),
            ),
        ).otherwise(F.array().cast("array<struct<h:bigint,p:int>>")),
    )
    # Only a text that repeats a window is sorted; equal windows are neighbours then.
    any_repeat = F.size(F.array_distinct(F.transform(F.col(windows), lambda x: x["h"]))) < F.size(windows)
    sorted_ = hashed.withColumn(
        ordered, F.when(any_repeat, F.array_sort(windows)).otherwise(F.array().cast("array<struct<h:bigint,p:int>>"))
    ).drop(windows)
    near = F.col(ordered)
    repeated = F.filter(
        near, lambda x, i: (F.get(near, i + 1)["h"] == x["h"]) | (F.get(near, i - 1)["h"] == x["h"])
    )
    # Their places, sorted again, cover three words each less what they share with the next.
    placed = sorted_.withColumn(places, F.array_sort(F.transform(repeated, lambda x: x["p"]))).drop(ordered)
    stop = sorted({word for each in STOP_WORDS.values() for word in each})
    at = F.col(places)
    lengths = F.transform(at, lambda p, i: F.least(F.lit(3), F.coalesce(F.get(at, i + 1) - p, F.lit(3))))
    return placed.withColumns(
        {
            "n_words": n.cast("long"),
            "word_chars": F.length(F.array_join(w, "")).cast("long"),
            "n_symbols": F.regexp_count(filled, F.lit(SYMBOLS)).cast("long"),
            "n_dup_lines": (F.size(lines) - F.size(F.array_distinct(lines))).cast("long"),
            "n_repeat_words": F.aggregate(lengths, F.lit(0).cast("long"), lambda total, x: total + x),
            "n_lines": F.size(lines).cast("long"),
            "n_stop_words": F.size(F.filter(w, lambda x: F.lower(x).isin(stop))).cast("long"),
        }
    ).drop(words, lines, places, windows)


def _holds(rule: Rule) -> Column:
    value = F.col(rule.statistic)
    if rule.over:
        # Statistics over nothing count as zero.
        value = F.when(F.col(rule.over) > 0, value / F.col(rule.over)).otherwise(F.lit(0.0))
    kept = F.lit(True)
    if rule.least is not None:
        kept = kept & (value >= rule.least)
    if rule.most is not None:
        kept = kept & (value <= rule.most)
    return kept


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))


def judge(frame: DataFrame, text: str, rules: list[Rule] = RULES) -> DataFrame:
    """``frame`` with its statistics, ``base_failed``, ``kept`` and ``broken`` (names of rules not kept)."""
    measured = with_statistics(frame.drop(*(c for c in frame.columns if c.lower() in ("base_failed", "kept", "broken"))), text)
    broken = F.filter(
        F.array(*(F.when(~_holds(rule), F.lit(rule.name)) for rule in rules)), lambda name: name.isNotNull()
    )
    return measured.withColumns({"base_failed": base_failed(), "broken": broken}).withColumn(
        "kept", ~F.col("base_failed") & (F.size("broken") == 0)
    )
