"""Benchmark passages in documents, from a distributed positional inverted index.

Every document's words become postings (row, term, place), for the terms that the benchmark
holds, or for all. A phrase is looked up from its rarest term: that term's places, each less
the term's offset in the phrase, are the starts the phrase may have. The second rarest
term's list, adjusted the same way, cuts them down before the lists of the others do. What
all lists agree on is an exact match. With a slop, a term may lie so many words
off its place: a proximity match, with the largest distance as its ``spread``.

All of it is built-in functions: no Python worker runs. Postings are written once, and a row's
number exists only there, so nothing depends on numbering the input twice.

Words are runs of ASCII letters and digits and of any non-ASCII characters, A-Z lower-cased.

Defined results: a null or empty text has no words, matches nothing and has length 0. Rows are
told apart by place, not by id, so repeated and null ids are rows of their own. An item of
fewer words than a window is one window; one without words has none. Items without an id
hit words but are not listed; rows of one item id are one item. Other columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventmart.llm.runtime import materialise

WINDOW = 10
# Fixed value: what words are made of, before A-Z are lower-cased.
WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# The term of the posting that each row has at its end; no word is empty.
END = ""
# Rows with candidates are sent to all executors up to so many (8 bytes each).
BROADCAST_ROWS = 1_000_000


def lowered(word: Column) -> Column:
    """A-Z lower-cased and nothing else; most words have none."""
    return F.when(F.lower(word) == word, word).otherwise(F.translate(word, UPPER, LOWER))


def words(text: Column) -> Column:
    """The words of a text in order, not yet lower-cased."""
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(f"({WORD})"), F.lit(1))


@dataclass
class Index:
    """``terms`` (term, id, n: its postings) and ``postings`` (row, id, place)."""

    terms: DataFrame
    postings: DataFrame
    # One row a document row: row, key, n_words.
    rows: DataFrame


def build(docs: DataFrame, key: str, text: str, terms: DataFrame | None = None) -> Index:
    """Indexes every row's whole text.

    ``terms`` (a column ``term``) restricts what is stored to terms that will be asked
    for; without it every word is stored.
    """
    numbered = docs.select(F.col(key).alias("key"), F.monotonically_increasing_id().alias("row"), F.col(text).alias("text"))
    tokens = numbered.select(
        "key", "row", F.posexplode(F.concat(words(F.col("text")), F.array(F.lit(END)))).alias("place", "word")
    ).select("key", "row", "place", lowered(F.col("word")).alias("term"))
    if terms is None:
        terms = tokens.select("term")
    known = terms.select("term").where(F.col("term") != END).distinct()
    known = materialise(
        known.select("term", F.monotonically_increasing_id().alias("id")).unionByName(
            docs.sparkSession.range(1).select(F.lit(END).alias("term"), F.lit(-1).cast("long").alias("id"))
        ),
        "index-terms",
    )
    stored = materialise(
        tokens.join(known, "term").select(F.when(F.col("id") < 0, F.col("key")).alias("key"), "row", "id", "place"),
        "index-postings",
    )
    counted = materialise(stored.groupBy("id").agg(F.count("*").alias("n")), "index-counts")
    return Index(
        known.where("id >= 0").join(counted, "id").select("term", "id", "n"),
        stored.where("id >= 0").select("row", "id", "place"),
        stored.where("id < 0").select("row", "key", F.col("place").cast("long").alias("n_words")),
    )


def windows(items: DataFrame, key: str, text: str, width: int = WINDOW) -> DataFrame:
    """``item`` and ``phrase`` (terms joined by spaces) of every window, each once an item."""
    listed = items.select(F.col(key).alias("item"), F.transform(words(F.col(text)), lowered).alias("w")).where(F.size("w") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.size("w") - (width - 1), F.lit(1)))
    cut = listed.select("item", "w", F.explode(starts).alias("at"))
    return cut.select("item", F.array_join(F.slice("w", F.col("at"), F.lit(width)), " ").alias("phrase")).distinct()


def _ranked(index: Index, phrases: DataFrame) -> DataFrame:
    """Offsets of every phrase whose terms all occur: phrase, offset, id, rank (rarest first), size.

    A phrase that has a term the index lacks is left out.
    """
    cut = phrases.select("phrase", F.split("phrase", " ").alias("w"))
    each = cut.select("phrase", F.size("w").alias("size"), F.posexplode("w").alias("offset", "term"))
    order = Window.partitionBy("phrase").orderBy("n", "offset")
    found = each.join(index.terms, "term").withColumns(
        {"rank": F.row_number().over(order), "there": F.count("*").over(Window.partitionBy("phrase"))}
    )
    return found.where(F.col("there") == F.col("size")).select("phrase", "offset", "id", "rank", "size")


def _agreeing(starts: DataFrame, offsets: DataFrame, postings: DataFrame, slop: int) -> DataFrame:
    """Starts that the lists of all given offsets agree on, with the greatest distance of any."""
    wide = 2 * slop + 1  # a place's surroundings reach into two cells of this width at most
    asked = starts.join(offsets.select("phrase", "offset", "id"), "phrase").withColumn("want", F.col("start") + F.col("offset"))
    needed = offsets.groupBy("phrase").agg(F.count("*").alias("needed"))
    if slop:
        near = F.array_distinct(F.array(*(F.floor((F.col("want") + d) / wide) for d in (-slop, slop))))
        asked = asked.withColumn("cell", F.explode(near))
    else:
        asked = asked.withColumn("cell", F.col("want").cast("long"))
    lists = postings.select("row", "id", "place", F.floor(F.col("place") / wide).cast("long").alias("cell"))
    met = asked.join(lists, ["row", "id", "cell"]).withColumn("off", F.abs(F.col("place") - F.col("want"))).where(F.col("off") <= slop)
    nearest = met.groupBy("row", "phrase", "start", "spread", "offset").agg(F.min("off").alias("off"))
    agreed = nearest.groupBy("row", "phrase", "start", "spread").agg(F.count("*").alias("n"), F.max("off").alias("most"))
    return agreed.join(needed, "phrase").where(F.col("n") == F.col("needed")).select(
        "row", "phrase", "start", F.greatest("spread", "most").alias("spread")
    )


def _lists(postings: DataFrame, terms: DataFrame, purpose: str) -> DataFrame:
    """The postings of some terms, whose numbers are written so that Spark knows how few they are."""
    return postings.join(materialise(terms.select("id").distinct(), purpose), "id", "left_semi")


def matches(index: Index, phrases: DataFrame, slop: int = 0) -> DataFrame:
    """``row``, ``phrase``, ``start``, ``size`` and ``spread`` of all matches of the phrases.

    ``start`` is where the phrase begins if its rarest term is in place. With ``slop`` 0
    these are the exact matches, each once, with spread 0; otherwise every other term lies
    at most ``slop`` words off its place.
    """
    ranked = materialise(_ranked(index, phrases), "phrase-terms")
    rarest = ranked.where("rank = 1")
    starts = _lists(index.postings, rarest, "rarest-terms").join(rarest, "id").select(
        "row", "phrase", (F.col("place") - F.col("offset")).alias("start"), F.lit(0).alias("spread")
    )
    if not slop:
        starts = starts.where("start >= 0")
    second = ranked.where("rank = 2")
    single = starts.join(ranked.where("rank = 1 and size = 1").select("phrase"), "phrase")
    several = starts.join(second.select("phrase"), "phrase")
    lists = _lists(index.postings, second, "second-terms")
    pairs = materialise(_agreeing(several, second, lists, slop), "phrase-starts")
    rest = ranked.where("rank > 2")
    lists = index.postings
    rows = pairs.select("row").distinct()
    if rows.count() <= BROADCAST_ROWS:
        lists = lists.join(F.broadcast(rows), "row", "left_semi")
    short = pairs.join(ranked.where("rank = 2 and size = 2").select("phrase"), "phrase")
    long = _agreeing(pairs.join(rest.select("phrase").distinct(), "phrase"), rest, lists, slop)
    names = ["row", "phrase", "start", "spread"]
    whole = single.select(names).unionByName(short.select(names)).unionByName(long.select(names))
    return whole.join(rarest.select("phrase", "size"), "phrase")


def contamination(docs: DataFrame, key: str, text: str, items: DataFrame, item_key: str, item_text: str, width: int = WINDOW) -> DataFrame:
    """``key``, ``n_words``, ``n_hit``, ``items`` (sorted, as text) of every row of ``docs``."""
    cut = materialise(windows(items, item_key, item_text, width), "phrases")
    phrases = cut.select("phrase").distinct()
    index = build(docs, key, text, phrases.select(F.explode(F.split("phrase", " ")).alias("term")))
    found = materialise(matches(index, phrases), "phrase-matches")
    # A word lies in many windows of a passage: places are made distinct before they are counted.
    places = found.select("row", F.explode(F.sequence("start", F.col("start") + F.col("size") - 1)).alias("place"))
    hit = places.distinct().groupBy("row").agg(F.count("*").alias("n_hit"))
    pairs = found.select("row", "phrase").distinct().join(cut, "phrase").select("row", F.col("item").cast("string").alias("item"))
    named = pairs.distinct().groupBy("row").agg(F.sort_array(F.collect_list("item")).alias("items"))
    return (
        index.rows.join(hit, "row", "left")
        .join(named, "row", "left")
        .select(
            F.col("key").alias(key),
            "n_words",
            F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"),
            F.coalesce("items", F.array().cast("array<string>")).alias("items"),
        )
    )
