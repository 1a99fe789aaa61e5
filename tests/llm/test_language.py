"""Language identification against the plain way, with repeated ids and rare counts."""

import random

import pytest

from eventmart.llm import language
from tests.llm import brute

SCHEMA = "doc_id long, text string, lang string"
WORDS = {
    "en": "the river and a stone over fields of light birds sing dawn we sat there".split(),
    "fr": "le la rivière et une pierre sur les champs de lumière oiseaux chantent aube nous".split(),
    "xx": "zor kal tup wex yol brin quat the".split(),
}


def prose(chance, lang, n):
    return " ".join(chance.choice(WORDS[lang]) + chance.choice(["", "", ",", "."]) for _ in range(n))


def rows(chance):
    out = [(i, prose(chance, lang, chance.randrange(3, 40)), lang) for i, lang in enumerate(["en", "fr", "xx"] * 30)]
    out += [(7, "another text of seven", "fr"), (7, "les autres mots", "fr"), (8, "same id, other language", "en")]
    return out + [(None, "no id", "en"), (900, None, "en"), (901, "no language", None), (902, "12 34 !", "de")]


TEXTS = [None, "", "12 !", "the river", "la pierre", "stones riviera", "zork", "日本", "the la zor", "É", "ünknöwn wörds"]


@pytest.mark.parametrize("kept", [20_000, 6])
def test_predictions_are_those_of_plain_counting(spark, monkeypatch, kept):
    monkeypatch.setattr(language, "WORDS_PER_LANGUAGE", kept)
    monkeypatch.setattr(language, "GRAMS_PER_LANGUAGE", kept)
    training = rows(random.Random(kept))
    model = language.fit(spark.createDataFrame(training, SCHEMA).repartition(4), "doc_id", "text", "lang")
    table = spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS)], "doc_id long, text string")
    found = {r["doc_id"]: r["told"] for r in language.identify(table, "text", model, "told").collect()}
    wanted = brute.language_scores([(i, lang, t) for i, t, lang in training], TEXTS, kept, kept, language.SMOOTHING, language.MOST_AGAINST)
    assert [found[i]["lang"] for i in range(len(TEXTS))] == [lang for lang, _ in wanted]
    assert [found[i]["score"] for i in range(len(TEXTS))] == pytest.approx([score for _, score in wanted])


def test_ids_that_repeat_count_once(spark):
    chance = random.Random(1)
    few = [(i, prose(chance, "xx", 30), "xx") for i in range(6)]
    many = [(100 + i, prose(chance, "en", 30), "en") for i in range(200)]
    table = spark.createDataFrame(few, SCHEMA).selectExpr("*", "explode(sequence(1, 20000)) as n").drop("n")
    both = table.unionByName(spark.createDataFrame(many, SCHEMA))
    model = language.fit(both, "doc_id", "text", "lang")
    once = language.fit(spark.createDataFrame(few + many, SCHEMA), "doc_id", "text", "lang")
    assert model.languages == ["en", "xx"]
    assert model.words == once.words and (model.word_scores == once.word_scores).all()


def test_counts_of_kept_words_are_whole(spark):
    # "shared" is the most frequent word of one language and rare, but not unseen, in the other.
    table = [(1, "shared " * 50, "aa"), (2, "own " * 50 + "shared", "bb")]
    model = language.fit(spark.createDataFrame(table, SCHEMA), "doc_id", "text", "lang")
    place = model.words["shared"]
    seen, unseen = model.word_scores[place, 1], model.word_scores[model.words["own"], 0]
    assert seen - unseen > 2


def test_many_languages_and_very_long_texts_stay_bounded(spark, monkeypatch):
    monkeypatch.setattr(language, "MODEL_CELLS", 9 * 4)
    monkeypatch.setattr(language, "AT_ONCE", 50)
    monkeypatch.setattr(language, "MEMORY_BYTES", 1)
    training = rows(random.Random(3))
    model = language.fit(spark.createDataFrame(training, SCHEMA), "doc_id", "text", "lang")
    assert len(model.words) <= 4 * 3
    chance = random.Random(4)
    long = " ".join(f"{prose(chance, 'fr', 20)} mot{n}" for n in range(3_000))
    table = spark.createDataFrame([(1, long, "x", 0.5)], "doc_id long, text string, lang string, told double").drop("told")
    assert language.identify(table, "text", model, "told").first()["told"]["lang"] == "fr"
