"""The positional index against plain search."""

import random

import pytest

import __spark_entry__ as driver
from eventmart.llm import positional_index as index
from eventmart.llm import queries
from tests.compare import differences, oracle_connection
from tests.llm import brute

WORDS = "the of and river stone field light bird dawn é ß 日本 42 x1".split()


def prose(chance, n):
    return " ".join(chance.choice(WORDS).title() + chance.choice(["", "", ",", ". ", "\n"]) for _ in range(n))


def tables():
    chance = random.Random(4)
    items = [(i, prose(chance, chance.choice([3, 9, 10, 11, 25]))) for i in range(25)]
    items += [(100, None), (101, ""), (102, "., !"), (103, items[4][1]), (None, items[5][1]), (104, "the"), (4, "river river river")]
    passage = items[7][1]
    docs = [(i, prose(chance, chance.randrange(60))) for i in range(60)]
    docs += [(i, f"{prose(chance, 8)} {items[i % 25][1].upper() if i % 2 else items[i % 25][1]} {prose(chance, 5)}") for i in range(100, 140)]
    docs += [(200 + i, passage) for i in range(40)] + [(300, passage), (300, "other"), (300, "other"), (None, passage), (None, None), (301, "")]
    docs += [(302, prose(chance, 20_000) + passage + passage), (303, "river " * 500)]
    return docs, items


def test_every_hit_is_that_of_plain_search(spark):
    docs, items = tables()
    doc_table = spark.createDataFrame([(*d, 1, "x") for d in docs], "doc_id long, text string, place int, phrase string").repartition(3)
    item_table = spark.createDataFrame([(*i, 1) for i in items], "item_id long, text string, key int")
    found = index.contamination(doc_table, "doc_id", "text", item_table, "item_id", "text")
    order = lambda r: (r[0] is None, r[0] or 0, r[1:])
    assert sorted((tuple(r) for r in found.collect()), key=order) == sorted(brute.contamination(docs, items), key=order)


@pytest.mark.parametrize("docs, items", [([], [(1, "a b")]), ([(1, "a b")], []), ([], [])])
def test_empty_tables(spark, docs, items):
    found = index.contamination(
        spark.createDataFrame(docs, "doc_id long, text string"), "doc_id", "text",
        spark.createDataFrame(items, "item_id long, text string"), "item_id", "text",
    )
    assert [tuple(r) for r in found.collect()] == [(d, 2, 0, []) for d, _ in docs]


@pytest.mark.parametrize("slop", [0, 1, 3])
@pytest.mark.parametrize("rows", [0, 1_000_000])
def test_proximity_is_that_of_plain_search(spark, monkeypatch, slop, rows):
    monkeypatch.setattr(index, "BROADCAST_ROWS", rows)
    chance = random.Random(slop)
    docs = [(i, prose(chance, 40)) for i in range(40)]
    phrases = [" ".join(chance.choice(WORDS) for _ in range(n)) for n in (1, 2, 2, 3, 4, 4, 5)] + ["the of", "river stone river", "absent word"]
    built = index.build(spark.createDataFrame(docs, "doc_id long, text string"), "doc_id", "text")
    table = spark.createDataFrame([(p,) for p in phrases], "phrase string")
    found = index.matches(built, table, slop).join(built.rows, "row").select("key", "phrase", "start", "spread").collect()
    counts: dict[str, int] = {}
    for _, text in docs:
        for word in brute.terms(text):
            counts[word] = counts.get(word, 0) + 1
    wanted = set()
    for doc, text in docs:
        w = brute.terms(text)
        for phrase in phrases:
            p = phrase.split(" ")
            if any(x not in counts for x in p):
                continue
            anchor = min(range(len(p)), key=lambda i: (counts[p[i]], i))
            for at in (i - anchor for i, x in enumerate(w) if x == p[anchor]):
                off = [min((abs(i - at - k) for i, y in enumerate(w) if y == x), default=99) for k, x in enumerate(p)]
                off[anchor] = 0
                if max(off) <= slop:
                    wanted.add((doc, phrase, at, max(off)))
    assert {tuple(r) for r in found} == wanted and len(found) == len(wanted)


def test_no_python_worker_runs(spark):
    plan = queries.QUERIES["op13_positional_index"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "InPandas" not in plan


def test_query_equals_its_sql(spark):
    relation = oracle_connection("/root/testdata/sf0.01").sql(driver.oracle_sql()["op13_positional_index"])
    assert differences(queries.QUERIES["op13_positional_index"](spark, "/root/testdata/sf0.01"), relation) is None
