"""Conversation repair against the plain dynamic programme over the grammar's states."""

import random
from pathlib import Path

import pandas as pd
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from eventmart.llm import queries, turn_repair
from tests.llm import brute

SF_DIR = "/root/testdata/sf0.001"
SCHEMA = "conv_id long, turn long, role string, text string"
CODES = {"s": ("system", None), "u": ("user", None), "a": ("assistant", None), "o": ("tool", None)}


def plain(codes: str) -> list[tuple]:
    """Turns that bear the given codes."""
    out = []
    for i, code in enumerate(codes):
        if code == "x":
            out.append((i, "user", " "))
        else:
            out.append((i, CODES[code.lower()][0], f"text {i}" + ("" if code.isupper() else ".")))
    return out


@settings(max_examples=400, deadline=None)
@given(st.text("suaoSUAOx", max_size=14))
def test_alignment_is_the_cheapest_and_least(codes):
    wanted = brute.conversation(plain(codes))
    assert turn_repair.repair(codes) == (wanted["cost"], wanted["audit"])


@pytest.mark.parametrize("size", [1, 2, 3, 7])
def test_blocks_change_nothing(monkeypatch, size):
    chance = random.Random(size)
    monkeypatch.setattr(turn_repair, "BLOCK", size)
    for _ in range(60):
        codes = "".join(chance.choices("suaoSUAOx", [1, 8, 8, 1, 1, 2, 2, 1, 2], k=chance.randrange(30)))
        wanted = brute.conversation(plain(codes))
        assert turn_repair.repair(codes) == (wanted["cost"], wanted["audit"])


def test_band_is_left_out_above_the_incumbent():
    assert turn_repair.aligned("uaua", "ua", 5) is None
    assert turn_repair.aligned("uaua", "ua", 6) == (6, "DDKK")
    assert turn_repair.aligned("", "uaua", 8) == (8, "IIII")


def rows_of(spark, name, sf_dir):
    return {None if pd.isna(r.conv_id) else r.conv_id: r for r in queries.QUERIES[name](spark, sf_dir).toPandas().itertuples()}


def check(found, rows):
    wanted = brute.damaged_turns(rows)
    assert found.keys() == wanted.keys()
    for conv, turns in wanted.items():
        told = brute.conversation(turns)
        assert {k: getattr(found[conv], k) for k in told} == told, conv


@pytest.mark.skipif(not Path(SF_DIR).exists(), reason="no test data")
def test_query_over_the_smallest_table(spark):
    table = pd.read_parquet(f"{SF_DIR}/conversations.parquet")
    check(rows_of(spark, "op11_turn_repair", SF_DIR), list(table[["conv_id", "turn", "role", "text"]].itertuples(index=False, name=None)))


def odd_rows():
    chance = random.Random(8)
    roles = ["user", "assistant", "user", "assistant", "system", None, "tool", ""]
    rows = [(conv, turn, chance.choice(roles), chance.choice(["Yes.", "No", None, "", "\t", "Why?", f"Turn {turn}!"])) for conv in range(40) for turn in range(chance.randrange(9))]
    rows += [(None, None, None, None), (None, 3, "user", "Hi."), (1, None, "user", "First."), (1, None, "assistant", "Second.")]
    rows += [(2, 4, "user", "Twice."), (2, 4, "user", "Twice."), (3, 9, "assistant", "word " * 50_000 + "end.")]
    # A conversation with most of the rows, cut by the ranges of several tasks.
    rows += [(77, turn, "user" if turn % 2 else "assistant", f"Line {turn % 400}" + "." * (turn % 5 > 0)) for turn in range(1_500)]
    return rows


def test_odd_rows_and_a_hot_conversation(spark, tmp_path):
    rows = odd_rows()
    table = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA + ", place string, fault int").coalesce(1)
    table.write.parquet(f"{tmp_path}/conversations.parquet")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "7")
    try:
        marked = turn_repair.mark(queries.damaged(table), "conv_id", "turn", "role", "text")
        assert turn_repair.align(marked).count()
        check(rows_of(spark, "op11_turn_repair", str(tmp_path)), rows)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_repaired_turns_read_as_the_grammar_says(spark):
    table = spark.createDataFrame([r for r in odd_rows() if r[0] != 77], SCHEMA)
    marked = turn_repair.mark(table, "conv_id", "turn", "role", "text")
    kept = turn_repair.repaired(marked, turn_repair.align(marked)).toPandas()
    for _, turns in kept.sort_values("number").groupby("conv_key"):
        read = "".join(x[:1] for x in turns.role)
        read = read.removeprefix("s")
        assert read and read == "ua" * (len(read) // 2)
        assert turns.number.tolist() == list(range(len(turns)))
        assert (turns[turns.edit == "I"].text == "").all()


def test_empty_table(spark, tmp_path):
    spark.createDataFrame([], SCHEMA).write.parquet(f"{tmp_path}/conversations.parquet")
    assert queries.QUERIES["op11_turn_repair"](spark, str(tmp_path)).count() == 0
