"""Pre-tokens, the rank queue, components and packing plans, without tables."""

import random

import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow as pa
import pytest
import regex
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from eventmart.llm import packing, rank_queue, simhash, warc
from eventmart.llm.byte_bpe import text_encoder, vocabulary_path
from eventmart.llm.components import components
from eventmart.llm.pretokens import BYTES_AT_ONCE
from eventmart.llm.runtime import own_columns, run_bounds, runs, text_bounds, text_slices
from tests.llm import brute

ODD_TEXTS = [
    "", " ", "  ", "\n", "a", " a", "a ", "a  b", "a\nb", "a\n\nb", "a \nb", "a\n b", "it's we'll I'd 'tis", "tab\there",
    "no break", " wide", "\x1cfile separator\x1f", "12 345,6", "émoji 😀 x", "日本語 テキスト", "a\r\nb", "<|endoftext|>",
    "x" * 500, "\n\n\n", "end\n", "é" * 80 + " done", "A.\nB c.\nD",
]
any_text = st.text(alphabet=st.sampled_from(list("aab'st .,\n\t é1#\r\x1c😀")), max_size=40)


@pytest.fixture(scope="module")
def library():
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    tokenizer.encode_special_tokens = True
    return tokenizer


@pytest.fixture(scope="module")
def ranks():
    return rank_queue.load(public_tokenizers.path(rank_queue.RANKS))


@pytest.fixture(scope="module")
def reference(ranks):
    return tiktoken.Encoding("test", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def ids_of(data: bytes) -> list[int]:
    return np.frombuffer(data, dtype="<u4").tolist()


@pytest.mark.parametrize("text", ODD_TEXTS)
def test_texts_encode_as_the_libraries_do(library, ranks, reference, text):
    assert ids_of(text_encoder(vocabulary_path()).encode(text)) == library.encode(text, add_special_tokens=False).ids
    words = rank_queue.Vocabulary(ranks)
    assert ids_of(words.encode(text)) == reference.encode_ordinary(text)
    assert words.decode(words.encode(text)) == text.encode()


def test_any_text(library, ranks, reference):
    words = rank_queue.Vocabulary(ranks)

    @settings(max_examples=400, deadline=None)
    @given(any_text)
    def check(text):
        assert ids_of(text_encoder(vocabulary_path()).encode(text)) == library.encode(text, add_special_tokens=False).ids
        assert ids_of(words.encode(text)) == reference.encode_ordinary(text)

    check()


def test_very_long_pretokens(ranks, reference):
    words = rank_queue.Vocabulary(ranks)
    letters = random.Random(1).choices("abcdefghie", k=60_000)
    for text in ("a" * 50_000, "".join(letters), "ab" * 20_000, "=" * 30_001):
        assert ids_of(words.encode(text)) == reference.encode_ordinary(text)


def test_forgetting_changes_nothing(library):
    from eventmart.llm.pretokens import TextEncoder

    small = TextEncoder(lambda p: library.encode(p, add_special_tokens=False).ids, size=3)
    text = "one two three four five, one two three.\nfour five six one two"
    assert ids_of(small.encode(text)) == library.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("start, size", [(0, 30), (3, 6), (5, 0), (11, 1)])
def test_a_batch_encodes_as_its_texts_do(library, ranks, reference, start, size):
    texts = [None, *ODD_TEXTS, "a b\nc", None]
    batch = pa.array(texts, pa.string()).slice(start, size)
    wanted = texts[start : start + size]
    found = text_encoder(vocabulary_path()).encode_all(batch)
    assert list(map(ids_of, found)) == [library.encode(x or "", add_special_tokens=False).ids for x in wanted]
    found = rank_queue.Vocabulary(ranks).encode_all(pd.Series(wanted, dtype=object))
    assert list(map(ids_of, found)) == [reference.encode_ordinary(x or "") for x in wanted]


def test_texts_are_cut_by_bytes():
    texts = pa.array(["a" * 4, None, "é" * 3, "", "b" * 50, "c", "d"])
    assert text_bounds(texts, 10) == [0, 3, 5, 7] and text_bounds(texts[:0], 10) == [0]
    batch = pa.RecordBatch.from_arrays([pa.array(range(7)), texts], names=["key", "text"])
    parts = list(text_slices(iter([batch, batch[:0]]), 1, 10))
    assert pa.Table.from_batches(parts).to_batches()[0].schema == batch.schema
    assert pa.Table.from_batches(parts).to_pylist() == batch.to_pylist()
    # Short texts are not cut by their number.
    assert text_bounds(pa.array(["few words"] * 2_000), BYTES_AT_ONCE) == [0, 2_000]


def test_rank_queue_gives_lowest_rank_then_leftmost_place():
    queue, chance = rank_queue.RankQueue(300_000), random.Random(5)
    waiting = [(chance.randrange(300_000) if i % 3 else 7, chance.randrange(1_000)) for i in range(2_000)]
    for rank, place in waiting:
        queue.push(rank, place)
    assert [queue.pop() for _ in waiting] == sorted(waiting)
    assert queue.pop() is None


def test_components_are_those_of_the_links(spark):
    chance = random.Random(3)
    links = [(chance.randrange(400), chance.randrange(400)) for _ in range(260)]
    links += [(i, i + 1) for i in range(1_000, 1_060)] + [(2_000, 2_000 + i) for i in range(1, 200)]
    links += [(5, 5), (1_001, 1_000), (None, 3)]
    found = components(spark.createDataFrame(links, "a long, b long"), "a", "b").collect()
    whole = [(a, b) for a, b in links if a is not None]
    roots = brute.united(2_300, whole)
    touched = {x for link in whole if link[0] != link[1] for x in link}
    assert {row["node"]: row["root"] for row in found} == {x: roots[x] for x in touched}
    assert len(found) == len(touched)


def test_components_of_no_links(spark):
    assert components(spark.createDataFrame([], "a string, b string"), "a", "b").collect() == []


def test_runs_stay_whole():
    keys = [1, 1, 2, 3, 3, 3, 3, 4, 5, 5]
    batches = [pa.RecordBatch.from_pydict({"k": keys[i:j]}) for i, j in ((0, 2), (2, 2), (2, 5), (5, 6), (6, 10))]
    tables = [t.column("k").to_pylist() for t in runs(iter(batches), "k")]
    assert [x for t in tables for x in t] == keys
    assert all(a[-1] != b[0] for a, b in zip(tables, tables[1:]))
    assert run_bounds(np.array(keys)).tolist() == [0, 2, 3, 7, 8, 10]


def test_own_columns(spark):
    assert own_columns(spark.range(1).selectExpr("id _X", "id _x_"), "_x", "y") == ["_x__", "y"]


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(1, 32), st.integers(1, 40), max_size=32))
def test_every_length_is_packed_once_and_no_sequence_overflows(counts):
    used: dict[int, int] = {}
    sequences = 0
    for pattern, times in packing.patterns(counts, 32):
        assert sum(pattern) <= 32 and times > 0
        sequences += times
        for length in pattern:
            used[length] = used.get(length, 0) + times
    assert used == counts
    total = sum(length * n for length, n in counts.items())
    assert -(-total // 32) <= sequences <= max(1, 2 * total // 32 + 1)


def test_exact_complements_are_found():
    assert sorted(packing.patterns({20: 2, 12: 1, 7: 1, 5: 1}, 32)) == [([20, 7, 5], 1), ([20, 12], 1)]
    assert packing.patterns({16: 4}, 32) == [([16, 16], 2)]
    assert packing.patterns({}, 32) == []


def test_pieces_of_a_document():
    ids = np.arange(10, dtype="<u4").tobytes()
    assert [(p, s, n) for p, s, n, _ in packing.cut(ids, 4)] == [(0, 0, 2), (1, 2, 4), (2, 6, 4)]
    assert [(p, s, n) for p, s, n, _ in packing.cut(ids[:32], 4)] == [(0, 0, 4), (1, 4, 4)]
    assert list(packing.cut(b"", 4)) == []


def test_blocks_of_fingerprints_reach_what_pairs_reach():
    chance = random.Random(2)
    centre = [chance.getrandbits(64) for _ in range(3)]
    fps = sorted({c ^ sum(1 << chance.randrange(64) for _ in range(chance.randrange(5))) for c in centre for _ in range(40)})
    signed = np.array(fps, dtype=np.uint64).view(np.int64)
    nodes, roots = simhash.block_links(signed, signed)
    place = {int(x): i for i, x in enumerate(signed)}
    linked = brute.united(len(fps), [(place[int(a)], place[int(b)]) for a, b in zip(nodes, roots)])
    assert linked == brute.united(len(fps), brute.simhash_links(fps))


def test_fingerprints_follow_the_definition():
    for text in (None, "", " \t\n", "one", "One two", "a b c d", "a b c d e", "Ünï ÇÖDE x y z", "w " * 70_000, "a b c\x1cd e f"):
        assert simhash.fingerprint(None if text is None else text.encode()) % (1 << 64) == brute.simhash(text)


@settings(max_examples=100, deadline=None)
@given(st.binary(max_size=200), st.integers(1, 50))
def test_chunked_framing_round_trip(data, size):
    assert warc.unchunked(warc.chunked(data, size)) == data


@pytest.mark.parametrize("bad", [b"", b"5\r\nabc\r\n0\r\n\r\n", b"3\r\nabc\r\n", b"zz\r\n"])
def test_damaged_framing_is_told(bad):
    with pytest.raises(ValueError):
        warc.unchunked(bad)


def test_the_pattern_cuts_as_published():
    published = regex.compile(public_tokenizers.PATTERN)
    from eventmart.llm.pretokens import PATTERN

    for text in ODD_TEXTS:
        if not any(c in text for c in "\x1c\x1f"):
            assert regex.findall(PATTERN, text) == published.findall(text)
