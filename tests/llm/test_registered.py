"""Registered queries against the libraries and plain scorers, over whole tables."""

import hashlib
import math
import random
import re
from pathlib import Path

import numpy as np
import pandas as pd
import public_tokenizers
import pytest
import tiktoken
from tokenizers import Tokenizer

from eventmart.llm import queries, quality_trees, rank_queue, toxicity
from tests.llm import brute

SF_DIR = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="no test data")


@pytest.fixture(scope="module")
def texts():
    table = pd.read_parquet(f"{SF_DIR}/documents.parquet")
    return dict(zip(table.doc_id, table.text))


@pytest.fixture(scope="module")
def ids(texts):
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    return {i: library.encode(text or "", add_special_tokens=False).ids for i, text in texts.items()}


def test_shards_hold_what_the_library_encodes(spark, ids):
    found = {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in queries.QUERIES["op4_token_shards"](spark, SF_DIR).collect()}
    wanted, start = {}, 0
    for key in sorted(ids):
        whole = [*ids[key], 0]
        wanted[key] = (start, len(whole), brute.crc32_of(whole))
        start += len(whole)
    assert found == wanted


def test_pieces_hold_what_the_library_encodes(spark, ids):
    found = queries.QUERIES["op7_packing"](spark, SF_DIR).toPandas().sort_values(["doc_id", "piece"])
    assert set(found.doc_id) == set(ids)
    for key, pieces in found.groupby("doc_id"):
        whole, start = [*ids[key], 2], 0
        assert pieces.piece.tolist() == list(range(len(pieces)))
        for piece in pieces.itertuples():
            assert piece.start == start and piece.ids_crc32 == brute.crc32_of(whole[start : start + piece.length])
            start += piece.length
        assert start == len(whole) and (pieces.length[1:] == 1_024).all()
        assert len(pieces) == -(-len(whole) // 1_024)
    for _, held in found.sort_values("offset").groupby("sequence_id"):
        assert held.offset.tolist() == [0, *held.length.cumsum()[:-1]] and held.length.sum() <= 1_024
    # No packing is smaller than what the tokens need; this one is hardly larger.
    least = -(-found.length.sum() // 1_024)
    assert least <= found.sequence_id.nunique() <= least + max(2, least // 50)


def test_rank_queue_encodes_as_the_library_does(spark, texts):
    ranks = rank_queue.load(public_tokenizers.path(rank_queue.RANKS))
    library = tiktoken.Encoding("test", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    found = {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in queries.QUERIES["op10_rank_queue_bpe"](spark, SF_DIR).collect()}
    for key, text in texts.items():
        wanted = library.encode_ordinary(text or "")
        packed = np.array(wanted, dtype="<u4").tobytes()
        digests = (hashlib.sha256(packed).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest())
        assert found[key] == (len(wanted), *digests)


def plain_toxicity(model: toxicity.ToxicityModel, text: str | None) -> tuple[float, list[tuple[int, int]]]:
    clean, places = 1.0, []
    for found in re.finditer(r"[^.!?\n]+", text or ""):
        words = re.findall(r"[^\W\d_]+", found.group().lower())
        if not words or not model.weights:
            continue
        margin = model.bias
        for word in words:
            for sign in [word, *(word[:n] + "*" for n in (3, 4, 5, 6) if len(word) >= n)]:
                margin += model.weights.get(sign, 0.0)
        chance = 1 / (1 + math.exp(-margin))
        clean *= 1 - min(chance, 1 - 1e-12)
        if chance >= 0.5:
            places.append(found.span())
    return 1 - clean, places


def test_toxicity_scores_are_those_of_plain_noisy_or(spark, texts):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text")
    model = queries.toxicity_model(docs, SF_DIR)
    chance = random.Random(2)
    long = [" ".join(chance.choice(list(model.weights) or ["word"]).rstrip("*") + chance.choice(["", "", ". "]) for _ in range(40_000)), "x" * 300_000]
    odd = spark.createDataFrame([(10_000 + i, t) for i, t in enumerate([None, "", "12 !", *long])], docs.schema)
    everything = texts | {10_000 + i: t for i, t in enumerate([None, "", "12 !", *long])}
    found = toxicity.rate(docs.unionByName(odd), "text", model, "found").collect()
    assert len(found) == len(everything)
    for row in found:
        score, places = plain_toxicity(model, everything[row["doc_id"]])
        assert row["found"]["score"] == pytest.approx(score, abs=1e-9)
        assert [(s["start"], s["end"]) for s in row["found"]["offending"]] == places


def test_quality_scores_are_those_of_slow_trees(spark, texts):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text")
    forest = queries.quality_model(docs, SF_DIR)
    long = ["word and " * 150_000, "\n" * 100_000, "é" * 200_000]
    table = docs.unionByName(spark.createDataFrame([(10_000 + i, t) for i, t in enumerate(long)], docs.schema))
    everything = texts | {10_000 + i: t for i, t in enumerate(long)}

    def walk(row, node):
        while forest.below[node] != node:
            node = forest.above[node] if row[forest.feature[node]] > forest.threshold[node] else forest.below[node]
        return forest.value[node]

    for row in quality_trees.rate(table, "text", forest, "score").collect():
        features = quality_trees.statistics((everything[row["doc_id"]] or "").encode())
        total = forest.prior + sum(walk(features, root) for root in forest.roots)
        assert row["score"] == pytest.approx(1 / (1 + math.exp(-total)))
