"""Every operator against brute force, on hand-made rows with nulls, ties, repeats and odd columns."""

import os
import random

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from eventmart.llm import embeddings, language, packing, quality_rules, quality_trees, rank_queue, simhash, token_shards, toxicity, warc
from eventmart.llm.runtime import materialise
from eventmart.session import fresh_folder
from tests.llm import brute

WORDS = "the river and a stone over fields of quiet light with many small birds that sing at dawn".split()


def prose(seed: int, n: int) -> str:
    chance = random.Random(seed)
    return " ".join(chance.choice(WORDS) + (chance.choice([".", ",", ".\n"]) if chance.random() < 0.1 else "") for _ in range(n))


TEXTS = {
    0: None,
    1: "",
    2: "  \n\t ",
    3: "one two three",
    4: prose(1, 60),
    5: prose(1, 60),
    6: prose(1, 60).replace("river", "River"),
    7: prose(2, 3_000),
    8: "same line\nsame line\n\nsame line \nother",
    9: "a b c a b c a b c x y z",
    10: "#*$%&|<> " * 30,
    11: "tab\tand space\x0bhere",
    12: "x" * 5_000,
    13: prose(3, 80) + "\n" + prose(3, 80),
    14: "é ü ß " * 40,
}


def frame(spark, rows, schema="doc_id long, text string"):
    return spark.createDataFrame(rows, schema)


@pytest.fixture(scope="module")
def docs(spark):
    return frame(spark, list(TEXTS.items()))


@pytest.fixture(scope="module")
def library():
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    tokenizer.encode_special_tokens = True
    return tokenizer


def empty(spark):
    return frame(spark, [])


# SimHash


def test_simhash_groups_are_brute_force(spark, docs):
    marked = simhash.with_fingerprint(docs, "text", "fp")
    found = simhash.group(marked, "doc_id", "fp", "group").collect()
    assert {r["doc_id"]: r["fp"] % (1 << 64) for r in found} == {i: brute.simhash(t) for i, t in TEXTS.items()}
    assert {r["doc_id"]: r["group"] for r in found} == brute.simhash_groups(TEXTS)


@pytest.mark.parametrize("crowded", [1, 1_024])
def test_near_links_in_crowded_buckets_too(spark, monkeypatch, crowded):
    monkeypatch.setattr(simhash, "CROWDED", crowded)
    monkeypatch.setattr(simhash, "BLOCK", 7)
    chance = random.Random(11)
    centres = [chance.getrandbits(64) for _ in range(12)]
    fps = {c for c in centres}
    for c in centres[:6]:
        fps |= {c ^ sum(1 << b for b in chance.sample(range(64), chance.randrange(1, 6))) for _ in range(25)}
    fps = sorted(fps)
    signed = [x - (1 << 64) if x >> 63 else x for x in fps]
    links = simhash.near_links(frame(spark, [(x,) for x in signed], "fp long"), "fp").collect()
    place = {x: i for i, x in enumerate(signed)}
    pairs = [(place[r["a"]], place[r["b"]]) for r in links]
    wanted = brute.simhash_links(fps)
    assert brute.united(len(fps), pairs) == brute.united(len(fps), wanted)
    if crowded > 1:
        assert {(min(p), max(p)) for p in pairs} == set(wanted)


@pytest.mark.parametrize("crowded", [40, 1_024])
def test_exploded_fingerprints_are_not_broadcast(spark, monkeypatch, crowded):
    monkeypatch.setattr(simhash, "CROWDED", crowded)
    chance = random.Random(5)
    near = [chance.getrandbits(38) << 26 for _ in range(60)]  # alike in two segments: a crowded bucket above 40
    fps = [(x,) for x in near + [chance.getrandbits(63) for _ in range(600)]]
    table = materialise(frame(spark, [(x - (1 << 64) if x >> 63 else x,) for (x,) in fps], "fp long"), "fps")
    plan = simhash.near_links(table, "fp")._jdf.queryExecution().executedPlan().toString().splitlines()
    depths = [len(line) - len(line.lstrip(" :+-")) for line in plan]
    sent = []
    for at, line in enumerate(plan):
        if "BroadcastExchange" in line:
            below = next((i for i in range(at + 1, len(plan)) if depths[i] <= depths[at]), len(plan))
            sent += plan[at + 1 : below]
    assert any("explode" in line for line in plan)
    # Sums over exploded rows are small; the rows themselves are not.
    assert not any("explode" in line for line in sent)


def test_deduplicate_keeps_one_row_a_group(spark):
    rows = [
        (5, prose(1, 60), "a"), (3, prose(1, 60), "b"), (3, prose(1, 60), "b"), (9, prose(4, 90), "c"),
        (None, prose(4, 90), "d"), (None, prose(5, 70), "e"), (None, prose(5, 70), "e"), (7, None, "f"), (8, "", "g"), (3, prose(6, 50), "h"),
    ]
    table = frame(spark, rows, "doc_id long, text string, _fingerprint string")
    kept = simhash.deduplicate(table, "doc_id", "text")
    assert kept.columns == table.columns
    assert sorted(r["_fingerprint"] for r in kept.collect()) == ["b", "c", "e", "f", "h"]
    assert simhash.deduplicate(empty(spark), "doc_id", "text").collect() == []


# Quality rules


def test_rule_statistics_are_brute_force(spark, docs):
    for row in quality_rules.judge(docs, "text").collect():
        wanted = brute.rule_statistics(TEXTS[row["doc_id"]])
        assert {k: row[k] for k in wanted} == wanted, row["doc_id"]
        failed = wanted["n_words"] < 50 or 100 * wanted["n_repeat_words"] > 50 * wanted["n_words"]
        assert row["base_failed"] == failed
        assert row["kept"] == (not row["broken"])
        assert not (failed and row["kept"])


def test_rules_name_what_is_broken_and_keep_other_columns(spark):
    rows = [(None, prose(1, 300), 7), (1, "#*$ the " * 100, 8), (1, "#*$ the " * 100, 8)]
    table = frame(spark, rows, "doc_id long, text string, _words int").selectExpr("*", "'old' as kept")
    found = quality_rules.judge(table, "text").collect()
    assert [r["_words"] for r in found] == [7, 8, 8]
    assert found[1]["broken"] == found[2]["broken"] and "symbols" in found[1]["broken"]
    assert quality_rules.judge(empty(spark), "text").collect() == []


# Token shards


def shards(spark, table):
    root = token_shards.make_folder(spark, fresh_folder(spark, "shards"))
    form = token_shards.sample_format(table, "doc_id", "text")
    return token_shards.write(table, "doc_id", "text", root, form), root, form


def test_shards_round_trip(spark, docs, library, monkeypatch):
    manifest, root, form = shards(spark, docs)
    found = {r["key"]: r for r in token_shards.read(manifest, root, form).collect()}
    start = 0
    for key in sorted(TEXTS):
        ids = library.encode(TEXTS[key] or "", add_special_tokens=False).ids + [0]
        row = found[key]
        assert (row["start"], row["n_tokens"], row["ids_crc32"]) == (start, len(ids), brute.crc32_of(ids))
        start += len(ids)
    shard = manifest.collect()[0]
    reader = token_shards.ShardReader(root, shard["path"], form)
    place = reader.index.to_pylist()[-1]
    assert reader.ids(place["offset"], place["size"]).tolist() == library.encode(TEXTS[place["key"]]).ids + [0]
    with pytest.raises(ValueError, match="dictionary"):
        token_shards.ShardReader(root, shard["path"], token_shards.Format(form.width, b"other"))


def test_shards_of_a_trained_dictionary_with_repeats_and_nulls(spark):
    rows = [(i % 150, prose(i, 120), "x") for i in range(300)] + [(None, None, "y"), (None, "z", "y")]
    table = frame(spark, rows, "doc_id long, text string, key string")
    manifest, root, form = shards(spark, table)
    assert form.dictionary
    found = token_shards.read(manifest, root, form).collect()
    assert len(found) == len(rows)
    ordered = sorted(found, key=lambda r: r["start"])
    assert [r["key"] for r in ordered] == [None, None, *sorted(i for i, _, _ in rows if i is not None)]
    assert all(a["start"] + a["n_tokens"] == b["start"] for a, b in zip(ordered, ordered[1:]))


def test_a_folder_of_shards_stands_alone(spark):
    table = frame(spark, [(i, prose(i, 120)) for i in range(300)])
    manifest, root, form = shards(spark, table)
    wanted = sorted(token_shards.read(manifest, root, form).collect())
    other = spark.newSession()
    there, known = token_shards.open_folder(other, root)
    assert known == form and form.dictionary and sorted(token_shards.read(there, root, known).collect()) == wanted
    # Written again over what lies there, as a second attempt would.
    token_shards.write(table, "doc_id", "text", root, form)
    assert sorted(token_shards.read(*_opened(other, root)).collect()) == wanted
    (name,) = [f for f in os.listdir(root.removeprefix("file:")) if f.startswith("dictionary-")]
    with open(f"{root.removeprefix('file:')}/{name}", "wb") as out:
        out.write(b"damaged")
    with pytest.raises(ValueError, match="another dictionary"):
        token_shards.open_folder(other, root)


def _opened(session, root):
    manifest, form = token_shards.open_folder(session, root)
    return manifest, root, form


MARKED = ["a <|endoftext|> b", "<|endoftext|>", "x\n<|endoftext|><|endoftext|> y  ", "<|endoftext| >", "<|endoftext|>é" * 300]


def test_added_tokens_inside_texts_are_those_of_the_library(spark):
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    table = frame(spark, list(enumerate(MARKED)))
    wanted = [library.encode(text, add_special_tokens=False).ids for text in MARKED]
    assert wanted[0] == [64, 220, 50256, 275]
    manifest, root, form = shards(spark, table)
    start = 0
    for row, ids in zip(sorted(token_shards.read(manifest, root, form).collect()), wanted):
        assert (row["start"], row["n_tokens"], row["ids_crc32"]) == (start, len(ids) + 1, brute.crc32_of([*ids, 0]))
        start += len(ids) + 1
    for row in packing.pack(table, "doc_id", "text", capacity=64).collect():
        ids = [*wanted[row["doc_id"]], 2]
        assert row["ids_crc32"] == brute.crc32_of(ids[row["start"] : row["start"] + row["length"]])
    assert packing.pieces(table, "doc_id", "text").groupBy().sum("length").first()[0] == start


def test_no_documents_make_no_shards(spark):
    manifest, root, form = shards(spark, empty(spark))
    assert manifest.collect() == [] and token_shards.read(manifest, root, form).collect() == []


# WARC


def archived(spark, rows, segment_bytes=warc.SEGMENT_BYTES):
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, _digest string")
    root = token_shards.make_folder(spark, fresh_folder(spark, "warc"))
    archives = warc.write(pages, "page_id", "url", "html", root, segment_bytes)
    return warc.read(archives, root), archives, root


@pytest.mark.parametrize("segment_bytes", [100, 64 << 10])
def test_pages_come_back_from_archives(spark, segment_bytes):
    html = {4: "<p>same</p>", 2: "<p>same</p>", 9: None, 11: "", 7: "ü" * 9_000, 8: "ü" * 9_000, 1: prose(1, 20_000), 30: "a\r\n\r\nb"}
    rows = [(i, "http://example.com/a b\nc" if i % 2 else None, h, "old") for i, h in html.items()]
    found, _, _ = archived(spark, rows, segment_bytes)
    got = {r["page_id"]: tuple(r)[1:] for r in found.collect()}
    assert got == brute.pages(html)


def test_ids_of_any_letters(spark):
    ids = ["a:b", "a", "", "=", "x\r\ny", "é %41", "<urn:page:x>", ":", None]
    rows = [(i, "u", f"<p>{(i or 'none')[:1]}</p>" * 900) for i in ids]
    root = token_shards.make_folder(spark, fresh_folder(spark, "warc"))
    pages = spark.createDataFrame(rows, "page_id string, url string, html string")
    found = warc.read(warc.write(pages, "page_id", "url", "html", root), root, "string").collect()
    assert {r["page_id"] for r in found} == set(ids) and len(found) == len(ids)
    assert {r["page_id"]: r["refers_to"] for r in found if r["record_type"] == "revisit"} == {"a:b": "a", None: ""}


def test_real_pages_are_segmented(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet").select("page_id", "url", "html")
    root = token_shards.make_folder(spark, fresh_folder(spark, "warc"))
    archives = warc.write(pages, "page_id", "url", "html", root)
    parts = warc._read(archives, root)
    assert parts.where("record_type = 'continuation'").count() > 50
    assert warc.read(archives, root).count() == pages.count()
    # Without one continuation record, its page is told.
    lost = parts.where("not (segment > 1 and total is not null)").where("origin is not null")
    with pytest.raises(Exception, match="are missing"):
        warc._rejoined(lost).collect()


def test_pages_that_repeat_and_pages_without_an_id(spark):
    rows = [(3, "u", "x", ""), (3, "u", "x", ""), (5, "u", "x", ""), (None, "u", "x", ""), (None, "u", "y", ""), (None, "u", "y", "")]
    found, _, _ = archived(spark, rows)
    kinds = sorted((r["page_id"] or -1, r["record_type"], r["refers_to"] or -1, r["payload_bytes"]) for r in found.collect())
    assert kinds == [
        (-1, "response", -1, 1), (-1, "revisit", -1, 1), (-1, "revisit", 3, 1),
        (3, "response", -1, 1), (3, "revisit", 3, 1), (5, "revisit", 3, 1),
    ]


def test_no_pages(spark):
    assert archived(spark, [])[0].collect() == []


def test_missing_segments_are_told(spark):
    record = warc.page_record(1, "u", b"a" * 500, warc.base32_sha1(b"a" * 500), "response", None, "0.0")
    parts = list(warc.segments(record, 100))
    assert [p.fields[warc.TYPE] for p in parts[1:]] == ["continuation"] * (len(parts) - 1)
    rows = [warc._row(p) for p in parts if p.fields[warc.SEGMENT] != "3"]
    names = warc._ARROW_READ.names
    table = spark.createDataFrame([tuple(row.get(name) for name in names) for row in rows], warc.READ)
    with pytest.raises(Exception, match="are missing"):
        warc._rejoined(table).collect()


def test_damaged_archives_are_told():
    import io

    whole = warc.Record({warc.TYPE: "resource", warc.RECORD_ID: "<urn:x:1:>"}, b"block").encoded()
    assert [r.block for r in warc.records(io.BytesIO(whole + whole))] == [b"block", b"block"]
    with pytest.raises(ValueError):
        list(warc.records(io.BytesIO(whole + whole[:-9])))


# Embeddings


def test_embedding_links_are_brute_force(spark, monkeypatch):
    chance = np.random.default_rng(4)
    centres = chance.standard_normal((30, 16))
    vectors = [c + 0.12 * chance.standard_normal(16) for c in centres for _ in range(6)]
    vectors += [centres[0] + 0.05 * chance.standard_normal(16) for _ in range(60)] + [centres[1]] * 20
    values = [[float(np.float32(x)) for x in v] for v in vectors]
    values += [None, [], [0.0] * 16, [float("nan")] + [1.0] * 15, [float("inf")] + [1.0] * 15, [None] + [1.0] * 15]
    values += [[2.0, 0.0], [1.0, 0.0], [1e-30, 0.0], [0.0, 1.0]]
    for block in (512, 9):
        monkeypatch.setattr(embeddings, "BLOCK", block)
        rows = [(1_000 - i, v, "c") for i, v in enumerate(values)]
        table = frame(spark, rows, "vec_id long, embedding array<float>, node string")
        order = sorted(range(len(rows)), key=lambda i: rows[i][0])
        single = [None if v is None else [None if x is None else float(np.float32(x)) for x in v] for v in values]
        links = brute.vector_links([single[i] for i in order])
        roots = brute.united(len(order), links)
        degree = np.bincount([x for link in links for x in link], minlength=len(order))
        wanted = {rows[i][0]: (int(degree[k]), rows[order[roots[k]]][0]) for k, i in enumerate(order)}
        found = embeddings.near_duplicates(table, "vec_id", "embedding").collect()
        assert {r["vec_id"]: (r["n_links"], r["component_id"]) for r in found} == wanted
        assert all(r["kept"] == (r["vec_id"] == r["component_id"]) for r in found)


def test_embeddings_of_nothing_and_without_ids(spark):
    schema = "vec_id long, embedding array<float>"
    assert embeddings.near_duplicates(frame(spark, [], schema), "vec_id", "embedding").collect() == []
    rows = [(None, [1.0, 0.0]), (None, [1.0, 0.0]), (2, [1.0, 0.01]), (2, [1.0, 0.01]), (None, [0.0, 1.0])]
    found = embeddings.near_duplicates(frame(spark, rows, schema), "vec_id", "embedding").collect()
    assert sorted((r["vec_id"] or 0, r["n_links"], r["component_id"] or 0) for r in found) == [
        (0, 0, 0), (0, 3, 2), (0, 3, 2), (2, 3, 2), (2, 3, 2)]


def test_links_in_a_hot_cone_are_brute_force(spark):
    chance = np.random.default_rng(7)
    axis = np.eye(64)[0]
    aside = chance.standard_normal((50_000, 64)) * (np.arange(64) > 0)
    aside /= np.linalg.norm(aside, axis=1)[:, None]
    vectors = np.concatenate([np.sqrt(0.9) * axis + np.sqrt(0.1) * aside, chance.standard_normal((3_000, 64))])
    units = vectors / np.linalg.norm(vectors, axis=1)[:, None]
    pairs = []
    for start in range(0, len(units), 2_000):
        a, b = np.nonzero(units[start : start + 2_000] @ units.T >= embeddings.THRESHOLD)
        pairs += [(int(i) + start, int(j)) for i, j in zip(a, b) if i + start < j]
    degree = np.bincount(np.array(pairs).ravel(), minlength=len(units))
    wanted = dict(enumerate(zip(degree.tolist(), brute.united(len(units), pairs))))
    table = frame(spark, list(enumerate(vectors.tolist())), "vec_id long, embedding array<double>")
    found = embeddings.near_duplicates(table, "vec_id", "embedding").collect()
    assert len(pairs) > 10_000
    assert {r["vec_id"]: (r["n_links"], r["component_id"]) for r in found} == wanted


def test_dense_passes_meet_whole_buckets_in_blocks(spark, monkeypatch):
    chance = np.random.default_rng(8)
    topics = chance.standard_normal((5, 16))
    rows = [(i, (topics[i % 5] + 0.3 * chance.standard_normal(16)).tolist()) for i in range(600)]
    links = brute.vector_links([v for _, v in rows])
    roots = brute.united(len(rows), links)
    degree = np.bincount([x for link in links for x in link], minlength=len(rows))
    wanted = {i: (int(degree[i]), roots[i]) for i, _ in rows}
    monkeypatch.setattr(embeddings, "CROWDED", 3)
    monkeypatch.setattr(embeddings, "DENSE_BLOCK", 20)
    for signs in (0, 4):
        monkeypatch.setattr(embeddings, "dense_signs", lambda *_: signs)
        found = embeddings.near_duplicates(frame(spark, rows, "vec_id long, embedding array<double>"), "vec_id", "embedding")
        assert {r["vec_id"]: (r["n_links"], r["component_id"]) for r in found.collect()} == wanted


def test_dense_prefix_follows_the_sample():
    chance = np.random.default_rng(9)
    topics = np.repeat(chance.standard_normal((200, 64)), 5, axis=0)
    units = [v / np.linalg.norm(v) for v in topics + 0.3 * chance.standard_normal(topics.shape)]
    one = [v / np.linalg.norm(v) for v in topics[0] + 0.3 * chance.standard_normal(topics.shape)]
    assert embeddings.dense_signs(one, 20_000) == 0
    assert embeddings.dense_signs(units, 2_000_000) > 0
    assert embeddings.passes_needed(0) == 1


# Packing


def test_packing_places_every_piece(spark, docs, library):
    table = docs.unionByName(frame(spark, [(None, prose(8, 40)), (4, TEXTS[4])])).selectExpr("*", "1 as length", "2 as rank")
    found = packing.pack(table, "doc_id", "text", capacity=64).collect()
    texts = [*TEXTS.items(), (None, prose(8, 40)), (4, TEXTS[4])]
    tokens = {}
    for key, text in texts:
        tokens.setdefault(key, []).append(library.encode(text or "").ids + [2])
    total = 0
    for key, each in tokens.items():
        ids = each[0]
        total += len(ids) * len(each)
        pieces = [r for r in found if r["doc_id"] == key]
        assert len(pieces) == len(each) * -(-len(ids) // 64)
        for r in pieces:
            assert r["ids_crc32"] == brute.crc32_of(ids[r["start"] : r["start"] + r["length"]])
            assert r["length"] == 64 or r["piece"] == 0
    by = {}
    for r in found:
        by.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for places in by.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= 64
    assert len(by) <= -(-total // 64) + 3


def test_packing_nothing(spark):
    assert packing.pack(empty(spark), "doc_id", "text").collect() == []


def test_ranks_need_no_whole_length_in_one_place(spark, monkeypatch):
    monkeypatch.setattr(packing, "PIECES_PER_BUCKET", 10)
    rows = [(i, 0, 0, 5 + i % 2, 0) for i in range(200)]
    ranked = packing._ranked(frame(spark, rows, "key long, piece int, start long, length long, ids_crc32 long")).collect()
    for length in (5, 6):
        assert sorted(r["rank"] for r in ranked if r["length"] == length) == list(range(100))


# BPE


def test_bpe_round_trip(spark, docs):
    words = rank_queue.Vocabulary(rank_queue.load(public_tokenizers.path(rank_queue.RANKS)))
    table = docs.selectExpr("*", "1 as ids_")
    found = rank_queue.decode(rank_queue.encode(table, "text", "ids"), "ids", "bytes").collect()
    for row in found:
        assert bytes(row["ids"]) == words.encode(row["text"])
        assert bytes(row["bytes"]) == (row["text"] or "").encode()
    assert rank_queue.digests(empty(spark), "text", "found").collect() == []


# Classifiers


def labelled(n: int) -> list[tuple]:
    """Clean prose, and prose with one sentence that holds an insult."""
    rows = []
    for i in range(n):
        bad = i % 4 == 0
        text = prose(i, 50) + (". You vilewort" + "abcdefgh"[i % 8] + " thing. " if bad else ". ") + prose(i + n, 20)
        rows.append((i, text, int(bad)))
    return rows


def test_toxicity_learns_from_documents_and_finds_the_sentence(spark):
    rows = labelled(240)
    table = frame(spark, rows, "doc_id long, text string, toxic int")
    # Shadowed names, a null label, a null key and a repeated row change nothing.
    marks = table.selectExpr("doc_id", "toxic").unionByName(frame(spark, [(1, None), (None, 1), (2, 0)], "doc_id long, toxic int"))
    model = toxicity.fit(table.where("doc_id < 160").drop("toxic"), "doc_id", "text", marks, "doc_id", "toxic")
    found = toxicity.rate(table, "text", model, "found").where("doc_id >= 160").collect()
    assert all((r["found"]["score"] >= 0.5) == bool(r["toxic"]) for r in found)
    for r in found:
        spans = [r["text"][s["start"] : s["end"]] for s in r["found"]["offending"]]
        assert [("vilewort" in s) for s in spans] == [True] * r["toxic"]
    odd = frame(spark, [(1, None), (2, ""), (3, "... 12 !"), (3, "... 12 !")])
    assert [r["found"]["score"] for r in toxicity.rate(odd, "text", model, "found").collect()] == [0.0] * 4


def test_toxicity_without_labels(spark, docs):
    none = frame(spark, [], "doc_id long, toxic int")
    model = toxicity.fit(docs, "doc_id", "text", none, "doc_id", "toxic")
    assert {r["found"]["score"] for r in toxicity.rate(docs, "text", model, "found").collect()} == {0.0}
    assert toxicity.rate(empty(spark), "text", model, "found").collect() == []


def test_samples_hold_one_row_a_key(spark, monkeypatch):
    rows = [(7, prose(i, 30)) for i in range(300)] + [(i, prose(i, 30)) for i in range(20)]
    table = frame(spark, rows)
    marks = frame(spark, [(i, i % 2) for i in range(20)], "doc_id long, mark int")
    assert toxicity._sample(table, "doc_id", "text", marks, "doc_id", "mark", 50).count() == 20
    grown, trained = [], []
    monkeypatch.setattr(quality_trees, "grow", lambda x, y: grown.append(len(y)))
    quality_trees.fit(table, "doc_id", "text", marks, "doc_id", "mark")
    monkeypatch.setattr(token_shards, "train", lambda samples: trained.append(len(samples)) or b"")
    token_shards.sample_format(table, "doc_id", "text")
    assert (grown, trained) == ([20], [20])


def test_quality_trees_learn_a_rule(spark):
    rows = [(i, prose(i, 40 + i % 50) if i % 3 else "buy *** now %%% " * (5 + i % 20), int(i % 3 > 0)) for i in range(400)]
    table = frame(spark, rows, "doc_id long, text string, quality int")
    forest = quality_trees.fit(table.where("doc_id < 250"), "doc_id", "text", table, "doc_id", "quality")
    found = quality_trees.rate(table, "text", forest, "score").where("doc_id >= 250").collect()
    assert all((r["score"] >= 0.5) == bool(r["quality"]) for r in found)
    odd = frame(spark, [(1, None), (2, ""), (2, "")])
    scores = [r["score"] for r in quality_trees.rate(odd, "text", forest, "score").collect()]
    assert len(set(scores)) == 1 and 0 <= scores[0] <= 1


def test_quality_trees_without_labels_or_with_one_kind(spark, docs):
    none = frame(spark, [], "doc_id long, quality int")
    forest = quality_trees.fit(docs, "doc_id", "text", none, "doc_id", "quality")
    assert {r["score"] for r in quality_trees.rate(docs, "text", forest, "score").collect()} == {0.5}
    ones = frame(spark, [(i, 1) for i in TEXTS], "doc_id long, quality int")
    forest = quality_trees.fit(docs, "doc_id", "text", ones, "doc_id", "quality")
    assert all(r["score"] > 0.9 for r in quality_trees.rate(docs, "text", forest, "score").collect())


def test_flat_trees_walk_as_the_trees_grew():
    chance = np.random.default_rng(0)
    rows = chance.standard_normal((2_000, 5))
    labels = ((rows[:, 0] > 0) ^ (rows[:, 3] > 0.5)).astype(float)
    forest = quality_trees.grow(rows, labels)
    new = chance.standard_normal((500, 5))
    wanted = (new[:, 0] > 0) ^ (new[:, 3] > 0.5)
    assert ((forest.scores(new) >= 0.5) == wanted).mean() > 0.95

    def walk(row, node):
        while forest.below[node] != node:
            node = forest.above[node] if row[forest.feature[node]] > forest.threshold[node] else forest.below[node]
        return forest.value[node]

    slow = [forest.prior + sum(walk(row, root) for root in forest.roots) for row in new[:50]]
    assert np.allclose(forest.scores(new[:50]), 1 / (1 + np.exp(-np.array(slow))))


def test_language_by_words_then_by_ever_shorter_ngrams(spark):
    rows = [(i, "river stone light birds", "en") for i in range(20)] + [(20 + i, "rivière pierre lumière oiseaux", "fr") for i in range(20)]
    table = frame(spark, [*rows, (None, "x", "en"), (99, None, "fr"), (98, "y", None)], "doc_id long, text string, lang string")
    model = language.fit(table, "doc_id", "text", "lang")
    assert model.languages == ["en", "fr"]
    odd = [(1, "river light"), (2, "lumières pierres"), (3, None), (4, ""), (5, "12 .!"), (6, "日本"), (7, "stoned birdsong"), (7, "stoned birdsong")]
    table = frame(spark, odd).selectExpr("*", "'old' as lang")
    found = language.identify(table, "text", model, "told").collect()
    assert [r["told"]["lang"] for r in found] == ["en", "fr", "und", "und", "und", "en", "en", "en"]
    assert [r["told"]["score"] for r in found[2:5]] == [0.0] * 3
    assert all(r["lang"] == "old" for r in found)
    assert found[5]["told"]["score"] == 0.5
    known = model.new_word("rivers")
    assert known[0] > known[1]


def test_language_of_an_empty_training_table(spark, docs):
    model = language.fit(frame(spark, [], "doc_id long, text string, lang string"), "doc_id", "text", "lang")
    assert {r["told"]["lang"] for r in language.identify(docs, "text", model, "told").collect()} == {"und"}


def test_language_sample_is_bounded_and_takes_hot_languages(spark):
    rows = [(i, prose(i, 5), "en") for i in range(300)] + [(300 + i, "der die das und " * 3, "de") for i in range(5)]
    table = frame(spark, rows, "doc_id long, text string, lang string")
    model = language.fit(table, "doc_id", "text", "lang", docs_per_language=10)
    assert model.languages == ["de", "en"]
