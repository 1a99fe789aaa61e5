"""The registered queries over the driver's smallest tables, and the whole pipeline."""

from pathlib import Path

import pandas as pd
import pytest

import __spark_entry__ as driver
import corpus_pipeline
from eventmart.llm import queries
from tests.llm import brute

SF_DIR = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="no test data")


@pytest.fixture(scope="module")
def documents():
    return pd.read_parquet(f"{SF_DIR}/documents.parquet")


@pytest.fixture(scope="module")
def labels():
    return pd.read_parquet(f"{SF_DIR}/labels.parquet")


def rows_of(spark, name):
    return queries.QUERIES[name](spark, SF_DIR).toPandas()


def test_all_are_registered():
    assert queries.QUERIES.keys() < driver.queries().keys()
    assert driver.queries()["pipeline"] is corpus_pipeline.run


@pytest.mark.parametrize("name, modulus, remainder, label", [("op1_quality_trees", 3, 1, "quality"), ("op8_toxicity", 5, 0, "toxic")])
def test_classifiers(spark, documents, labels, name, modulus, remainder, label):
    found = rows_of(spark, name)
    assert sorted(found.doc_id) == sorted(documents.doc_id)
    assert found.score.between(0, 1).all()
    assert ((found.score >= 0.5).astype(int) == found.predicted).all()
    assert [brute.held_out(i, modulus, remainder) for i in found.doc_id] == found.held_out.tolist()


def test_classifiers_on_held_out_documents_of_a_larger_table(spark):
    larger = "/root/testdata/sf0.01"
    marks = pd.read_parquet(f"{larger}/labels.parquet")
    for name, label, least in (("op1_quality_trees", "quality", 0.98), ("op8_toxicity", "toxic", 0.93)):
        found = queries.QUERIES[name](spark, larger).toPandas().merge(marks, on="doc_id")
        held = found[found.held_out]
        assert brute.auc(held.score, held[label]) > least


def test_language_of_held_out_documents(spark, documents):
    found = rows_of(spark, "op9_language").merge(documents[["doc_id", "lang"]], on="doc_id")
    held = found[found.held_out]
    assert len(found) == len(documents) and (held.lang == held.lang_pred).mean() > 0.97


def test_simhash(spark, documents):
    found = rows_of(spark, "op2_simhash")
    texts = dict(zip(documents.doc_id, documents.text))
    assert dict(zip(found.doc_id, found.component_id)) == brute.simhash_groups(texts)
    assert {i: int(f, 16) for i, f in zip(found.doc_id, found.fingerprint)} == {i: brute.simhash(t) for i, t in texts.items()}


def test_rules(spark, documents, labels):
    found = rows_of(spark, "op3_quality_rules").set_index("doc_id")
    for key, text in zip(documents.doc_id, documents.text):
        wanted = brute.rule_statistics(text)
        assert {k: found.loc[key, k] for k in wanted} == wanted
    good = labels[labels.quality == 1].doc_id
    assert (found.loc[good].kept | found.loc[good].base_failed).all()


def test_rules_equal_their_sql(spark):
    from tests.compare import differences, oracle_connection

    relation = oracle_connection(SF_DIR).sql(driver.oracle_sql()["op3_quality_rules"])
    assert differences(queries.QUERIES["op3_quality_rules"](spark, SF_DIR), relation) is None


def test_embeddings(spark):
    found = rows_of(spark, "op6_embeddings")
    vectors = pd.read_parquet(f"{SF_DIR}/embeddings.parquet").sort_values("vec_id")
    links = brute.vector_links([list(map(float, v)) for v in vectors.embedding])
    roots = brute.united(len(vectors), links)
    ids = vectors.vec_id.tolist()
    assert dict(zip(found.vec_id, found.component_id)) == {i: ids[r] for i, r in zip(ids, roots)}
    assert found.n_links.sum() == 2 * len(links)


def test_pages(spark):
    found = rows_of(spark, "op5_warc")
    pages = pd.read_parquet(f"{SF_DIR}/pages.parquet")
    wanted = brute.pages(dict(zip(pages.page_id, pages.html)))
    got = {r.page_id: (r.payload_bytes, r.payload_digest, r.record_type, None if pd.isna(r.refers_to) else r.refers_to) for r in found.itertuples()}
    assert got == wanted


def stage_inputs(spark, docs):
    for name, stage in corpus_pipeline.STAGES:
        before, docs = docs, stage(spark, docs, SF_DIR)
        yield name, before, docs


def test_every_stage_takes_effect_and_keeps_columns(spark, documents):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    odd = spark.createDataFrame(
        [(90_001, None, "en", "s", 0), (90_002, "12 34", "en", "s", 5), (90_003, documents.text[0], "fr", "s", 1), (None, documents.text[1], None, None, None)],
        docs.schema,
    )
    docs = docs.unionByName(odd).selectExpr("*", "1 as score", "'x' as _fp")
    seen = {}
    for name, before, after in stage_inputs(spark, docs):
        if name == "packing":
            packed = after.toPandas()
            assert set(packed.doc_id.dropna()) == set(before.toPandas().doc_id.dropna())
            continue
        assert after.columns == before.columns
        seen[name] = (set(before.toPandas().doc_id), set(after.toPandas().doc_id))
    assert not {90_001, 90_002} & seen["language"][1]
    kept, texts = seen["near_duplicates"], dict(zip(documents.doc_id, documents.text)) | {90_003: documents.text[0]}
    groups = brute.simhash_groups({int(i): texts[int(i)] for i in kept[0] if i == i})
    assert {int(i) for i in kept[1] if i == i} == set(groups.values())


def test_pipeline_runs_whole(spark):
    packed = corpus_pipeline.run(spark, SF_DIR).toPandas()
    ends = packed.groupby("sequence_id").length.sum()
    assert (ends <= 1_024).all() and len(ends) <= -(-packed.length.sum() // 1_024) + 5
    assert not packed.duplicated(["doc_id", "piece"]).any()


def test_pipeline_stages_take_empty_tables(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").where("doc_id < 0")
    for _, _, after in stage_inputs(spark, docs):
        assert after.count() == 0
