"""One query an operator, over the whole of its table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventmart.llm import (
    collocations,
    embeddings,
    language,
    packing,
    positional_index,
    quality_rules,
    quality_trees,
    rank_queue,
    simhash,
    token_shards,
    toxicity,
    turn_repair,
    warc,
)
from eventmart.llm.runtime import documents, key_remainder, materialise
from eventmart.session import fresh_folder

Query = Callable[[SparkSession, str], DataFrame]


def held_out(modulus: int, remainder: int):
    """Whether a document is kept from training; one without an id is never trained on, nor held out."""
    return F.coalesce(key_remainder(F.col("doc_id"), modulus) == remainder, F.lit(False))


def for_training(frame: DataFrame, modulus: int, remainder: int) -> DataFrame:
    return frame.where(key_remainder(F.col("doc_id"), modulus) != remainder)


def labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def quality_model(docs: DataFrame, sf_dir: str) -> quality_trees.Forest:
    marks = for_training(labels(docs.sparkSession, sf_dir), 3, 1)
    return quality_trees.fit(docs, "doc_id", "text", marks, "doc_id", "quality")


def toxicity_model(docs: DataFrame, sf_dir: str) -> toxicity.ToxicityModel:
    marks = for_training(labels(docs.sparkSession, sf_dir), 5, 0)
    return toxicity.fit(docs, "doc_id", "text", marks, "doc_id", "toxic")


def language_model(docs: DataFrame) -> language.LanguageModel:
    return language.fit(for_training(docs, 4, 2), "doc_id", "text", "lang")


def op1_quality_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir, "doc_id", "text")
    rated = quality_trees.rate(docs, "text", quality_model(docs, sf_dir), "score")
    return rated.select(
        "doc_id", held_out(3, 1).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir, "doc_id", "text")
    marked = materialise(simhash.with_fingerprint(docs, "text", "fp").select("doc_id", "fp"), "simhash")
    return simhash.group(marked, "doc_id", "fp", "component_id").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality_rules.judge(documents(spark, sf_dir, "doc_id", "text"), "text")
    return judged.select("doc_id", *quality_rules.BASE, "base_failed", "kept")


def _opened(spark: SparkSession, root: str) -> tuple[DataFrame, str, token_shards.Format]:
    manifest, form = token_shards.open_folder(spark, root)
    return manifest, root, form


def op4_token_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir, "doc_id", "text")
    root = token_shards.make_folder(spark, fresh_folder(spark, "token-shards"))
    form = token_shards.sample_format(docs, "doc_id", "text")
    token_shards.write(docs, "doc_id", "text", root, form)
    # Read as any other session would: by what lies in the folder.
    return token_shards.read(*_opened(spark, root)).withColumnRenamed("key", "doc_id")


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html")
    root = token_shards.make_folder(spark, fresh_folder(spark, "warc"))
    return warc.read(warc.write(pages, "page_id", "url", "html", root), root)


def op6_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding")
    return embeddings.near_duplicates(vectors, "vec_id", "embedding")


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(documents(spark, sf_dir, "doc_id", "text"), "doc_id", "text")


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir, "doc_id", "text")
    rated = toxicity.rate(docs, "text", toxicity_model(docs, sf_dir), "found")
    return rated.select(
        "doc_id",
        held_out(5, 0).alias("held_out"),
        "found.score",
        (F.col("found.score") >= 0.5).cast("int").alias("predicted"),
        F.size("found.offending").alias("n_offending"),
    )


def op9_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir, "doc_id", "text", "lang")
    told = language.identify(docs.select("doc_id", "text"), "text", language_model(docs), "told")
    return told.select(
        "doc_id", held_out(4, 2).alias("held_out"), F.col("told.lang").alias("lang_pred"), "told.score"
    )


def op10_rank_queue_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = rank_queue.digests(documents(spark, sf_dir, "doc_id", "text"), "text", "found")
    return found.select("doc_id", "found.*")


def damaged(turns: DataFrame) -> DataFrame:
    """Conversations with one turn in five spoilt, by the hash of its conversation and number."""
    shown = {name: F.coalesce(F.col(name).cast("string"), F.lit(" ")) for name in ("conv_id", "turn", "role", "text")}
    fate = F.pmod(F.crc32(F.concat_ws(":", shown["conv_id"], shown["turn"]).cast("binary")), F.lit(20))
    copies = F.when(fate == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    text = (
        F.when(fate == 1, F.lit(""))
        .when(fate == 2, F.regexp_replace(shown["text"], "[.!?]", ""))
        .otherwise(shown["text"])
    )
    role = F.when(fate == 4, F.lit("user")).otherwise(shown["role"])
    spoilt = turns.where(fate != 0).select("conv_id", "turn", role.alias("role"), text.alias("text"), copies.alias("copies"))
    return spoilt.withColumn("copy", F.explode("copies")).select("conv_id", "turn", "role", "text")


def op11_turn_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    marked = turn_repair.mark(damaged(turns), "conv_id", "turn", "role", "text")
    summary = turn_repair.align(marked)
    counts = [F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return (
        turn_repair.conversations(turns, "conv_id")
        .join(summary.join(turn_repair.digests(marked, summary), "conv_key"), "conv_key", "left")
        .select(
            "conv_id",
            *counts,
            F.coalesce("audit", F.lit("")).alias("audit"),
            F.coalesce("sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"),
        )
    )


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(documents(spark, sf_dir, "lang", "text"), "text", "lang")


def op13_positional_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text")
    docs = documents(spark, sf_dir, "doc_id", "text")
    found = positional_index.contamination(docs, "doc_id", "text", items, "item_id", "text")
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


QUERIES: dict[str, Query] = {
    "op1_quality_trees": op1_quality_trees,
    "op2_simhash": op2_simhash,
    "op3_quality_rules": op3_quality_rules,
    "op4_token_shards": op4_token_shards,
    "op5_warc": op5_warc,
    "op6_embeddings": op6_embeddings,
    "op7_packing": op7_packing,
    "op8_toxicity": op8_toxicity,
    "op9_language": op9_language,
    "op10_rank_queue_bpe": op10_rank_queue_bpe,
    "op11_turn_repair": op11_turn_repair,
    "op12_collocations": op12_collocations,
    "op13_positional_index": op13_positional_index,
}

# SQL that gives the same rows as op3, op12 and op13. The other operators train a model, hash, pack or
# align, which SQL cannot say; they are tested against brute force, a round trip or held-out labels.
_STOP = ", ".join(f"'{word}'" for word in sorted({x for each in quality_rules.STOP_WORDS.values() for x in each}))
ORACLE: dict[str, str] = {
    "op3_quality_rules": r"""
    with docs as (select row_number() over () as r, doc_id, coalesce(text, '') as t from documents),
    cut as (
      select r, doc_id, t,
        list_filter(regexp_split_to_array(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') as w,
        list_filter(string_split(t, chr(10)), lambda x: regexp_replace(x, '[\x20\x09-\x0D]+', '', 'g') <> '') as l
      from docs),
    places as (select r, w, unnest(range(1, len(w) - 1)) as p from cut where len(w) >= 4),
    windows as (select r, p, count(*) over (partition by r, w[p], w[p + 1], w[p + 2]) as n from places),
    covered as (
      select r, count(distinct p + k) as n from windows, (values (0), (1), (2)) as steps(k) where windows.n > 1 group by r),
    counted as (
      select doc_id, len(w) as n_words, length(array_to_string(w, '')) as word_chars,
        len(regexp_extract_all(t, '[#*$%&|<>]')) as n_symbols, len(l) - len(list_distinct(l)) as n_dup_lines,
        coalesce(covered.n, 0) as n_repeat_words, len(l) as n_lines,
        len(list_filter(w, lambda x: lower(x) in (""" + _STOP + r"""))) as n_stop_words
      from cut left join covered using (r)),
    failing as (select *, n_words < 50 or 100 * n_repeat_words > 50 * n_words as base_failed from counted)
    select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
      not base_failed and n_words <= 1000000 and word_chars between 1.5 * n_words and 25 * n_words
        and n_symbols / n_words <= 0.3 and case when n_lines > 0 then n_dup_lines / n_lines else 0 end <= 0.5
        and n_stop_words / n_words >= 0.005 as kept
    from failing
    """,
    "op12_collocations": r"""
    with pieces as (
      select coalesce(lang, 'und') as lang,
        unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
          '[.,;:!?\x0A-\x0D]')) as piece
      from documents),
    cut as (select lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda x: x <> '') as w from pieces),
    totals as (select lang, sum(len(w))::bigint as n from cut group by lang),
    sizes(size) as (values (1), (2), (3), (4), (5)),
    runs as (
      select lang, size, array_to_string(unnest(list_transform(range(1, (len(w) - size + 2)::bigint), lambda i: w[i : i + size - 1])), ' ') as phrase
      from cut, sizes where len(w) >= size),
    counted as (select lang, size, phrase, count(*) as f from runs group by all having count(*) >= 100),
    long as (select *, string_split(phrase, ' ') as w from counted where size > 1),
    cuts as (
      select lang, phrase, f, k, array_to_string(w[1 : k], ' ') as head, array_to_string(w[k + 1 : size], ' ') as tail
      from (select *, unnest(range(1, size)) as k from long)),
    weighed as (
      select cuts.lang, cuts.phrase, cuts.f as a, h.f as l, t.f as r, n, k,
        ((1000::hugeint * cuts.f * n) // (h.f::hugeint * t.f))::bigint as score
      from cuts join counted h on h.lang = cuts.lang and h.phrase = cuts.head
        join counted t on t.lang = cuts.lang and t.phrase = cuts.tail join totals on totals.lang = cuts.lang),
    weakest as (select * from weighed qualify row_number() over (partition by lang, phrase order by score, k) = 1),
    inner_ as (
      select lang, array_to_string(w[i : i + k - 1], ' ') as phrase, max(f) as f
      from (select *, unnest(range(1, size - k + 2)) as i from (select *, unnest(range(2, size)) as k from long))
      group by all),
    kept as (
      select * from weakest where not exists (
        select 1 from inner_ where inner_.lang = weakest.lang and inner_.phrase = weakest.phrase and 100 * inner_.f >= 100 * a)),
    ranked as (select *, row_number() over (partition by lang order by score desc, a desc, phrase) as rank from kept)
    select lang, rank, phrase, a, l, r, n, score from ranked where rank <= 2000
    """,
    "op13_positional_index": r"""
    with docs as (
      select row_number() over () as d, doc_id,
        regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
          '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w
      from documents),
    items as (
      select item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
          '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w
      from benchmark),
    windows as (
      select distinct item_id, least(len(w), 10) as size,
        array_to_string(unnest(list_transform(range(1, (greatest(len(w) - 9, 1) + 1)::bigint), lambda i: w[i : i + 9])), ' ') as phrase
      from items where len(w) > 0),
    sizes as (select distinct size from windows),
    places as (
      select d, size, i, array_to_string(w[i : i + size - 1], ' ') as phrase
      from (select d, w, size, unnest(range(1, (len(w) - size + 2)::bigint)) as i from docs, sizes where len(w) >= size)),
    found as (select d, i, places.size, item_id from places join windows on windows.phrase = places.phrase and windows.size = places.size),
    hit as (select d, count(distinct p) as n_hit from (select d, unnest(range(i, i + size)) as p from found) group by d),
    named as (select d, count(distinct item_id) as n_items, string_agg(distinct item_id::varchar, ',' order by item_id::varchar) as ids from found group by d)
    select doc_id, len(w)::bigint as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items,
      sha256(coalesce(ids, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
    from docs left join hit using (d) left join named using (d)
    """,
}
