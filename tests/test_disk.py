"""What the star leaves on disk while it is built, and how much its plans move."""

import os
import time

import pytest
from pyspark.sql import functions as F

from eventmart.functions import packed_key, unpacked_key
from eventmart.plans import checks, facts
from eventmart.plans.star import Star
from eventmart.sources import export, landing
from eventmart.sources.schemas import LANDED_LINES
from workload import mapping

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def star(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("disk")
    landing.full_refresh(mapping.raw_lines(spark, SF_DIR), f"{root}/raw", dealt=True)
    return Star(spark, landing.read_lines(spark, f"{root}/raw"), f"{root}/star", by_date=True)


def shuffle_files(spark):
    manager = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    return {str(f) for f in manager.getAllFiles().mkString("|").split("|") if "shuffle_" in f}


def left_over(spark, before):
    """Shuffle files there are beside those of before; their removal runs beside the job."""
    for _ in range(50):
        left = shuffle_files(spark) - before
        if not left:
            break
        time.sleep(0.1)
    return left


def plan(table):
    return table._jdf.queryExecution().toString()


def test_no_shuffle_outlives_a_written_table(spark, star, tmp_path):
    before = shuffle_files(spark)
    star.table("fact_item_pairs")
    star.table("fact_item_daily")
    landing.full_refresh(star.raw, str(tmp_path / "again"))
    assert not left_over(spark, before)
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "false"


def test_drafts_go_with_the_table_they_were_for(star):
    star.table("fact_item_pairs")
    star.table("fact_item_daily")
    assert not [name for name in os.listdir(star.root) if name.startswith("_draft")]


def test_hashes_are_stored_compressed(star):
    star.table("fact_sales_line")
    names = [name for _, _, found in os.walk(f"{star.root}/fact_sales_line") for name in found if name.endswith(".parquet")]
    assert names and all(".zstd." in name for name in names)


def test_lines_move_by_date_before_their_texts_are_made(spark):
    moved = plan(mapping.raw_lines(spark, SF_DIR)).split("Physical Plan")[1]
    assert "sha2" in moved.split("REBALANCE_PARTITIONS")[0]
    assert "sha2" not in moved.split("REBALANCE_PARTITIONS")[1]


def test_dated_lines_lie_in_few_files(star):
    """Lines are read a date after the other, so no task writes more dates than it reads."""
    star.table("fact_sales_line")
    days = [d for d in os.listdir(f"{star.root}/fact_sales_line") if d.startswith("date_key=")]
    files = [f for d in days for f in os.listdir(f"{star.root}/fact_sales_line/{d}") if f.endswith(".parquet")]
    assert len(files) <= 2 * len(days)


@pytest.mark.parametrize("text", ["0" * 32, "0123456789abcdef" * 2, "ABCDEF0123456789" * 2, "a", "", "sixteen letters!", "0" * 33, "seventeen letters", None, "ü" * 8])
def test_keys_come_back_from_their_packed_form(spark, text):
    row = spark.createDataFrame([(text,)], "k string").select(packed_key("k").alias("p")).select("p", unpacked_key("p").alias("k")).first()
    assert row.k == text
    assert text is None or len(row.p) == (16 if text.isalnum() and len(text) == 32 and text == text.lower() else len(row.p))


def test_pairs_of_any_keys_stand_in_the_order_of_their_text(spark):
    keys = ["ff" * 16, "00" * 16, "b", "sixteen letters!"]
    items = spark.createDataFrame([(k, f"name {k}", "c") for k in keys], "item_key string, item_name string, category_name string")
    dates = spark.createDataFrame([("d", True, "e", "event")], "date_key string, is_trading_day boolean, event_key string, event_name string")
    lines = spark.createDataFrame([("d", "t", k) for k in keys], "date_key string, transaction_id string, item_key string")
    found = facts.item_pairs_fact(items, dates, lines).collect()
    assert {(r.item_a_key, r.item_b_key) for r in found} == {(a, b) for a in keys for b in keys if a < b}
    assert all((r.item_a, r.item_b) == (f"name {r.item_a_key}", f"name {r.item_b_key}") for r in found)


def test_pair_keys_move_packed(star):
    counted = facts.pair_counts(star.table("dim_date"), star.table("fact_sales_line"))
    assert dict(counted.dtypes) == {"event": "binary", "a_item": "binary", "b_item": "binary", "baskets": "bigint"}


def test_bridge_is_checked_alike_in_one_turn_and_in_many(spark, star, monkeypatch):
    pairs, bridge = star.table("fact_item_pairs"), star.table("bridge_item_pair")
    odd = F.crc32("pair_member_key") % 5
    broken = bridge.filter(odd != 0).withColumn("item_key", F.when(odd == 1, F.col("pair_member_key")).when(odd == 2, F.col("item_key")))
    stray = broken.unionByName(bridge.filter(odd == 3).withColumn("item_pair_key", F.col("pair_member_key")))

    def counted():
        found = checks.bridge_matches_pairs(pairs, stray).collect()
        alone = checks.bridge_resolves(pairs, stray).collect()
        return {r.check_name: r.violations for r in found}, {r.check_name: r.violations for r in alone}

    whole, alone = counted()
    assert min(whole.values()) > 0 and alone.items() <= whole.items()
    monkeypatch.setattr(checks, "TURN_BYTES", checks.known_size(stray) // 3)
    assert counted() == (whole, alone)


def test_checks_run_in_turn_leave_no_shuffle(spark, star):
    before = shuffle_files(spark)
    found = checks.in_turn([checks.unique(star.table("fact_item_pairs"), "fact_item_pairs", "item_pair_key")] * 2)
    assert not left_over(spark, before)
    assert [r.violations for r in found.collect()] == [0, 0]


def test_pairs_met_are_written_before_names_join_them(star):
    from eventmart.plans import analysis

    asked = plan(analysis.items_bought_together(star.table))
    assert "fact_sales_line" not in asked and "pairs-met" in asked


def test_export_moves_no_row(spark, tmp_path):
    table = spark.createDataFrame([], LANDED_LINES).unionByName(spark.createDataFrame([(None,) * len(LANDED_LINES)], LANDED_LINES))
    before = shuffle_files(spark)
    export.export_table(table, str(tmp_path / "csv"))
    assert not shuffle_files(spark) - before


def test_staged_sales_by_name_are_compressed(spark, star, tmp_path):
    from eventmart.sources.catalog import Catalog

    names = Catalog(spark, "disk", str(tmp_path / "catalog"))
    names.create()
    try:
        names.register_star(star)
        found = [f for _, _, files in os.walk(tmp_path / "catalog") for f in files if f.endswith(".parquet")]
        assert found and all(".zstd." in name for name in found)
    finally:
        names.drop()


def test_lines_of_documents_move_as_rows(spark):
    """The texts of a line are made behind the join of its order."""
    moved = plan(mapping.order_pages(spark, SF_DIR)).split("Physical Plan")[1]
    assert "collect_list(struct(l_linenumber" in moved
    assert "total_tax_money" not in moved.split("Join", 1)[1]
