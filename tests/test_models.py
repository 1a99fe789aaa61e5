import itertools
import random
from collections import Counter
from datetime import date, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from eventmart.operators.baskets import pair_up
from eventmart.operators.densify import unfold_over_days
from eventmart.plans import analysis, checks, dims, facts
from eventmart.plans.staging import stage_sales
from eventmart.plans.star import Star
from eventmart.sources.schemas import RAW_LINES

DATES = "date_key string, event_key string, event_name string, is_trading_day boolean"


def raw_line(day, txn, item, net, *, sku=None, kind="ITEM", qty="1", clock="12:00:00", category="x"):
    values = dict.fromkeys(RAW_LINES.names)
    values |= {
        "sale_date": day, "sale_time": clock, "category": category, "item": item, "sku": sku,
        "qty": qty and Decimal(qty), "gross_sales": Decimal(net), "discounts": Decimal(0),
        "net_sales": Decimal(net), "tax": Decimal(0), "transaction_id": txn,
        "itemization_type": kind,
    }
    return tuple(values[n] for n in RAW_LINES.names)


def raw_table(spark, *rows):
    return spark.createDataFrame(list(rows), RAW_LINES)


def test_pairs_stay_within_their_event(spark):
    """A line listed twice, a basket of three, an idle day and the same pair at two events."""
    dates = spark.createDataFrame(
        [("mon", "spring", "Spring fair", True), ("sat", "autumn", "Autumn fair", True), ("idle", "none", "No event", False)],
        DATES,
    )
    items = spark.createDataFrame(
        [("k", "kite"), ("m", "mug"), ("s", "scarf")], "item_key string, item_name string"
    )
    baskets = {"mon": ["kkm", "ms"], "sat": ["mk", "kms", "mk", "s"], "idle": ["km"]}
    rows = [(f"{day}-{i}", item, day) for day, each in baskets.items() for i, held in enumerate(each) for item in held]
    lines = spark.createDataFrame(rows, "transaction_id string, item_key string, date_key string")
    expected = {
        ("spring", "k", "m", "kite  +  mug", 1),
        ("spring", "m", "s", "mug  +  scarf", 1),
        ("autumn", "k", "m", "kite  +  mug", 3),
        ("autumn", "k", "s", "kite  +  scarf", 1),
        ("autumn", "m", "s", "mug  +  scarf", 1),
    }
    for block_items in (2_000, 1):
        pairs = facts.item_pairs_fact(items, dates, lines, block_items)
        got = pairs.select("event_key", "item_a_key", "item_b_key", "pair_label", "baskets").collect()
        assert {tuple(r) for r in got} == expected and len(got) == len(expected)
        bridge = facts.pair_bridge(pairs)
        assert bridge.count() == 2 * len(expected)
        assert bridge.select("pair_member_key").distinct().count() == 2 * len(expected)


@pytest.mark.parametrize("block_items", [1, 3, 7, 1_000])
def test_pairs_against_brute_force_with_one_huge_basket(spark, block_items):
    rng = random.Random(block_items)
    baskets = {f"t{i}": rng.sample(range(40), rng.randint(1, 5)) for i in range(30)}
    # One basket holds more than a third of all rows.
    baskets["huge"] = list(range(60))
    rows = [(t, f"i{i:02d}", t + "!") for t, held in baskets.items() for i in held]
    table = spark.createDataFrame(rows, "t string, i string, note string")
    got = Counter(
        (r.t, r.a_item, r.b_item, r.a_note, r.b_note)
        for r in pair_up(table, "t", "i", ["note"], block_items).collect()
    )
    expected = Counter(
        (t, f"i{a:02d}", f"i{b:02d}", t + "!", t + "!")
        for t, held in baskets.items()
        for a, b in itertools.combinations(sorted(held), 2)
    )
    assert got == expected


def test_line_pairs_multiply_repeated_lines(spark):
    lines = spark.createDataFrame(
        [("t1", "a")] * 3 + [("t1", "b")] * 2 + [("t2", "a"), ("t2", "c")],
        "transaction_id string, item_key string",
    )
    items = spark.createDataFrame(
        [("a", "Alpha"), ("b", "Beta"), ("c", "Beta")], "item_key string, item_name string"
    )
    tables = {"fact_sales_line": lines, "dim_item": items}
    for block_items in (2_000, 1):
        got = analysis.items_bought_together(tables.__getitem__, block_items=block_items).collect()
        assert [tuple(r) for r in got] == [("Alpha", "Beta", 7)]


def test_events_split_after_more_than_seven_days(spark):
    first = date(2026, 4, 3)
    days = [first, first + timedelta(7), first + timedelta(15), first + timedelta(16)]
    raw = raw_table(spark, *[raw_line(d, f"t{d}", "plush", "20") for d in days])
    dim = dims.date_dimension(stage_sales(raw)).orderBy("full_date").collect()
    assert [(r.event_name, r.convention_day, r.day_in_event) for r in dim] == [
        ("Event 1 (2026-04-03)", "Day 1", 1),
        ("Event 1 (2026-04-03)", "Day 2", 2),
        ("Event 2 (2026-04-18)", "Day 1", 1),
        ("Event 2 (2026-04-18)", "Day 2", 2),
    ]
    assert dim[0].day_of_week == "Friday" and not dim[0].is_weekend


def test_terminal_test_is_no_trading_day_and_splits_nothing(spark):
    raw = raw_table(
        spark,
        raw_line(date(2026, 3, 1), "t0", "Custom amount (unnamed)", "3", kind="CUSTOM_AMOUNT"),
        raw_line(date(2026, 4, 3), "t1", "plush", "40", qty="2"),
        raw_line(date(2026, 4, 4), "t2", "plush", "20"),
    )
    dim = {r.full_date.isoformat(): r for r in dims.date_dimension(stage_sales(raw)).collect()}
    test = dim["2026-03-01"]
    assert (test.is_trading_day, test.event_name, test.convention_day, test.day_in_event) == (
        False, "Non-trading day", "Non-trading", 0,
    )
    assert test.event_start_date is None
    assert dim["2026-04-03"].event_name == "Event 1 (2026-04-03)"


def test_without_catalog_items_every_day_trades(spark):
    raw = raw_table(spark, raw_line(date(2026, 3, 1), "t0", "amount", "3", kind="CUSTOM_AMOUNT"))
    assert dims.date_dimension(stage_sales(raw)).first().is_trading_day


def test_staging_fills_measures_and_drops_unattributed_lines(spark):
    raw = raw_table(
        spark,
        raw_line(date(2026, 4, 3), "t1", "plush", "20", qty=None, sku=" S1 "),
        raw_line(date(2026, 4, 3), None, "plush", "20"),
        raw_line(date(2026, 4, 3), "t2", None, "20"),
    )
    rows = stage_sales(raw).collect()
    assert [(r.transaction_id, r.quantity, r.sku, r.item_natural_key) for r in rows] == [
        ("t1", Decimal("0.00"), "S1", "S1")
    ]


def test_item_takes_greatest_labels(spark):
    raw = raw_table(
        spark,
        raw_line(date(2026, 4, 3), "t1", "plush", "20", sku="S1", category="handmade"),
        raw_line(date(2026, 4, 3), "t2", "plush v2", "20", sku="S1", category="blindbag"),
        raw_line(date(2026, 4, 3), "t3", "sticker", "2", sku="  "),
    )
    got = {r.item_natural_key: (r.sku, r.item_name, r.category_name)
           for r in dims.item_dimension(stage_sales(raw)).collect()}
    assert got == {"S1": ("S1", "plush v2", "Handmade"), "sticker": (None, "sticker", "X")}


def small_star(spark, tmp_path, *extra):
    raw = raw_table(
        spark,
        raw_line(date(2026, 3, 1), "t0", "amount", "1", kind="CUSTOM_AMOUNT"),
        raw_line(date(2026, 4, 3), "t1", "plush", "20", sku="S1"),
        raw_line(date(2026, 4, 3), "t1", "plush", "20", sku="S1", clock="12:00:01"),
        raw_line(date(2026, 4, 3), "t1", "sticker", "2"),
        raw_line(date(2026, 4, 5), "t2", "sticker", "2"),
        *extra,
    )
    return Star(spark, raw, str(tmp_path / "star"))


def test_item_days_are_dense(spark, tmp_path):
    star = small_star(spark, tmp_path)
    daily = star.table("fact_item_daily").collect()
    got = {(r.item_name, r.full_date.isoformat()): (r.quantity, r.transactions, r.sold_that_day)
           for r in daily}
    assert len(daily) == len(got) == 6
    assert got == {
        ("plush", "2026-04-03"): (2, 1, True),
        ("plush", "2026-04-05"): (0, 0, False),
        ("sticker", "2026-04-03"): (1, 1, True),
        ("sticker", "2026-04-05"): (1, 1, True),
        ("amount", "2026-04-03"): (0, 0, False),
        ("amount", "2026-04-05"): (0, 0, False),
    }
    grid = facts.item_day_grid(star.table("dim_item"), star.table("dim_date"))
    labels = ["item_key", "item_name", "category_name", "date_key", "convention_day", "event_name"]
    assert sorted(map(tuple, grid.select(labels).collect())) == sorted(
        tuple(r[c] for c in labels) for r in daily
    )


def test_no_days_no_grid(spark):
    items = spark.createDataFrame([("a",)], "item string")
    days = spark.createDataFrame([], "day date")
    assert unfold_over_days(items, days, "day").count() == 0


def test_build_is_clean_and_repeatable(spark, tmp_path):
    star = small_star(spark, tmp_path)
    assert star.build() == {}
    again = small_star(spark, tmp_path / "again")
    again.build()
    for name in ("dim_item", "dim_date", "fact_sales_line", "fact_item_pairs"):
        first, second = (sorted(map(tuple, s.table(name).collect()), key=str) for s in (star, again))
        assert first == second


def test_build_stops_at_the_first_broken_table(spark, tmp_path):
    star = small_star(spark, tmp_path, raw_line(date(2026, 4, 5), "t9", None, "2"))
    with pytest.raises(checks.CheckFailed) as stop:
        star.build()
    assert stop.value.table == "raw_lines"
    assert stop.value.failures == {
        "not_null_raw_lines_item": 1, "staging_preserves_raw_revenue": 1,
    }
    assert "dim_category" not in star._read


def test_refund_line_breaks_the_fact(spark, tmp_path):
    star = small_star(spark, tmp_path, raw_line(date(2026, 4, 5), "t9", "sticker", "2", qty="-1"))
    with pytest.raises(checks.CheckFailed) as stop:
        star.build()
    assert (stop.value.table, stop.value.failures) == ("fact_sales_line", {"quantity_non_negative": 1})


def test_all_79_checks_are_declared(spark, tmp_path):
    star = small_star(spark, tmp_path)
    names = []
    for table in checks.NOT_NULL:
        names += [r.check_name for r in checks.check_table(table, star.table).collect()]
    assert len(names) == len(set(names)) == 79


def test_numbered_questions(spark, tmp_path):
    star = small_star(spark, tmp_path)
    assert list(analysis.run_analyses(star.table)) == [1, 2, 3, 4, 5, 6, 7]
    only = analysis.run_analyses(star.table, only=3)
    assert [r.cumulative_revenue for r in only[3].collect()] == [Decimal("42.00"), Decimal("44.00")]


def test_label_checks_notice_a_missing_label(spark, tmp_path):
    star = small_star(spark, tmp_path)
    daily = star.table("fact_item_daily").withColumn("event_name", F.lit(None).cast("string"))
    found = checks.daily_labels_match(daily, star.table("dim_item"), star.table("dim_date"))
    assert checks.failures(found) == {"item_daily_labels_match_dimensions": 6}


def _spoiled(table, every: int, **columns):
    """Every so many rows with other values, so that each check finds some and not all."""
    hit = F.pmod(F.xxhash64(*table.columns), F.lit(every)) == 0
    return table.withColumns({c: F.when(hit, v).otherwise(F.col(c)) for c, v in columns.items()})


def test_checks_in_one_pass_find_what_single_checks_find(spark, tmp_path):
    star = small_star(spark, tmp_path, *[
        raw_line(date(2026, 4, 3 + i // 5 % 3), f"x{i // 5}", f"toy {i * 7 % 9}", str(i % 7)) for i in range(60)
    ])
    tables = {name: star.table(name) for name in (*checks.NOT_NULL, "stg_sales")}
    nothing = F.lit(None).cast("string")
    tables["fact_sales_line"] = _spoiled(
        _spoiled(_spoiled(tables["fact_sales_line"], 3, item_key=F.lit("gone")), 4, date_key=F.lit("gone")), 5, item_key=nothing
    )
    tables["fact_item_daily"] = _spoiled(
        _spoiled(_spoiled(tables["fact_item_daily"], 3, item_key=F.lit("gone")), 4, event_name=nothing), 5, date_key=nothing
    )
    tables["fact_item_pairs"] = _spoiled(
        _spoiled(_spoiled(tables["fact_item_pairs"], 3, item_a_key=F.lit("gone")), 2, item_b=nothing), 4, event_key=F.lit("x")
    )
    sales, items, dates = tables["stg_sales"], tables["dim_item"], tables["dim_date"]
    lines, daily, pairs = (tables[f"fact_{n}"] for n in ("sales_line", "item_daily", "item_pairs"))
    single = {
        "fact_sales_line": [checks.facts_have_parents(lines, items, dates), checks.events_clear_the_floor(sales, lines, dates)],
        "fact_item_daily": [checks.daily_labels_match(daily, items, dates)],
        "fact_item_pairs": [checks.pair_labels_match(pairs, items, dates), checks.pairs_are_unordered(pairs)],
    }
    for name, more in single.items():
        wanted = {}
        for check in (
            *more,
            checks.not_null(tables[name], name, checks.NOT_NULL[name]),
            *[checks.references(tables[name], name, c, tables[p], pc) for c, p, pc in checks.REFERENCES[name]],
        ):
            wanted |= {r.check_name: r.violations for r in check.collect()}
        got = {r.check_name: r.violations for r in checks.check_table(name, tables.__getitem__).collect()}
        assert {k: got[k] for k in wanted} == wanted
        assert any(wanted.values())
    assert checks.failures(checks.unique(lines, "t", "item_key")) == {
        "unique_t_item_key": len([1 for r in lines.groupBy("item_key").count().collect() if r.item_key and r["count"] > 1])
    }
