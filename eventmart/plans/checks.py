"""Checks that run with every build.

A check is a one-row table: its name and how many violations it found. Checks on
the nulls and values of a table share one pass over it.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventmart.functions import packed_key, spelling_key
from eventmart.operators.islands import catalog_floor
from eventmart.plans.analysis import Tables
from eventmart.plans.facts import trading_dates
from eventmart.session import known_size, written

CENT = 0.01
# Pairs and their bridge meet in so many turns at most, one for each so many bytes of the bridge.
TURNS = 8
TURN_BYTES = 1 << 30

# The declared contract of the tables: fixed values.
NOT_NULL: dict[str, list[str]] = {
    "raw_lines": ["transaction_id", "sale_date", "item", "net_sales"],
    "dim_category": ["category_key", "category_name"],
    "dim_item": ["item_key", "item_natural_key", "category_key", "item_name"],
    "dim_date": [
        "date_key", "full_date", "is_trading_day", "convention_day", "event_key", "event_name",
        "day_in_event",
    ],
    "fact_sales_line": [
        "sale_line_key", "transaction_id", "item_key", "date_key", "net_sales", "quantity",
        "hour_of_day",
    ],
    "fact_item_daily": [
        "item_day_key", "item_key", "date_key", "item_name", "convention_day", "event_name",
        "quantity", "net_sales", "transactions", "sold_that_day",
    ],
    "fact_item_pairs": [
        "item_pair_key", "event_key", "event_name", "item_a_key", "item_b_key", "pair_label",
        "baskets",
    ],
    "bridge_item_pair": ["pair_member_key", "item_pair_key", "item_key"],
}

UNIQUE: dict[str, list[str]] = {
    "dim_category": ["category_key", "category_name"],
    "dim_item": ["item_key", "item_natural_key"],
    "dim_date": ["date_key", "full_date"],
    "fact_sales_line": ["sale_line_key"],
    "fact_item_daily": ["item_day_key"],
    "fact_item_pairs": ["item_pair_key"],
    "bridge_item_pair": ["pair_member_key"],
}

# Table -> (column, parent table, parent column).
REFERENCES: dict[str, list[tuple[str, str, str]]] = {
    "dim_item": [("category_key", "dim_category", "category_key")],
    "fact_sales_line": [("item_key", "dim_item", "item_key"), ("date_key", "dim_date", "date_key")],
    "fact_item_daily": [("item_key", "dim_item", "item_key"), ("date_key", "dim_date", "date_key")],
    "fact_item_pairs": [
        ("event_key", "dim_date", "event_key"),
        ("item_a_key", "dim_item", "item_key"),
        ("item_b_key", "dim_item", "item_key"),
    ],
    "bridge_item_pair": [
        ("item_pair_key", "fact_item_pairs", "item_pair_key"),
        ("item_key", "dim_item", "item_key"),
    ],
}

HOURS = list(range(24))


class CheckFailed(Exception):
    """Raised when a table breaks its contract; later tables are not built."""

    def __init__(self, table: str, failures: dict[str, int]):
        self.table = table
        self.failures = failures
        listed = ", ".join(f"{name}: {count}" for name, count in sorted(failures.items()))
        super().__init__(f"{table} failed {listed}")


def _together(checks: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, checks)


def in_turn(checks: list[DataFrame]) -> DataFrame:
    """The checks' rows, each run to its end before the next one begins, so that their shuffles never add up."""
    return _together([written(check, "checked") for check in checks])


def _tally(violations: DataFrame, name: str) -> DataFrame:
    return violations.agg(F.count("*").alias("violations")).select(
        F.lit(name).alias("check_name"), "violations"
    )


Rules = dict[str, Column]


def _profile(table: DataFrame, rules: Rules, verdicts: Rules | None = None) -> DataFrame:
    """Rows that meet each rule, and verdicts on the table as a whole, from one pass.

    A verdict is a condition over ``rows`` and ``revenue`` of the table; it counts
    as one violation.
    """
    verdicts = verdicts or {}
    totals = (
        [F.count("*").alias("rows"), F.sum("net_sales").alias("revenue")] if verdicts else []
    )
    row = table.agg(*[F.count_if(rule).alias(name) for name, rule in rules.items()], *totals)
    judged = row.select(
        *rules,
        *[F.when(bad, 1).otherwise(0).cast("bigint").alias(name) for name, bad in verdicts.items()],
    )
    return judged.unpivot([], [*rules, *verdicts], "check_name", "violations")


def _null_rules(name: str, columns: list[str]) -> Rules:
    return {f"not_null_{name}_{c}": F.col(c).isNull() for c in columns}


def _hour_rule() -> Rules:
    # An accepted value ignores NULL, which has a check of its own.
    return {"accepted_values_fact_sales_line_hour_of_day": ~F.col("hour_of_day").isin(HOURS)}


def _quantity_rule() -> Rules:
    return {"quantity_non_negative": F.col("quantity") < 0}


def _order_rule() -> Rules:
    return {"item_pairs_are_unordered": F.col("item_a_key") >= F.col("item_b_key")}


def not_null(table: DataFrame, name: str, columns: list[str]) -> DataFrame:
    return _profile(table, _null_rules(name, columns))


def accepted_hours(lines: DataFrame) -> DataFrame:
    return _profile(lines, _hour_rule())


def quantities_are_not_negative(lines: DataFrame) -> DataFrame:
    return _profile(lines, _quantity_rule())


def pairs_are_unordered(pairs: DataFrame) -> DataFrame:
    return _profile(pairs, _order_rule())


def _key(table: DataFrame, column: str) -> Column:
    """A key's text packed: half the bytes to sort and to send."""
    is_key = column.endswith(("_key", "_uid")) and dict(table.dtypes)[column] == "string"
    return packed_key(column) if is_key else F.col(column)


def unique(table: DataFrame, name: str, column: str) -> DataFrame:
    """How many values occur more than once; copies combine before the shuffle."""
    repeated = (
        table.select(_key(table, column).alias("_value"))
        .filter(F.col("_value").isNotNull())
        .groupBy("_value")
        .agg(F.count("*").alias("_n"))
        .filter(F.col("_n") > 1)
    )
    return _tally(repeated, f"unique_{name}_{column}")


def references(
    table: DataFrame, name: str, column: str, parent: DataFrame, parent_column: str
) -> DataFrame:
    """Rows whose key has no parent. Keys are counted first, so the join sees each once."""
    keys = (
        table.filter(F.col(column).isNotNull())
        .groupBy(_key(table, column).alias("_key"))
        .agg(F.count("*").alias("_n"))
    )
    known = parent.select(_key(parent, parent_column).alias("_key"))
    orphans = keys.join(known, "_key", "left_anti").agg(F.sum("_n").alias("_n"))
    return orphans.select(
        F.lit(f"relationships_{name}_{column}").alias("check_name"),
        F.coalesce("_n", F.lit(0)).alias("violations"),
    )


def _summary(table: DataFrame) -> Column:
    """Row count and revenue of another table, as a value to compare with."""
    return table.agg(
        F.struct(F.count("*").alias("rows"), F.sum("net_sales").alias("revenue")).alias("t")
    ).scalar()


def _gap(other: Column) -> Column:
    zero = F.lit(0)
    return F.abs(F.coalesce("revenue", zero) - F.coalesce(other["revenue"], zero)) > CENT


def _raw_verdict(sales: Column) -> Rules:
    return {"staging_preserves_raw_revenue": (F.col("rows") != sales["rows"]) | _gap(sales)}


def _revenue_verdict(sales: Column) -> Rules:
    return {"fact_revenue_reconciles": _gap(sales)}


def _rows_verdict(sales: Column) -> Rules:
    return {"fact_rowcount_matches_staging": F.col("rows") != sales["rows"]}


def _size(table: DataFrame) -> Column:
    return table.agg(F.count("*").alias("n")).scalar()


def _grid_verdict(items: DataFrame, dates: DataFrame) -> Rules:
    expected = _size(items) * _size(dates.filter("is_trading_day"))
    return {"item_daily_grid_is_complete": F.col("rows") != expected}


def _dense_verdict(lines: DataFrame, dates: DataFrame) -> Rules:
    sparse = lines.join(trading_dates(dates, "date_key"), "date_key").agg(F.sum("net_sales"))
    return {"item_daily_revenue_reconciles": F.col("revenue") != sparse.scalar()}


def raw_matches_staging(raw: DataFrame, sales: DataFrame) -> DataFrame:
    """Nothing may vanish between landing and staging."""
    return _profile(raw, {}, _raw_verdict(_summary(sales)))


def fact_revenue_matches(sales: DataFrame, lines: DataFrame) -> DataFrame:
    return _profile(lines, {}, _revenue_verdict(_summary(sales)))


def fact_rows_match(sales: DataFrame, lines: DataFrame) -> DataFrame:
    """A dropped line worth nothing shows up in the count alone."""
    return _profile(lines, {}, _rows_verdict(_summary(sales)))


def grid_is_complete(items: DataFrame, dates: DataFrame, daily: DataFrame) -> DataFrame:
    return _profile(daily, {}, _grid_verdict(items, dates))


def dense_revenue_matches(daily: DataFrame, lines: DataFrame, dates: DataFrame) -> DataFrame:
    """Zeros add nothing: dense and sparse revenue agree to the cent."""
    return _profile(daily, {}, _dense_verdict(lines, dates))


def _differ(left: str, right: str) -> Column:
    # Unlike "<>", this also notices a label on one side only.
    return ~F.col(left).eqNullSafe(F.col(right))


def daily_labels_match(daily: DataFrame, items: DataFrame, dates: DataFrame) -> DataFrame:
    labels = dates.select(
        "date_key", F.col("convention_day").alias("_day"), F.col("event_name").alias("_event")
    )
    names = items.select("item_key", F.col("item_name").alias("_name"))
    drifted = (
        daily.select("item_key", "date_key", "item_name", "convention_day", "event_name")
        .join(labels, "date_key")
        .join(names, "item_key")
        .filter(
            _differ("item_name", "_name")
            | _differ("convention_day", "_day")
            | _differ("event_name", "_event")
        )
    )
    return _tally(drifted, "item_daily_labels_match_dimensions")


def pair_labels_match(pairs: DataFrame, items: DataFrame, dates: DataFrame) -> DataFrame:
    """A label that was compared moves no further: the second join of items carries a mark in its place."""
    events = dates.select("event_key", F.col("event_name").alias("_event")).distinct()
    names = items.select(packed_key("item_key"), "item_name")
    drifted = (
        pairs.join(events, "event_key")
        .select(
            packed_key("item_a_key").alias("_a_key"),
            packed_key("item_b_key").alias("_b_key"),
            "item_a",
            "item_b",
            _differ("event_name", "_event").alias("_drift"),
        )
        .join(names.toDF("_a_key", "_a"), "_a_key")
        .select("_b_key", "item_b", (F.col("_drift") | _differ("item_a", "_a")).alias("_drift"))
        .join(names.toDF("_b_key", "_b"), "_b_key")
        .filter(F.col("_drift") | _differ("item_b", "_b"))
    )
    return _tally(drifted, "item_pairs_labels_match_dimensions")


def pair_labels_are_unique(pairs: DataFrame) -> DataFrame:
    repeated = (
        pairs.groupBy("event_key", "pair_label")
        .agg(F.count("*").alias("_n"))
        .filter(F.col("_n") > 1)
    )
    return _tally(repeated, "pair_labels_unique_within_event")


def _pairs_with_members(pairs: DataFrame, bridge: DataFrame) -> DataFrame:
    """Per pair key of either table: is there a pair, its bridge rows, those of its items.

    Expected and found members stand in one table that is distributed by pair
    once; both groupings then run in place, without a join or a sort.
    """
    columns = ["_pair_key", "_item", "_wanted", "_found"]
    one, none = F.lit(1).cast("tinyint"), F.lit(0).cast("tinyint")
    wanted = pairs.select(
        packed_key("item_pair_key").alias("_pair_key"),
        F.explode(F.array_distinct(F.array(packed_key("item_a_key"), packed_key("item_b_key")))).alias("_item"),
        one.alias("_wanted"),
        none.alias("_found"),
    )
    found = bridge.select(
        packed_key("item_pair_key").alias("_pair_key"),
        packed_key("item_key").alias("_item"),
        none.alias("_wanted"),
        F.col("item_key").isNotNull().cast("tinyint").alias("_found"),
    )
    members = (
        wanted.select(columns)
        .unionByName(found.select(columns))
        .repartition("_pair_key")
        .groupBy("_pair_key", "_item")
        .agg(F.sum("_wanted").alias("_wanted"), F.sum("_found").alias("_found"))
    )
    return members.groupBy("_pair_key").agg(
        F.sum("_wanted").alias("_pair"),
        F.sum("_found").alias("_rows"),
        F.sum(F.when(F.col("_wanted") > 0, F.col("_found")).otherwise(0)).alias("_members"),
    )


def _pairs_in_turn(pairs: DataFrame, bridge: DataFrame, count: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``count``'s one row over the members of all pairs, summed over turns that take a share of the keys each."""
    turns = min(TURNS, 1 + known_size(bridge) // TURN_BYTES)
    if turns == 1:
        return count(_pairs_with_members(pairs, bridge))

    def share(table: DataFrame, turn: int) -> DataFrame:
        # Hashed with a seed of its own, or a turn's keys would meet in a few tasks.
        return table.filter(F.pmod(F.xxhash64(F.lit("turn"), "item_pair_key"), F.lit(turns)) == turn)

    counted = in_turn([count(_pairs_with_members(share(pairs, t), share(bridge, t))) for t in range(turns)])
    return counted.agg(*[F.sum(name).alias(name) for name in counted.columns])


def _unresolved() -> Column:
    """A pair whose bridge rows are not exactly its own two items."""
    return (F.col("_pair") > 0) & ((F.col("_rows") != 2) | (F.col("_members") != 2))


def bridge_resolves(pairs: DataFrame, bridge: DataFrame) -> DataFrame:
    name = "bridge_resolves_each_pair"
    found = _pairs_in_turn(pairs, bridge, lambda members: members.agg(F.count_if(_unresolved()).alias(name)))
    return found.unpivot([], found.columns, "check_name", "violations")


def bridge_matches_pairs(pairs: DataFrame, bridge: DataFrame) -> DataFrame:
    """Both directions of bridge and pairs: pairs resolve, and no row lacks its pair."""
    lost = F.when((F.col("_pair") == 0) & F.col("_pair_key").isNotNull(), F.col("_rows"))
    found = _pairs_in_turn(
        pairs,
        bridge,
        lambda members: members.agg(
            F.count_if(_unresolved()).alias("bridge_resolves_each_pair"),
            F.coalesce(F.sum(lost), F.lit(0)).alias("relationships_bridge_item_pair_item_pair_key"),
        ),
    )
    return found.unpivot([], found.columns, "check_name", "violations")


def facts_have_parents(lines: DataFrame, items: DataFrame, dates: DataFrame) -> DataFrame:
    """Fact rows without an item or without a date, counted per distinct key pair."""
    keys = lines.groupBy("item_key", "date_key").agg(F.count("*").alias("_n"))
    known_items = items.select("item_key", F.lit(True).alias("_item"))
    known_dates = dates.select("date_key", F.lit(True).alias("_date"))
    orphans = (
        keys.join(known_dates, "date_key", "left")
        .join(known_items, "item_key", "left")
        .filter(F.col("_item").isNull() | F.col("_date").isNull())
        .agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("violations"))
    )
    return orphans.select(F.lit("no_orphaned_revenue").alias("check_name"), "violations")


def events_clear_the_floor(sales: DataFrame, lines: DataFrame, dates: DataFrame) -> DataFrame:
    """Every event day took at least the price of the cheapest item."""
    floor = catalog_floor(sales).scalar()
    poor = (
        lines.groupBy("date_key")
        .agg(F.sum("net_sales").alias("_net"))
        .join(trading_dates(dates, "date_key"), "date_key")
        .filter(F.col("_net") < floor)
    )
    return _tally(poor, "events_clear_the_catalog_floor")


def category_spellings(categories: DataFrame) -> DataFrame:
    """Categories that differ only by case, space or underscore."""
    return categories.groupBy(spelling_key(F.col("category_name")).alias("spelling")).agg(
        F.count("*").alias("distinct_spellings"),
        F.min("category_name").alias("example_a"),
        F.max("category_name").alias("example_b"),
    )


def categories_are_normalised(categories: DataFrame) -> DataFrame:
    twice = category_spellings(categories).filter(F.col("distinct_spellings") > 1)
    return _tally(twice, "categories_are_case_normalised")


def _lines_against_dimensions(lines: DataFrame, items: DataFrame, dates: DataFrame, floor: Column) -> DataFrame:
    """References, orphans and the price floor of the sales fact from one pass.

    Lines are summed to their keys once; items join those sums, dates the sums by date.
    """
    known = items.select("item_key").distinct().withColumn("_item", F.lit(True))
    by_key = lines.groupBy("item_key", "date_key").agg(
        F.count("*").alias("_n"), F.sum("net_sales").alias("_net")
    )
    lost = F.col("_item").isNull()
    by_date = (
        by_key.join(known, "item_key", "left")
        .groupBy("date_key")
        .agg(
            F.sum("_n").alias("_n"),
            F.sum("_net").alias("_net"),
            F.sum(F.when(lost, F.col("_n")).otherwise(0)).alias("_lost"),
            F.sum(F.when(lost & F.col("item_key").isNotNull(), F.col("_n")).otherwise(0)).alias("_unknown"),
        )
    )
    days = dates.groupBy("date_key").agg(
        F.lit(True).alias("_date"), F.max("is_trading_day").alias("_open")
    )
    no_date = F.col("_date").isNull()
    n, zero = F.col("_n"), F.lit(0)
    found = by_date.join(days, "date_key", "left").agg(
        F.sum("_unknown").alias("relationships_fact_sales_line_item_key"),
        F.sum(F.when(no_date & F.col("date_key").isNotNull(), n)).alias("relationships_fact_sales_line_date_key"),
        F.sum(F.when(no_date, n).otherwise(F.col("_lost"))).alias("no_orphaned_revenue"),
        F.count_if(F.col("_open") & (F.col("_net") < floor)).alias("events_clear_the_catalog_floor"),
    )
    whole = found.select(*[F.coalesce(c, zero).cast("bigint").alias(c) for c in found.columns])
    return whole.unpivot([], whole.columns, "check_name", "violations")


def _absent(column: str, mark: str) -> Column:
    """A key that its dimension does not have; NULL has a check of its own."""
    return F.col(column).isNotNull() & F.col(mark).isNull()


def _with_labels(facts: DataFrame, parents: dict[str, tuple[DataFrame, str, list[str]]]) -> DataFrame:
    """Facts with labels of their parents' rows, one row a key, and a mark that there is one.

    ``parents``: fact column -> (table, its column, labels), named ``<fact column>:<label>``.
    """
    for column, (parent, key, labels) in parents.items():
        one = parent.groupBy(F.col(key).alias(column)).agg(
            F.lit(True).alias(f"{column}:there"), *[F.min(label).alias(f"{column}:{label}") for label in labels]
        )
        facts = facts.join(one, column, "left")
    return facts


def _daily_against_dimensions(items: DataFrame, dates: DataFrame) -> tuple[dict, Rules]:
    parents = {
        "item_key": (items, "item_key", ["item_name"]),
        "date_key": (dates, "date_key", ["convention_day", "event_name"]),
    }
    drifted = (
        _differ("item_name", "item_key:item_name")
        | _differ("convention_day", "date_key:convention_day")
        | _differ("event_name", "date_key:event_name")
    )
    both = F.col("item_key:there") & F.col("date_key:there")
    return parents, {
        **{f"relationships_fact_item_daily_{c}": _absent(c, f"{c}:there") for c in parents},
        "item_daily_labels_match_dimensions": both & drifted,
    }


def _pairs_against_dimensions(items: DataFrame, dates: DataFrame) -> tuple[dict, Rules]:
    parents = {
        "event_key": (dates, "event_key", ["event_name"]),
        "item_a_key": (items, "item_key", ["item_name"]),
        "item_b_key": (items, "item_key", ["item_name"]),
    }
    drifted = (
        _differ("item_a", "item_a_key:item_name")
        | _differ("item_b", "item_b_key:item_name")
        | _differ("event_name", "event_key:event_name")
    )
    all_there = F.col("event_key:there") & F.col("item_a_key:there") & F.col("item_b_key:there")
    return parents, {
        **{f"relationships_fact_item_pairs_{c}": _absent(c, f"{c}:there") for c in parents},
        "item_pairs_labels_match_dimensions": all_there & drifted,
    }


def check_table(name: str, table: Tables) -> DataFrame:
    """All declared and written checks of one table, in as few passes as they allow.

    Dimensions join the row profile where a check compares row by row; they were
    checked before, so each key is one row of theirs.
    """
    this = profiled = table(name)
    rules = _null_rules(name, NOT_NULL.get(name, []))
    verdicts: Rules = {}
    links = REFERENCES.get(name, [])
    more: list[DataFrame] = []
    if name == "raw_lines":
        verdicts = _raw_verdict(_summary(table("stg_sales")))
    elif name == "dim_category":
        more = [categories_are_normalised(this)]
    elif name == "fact_sales_line":
        sales, items, dates = table("stg_sales"), table("dim_item"), table("dim_date")
        staged = _summary(sales)
        rules |= _hour_rule() | _quantity_rule()
        verdicts = _revenue_verdict(staged) | _rows_verdict(staged)
        links = []
        more = [_lines_against_dimensions(this, items, dates, catalog_floor(sales).scalar())]
    elif name == "fact_item_daily":
        items, dates = table("dim_item"), table("dim_date")
        verdicts = _grid_verdict(items, dates) | _dense_verdict(table("fact_sales_line"), dates)
        parents, against = _daily_against_dimensions(items, dates)
        profiled, rules, links = _with_labels(this, parents), rules | against, []
    elif name == "fact_item_pairs":
        parents, against = _pairs_against_dimensions(table("dim_item"), table("dim_date"))
        profiled, rules, links = _with_labels(this, parents), rules | against | _order_rule(), []
        more = [pair_labels_are_unique(this)]
    elif name == "bridge_item_pair":
        links = [link for link in links if link[1] != "fact_item_pairs"]
        more = [bridge_matches_pairs(table("fact_item_pairs"), this)]
    return _together(
        [
            _profile(profiled, rules, verdicts),
            *[unique(this, name, c) for c in UNIQUE.get(name, [])],
            *[references(this, name, c, table(parent), pc) for c, parent, pc in links],
            *more,
        ]
    )


def failures(results: DataFrame) -> dict[str, int]:
    """Broken checks by name. The table has one row per check."""
    return {r["check_name"]: r["violations"] for r in results.filter("violations > 0").collect()}
