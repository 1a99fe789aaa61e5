"""The same results in plain SQL over the driver's tables, for comparison.

Each text is a chain of named parts, of which a query takes the ones it needs.
Ratios are rounded in whole numbers, so no engine's idea of rounding a double
matters.
"""

from __future__ import annotations

import re

from eventmart.operators.islands import EVENT_GAP_DAYS
from eventmart.plans import checks

# --------------------------------------------------------------------------
# Small pieces of SQL
# --------------------------------------------------------------------------


def key(*columns: str) -> str:
    texts = ", ".join(f"coalesce(CAST({c} AS VARCHAR), '_sk_null_')" for c in columns)
    return f"md5(concat_ws('-', {texts}))"


def half_up(part: str, whole: str, digits: int) -> str:
    """part / whole of two whole numbers, rounded half away from zero, as a double."""
    scale = 10**digits
    size = f"((abs(CAST({part} AS HUGEINT)) * {2 * scale} + ({whole})) // (2 * ({whole})))"
    return f"(CAST(sign({part}) * {size} AS DOUBLE) / {scale})"


def cents(column: str) -> str:
    return f"CAST({column} * 100 AS HUGEINT)"


def share(part: str, whole: str, digits: int) -> str:
    return f"CASE WHEN {whole} <> 0 THEN {half_up(f'100 * {part}', whole, digits)} END"


def capitals(text: str) -> str:
    return (
        f"array_to_string(list_transform(string_split(lower({text}), ' '), "
        "lambda w: upper(w[1]) || w[2:]), ' ')"
    )


def doubles(*columns: str) -> str:
    return ", ".join(f"CAST({c} AS DOUBLE) AS {c.split('.')[-1]}" for c in columns)


# --------------------------------------------------------------------------
# Named parts
# --------------------------------------------------------------------------

QUARTER = "CAST(date_trunc('quarter', o_orderdate) AS DATE)"
MONEY = "DECIMAL(12,2)"
TEST = "o_orderkey % 10 = 0"
PRICE = f"CAST(l_extendedprice AS {MONEY})"
GROSS = f"CASE WHEN {TEST} THEN CAST(3 AS {MONEY}) ELSE {PRICE} END"
OFF = (
    f"CASE WHEN {TEST} THEN CAST(3 AS {MONEY}) "
    f"ELSE CAST({PRICE} * CAST(l_discount AS DECIMAL(4,2)) AS {MONEY}) END"
)

PARTS = {
    "raw": f"""
SELECT CASE WHEN {TEST} THEN {QUARTER} + 40
            ELSE {QUARTER} + CAST(day(o_orderdate) % (3 + quarter(o_orderdate) % 3) AS INTEGER)
       END AS sale_date,
       CAST(10 + o_orderkey * 37 % 9 AS VARCHAR) || ':'
         || lpad(CAST(o_orderkey * 13 % 60 AS VARCHAR), 2, '0') || ':00' AS sale_time,
       CASE p_partkey % 7 WHEN 0 THEN NULL WHEN 1 THEN 'None' WHEN 2 THEN lower(p_type)
            WHEN 3 THEN lower(p_type) || '_goods' WHEN 4 THEN ' ' || p_type || ' '
            ELSE p_type END AS category,
       p_name || ' ' || CAST(p_partkey AS VARCHAR) AS item,
       CASE WHEN {TEST} THEN CAST(1 AS {MONEY}) ELSE CAST(l_quantity AS {MONEY}) END AS qty,
       p_brand AS price_point_name,
       CASE p_partkey % 16 WHEN 0 THEN NULL WHEN 1 THEN '  '
            ELSE 'SKU-' || CAST(p_partkey AS VARCHAR) END AS sku,
       {GROSS} AS gross_sales,
       {OFF} AS discounts,
       CAST({GROSS} - {OFF} AS {MONEY}) AS net_sales,
       CAST({GROSS} * CAST(l_tax AS DECIMAL(4,2)) AS {MONEY}) AS tax,
       CAST(o_orderkey AS VARCHAR) AS transaction_id,
       'LOC-' || CAST(o_custkey % 25 AS VARCHAR) AS location,
       CASE WHEN {TEST} OR o_orderpriority = '1-URGENT' THEN 'CUSTOM_AMOUNT' ELSE 'ITEM' END
         AS itemization_type,
       o_orderpriority AS channel,
       sha256('till of clerk ' || CAST(l_suppkey AS VARCHAR)) AS device_name_key,
       l_linenumber AS line_no
FROM lineitem
JOIN orders ON o_orderkey = l_orderkey
JOIN part ON p_partkey = l_partkey""",
    "sales": f"""
SELECT transaction_id, sale_date, sale_time,
       CASE WHEN trim(sku) <> '' THEN trim(sku) ELSE item END AS item_natural_key,
       nullif(trim(sku), '') AS sku, item AS item_name, price_point_name,
       CASE WHEN category IS NULL OR lower(trim(category)) = 'none' THEN 'Uncategorized'
            ELSE {capitals("replace(trim(category), '_', ' ')")} END AS category_name,
       location AS location_id, device_name_key, channel, itemization_type,
       qty AS quantity, gross_sales, discounts, net_sales, tax,
       'lineitem' AS source_file, line_no
FROM raw""",
    "category": f"""
SELECT {key('category_name')} AS category_key, category_name FROM sales GROUP BY category_name""",
    "item": f"""
SELECT {key('item_natural_key')} AS item_key, {key('max(category_name)')} AS category_key,
       item_natural_key, max(sku) AS sku, max(item_name) AS item_name,
       max(category_name) AS category_name
FROM sales GROUP BY item_natural_key""",
    "cheapest": """
SELECT min(CAST(gross_sales AS DOUBLE) / CAST(quantity AS DOUBLE)) AS price
FROM sales WHERE itemization_type = 'ITEM' AND quantity > 0 AND gross_sales > 0""",
    "day": """
SELECT sale_date, sum(net_sales) AS taken,
       CAST(sum(net_sales) AS DOUBLE) >= coalesce((SELECT price FROM cheapest), 0) AS open
FROM sales GROUP BY sale_date""",
    "opened": f"""
SELECT sale_date, before,
       CAST(before IS NULL OR sale_date - before > {EVENT_GAP_DAYS} AS INTEGER) AS starts
FROM (SELECT sale_date, lag(sale_date) OVER (ORDER BY sale_date) AS before
      FROM day WHERE open) AS d""",
    "event_day": """
SELECT sale_date, before, starts, n, min(sale_date) OVER (PARTITION BY n) AS began,
       row_number() OVER (PARTITION BY n ORDER BY sale_date) AS nth
FROM (SELECT *, sum(starts) OVER (ORDER BY sale_date ROWS UNBOUNDED PRECEDING) AS n
      FROM opened) AS e""",
    "dates": f"""
SELECT {key('d.sale_date')} AS date_key, d.sale_date AS full_date, d.open AS is_trading_day,
       {key('coalesce(e.n, 0)')} AS event_key,
       coalesce('Event ' || CAST(e.n AS VARCHAR) || ' (' || CAST(e.began AS VARCHAR) || ')',
                'Non-trading day') AS event_name,
       e.began AS event_start_date,
       coalesce('Day ' || CAST(e.nth AS VARCHAR), 'Non-trading') AS convention_day,
       CAST(coalesce(e.nth, 0) AS BIGINT) AS day_in_event,
       dayname(d.sale_date) AS day_of_week,
       isodow(d.sale_date) >= 6 AS is_weekend
FROM day AS d LEFT JOIN event_day AS e USING (sale_date)""",
    "line": f"""
SELECT {key('transaction_id', 'item_natural_key', 'sale_time')} AS sale_line_key,
       {key('transaction_id', 'item_natural_key', 'sale_time', 'line_no')} AS sale_line_uid,
       transaction_id, {key('item_natural_key')} AS item_key, sale_time,
       CAST(sale_time[1:2] AS BIGINT) AS hour_of_day, location_id, device_name_key, channel,
       quantity, gross_sales, discounts, net_sales, tax, {key('sale_date')} AS date_key
FROM sales""",
    "open_line": """
SELECT l.*, d.event_key, d.event_name, d.convention_day, d.full_date, d.day_in_event
FROM line AS l JOIN dates AS d USING (date_key) WHERE d.is_trading_day""",
    "actual": """
SELECT item_key, date_key, sum(quantity) AS quantity, sum(net_sales) AS net_sales,
       sum(gross_sales) AS gross_sales, count(DISTINCT transaction_id) AS transactions
FROM line GROUP BY item_key, date_key""",
    "grid": """
SELECT i.item_key, i.item_name, i.category_name, d.date_key, d.full_date, d.convention_day,
       d.day_in_event, d.event_name
FROM item AS i, dates AS d WHERE d.is_trading_day""",
    "daily": f"""
SELECT {key('g.item_key', 'g.date_key')} AS item_day_key, g.*,
       coalesce(a.quantity, 0) AS quantity, coalesce(a.net_sales, 0) AS net_sales,
       coalesce(a.gross_sales, 0) AS gross_sales, coalesce(a.transactions, 0) AS transactions,
       a.item_key IS NOT NULL AS sold_that_day
FROM grid AS g LEFT JOIN actual AS a ON (a.item_key, a.date_key) = (g.item_key, g.date_key)""",
    "held": """
SELECT DISTINCT event_key, transaction_id, item_key FROM open_line""",
    "pair": f"""
SELECT {key('p.event_key', 'p.x', 'p.y')} AS item_pair_key, p.event_key,
       (SELECT any_value(event_name) FROM dates WHERE dates.event_key = p.event_key) AS event_name,
       p.x AS item_a_key, p.y AS item_b_key, u.item_name AS item_a, v.item_name AS item_b,
       u.item_name || '  +  ' || v.item_name AS pair_label, p.baskets
FROM (SELECT h.event_key, h.item_key AS x, k.item_key AS y, count(*) AS baskets
      FROM held AS h JOIN held AS k USING (transaction_id)
      WHERE h.item_key < k.item_key GROUP BY ALL) AS p
JOIN item AS u ON u.item_key = p.x JOIN item AS v ON v.item_key = p.y""",
    "bridge": f"""
SELECT {key('item_pair_key', 'member')} AS pair_member_key, item_pair_key, member AS item_key
FROM (SELECT item_pair_key, unnest([item_a_key, item_b_key]) AS member FROM pair) AS m""",
    # Order documents, as the mapping builds them.
    "zone": """
SELECT 'LOC-' || CAST(n_nationkey AS VARCHAR) AS location_id,
       CASE n_nationkey % 3 WHEN 0 THEN 'America/Los_Angeles' WHEN 1 THEN 'America/New_York'
            ELSE 'UTC' END AS zone
FROM nation""",
    "chunk": """
SELECT l_orderkey, (l_linenumber - 1) // 500 AS chunk, count(*) AS n_lines FROM lineitem GROUP BY ALL""",
    "document": f"""
SELECT orders.*, coalesce(chunk, 0) AS chunk, coalesce(n_lines, 0) AS n_lines,
       'ORD-' || CAST(o_orderkey AS VARCHAR) || CASE WHEN chunk > 0 THEN '/' || CAST(chunk AS VARCHAR) ELSE '' END AS id,
       'LOC-' || CAST(o_custkey % 25 AS VARCHAR) AS location_id,
       CASE o_orderstatus WHEN 'F' THEN 'COMPLETED' WHEN 'O' THEN 'OPEN' ELSE 'CANCELED' END
         AS state,
       {QUARTER} + CAST(day(o_orderdate) % (3 + quarter(o_orderdate) % 3) AS INTEGER)
         + to_minutes(CAST(o_orderkey * 37 % 1440 AS INTEGER)) AS moment
FROM orders LEFT JOIN chunk ON l_orderkey = o_orderkey""",
    "document_line": """
SELECT d.*, l_partkey, l_quantity, CAST(round(l_extendedprice * 100) AS BIGINT) AS cents,
       row_number() OVER (PARTITION BY d.id ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_quantity)
         - 1 AS line_no,
       l_linenumber % 3 AS kind,
       CASE l_linenumber % 3 WHEN 0 THEN 'CUSTOM_AMOUNT' ELSE 'ITEM' END AS item_type,
       CASE l_linenumber % 3 WHEN 1 THEN 'typed at the till'
            WHEN 2 THEN CASE WHEN l_partkey % 4 = 0 THEN 'loose item' END
            ELSE CASE WHEN o_orderkey % 5 = 0 THEN 'gift wrap' END END AS typed_name,
       CASE WHEN l_linenumber % 3 = 1 OR (l_linenumber % 3 = 2 AND l_partkey % 4 <> 0)
            THEN 'VAR-' || CAST(l_partkey AS VARCHAR) END AS variation_id
FROM document AS d JOIN lineitem AS l ON l.l_orderkey = d.o_orderkey AND (l_linenumber - 1) // 500 = d.chunk""",
    "priced_line": """
SELECT *, CASE WHEN kind = 0 AND o_orderkey % 2 = 1 THEN 0 ELSE cents END AS gross,
       CASE WHEN o_orderkey % 2 = 0 THEN cents % 500 ELSE 0 END AS off,
       cents % 97 AS due
FROM document_line""",
    "variation": """
SELECT 'VAR-' || CAST(p_partkey AS VARCHAR) AS variation_id,
       CASE WHEN p_partkey % 9 <> 8 THEN p_name END AS item_name,
       CASE WHEN p_partkey % 16 <> 0 THEN 'SKU-' || CAST(p_partkey AS VARCHAR) END AS sku,
       p_brand AS variation_name,
       CASE WHEN p_partkey % 9 <> 8 AND p_partkey % 4 <> 3 THEN p_type END AS category_name
FROM part""",
    "flat": """
SELECT l.id AS transaction_id, l.line_no, l.state, l.moment, CAST(l.local_moment AS DATE) AS sale_date,
       strftime(l.local_moment, '%H:%M:%S') AS sale_time, l.zone AS time_zone,
       v.category_name AS category,
       coalesce(v.item_name, l.typed_name,
                CASE l.item_type WHEN 'ITEM' THEN 'Unnamed line item'
                     ELSE 'Custom amount (unnamed)' END) AS item,
       v.item_name AS catalog_name,
       CASE WHEN l.l_partkey % 11 = 0 THEN 0 ELSE CAST(l.l_quantity AS BIGINT) END AS qty,
       CASE WHEN l.o_orderkey % 3 = 0 THEN 'Large' ELSE v.variation_name END AS price_point_name,
       v.sku, l.gross, l.off, l.due, l.location_id AS location,
       CASE WHEN l.o_orderkey % 6 = 0 THEN 'kg' ELSE 'ea' END AS unit,
       l.item_type AS itemization_type, l.o_orderpriority AS channel
FROM (SELECT p.*, zone, (moment AT TIME ZONE 'UTC') AT TIME ZONE zone AS local_moment
      FROM priced_line AS p JOIN zone USING (location_id)) AS l
LEFT JOIN variation AS v USING (variation_id)""",
    "exported": """
SELECT CAST(l_orderkey AS VARCHAR) AS transaction_id,
       p_name || ' 12" wide,' || chr(10) || 'boxed' AS name,
       CASE WHEN p_partkey % 16 > 1 THEN 'SKU-' || CAST(p_partkey AS VARCHAR) END AS sku,
       CASE WHEN l_linenumber < 7 THEN CAST(l_quantity AS BIGINT) ELSE 1 END AS quantity,
       CASE WHEN l_linenumber <> 1 THEN p_type END AS category,
       CAST(round(l_extendedprice * 100) AS BIGINT)
         * CASE WHEN l_returnflag = 'R' THEN -1 ELSE 1 END AS paid,
       coalesce(CASE WHEN p_partkey % 16 > 1 THEN 'SKU-' || CAST(p_partkey AS VARCHAR) END,
                p_name || ' 12" wide,' || chr(10) || 'boxed') AS natural_key,
       row_number() OVER (
         PARTITION BY coalesce(CASE WHEN p_partkey % 16 > 1
                               THEN 'SKU-' || CAST(p_partkey AS VARCHAR) END, p_name)
         ORDER BY l_shipdate, l_orderkey, l_linenumber, l_partkey, l_extendedprice, l_quantity,
                  l_returnflag) AS nth
FROM lineitem JOIN part ON p_partkey = l_partkey""",
}

_WORD = re.compile(r"\b[a-z_]+\b")


def _needs(text: str) -> set[str]:
    words = set(_WORD.findall(re.sub(r"'[^']*'", "", text)))
    return {p for p in PARTS if p in words and re.search(rf"(FROM|JOIN|,)\s+{p}\b", text)}


def sql(text: str) -> str:
    """The text with every part it mentions, directly or through another part."""
    wanted: set[str] = set()
    todo = _needs(text)
    while todo:
        wanted |= todo
        todo = set().union(*(_needs(PARTS[p]) for p in todo)) - wanted
    chain = ", ".join(f"{name} AS ({PARTS[name]})" for name in PARTS if name in wanted)
    return f"WITH {chain}\n{text}" if chain else text


# --------------------------------------------------------------------------
# Checks
# --------------------------------------------------------------------------

# What each table is called among the parts.
PART_OF = {
    "raw_lines": "raw",
    "dim_category": "category",
    "dim_item": "item",
    "dim_date": "dates",
    "fact_sales_line": "line",
    "fact_item_daily": "daily",
    "fact_item_pairs": "pair",
    "bridge_item_pair": "bridge",
}


def count(name: str, table: str, condition: str) -> str:
    return (
        f"SELECT '{name}' AS check_name, CAST(count(*) AS BIGINT) AS violations "
        f"FROM {table} WHERE {condition}"
    )


def verdict(name: str, broken: str) -> str:
    return f"SELECT '{name}' AS check_name, CAST(({broken}) AS BIGINT) AS violations"


def repeated(name: str, table: str, columns: str) -> str:
    return count(
        name, f"(SELECT {columns} FROM {table} GROUP BY {columns} HAVING count(*) > 1) AS r", "true"
    )


def orphans(name: str, table: str, column: str, parent: str, parent_column: str) -> str:
    return count(
        name, table, f"{column} NOT IN (SELECT {parent_column} FROM {parent}) AND {column} IS NOT NULL"
    )


def every(*parts: str) -> str:
    return "\nUNION ALL ".join(parts)


NOT_NULLS = [
    count(f"not_null_{table}_{column}", PART_OF[table], f"{column} IS NULL")
    for table, columns in checks.NOT_NULL.items()
    for column in columns
]
UNIQUES = [
    repeated(f"unique_{table}_{column}", PART_OF[table], column)
    for table, columns in checks.UNIQUE.items()
    for column in columns
]
REFERENCES = [
    orphans(f"relationships_{table}_{column}", PART_OF[table], column, PART_OF[parent], other)
    for table, wanted in checks.REFERENCES.items()
    for column, parent, other in wanted
]


def _total(table: str, where: str = "true") -> str:
    return f"(SELECT sum(net_sales) FROM {table} WHERE {where})"


def _size(table: str, where: str = "true") -> str:
    return f"(SELECT count(*) FROM {table} WHERE {where})"


def _drifted_daily(name: str, event: str) -> str:
    return count(
        name,
        "daily AS f JOIN item AS i USING (item_key) JOIN dates AS d USING (date_key)",
        "f.item_name IS DISTINCT FROM i.item_name "
        "OR f.convention_day IS DISTINCT FROM d.convention_day "
        f"OR {event} IS DISTINCT FROM d.event_name",
    )


def _drifted_pairs(name: str, first: str, second: str) -> str:
    return count(
        name,
        "pair AS p JOIN item AS i ON i.item_key = item_a_key JOIN item AS j ON j.item_key = item_b_key",
        f"{first} IS DISTINCT FROM i.item_name OR {second} IS DISTINCT FROM j.item_name",
    )


def _poor_days(name: str, which: str) -> str:
    return count(
        name,
        f"day, cheapest",
        f"{which} AND CAST(taken AS DOUBLE) < price",
    )


def _respelled(name: str, names: str) -> str:
    return count(
        name,
        f"(SELECT count(*) AS n FROM ({names}) AS c(name) "
        "GROUP BY lower(replace(replace(name, ' ', ''), '_', '')) HAVING count(*) > 1) AS s",
        "true",
    )


CHECKS = {
    "check_not_null": every(
        *NOT_NULLS, count("not_null_raw_lines_transaction_id_damaged", "raw", "channel = '5-LOW'")
    ),
    "check_unique": every(
        *UNIQUES,
        repeated("unique_fact_sales_line_sale_line_uid", "line", "sale_line_uid"),
        count("unique_dim_item_item_key_damaged", "item", "sku IS NULL"),
    ),
    "check_orphans": every(
        *REFERENCES,
        verdict("no_orphaned_revenue", _size("line", "item_key NOT IN (SELECT item_key FROM item)")),
        count(
            "relationships_fact_sales_line_item_key_damaged",
            "line JOIN item USING (item_key)",
            "sku IS NULL",
        ),
        count(
            "no_orphaned_revenue_damaged",
            "line JOIN item USING (item_key) JOIN dates USING (date_key)",
            "sku IS NULL OR NOT is_trading_day",
        ),
    ),
    "check_hours": every(
        count("accepted_values_fact_sales_line_hour_of_day", "line", "hour_of_day NOT BETWEEN 0 AND 23"),
        count(
            "accepted_values_fact_sales_line_hour_of_day_damaged",
            "line",
            "hour_of_day + 10 NOT BETWEEN 0 AND 23",
        ),
    ),
    "check_raw_vs_staging": every(
        verdict(
            "staging_preserves_raw_revenue",
            f"{_size('raw')} <> {_size('sales')} "
            f"OR abs({_total('raw')} - {_total('sales')}) > 0.01",
        ),
        verdict(
            "staging_preserves_raw_revenue_damaged",
            f"{_size('raw')} <> {_size('raw', 'category IS NOT NULL')}",
        ),
    ),
    "check_fact_revenue": every(
        verdict("fact_revenue_reconciles", f"abs({_total('sales')} - {_total('line')}) > 0.01"),
        verdict(
            "fact_revenue_reconciles_damaged",
            f"abs({_total('sales')} - {_total('line', chr(10) + 'channel <> ' + repr('5-LOW'))}) > 0.01",
        ),
    ),
    "check_fact_rows": every(
        verdict("fact_rowcount_matches_staging", f"{_size('sales')} <> {_size('line')}"),
        verdict(
            "fact_rowcount_matches_staging_damaged",
            f"{_size('sales')} <> {_size('line', 'net_sales <> 0')}",
        ),
    ),
    "check_grid_complete": every(
        verdict(
            "item_daily_grid_is_complete",
            f"{_size('item')} * {_size('dates', 'is_trading_day')} <> {_size('daily')}",
        ),
        verdict(
            "item_daily_grid_is_complete_damaged",
            f"{_size('item')} * {_size('dates', 'is_trading_day')} <> {_size('daily', 'sold_that_day')}",
        ),
    ),
    "check_dense_revenue": every(
        verdict("item_daily_revenue_reconciles", f"{_total('daily')} <> {_total('open_line')}"),
        verdict(
            "item_daily_revenue_reconciles_damaged",
            f"{_total('daily')} + {_total('daily', 'day_in_event = 1')} <> {_total('open_line')}",
        ),
    ),
    "check_daily_labels": every(
        _drifted_daily("item_daily_labels_match_dimensions", "f.event_name"),
        _drifted_daily(
            "item_daily_labels_match_dimensions_damaged",
            "CASE WHEN f.day_in_event > 1 THEN f.event_name END",
        ),
    ),
    "check_pair_dim_labels": every(
        _drifted_pairs("item_pairs_labels_match_dimensions", "item_a", "item_b"),
        _drifted_pairs("item_pairs_labels_match_dimensions_damaged", "item_b", "item_a"),
    ),
    "check_pairs_unordered": every(
        count("item_pairs_are_unordered", "pair", "item_a_key >= item_b_key"),
        count("item_pairs_are_unordered_damaged", "pair", "item_a_key <> item_b_key"),
    ),
    "check_pair_labels": every(
        repeated("pair_labels_unique_within_event", "pair", "event_key, pair_label"),
        repeated("pair_labels_unique_within_event_damaged", "pair", "event_key, item_a"),
    ),
    "check_bridge": every(
        count(
            "bridge_resolves_each_pair",
            "(SELECT item_pair_key FROM pair JOIN bridge USING (item_pair_key) "
            "GROUP BY item_pair_key HAVING count(*) <> 2 "
            "OR count(*) FILTER (item_key IN (item_a_key, item_b_key)) <> 2) AS b",
            "true",
        ),
        count("bridge_resolves_each_pair_damaged", "pair", "true"),
    ),
    "check_event_floor": every(
        _poor_days("events_clear_the_catalog_floor", "open"),
        _poor_days("events_clear_the_catalog_floor_damaged", "true"),
    ),
    "check_category_spellings": every(
        _respelled("categories_are_case_normalised", "SELECT category_name FROM category"),
        _respelled(
            "categories_are_case_normalised_damaged",
            "SELECT category_name FROM category UNION ALL (SELECT DISTINCT category FROM raw)",
        ),
    ),
    "check_quantity": every(
        count("quantity_non_negative", "line", "quantity < 0"),
        count("quantity_non_negative_damaged", "line", "channel = '2-HIGH' AND quantity > 0"),
    ),
}

# --------------------------------------------------------------------------
# Everything else
# --------------------------------------------------------------------------

LINE_MEASURES = doubles("quantity", "gross_sales", "discounts", "net_sales", "tax")
DAY_MEASURES = doubles("quantity", "net_sales", "gross_sales")

REPLACED = """
SELECT sale_date, count(*) AS lines,
       CAST(sum(qty) + CASE WHEN quarter(sale_date) = 4 THEN count(*) ELSE 0 END AS DOUBLE) AS qty,
       CAST(sum(net_sales) AS DOUBLE) AS net_sales
FROM raw GROUP BY sale_date"""

UNIT_CHANGE = """
SELECT *, units - prev_units AS unit_change
FROM (SELECT *, lag(units) OVER (PARTITION BY event_name, item_name ORDER BY full_date)
             AS prev_units
      FROM (SELECT event_name, item_name, full_date, convention_day, day_in_event,
                   sum(quantity) AS units
            FROM daily GROUP BY ALL) AS u) AS v"""

OTHERS = {
    "orders_replay": """
SELECT id, state,
       CASE WHEN state <> 'OPEN' THEN strftime(moment, '%Y-%m-%dT%H:%M:%SZ') END AS closed_at,
       n_lines AS lines
FROM document""",
    "replay_one_extract": "SELECT id, 'OPEN' AS state, least(n_lines, 1) AS lines FROM document",
    "completed_orders_window": """
SELECT o_orderkey, location_id, CAST(o_orderdate AS DATE) AS closed_on
FROM (SELECT DISTINCT o_orderkey, location_id, o_orderdate, o_orderstatus FROM document) AS d
WHERE o_orderstatus = 'F' AND o_orderdate >= TIMESTAMP '1996-01-01'
  AND o_orderdate < TIMESTAMP '1999-01-01'""",
    "incremental_window": """
SELECT event_id, user_id, event_type, value
FROM events, (SELECT max(ts) AS stop FROM events) AS m
WHERE ts >= stop - INTERVAL 24 HOURS AND ts < stop""",
    "archive_roundtrip": """
SELECT extract_hour, location_id, state, count(*) AS documents, CAST(sum(lines) AS BIGINT) AS lines
FROM (SELECT CAST(6 AS BIGINT) AS extract_hour, location_id, 'OPEN' AS state, least(n_lines, 1) AS lines
      FROM document
      UNION ALL
      SELECT 18, location_id, 'OPEN', least(n_lines, 1) FROM document
      WHERE o_orderkey % 3 = 0
      UNION ALL
      SELECT 18, location_id, state, n_lines FROM document) AS a
GROUP BY extract_hour, location_id, state""",
    "csv_landing_roundtrip": f"""
SELECT sale_date, sale_time, 'America/Los_Angeles' AS time_zone, category, item,
       {doubles('qty')}, price_point_name, nullif(sku, '  ') AS sku,
       {doubles('gross_sales', 'discounts', 'net_sales', 'tax')}, transaction_id, location,
       'ea' AS unit, CAST(qty AS DOUBLE) AS count, itemization_type, channel, device_name_key,
       CAST(NULL AS VARCHAR) AS convention_day, 'lineitem' AS source_file
FROM raw""",
    "idempotent_date_replace": REPLACED,
    "full_refresh": """
SELECT count(*) AS table_rows, count(DISTINCT sale_date) AS sale_dates,
       CAST(sum(net_sales) * 2 AS DOUBLE) AS net_sales
FROM raw""",
    "observed_loads": """
SELECT CAST(1 AS BIGINT) AS number, count(*) AS table_rows, count(DISTINCT sale_date) AS sale_dates,
       CAST(sum(net_sales) AS DOUBLE) AS net_sales
FROM raw
UNION ALL
SELECT 2, count(*), count(DISTINCT sale_date), CAST(sum(net_sales) AS DOUBLE) FROM raw WHERE quarter(sale_date) = 4""",
    "pos_export_items": """
SELECT natural_key, name, sku, category,
       CASE WHEN paid < 0 THEN 0 ELSE paid // greatest(quantity, 1) END AS price_cents
FROM exported WHERE nth = 1""",
    "pos_export_lines": """
SELECT transaction_id, natural_key, count(*) AS lines, CAST(sum(quantity) AS BIGINT) AS quantity
FROM exported GROUP BY transaction_id, natural_key""",
    "export_dim_item": """
SELECT item_key, category_key, item_natural_key, sku,
       ' 12" ' || item_name || ', "boxed"' || chr(10) || chr(92) || ' ' AS item_name, category_name
FROM item""",
    "export_fact_sales_line": f"""
SELECT sale_line_key, sale_line_uid, transaction_id, item_key, sale_time, hour_of_day, channel,
       {LINE_MEASURES}, date_key
FROM line""",
    "incremental_load": """
SELECT sale_date, count(*) AS lines, CAST(sum(qty) AS DOUBLE) AS qty,
       CAST(sum(gross - off) AS DOUBLE) / 100 AS net_sales
FROM flat WHERE state = 'COMPLETED' AND CAST(split_part(substr(transaction_id, 5), '/', 1) AS BIGINT) % 50 <> 7
GROUP BY sale_date""",
    "window_load": """
SELECT sale_date, count(*) AS lines, CAST(sum(gross - off) AS DOUBLE) / 100 AS net_sales
FROM flat
WHERE state = 'COMPLETED' AND moment >= TIMESTAMP '1995-01-02' AND moment < TIMESTAMP '1997-07-04'
GROUP BY sale_date""",
    "catalog_as_of": """
SELECT variation_id, 'old ' || item_name AS item_name, sku
FROM variation WHERE CAST(substr(variation_id, 5) AS BIGINT) % 5 <> 0""",
    "quarantined_lines": """
SELECT transaction_id, line_no, item, CAST(qty AS DOUBLE) AS qty,
       CAST(gross - off AS DOUBLE) / 100 AS net_sales
FROM flat WHERE state = 'COMPLETED' AND CAST(split_part(substr(transaction_id, 5), '/', 1) AS BIGINT) % 50 = 7""",
    "flatten_line_items": """
SELECT sale_date, sale_time, time_zone, category, item, CAST(qty AS DOUBLE) AS qty,
       price_point_name, sku, CAST(gross AS DOUBLE) / 100 AS gross_sales,
       CAST(off AS DOUBLE) / 100 AS discounts, CAST(gross - off AS DOUBLE) / 100 AS net_sales,
       CAST(due AS DOUBLE) / 100 AS tax, transaction_id, location, unit,
       CAST(qty AS DOUBLE) AS count, itemization_type, channel,
       'point_of_sale:archive' AS source_file, line_no
FROM flat WHERE state = 'COMPLETED'""",
    "net_sales_calc": """
SELECT id AS transaction_id, line_no, CAST(gross AS DOUBLE) / 100 AS gross_sales,
       CAST(off AS DOUBLE) / 100 AS discounts, CAST(gross - off AS DOUBLE) / 100 AS net_sales,
       CAST(due AS DOUBLE) / 100 AS tax
FROM priced_line""",
    "device_pseudonym": """
SELECT sha256('till of clerk ' || CAST(l_suppkey AS VARCHAR)) AS device_name_key,
       count(*) AS lines
FROM lineitem GROUP BY l_suppkey""",
    "catalog_lookup": """
SELECT variation_id, item_name, sku, variation_name, category_name FROM variation""",
    "catalog_stats": """
SELECT 'CATEGORY' AS type, count(*) AS documents, count(DISTINCT lower(p_type)) AS objects FROM part
UNION ALL SELECT 'ITEM', count(*), count(*) FROM part
UNION ALL SELECT 'ITEM_VARIATION', count(*), count(*) FROM part""",
    "enrich_lines": """
SELECT transaction_id, line_no, catalog_name AS item_name, sku, category AS category_name FROM flat""",
    "local_sale_time": """
SELECT event_id, zone AS time_zone, CAST(here AS DATE) AS sale_date,
       CAST(here AS VARCHAR)[12:] AS sale_time
FROM (SELECT event_id, zone, (ts AT TIME ZONE 'UTC') AT TIME ZONE zone AS here
      FROM events JOIN zone ON location_id = 'LOC-' || CAST(user_id % 25 AS VARCHAR)) AS e""",
    "cents_to_money": """
SELECT event_id, CASE WHEN event_type = 'error' THEN 0.0
                      ELSE CAST(CAST(round(value * 100) AS BIGINT) AS DOUBLE) / 100 END AS amount
FROM events""",
    "parse_currency": """
SELECT l_orderkey, l_returnflag, CAST(sum(cents) AS BIGINT) AS cents, min(cents) AS least
FROM (SELECT l_orderkey, l_returnflag,
             CASE WHEN l_returnflag = 'R' THEN -CAST(round(l_extendedprice * 100) AS BIGINT)
                  WHEN l_linenumber = 7 THEN 0
                  ELSE CAST(round(l_extendedprice * 100) AS BIGINT) END AS cents
      FROM lineitem) AS c
GROUP BY l_orderkey, l_returnflag""",
    "slug": """
SELECT page_id, trim(regexp_replace(lower(trim(coalesce(nullif(url, ''), 'none'))),
                                    '[^a-z0-9]+', '_', 'g'), '_') AS slug
FROM pages""",
    "item_natural_key": """
SELECT sku, item, CASE WHEN trim(sku) <> '' THEN trim(sku) ELSE item END AS item_natural_key,
       count(*) AS lines
FROM raw GROUP BY sku, item""",
    "category_normalise": """
SELECT r.category, s.category_name, count(*) AS lines
FROM (SELECT category, row_number() OVER () AS n FROM raw) AS r
JOIN (SELECT category_name, row_number() OVER () AS n FROM sales) AS s USING (n)
GROUP BY r.category, s.category_name""",
    "pair_label": """
SELECT pair_label, count(*) AS pairs, CAST(sum(baskets) AS BIGINT) AS baskets
FROM pair GROUP BY pair_label""",
    "surrogate_keys": f"""
SELECT p_partkey, {key('p_partkey')} AS single_key,
       {key('p_name', 'CASE WHEN p_partkey % 16 <> 0 THEN p_type END', 'p_size')} AS joint_key
FROM part""",
    "calendar_attrs": """
SELECT full_date, dayname(full_date) AS day_of_week, dayofweek(full_date) IN (0, 6) AS is_weekend,
       count(*) AS orders
FROM (SELECT CAST(o_orderdate AS DATE) AS full_date FROM orders) AS o GROUP BY full_date""",
    "line_item_name": """
SELECT item, itemization_type AS item_type, count(*) AS lines
FROM flat GROUP BY item, itemization_type""",
    "category_resolution": """
SELECT 'ITEM-' || CAST(p_partkey AS VARCHAR) AS id,
       CASE WHEN p_partkey % 4 <> 3 THEN 'CAT-' || lower(p_type) END AS category_id
FROM part""",
    "stg_sales": f"""
SELECT transaction_id, sale_date, sale_time, item_natural_key, sku, item_name, price_point_name,
       category_name, location_id, device_name_key, channel, itemization_type, {LINE_MEASURES},
       source_file, CAST(line_no AS BIGINT) AS line_no
FROM sales""",
    "dim_category": "SELECT category_key, category_name FROM category",
    "dim_item": """
SELECT item_key, category_key, item_natural_key, sku, item_name, category_name FROM item""",
    "dim_date": """
SELECT date_key, full_date, is_trading_day, event_key, event_name, event_start_date,
       convention_day, day_in_event, day_of_week, is_weekend
FROM dates""",
    "fact_sales_line": f"""
SELECT sale_line_key, sale_line_uid, transaction_id, item_key, sale_time, hour_of_day,
       location_id, device_name_key, channel, {LINE_MEASURES}, date_key
FROM line""",
    "fact_item_daily": f"""
SELECT item_day_key, item_key, item_name, category_name, date_key, full_date, convention_day,
       day_in_event, event_name, {DAY_MEASURES}, CAST(transactions AS BIGINT) AS transactions,
       sold_that_day
FROM daily""",
    "fact_item_pairs": """
SELECT item_pair_key, event_key, event_name, item_a_key, item_b_key, item_a, item_b, pair_label,
       baskets
FROM pair""",
    "bridge_item_pair": "SELECT pair_member_key, item_pair_key, item_key FROM bridge",
    "catalog_floor": "SELECT round(price, 6) AS floor_amount FROM cheapest",
    "trading_days": """
SELECT sale_date, CAST(taken AS DOUBLE) AS day_net_sales, open AS is_trading_day FROM day""",
    "trading_day_gaps": """
SELECT sale_date, before AS prev_date, CAST(starts AS BIGINT) AS is_event_start FROM opened""",
    "event_islands": "SELECT sale_date, CAST(n AS BIGINT) AS event_number FROM event_day",
    "event_days": """
SELECT sale_date, CAST(n AS BIGINT) AS event_number, began AS event_start_date,
       nth AS day_in_event
FROM event_day""",
    "item_day_grid": """
SELECT item_key, item_name, category_name, date_key, full_date, convention_day, day_in_event,
       event_name
FROM grid""",
    "item_daily_actual": f"""
SELECT item_key, date_key, {DAY_MEASURES}, transactions FROM actual""",
    "basket_items": "SELECT event_key, transaction_id, item_key FROM held",
    "basket_lines": """
SELECT transaction_id, date_key, count(*) AS lines_in_basket,
       CAST(sum(quantity) AS DOUBLE) AS units, CAST(sum(net_sales) AS DOUBLE) AS basket_value
FROM open_line GROUP BY transaction_id, date_key""",
    "revenue_by_category": f"""
SELECT category_name, CAST(units AS DOUBLE) AS units_sold, CAST(taken AS DOUBLE) AS revenue,
       {share(cents('taken'), '(SELECT ' + cents('sum(net_sales)') + ' FROM open_line)', 1)}
         AS pct_of_total
FROM (SELECT c.category_name, sum(l.quantity) AS units, sum(l.net_sales) AS taken
      FROM open_line AS l JOIN item AS i USING (item_key)
      JOIN category AS c ON c.category_key = i.category_key
      GROUP BY c.category_name) AS t""",
    "top3_items_per_category": """
SELECT category_name, item_name, CAST(taken AS DOUBLE) AS revenue, rnk
FROM (SELECT *, rank() OVER (PARTITION BY category_name ORDER BY taken DESC) AS rnk
      FROM (SELECT i.category_name, i.item_name, sum(l.net_sales) AS taken
            FROM open_line AS l JOIN item AS i USING (item_key) GROUP BY ALL) AS t) AS r
WHERE rnk <= 3""",
    "cumulative_revenue": """
SELECT event_name, convention_day, full_date, CAST(taken AS DOUBLE) AS daily_revenue,
       CAST((SELECT sum(o.net_sales) FROM open_line AS o
             WHERE o.event_name = t.event_name AND o.full_date <= t.full_date) AS DOUBLE)
         AS cumulative_revenue
FROM (SELECT event_name, convention_day, full_date, sum(net_sales) AS taken
      FROM open_line GROUP BY ALL) AS t""",
    "basket_stats": f"""
SELECT event_name, convention_day, n AS transactions,
       {half_up(cents('v') , 'n', 0)} / 100 AS avg_basket_value,
       {half_up(cents('u'), 'n', 0)} / 100 AS avg_units_per_basket,
       CAST(top AS DOUBLE) AS largest_basket
FROM (SELECT event_name, convention_day, count(*) AS n, sum(taken) AS v, sum(units) AS u,
             max(taken) AS top
      FROM (SELECT event_name, convention_day, transaction_id, sum(net_sales) AS taken,
                   sum(quantity) AS units
            FROM open_line GROUP BY ALL) AS b
      GROUP BY event_name, convention_day) AS s""",
    "hourly_curve": """
SELECT event_name, convention_day, hour_of_day, count(DISTINCT transaction_id) AS transactions,
       CAST(sum(net_sales) AS DOUBLE) AS revenue
FROM open_line GROUP BY event_name, convention_day, hour_of_day""",
    "items_bought_together": """
SELECT i.item_name AS item_a, j.item_name AS item_b, count(*) AS times_bought_together
FROM line AS l JOIN line AS m ON m.transaction_id = l.transaction_id AND m.item_key > l.item_key
JOIN item AS i ON i.item_key = l.item_key JOIN item AS j ON j.item_key = m.item_key
GROUP BY ALL HAVING count(*) > 1 ORDER BY 3 DESC, 1, 2 LIMIT 15""",
    "velocity_sparse": f"""
SELECT item_name, category_name, event_name, convention_day,
       {doubles('prev_day_units', 'today_units', 'unit_change')},
       CASE WHEN prev_day_units > 0
            THEN {half_up('100 * ' + cents('unit_change'), cents('prev_day_units'), 0)} END AS pct_change
FROM (SELECT *, today_units - prev_day_units AS unit_change
      FROM (SELECT *, lag(today_units) OVER (PARTITION BY item_name, event_name
                                             ORDER BY full_date, category_name) AS prev_day_units
            FROM (SELECT i.item_name, i.category_name, l.event_name, l.full_date,
                         l.convention_day, sum(l.quantity) AS today_units
                  FROM open_line AS l JOIN item AS i USING (item_key) GROUP BY ALL) AS t) AS p) AS c
WHERE prev_day_units IS NOT NULL
ORDER BY c.unit_change DESC, item_name, category_name, event_name, convention_day, c.prev_day_units
LIMIT 15""",
    "headline_tiles": """
SELECT event_name, count(DISTINCT full_date) AS days,
       count(DISTINCT transaction_id) AS transactions, CAST(sum(quantity) AS DOUBLE) AS units_sold,
       count(DISTINCT item_key) AS products_sold
FROM open_line GROUP BY event_name""",
    "revenue_index": f"""
SELECT t.event_name, t.convention_day, t.full_date,
       {share(cents('t.taken'), cents('f.taken'), 1)} AS revenue_index,
       {share(cents('e.taken'), '(' + cents('f.taken') + ' * e.n)', 1)} AS average_index
FROM (SELECT event_name, convention_day, full_date, sum(net_sales) AS taken
      FROM open_line GROUP BY ALL) AS t
JOIN (SELECT event_name, sum(net_sales) AS taken FROM open_line WHERE day_in_event = 1
      GROUP BY event_name) AS f USING (event_name)
JOIN (SELECT event_name, sum(net_sales) AS taken, count(DISTINCT full_date) AS n FROM open_line
      GROUP BY event_name) AS e USING (event_name)""",
    "item_revenue_share_top12": f"""
SELECT item_name,
       {share(cents('taken'), '(SELECT ' + cents('sum(net_sales)') + ' FROM open_line)', 1)}
         AS revenue_share
FROM (SELECT i.item_name, sum(l.net_sales) AS taken
      FROM open_line AS l JOIN item AS i USING (item_key) GROUP BY i.item_name) AS t
ORDER BY taken DESC, item_name LIMIT 12""",
    "item_day_heatmap": """
SELECT event_name, item_name, convention_day, CAST(sum(quantity) AS DOUBLE) AS units
FROM daily GROUP BY event_name, item_name, convention_day""",
    "item_day_heatmap_wide": """
SELECT event_name, item_name,
       CAST(sum(quantity) FILTER (day_in_event = 1) AS DOUBLE) AS day_1,
       CAST(sum(quantity) FILTER (day_in_event = 2) AS DOUBLE) AS day_2,
       CAST(sum(quantity) FILTER (day_in_event = 3) AS DOUBLE) AS day_3,
       CAST(sum(quantity) FILTER (day_in_event = 4) AS DOUBLE) AS day_4,
       CAST(sum(quantity) FILTER (day_in_event = 5) AS DOUBLE) AS day_5
FROM daily GROUP BY event_name, item_name""",
    "named_tables": """
SELECT 'raw_lines' AS table_name, count(*) AS rows, CAST(sum(net_sales) AS DOUBLE) AS net_sales FROM raw
UNION ALL SELECT 'stg_sales', count(*), CAST(sum(net_sales) AS DOUBLE) FROM sales
UNION ALL SELECT 'dim_item', count(*), NULL FROM item
UNION ALL SELECT 'fact_sales_line', count(*), CAST(sum(net_sales) AS DOUBLE) FROM line
UNION ALL SELECT 'fact_item_daily', count(*), CAST(sum(net_sales) AS DOUBLE) FROM daily""",
    "velocity_dense": f"""
SELECT event_name, item_name, convention_day, {doubles('prev_units', 'units', 'unit_change')},
       CASE WHEN unit_change IS NULL THEN 'no prior day' WHEN unit_change > 0 THEN 'gained'
            WHEN unit_change < 0 THEN 'declined' ELSE 'no change' END AS direction
FROM ({UNIT_CHANGE}) AS c WHERE day_in_event > 1""",
    "dropped_to_zero": """
SELECT event_name, item_key, item_name, convention_day, CAST(before AS DOUBLE) AS prev_units
FROM (SELECT *, lag(quantity) OVER (PARTITION BY event_name, item_key
                                    ORDER BY day_in_event) AS before FROM daily) AS d
WHERE quantity = 0 AND before > 0""",
    "peak_hour": """
SELECT event_name, convention_day, hour_of_day, transactions
FROM (SELECT *, max(transactions) OVER (PARTITION BY event_name, convention_day) AS most
      FROM (SELECT event_name, convention_day, hour_of_day,
                   count(DISTINCT transaction_id) AS transactions
            FROM open_line GROUP BY ALL) AS h) AS m
WHERE transactions = most""",
    "top_pairs": """
SELECT event_name, pair_label, baskets, item_pair_key FROM pair
ORDER BY baskets DESC, event_name, pair_label, item_pair_key LIMIT 15""",
    "pairs_for_item": """
SELECT b.item_key, p.item_pair_key, p.event_name, p.pair_label, p.baskets
FROM pair AS p
JOIN (SELECT item_key FROM open_line GROUP BY item_key
      ORDER BY sum(quantity) DESC, item_key LIMIT 1) AS b
  ON b.item_key IN (p.item_a_key, p.item_b_key)""",
    "event_filter": """
SELECT l.event_name, l.item_key, i.item_name, CAST(sum(l.quantity) AS DOUBLE) AS units,
       count(DISTINCT l.transaction_id) AS transactions
FROM open_line AS l JOIN item AS i USING (item_key)
WHERE l.event_key IN (SELECT event_key FROM dates
                      WHERE event_start_date = (SELECT max(event_start_date) FROM dates))
GROUP BY ALL""",
    "trading_hours": """
SELECT event_name, convention_day, min(hour_of_day) AS first_hour, max(hour_of_day) AS last_hour
FROM open_line GROUP BY event_name, convention_day""",
}

OTHERS["named_revenue_by_category"] = OTHERS["revenue_by_category"]

ORACLE: dict[str, str] = {name: sql(text.strip()) for name, text in {**OTHERS, **CHECKS}.items()}
