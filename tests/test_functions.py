import hashlib
from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from eventmart import functions as fn
from eventmart.sources.schemas import CATALOG_OBJECT


def values(spark, rows, schema, column):
    return [r[0] for r in spark.createDataFrame(rows, schema).select(column).collect()]


def test_cents_become_exact_decimals(spark):
    got = values(spark, [(2000,), (63,), (0,), (None,)], "a bigint", fn.from_minor_units(F.col("a")))
    assert got == [Decimal("20.00"), Decimal("0.63"), Decimal("0.00"), Decimal("0.00")]
    total = spark.createDataFrame([(10,)] * 10, "a bigint").agg(F.sum(fn.from_minor_units(F.col("a"))))
    assert total.first()[0] == Decimal("1.00")


def test_currency_text(spark):
    texts = ["$20.00", "($1,234.50)", "", None, "  ", "0.63", "$0.005", "$0.015"]
    got = values(spark, [(t,) for t in texts], "t string", fn.currency_to_cents(F.col("t")))
    assert got == [2000, -123450, 0, 0, 0, 63, 0, 2]


def test_slug(spark):
    texts = ["Art Prints!", "  a--b  ", None, "", "___", "Ünï 1"]
    got = values(spark, [(t,) for t in texts], "t string", fn.slug(F.col("t")))
    assert got == ["art_prints", "a_b", "none", "none", "", "n_1"]


@pytest.mark.parametrize(
    "typed, name",
    [
        (None, "Uncategorized"),
        ("", "Uncategorized"),
        ("  None ", "Uncategorized"),
        ("nan", "Uncategorized"),
        ("NULL", "Uncategorized"),
        ("n/a", "Uncategorized"),
        ("handmade", "Handmade"),
        (" Blindbag ", "Blindbag"),
        ("art_prints", "Art Prints"),
        ("ART  PRINTS", "Art  Prints"),
        ("t-shirt", "T-Shirt"),
        ("o'neil", "O'Neil"),
        ("été d'or", "Été D'Or"),
        ("3d models", "3d Models"),
    ],
)
def test_categories(spark, typed, name):
    assert values(spark, [(typed,)], "t string", fn.clean_category(F.col("t"))) == [name]


def test_natural_key(spark):
    rows = [("S1", "a"), (" S2 ", "b"), ("  ", "c"), (None, "d")]
    got = values(spark, rows, "sku string, item string", fn.natural_key(F.col("sku"), F.col("item")))
    assert got == ["S1", "S2", "c", "d"]


def test_keys_tell_null_positions_apart(spark):
    rows = [(None, "a"), ("a", None), ("a", "b")]
    got = values(spark, rows, "x string, y string", fn.surrogate_key("x", "y"))
    assert len(set(got)) == 3
    # md5 of "a-b", and of a date's own text.
    assert got[2] == hashlib.md5(b"a-b").hexdigest()
    day = values(spark, [(date(2026, 4, 3),)], "d date", fn.surrogate_key("d"))
    assert day == [hashlib.md5(b"2026-04-03").hexdigest()]


def test_pseudonym(spark):
    got = values(spark, [("till",), (" till ",), ("",), (None,)], "t string", fn.pseudonym(F.col("t")))
    assert got[0] == got[1] == hashlib.sha256(b"till").hexdigest()
    assert got[2:] == [None, None]


def test_local_time(spark):
    rows = [
        ("2026-04-04T01:30:00Z", "America/Los_Angeles"),
        ("2026-04-04T01:30:00Z", "Not/ARealZone"),
        ("2026-04-04T03:30:00+02:00", "UTC"),
        ("2026-04-05T15:44:49.125Z", "UTC"),
        ("2026-04-05T15:44:49Z", "+05:00"),
    ]
    table = spark.createDataFrame(rows, "t string, z string")
    local = fn.to_local(fn.iso_to_utc(F.col("t")), fn.known_zone_or_utc(F.col("z")))
    got = table.select(local.alias("l"), fn.time_text(local).alias("s")).collect()
    assert [r.l for r in got][:3] == [
        datetime(2026, 4, 3, 18, 30),
        datetime(2026, 4, 4, 1, 30),
        datetime(2026, 4, 4, 1, 30),
    ]
    assert [r.s for r in got] == ["18:30:00", "01:30:00", "01:30:00", "15:44:49.125", "15:44:49"]


def test_weekdays(spark):
    rows = [(date(2026, 4, d),) for d in (3, 4, 5, 6)]
    table = spark.createDataFrame(rows, "d date").select(
        fn.weekday_name(F.col("d")), fn.is_weekend(F.col("d"))
    )
    assert [tuple(r) for r in table.collect()] == [
        ("Friday", False), ("Saturday", True), ("Sunday", True), ("Monday", False),
    ]


def test_line_names(spark):
    rows = [
        ("catalog", "typed", "ITEM"),
        ("", "typed", "ITEM"),
        (None, "Custom Amount", "CUSTOM_AMOUNT"),
        (None, None, "CUSTOM_AMOUNT"),
        (None, "", "ITEM"),
        (None, None, None),
    ]
    name = fn.line_name(F.col("c"), F.col("t"), F.col("k"))
    assert values(spark, rows, "c string, t string, k string", name) == [
        "catalog", "typed", "Custom Amount", "Custom amount (unnamed)", "Unnamed line item",
        "Unnamed line item",
    ]


def test_category_id_fields(spark):
    def item(legacy=None, reporting=None, listed=None):
        return (
            "ITEM", "I", None,
            ("thing", legacy, reporting and (reporting,), listed and [(i,) for i in listed]),
            None,
        )

    rows = [
        item("LEGACY", "R", ["A"]),
        item(None, "REPORTING", ["A"]),
        item("", None, [None, "", "FIRST", "SECOND"]),
        item(),
    ]
    got = values(spark, rows, CATALOG_OBJECT, fn.category_id(F.col("item_data")))
    assert got == ["LEGACY", "REPORTING", "FIRST", None]


def test_spelling_key(spark):
    got = values(
        spark, [("Art Prints",), ("art_prints",), ("ARTPRINTS",)], "t string", fn.spelling_key(F.col("t"))
    )
    assert set(got) == {"artprints"}
