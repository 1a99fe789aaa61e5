"""Cleaning and labelling of hand-typed text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

UNCATEGORISED = "Uncategorized"

# Spellings of "no category" found in exports.
NO_CATEGORY = ["", "none", "nan", "null", "n/a"]

# Names for lines sold without one.
UNNAMED_AMOUNT = "Custom amount (unnamed)"
UNNAMED_LINE = "Unnamed line item"

PAIR_JOINT = "  +  "


def blank_to_null(text: Column) -> Column:
    """Trimmed text, or NULL when nothing but blanks is left."""
    return F.nullif(F.trim(text), F.lit(""))


def first_present(*texts: Column) -> Column:
    """The first text that is neither NULL nor empty."""
    return F.coalesce(*[F.nullif(t, F.lit("")) for t in texts])


def capitalise_words(text: Column) -> Column:
    """Upper-case every letter that follows a non-alphanumeric, lower the rest.

    Spark's own ``initcap`` looks at white space only, so ``t-shirt`` would keep
    its small ``s``. It does serve plain names of letters, digits and blanks.
    """
    words = F.split(F.lower(text), r"(?<=[^\p{L}\p{N}])")
    spelled = F.array_join(
        F.transform(words, lambda w: F.concat(F.upper(F.substring(w, 1, 1)), F.substr(w, F.lit(2)))),
        "",
    )
    return F.when(text.rlike("[^A-Za-z0-9 ]"), spelled).otherwise(F.initcap(text))


def clean_category(text: Column) -> Column:
    """One spelling per category; every way of saying "none" becomes one member."""
    bare = F.trim(text)
    missing = text.isNull() | F.lower(bare).isin(NO_CATEGORY)
    return F.when(missing, F.lit(UNCATEGORISED)).otherwise(
        capitalise_words(F.replace(bare, F.lit("_"), F.lit(" ")))
    )


def natural_key(sku: Column, item: Column) -> Column:
    """The SKU where there is one, else the display name."""
    return F.coalesce(blank_to_null(sku), item)


def slug(text: Column) -> Column:
    """Lower-case identifier; runs of other characters become one underscore."""
    named = F.coalesce(F.nullif(text, F.lit("")), F.lit("none"))
    joined = F.regexp_replace(F.lower(F.trim(named)), "[^a-z0-9]+", "_")
    return F.btrim(joined, F.lit("_"))


def spelling_key(name: Column) -> Column:
    """Equal for names that differ only by case, spaces or underscores."""
    return F.lower(F.regexp_replace(name, "[ _]", ""))


def pair_label(left: Column, right: Column) -> Column:
    return F.concat(left, F.lit(PAIR_JOINT), right)


def line_name(catalog_name: Column, typed_name: Column, line_type: Column) -> Column:
    """Catalog name, else the name at the till, else an honest placeholder."""
    placeholder = F.when(line_type == "CUSTOM_AMOUNT", F.lit(UNNAMED_AMOUNT)).otherwise(
        F.lit(UNNAMED_LINE)
    )
    return F.coalesce(first_present(catalog_name, typed_name), placeholder)


def category_id(item_data: Column) -> Column:
    """Category id of a catalog item, whichever of the three fields carries it."""
    listed = F.filter(
        F.transform(item_data["categories"], lambda c: c["id"]),
        lambda i: i.isNotNull() & (i != ""),
    )
    return F.coalesce(
        first_present(item_data["category_id"], item_data["reporting_category"]["id"]),
        F.get(listed, F.lit(0)),
    )
