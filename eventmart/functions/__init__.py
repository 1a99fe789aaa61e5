"""Column expressions; every one stays on the JVM side."""

from eventmart.functions.clock import (
    iso_to_utc,
    is_weekend,
    known_zone_or_utc,
    time_text,
    to_local,
    wall_clock_in_utc,
    weekday_name,
)
from eventmart.functions.keys import packed_key, pseudonym, surrogate_key, unpacked_key
from eventmart.functions.money import currency_to_cents, from_minor_units
from eventmart.functions.text import (
    blank_to_null,
    capitalise_words,
    category_id,
    clean_category,
    first_present,
    line_name,
    natural_key,
    pair_label,
    slug,
    spelling_key,
)

__all__ = [
    "blank_to_null",
    "capitalise_words",
    "category_id",
    "clean_category",
    "currency_to_cents",
    "first_present",
    "from_minor_units",
    "is_weekend",
    "iso_to_utc",
    "known_zone_or_utc",
    "line_name",
    "natural_key",
    "packed_key",
    "pair_label",
    "pseudonym",
    "slug",
    "spelling_key",
    "surrogate_key",
    "time_text",
    "to_local",
    "unpacked_key",
    "wall_clock_in_utc",
    "weekday_name",
]
