"""Deterministic keys: the same natural key hashes alike on every rebuild."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# They decide the key text and must not change.
NULL_MARK = "_sk_null_"
SEPARATOR = "-"


def surrogate_key(*parts: Column | str) -> Column:
    """md5 over the text of the parts, with a mark standing in for NULL."""
    texts = [
        F.coalesce((F.col(p) if isinstance(p, str) else p).cast("string"), F.lit(NULL_MARK))
        for p in parts
    ]
    return F.md5(F.concat_ws(SEPARATOR, *texts))


def pseudonym(name: Column) -> Column:
    """SHA-256 of a personal name; a missing or blank name stays missing."""
    return F.sha2(F.nullif(F.trim(name), F.lit("")), 256)


_FILL = "00" * 17


def packed_key(key: Column | str) -> Column:
    """A surrogate key in 16 bytes, half of its text, to move between tasks.

    Other text stays its own bytes; where those are 16 too, zeros behind them tell it apart.
    """
    text = F.col(key) if isinstance(key, str) else key
    own = text.cast("binary")
    filled = F.when(F.octet_length(text) == 16, F.concat(own, F.unhex(F.lit(_FILL)))).otherwise(own)
    return F.when(text.rlike("^[0-9a-f]{32}$"), F.unhex(text)).otherwise(filled)


def unpacked_key(packed: Column | str) -> Column:
    """The key that ``packed_key`` was given."""
    held = F.col(packed) if isinstance(packed, str) else packed
    filled = (F.length(held) == 33) & (F.substring(held, 17, 17) == F.unhex(F.lit(_FILL)))
    own = F.when(filled, F.substring(held, 1, 16)).otherwise(held).cast("string")
    return F.when(F.length(held) == 16, F.lower(F.hex(held))).otherwise(own)
