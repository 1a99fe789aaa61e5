"""Money as exact decimals, never as doubles."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(12,2)"


def from_minor_units(amount: Column) -> Column:
    """Integer cents to a two-digit decimal; a missing amount is zero."""
    exact = (amount.cast("decimal(20,0)") / F.lit(100)).cast(MONEY)
    return F.coalesce(exact, F.lit(0).cast(MONEY))


def currency_to_cents(text: Column) -> Column:
    """``$1,234.50`` to 123450; parentheses mark a refund; blank is zero."""
    trimmed = F.trim(F.coalesce(text, F.lit("")))
    digits = F.regexp_replace(trimmed, r"[$,()]", "")
    amount = F.when(digits == "", F.lit("0")).otherwise(digits).cast("decimal(20,4)")
    # Half-to-even, as decimal arithmetic rounds a fraction of a cent by default.
    cents = F.bround(amount * 100, 0).cast("bigint")
    return F.when(trimmed.startswith("(") & trimmed.endswith(")"), -cents).otherwise(cents)
