"""Time: UTC moments to the seller's wall clock, independent of the session zone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

UTC = "UTC"


def wall_clock_in_utc(moment: Column) -> Column:
    """An instant as a zone-less timestamp in UTC, whatever zone the session has."""
    micros = F.unix_micros(moment)
    seconds = (micros.cast("decimal(20,0)") / F.lit(1000000)).cast("decimal(18,6)")
    zero = F.lit(0)
    return F.expr("timestamp_ntz'1970-01-01 00:00:00'") + F.make_dt_interval(
        zero, zero, zero, seconds
    )


def iso_to_utc(text: Column) -> Column:
    """ISO-8601 text with ``Z`` or an offset to a zone-less timestamp in UTC."""
    return wall_clock_in_utc(F.to_timestamp(F.nullif(text, F.lit(""))))


def known_zone_or_utc(zone: Column) -> Column:
    """The zone name if Spark can resolve it, else UTC.

    A cast that fails softly does the check, so no zone list has to travel
    through the driver. Bare offsets are not zone names and also become UTC.
    """
    named = zone.rlike(r"^[A-Za-z][A-Za-z0-9_]*(/[A-Za-z0-9_+\-]+)*$")
    probe = F.concat(F.lit("2000-01-01 00:00:00 "), zone).try_cast("timestamp")
    return F.when(named & probe.isNotNull(), zone).otherwise(F.lit(UTC))


def to_local(utc: Column, zone: Column) -> Column:
    """Zone-less UTC timestamp to the wall clock of ``zone`` (a valid name)."""
    return F.convert_timezone(F.lit(UTC), zone, utc)


def time_text(wall_clock: Column) -> Column:
    """Time of day as text, fraction included where the source carries one."""
    return F.substr(wall_clock.cast("string"), F.lit(12))


def weekday_name(day: Column) -> Column:
    return F.date_format(day, "EEEE")


def is_weekend(day: Column) -> Column:
    # Spark counts Sunday as 1 and Saturday as 7.
    return F.dayofweek(day).isin(1, 7)
