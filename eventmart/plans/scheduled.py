"""The daily load of one window of orders."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame

from eventmart.operators.flatten import flatten_orders
from eventmart.sources.landing import replace_dates, split_undated
from eventmart.sources.pos_api import ExtractWindow, completed_orders


def load_window(
    orders: DataFrame,
    window: ExtractWindow,
    locations: DataFrame,
    catalog: DataFrame,
    zones: DataFrame,
    source: str,
    table: str,
    staging: str,
    zone: str | None,
) -> tuple[set[date], DataFrame]:
    """Replaces the window's sale dates by its paid orders; returns the dates and undated lines.

    The window is widened to whole days of ``zone``, as a load replaces whole dates;
    None takes the window as it is. Loading the same window again changes nothing.
    """
    whole = window if zone is None else window.snapped_to_midnight(zone)
    lines = flatten_orders(completed_orders(orders, whole, locations), catalog, zones, source)
    dated, undated = split_undated(lines)
    return replace_dates(dated, table, staging), undated
