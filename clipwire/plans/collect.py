"""Fill the raw table from landed articles: the history, or the latest days."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame

from clipwire.operators.articles import search_query
from clipwire.operators.windows import (
    assign_windows,
    popularity_order,
    producer_window,
    stamp_from_date,
    window_page_cap,
)
from clipwire.schema import HISTORY_DAYS, MAX_PAGES, PAGE_SIZE, SEARCH_TERMS


def collect_history(
    landed: DataFrame,
    today: dt.date,
    popularity: str | None = None,
    terms: Sequence[str] = SEARCH_TERMS,
    days: int = HISTORY_DAYS,
    pages: int = MAX_PAGES,
    page_size: int = PAGE_SIZE,
    tie: Sequence[str] = ("url",),
) -> DataFrame:
    """Matching articles by one-day windows, the most popular pages of each.

    Popularity is a column, or by default the place in the sender's reply. ``from_date`` is the start of the window. Save with ``write_partition_overwrite``.
    """
    windows = assign_windows(search_query(landed, terms), today, days)
    return window_page_cap(windows, popularity, tie, pages, page_size)


def collect_recent(
    landed: DataFrame,
    to_time: dt.datetime | dt.date | str,
    popularity: str | None = None,
    terms: Sequence[str] = SEARCH_TERMS,
    days: int = 1,
    page_size: int = PAGE_SIZE,
    tie: Sequence[str] = ("url",),
    from_date: dt.date | None = None,
) -> DataFrame:
    """The most popular page of matching articles of the days up to ``to_time``.

    Popularity is a column, or by default the place in the sender's reply. ``from_date`` is the day of ingestion. Save with ``write_partition_append``.
    """
    recent = producer_window(search_query(landed, terms), to_time, days)
    order = popularity_order(popularity, tie)
    return stamp_from_date(recent.orderBy(*order).limit(page_size), from_date)
