"""Publication date and time of an article from its ISO-8601 string."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def published_date(column: str = "publishedAt") -> Column:
    """The calendar day written in the string; the session time zone plays no part.

    A value that is no date gives null, so bad rows are counted in a null group
    and do not fail the job.
    """
    return F.col(column).try_cast("date")


def published_ts(column: str = "publishedAt") -> Column:
    """The instant of publication, null if the string does not parse."""
    return F.col(column).try_cast("timestamp")


def day_parts(day: str | Column) -> list[Column]:
    """Columns ``year``, ``month`` and ``day`` of a date."""
    return [
        F.year(day).alias("year"),
        F.month(day).alias("month"),
        F.dayofmonth(day).alias("day"),
    ]
