"""Collection windows: which day an article is fetched for, and how many per day."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clipwire.functions.dates import published_ts
from clipwire.schema import HISTORY_DAYS, MAX_PAGES, PAGE_SIZE, PARTITION_COLUMN, POSITION_COLUMN

_DAY_MICROS = 24 * 60 * 60 * 1_000_000


def stamp_from_date(df: DataFrame, day: dt.date | None = None) -> DataFrame:
    """Set ``from_date``: a given window start, or the day of ingestion if none."""
    stamp = F.current_date() if day is None else F.lit(day)
    return df.withColumn(PARTITION_COLUMN, stamp.cast("date"))


def assign_windows(
    df: DataFrame,
    today: dt.date,
    days: int = HISTORY_DAYS,
    published: str = "publishedAt",
    closed: bool = False,
) -> DataFrame:
    """Put each article into its one-day UTC window, as ``from_date``.

    The day is that of the instant in UTC, so ``2024-01-01T23:30:00-05:00`` is in the window
    of January 2. Windows start on each day from ``today - days`` to ``today``, both included, and
    are half-open. With ``closed`` both ends belong to the window, so an article of
    exactly midnight is in two. The window follows from the row alone: no join.
    """
    micros = F.unix_micros(published_ts(published))
    day = F.date_from_unix_date(F.floor(micros / _DAY_MICROS).cast("int"))
    if closed:
        midnight = F.pmod(micros, F.lit(_DAY_MICROS)) == 0
        both = F.array(day, F.date_sub(day, 1))
        day = F.explode(F.when(midnight, both).otherwise(F.array(day)))
    first = today - dt.timedelta(days=days)
    return df.withColumn(PARTITION_COLUMN, day).where(
        F.col(PARTITION_COLUMN).between(F.lit(first), F.lit(today))
    )


def top_k_per_group(
    df: DataFrame,
    group: Sequence[str],
    order: Sequence[Column],
    k: int,
    slices: int = 256,
) -> DataFrame:
    """The first ``k`` rows of each group, exact also where one group is huge.

    The rows of a group are cut into ``slices`` by the input partition they come from,
    and each slice keeps its first ``k``. Those hold the group's first ``k``, so the
    second step sees at most ``slices * k`` rows of any group. Up to k = 1000 Spark also
    drops rows beyond the first ``k`` of a slice before the shuffle.
    """
    within_slice = Window.partitionBy(*group, "_slice").orderBy(*order)
    within_group = Window.partitionBy(*group).orderBy(*order)
    return (
        df.withColumn("_slice", F.pmod(F.spark_partition_id(), F.lit(slices)))
        .withColumn("_rank", F.row_number().over(within_slice))
        .where(F.col("_rank") <= k)
        .withColumn("_rank", F.row_number().over(within_group))
        .where(F.col("_rank") <= k)
        .drop("_rank", "_slice")
    )


def popularity_order(popularity: str | None, tie: Sequence[str]) -> list[Column]:
    """The most popular first: by a column, or by the place in the sender's reply."""
    if popularity is None:
        first = F.col(POSITION_COLUMN).asc_nulls_last()
    else:
        first = F.col(popularity).desc_nulls_last()
    return [first, *[F.col(c).asc() for c in tie]]


def window_page_cap(
    df: DataFrame,
    popularity: str | None = None,
    tie: Sequence[str] = ("url",),
    pages: int = MAX_PAGES,
    page_size: int = PAGE_SIZE,
    slices: int = 256,
) -> DataFrame:
    """At most ``pages`` full pages of articles per window, the most popular first.

    Popularity is a column, or by default the place in the sender's reply. Beyond 1000 rows a
    window, set ``spark.sql.optimizer.windowGroupLimitThreshold`` to ``pages * page_size``,
    so that Spark still drops the rest of each slice before the shuffle.
    """
    order = popularity_order(popularity, tie)
    return top_k_per_group(df, [PARTITION_COLUMN], order, pages * page_size, slices)


def _utc(moment: dt.datetime | dt.date | str) -> Column:
    if isinstance(moment, str):
        moment = dt.datetime.fromisoformat(moment)
    if not isinstance(moment, dt.datetime):
        moment = dt.datetime.combine(moment, dt.time())
    if moment.tzinfo is None:
        moment = moment.replace(tzinfo=dt.timezone.utc)
    return F.lit(moment.isoformat()).cast("timestamp")


def producer_window(
    df: DataFrame,
    to_time: dt.datetime | dt.date | str,
    days: int,
    published: str = "publishedAt",
) -> DataFrame:
    """Articles of the last ``days`` days up to ``to_time`` (UTC), both ends included."""
    end = _utc(to_time)
    start = end - F.make_dt_interval(days=F.lit(days))
    return df.where(published_ts(published).between(start, end))
