"""Drop repeated articles of a stream, with state bounded by a watermark."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from clipwire.functions.dates import published_ts
from clipwire.schema import ARTICLE_KEYS


def with_event_time(articles: DataFrame, delay: str) -> DataFrame:
    """Add ``published_ts`` and a watermark on it."""
    return articles.withColumn("published_ts", published_ts()).withWatermark("published_ts", delay)


def stream_dedup(
    articles: DataFrame, delay: str = "1 day", keys: Sequence[str] = ARTICLE_KEYS
) -> DataFrame:
    """The first seen article of each key, among those at most ``delay`` apart.

    Articles older than the watermark are late, and Spark drops them. One without a valid
    time is never late, but is forgotten at once, so its repeats in later batches pass;
    ``stream_stage_merge`` has no such limit.

    One state per key, and one state only: a second stage before it would remember copies
    that are dropped here, and so drop later ones that are to stay.
    """
    return with_event_time(articles, delay).dropDuplicatesWithinWatermark(list(keys))
