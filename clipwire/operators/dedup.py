"""One row per article: the latest by publication time."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clipwire.functions.dates import published_ts
from clipwire.schema import ARTICLE_KEYS


def _recency(published: str, tie: Sequence[str]) -> list[Column]:
    return [published_ts(published), F.col(published), *[F.col(c) for c in tie]]


def dedup_latest(
    df: DataFrame,
    keys: Sequence[str] = ARTICLE_KEYS,
    published: str = "publishedAt",
    tie: Sequence[str] = ("url",),
) -> DataFrame:
    """The latest row of each key; null keys form one group, ``tie`` settles equal times.

    The filter on ``row_number() = 1`` makes Spark keep one row per key within each
    map task before the shuffle, so a key that holds much of the data sends at most
    one row per task.
    """
    latest_first = Window.partitionBy(*keys).orderBy(
        *[c.desc_nulls_last() for c in _recency(published, tie)]
    )
    return (
        df.withColumn("_recency", F.row_number().over(latest_first))
        .where(F.col("_recency") == 1)
        .drop("_recency")
    )


def dedup_max_by(
    df: DataFrame,
    keys: Sequence[str] = ARTICLE_KEYS,
    published: str = "publishedAt",
    tie: Sequence[str] = ("url",),
) -> DataFrame:
    """The rows of ``dedup_latest`` by aggregation, merged within each map task first.

    A cross-check, not the fast way: whole rows are aggregation buffers here, which Spark sorts.
    """
    rest = [c for c in df.columns if c not in keys]
    best = F.max_by(F.struct(*rest), F.struct(*_recency(published, tie)))
    return df.groupBy(*keys).agg(best.alias("_best")).select(
        *[F.col(c) if c in keys else F.col(f"_best.{c}").alias(c) for c in df.columns]
    )
