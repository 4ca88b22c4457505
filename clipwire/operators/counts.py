"""Article counts by day, by source and author, and by keyword."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clipwire.functions.dates import day_parts, published_date
from clipwire.functions.keywords import keyword_match, occurrences
from clipwire.schema import COUNT_KEYWORDS, TRANSLATED_COLUMNS


def _per_day(df: DataFrame, published: str, *measures: Column) -> DataFrame:
    # Grouped by the date, a single fixed-width key; its parts are taken afterwards.
    days = df.groupBy(published_date(published).alias("_day")).agg(*measures)
    return days.select(*day_parts("_day"), *[c for c in days.columns if c != "_day"])


def count_by_day(df: DataFrame, published: str = "publishedAt") -> DataFrame:
    """Articles per publication year, month and day."""
    return _per_day(df, published, F.count("*").alias("news_count"))


def count_by_source_author(df: DataFrame) -> DataFrame:
    """Articles per source and author; a missing author is a group of its own."""
    return df.groupBy("source_name", "author").agg(F.count("*").alias("news_count"))


def count_keyword_days(
    df: DataFrame,
    keywords: Sequence[str] = COUNT_KEYWORDS,
    columns: Sequence[str] = TRANSLATED_COLUMNS,
    published: str = "publishedAt",
) -> DataFrame:
    """Articles per day that hold any keyword; days without one are absent."""
    relevant = df.where(keyword_match(keywords, columns))
    return _per_day(relevant, published, F.count("*").alias("keyword_appearance_count"))


def count_keyword_occurrences(
    df: DataFrame,
    keywords: Sequence[str] = COUNT_KEYWORDS,
    columns: Sequence[str] = TRANSLATED_COLUMNS,
    published: str = "publishedAt",
) -> DataFrame:
    """How often each keyword occurs per day, over all text columns.

    Each keyword is one sum in a single aggregate, so rows are never multiplied by the
    keyword list; only the finished day rows are turned into one row per keyword.
    """
    words = list(dict.fromkeys(w.lower() for w in keywords))
    if not words:
        raise ValueError("keywords must be given")
    sums = [
        F.sum(sum((occurrences(c, w) for c in columns), F.lit(0))).cast("bigint").alias(f"_k{i}")
        for i, w in enumerate(words)
    ]
    per_keyword = F.array(
        *[
            F.struct(F.lit(w).alias("keyword"), F.col(f"_k{i}").alias("occurrences"))
            for i, w in enumerate(words)
        ]
    )
    return (
        _per_day(df, published, *sums)
        .select("year", "month", "day", F.inline(per_keyword))
        .where(F.col("occurrences") > 0)
    )


def table_counts(tables: dict[str, DataFrame], by: str = "from_date") -> DataFrame:
    """Rows per table and partition value, null partition for tables without one."""
    counts = []
    for name, df in tables.items():
        part = F.col(by) if by in df.columns else F.lit(None)
        counts.append(
            df.groupBy(part.cast("string").alias(by))
            .agg(F.count("*").alias("row_count"))
            .select(F.lit(name).alias("table_name"), by, "row_count")
        )
    return reduce(DataFrame.unionByName, counts)
