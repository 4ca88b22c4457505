"""The three count tables from one pass over the harmonized table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clipwire.functions.dates import day_parts, published_date
from clipwire.functions.keywords import keyword_match
from clipwire.schema import (
    COUNT_KEYWORDS,
    DAY_TABLE,
    KEYWORD_TABLE,
    SOURCE_AUTHOR_TABLE,
    TRANSLATED_COLUMNS,
)
from clipwire.sources.tables import DEFAULT_FORMAT, write_overwrite

_DAY = ["year", "month", "day"]
_SOURCE_AUTHOR = ["source_name", "author"]


def semantic_counts(
    df: DataFrame,
    keywords: Sequence[str] = COUNT_KEYWORDS,
    columns: Sequence[str] = TRANSLATED_COLUMNS,
    published: str = "publishedAt",
) -> DataFrame:
    """Day and source/author counts in one aggregate; ``by_day`` tells them apart.

    The texts are scanned and matched once, and only narrow rows are grouped.
    """
    matched = F.coalesce(keyword_match(keywords, columns), F.lit(False))
    narrow = df.select(
        published_date(published).alias("_day"), *_SOURCE_AUTHOR, matched.cast("bigint").alias("hit")
    )
    counts = narrow.groupingSets([["_day"], _SOURCE_AUTHOR], "_day", *_SOURCE_AUTHOR).agg(
        (F.grouping("author") == 1).alias("by_day"),
        F.count("*").alias("news_count"),
        F.sum("hit").alias("keyword_appearance_count"),
    )
    return counts.select(*day_parts("_day"), *[c for c in counts.columns if c != "_day"])


def split_counts(counts: DataFrame) -> dict[str, DataFrame]:
    """The three count tables by name, out of ``semantic_counts``."""
    by_day = counts.where("by_day")
    return {
        DAY_TABLE: by_day.select(*_DAY, "news_count"),
        SOURCE_AUTHOR_TABLE: counts.where("NOT by_day").select(*_SOURCE_AUTHOR, "news_count"),
        KEYWORD_TABLE: by_day.where("keyword_appearance_count > 0").select(
            *_DAY, "keyword_appearance_count"
        ),
    }


def aggregate_all(
    df: DataFrame,
    out_dir: str,
    keywords: Sequence[str] = COUNT_KEYWORDS,
    columns: Sequence[str] = TRANSLATED_COLUMNS,
    fmt: str = DEFAULT_FORMAT,
) -> dict[str, str]:
    """Write the three count tables below ``out_dir``; gives their paths by name.

    The counts are kept while the tables are written, so ``df`` is read once.
    """
    counts = semantic_counts(df, keywords, columns).persist()
    paths = {}
    try:
        for name, table in split_counts(counts).items():
            paths[name] = f"{out_dir}/{name}"
            write_overwrite(table, paths[name], fmt)
    finally:
        counts.unpersist()
    return paths
