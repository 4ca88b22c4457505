"""The harmonized table: flat, translated, relevant articles without duplicates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from clipwire.operators.articles import flatten_source, keyword_filter
from clipwire.operators.dedup import dedup_latest
from clipwire.operators.translation import translate_enrich
from clipwire.schema import MEMORY_SCHEMA, RELEVANCE_KEYWORDS
from clipwire.sources.tables import DEFAULT_FORMAT, load_table, write_overwrite


def harmonize(
    raw: DataFrame,
    memory: DataFrame,
    keywords: Sequence[str] = RELEVANCE_KEYWORDS,
    tie: Sequence[str] = ("url",),
    lookup: bool = False,
    few: bool = False,
) -> DataFrame:
    """Flatten, translate, keep relevant articles, keep the latest of each.

    ``lookup`` and ``few`` are those of ``translate_enrich``.
    """
    translated = translate_enrich(flatten_source(raw), memory, lookup=lookup, few=few)
    return dedup_latest(keyword_filter(translated, keywords), tie=tie)


def run_harmonize(
    spark: SparkSession,
    raw_path: str,
    memory_path: str,
    out_path: str,
    keywords: Sequence[str] = RELEVANCE_KEYWORDS,
    fmt: str = DEFAULT_FORMAT,
) -> None:
    """Build the harmonized table anew from the whole raw table, with all its columns.

    A newer translation can make an old article relevant or stop it from being so, and
    bring back an older copy. So the table is always built from all raw articles.
    """
    raw = load_table(spark, raw_path, fmt)
    memory = load_table(spark, memory_path, fmt, MEMORY_SCHEMA)
    write_overwrite(harmonize(raw, memory, keywords), out_path, fmt)
