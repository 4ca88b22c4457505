"""Projections and filters on article rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clipwire.functions.keywords import keyword_match, whole_word_match
from clipwire.schema import RELEVANCE_KEYWORDS, TEXT_COLUMNS, TRANSLATED_COLUMNS


def flatten_source(df: DataFrame) -> DataFrame:
    """Replace the nested ``source`` by ``source_id`` and ``source_name``."""
    return df.select(
        "*",
        F.col("source.id").alias("source_id"),
        F.col("source.name").alias("source_name"),
    ).drop("source")


def keyword_filter(
    df: DataFrame,
    keywords: Sequence[str] = RELEVANCE_KEYWORDS,
    columns: Sequence[str] = TRANSLATED_COLUMNS,
    literal: bool = False,
) -> DataFrame:
    """Rows in which any keyword is part of any of the text columns."""
    return df.where(keyword_match(keywords, columns, literal))


def relevance_strict(
    df: DataFrame,
    keywords: Sequence[str] = RELEVANCE_KEYWORDS,
    columns: Sequence[str] = TRANSLATED_COLUMNS,
) -> DataFrame:
    """As ``keyword_filter``, but a keyword must stand as a whole word."""
    return df.where(whole_word_match(keywords, columns))


def search_query(
    df: DataFrame,
    terms: Sequence[str],
    columns: Sequence[str] = TEXT_COLUMNS,
) -> DataFrame:
    """Rows matching any search term or phrase, as whole words in any case."""
    return df.where(whole_word_match(terms, columns))
