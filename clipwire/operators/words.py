"""Tokens, word counts, top words and the Zipf comparison."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import StopWordsRemover, Tokenizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clipwire.functions.tokens import (
    ASCII_WORD,
    LETTERS_WORD,
    UNICODE_SPACE,
    not_stopword,
    portuguese_stopwords,
    single_space_tokens,
    space_run_tokens,
)

TEXT = "content_pt"


def tokenize_ml(df: DataFrame, column: str = TEXT, output: str = "tokens") -> DataFrame:
    """Add lower-case tokens cut at each single whitespace character."""
    filled = df.withColumn("_text", F.coalesce(F.col(column), F.lit("")))
    return Tokenizer(inputCol="_text", outputCol=output).transform(filled).drop("_text")


def remove_stopwords(
    df: DataFrame,
    stopwords: Sequence[str] | None = None,
    column: str = "tokens",
    output: str = "filtered_tokens",
) -> DataFrame:
    """Add ``column`` without stopwords, compared in any case."""
    words = portuguese_stopwords() if stopwords is None else list(stopwords)
    return StopWordsRemover(inputCol=column, outputCol=output, stopWords=words).transform(df)


def ascii_words(df: DataFrame, column: str = "filtered_tokens") -> DataFrame:
    """Keep the tokens made of plain A to Z letters; accented words go."""
    return df.withColumn(column, F.filter(column, lambda t: t.rlike(ASCII_WORD)))


def explode_words(df: DataFrame, column: str = "filtered_tokens") -> DataFrame:
    """One row per token, in column ``word``; rows without tokens go."""
    return df.withColumn("word", F.explode(column))


def tokenize_whitespace(df: DataFrame, column: str = TEXT, output: str = "tokens") -> DataFrame:
    """Add tokens cut at runs of any Unicode whitespace, case kept."""
    return df.withColumn(output, space_run_tokens(column))


def alpha_words(
    df: DataFrame,
    stopwords: Sequence[str] | None = None,
    column: str = "tokens",
    output: str = "filtered_tokens",
) -> DataFrame:
    """Add lower-case tokens that are all letters, accents included, and no stopword."""
    words = portuguese_stopwords() if stopwords is None else list(stopwords)
    kept = F.filter(column, lambda t: t.rlike(LETTERS_WORD) & not_stopword(F.lower(t), words))
    return df.withColumn(output, F.transform(kept, F.lower))


def _count_words(words: DataFrame, ordered: bool) -> DataFrame:
    counts = words.groupBy("word").agg(F.count("*").alias("count"))
    return counts.orderBy(F.desc("count"), "word") if ordered else counts


def word_count(
    df: DataFrame,
    stopwords: Sequence[str] | None = None,
    column: str = TEXT,
    ordered: bool = True,
) -> DataFrame:
    """Count of each plain-letter word that is no stopword, most frequent first.

    Gives the counts of ``tokenize_ml``, ``remove_stopwords``, ``ascii_words`` and
    ``explode_words`` in turn, but tests single tokens after the explode, inside
    generated code, and builds no filtered arrays.
    """
    stop = portuguese_stopwords() if stopwords is None else stopwords
    tokens = df.select(F.explode(single_space_tokens(column)).alias("word"))
    word = F.col("word")
    return _count_words(tokens.where(word.rlike(ASCII_WORD) & not_stopword(word, stop)), ordered)


def zipf_word_freq(
    df: DataFrame,
    stopwords: Sequence[str] | None = None,
    column: str = TEXT,
    ordered: bool = True,
) -> DataFrame:
    """Count of each all-letter word, accents kept, that is no stopword."""
    stop = portuguese_stopwords() if stopwords is None else stopwords
    tokens = df.select(F.explode(F.split(column, f"{UNICODE_SPACE}+")).alias("token"))
    words = tokens.where(F.col("token").rlike(LETTERS_WORD)).select(F.lower("token").alias("word"))
    return _count_words(words.where(not_stopword(F.col("word"), stop)), ordered)


def top_words(counts: DataFrame, k: int = 100) -> DataFrame:
    """The ``k`` most frequent words; equal counts in word order."""
    return counts.orderBy(F.desc("count"), "word").limit(k)


def rank_words(counts: DataFrame, k: int = 100) -> DataFrame:
    """The top ``k`` words with their rank, from 1. Only those ``k`` rows are ranked."""
    by_rank = Window.orderBy(F.desc("count"), "word")
    return top_words(counts, k).withColumn("rank", F.row_number().over(by_rank))


def zipf_top10(counts: DataFrame) -> DataFrame:
    return top_words(counts, 10)


def zipf_compare(counts: DataFrame, k: int = 10) -> DataFrame:
    """Top words with the count that Zipf's law expects: the top count over the rank."""
    top = F.max("count").over(Window.partitionBy())
    return rank_words(counts, k).withColumn("zipf_expected", top.cast("double") / F.col("rank"))
