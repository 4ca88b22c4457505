"""Operators on article DataFrames."""

from clipwire.operators.articles import (
    flatten_source,
    keyword_filter,
    relevance_strict,
    search_query,
)
from clipwire.operators.automaton import (
    count_keyword_occurrences_many,
    keyword_filter_many,
    match_many,
)
from clipwire.operators.counts import (
    count_by_day,
    count_by_source_author,
    count_keyword_days,
    count_keyword_occurrences,
    table_counts,
)
from clipwire.operators.dedup import dedup_latest, dedup_max_by
from clipwire.operators.quality import QUALITY_SCHEMA, QualityLog
from clipwire.operators.translation import (
    fill_memory,
    translate_enrich,
    translate_texts,
    translate_udf,
    translation_pending,
)
from clipwire.operators.windows import (
    assign_windows,
    producer_window,
    stamp_from_date,
    window_page_cap,
)
from clipwire.operators.words import (
    alpha_words,
    ascii_words,
    explode_words,
    rank_words,
    remove_stopwords,
    tokenize_ml,
    tokenize_whitespace,
    top_words,
    word_count,
    zipf_compare,
    zipf_top10,
    zipf_word_freq,
)

__all__ = [
    "QUALITY_SCHEMA",
    "QualityLog",
    "alpha_words",
    "ascii_words",
    "assign_windows",
    "count_by_day",
    "count_by_source_author",
    "count_keyword_days",
    "count_keyword_occurrences",
    "count_keyword_occurrences_many",
    "dedup_latest",
    "dedup_max_by",
    "explode_words",
    "fill_memory",
    "flatten_source",
    "keyword_filter",
    "keyword_filter_many",
    "match_many",
    "producer_window",
    "rank_words",
    "relevance_strict",
    "remove_stopwords",
    "search_query",
    "stamp_from_date",
    "table_counts",
    "tokenize_ml",
    "tokenize_whitespace",
    "top_words",
    "translate_enrich",
    "translate_texts",
    "translate_udf",
    "translation_pending",
    "window_page_cap",
    "word_count",
    "zipf_compare",
    "zipf_top10",
    "zipf_word_freq",
]
