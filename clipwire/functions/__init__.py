"""Column expressions: dates, keyword predicates and tokens."""

from clipwire.functions.dates import day_parts, published_date, published_ts
from clipwire.functions.keywords import keyword_match, occurrences, whole_word_match
from clipwire.functions.tokens import portuguese_stopwords

__all__ = [
    "day_parts",
    "keyword_match",
    "occurrences",
    "portuguese_stopwords",
    "published_date",
    "published_ts",
    "whole_word_match",
]
