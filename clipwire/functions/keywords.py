"""Keyword predicates over the text columns of an article."""

from __future__ import annotations

import re
from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from clipwire.schema import TRANSLATED_COLUMNS

_METACHARACTERS = re.compile(r"[\\^$.|?*+()\[\]{}]")
_NON_WORD = r"[^\p{L}\p{N}_]"


def quote_regex(text: str) -> str:
    """``text`` with every regex metacharacter escaped, valid in Java and RE2 alike."""
    return _METACHARACTERS.sub(lambda m: "\\" + m.group(0), text)


def _worded(words: Sequence[str], what: str) -> list[str]:
    """``words`` in lower case; an error if there are none or one is blank."""
    lowered = [w.lower() for w in words]
    if not lowered or not all(w.strip() for w in lowered):
        raise ValueError(f"{what} must be given and must not be blank: {list(words)!r}")
    return lowered


def any_of(conditions: Sequence[Column]) -> Column:
    return reduce(or_, conditions)


def _contains_any(column: Column, words: Sequence[str]) -> Column:
    # The one-element array lowers each text once for all words. A plain OR of
    # contains(lower(text), w) is rewritten to lower the text again per word.
    return F.exists(F.array(F.lower(column)), lambda t: any_of([t.contains(w) for w in words]))


def keyword_match(
    keywords: Sequence[str],
    columns: Sequence[str] = TRANSLATED_COLUMNS,
    literal: bool = False,
) -> Column:
    """True if any of ``columns``, lower-cased, contains any of ``keywords``.

    Keywords are lower-cased and read as regular expressions unless ``literal``. Words
    without regex metacharacters take a substring search, which gives the same rows
    and is cheaper. A null column does not stop a match in another; if none matches
    and one is null, the result is null and a filter drops the row.
    """
    words = _worded(keywords, "keywords")
    if literal or not any(_METACHARACTERS.search(w) for w in words):
        return any_of([_contains_any(F.col(c), words) for c in columns])
    pattern = "|".join(words)
    return any_of([F.lower(c).rlike(pattern) for c in columns])


def whole_word_pattern(terms: Sequence[str]) -> str:
    """A regex that finds any term or phrase standing as whole words, in lower case.

    The words of a phrase may be separated by any run of whitespace.
    """
    phrases = [r"\s+".join(quote_regex(w) for w in t.lower().split()) for t in terms]
    return f"(^|{_NON_WORD})({'|'.join(phrases)})({_NON_WORD}|$)"


def whole_word_match(terms: Sequence[str], columns: Sequence[str]) -> Column:
    """True if any term stands as whole words, in any case, in any of ``columns``."""
    terms = _worded(terms, "terms")
    pattern = whole_word_pattern(terms)
    # A text without the longest word of any term needs no regex.
    hints = sorted({max(t.lower().split(), key=len) for t in terms})
    return any_of(
        [
            F.exists(
                F.array(F.lower(c)),
                lambda t: any_of([t.contains(w) for w in hints]) & t.rlike(pattern),
            )
            for c in columns
        ]
    )


def occurrences(column: str, keyword: str) -> Column:
    """How often ``keyword`` occurs, in any case and without overlap; 0 for null text.

    Found by how much shorter the text is without it, with no regular expression.
    """
    (word,) = _worded([keyword], "keyword")
    text = F.lower(column)
    rest = F.replace(text, F.lit(word), F.lit(""))
    found = F.octet_length(text) - F.octet_length(rest)
    return F.coalesce((found / F.lit(len(word.encode()))).cast("bigint"), F.lit(0).cast("bigint"))
