"""Token expressions behind the two word counts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import StopWordsRemover
from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters a bare string split treats as whitespace. Those above
# U+0100 stand behind one range test, as most characters fail it at once.
_LATIN_SPACE = r" \t\n\x0b\f\r\x1c\x1d\x1e\x1f\x85\xa0"
_OTHER_SPACE = (
    r"\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
)
UNICODE_SPACE = rf"[{_LATIN_SPACE}[\x{{1680}}-\x{{3000}}&&[{_OTHER_SPACE}]]]"
# What counts as a word in each of the two word counts.
ASCII_WORD = r"^[a-zA-Z]+$"
LETTERS_WORD = r"^\p{L}+$"


def portuguese_stopwords() -> list[str]:
    """The Portuguese stopword list that ships with Spark."""
    return StopWordsRemover.loadDefaultStopWords("portuguese")


def lowered(stopwords: Sequence[str]) -> list[str]:
    return sorted({w.lower() for w in stopwords})


def single_space_tokens(column: str) -> Column:
    """Lower-case text cut at each single whitespace character; null gives no token.

    Runs of whitespace leave empty tokens, which the word pattern drops later.
    """
    return F.split(F.lower(column), r"\s")


def space_run_tokens(column: str) -> Column:
    """Text cut at runs of whitespace, without empty tokens at either end."""
    trimmed = F.regexp_replace(F.col(column), f"^{UNICODE_SPACE}+|{UNICODE_SPACE}+$", "")
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(
        F.split(trimmed, f"{UNICODE_SPACE}+")
    )


def not_stopword(word: Column, stopwords: Sequence[str]) -> Column:
    """True if ``word``, which is in lower case, is none of ``stopwords``, in any case."""
    words = lowered(stopwords)
    return ~word.isin(words) if words else F.lit(True)
