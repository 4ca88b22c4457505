"""Keywords in the thousands: one pass over each text by an automaton of all of them.

The automaton is made once in each worker from the list, which is bounded (``MOST``), and texts come
in Arrow batches, lower-cased by Spark. The plan is the same for two keywords and for ten
thousand. Keywords are literal here; few of them, or regular expressions, are better served
by ``keyword_filter`` and ``count_keyword_occurrences``.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator, Sequence
from functools import lru_cache, reduce
from operator import or_

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clipwire.functions.dates import day_parts, published_date
from clipwire.schema import TRANSLATED_COLUMNS

#: Keywords of a list at most: it is sent to every worker.
MOST = 1_000_000


def _checked(keywords: Sequence[str]) -> tuple[str, ...]:
    """The keywords in lower case, each once; an error if there are none, too many, or a blank one."""
    words = tuple(dict.fromkeys(w.lower() for w in keywords))
    if not words or len(words) > MOST or not all(w.strip() for w in words):
        raise ValueError(f"1 to {MOST} keywords must be given and none must be blank")
    return words


@lru_cache(maxsize=2)
def _automaton(words: tuple[str, ...]):
    """The automaton of some words; a match gives its end and (number, length) of the word."""
    import ahocorasick

    made = ahocorasick.Automaton()
    for n, word in enumerate(words):
        made.add_word(word, (n, len(word)))
    made.make_automaton()
    return made


def _found(automaton, text: str, counts: Counter) -> None:
    """Count each word of a text from the left, without overlap with itself."""
    ends: dict[int, int] = {}
    for end, (word, length) in automaton.iter(text):
        if end - length >= ends.get(word, -1):
            ends[word] = end
            counts[word] += 1


def match_many(keywords: Sequence[str], columns: Sequence[str] = TRANSLATED_COLUMNS) -> Column:
    """True if any of ``columns``, lower-cased, contains any of the keywords, as ``keyword_match`` has it.

    A null column does not stop a match in another; if none matches and one is null, the result is null.
    """
    words = _checked(keywords)

    @F.pandas_udf("boolean")
    def holds(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        automaton = _automaton(words)
        for texts in batches:
            yield pd.Series([None if t is None else any(True for _ in automaton.iter(t)) for t in texts], dtype=object)

    return reduce(or_, [holds(F.lower(c)) for c in columns])


def keyword_filter_many(
    df: DataFrame, keywords: Sequence[str], columns: Sequence[str] = TRANSLATED_COLUMNS
) -> DataFrame:
    """Rows in which any of many literal keywords is part of any of the text columns."""
    return df.where(match_many(keywords, columns))


def count_keyword_occurrences_many(
    df: DataFrame,
    keywords: Sequence[str],
    columns: Sequence[str] = TRANSLATED_COLUMNS,
    published: str = "publishedAt",
) -> DataFrame:
    """How often each of many keywords occurs per day, over all text columns.

    The rows of ``count_keyword_occurrences``: any case, without overlap of a keyword with itself. A
    task sends one row for each day and keyword of a batch, by the keyword's number; the words
    themselves are joined to the finished counts.
    """
    words = _checked(keywords)

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = _automaton(words)
        for batch in batches:
            days: dict[int | None, Counter] = {}
            rows = zip(*(c.to_pylist() for c in batch.columns))
            for day, *texts in rows:
                counts = days.setdefault(day, Counter())
                for text in filter(None, texts):
                    _found(automaton, text, counts)
            flat = [(d, w, n) for d, counts in days.items() for w, n in counts.items()]
            columns = zip(*flat) if flat else ([], [], [])
            types = (pa.int32(), pa.int32(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, types)], ["day", "word", "n"])

    lowered = df.select(F.unix_date(published_date(published)).alias("day"), *[F.lower(c).alias(f"t{k}") for k, c in enumerate(columns)])
    sums = lowered.mapInArrow(counted, "day int, word int, n bigint").groupBy("day", "word").agg(F.sum("n").alias("occurrences"))
    names = df.sparkSession.createDataFrame(pd.DataFrame({"word": range(len(words)), "keyword": words}), "word int, keyword string")
    named = sums.join(names, "word").withColumn("day", F.date_from_unix_date("day"))
    return named.select(*day_parts("day"), "keyword", "occurrences")
