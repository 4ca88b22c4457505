"""Thousands of keywords beside the operators for a few of them."""

import random

import pytest

from clipwire.operators import (
    count_keyword_occurrences,
    count_keyword_occurrences_many,
    keyword_filter,
    keyword_filter_many,
    match_many,
)
from helpers import flat, rows

TEXTS = [
    "aaaa aab ÄÖ äö genes GENES", "abababab", None, "", "x" * 5000 + "aba", "İstanbul ß STRASSE", "a.b (c) [d] a.b",
]
WORDS = ["aa", "aba", "ab", "b", "genes", "äö", "gene", "a.b", "(c)", "strasse", "x" * 40]


@pytest.fixture
def articles(spark):
    days = ["2024-01-01T10:00:00Z", "2024-01-02T10:00:00Z", "n/a", None]
    made = [
        {"title_pt": t, "content_pt": TEXTS[-k], "publishedAt": days[k % 4], "url": str(k)} for k, t in enumerate(TEXTS)
    ]
    return flat(spark, *made)


def test_counts_like_those_of_few_keywords(articles):
    few = count_keyword_occurrences(articles, WORDS)
    many = count_keyword_occurrences_many(articles, [*WORDS, "GENES"])
    columns = ("year", "month", "day", "keyword", "occurrences")
    assert rows(many, *columns) == rows(few, *columns) and few.count() > 10


def test_filter_like_that_of_few_keywords(articles):
    for words in (WORDS, ["genes"], ["nowhere"]):
        assert rows(keyword_filter_many(articles, words), "url") == rows(keyword_filter(articles, words, literal=True), "url")


def test_null_texts(spark):
    df = flat(spark, {"title_pt": "dna"}, {"title_pt": "no"}, {"title_pt": "no", "content_pt": "no", "description_pt": "no"}, {})
    assert [r[0] for r in df.select(match_many(["DNA"])).collect()] == [True, None, False, None]


def test_plan_does_not_grow_with_the_list(articles):
    r = random.Random(1)
    words = ["".join(r.choice("abcdefgh") for _ in range(8)) for _ in range(10_000)]
    size = lambda df: len(df._jdf.queryExecution().optimizedPlan().toString().splitlines())
    many, few = count_keyword_occurrences_many(articles, words), count_keyword_occurrences_many(articles, words[:2])
    assert size(many) == size(few)
    assert many.count() == 0
    assert rows(count_keyword_occurrences_many(articles, [*words, "genes"]), "occurrences")[-1][0] >= 2


def test_refused_lists(articles):
    for words in ([], ["a", " "]):
        with pytest.raises(ValueError):
            count_keyword_occurrences_many(articles, words)
    assert count_keyword_occurrences_many(articles.limit(0), ["a"]).collect() == []
