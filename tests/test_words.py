from collections import Counter

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from clipwire.functions import portuguese_stopwords
from clipwire.operators import (
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
from helpers import flat, rows

STOP = ["De", "o"]


def _texts(spark, *texts):
    return flat(spark, *[{"url": str(i), "content_pt": t} for i, t in enumerate(texts)])


def test_ml_tokens_are_cut_at_single_spaces(spark):
    out = tokenize_ml(_texts(spark, "A  b\tC, é", "", None, "x \n", "  "))
    assert [r["tokens"] for r in out.orderBy("url").collect()] == [
        ["a", "", "b", "c,", "é"],
        [""],
        [""],
        ["x"],
        [],
    ]


def test_visible_words_drop_stopwords_and_accents(spark):
    tokens = remove_stopwords(tokenize_ml(_texts(spark, "De o gene é DNA2 Raro", "o")), STOP)
    words = explode_words(ascii_words(tokens))
    assert rows(words, "url", "word") == [("0", "gene"), ("0", "raro")]


def test_whitespace_tokens_match_a_bare_split(spark):
    texts = ["A  b\tC, é", " x y z ", "", "   ", "a\x1cb\x85c", "q​w"]
    out = tokenize_whitespace(_texts(spark, *texts)).orderBy("url").collect()
    assert [r["tokens"] for r in out] == [t.split() for t in texts]


def test_null_text_gives_no_words(spark):
    df = _texts(spark, None)
    assert word_count(df, STOP).count() == 0
    assert zipf_word_freq(df, STOP).count() == 0
    assert alpha_words(tokenize_whitespace(df), STOP).first()["filtered_tokens"] is None


def _expected_zipf(texts):
    stop = {w.lower() for w in STOP}
    return Counter(
        t.lower() for x in texts for t in x.split() if t.lower() not in stop and t.isalpha()
    )


chars = st.sampled_from(list("aAbZé ÇñK2.,-") + ["\t", "\n", " ", "de", " o "])
documents = st.lists(st.lists(chars, max_size=20).map("".join), min_size=1, max_size=6)


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(documents)
def test_fused_counts_equal_the_step_by_step_ways(spark, texts):
    df = _texts(spark, *texts)
    steps = explode_words(ascii_words(remove_stopwords(tokenize_ml(df), STOP)))
    assert rows(word_count(df, STOP)) == rows(steps.groupBy("word").count())
    alpha = explode_words(alpha_words(tokenize_whitespace(df), STOP))
    freqs = rows(zipf_word_freq(df, STOP))
    assert freqs == rows(alpha.groupBy("word").count())
    assert dict(freqs) == dict(_expected_zipf(texts))


def test_order_top_and_ranks(spark):
    df = _texts(spark, "b b a a c d d d")
    counts = word_count(df, [])
    assert [tuple(r) for r in counts.collect()] == [("d", 3), ("a", 2), ("b", 2), ("c", 1)]
    assert [tuple(r) for r in top_words(counts, 2).collect()] == [("d", 3), ("a", 2)]
    assert rows(rank_words(counts, 3)) == [("a", 2, 2), ("b", 2, 3), ("d", 3, 1)]
    assert zipf_top10(counts).count() == 4
    assert rows(zipf_compare(counts, 3)) == [("a", 2, 2, 1.5), ("b", 2, 3, 1.0), ("d", 3, 1, 3.0)]


def test_default_stopwords(spark):
    assert "de" in portuguese_stopwords()
    assert rows(word_count(_texts(spark, "de gene de")), "word") == [("gene",)]
