from clipwire.operators import (
    count_by_day,
    count_by_source_author,
    count_keyword_days,
    count_keyword_occurrences,
    table_counts,
)
from clipwire.plans import aggregate_all, semantic_counts, split_counts
from clipwire.schema import DAY_TABLE, KEYWORD_TABLE, SOURCE_AUTHOR_TABLE
from clipwire.session import scratch_dir
from helpers import flat, rows


def _articles(spark):
    return flat(
        spark,
        {"source_name": "s", "author": "a", "publishedAt": "2024-01-01T01:00:00Z", "title_pt": "DNA dna", "content_pt": "xdnadna"},
        {"source_name": "s", "publishedAt": "2024-01-01T02:00:00Z", "title_pt": "genes"},
        {"source_name": "s", "publishedAt": "2024-01-02T02:00:00Z", "title_pt": "nothing"},
        {"publishedAt": "n/a", "title_pt": "genes"},
        {},
    )


def test_counts(spark):
    df = _articles(spark)
    assert rows(count_by_day(df)) == [(None, None, None, 2), (2024, 1, 1, 2), (2024, 1, 2, 1)]
    assert rows(count_by_source_author(df)) == [(None, None, 2), ("s", None, 2), ("s", "a", 1)]
    assert rows(count_keyword_days(df)) == [(None, None, None, 1), (2024, 1, 1, 2)]


def test_occurrences_are_counted_per_keyword(spark):
    out = count_keyword_occurrences(_articles(spark), ["DNA", "genes", "absent"])
    assert rows(out) == [
        (None, None, None, "genes", 1),
        (2024, 1, 1, "dna", 4),
        (2024, 1, 1, "genes", 1),
    ]


def test_occurrences_take_keywords_literally(spark):
    df = flat(spark, {"publishedAt": "2024-01-01", "title_pt": "a.c abc a.c"})
    assert rows(count_keyword_occurrences(df, ["a.c"])) == [(2024, 1, 1, "a.c", 2)]


def test_sum_of_days_is_the_row_count(spark):
    df = _articles(spark)
    assert sum(r["news_count"] for r in count_by_day(df).collect()) == df.count()


def test_single_pass_equals_the_three_counts(spark):
    df = _articles(spark)
    tables = split_counts(semantic_counts(df))
    assert rows(tables[DAY_TABLE]) == rows(count_by_day(df))
    assert rows(tables[SOURCE_AUTHOR_TABLE]) == rows(count_by_source_author(df))
    assert rows(tables[KEYWORD_TABLE]) == rows(count_keyword_days(df))


def test_aggregate_all_writes_three_tables(spark):
    df = _articles(spark)
    paths = aggregate_all(df, scratch_dir(spark, "aggregate"))
    assert set(paths) == {DAY_TABLE, SOURCE_AUTHOR_TABLE, KEYWORD_TABLE}
    assert rows(spark.read.parquet(paths[DAY_TABLE])) == rows(count_by_day(df))
    assert rows(spark.read.parquet(paths[KEYWORD_TABLE])) == rows(count_keyword_days(df))


def test_table_counts(spark):
    dated = spark.createDataFrame([("2024-01-01",), ("2024-01-01",), (None,)], "from_date string")
    out = table_counts({"raw": dated, "flat": _articles(spark)})
    assert rows(out) == [("flat", None, 5), ("raw", None, 1), ("raw", "2024-01-01", 2)]
