from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from clipwire.operators import dedup_latest, dedup_max_by
from helpers import flat, rows

COLUMNS = ("url", "author", "title", "publishedAt")


def _both(df):
    latest, best = rows(dedup_latest(df), *COLUMNS), rows(dedup_max_by(df), *COLUMNS)
    assert latest == best
    return latest


def test_latest_wins_and_null_keys_are_one_group(spark):
    df = flat(
        spark,
        {"url": "1", "author": "a", "title": "t", "publishedAt": "2024-01-01T00:00:00Z"},
        {"url": "2", "author": "a", "title": "t", "publishedAt": "2024-01-02T00:00:00Z"},
        {"url": "3", "title": "t", "publishedAt": "2024-01-01T00:00:00Z"},
        {"url": "4", "title": "t", "publishedAt": "2024-01-03T00:00:00Z"},
        {"url": "5"},
        {"url": "6"},
    )
    assert [r[0] for r in _both(df)] == ["2", "4", "6"]


def test_ties_and_bad_dates(spark):
    df = flat(
        spark,
        {"url": "1", "title": "t", "publishedAt": "2024-01-02T00:00:00Z"},
        {"url": "2", "title": "t", "publishedAt": "2024-01-02T00:00:00Z"},
        {"url": "3", "title": "t", "publishedAt": "n/a"},
        {"url": "4", "title": "t"},
        {"url": "5", "title": "u", "publishedAt": "n/a"},
        {"url": "6", "title": "u"},
    )
    assert [r[0] for r in _both(df)] == ["2", "5"]


def test_time_order_beats_string_order(spark):
    df = flat(
        spark,
        {"url": "late", "title": "t", "publishedAt": "2024-01-01T23:30:00-05:00"},
        {"url": "early", "title": "t", "publishedAt": "2024-01-02T01:00:00Z"},
    )
    assert [r[0] for r in _both(df)] == ["late"]


articles = st.lists(
    st.tuples(
        st.sampled_from([None, "a", "b"]),
        st.sampled_from([None, "t", "u"]),
        st.sampled_from([None, "n/a", "2024-01-01T00:00:00Z", "2024-01-02T00:00:00Z"]),
    ),
    min_size=1,
    max_size=12,
)


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(articles)
def test_one_row_per_key_and_idempotent(spark, drawn):
    df = flat(
        spark,
        *[
            {"url": str(i), "author": a, "title": t, "publishedAt": p}
            for i, (a, t, p) in enumerate(drawn)
        ],
    )
    once = _both(df)
    assert len(once) == len({(a, t) for a, t, _ in drawn})
    assert rows(dedup_latest(dedup_latest(df)), *COLUMNS) == once


def test_only_one_row_per_key_leaves_a_map_task(spark):
    plan = dedup_latest(flat(spark, {"url": "1"}))._jdf.queryExecution().executedPlan().toString()
    before_shuffle = plan[plan.index("Exchange") :]
    assert "WindowGroupLimit" in before_shuffle and "Partial" in before_shuffle


def test_a_hot_key_loses_no_other_row(spark):
    # Every third row is a copy of one article, spread over all input partitions.
    df = spark.range(0, 30000, 1, 12).selectExpr(
        "cast(id AS string) AS url",
        "if(id % 3 = 0, NULL, 'a') AS author",
        "if(id % 3 = 0, 'hot', concat('t', id)) AS title",
        "date_format(timestamp_seconds(id), \"yyyy-MM-dd'T'HH:mm:ss'Z'\") AS publishedAt",
    )
    for out in (dedup_latest(df), dedup_max_by(df)):
        assert out.count() == 20001
        assert rows(out.where("title = 'hot'"), "url") == [("29997",)]
