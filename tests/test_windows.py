import datetime as dt

from clipwire.operators import (
    assign_windows,
    producer_window,
    stamp_from_date,
    window_page_cap,
)
from helpers import flat, rows

TODAY = dt.date(2024, 1, 31)


def _at(spark, *times):
    return flat(spark, *[{"url": str(i), "publishedAt": t} for i, t in enumerate(times)])


def test_windows_are_half_open_and_31_long(spark):
    df = _at(
        spark,
        "2023-12-31T23:59:59Z",
        "2024-01-01T00:00:00Z",
        "2024-01-31T23:59:59Z",
        "2024-02-01T00:00:00Z",
        "n/a",
    )
    out = assign_windows(df, TODAY)
    assert rows(out, "url", "from_date") == [
        ("1", dt.date(2024, 1, 1)),
        ("2", dt.date(2024, 1, 31)),
    ]


def test_windows_go_by_the_instant(spark):
    df = _at(spark, "2024-01-01T23:30:00-05:00", "2024-01-02T00:30:00+01:00", "2024-01-02T01:00:00+01:00")
    assert rows(assign_windows(df, TODAY), "url", "from_date") == [
        ("0", dt.date(2024, 1, 2)), ("1", dt.date(2024, 1, 1)), ("2", dt.date(2024, 1, 2)),
    ]
    assert rows(assign_windows(df, TODAY, closed=True), "url", "from_date") == [
        ("0", dt.date(2024, 1, 2)), ("1", dt.date(2024, 1, 1)),
        ("2", dt.date(2024, 1, 1)), ("2", dt.date(2024, 1, 2)),
    ]


def test_closed_windows_share_midnight(spark):
    df = _at(spark, "2024-01-02T00:00:00Z", "2024-01-02T00:00:01Z", "2024-02-01T00:00:00Z")
    out = assign_windows(df, TODAY, closed=True)
    assert rows(out, "url", "from_date") == [
        ("0", dt.date(2024, 1, 1)),
        ("0", dt.date(2024, 1, 2)),
        ("1", dt.date(2024, 1, 2)),
        ("2", dt.date(2024, 1, 31)),
    ]


def test_page_cap_keeps_the_most_popular_of_each_window(spark):
    days = [dt.date(2024, 1, 1), dt.date(2024, 1, 2)]
    # The first window holds far more rows than the second, over many input partitions.
    df = spark.range(0, 900, 1, 12).selectExpr(
        "cast(id AS string) AS url",
        "cast(id * 7 % 900 AS double) AS popularity",
        "if(id < 850, date'2024-01-01', date'2024-01-02') AS from_date",
    )
    out = window_page_cap(df, "popularity", pages=3, page_size=5, slices=4)
    everything = df.collect()
    for day in days:
        best = sorted((r["popularity"] for r in everything if r["from_date"] == day), reverse=True)
        kept = [r["popularity"] for r in out.collect() if r["from_date"] == day]
        assert sorted(kept, reverse=True) == best[:15]
    assert out.columns == ["url", "popularity", "from_date"]


def test_page_cap_breaks_ties_by_url(spark):
    df = spark.createDataFrame(
        [(u, 1.0, TODAY) for u in "dbac"], "url string, popularity double, from_date date"
    )
    assert rows(window_page_cap(df, "popularity", pages=1, page_size=2), "url") == [("a",), ("b",)]


def test_producer_window_is_closed_and_in_utc(spark):
    df = _at(
        spark,
        "2024-01-21T11:59:59Z",
        "2024-01-21T12:00:00Z",
        "2024-01-31T12:00:00Z",
        "2024-01-31T12:00:01Z",
        "n/a",
    )
    end = dt.datetime(2024, 1, 31, 12)
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
        for to_time in (end, "2024-01-31T12:00:00", end.replace(tzinfo=dt.timezone.utc)):
            assert rows(producer_window(df, to_time, 10), "url") == [("1",), ("2",)]
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert rows(producer_window(df, TODAY, 10), "url") == [("0",), ("1",)]


def test_stamp(spark):
    df = _at(spark, None)
    assert rows(stamp_from_date(df, TODAY), "from_date") == [(TODAY,)]
    assert dict(stamp_from_date(df).dtypes)["from_date"] == "date"
    assert stamp_from_date(df).first()["from_date"] is not None
