import datetime as dt
import json
import os

import pytest
from pyspark.sql import Row

from clipwire.checks import registry
from clipwire.operators import count_by_day, dedup_latest, stamp_from_date
from clipwire.schema import RAW_SCHEMA
from clipwire.session import scratch_dir
from clipwire.sources.files import folders
from clipwire.sources import (
    ingest_articles,
    load_table,
    read_payload_files,
    write_partition_append,
)
from clipwire.streaming import (
    add_keys,
    append_raw,
    available_now,
    file_payloads,
    hourly_batches,
    latest_articles,
    latest_counts,
    make_keys,
    merge,
    new_articles,
    stream_articles,
    stream_counts_by_day,
    stream_dedup,
    stream_latest,
    stream_stage_merge,
)
from clipwire.streaming.latest import _Latest
from helpers import rows

DAY = dt.date(2024, 1, 5)


def _article(title, author, published, url):
    return {"title": title, "author": author, "publishedAt": published, "url": url}


FIRST = [
    _article("t", "a", "2024-01-01T10:00:00Z", "1"),
    _article("t", "a", "2024-01-01T12:00:00Z", "2"),
    _article("n", None, "2024-01-01T10:00:00Z", "3"),
]
SECOND = [
    _article("n", None, "2024-01-02T10:00:00Z", "4"),
    _article("u", "a", "2024-01-02T10:00:00Z", "5"),
]


@pytest.fixture
def landing(tmp_path):
    def drop(name, articles):
        (tmp_path / "landing").mkdir(exist_ok=True)
        (tmp_path / "landing" / name).write_text(json.dumps({"articles": articles}) + "\n")

    drop("1.json", FIRST)
    drop("2.json", SECOND)
    drop.path = str(tmp_path / "landing")
    return drop


def _stream(spark, landing):
    return stream_articles(file_payloads(spark, landing.path, files_per_batch=1))


def test_counts_that_are_being_written_do_not_count(spark, landing):
    out = scratch_dir(spark, "half")
    assert latest_counts(spark, f"{out}/counts").collect() == []
    stream_counts_by_day(_stream(spark, landing), f"{out}/counts", f"{out}/cp").awaitTermination()
    before = rows(latest_counts(spark, f"{out}/counts"))
    run = next(iter(folders(spark, f"{out}/counts")))
    half = f"{out}/counts/{run}/batch=0000000002/_temporary"
    spark.range(1).write.parquet(half)
    assert before and rows(latest_counts(spark, f"{out}/counts")) == before
    assert rows(latest_counts(spark, f"{out}/counts", f"{out}/cp")) == before


def _by_batch(spark, tmp_path, *batches):
    """A stream with a micro-batch for each list of articles, one file each."""
    folder = tmp_path / "batches"
    folder.mkdir()
    for n, articles in enumerate(batches):
        file = folder / f"{n}.json"
        file.write_text("".join(json.dumps({"articles": [a]}) + "\n" for a in articles))
        os.utime(file, (1_700_000_000 + n, 1_700_000_000 + n))
    return stream_articles(file_payloads(spark, str(folder), files_per_batch=1))


def test_stream_gives_the_batch_rows(spark, landing):
    out = scratch_dir(spark, "stream")
    append_raw(_stream(spark, landing), f"{out}/raw", f"{out}/cp").awaitTermination()
    batch = ingest_articles(read_payload_files(spark, landing.path))
    table = load_table(spark, f"{out}/raw")
    assert rows(table, "url", "title", "author") == rows(batch, "url", "title", "author")
    assert table.where("from_date IS NULL").count() == 0


def test_merge_inserts_each_article_once(spark, landing):
    out = scratch_dir(spark, "merge")

    def run(checkpoint):
        stream_stage_merge(
            _stream(spark, landing), f"{out}/raw", f"{out}/staging-{checkpoint}",
            f"{out}/{checkpoint}", from_date=DAY,
        ).awaitTermination()
        return rows(load_table(spark, f"{out}/raw", schema=RAW_SCHEMA), "author", "title", "from_date")

    expected = [(None, "n", DAY), ("a", "t", DAY), ("a", "u", DAY)]
    assert run("one") == expected
    # The same checkpoint has nothing to do; a new one sees all again and adds nothing.
    assert run("one") == expected
    assert run("two") == expected
    landing("3.json", [_article("v", None, "2024-01-03T10:00:00Z", "6"), *FIRST])
    assert run("one") == [(None, "n", DAY), (None, "v", DAY), ("a", "t", DAY), ("a", "u", DAY)]


@pytest.mark.parametrize("when", ["before", "after"])
def test_merge_after_a_crash(spark, landing, monkeypatch, when):
    """A crash between the key write and the article write, or between that and the commit."""
    out = scratch_dir(spark, "crash")
    write, crashes = merge.write_partition_append, []

    def crash(df, path, fmt):
        if when == "after":
            write(df, path, fmt)
        crashes.append(path)
        raise RuntimeError("executor lost")

    def run(day):
        return stream_stage_merge(
            _stream(spark, landing), f"{out}/raw", f"{out}/staging", f"{out}/cp", from_date=day
        )

    monkeypatch.setattr(merge, "write_partition_append", crash)
    with pytest.raises(Exception, match="executor lost"):
        run(DAY).awaitTermination()
    monkeypatch.setattr(merge, "write_partition_append", write)
    # The second try is on another day.
    run(DAY + dt.timedelta(1)).awaitTermination()
    table = load_table(spark, f"{out}/raw", schema=RAW_SCHEMA)
    assert crashes and rows(table, "author", "title") == [(None, "n"), ("a", "t"), ("a", "u")]


def test_merge_indexes_each_key_once_with_its_day(spark, landing):
    out = scratch_dir(spark, "indexed")
    stream_stage_merge(
        _stream(spark, landing), f"{out}/raw", f"{out}/staging", f"{out}/cp", from_date=DAY
    ).awaitTermination()
    keys = merge.key_index(spark, f"{out}/raw").read()
    assert [r["_day"] for r in keys.collect()] == [DAY] * 3
    assert keys.select("_digest").distinct().count() == 3


def test_merge_runs_beside_a_job_that_writes_later(spark, landing):
    """A job indexes its keys first, so a stream that comes in between inserts no copy."""
    out = scratch_dir(spark, "beside")
    raw = stamp_from_date(ingest_articles(read_payload_files(spark, landing.path)), DAY).where("url IN ('2', '3')")
    add_keys(raw, f"{out}/raw", "jobs", 1)
    stream_stage_merge(
        _stream(spark, landing), f"{out}/raw", f"{out}/staging", f"{out}/cp"
    ).awaitTermination()
    write_partition_append(raw, f"{out}/raw")
    assert rows(load_table(spark, f"{out}/raw"), "url") == [("2",), ("3",), ("5",)]


def test_merge_of_many_batches_merges_its_runs(spark, tmp_path):
    articles = [[_article(f"t{n % 20}", "a", "2024-01-01T00:00:00Z", str(n))] for n in range(26)]
    out = scratch_dir(spark, "runs")
    stream_stage_merge(
        _by_batch(spark, tmp_path, *articles), f"{out}/raw", f"{out}/staging", f"{out}/cp"
    ).awaitTermination()
    assert load_table(spark, f"{out}/raw").count() == 20
    runs = [r for r in merge.key_index(spark, f"{out}/raw").runs() if r.writer != merge.BASE]
    assert [r.level for r in runs] == [1, 1, 1, 0, 0]


def test_merge_knows_what_other_jobs_wrote(spark, landing):
    out = scratch_dir(spark, "others")
    raw = stamp_from_date(ingest_articles(read_payload_files(spark, landing.path)), DAY)
    write_partition_append(raw.where("url IN ('2', '3')"), f"{out}/raw")
    for n in (1, 2):
        stream_stage_merge(
            _stream(spark, landing), f"{out}/raw", f"{out}/staging", f"{out}/cp{n}"
        ).awaitTermination()
        assert rows(load_table(spark, f"{out}/raw"), "url") == [("2",), ("3",), ("5",)]
        make_keys(spark, f"{out}/raw")


def test_merge_takes_the_latest_copy_within_a_batch(spark, landing):
    out = scratch_dir(spark, "latest")
    stream_stage_merge(
        _stream(spark, landing), f"{out}/raw", f"{out}/staging", f"{out}/cp"
    ).awaitTermination()
    assert rows(load_table(spark, f"{out}/raw"), "url", "title")[0] == ("2", "t")


@pytest.mark.parametrize("lookup", [True, False])
def test_new_articles_compares_null_safely(spark, lookup):
    columns = "author string, title string, publishedAt string, url string"
    batch = spark.createDataFrame(
        [(None, "a", "1", "1"), (None, None, "1", "2"), ("x", "a", "1", "3"), ("x", None, "1", "4")],
        columns,
    )
    target = spark.createDataFrame(
        [(None, "a", "0", "0"), (None, None, "0", "0"), (None, "a", "0", "0")], columns
    )
    fresh = new_articles(batch, target, lookup=lookup)
    assert rows(fresh, "author", "title") == [("x", None), ("x", "a")]
    assert fresh.columns == batch.columns


def test_lookup_does_not_shuffle_the_target(spark):
    path = scratch_dir(spark, "target")
    columns = "author string, title string, publishedAt string, url string, content string"
    spark.createDataFrame([("a", "t", "1", "1", "long")], columns).write.parquet(path)
    batch = spark.createDataFrame([("a", "t", "1", "1", "c")], columns)
    plan = new_articles(batch, spark.read.parquet(path), lookup=True)
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in text and "LeftSemi" in text
    # Only the key columns of the target are read.
    assert "ReadSchema: struct<author:string,title:string>" in text


def test_dedup_within_watermark(spark, landing):
    out = scratch_dir(spark, "dedup")
    unique = stream_dedup(_stream(spark, landing), "10 days")
    append_raw(unique, f"{out}/raw", f"{out}/cp").awaitTermination()
    assert rows(load_table(spark, f"{out}/raw"), "author", "title") == [
        (None, "n"), ("a", "t"), ("a", "u"),
    ]


def test_stream_counts_equal_batch_counts(spark, landing):
    out = scratch_dir(spark, "counts")

    def run():
        stream_counts_by_day(
            _stream(spark, landing), f"{out}/counts", f"{out}/cp"
        ).awaitTermination()
        return rows(latest_counts(spark, f"{out}/counts"))

    def batch():
        return rows(count_by_day(ingest_articles(read_payload_files(spark, landing.path))))

    assert run() == batch()
    landing("3.json", FIRST)
    assert run() == batch()


@pytest.mark.parametrize("parts", [1, 3])
def test_dedup_forgets_only_what_it_emitted(spark, tmp_path, parts):
    # The copy of day 9 is dropped, so it must not hide that of day 15 from the one of day 0.
    def day(n):
        return _article("t", "a", f"2024-01-{1 + n:02d}T00:00:00Z", str(n))

    def others(n):
        return _article(f"o{n}", "b", f"2024-01-{1 + n:02d}T00:00:00Z", f"o{n}")

    batches = [[day(0)], [day(9)], [others(20)], [others(20)], [day(15)], [day(0)]]
    stream = _by_batch(spark, tmp_path, *batches).repartition(parts)
    out = scratch_dir(spark, "forget")
    query = append_raw(stream_dedup(stream, "10 days"), f"{out}/raw", f"{out}/cp")
    query.awaitTermination()
    assert len([p for p in query.recentProgress if p["numInputRows"]]) == len(batches)
    kept = rows(load_table(spark, f"{out}/raw").where("title = 't'"), "url")
    assert kept == [("0",), ("15",)]


def test_dedup_of_a_hot_key(spark, tmp_path):
    hot = [_article("t", "a", f"2024-01-01T00:{n % 60:02d}:00Z", str(n)) for n in range(500)]
    rest = [_article(f"t{n}", "a", "2024-01-01T00:00:00Z", f"r{n}") for n in range(50)]
    out = scratch_dir(spark, "hot")
    stream = _by_batch(spark, tmp_path, hot[:250] + rest, hot[250:] + rest)
    append_raw(stream_dedup(stream, "1 day"), f"{out}/raw", f"{out}/cp").awaitTermination()
    assert load_table(spark, f"{out}/raw").count() == 51


def test_stream_counts_take_the_written_day_and_count_bad_dates(spark, tmp_path):
    times = ["n/a", None, "2024-01-01T23:30:00-05:00", "2024-01-01T10:00:00Z", "2023-01-01T00:00:00Z"]
    batches = [[_article("t", "a", t, str(n))] for n, t in enumerate(times)]
    stream = _by_batch(spark, tmp_path, *batches)
    out = scratch_dir(spark, "bad-dates")
    batch = count_by_day(ingest_articles(read_payload_files(spark, str(tmp_path / "batches"))))
    for checkpoint in ("one", "two", "one"):
        stream_counts_by_day(stream, f"{out}/counts", f"{out}/{checkpoint}").awaitTermination()
        assert rows(latest_counts(spark, f"{out}/counts")) == rows(batch)
        assert rows(latest_counts(spark, f"{out}/counts", f"{out}/{checkpoint}")) == rows(batch)
    assert rows(batch)[0] == (None, None, None, 2)


def test_registered_streams_have_many_batches(spark):
    stream, folder, _ = registry._payload_stream(spark, "/root/testdata/sf0.001", "count-batches")
    query = append_raw(stream, f"{folder}/raw", f"{folder}/checkpoint")
    query.awaitTermination()
    assert len([p for p in query.recentProgress if p["numInputRows"]]) >= 3


def test_triggers():
    assert hourly_batches() == {"processingTime": "1 hour"}
    assert available_now() == {"availableNow": True}


def test_latest_copy_of_a_later_batch_wins(spark, tmp_path):
    def at(day, url, title="t", author="a"):
        return _article(title, author, day and f"2024-01-{day:02d}T00:00:00Z", url)

    batches = [
        [at(1, "1"), at(2, "n", "n", None)],
        [at(3, "2"), at(2, "m", "n", None), at(None, "x", "x", None)],
        [at(2, "3"), at(3, "4"), at(1, "x2", "x", None)],
        # Event time goes on, and the state of the first keys expires.
        [at(28, "5", "z", "z")],
        [at(29, "6", "z", "z")],
        [at(27, "7"), at(29, "8", "z", "z")],
    ]
    out = scratch_dir(spark, "latest-wins")
    stream = stream_latest(_by_batch(spark, tmp_path, *batches), "5 days", keep_days=6)
    query = append_raw(stream, f"{out}/raw", f"{out}/cp")
    query.awaitTermination()
    came = ingest_articles(read_payload_files(spark, str(tmp_path / "batches")))
    latest = latest_articles(spark, f"{out}/raw")
    columns = ("author", "title", "publishedAt", "url")
    assert rows(latest, *columns) == rows(dedup_latest(came), *columns)
    # Copies that are not later do not come out again.
    urls = [r["url"] for r in load_table(spark, f"{out}/raw").select("url").collect()]
    assert "3" not in urls and {"1", "2", "4", "7", "8"} <= set(urls)
    states = [p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress if p["stateOperators"]]
    assert states and states[-1] < max(states)


def test_latest_takes_rows_without_a_frame_for_each_key():
    """A key's rows come as they are, and a new key costs its state three calls."""

    class Handle:
        def __init__(self):
            self.calls, self.value = [], None

        def __getattr__(self, name):
            def call(*given):
                self.calls.append(name)
                if name == "getValueState":
                    return self
                if name == "update":
                    self.value = given[0]
                return {"get": self.value, "listTimers": iter([(7,)])}.get(name)

            return call

        def getCurrentWatermarkInMs(self):
            return 5

    handle, latest = Handle(), _Latest(10)
    latest.init(handle)
    row = lambda at, n: Row(at=at, published=f"p{n}", tie="t", article=f"a{n}")
    got = list(latest.handleInputRows(("k",), iter([row(None, 9), row(3, 1), row(3, 2), row(2, 3)]), handle))
    assert got == [Row(article="a2")] and handle.value == (3, "p2", "t")
    assert handle.calls == ["getValueState", "get", "update", "registerTimer"]
    assert list(latest.handleInputRows(("k",), iter([row(3, 0)]), handle)) == []
    assert list(latest.handleInputRows(("k",), iter([row(4, 0)]), handle)) == [Row(article="a0")]
    assert handle.calls[4:] == ["get", "get", "update", "listTimers", "deleteTimer", "registerTimer"]
    assert list(latest.handleExpiredTimer(("k",), handle, None)) == []
