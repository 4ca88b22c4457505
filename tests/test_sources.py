import datetime as dt
import json

import pyarrow.dataset as pads
import pytest

from clipwire.operators import stamp_from_date, translate_udf
from clipwire.plans import daily_job
from clipwire.schema import INGESTED_SCHEMA, MEMORY_SCHEMA, RAW_SCHEMA
from clipwire.session import scratch_dir
from clipwire.sources import (
    history_union,
    ingest_articles,
    load_table,
    read_csv_export,
    read_payload_files,
    rejected_articles,
    rejected_payloads,
    write_csv_export,
    write_overwrite,
    write_partition_append,
    write_partition_overwrite,
)
from clipwire.sources.tables import _by_partition, append_as_dealt
from clipwire.streaming import append_raw, file_payloads, stream_articles
from helpers import rows

DAY = dt.date(2024, 1, 1)


def _payload(*titles, **extra):
    return json.dumps(
        {
            "status": "ok",
            "articles": [
                {"source": {"id": None, "name": "S"}, "author": None, "title": t, **extra}
                for t in titles
            ],
        }
    )


def _payloads(spark, *texts):
    return spark.createDataFrame([(t,) for t in texts], "value string")


def test_ingest_takes_all_articles_and_only_good_payloads(spark):
    df = _payloads(
        spark,
        _payload("a", "b", unknown=1),
        _payload(),
        '{"status": "ok"}',
        "{}",
        "not json",
        '{"articles": [null]}',
        '{"status": "error", "code": "rateLimited"}',
        '{"articles": "text"}',
        '{"articles": [{"title": ',
        None,
    )
    out = ingest_articles(df)
    assert rows(out, "title") == [("a",), ("b",)]
    assert [f.name for f in out.schema] == INGESTED_SCHEMA.names
    assert rows(out, "extra", "position") == [('{"unknown":"1"}', 0), ('{"unknown":"1"}', 1)]
    assert {r[0] for r in rows(rejected_payloads(df))} == {
        "not json", '{"articles": "text"}', '{"articles": [{"title": ',
    }


def test_each_payload_is_parsed_once(spark):
    path = scratch_dir(spark, "once")
    _payloads(spark, _payload("a")).write.text(path)
    out = ingest_articles(read_payload_files(spark, path))
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("StructField(articles,") == 1


def test_a_bad_article_rejects_itself_only(spark):
    bad = {"title": "bad", "source": "text"}
    payload = json.loads(_payload("a", "b"))
    payload["articles"].insert(1, bad)
    df = _payloads(spark, json.dumps(payload), '{"articles": [7, "x", {}]}', "broken")
    out = ingest_articles(df)
    assert rows(out, "title", "position") == [(None, 2), ("a", 0), ("b", 2)]
    rejected = rows(rejected_articles(df), "value")
    assert [json.loads(r[0]) if r[0][0] == "{" else r[0] for r in rejected] == ["7", "x", bad]
    assert rows(rejected_payloads(df)) == [("broken",)]


def test_payload_files_by_day(spark):
    path = scratch_dir(spark, "files")
    days = spark.createDataFrame(
        [(_payload("a", "b"), "2024-01-01"), (_payload("c"), "2024-01-02")],
        "value string, from_date string",
    )
    days.write.partitionBy("from_date").text(path)
    out = ingest_articles(read_payload_files(spark, path))
    assert rows(out, "title", "from_date") == [
        ("a", dt.date(2024, 1, 1)), ("b", dt.date(2024, 1, 1)), ("c", dt.date(2024, 1, 2)),
    ]


def test_payload_over_many_lines(spark, tmp_path):
    (tmp_path / "reply.json").write_text(json.dumps(json.loads(_payload("a")), indent=2))
    assert ingest_articles(read_payload_files(spark, str(tmp_path), whole_files=True)).count() == 1


def test_daily_job_takes_a_map_source_and_keeps_other_columns(spark):
    out = scratch_dir(spark, "inferred")
    raw = spark.createDataFrame(
        [({"id": None, "name": "S"}, "a", "genes", None, "2024-01-01T00:00:00Z", None, "u", "more", "2024-01-01")],
        "source map<string,string>, author string, title string, description string, "
        "publishedAt string, content string, url string, extra string, from_date string",
    )
    write_partition_append(raw, f"{out}/raw")
    write_overwrite(spark.createDataFrame([], MEMORY_SCHEMA), f"{out}/memory")
    paths = daily_job(spark, f"{out}/raw", f"{out}/memory", out)
    harmonized = spark.read.parquet(paths["harmonized"])
    assert rows(harmonized, "source_name", "extra", "title_pt") == [("S", "more", "genes")]


def test_history_union(spark):
    a = spark.createDataFrame([(1, "x")], "n int, t string")
    b = spark.createDataFrame([("y",)], "t string")
    assert history_union([]) is None
    assert rows(history_union([a, b]), "n", "t") == [(None, "y"), (1, "x")]


def _raw(spark, day, *titles):
    df = ingest_articles(_payloads(spark, _payload(*titles)))
    return stamp_from_date(df, day)


def test_partition_overwrite_keeps_other_days(spark):
    path = scratch_dir(spark, "raw")
    write_partition_overwrite(_raw(spark, DAY, "a"), path)
    write_partition_overwrite(_raw(spark, DAY + dt.timedelta(1), "b"), path)
    write_partition_overwrite(_raw(spark, DAY, "c"), path)
    assert rows(load_table(spark, path), "title") == [("b",), ("c",)]
    write_partition_append(_raw(spark, DAY, "d"), path)
    assert rows(load_table(spark, path, schema=RAW_SCHEMA), "title", "from_date") == [
        ("b", DAY + dt.timedelta(1)), ("c", DAY), ("d", DAY),
    ]
    assert rows(load_table(spark, path, since=DAY + dt.timedelta(1)), "title") == [("b",)]
    write_overwrite(_raw(spark, DAY, "e"), path)
    assert rows(load_table(spark, path), "title") == [("e",)]


def test_since_prunes_partitions(spark):
    path = scratch_dir(spark, "pruned")
    write_partition_overwrite(_raw(spark, DAY, "a"), path)
    plan = load_table(spark, path, since=DAY)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(from_date" in plan


def test_csv_round_trip(spark):
    path = scratch_dir(spark, "csv")
    texts = ['say "hi", then\nleave', "plain", "a\\b", None, "tab\there"]
    df = spark.createDataFrame([(str(i), t) for i, t in enumerate(texts)], "url string, content_pt string")
    write_csv_export(df, path, rows_per_file=2)
    back = read_csv_export(spark, path, df.schema)
    assert rows(back) == rows(df)
    assert read_csv_export(spark, path).columns == ["url", "content_pt"]


def test_daily_job(spark):
    out = scratch_dir(spark, "daily")
    raw = _raw(spark, DAY, "os genes", "os genes", "outro")
    write_partition_append(raw, f"{out}/raw")
    memory = spark.createDataFrame([("outro", "dna outro")], MEMORY_SCHEMA)
    write_overwrite(memory, f"{out}/memory")
    paths = daily_job(spark, f"{out}/raw", f"{out}/memory", out)
    assert rows(spark.read.parquet(paths["harmonized"]), "title", "title_pt") == [
        ("os genes", "os genes"), ("outro", "dna outro"),
    ]
    assert rows(spark.read.parquet(paths["source_author_aggregation"])) == [("S", None, 2)]
    assert daily_job(spark, f"{out}/raw", f"{out}/memory", out) == paths


def test_writes_are_rebalanced_by_day(spark):
    plan = _by_partition(_raw(spark, DAY, "a"))._jdf.queryExecution().executedPlan().toString()
    assert "REBALANCE_PARTITIONS_BY_COL" in plan


def _stream(spark, path):
    _payloads(spark, _payload("a", content="text " * 2000)).write.text(f"{path}-in")
    append_raw(stream_articles(file_payloads(spark, f"{path}-in")), path, f"{path}-log").awaitTermination()


@pytest.mark.parametrize(
    "write",
    [
        write_overwrite,
        write_partition_overwrite,
        write_partition_append,
        append_as_dealt,
        lambda df, path: _stream(df.sparkSession, path),
        lambda df, path: translate_udf(df, str.upper, path, columns=["content"]),
    ],
)
def test_tables_are_packed_by_zstd(spark, write):
    """Whoever writes a Parquet table of texts; the session's own codec is another."""
    path = scratch_dir(spark, "packed")
    df = spark.createDataFrame([(f"text {n} " * 500, DAY) for n in range(20)], "content string, from_date date")
    write(df, path)
    files = pads.dataset(path.removeprefix("file:"), format="parquet", exclude_invalid_files=True).get_fragments()
    groups = [f.metadata.row_group(g) for f in files for g in range(f.metadata.num_row_groups)]
    assert groups and {g.column(c).compression for g in groups for c in range(g.num_columns)} == {"ZSTD"}
