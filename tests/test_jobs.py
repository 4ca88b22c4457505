import datetime as dt
import json

from clipwire.__main__ import run
from clipwire.schema import MEMORY_SCHEMA
from clipwire.session import scratch_dir
from helpers import rows


def _payload(*articles):
    names = ("title", "author", "publishedAt", "url", "content")
    return json.dumps({"articles": [dict(zip(names, a)) for a in articles]}) + "\n"


def test_jobs_from_payload_files_to_words(spark, tmp_path, capsys):
    out = scratch_dir(spark, "jobs")
    past = tmp_path / "past" / "from_date=2024-01-01"
    past.mkdir(parents=True)
    old = ("Novos genes", "a", "2024-01-01T08:00:00Z", "1", "raro gene raro ação")
    page = _payload(old, ("Clima", None, "2024-01-01T09:00:00Z", "2", "x"))
    (past / "page.json").write_text(page + "oops\n")
    history = ["history", "--payloads", str(tmp_path / "past"), "--raw", f"{out}/raw"]
    run(spark, [*history, "--rejects", f"{out}/rejects"])
    assert rows(spark.read.parquet(f"{out}/rejects"), "value") == [("oops",)]
    raw = spark.read.parquet(f"{out}/raw")
    assert rows(raw, "url", "from_date") == [("1", dt.date(2024, 1, 1)), ("2", dt.date(2024, 1, 1))]

    new = tmp_path / "new"
    new.mkdir()
    page = _payload(old, ("DNA", None, "2024-01-02T08:00:00Z", "3", "raro"))
    (new / "page.json").write_text(page + "{oops\n")
    recent = ["recent", "--payloads", str(new), "--raw", f"{out}/raw"]
    recent += ["--staging", f"{out}/staging", "--checkpoint", f"{out}/checkpoint"]
    recent += ["--rejects", f"{out}/new-rejects"]
    run(spark, recent)
    run(spark, recent)
    assert rows(spark.read.parquet(f"{out}/raw"), "url") == [("1",), ("2",), ("3",)]

    assert rows(spark.read.parquet(f"{out}/new-rejects"), "value") == [("{oops",)]

    memory = spark.createDataFrame([("raro", "raríssimo"), ("x", "y")], MEMORY_SCHEMA)
    memory.write.parquet(f"{out}/memory")
    tables = ["--raw", f"{out}/raw", "--memory", f"{out}/memory"]
    run(spark, ["pending", *tables, "--out", f"{out}/pending"])
    assert rows(spark.read.parquet(f"{out}/pending")) == [
        ("Clima",), ("DNA",), ("Novos genes",), ("raro gene raro ação",),
    ]

    run(spark, ["daily", *tables, "--out", out])
    assert rows(spark.read.parquet(f"{out}/harmonized"), "url", "content_pt") == [
        ("1", "raro gene raro ação"), ("3", "raríssimo"),
    ]
    days = spark.read.parquet(f"{out}/semantic/year_month_day_aggregation")
    assert rows(days) == [(2024, 1, 1, 1), (2024, 1, 2, 1)]

    words = ["words", "--harmonized", f"{out}/harmonized", "--out"]
    run(spark, [*words, f"{out}/words"])
    run(spark, [*words, f"{out}/accents", "--accents"])
    assert rows(spark.read.parquet(f"{out}/words")) == [("gene", 1), ("raro", 2)]
    assert ("ação", 1) in rows(spark.read.parquet(f"{out}/accents"))

    run(spark, [*words, f"{out}/words", "--top", f"{out}/top", "--zipf", f"{out}/zipf"])
    assert rows(spark.read.parquet(f"{out}/top")) == [("gene", 1), ("raro", 2)]
    assert spark.read.parquet(f"{out}/zipf").count() == 2

    run(spark, ["counts", "--out", f"{out}/counts", f"{out}/raw", f"{out}/harmonized"])
    assert "5 rows in 2 tables" in capsys.readouterr().out
    assert ("2024-01-01", 2) in rows(spark.read.parquet(f"{out}/counts"), "from_date", "row_count")


def test_undated_history_keeps_the_day_of_ingestion(spark, tmp_path):
    out = scratch_dir(spark, "undated")
    for name, title in (("new", "r"), ("past", "h")):
        (tmp_path / name).mkdir()
        page = _payload((title, "a", "2024-01-01T08:00:00Z", title, "x"))
        (tmp_path / name / "page.json").write_text(page)
    recent = ["recent", "--payloads", str(tmp_path / "new"), "--raw", f"{out}/raw"]
    run(spark, [*recent, "--staging", f"{out}/staging", "--checkpoint", f"{out}/checkpoint"])
    history = ["history", "--payloads", str(tmp_path / "past"), "--raw", f"{out}/raw"]
    run(spark, history)
    assert rows(spark.read.parquet(f"{out}/raw"), "title") == [("h",), ("r",)]
    run(spark, [*history, "--from-date", "2024-01-01"])
    days = rows(spark.read.parquet(f"{out}/raw").where("title = 'h'"), "from_date")
    assert days[0] == (dt.date(2024, 1, 1),) and len(days) == 2


def test_counts_of_more_than_a_thousand_days(spark):
    out = scratch_dir(spark, "many-days")
    days = spark.range(1500).selectExpr("id", "date_add(date'2020-01-01', cast(id % 1200 AS int)) AS from_date")
    days.write.parquet(f"{out}/table")
    run(spark, ["counts", "--out", f"{out}/counts", f"{out}/table"])
    assert spark.read.parquet(f"{out}/counts").count() == 1200


def test_collect_and_translate_jobs(spark, tmp_path):
    out = scratch_dir(spark, "collect")
    (tmp_path / "new").mkdir()
    page = _payload(
        ("genomics now", "a", "2024-01-02T08:00:00Z", "1", "x"),
        ("weather", "a", "2024-01-02T08:00:00Z", "2", "x"),
        ("genomics then", "a", "2023-01-02T08:00:00Z", "3", "x"),
    )
    (tmp_path / "new" / "page.json").write_text(page)
    collect = ["collect", "--payloads", str(tmp_path / "new"), "--raw", f"{out}/raw"]
    collect += ["--to", "2024-01-03T00:00:00"]
    history = ["history", "--payloads", str(tmp_path / "new"), "--raw", f"{out}/raw"]
    for _ in range(2):
        run(spark, collect)
        run(spark, [*history, "--collect", "2024-01-03"])
        assert rows(spark.read.parquet(f"{out}/raw"), "url") == [("1",)]
    memory = f"{out}/memory"
    run(spark, ["translate", "--raw", f"{out}/raw", "--memory", memory, "--translator", "textwrap:dedent"])
    assert rows(spark.read.parquet(memory), "text", "text_pt") == [("genomics now",) * 2, ("x", "x")]
