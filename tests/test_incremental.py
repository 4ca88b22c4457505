"""The daily job by what has changed, beside a full rebuild."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from clipwire.plans import daily_incremental, daily_job, incremental
from clipwire.schema import HARMONIZED_TABLE, MEMORY_SCHEMA, RAW_SCHEMA
from clipwire.session import scratch_dir
from clipwire.sources import files, write_partition_append, write_partition_overwrite
from helpers import rows

DAYS = [dt.date(2024, 1, d) for d in (1, 2, 3)]


def raw(spark, *articles):
    """Raw articles from (from_date, author, title, publishedAt, url, content)."""
    made = []
    for day, author, title, published, url, content in articles:
        known = {
            "source": ("s", "S"), "author": author, "title": title, "publishedAt": published, "url": url,
            "content": content, "from_date": day,
        }
        made.append(tuple(known.get(f) for f in RAW_SCHEMA.names))
    return spark.createDataFrame(made, RAW_SCHEMA)


class Tables:
    """The tables of one job: what comes in, what one run and a full rebuild give."""

    def __init__(self, spark, name):
        self.spark, self.out = spark, scratch_dir(spark, name)
        self.raw, self.memory = f"{self.out}/raw", f"{self.out}/memory"

    def arrive(self, *articles):
        write_partition_append(raw(self.spark, *articles), self.raw)

    def translate(self, *pairs):
        memory = self.spark.createDataFrame(list(pairs), MEMORY_SCHEMA)
        memory.write.mode("append").parquet(self.memory)

    def run(self, keywords=("genes", "dna")):
        self.paths = daily_incremental(self.spark, self.raw, self.memory, f"{self.out}/by-change", keywords, ["dna"])

    def all_rows(self, paths):
        out = {}
        for name, path in paths.items():
            df = self.spark.read.parquet(path)
            out[name] = rows(df, *sorted(c for c in df.columns if c != "published_day" and c != "source"))
        return out

    def check(self, keywords=("genes", "dna")):
        self.run(keywords)
        whole = daily_job(self.spark, self.raw, self.memory, f"{self.out}/whole", keywords, ["dna"])
        assert self.all_rows(self.paths) == self.all_rows(whole)
        return self.all_rows(self.paths)[HARMONIZED_TABLE]

    def changed(self):
        """When each day of the harmonized table was last written."""
        base = self.paths[HARMONIZED_TABLE].removeprefix("file:")
        return {d: max(os.stat(f"{base}/{d}/{f}").st_mtime_ns for f in os.listdir(f"{base}/{d}")) for d in os.listdir(base) if "=" in d}


@pytest.fixture
def tables(spark):
    made = Tables(spark, "incremental")
    made.translate(("raro", "genes raros"))
    made.arrive(
        (DAYS[0], "a", "t", "2024-01-01T10:00:00Z", "1", "dna here"),
        (DAYS[0], "b", "u", "2024-01-01T11:00:00Z", "2", "raro"),
        (DAYS[0], None, None, "2024-01-01T12:00:00Z", "3", "nothing"),
        (DAYS[0], "c", "v", "n/a", "4", "late text"),
        (DAYS[0], "d", "w", "2023-12-31T23:00:00Z", "5", "genes"),
    )
    made.check()
    return made


def test_a_new_day_touches_its_own_days(tables):
    before = tables.changed()
    tables.arrive((DAYS[1], "e", "x", "2024-01-02T10:00:00Z", "6", "dna"))
    assert len(tables.check()) == 4
    after = tables.changed()
    assert {d for d in after if after[d] != before.get(d)} == {"published_day=2024-01-02"}


def test_a_later_copy_replaces_the_old_row(tables):
    before = tables.changed()
    tables.arrive((DAYS[2], "a", "t", "2024-01-03T10:00:00Z", "7", "dna again"))
    found = tables.check()
    assert len(found) == 3 and not any("dna here" in map(str, r) for r in found)
    after = tables.changed()
    # The day that the old copy stood in has another row and is written again.
    assert {d for d in {*before, *after} if after.get(d) != before.get(d)} == {
        "published_day=2024-01-01", "published_day=2024-01-03",
    }


def test_an_earlier_copy_changes_nothing(tables):
    before = tables.changed()
    tables.arrive((DAYS[2], "a", "t", "2023-01-03T10:00:00Z", "7", "dna before"))
    tables.check()
    assert tables.changed() == before


def test_a_late_translation_brings_old_articles_in_and_out(tables):
    tables.translate(("late text", "dna tardio"), ("dna here", "nada"))
    found = tables.check()
    assert any("dna tardio" in map(str, r) for r in found)
    # The article whose text is no longer relevant is gone, and its day with the rest of it stays.
    assert not any("dna here" in map(str, r) for r in found)


def test_a_translation_brings_back_an_older_copy(tables):
    tables.arrive((DAYS[2], "d", "w", "2024-01-03T10:00:00Z", "8", "genes new"))
    tables.check()
    before = tables.changed()
    tables.translate(("genes new", "nada"))
    found = tables.check()
    assert any("2023-12-31T23:00:00Z" in map(str, r) for r in found)
    after = tables.changed()
    assert "published_day=2024-01-03" in before and "published_day=2024-01-03" not in after


def test_a_replaced_day_is_taken_back(spark, tables):
    tables.arrive((DAYS[1], "a", "t", "2024-01-02T10:00:00Z", "6", "dna two"))
    tables.check()
    again = raw(spark, (DAYS[1], "z", "z", "2024-01-02T11:00:00Z", "9", "genes z"))
    write_partition_overwrite(again, tables.raw)
    found = tables.check()
    assert any("dna here" in map(str, r) for r in found) and not any("dna two" in map(str, r) for r in found)


def test_nothing_new_changes_nothing(tables):
    before = tables.changed()
    tables.check()
    assert tables.changed() == before


def test_other_keywords_or_a_replaced_memory_build_all_anew(spark, tables):
    tables.check(("nothing", "dna"))
    memory = spark.createDataFrame([("nothing", "dna nada")], MEMORY_SCHEMA)
    memory.write.mode("overwrite").parquet(tables.memory)
    tables.check(("nothing", "dna"))


@pytest.mark.parametrize("when", ["in the swap", "before it"])
def test_a_crash_is_repeated_or_finished(tables, monkeypatch, when):
    tables.arrive(
        (DAYS[2], "a", "t", "2024-01-03T10:00:00Z", "7", "dna again"), (DAYS[2], "q", "q", "2024-01-02T10:00:00Z", "8", "dna")
    )
    tables.translate(("late text", "dna tardio"))
    from clipwire.plans import incremental

    move, calls = files.move_folder, []

    def crash(*arguments):
        if calls or when == "before it":
            raise RuntimeError("driver lost")
        calls.append(arguments)
        return move(*arguments)

    if when == "before it":
        monkeypatch.setattr(incremental, "swap", crash)
    else:
        monkeypatch.setattr(files, "move_folder", crash)
    with pytest.raises(RuntimeError, match="driver lost"):
        tables.run()
    monkeypatch.undo()
    assert len(tables.check()) == 5


def test_plan_of_a_run_reads_only_the_days_of_touched_keys(spark, tables, monkeypatch):
    from clipwire.plans import incremental

    asked = []
    real = incremental._in_days

    def noted(column, days):
        asked.append((column, sorted(map(str, days))))
        return real(column, days)

    monkeypatch.setattr(incremental, "_in_days", noted)
    tables.arrive((DAYS[2], "new", "key", "2024-01-03T10:00:00Z", "7", "dna"))
    tables.run()
    assert ("from_date", ["2024-01-03"]) in asked and ("published_day", ["2024-01-03"]) in asked
    assert all(days == ["2024-01-03"] for _, days in asked)


def test_many_articles_of_one_key(spark):
    made = Tables(spark, "hot")
    made.translate(("x", "y"))
    for day in DAYS:
        hot = [(day, None, None, f"{day}T00:{k % 60:02d}:00Z", f"{day}-{k}", f"dna {k}") for k in range(300)]
        rest = [(day, "a", f"t{k}", f"{day}T00:00:00Z", f"r{k}", "genes") for k in range(50)]
        made.arrive(*hot, *rest)
        assert len(made.check()) == 51


def test_no_rows(spark):
    made = Tables(spark, "none")
    made.translate(("x", "y"))
    made.arrive((DAYS[0], "a", "t", "2024-01-01T10:00:00Z", "1", "nothing"))
    made.run()
    assert spark.read.parquet(f"{made.out}/by-change/state/files").count() > 0
    made.arrive((DAYS[1], "a", "t", "2024-01-02T10:00:00Z", "2", "dna"))
    assert len(made.check()) == 1


def test_a_new_copy_does_not_read_the_old_ones(spark, monkeypatch):
    """A key with new articles alone is made of these and the row that it has; see what is translated."""
    tables, made = Tables(spark, "copies"), []
    translated = incremental._Run.translated

    def counted(run, source):
        made.append(source.count())
        return translated(run, source)

    monkeypatch.setattr(incremental._Run, "translated", counted)
    tables.translate(("raro", "genes raros"))
    at = lambda hour, n: (DAYS[0], "a", "t", f"2024-01-01T{hour:02d}:00:00Z", str(n), "dna")
    tables.arrive(*[at(n, n) for n in range(20)], (DAYS[0], "b", "u", "2024-01-01T01:00:00Z", "30", "late"))
    tables.check()
    tables.arrive(at(3, 21), at(22, 22), at(22, 23), (DAYS[1], "c", "x", "2024-01-02T01:00:00Z", "31", "dna"))
    tables.check()
    # An older copy alone changes nothing; a new translation makes its keys from all their articles.
    tables.arrive(at(2, 24), (DAYS[1], "b", "u", "2024-01-02T01:00:00Z", "32", "other"))
    tables.translate(("late", "dna late"))
    tables.check()
    assert made == [21, 4, 3]
