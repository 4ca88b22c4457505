import datetime as dt
import os

from pyspark.sql import functions as F

from clipwire.checks import registry
from clipwire.session import scratch_dir
from clipwire.streaming import merge


def test_days_land_in_one_pass_and_in_order(spark):
    """Two dated files for each day, in their order; the input is passed over once, not once a day."""
    passes = spark.sparkContext.accumulator(0)
    first = dt.date(2024, 1, 1)
    payloads = spark.range(60).select(
        F.concat(F.lit("row "), "id").alias("value"), F.date_add(F.lit(first), (F.col("id") % 6).cast("int")).alias("from_date")
    )

    def seen(batches):
        for batch in batches:
            passes.add(batch.num_rows)
            yield batch

    folder = scratch_dir(spark, "landing-test")
    days = [first + dt.timedelta(n) for n in range(6)] + [dt.date(2024, 2, 1)]
    registry._land(payloads.mapInArrow(seen, payloads.schema), {d: f"{folder}/{n}" for n, d in enumerate(days)})
    assert passes.value == 60
    times = []
    for n in range(6):
        got = sorted(r[0] for r in spark.read.text(f"{folder}/{n}").collect())
        assert got == sorted(f"row {k}" for k in range(60) if k % 6 == n)
        path = f"{folder}/{n}".removeprefix("file:")
        names = [x for x in os.listdir(path) if x.startswith("part-")]
        assert len(names) == 2
        times.append({int(os.path.getmtime(f"{path}/{x}")) for x in names})
    assert all(len(t) == 1 for t in times) and sorted(times, key=min) == times and len(set(map(min, times))) == 6


def test_rows_are_dealt_to_days_before_they_become_payloads(spark, monkeypatch):
    """Payloads hold each text twice, so it is not they that are shuffled."""
    dealt, frame = [], type(spark.range(1))
    by_id = frame.repartitionById
    monkeypatch.setattr(frame, "repartitionById", lambda df, *of: dealt.append(df.columns) or by_id(df, *of))
    first, folder = dt.date(2024, 1, 1), scratch_dir(spark, "landing-narrow")
    rows = spark.range(40).select(
        F.concat(F.lit("text "), "id").alias("text"), F.date_add(F.lit(first), (F.col("id") % 2).cast("int")).alias("from_date")
    )
    folders = {first + dt.timedelta(n): f"{folder}/{n}" for n in range(2)}
    registry._land(rows, folders, F.concat("text", F.lit("+"), "text"))
    assert dealt == [["text", "part"]]
    for n in range(2):
        got = sorted(r[0] for r in spark.read.text(f"{folder}/{n}").collect())
        assert got == sorted(f"text {k}+text {k}" for k in range(40) if k % 2 == n)


def test_history_days_are_read_from_where_they_landed(spark, monkeypatch):
    """Neither the join to the times is made for each day, nor does one micro-batch hold all days."""
    write, staged = merge.write_overwrite, []

    def watched(batch, path, fmt):
        write(batch, path, fmt)
        staged.append(path)

    def joined(*_):
        raise AssertionError("joined once more")

    monkeypatch.setattr(registry, "article_payloads", joined)
    monkeypatch.setattr(merge, "write_overwrite", watched)
    assert registry.registered()["merge_after_history"](spark, "/root/testdata/sf0.001").count() > 0
    assert len(staged) >= 3
