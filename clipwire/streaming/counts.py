"""Articles per day of a stream."""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from clipwire.functions.dates import day_parts, published_date
from clipwire.sources.files import complete_folders, delete_folder, folders
from clipwire.sources.tables import DEFAULT_FORMAT, load_table
from clipwire.streaming.articles import available_now

#: Totals of so many batches stay, so that slow readers finish with the one they began with.
KEPT = 8
TOTALS_SCHEMA = T.StructType(
    [
        T.StructField("published_day", T.DateType()),
        T.StructField("news_count", T.LongType()),
    ]
)


def _run_folder(path: str, checkpoint: str) -> str:
    return f"{path}/run={hashlib.sha256(checkpoint.encode()).hexdigest()[:16]}"


def _batch_folder(run: str, batch_id: int) -> str:
    return f"{run}/batch={batch_id:010d}"


def stream_counts_by_day(
    articles: DataFrame,
    path: str,
    checkpoint: str,
    trigger: dict | None = None,
    fmt: str = DEFAULT_FORMAT,
) -> StreamingQuery:
    """Keep the articles per written day of a stream, as ``count_by_day`` counts them.

    Each micro-batch adds its own counts to the totals of the batch before and writes the
    sums to a folder of its own, one row per day. No article is late, and dates that are
    none are counted under null. A batch that runs again after a failure starts from the
    same totals, so nothing is added twice; older totals are deleted. Each checkpoint has
    totals of its own, and one that starts anew starts from none.
    """
    run = _run_folder(path, checkpoint)

    def save(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        if batch_id == 0:
            delete_folder(session, run)
        counts = batch.groupBy(published_date().alias("published_day")).agg(
            F.count("*").alias("news_count")
        )
        if batch_id > 0:
            before = load_table(session, _batch_folder(run, batch_id - 1), fmt, TOTALS_SCHEMA)
            counts = counts.union(before).groupBy("published_day")
            counts = counts.agg(F.sum("news_count").alias("news_count"))
        counts.write.format(fmt).mode("overwrite").save(_batch_folder(run, batch_id))
        delete_folder(session, _batch_folder(run, batch_id - KEPT))

    return (
        articles.writeStream.foreachBatch(save)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or available_now()))
        .start()
    )


def latest_counts(
    spark: SparkSession, path: str, checkpoint: str | None = None, fmt: str = DEFAULT_FORMAT
) -> DataFrame:
    """Articles per year, month and day, as of the last micro-batch that is complete.

    Of the query with the given ``checkpoint``, or of the one that wrote last. Totals that are
    being written do not count; before the first are whole there are no rows.
    """
    if checkpoint is not None:
        runs = [_run_folder(path, checkpoint)]
    else:
        runs = [f"{path}/{name}" for name in folders(spark, path)]
    last = []
    for run in runs:
        times = folders(spark, run)
        last += [(times[name], name, run) for name in complete_folders(spark, run)[-1:] if name in times]
    if not last:
        totals = spark.createDataFrame([], TOTALS_SCHEMA)
    else:
        _, name, run = max(last)
        totals = load_table(spark, f"{run}/{name}", fmt, TOTALS_SCHEMA)
    return totals.select(*day_parts("published_day"), "news_count")
