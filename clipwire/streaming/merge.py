"""Stage a batch, check it against the table, insert what is new."""

from __future__ import annotations

import datetime as dt
import hashlib
from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from clipwire.operators.dedup import dedup_latest
from clipwire.operators.windows import stamp_from_date
from clipwire.schema import ARTICLE_KEYS, RAW_SCHEMA
from clipwire.sources.keyindex import KeyIndex, key_digest
from clipwire.sources.tables import DEFAULT_FORMAT, load_table, write_overwrite
from clipwire.sources.tables import append_as_dealt as write_partition_append
from clipwire.streaming.articles import available_now

#: The writer whose one run holds the keys of articles that were there before the index.
BASE = "base"


def _same_key(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> Column:
    # Null-safe: an article without author equals its stored copy without author.
    return reduce(and_, [left[k].eqNullSafe(right[f"_{k}"]) for k in keys])


def _keys_of(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.select(*[F.col(k).alias(f"_{k}") for k in keys])


def new_articles(
    batch: DataFrame,
    target: DataFrame,
    keys: Sequence[str] = ARTICLE_KEYS,
    tie: Sequence[str] = ("url",),
    lookup: bool = False,
) -> DataFrame:
    """The latest row of each key in ``batch`` whose key is not in ``target``.

    The distinct target keys are shuffled to the batch. With ``lookup``, for a batch known
    to be small, its keys are broadcast to the scan of the target's key columns, so that
    the target is not shuffled and only keys found there come back.
    """
    latest = dedup_latest(batch, keys, tie=tie)
    stored = target.select(*keys)
    if lookup:
        asked = F.broadcast(_keys_of(batch, keys).distinct())
        stored = stored.join(asked, _same_key(stored, asked, keys), "left_semi")
    known = _keys_of(stored, keys).distinct()
    return latest.join(known, _same_key(latest, known, keys), "left_anti")


def keys_path(target: str) -> str:
    """Where the key index of the table at ``target`` is."""
    return f"{target.rstrip('/')}_keys"


def key_index(spark: SparkSession, target: str) -> KeyIndex:
    """The index of the keys in the table at ``target``, with the day each came in."""
    return KeyIndex(spark, keys_path(target), "_day date")


def make_keys(
    spark: SparkSession,
    target: str,
    keys: Sequence[str] = ARTICLE_KEYS,
    schema: T.StructType = RAW_SCHEMA,
    fmt: str = DEFAULT_FORMAT,
) -> None:
    """Index the keys of all articles in ``target``, unless that was done."""
    index = key_index(spark, target)
    if not index.has(BASE, 0):
        stored = load_table(spark, target, fmt, schema)
        rows = stored.select(key_digest(keys).alias("_digest"), F.col("from_date").alias("_day"))
        index.add(rows.groupBy("_digest").agg(F.max("_day").alias("_day")), BASE, 0)


def add_keys(
    articles: DataFrame, target: str, writer: str, number: int, keys: Sequence[str] = ARTICLE_KEYS
) -> None:
    """Index the keys of articles that a job is about to write to ``target``.

    Streams that merge into the table at the same time then know them. ``number`` grows from one
    call of a writer to its next. An article that a job takes out again stays known.
    """
    index = key_index(articles.sparkSession, target)
    rows = articles.select(key_digest(keys).alias("_digest"), F.col("from_date").alias("_day"))
    index.add(rows.groupBy("_digest").agg(F.max("_day").alias("_day")), writer, number)
    index.merge(writer)


def stream_stage_merge(
    articles: DataFrame,
    target: str,
    staging: str,
    checkpoint: str,
    keys: Sequence[str] = ARTICLE_KEYS,
    tie: Sequence[str] = ("url",),
    from_date: dt.date | None = None,
    schema: T.StructType = RAW_SCHEMA,
    trigger: dict | None = None,
    fmt: str = DEFAULT_FORMAT,
) -> StreamingQuery:
    """Insert a stream of articles into the table at ``target`` without duplicates.

    Each micro-batch is first written to ``staging``, in place of the one before. Its keys are
    looked up in an index beside the target, which reads little of it for a small batch; the
    target is not read. Keys are written first, as the run of that batch, then the articles. A
    batch that runs again after a failure keeps the run it wrote, does not take it for known,
    and looks for its articles in the day it wrote to. So none is lost and none comes twice.
    Each query needs its own ``staging``.

    Other jobs that write to the target call ``add_keys`` first.
    """
    spark = articles.sparkSession
    run = hashlib.sha256(checkpoint.encode()).hexdigest()[:16]
    # An empty table of the right shape, unless one is there.
    empty = spark.createDataFrame([], schema)
    empty.write.format(fmt).mode("ignore").partitionBy("from_date").save(target)
    make_keys(spark, target, keys, schema, fmt)

    def merge(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        index = key_index(session, target)
        day = from_date or session.range(1).select(F.current_date()).first()[0]
        again = index.has(run, batch_id)
        write_overwrite(batch, staging, fmt)
        staged = load_table(session, staging, fmt, batch.schema)
        # One digest for each key: the whole rows are shuffled by it once, to be compared and looked up.
        keyed = staged.withColumn("_digest", key_digest(keys))
        latest = dedup_latest(keyed, ["_digest"], tie=tie)
        if again:
            mine = index.lookup(keyed, lambda r: r.writer == run and r.first == r.last == batch_id)
            day = mine.agg(F.max("_day")).first()[0] or day
            stored = load_table(session, target, fmt, schema).where(F.col("from_date") == F.lit(day))
            there = stored.select(key_digest(keys).alias("_digest"))
            fresh = latest.join(mine.select("_digest"), "_digest", "left_semi")
            fresh = fresh.join(there, "_digest", "left_anti")
        else:
            known = index.lookup(keyed, lambda r: r.writer != run or r.last < batch_id)
            fresh = latest.join(known.select("_digest"), "_digest", "left_anti")
            added = keyed.join(known.select("_digest"), "_digest", "left_anti").select("_digest").distinct()
            index.add(added.withColumn("_day", F.lit(day)), run, batch_id)
        # A batch of known keys alone shuffles no whole rows.
        if again or not index.read(lambda r: r.writer == run and r.first <= batch_id <= r.last).isEmpty():
            # They lie even by their digests, and all go to one day.
            write_partition_append(stamp_from_date(fresh.drop("_digest"), day), target, fmt)
        if not again:
            index.merge(run)

    return (
        articles.writeStream.foreachBatch(merge)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or available_now()))
        .start()
    )
