"""The latest copy of each article of a stream: a later copy in a later batch replaces the first."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from clipwire.operators.dedup import dedup_latest
from clipwire.schema import ARTICLE_KEYS, RAW_SCHEMA
from clipwire.sources.keyindex import key_digest
from clipwire.sources.tables import DEFAULT_FORMAT, load_table
from clipwire.streaming.dedup import with_event_time

_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKS_DB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_ORDER = ("at", "published", "tie")


def _order(at, published, tie) -> tuple:
    """What copies are compared by; missing values are the lowest."""
    return tuple((v is not None, v) for v in (at, published, tie))


class _Latest(StatefulProcessor):
    """Per key the order of its latest copy; an event-time timer deletes it."""

    def __init__(self, keep_ms: int):
        self.keep_ms = keep_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.best = handle.getValueState("best", "at bigint, published string, tie string")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        stored = self.best.get()
        old = None if stored is None else _order(*stored)
        best, article = old, None
        for row in rows:
            this = _order(row.at, row.published, row.tie)
            if best is None or this > best:
                best, article = this, row.article
        if article is None:
            return
        self.best.update(tuple(v for _, v in best))
        if old is not None:  # a new key has no timer, and each call is a round trip
            for timer in list(self.handle.listTimers()):
                self.handle.deleteTimer(timer if isinstance(timer, int) else timer[0])
        now = timerValues.getCurrentWatermarkInMs()
        # Not before the watermark: a copy without a time stays as long as one of this moment.
        self.handle.registerTimer(max(best[0][1] or now, now) + self.keep_ms)
        yield Row(article=article)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        self.best.clear()
        return iter(())

    def close(self) -> None:
        pass


def stream_latest(
    articles: DataFrame,
    delay: str = "1 day",
    keep_days: float = 30,
    keys: Sequence[str] = ARTICLE_KEYS,
    tie: str = "url",
) -> DataFrame:
    """The copies of a stream that are later than all of their key before, in their micro-batch.

    Of each key one row comes out per micro-batch, if it is later than what came out before, by the
    order of ``dedup_latest``. Appended to a table, they are read by ``latest_articles``, which gives
    the rows of ``dedup_latest`` over all articles that were not late. The state of a key is the
    time and tie of its latest copy, not the article, and is deleted ``keep_days`` of event time
    after it; a copy that comes later still comes out again, and readers settle it. Articles over
    ``delay`` behind the watermark are late, and Spark drops them; one without a time never is.

    Needs RocksDB for its state, which is set for the session if it is not. Copies of a hot key are
    compared as they stream by, and only the best of a micro-batch is held. Rows go to Python as they
    are; a pandas frame for each key costs some ten times as much as all else that is done for it.
    """
    spark = articles.sparkSession
    if spark.conf.get(_PROVIDER, "") != _ROCKS_DB:
        spark.conf.set(_PROVIDER, _ROCKS_DB)
    columns = articles.columns
    schema = T.StructType([articles.schema[c] for c in columns])
    timed = with_event_time(articles, delay)
    narrow = timed.select(
        F.hex(key_digest(keys)).alias("key"),
        "published_ts",
        F.unix_millis("published_ts").alias("at"),
        F.col("publishedAt").alias("published"),
        F.col(tie).alias("tie"),
        F.to_json(F.struct(*columns)).alias("article"),
    )
    latest = narrow.groupBy("key").transformWithState(
        _Latest(int(keep_days * 86_400_000)), "article string", "Append", "EventTime"
    )
    return latest.select(F.from_json("article", schema).alias("a")).select("a.*")


def latest_articles(
    spark: SparkSession,
    path: str,
    keys: Sequence[str] = ARTICLE_KEYS,
    fmt: str = DEFAULT_FORMAT,
    schema: T.StructType = RAW_SCHEMA,
) -> DataFrame:
    """The latest row of each key in a table that ``stream_latest`` was appended to."""
    return dedup_latest(load_table(spark, path, fmt, schema), keys)
