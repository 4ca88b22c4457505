"""Article streams from message payloads."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from clipwire.operators.windows import stamp_from_date
from clipwire.schema import PARTITION_COLUMN
from clipwire.sources.payloads import ingest_articles, rejected_articles, rejected_payloads
from clipwire.sources.tables import DEFAULT_FORMAT, packed

# Fixed value: the topic the payloads are sent to, one whole payload per message.
TOPIC = "webhook"


def kafka_payloads(
    spark: SparkSession, servers: str, topic: str = TOPIC, per_batch: int | None = None
) -> DataFrame:
    """Payload texts from a Kafka topic. Needs Spark's Kafka connector."""
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", "earliest")
    )
    if per_batch:
        reader = reader.option("maxOffsetsPerTrigger", per_batch)
    return reader.load().select(F.col("value").cast("string").alias("value"))


def file_payloads(spark: SparkSession, path: str, files_per_batch: int | None = None) -> DataFrame:
    """Payload texts from files that arrive in a folder, one payload per line."""
    reader = spark.readStream.format("text")
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(path).select("value")


def stream_articles(payloads: DataFrame) -> DataFrame:
    """One row per article of a payload stream."""
    return ingest_articles(payloads)


def append_rejects(
    payloads: DataFrame,
    path: str,
    checkpoint: str,
    trigger: dict | None = None,
    fmt: str = DEFAULT_FORMAT,
) -> StreamingQuery:
    """Append the malformed payloads and articles of a stream to a table of their own."""
    bad = rejected_payloads(payloads).select("value")
    return (
        bad.union(rejected_articles(payloads).select("value"))
        .writeStream.format(fmt)
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or available_now()))
        .start(path)
    )


def hourly_batches() -> dict[str, str]:
    """Trigger for a query that stays up and loads once an hour."""
    return {"processingTime": "1 hour"}


def available_now() -> dict[str, bool]:
    """Trigger for a run that loads what is there and ends, for an outside scheduler."""
    return {"availableNow": True}


def append_raw(
    articles: DataFrame,
    path: str,
    checkpoint: str,
    trigger: dict | None = None,
    fmt: str = DEFAULT_FORMAT,
) -> StreamingQuery:
    """Append a stream of articles to the raw table, stamped with the ingestion day.

    A Parquet table filled this way belongs to the stream: readers trust the stream's
    own file list and would miss rows added by other jobs. To share the table with
    batch jobs, use ``stream_stage_merge`` or the Delta format.
    """
    return (
        stamp_from_date(articles)
        .writeStream.format(fmt)
        .options(**packed(fmt))
        .outputMode("append")
        .partitionBy(PARTITION_COLUMN)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or available_now()))
        .start(path)
    )
