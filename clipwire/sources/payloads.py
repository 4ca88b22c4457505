"""Articles out of JSON payloads, read from files or from a stream of messages."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clipwire.schema import (
    ARTICLE_SCHEMA,
    CORRUPT_COLUMN,
    EXTRA_COLUMN,
    PAYLOAD_SCHEMA,
    POSITION_COLUMN,
)

_PERMISSIVE = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT_COLUMN}


def read_payload_files(spark: SparkSession, path: str, whole_files: bool = False) -> DataFrame:
    """Payload texts as ``value``: one per line, or one per file with ``whole_files``.

    Folders named ``from_date=yyyy-MM-dd`` add that column.
    """
    return spark.read.text(path, wholetext=whole_files)


def _parsed(payloads: DataFrame, value: str) -> DataFrame:
    return payloads.withColumn("_payload", F.from_json(value, PAYLOAD_SCHEMA, _PERMISSIVE))


def _is_corrupt(parsed: str = "_payload") -> Column:
    return F.col(f"{parsed}.{CORRUPT_COLUMN}").isNotNull()


def _articles(payloads: DataFrame, value: str) -> DataFrame:
    """Each article's JSON text and fields, with its position and the payload's other columns."""
    others = [c for c in payloads.columns if c != value]
    # The corrupt payloads go inside the explode: a filter before it would be rewritten
    # to parse each payload again.
    found = F.when(~_is_corrupt(), F.col("_payload.articles"))
    schema = T.StructType([*ARTICLE_SCHEMA.fields, T.StructField(CORRUPT_COLUMN, T.StringType())])
    return (
        _parsed(payloads, value)
        .select(*others, F.posexplode(found).alias(POSITION_COLUMN, "_json"))
        .where(F.col("_json").isNotNull())
        .withColumn("_article", F.from_json("_json", schema, _PERMISSIVE))
    )


def ingest_articles(payloads: DataFrame, value: str = "value") -> DataFrame:
    """One row per article; other columns of ``payloads`` are kept.

    ``extra`` holds an article's unknown fields as a JSON object, null if it has none, and
    ``position`` its place in the payload from 0, which is the order the sender ranked it in.
    Payloads without articles give no rows. A malformed payload gives none either, and a
    malformed article is left out alone: see ``rejected_payloads``, ``rejected_articles``.
    Works on batch and streaming frames.
    """
    others = [c for c in payloads.columns if c != value]
    fields = F.from_json("_json", "map<string,string>")
    unknown = F.map_filter(fields, lambda k, _: ~k.isin(*ARTICLE_SCHEMA.names))
    return (
        _articles(payloads, value)
        .where(~_is_corrupt("_article"))
        .select(
            *[f"_article.{name}" for name in ARTICLE_SCHEMA.names],
            F.when(F.size(unknown) > 0, F.to_json(unknown)).alias(EXTRA_COLUMN),
            POSITION_COLUMN,
            *[c for c in others if c not in (EXTRA_COLUMN, POSITION_COLUMN)],
        )
    )


def rejected_payloads(payloads: DataFrame, value: str = "value") -> DataFrame:
    """The payloads that are malformed or do not fit the schema."""
    return _parsed(payloads, value).where(_is_corrupt()).drop("_payload")


def rejected_articles(payloads: DataFrame, value: str = "value") -> DataFrame:
    """The malformed articles of good payloads, as their JSON in ``value``."""
    bad = _articles(payloads, value).where(_is_corrupt("_article"))
    return bad.select(*[F.col("_json").alias(c) if c == value else c for c in payloads.columns])


def history_union(batches: Iterable[DataFrame]) -> DataFrame | None:
    """All batches as one frame by column name; ``None`` if there is no batch.

    A column absent from a batch is null there. For many days, read all payload
    files at once instead: ``ingest_articles(read_payload_files(spark, path))``.
    """
    frames = list(batches)
    if not frames:
        return None
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
