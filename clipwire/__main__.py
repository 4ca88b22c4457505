"""Jobs for spark-submit or any scheduler: python -m clipwire <job> ..."""

from __future__ import annotations

import argparse
import datetime as dt
import importlib
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clipwire import operators as ops
from clipwire import plans, sources, streaming
from clipwire.schema import (
    COUNT_KEYWORDS,
    MEMORY_SCHEMA,
    PARTITION_COLUMN,
    RAW_SCHEMA,
    RELEVANCE_KEYWORDS,
    SEARCH_TERMS,
)
from clipwire.session import build_session


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="clipwire")
    parser.add_argument("--fmt", default="parquet", help="table format, such as parquet or delta")
    jobs = parser.add_subparsers(dest="job", required=True)

    history = jobs.add_parser("history", help="load payload files of past days into the raw table")
    history.add_argument("--payloads", required=True)
    history.add_argument("--raw", required=True)
    history.add_argument("--rejects", help="table for malformed payloads and articles")
    history.add_argument("--from-date", type=dt.date.fromisoformat, help="day of undated payloads")
    history.add_argument(
        "--collect", type=dt.date.fromisoformat, metavar="TODAY",
        help="keep only what the history search up to this day finds, by its windows",
    )
    history.add_argument("--terms", nargs="+", default=list(SEARCH_TERMS))

    recent = jobs.add_parser("recent", help="insert new payload files into the raw table")
    recent.add_argument("--payloads", help="folder of payload files")
    recent.add_argument("--kafka-servers", help="or a Kafka topic; needs Spark's connector")
    recent.add_argument("--topic", default=streaming.TOPIC)
    recent.add_argument("--raw", required=True)
    recent.add_argument("--staging", required=True)
    recent.add_argument("--checkpoint", required=True)
    recent.add_argument("--rejects", help="table for malformed payloads")
    recent.add_argument("--per-batch", type=int, help="files, or messages, that a micro-batch takes at most")
    recent.add_argument("--hourly", action="store_true", help="stay up and load every hour")

    pending = jobs.add_parser("pending", help="list the texts that wait for a translation")
    pending.add_argument("--raw", required=True)
    pending.add_argument("--memory", required=True)
    pending.add_argument("--out", required=True)

    collect = jobs.add_parser("collect", help="append the first page of the latest articles")
    collect.add_argument("--payloads", required=True)
    collect.add_argument("--raw", required=True)
    collect.add_argument("--to", required=True, help="end of the search, ISO time in UTC")
    collect.add_argument("--days", type=int, default=1)
    collect.add_argument("--terms", nargs="+", default=list(SEARCH_TERMS))

    translate = jobs.add_parser("translate", help="fill the translation memory")
    translate.add_argument("--raw", required=True)
    translate.add_argument("--memory", required=True, help="table that translations are added to")
    translate.add_argument("--translator", required=True, help="module:function")
    translate.add_argument("--batched", action="store_true", help="the function takes a list")
    translate.add_argument("--parallelism", type=int)

    daily = jobs.add_parser("daily", help="harmonize the raw table, then count")
    daily.add_argument("--raw", required=True)
    daily.add_argument("--memory", required=True)
    daily.add_argument("--out", required=True)
    daily.add_argument("--incremental", action="store_true", help="only what has changed since the last run")
    daily.add_argument("--keywords", nargs="+", default=list(RELEVANCE_KEYWORDS))
    daily.add_argument("--count-keywords", nargs="+", default=list(COUNT_KEYWORDS))

    words = jobs.add_parser("words", help="count the words of the harmonized table")
    words.add_argument("--harmonized", required=True)
    words.add_argument("--out", required=True)
    words.add_argument("--accents", action="store_true", help="keep words with accents")
    words.add_argument("--top", help="table for the most frequent words")
    words.add_argument("--zipf", help="table for the first words beside Zipf's law")

    counts = jobs.add_parser("counts", help="count the rows of tables by day")
    counts.add_argument("--out", required=True, help="table for the counts")
    counts.add_argument("tables", nargs="+", help="paths of tables")
    return parser


def _insert(spark: SparkSession, found: DataFrame, raw: str, fmt: str) -> None:
    """Append the articles that the raw table does not have; what it has stays."""
    spark.createDataFrame([], RAW_SCHEMA).write.format(fmt).mode("ignore").partitionBy(
        PARTITION_COLUMN
    ).save(raw)
    there = sources.load_table(spark, raw, fmt, RAW_SCHEMA)
    new = streaming.new_articles(found, there)
    _tell_streams(new, raw)
    sources.write_partition_append(new, raw, fmt)


def _tell_streams(articles: DataFrame, raw: str) -> None:
    """Index the keys of what is about to be written, for streams that merge into the table."""
    streaming.add_keys(articles, raw, "jobs", time.time_ns())


def run(spark: SparkSession, arguments: list[str] | None = None) -> None:
    args = _parser().parse_args(arguments)
    if args.job == "history":
        payloads = sources.read_payload_files(spark, args.payloads)
        articles = sources.ingest_articles(payloads)
        if "from_date" not in articles.columns:
            articles = articles.withColumn("from_date", F.lit(None))
        articles = articles.withColumn("from_date", F.col("from_date").cast("date"))
        if args.collect:
            found = plans.collect_history(articles, args.collect, terms=args.terms)
            _insert(spark, found, args.raw, args.fmt)
        else:
            # Days that payloads name belong to this job; the day of ingestion does not.
            dated = articles.where("from_date IS NOT NULL")
            undated = ops.stamp_from_date(articles.where("from_date IS NULL"), args.from_date)
            _tell_streams(dated.unionByName(undated), args.raw)
            sources.write_partition_overwrite(dated, args.raw, args.fmt)
            sources.write_partition_append(undated, args.raw, args.fmt)
        if args.rejects:
            bad = sources.rejected_payloads(payloads).select("value")
            bad = bad.union(sources.rejected_articles(payloads).select("value"))
            sources.write_overwrite(bad, args.rejects, args.fmt)
    elif args.job == "recent":
        if bool(args.payloads) == bool(args.kafka_servers):
            raise SystemExit("give either --payloads or --kafka-servers")
        if args.kafka_servers:
            payloads = streaming.kafka_payloads(spark, args.kafka_servers, args.topic, args.per_batch)
        else:
            payloads = streaming.file_payloads(spark, args.payloads, args.per_batch)
        trigger = streaming.hourly_batches() if args.hourly else streaming.available_now()
        queries = [
            streaming.stream_stage_merge(
                streaming.stream_articles(payloads),
                args.raw,
                args.staging,
                f"{args.checkpoint}/articles",
                trigger=trigger,
                fmt=args.fmt,
            )
        ]
        if args.rejects:
            checkpoint = f"{args.checkpoint}/rejects"
            queries.append(
                streaming.append_rejects(payloads, args.rejects, checkpoint, trigger, args.fmt)
            )
        for query in queries:
            query.awaitTermination()
    elif args.job == "pending":
        raw = sources.load_table(spark, args.raw, args.fmt)
        memory = sources.load_table(spark, args.memory, args.fmt, MEMORY_SCHEMA)
        sources.write_overwrite(ops.translation_pending(raw, memory), args.out, args.fmt)
    elif args.job == "collect":
        payloads = sources.read_payload_files(spark, args.payloads)
        articles = sources.ingest_articles(payloads)
        found = plans.collect_recent(articles, args.to, terms=args.terms, days=args.days)
        _insert(spark, found, args.raw, args.fmt)
    elif args.job == "translate":
        module, _, function = args.translator.partition(":")
        translator = getattr(importlib.import_module(module), function)
        raw = sources.load_table(spark, args.raw, args.fmt)
        ops.fill_memory(
            raw, translator, args.memory, fmt=args.fmt, parallelism=args.parallelism,
            batched=args.batched,
        )
    elif args.job == "daily" and args.incremental:
        if args.fmt != "parquet":
            raise SystemExit("--incremental goes by the files of Parquet tables")
        plans.daily_incremental(
            spark, args.raw, args.memory, args.out, args.keywords, args.count_keywords
        )
    elif args.job == "daily":
        plans.daily_job(
            spark,
            args.raw,
            args.memory,
            args.out,
            args.keywords,
            args.count_keywords,
            args.fmt,
        )
    elif args.job == "words":
        harmonized = sources.load_table(spark, args.harmonized, args.fmt)
        count = ops.zipf_word_freq if args.accents else ops.word_count
        sources.write_overwrite(count(harmonized), args.out, args.fmt)
        counted = sources.load_table(spark, args.out, args.fmt)
        if args.top:
            sources.write_overwrite(ops.top_words(counted), args.top, args.fmt)
        if args.zipf:
            sources.write_overwrite(ops.zipf_compare(counted), args.zipf, args.fmt)
    elif args.job == "counts":
        tables = {path: sources.load_table(spark, path, args.fmt) for path in args.tables}
        sources.write_overwrite(ops.table_counts(tables), args.out, args.fmt)
        total = sources.load_table(spark, args.out, args.fmt).agg(F.sum("row_count")).first()[0]
        print(f"{total or 0} rows in {len(tables)} tables")


if __name__ == "__main__":
    run(build_session())
