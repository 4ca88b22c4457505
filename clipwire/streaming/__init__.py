"""Structured Streaming: article streams, merge without duplicates, running counts."""

from clipwire.streaming.articles import (
    TOPIC,
    append_raw,
    append_rejects,
    available_now,
    file_payloads,
    hourly_batches,
    kafka_payloads,
    stream_articles,
)
from clipwire.streaming.counts import latest_counts, stream_counts_by_day
from clipwire.streaming.dedup import stream_dedup
from clipwire.streaming.latest import latest_articles, stream_latest
from clipwire.streaming.merge import add_keys, key_index, make_keys, new_articles, stream_stage_merge
from clipwire.streaming.quality import QualityListener, watched

__all__ = [
    "QualityListener",
    "TOPIC",
    "add_keys",
    "append_raw",
    "append_rejects",
    "available_now",
    "file_payloads",
    "hourly_batches",
    "kafka_payloads",
    "key_index",
    "latest_articles",
    "latest_counts",
    "make_keys",
    "new_articles",
    "stream_articles",
    "stream_counts_by_day",
    "stream_dedup",
    "stream_latest",
    "stream_stage_merge",
    "watched",
]
