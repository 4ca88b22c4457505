"""The registered queries: name to function of (session, folder of tables)."""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clipwire.checks import params as P
from clipwire.checks.views import (
    article_payloads,
    article_texts,
    articles,
    dated_articles,
    memory,
    mixed_payloads,
    offset_articles,
    payload_value,
    with_pt,
)
from clipwire import operators as ops
from clipwire import plans, sources, streaming
from clipwire.__main__ import run as run_job
from clipwire.functions import keyword_match as match_column
from clipwire.schema import (
    ARTICLE_KEYS,
    DAY_TABLE,
    HARMONIZED_TABLE,
    KEYWORD_TABLE,
    RAW_SCHEMA,
    SOURCE_AUTHOR_TABLE,
    STORE_SCHEMA,
)
from clipwire.session import scratch_dir
from clipwire.sources import files
from clipwire.sources.keyindex import key_digest

Query = Callable[[SparkSession, str], DataFrame]
_REGISTRY: dict[str, Query] = {}

_ID = ["url", "author", "title", "publishedAt"]
_TRANSLATED = [f"{c}_{s}" for c in ("description", "content", "title") for s in ("pt", "translated")]


def query(fn: Query) -> Query:
    _REGISTRY[fn.__name__] = fn
    return fn


def registered() -> dict[str, Query]:
    return dict(_REGISTRY)


#: Files that a day's payloads come in.
_FILES_A_DAY = 2


def _days_of(payloads: DataFrame) -> list:
    return [r[0] for r in payloads.select("from_date").distinct().orderBy("from_date").collect()]


def _land(payloads: DataFrame, folders: dict, value: Column | None = None) -> None:
    """Write the payloads of each day (key) to two files in a folder of its own, day after day.

    All of them in one pass: each file is a partition, so days cost no pass over the input each. The
    files are dated in the order of the days, a second apart, as streams take them by date. Where
    ``value`` makes a payload out of a row, it does so after the shuffle, as payloads hold a text twice.
    """
    value = (F.col("value") if value is None else value).alias("value")
    spark, days = payloads.sparkSession, [d for d in folders if d is not None]
    if None in folders:  # no date: an empty folder
        payloads.where(F.lit(False)).select(value).write.text(folders[None])
    if days:
        pass_dir = scratch_dir(spark, "landed")
        of_day = spark.createDataFrame([(d, _FILES_A_DAY * n) for n, d in enumerate(days)], "day date, first int")
        rest = [c for c in payloads.columns if c != "from_date"]
        part = F.pmod(F.xxhash64(*rest), F.lit(_FILES_A_DAY)).cast("int")
        dealt = payloads.join(F.broadcast(of_day), F.col("from_date") == F.col("day"))
        dealt = dealt.select(*rest, (F.col("first") + part).alias("part"))
        dealt = dealt.repartitionById(_FILES_A_DAY * len(days), "part")
        dealt.select(value).write.text(pass_dir)
        for name in files.data_files(spark, pass_dir):
            n = int(name.split("-")[1]) // _FILES_A_DAY
            files.move_file(spark, f"{pass_dir}/{name}", f"{folders[days[n]]}/{name}")
    ordered, now = list(folders.values()), int(time.time())
    for n, folder in enumerate(ordered):
        there = files.data_files(spark, folder) if files.folder_exists(spark, folder) else []
        for k in range(len(there), _FILES_A_DAY if there else 0):
            there.append(f"part-empty-{k}.txt")
            files.empty_file(spark, f"{folder}/{there[-1]}")
        for name in there:
            files.date_file(spark, f"{folder}/{name}", (now - len(ordered) + n) * 1000)


def _land_days(spark: SparkSession, sf: str, landing: str) -> list:
    """Write the payloads of each day to a folder of two files, day after day; the days."""
    dated = dated_articles(spark, sf)
    days = _days_of(dated)
    _land(dated, {d: f"{landing}/{n}" for n, d in enumerate(days)}, payload_value(dated))
    return days


def _date_text(name: str = "from_date") -> Column:
    return F.col(name).cast("string").alias(name)


def _joined(column: str) -> list[Column]:
    """An array as text, with its length, so that any engine can compare it."""
    return [F.array_join(column, "|").alias(column), F.size(column).alias("n_tokens")]


# Sources and sinks


@query
def ingest_articles(spark, sf):
    return sources.ingest_articles(mixed_payloads(spark, sf)).select(
        F.col("source.id").alias("source_id"),
        F.col("source.name").alias("source_name"),
        *_ID,
        "description",
        "content",
        "extra",
        "position",
    )


@query
def rejected_payloads(spark, sf):
    return sources.rejected_payloads(mixed_payloads(spark, sf)).select("value")


@query
def rejected_articles(spark, sf):
    return sources.rejected_articles(mixed_payloads(spark, sf)).select("value")


@query
def stamp_from_date(spark, sf):
    stamped = ops.stamp_from_date(article_texts(spark, sf), P.STAMP)
    return stamped.select("url", "title", _date_text())


@query
def history_union(spark, sf):
    """One frame per day; the first has no description."""
    landing = scratch_dir(spark, "history")
    days = _land_days(spark, sf, landing)
    frames = [
        ops.stamp_from_date(
            sources.ingest_articles(sources.read_payload_files(spark, f"{landing}/{n}")), day
        )
        for n, day in enumerate(days)
    ]
    history = sources.history_union([frames[0].drop("description"), *frames[1:]])
    return history.select(*_ID, "description", "content", _date_text())


@query
def assign_windows(spark, sf):
    return ops.assign_windows(articles(spark, sf), P.TODAY).select(*_ID, _date_text())


@query
def assign_windows_closed(spark, sf):
    windows = ops.assign_windows(offset_articles(spark, sf), P.TODAY, closed=True)
    return windows.select(*_ID, _date_text())


@query
def window_page_cap(spark, sf):
    windows = ops.assign_windows(articles(spark, sf), P.TODAY)
    capped = ops.window_page_cap(windows, "popularity", page_size=P.PAGE_SIZE)
    return capped.select("url", "popularity", _date_text())


@query
def producer_window(spark, sf):
    recent = ops.producer_window(articles(spark, sf), P.PRODUCER_TO, P.PRODUCER_DAYS)
    return recent.select(*_ID)


@query
def search_query(spark, sf):
    return ops.search_query(article_texts(spark, sf), P.SEARCH).select("url", "title")


def _dated(spark, sf):
    return ops.assign_windows(articles(spark, sf), P.TODAY, days=60)


@query
def write_overwrite(spark, sf):
    path = scratch_dir(spark, "overwrite")
    flat = ops.flatten_source(articles(spark, sf))
    sources.write_overwrite(flat, path)
    sources.write_overwrite(ops.dedup_latest(flat), path)
    return sources.load_table(spark, path).select(*_ID, "content")


@query
def write_partition_overwrite(spark, sf):
    path = scratch_dir(spark, "partition-overwrite")
    dated = _dated(spark, sf)
    sources.write_partition_overwrite(dated, path)
    # The days up to REWRITE_TO come again, without duplicates; other days must stay.
    again = ops.producer_window(dated, P.REWRITE_TO, 1).where("from_date < '2024-01-03'")
    sources.write_partition_overwrite(ops.dedup_latest(again), path)
    return sources.load_table(spark, path).select(*_ID, _date_text())


@query
def write_partition_append(spark, sf):
    path = scratch_dir(spark, "partition-append")
    dated = _dated(spark, sf)
    sources.write_partition_append(dated, path)
    sources.write_partition_append(ops.producer_window(dated, P.PRODUCER_TO, 1), path)
    return sources.load_table(spark, path).select(*_ID, _date_text())


@query
def load_table(spark, sf):
    path = scratch_dir(spark, "load")
    sources.write_partition_overwrite(_dated(spark, sf), path)
    since = sources.load_table(spark, path, since=P.TODAY.replace(month=1, day=2))
    return since.select(*_ID, _date_text())


@query
def read_csv_export(spark, sf):
    path = scratch_dir(spark, "csv")
    export = with_pt(article_texts(spark, sf)).select("url", "author", "title_pt", "content_pt")
    sources.write_csv_export(export, path)
    return sources.read_csv_export(spark, path, export.schema)


@query
def table_counts(spark, sf):
    dated = _dated(spark, sf)
    latest = ops.dedup_latest(dated.drop("from_date"))
    return ops.table_counts({"raw": dated, HARMONIZED_TABLE: latest})


# Projections and filters


@query
def flatten_source(spark, sf):
    flat = ops.flatten_source(articles(spark, sf))
    return flat.select(*_ID, "source_id", "source_name", "description", "content")


@query
def keyword_filter(spark, sf):
    return ops.keyword_filter(with_pt(articles(spark, sf)), P.KEYWORDS).select(*_ID, "content_pt")


@query
def keyword_match(spark, sf):
    texts = with_pt(article_texts(spark, sf))
    return texts.select("url", match_column(P.KEYWORDS).alias("keyword_match"))


@query
def relevance_strict(spark, sf):
    return ops.relevance_strict(with_pt(article_texts(spark, sf)), P.STRICT_KEYWORDS).select(
        "url", "title"
    )


# Translation


@query
def translate_enrich(spark, sf):
    enriched = ops.translate_enrich(article_texts(spark, sf), memory(spark, sf))
    return enriched.select("url", *_TRANSLATED)


@query
def translate_enrich_few(spark, sf):
    """The way taken for few articles when the memory is too big to broadcast."""
    enriched = ops.translate_enrich(
        article_texts(spark, sf), memory(spark, sf), lookup=False, few=True
    )
    return enriched.select("url", *_TRANSLATED)


@query
def translate_enrich_large(spark, sf):
    """The way taken when neither the memory nor the articles may be broadcast."""
    enriched = ops.translate_enrich(
        article_texts(spark, sf), memory(spark, sf), lookup=False, few=False
    )
    return enriched.select("url", *_TRANSLATED)


@query
def translation_pending(spark, sf):
    return ops.translation_pending(article_texts(spark, sf), memory(spark, sf))


@query
def translation_pending_large(spark, sf):
    """The way taken when the memory is too big to broadcast."""
    return ops.translation_pending(article_texts(spark, sf), memory(spark, sf), lookup=False)


def _demo_translator():
    def translate(text):
        if "license" in text:
            raise ValueError("license text")
        return "pt: " + text

    return translate


@query
def translate_texts(spark, sf):
    pending = ops.translation_pending(article_texts(spark, sf), memory(spark, sf))
    return ops.translate_texts(pending, _demo_translator())


@query
def translate_udf(spark, sf):
    store = scratch_dir(spark, "translations")
    translated = ops.translate_udf(article_texts(spark, sf), _demo_translator(), store)
    return translated.select("url", *_TRANSLATED)


# De-duplication


@query
def dedup_latest(spark, sf):
    return ops.dedup_latest(articles(spark, sf)).select(*_ID, "content")


@query
def dedup_max_by(spark, sf):
    return ops.dedup_max_by(articles(spark, sf)).select(*_ID, "content")


# Counts


@query
def count_by_day(spark, sf):
    return ops.count_by_day(articles(spark, sf))


@query
def count_by_source_author(spark, sf):
    return ops.count_by_source_author(with_pt(article_texts(spark, sf)))


@query
def count_keyword_days(spark, sf):
    return ops.count_keyword_days(with_pt(articles(spark, sf)), P.KEYWORDS)


@query
def count_keyword_occurrences(spark, sf):
    return ops.count_keyword_occurrences(with_pt(articles(spark, sf)), P.KEYWORDS)


# Words


def _words(spark, sf):
    return with_pt(article_texts(spark, sf)).select("url", "content_pt")


def _visible_words(spark, sf):
    return ops.remove_stopwords(ops.tokenize_ml(_words(spark, sf)), P.STOPWORDS)


@query
def tokenize_ml(spark, sf):
    return ops.tokenize_ml(_words(spark, sf)).select("url", *_joined("tokens"))


@query
def remove_stopwords(spark, sf):
    return _visible_words(spark, sf).select("url", *_joined("filtered_tokens"))


@query
def ascii_words(spark, sf):
    return ops.ascii_words(_visible_words(spark, sf)).select("url", *_joined("filtered_tokens"))


@query
def explode_words(spark, sf):
    return ops.explode_words(ops.ascii_words(_visible_words(spark, sf))).select("url", "word")


@query
def word_count(spark, sf):
    return ops.word_count(_words(spark, sf), P.STOPWORDS)


@query
def top_words(spark, sf):
    return ops.top_words(ops.word_count(_words(spark, sf), P.STOPWORDS, ordered=False))


@query
def rank_words(spark, sf):
    return ops.rank_words(ops.word_count(_words(spark, sf), P.STOPWORDS, ordered=False))


@query
def tokenize_whitespace(spark, sf):
    return ops.tokenize_whitespace(_words(spark, sf)).select("url", *_joined("tokens"))


@query
def alpha_words(spark, sf):
    tokens = ops.tokenize_whitespace(_words(spark, sf))
    return ops.alpha_words(tokens, P.STOPWORDS).select("url", *_joined("filtered_tokens"))


def _zipf(spark, sf, ordered=False):
    return ops.zipf_word_freq(_words(spark, sf), P.STOPWORDS, ordered=ordered)


@query
def zipf_word_freq(spark, sf):
    return _zipf(spark, sf, ordered=True)


@query
def zipf_top10(spark, sf):
    return ops.zipf_top10(_zipf(spark, sf))


@query
def zipf_compare(spark, sf):
    return ops.zipf_compare(_zipf(spark, sf))


def _many_keywords(spark, sf) -> list[str]:
    """Every word of four letters and more of the benchmark."""
    words = F.explode(F.regexp_extract_all("text", F.lit("[A-Za-z]{4,}"), 0)).alias("word")
    words = spark.read.parquet(f"{sf}/benchmark.parquet").select(words).select(F.lower("word")).distinct()
    return sorted(r[0] for r in words.collect())


@query
def count_keyword_occurrences_many(spark, sf):
    return ops.count_keyword_occurrences_many(with_pt(articles(spark, sf)), _many_keywords(spark, sf))


@query
def keyword_filter_many(spark, sf):
    found = ops.keyword_filter_many(with_pt(articles(spark, sf)), _many_keywords(spark, sf)[::7])
    return found.select(*_ID, "content_pt")


# Streams


def _payload_stream(spark, sf, label):
    """A stream with a micro-batch for each day, and the first day once more at the end."""
    landing = scratch_dir(spark, label)
    days = _land_days(spark, sf, f"{landing}/landing")
    again = spark.read.text(f"{landing}/landing/0")
    again.coalesce(_FILES_A_DAY).write.text(f"{landing}/landing/again")
    stream = streaming.file_payloads(spark, f"{landing}/landing/*", P.FILES_PER_BATCH)
    return streaming.stream_articles(stream), landing, len(days)


@query
def stream_articles(spark, sf):
    stream, folder, _ = _payload_stream(spark, sf, "stream-articles")
    streaming.append_raw(stream, f"{folder}/raw", f"{folder}/checkpoint").awaitTermination()
    return sources.load_table(spark, f"{folder}/raw").select(*_ID, "content")


@query
def stream_rejects(spark, sf):
    folder = scratch_dir(spark, "stream-rejects")
    mixed_payloads(spark, sf).write.text(f"{folder}/landing")
    payloads = streaming.file_payloads(spark, f"{folder}/landing", P.FILES_PER_BATCH)
    streaming.append_rejects(
        payloads, f"{folder}/rejects", f"{folder}/checkpoint"
    ).awaitTermination()
    return sources.load_table(spark, f"{folder}/rejects").select("value")


@query
def stream_stage_merge(spark, sf):
    stream, folder, _ = _payload_stream(spark, sf, "stream-merge")
    for run in ("first", "second"):
        # The second run sees every payload again and must add nothing.
        streaming.stream_stage_merge(
            stream, f"{folder}/raw", f"{folder}/staging-{run}", f"{folder}/checkpoint-{run}"
        ).awaitTermination()
    return sources.load_table(spark, f"{folder}/raw").select(*_ID, "content")


@query
def stream_dedup(spark, sf):
    stream, folder, days = _payload_stream(spark, sf, "stream-dedup")
    # Too long for a key to be forgotten before the last day, short enough for the first day
    # to be late when it comes once more.
    delay = f"{max(1, days - 2)} days"
    unique = streaming.stream_dedup(stream, delay).drop("published_ts")
    streaming.append_raw(unique, f"{folder}/raw", f"{folder}/checkpoint").awaitTermination()
    # Which of a day's copies comes first depends on file order, so of each row its key and day
    # are compared, and that it is one of the rows that came in.
    came = sources.ingest_articles(sources.read_payload_files(spark, f"{folder}/landing/*"))
    row = key_digest([*_ID, "content"]).alias("row")
    kept = sources.load_table(spark, f"{folder}/raw").select(*ARTICLE_KEYS, "publishedAt", row)
    kept = kept.join(came.select(row).distinct(), "row", "left_semi")
    day = F.col("publishedAt").try_cast("date").cast("string").alias("published_day")
    return kept.select(*ARTICLE_KEYS, day)


@query
def stream_latest(spark, sf):
    """The latest copy of each article, whichever micro-batch it came in; the first day comes again."""
    stream, folder, days = _payload_stream(spark, sf, "stream-latest")
    latest = streaming.stream_latest(stream, f"{days} days", keep_days=days)
    streaming.append_raw(latest, f"{folder}/raw", f"{folder}/checkpoint").awaitTermination()
    return streaming.latest_articles(spark, f"{folder}/raw").select(*_ID, "content")


@query
def stream_counts_by_day(spark, sf):
    stream, folder, _ = _payload_stream(spark, sf, "stream-counts")
    streaming.stream_counts_by_day(
        stream, f"{folder}/counts", f"{folder}/checkpoint"
    ).awaitTermination()
    return streaming.latest_counts(spark, f"{folder}/counts", f"{folder}/checkpoint")


@query
def quality_rows(spark, sf):
    """Counts after each stage of a harmonization, out of its one pass."""
    log = ops.QualityLog("harmonize", "1")
    raw = log.watch(sources.ingest_articles(article_payloads(spark, sf)), "raw")
    flat = with_pt(raw)
    relevant = log.watch(ops.keyword_filter(flat, P.KEYWORDS), "relevant")
    latest = log.watch(ops.dedup_latest(relevant), "latest")
    folder = scratch_dir(spark, "quality")
    sources.write_overwrite(latest, f"{folder}/harmonized")
    log.save(spark, f"{folder}/quality")
    return sources.load_table(spark, f"{folder}/quality").select("stage", "measure", "value")


@query
def stream_quality_rows(spark, sf):
    """Counts of the micro-batches of a stream, summed."""
    stream, folder, _ = _payload_stream(spark, sf, "stream-quality")
    listener = streaming.QualityListener(spark, f"{folder}/quality")
    spark.streams.addListener(listener)
    try:
        query = streaming.append_raw(
            streaming.watched(stream, "raw"), f"{folder}/raw", f"{folder}/checkpoint", streaming.available_now()
        )
        query.awaitTermination()
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
    finally:
        spark.streams.removeListener(listener)
    rows = sources.load_table(spark, f"{folder}/quality", schema=ops.QUALITY_SCHEMA)
    return rows.groupBy("stage", "measure").agg(F.sum("value").alias("value"))


# Whole jobs


@query
def collect_history(spark, sf):
    history = plans.collect_history(
        articles(spark, sf), P.TODAY, "popularity", P.SEARCH, page_size=P.PAGE_SIZE
    )
    return history.select(*_ID, "popularity", _date_text())


@query
def collect_recent(spark, sf):
    recent = plans.collect_recent(
        articles(spark, sf),
        P.PRODUCER_TO,
        "popularity",
        P.SEARCH,
        P.PRODUCER_DAYS,
        P.PAGE_SIZE,
        from_date=P.STAMP,
    )
    return recent.select(*_ID, "popularity", _date_text())


@query
def harmonize(spark, sf):
    harmonized = plans.harmonize(articles(spark, sf), memory(spark, sf), P.PT_KEYWORDS)
    return harmonized.select(*_ID, "source_id", "source_name", *_TRANSLATED)


@query
def harmonize_large(spark, sf):
    """The way taken when neither the memory nor the articles may be broadcast."""
    harmonized = plans.harmonize(
        articles(spark, sf), memory(spark, sf), P.PT_KEYWORDS, lookup=False, few=False
    )
    return harmonized.select(*_ID, "source_id", "source_name", *_TRANSLATED)


def _tall(spark: SparkSession, paths: dict[str, str]) -> DataFrame:
    """The three count tables below each other."""
    columns = {
        "year": "int",
        "month": "int",
        "day": "int",
        "source_name": "string",
        "author": "string",
        "n": "bigint",
    }
    measure = {
        DAY_TABLE: "news_count",
        SOURCE_AUTHOR_TABLE: "news_count",
        KEYWORD_TABLE: "keyword_appearance_count",
    }
    parts = []
    for name, count in measure.items():
        df = sources.load_table(spark, paths[name]).withColumnRenamed(count, "n")
        parts.append(
            df.select(
                F.lit(name).alias("table_name"),
                *[
                    (F.col(c) if c in df.columns else F.lit(None)).cast(t).alias(c)
                    for c, t in columns.items()
                ],
            )
        )
    return sources.history_union(parts)


@query
def aggregate_all(spark, sf):
    folder = scratch_dir(spark, "semantic")
    paths = plans.aggregate_all(with_pt(articles(spark, sf)), folder, P.KEYWORDS)
    return _tall(spark, paths)


@query
def history_after_recent(spark, sf):
    """The jobs: the first day comes recently, the others as history by day, one of them undated."""
    folder = scratch_dir(spark, "history-job")
    payloads, dated = article_payloads(spark, sf), dated_articles(spark, sf)
    days = _days_of(dated)
    # Without a first date no day is later than it.
    places = {} if days[0] is None else {d: f"{folder}/past/from_date={d}" for d in days}
    places |= {days[n]: f"{folder}/landing/{n % len(days)}" for n in (-1, 0)}
    payloads.where(F.lit(False)).write.partitionBy("from_date").text(f"{folder}/past")
    _land(dated, places, payload_value(dated))
    raw = ["--raw", f"{folder}/raw"]
    recent = ["recent", "--payloads", f"{folder}/landing/0", *raw, "--staging", f"{folder}/staging"]
    run_job(spark, [*recent, "--checkpoint", f"{folder}/checkpoint"])
    run_job(spark, ["history", "--payloads", f"{folder}/past", *raw])
    run_job(spark, ["history", "--payloads", f"{places[days[-1]]}", *raw])
    stored = sources.load_table(spark, f"{folder}/raw", schema=RAW_SCHEMA)
    return stored.select(*_ID, "content")


@query
def merge_after_history(spark, sf):
    """The jobs: history by day, with a stream between its days, and one of all payloads day by day after them."""
    folder = scratch_dir(spark, "merge-history")
    days = _land_days(spark, sf, f"{folder}/landing")
    raw = ["--raw", f"{folder}/raw"]
    recent = ["recent", "--payloads", f"{folder}/landing/*", *raw, "--staging", f"{folder}/staging"]
    for n, day in enumerate(days[:2]):
        # The day's payloads as they landed, so that the join to the times is not made for each day.
        of_day = spark.read.text(f"{folder}/landing/{n}").withColumn("from_date", F.lit(day).cast("date"))
        of_day.write.partitionBy("from_date").text(f"{folder}/past-{n}")
        run_job(spark, ["history", "--payloads", f"{folder}/past-{n}", *raw])
        if n == 0:
            first = ["recent", "--payloads", f"{folder}/landing/0", *recent[3:]]
            run_job(spark, [*first, "--checkpoint", f"{folder}/first"])
    run_job(spark, [*recent, "--checkpoint", f"{folder}/all", "--per-batch", str(P.FILES_PER_BATCH)])
    stored = sources.load_table(spark, f"{folder}/raw", schema=RAW_SCHEMA)
    return stored.select(*_ID, "content")


@query
def translate_udf_twice(spark, sf):
    """Two runs on halves of the articles share one store, and the second translates the rest."""
    store = scratch_dir(spark, "translations-twice")
    texts = article_texts(spark, sf)
    for half in (0, 1):
        part = texts.where(F.pmod(F.xxhash64("url"), F.lit(2)) == half)
        ops.fill_memory(part, _demo_translator(), store)
    known = spark.read.schema(STORE_SCHEMA).parquet(store)
    return ops.translate_enrich(texts, known).select("url", *_TRANSLATED)


@query
def daily_job(spark, sf):
    folder = scratch_dir(spark, "daily")
    sources.write_partition_overwrite(_dated(spark, sf), f"{folder}/raw")
    sources.write_overwrite(memory(spark, sf), f"{folder}/memory")
    paths = plans.daily_job(
        spark, f"{folder}/raw", f"{folder}/memory", folder, P.PT_KEYWORDS, P.KEYWORDS
    )
    return _tall(spark, paths)


def _three_days(spark, sf):
    """Three runs: a day and half of the translations, the other days one by one, late translations."""
    folder = scratch_dir(spark, "daily-incremental")
    # The join to the times is made once, not once a day.
    sources.write_partition_append(_dated(spark, sf), f"{folder}/dated")
    dated, known = sources.load_table(spark, f"{folder}/dated"), memory(spark, sf)
    early = F.pmod(F.xxhash64("text"), F.lit(2)) == 0
    days = [r[0] for r in dated.select("from_date").distinct().orderBy("from_date").collect()]
    for n, day in enumerate(days):
        of_day = F.col("from_date") == F.lit(day)
        sources.append_as_dealt(dated.where(of_day), f"{folder}/raw")
        if n in (0, len(days) - 1):
            # The first day's translations come early or late, half of them each.
            known.where(early if n == 0 else ~early).write.mode("append").parquet(f"{folder}/memory")
        paths = plans.daily_incremental(
            spark, f"{folder}/raw", f"{folder}/memory", folder, P.PT_KEYWORDS, P.KEYWORDS
        )
    return paths


@query
def daily_incremental(spark, sf):
    """The counts after three runs, each of which works on what is new."""
    return _tall(spark, _three_days(spark, sf))


@query
def harmonize_incremental(spark, sf):
    """The harmonized table after three runs."""
    harmonized = sources.load_table(spark, _three_days(spark, sf)[HARMONIZED_TABLE])
    return harmonized.select(*_ID, "source_id", "source_name", *_TRANSLATED)
