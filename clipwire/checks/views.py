"""Articles, payloads and a translation memory out of the given tables.

A document is an article: its first line is the title, its second the description, and
the whole text the content. The event of the same number gives time and popularity.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clipwire.operators.translation import source_texts
from clipwire.schema import ARTICLE_SCHEMA, TEXT_COLUMNS

ISO = "yyyy-MM-dd'T'HH:mm:ss'Z'"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def article_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The text side of the articles. It needs no join, as it has no time."""
    text = F.col("text")
    second_line = F.substring_index(F.substring_index(text, "\n", 2), "\n", -1)
    return table(spark, sf_dir, "documents").select(
        "doc_id",
        "lang",
        F.struct(
            F.when(F.col("lang") != "de", F.col("source")).alias("id"),
            F.col("source").alias("name"),
        ).alias("source"),
        F.when(F.col("n_chars") >= 800, F.concat("lang", F.lit(" desk"))).alias("author"),
        F.substring_index(text, "\n", 1).alias("title"),
        F.when(text.contains("\n") & (second_line != ""), second_line).alias("description"),
        F.concat(F.lit("https://news.example/"), F.col("doc_id")).alias("url"),
        text.alias("content"),
    )


def articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw articles with their nested source, publication time and popularity."""
    events = table(spark, sf_dir, "events").select(
        F.col("event_id").alias("doc_id"),
        F.date_format("ts", ISO).alias("publishedAt"),
        F.col("value").alias("popularity"),
    )
    return article_texts(spark, sf_dir).join(events, "doc_id").drop("doc_id")


def with_pt(df: DataFrame) -> DataFrame:
    """Flat articles whose texts stand in for their translations."""
    return df.select(
        "*",
        F.col("source.id").alias("source_id"),
        F.col("source.name").alias("source_name"),
        *[F.col(c).alias(f"{c}_pt") for c in TEXT_COLUMNS],
    ).drop("source")


def memory(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Translations of every text of the articles that are not in English."""
    foreign = article_texts(spark, sf_dir).where(F.col("lang") != "en")
    return source_texts(foreign).select(
        "text",
        F.concat(
            F.lit("pt: "), F.replace("text", F.lit("license"), F.lit("licença"))
        ).alias("text_pt"),
    )


def _payload_articles(df: DataFrame) -> list[Column]:
    """The JSON of each article and of its wire copy without author, in this order."""
    fields = [
        F.col(f.name) if f.name != "urlToImage" else F.lit(None).cast("string").alias(f.name)
        for f in ARTICLE_SCHEMA
    ]
    wire = [
        F.struct(F.lit("wire").alias("id"), F.lit("Wire").alias("name")).alias("source")
        if f.name == "source"
        else F.lit(None).cast("string").alias(f.name)
        if f.name in ("author", "urlToImage")
        else F.col(f.name)
        for f in ARTICLE_SCHEMA
    ]
    return [F.to_json(F.struct(*fields, "lang")), F.to_json(F.struct(*wire))]


def _payload_of(*articles: Column) -> Column:
    joined = F.concat_ws(",", *articles)
    return F.concat(F.lit('{"status":"ok","articles":['), joined, F.lit("]}")).alias("value")


def dated_articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The articles with the day that their payloads land on, as ``from_date``."""
    return articles(spark, sf_dir).withColumn("from_date", F.col("publishedAt").try_cast("date"))


def payload_value(df: DataFrame) -> Column:
    """The payload of each article, holding it and a wire copy without author."""
    return _payload_of(*_payload_articles(df))


def article_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One payload per article, see ``payload_value``."""
    df = dated_articles(spark, sf_dir)
    return df.select(payload_value(df), "from_date")


def mixed_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Payloads of a good article, a bad one and a good one; event properties (no articles); pages."""
    df = articles(spark, sf_dir)
    good, wire = _payload_articles(df)
    bad = F.concat(F.lit('{"source":"none","url":"'), "url", F.lit('"}'))
    empty = table(spark, sf_dir, "events").select(F.col("props").alias("value"))
    broken = table(spark, sf_dir, "pages").select(F.col("html").alias("value"))
    return df.select(_payload_of(good, bad, wire)).union(empty).union(broken)


def offset_articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Articles whose times are written with the offset of New York, some of them at midnight UTC."""
    events = table(spark, sf_dir, "events")
    at = F.when(F.col("event_id") % 3 == 0, F.date_trunc("day", "ts")).otherwise(F.col("ts"))
    times = events.select(
        F.col("event_id").alias("doc_id"),
        F.concat(F.date_format(at - F.expr("INTERVAL 5 HOURS"), "yyyy-MM-dd'T'HH:mm:ss"), F.lit("-05:00")).alias(
            "publishedAt"
        ),
    )
    return article_texts(spark, sf_dir).join(times, "doc_id").drop("doc_id")
